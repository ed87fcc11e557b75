import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelops.operators import dedup, ranking, reports, split, validate, variants
from tests.conftest import rows


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def greedy(data, t):
    """One-by-one rule: drop a row when an earlier kept row of its class is within t bits."""
    kept = []
    for c, name, h in sorted(data):
        if not any(c == k[0] and ((h ^ k[2]) & (2**64 - 1)).bit_count() <= t for k in kept):
            kept.append((c, name, h))
    return {(c, n) for c, n, _ in kept}


def clustered(seed, n=160):
    """Hashes that differ in a few low bits only: many near pairs and large shared buckets."""
    rng = random.Random(seed)
    bases = [rng.getrandbits(64) for _ in range(4)]
    out = []
    for i in range(n):
        h = rng.choice(bases)
        for _ in range(rng.randint(0, 5)):
            h ^= 1 << rng.randrange(20)
        out.append((rng.choice("ab"), f"{i:04d}", signed(h)))
    return out


@pytest.mark.parametrize("t,limit", [(0, 200), (1, 200), (1, 1), (2, 3), (3, 200), (3, 2), (4, 4), (7, 200), (7, 3)])
def test_near_duplicates_equal_the_greedy_rule(spark, t, limit):
    data = clustered(t * 10 + limit)
    df = spark.createDataFrame(data, "class string, file_name string, phash bigint").repartition(5)
    out = dedup.drop_near_dups(df, t, order=("file_name",), bucket_limit=limit)
    assert set(rows(out, "class", "file_name")) == greedy(data, t)


def test_near_duplicates_on_random_hashes(spark):
    rng = random.Random(7)
    data = [("a", f"{i:04d}", signed(rng.getrandbits(64))) for i in range(300)]
    data += [("a", f"{i + 300:04d}", data[i][2] ^ (1 << (i % 60)) ^ (1 << (i % 50))) for i in range(100)]
    df = spark.createDataFrame(data, "class string, file_name string, phash bigint")
    assert set(rows(dedup.drop_near_dups(df, 3, order=("file_name",)), "class", "file_name")) == greedy(data, 3)


def test_large_buckets_are_dealt_above_the_flip_distance(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SLICE", 5)
    data = clustered(77)
    df = spark.createDataFrame(data, "class string, file_name string, phash bigint")
    assert set(rows(dedup.drop_near_dups(df, 8, order=("file_name",), bucket_limit=2), "class", "file_name")) == greedy(data, 8)


def test_exact_dedup_is_global_and_keeps_the_first(spark):
    data = [("B", "1", "x"), ("a", "2", "x"), ("a", "1", "y"), ("B", "2", "y"), ("B", "3", "z")]
    df = spark.createDataFrame(data, "class string, file_name string, content_hash string").withColumn("path", F.concat("class", "file_name"))
    kept = dedup.dedup_exact(df)
    assert sorted(rows(kept, "class", "file_name")) == [("B", "3"), ("a", "1"), ("a", "2")]
    marked = dedup.mark_copies(df, ["content_hash"], dedup.LISTING, ["path"])
    assert {r["path"]: r["is_copy"] for r in marked.collect()} == {"B1": True, "a2": False, "a1": False, "B2": True, "B3": False}
    counts = dedup.duplicate_counts(df, kept)
    assert sorted(rows(counts)) == [("B", 3, 1, 2), ("a", 2, 2, 0)]
    with pytest.raises(PySparkException, match="too few unique rows"):
        dedup.duplicate_counts(df, kept, minimum=3).collect()


SIZES = {3: (1, 1, 1), 4: (2, 1, 1), 5: (3, 1, 1), 6: (4, 1, 1), 7: (5, 1, 1), 8: (6, 1, 1), 9: (6, 2, 1), 10: (7, 2, 1), 11: (8, 2, 1),
         13: (9, 2, 2), 20: (14, 3, 3), 90: (63, 14, 13), 100: (70, 15, 15), 1000: (700, 150, 150)}


def test_split_sizes(spark):
    df = spark.createDataFrame([(n,) for n in SIZES], "n bigint").select("n", split.allocate(F.col("n")).alias("s"))
    assert {r["n"]: tuple(r["s"]) for r in df.collect()} == SIZES
    with pytest.raises(PySparkException, match="at least 3 rows"):
        spark.createDataFrame([(2,)], "n bigint").select(split.allocate(F.col("n"))).collect()
    many = spark.range(3, 3000).select("id", split.allocate(F.col("id")).alias("s"))
    assert many.where((F.col("s.train") + F.col("s.val") + F.col("s.test") != F.col("id")) | (F.least("s.train", "s.val", "s.test") < 1)).isEmpty()
    odd = split.allocate(F.lit(3).cast("bigint"), (0.98, 0.01, 0.01))
    assert tuple(spark.range(1).select(odd).first()[0]) == (1, 1, 1)
    with pytest.raises(ValueError):
        split.check_ratios((0.5, 0.5, 0.1))


def test_stratified_split_matches_a_full_sort_with_a_hot_class(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("class"),
                                   F.col("id").cast("string").alias("file_name"))
    out = split.stratified_split(big, digits=1)
    import hashlib

    groups = {}
    for r in big.collect():
        groups.setdefault(r["class"], []).append(r["file_name"])
    want = {}
    sizes = {r["class"]: (r["train"], r["val"]) for r in split.split_sizes(big).collect()}
    for c, names in groups.items():
        names.sort(key=lambda f: (hashlib.sha256(f"42:{c}:{f}".encode()).hexdigest(), f))
        a, b = sizes[c]
        for i, f in enumerate(names):
            want[f] = "train" if i < a else "val" if i < a + b else "test"
    assert {r["file_name"]: r["split"] for r in out.collect()} == want
    again = split.stratified_split(big.repartition(7), digits=2)
    assert {r["file_name"]: r["split"] for r in again.collect()} == want


def test_seed_key_value(spark):
    got = spark.range(1).select(ranking.seeded_digest(42, F.lit("en"), F.lit(7))).first()[0]
    assert got == "953f17e94307eb6896195e45c011dc16cda3dc191dec08a097d8063d4fab645c"


def test_ranks_equal_a_plain_window(spark):
    from pyspark.sql import Window

    df = spark.range(2000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    assert sorted(rows(ranking.rank_by_order(df.repartition(6), ["k"], ["v"]), "k", "v", "rank")) == sorted(rows(plain, "k", "v", "rank"))
    by_hash = ranking.rank_by_digest(df, ["k"], F.sha2("v", 256), ["v"], digits=1)
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.sha2("v", 256))))
    assert sorted(rows(by_hash, "k", "v", "rank")) == sorted(rows(plain, "k", "v", "rank"))


def test_batches(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    out = split.batches(df, 32, ["k"])
    assert sorted(r["count"] for r in out.groupBy("batch").count().collect()) == [4, 32, 32, 32]
    assert split.batches(df, 32, ["k"], drop_remainder=True).count() == 96
    assert split.batch_plan(df, 32).first()["batches"] == 4 and split.batch_plan(df, 32, True).first()["batches"] == 3
    with pytest.raises(PySparkException, match="no batch"):
        split.batch_plan(df, 200, True).collect()


def test_leaks_and_variants(spark):
    data = [("train", "a", "1", "x"), ("val", "a", "2", "x"), ("test", "a", "1", "y"), ("test", "b", "3", "z"), ("test", "b", "4", "z")]
    df = spark.createDataFrame(data, "split string, class string, file_name string, content_hash string")
    found = {(r["check"], r["left_split"], r["right_split"]): r["shared_keys"] for r in validate.leak_report(df).where("shared_keys > 0").collect()}
    assert found == {("name", "train", "test"): 1, ("content", "train", "val"): 1, ("content", "test", "test"): 1}
    a = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), ("b", "1", "x"), ("b", "9", "q")], "class string, file_name string, content_hash string")
    b = spark.createDataFrame([("a", "1", "p"), ("a", "2", "p"), ("b", "1", "p"), ("a", "7", "p")], "class string, file_name string, content_hash string")
    kept, report = variants.match_variants(a, b)
    assert sorted(rows(kept, "class", "file_name")) == [("a", "1"), ("a", "2")]
    got = {r["class"]: (r["matched"], r["matched_unique"], r["missing_in_a"], r["missing_in_b"], r["duplicate_skipped"]) for r in report.collect()}
    assert got == {"a": (2, 2, 1, 0, 0), "b": (1, 0, 0, 1, 1)}


def test_unique_names(spark):
    data = [("apple", "Apple", "IMG 1.jpg"), ("apple", "Apple", "img_1.png"), ("apple", "Apple", "img-1"), ("apple", "apple_tao_5", "img 1.jpg"), ("apple", "Apple", "__.jpg")]
    df = spark.createDataFrame(data, "class string, raw_class string, file_name string")
    out = reports.unique_names(df)
    assert sorted(rows(out, "output_name")) == [("apple__image.jpg",), ("apple__img_1.jpg",), ("apple__img_1__0002.jpg",), ("apple__img_1__0003.jpg",), ("apple__img_1__0004.jpg",)]
    assert reports.name_clashes(out).isEmpty()


def test_clean_with_tolerance_and_reasons(spark):
    from labelops.operators import cleaning

    data = clustered(5, 80)
    df = spark.createDataFrame([(c, c, f"{n}.jpg", f"{c}/{n}", 200, 200, 150.0, h) for c, n, h in data] + [("a", "a", "x.txt", "a/x", 1, 1, 0.0, 1), ("a", "a", "y.gif", "a/y", None, None, None, None)],
                               "class string, raw_class string, file_name string, path string, width int, height int, sharpness double, phash bigint")
    out = {r["path"]: r["reason"] for r in cleaning.clean(df, tolerance=2).collect()}
    assert out.pop("a/x") == "unsupported_extension" and out.pop("a/y") == "corrupted_image"
    kept = greedy([(c, n, h) for c, n, h in data], 2)
    assert {p for p, reason in out.items() if reason is None} == {f"{c}/{n}" for c, n in kept} and set(out.values()) == {None, "duplicate_image"}


def brute_removed(pairs):
    """{(group, h)} by the one-by-one rule, from (group, a, b, pa, pb)."""
    near, names = {}, {}
    for g, a, b, pa, pb in pairs:
        near.setdefault((g, pb), set()).add((g, pa))
        names[g, pa], names[g, pb] = a, b
    gone = set()
    for row in sorted(names):
        if any(x not in gone for x in near.get(row, ())):
            gone.add(row)
    return {(g, names[g, p]) for g, p in gone}


@pytest.mark.parametrize("peel,block", [(0, 7), (0, 1), (1, 40), (3, 500_000), (0, 500_000)])
def test_greedy_by_blocks_equals_the_rule(spark, peel, block):
    rnd = random.Random(block + peel)
    pairs = []
    for g, n, m in (("a", 60, 150), ("b", 40, 40), ("c", 5, 3)):
        found = {tuple(sorted(rnd.sample(range(n), 2))) for _ in range(m)}
        if g == "b":
            found |= {(i, i + 1) for i in range(n - 1)} | {(0, i) for i in range(1, n, 3)}
        pairs += [(g, -a * 3, -b * 3, a, b) for a, b in found]
    df = spark.createDataFrame(pairs, "group string, a long, b long, pa long, pb long")
    got = dedup.greedy_removed(df, peel, block)
    assert {tuple(r) for r in got.collect()} == brute_removed(pairs) and got.count() == len(brute_removed(pairs))
    assert dedup.greedy_removed(df.limit(0), peel, block).count() == 0


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """100,000 rows, each near the one before: every other one goes, after the peeled rounds and four blocks."""
    n, writes, real = 100_000, [], dedup.cut
    monkeypatch.setattr(dedup, "cut", lambda df: writes.append(1) or real(df))
    i = F.col("id")
    chain = spark.range(n - 1).select(F.lit("a").alias("group"), i.alias("a"), (i + 1).alias("b"), i.alias("pa"), (i + 1).alias("pb"))
    got = dedup.greedy_removed(chain, block_pairs=25_000)
    assert got.count() == n // 2 and got.where("h % 2 = 0").isEmpty() and got.select("h").distinct().count() == n // 2
    assert len(writes) < 20


@pytest.mark.parametrize("keys", [["g"], ["g", "h"], []])
def test_ranks_need_one_shuffle_of_the_rows(spark, keys):
    rnd = random.Random(len(keys))
    data = [(rnd.choice(["hot", "hot", "hot", "a", None]), rnd.choice([1, None]), rnd.choice([None, *range(40)]), i, "x") for i in range(3000)]
    df = spark.createDataFrame(data, "g string, h int, v int, id long, _x string").repartition(8)
    out = ranking.rank_by_order(df, keys, ["v", F.col("id")], "place")
    got = {r["id"]: r["place"] for r in out.collect()}
    seen, want = {}, {}
    for g, h, v, i, _ in sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[3])):
        key = tuple({"g": g, "h": h}[k] for k in keys)
        want[i] = seen[key] = seen.get(key, 0) + 1
    assert got == want and set(out.columns) == {*df.columns, "place"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert ranking.rank_by_order(df.limit(0), keys, ["v"], "place").count() == 0
