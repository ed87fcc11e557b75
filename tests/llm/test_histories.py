"""Prefix trie and sequence helpers against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from labelops.llm import prefix_trie, sequences

SF = "/root/testdata/sf0.001"


def brute_trie(histories):
    """{run: [(role, text), ...]} -> {(run, depth): columns}."""
    members = {}
    for run, rows in histories.items():
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(run)
    nodes = {p: {"run": min(m), "depth": len(p), "n_runs": len(m), "ends": sorted(r for r in m if len(histories[r]) == len(p))} for p, m in members.items()}
    for p, v in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        v["parent_run"] = nodes[p[:-1]]["run"] if p else None
        v["n_children"] = sum(len(q) == len(p) + 1 for q in below)
        v["n_leaves"] = sum(all(len(x) <= len(q) or x[: len(q)] != q for x in nodes) for q in below)
        v["saved_chars"] = sum((nodes[q]["n_runs"] - 1) * (len(q[-1][1]) if q else 0) for q in below)
    return {(v["run"], v["depth"]): v for v in nodes.values()}


def random_histories(seed, n=60):
    rnd = random.Random(seed)
    found = {}
    for run in range(n):
        if run and rnd.random() < 0.7:
            other = found[rnd.choice(list(found))]
            start = other[: rnd.randint(0, len(other))]
        else:
            start = []
        found[run] = start + [(rnd.choice(["stage1", "stage2", ""]), rnd.choice(["", "loss", "é" * 3, "ab"])) for _ in range(rnd.randint(0, 5))]
    return found


def epochs_of(spark, histories):
    rows = [(run, e, r, t, 1, "x", 2) for run, h in histories.items() for e, (r, t) in enumerate(h)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "run long, epoch int, stage string, value string, depth int, k1 string, pos int")


@pytest.mark.parametrize("block,stretch", [(4, 4096), (2, 1), (1, 2), (8, 4096)])
def test_trie_of_histories(spark, block, stretch, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    histories = random_histories(block)
    runs = spark.createDataFrame([(r,) for r in histories], "run long")
    nodes, ends = prefix_trie.history_trie(epochs_of(spark, histories), runs, block=block)
    want = brute_trie(histories)
    got = {(r["run"], r["depth"]): r.asDict() for r in nodes.collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert {c: got[k][c] for c in v if c != "ends"} == {c: x for c, x in v.items() if c != "ends"}
    at = {(r["depth"], r["k1"], r["k2"]): k for k, r in got.items()}
    found = {}
    for r in ends.collect():
        found.setdefault(at[r["depth"], r["k1"], r["k2"]], []).append(r["run"])
    assert {k: sorted(v) for k, v in found.items()} == {k: v["ends"] for k, v in want.items() if v["ends"]}


def test_trie_of_read_histories(spark):
    """Two runs whose first stage is the same, as the history reader lists them."""
    from labelops.sources.readers import parse_history

    text = '{"stage1": {"loss": [0.9, 0.5]}, "stage2": {"loss": [%s]}}'
    epochs = parse_history(spark.createDataFrame([("a", text % "0.4, 0.3"), ("b", text % "0.6")], "run string, value string"))
    epochs = epochs.select("run", (F.col("stage_pos") * 1000 + F.col("i")).alias("epoch"), "stage", F.col("loss").cast("string").alias("value"))
    nodes, ends = prefix_trie.history_trie(epochs)
    got = sorted((r["depth"], r["run"], r["parent_run"] or "", r["n_runs"], r["n_children"], r["n_leaves"], r["saved_chars"]) for r in nodes.collect())
    assert got == [(0, "a", "", 2, 1, 2, 6), (1, "a", "a", 2, 1, 2, 6), (2, "a", "a", 2, 2, 2, 3), (3, "a", "a", 1, 1, 1, 0), (3, "b", "a", 1, 0, 1, 0), (4, "a", "a", 1, 0, 1, 0)]
    assert sorted(r["run"] for r in ends.collect()) == ["a", "b"]


def test_trie_of_odd_histories(spark):
    schema = "run long, epoch int, stage string, value string"
    nodes, ends = prefix_trie.history_trie(spark.createDataFrame([], schema))
    assert nodes.count() == 0 and ends.count() == 0
    nodes, ends = prefix_trie.history_trie(spark.createDataFrame([], schema), spark.createDataFrame([(3,), (2,), (None,)], "run long"))
    assert [(r["run"], r["depth"], r["n_runs"], r["n_leaves"]) for r in nodes.collect()] == [(2, 0, 2, 1)] and ends.count() == 2
    # NULL counts as empty, NULL order comes first, repeated rows are records, a row without a run is left out
    rows = [(1, None, None, None), (1, 0, "a", "x" * 100_000), (2, -5, "", ""), (2, 3, "a", "x" * 100_000), (2, 3, "a", "x" * 100_000), (None, 0, "a", "b")]
    nodes, _ = prefix_trie.history_trie(spark.createDataFrame(rows, schema))
    got = sorted((r["depth"], r["run"], r["n_runs"], r["saved_chars"]) for r in nodes.collect())
    assert got == [(0, 1, 2, 100_000), (1, 1, 2, 100_000), (2, 1, 2, 100_000), (3, 2, 1, 0)]


def test_hot_history(spark):
    """A third of the runs are exact copies, all share their first record."""
    histories = {i: [("s", "same")] + ([("u", "copy")] * 6 if i % 3 == 0 else [("u", f"own {i}")] * (i % 4)) for i in range(300)}
    nodes, _ = prefix_trie.history_trie(epochs_of(spark, histories))
    want = brute_trie(histories)
    got = {(r["run"], r["depth"]): r for r in nodes.collect()}
    assert set(got) == set(want)
    assert all(got[k][c] == v[c] for k, v in want.items() for c in ("n_runs", "n_children", "n_leaves", "saved_chars", "parent_run"))


def test_numbered_and_joined(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, 2, 2, 2, 2]), rnd.choice([None, 1, 5]), f"{i:04d}", "pos") for i in range(2000)]
    by_value = {r[2]: r[0] for r in rows}
    df = spark.createDataFrame(rows, "run int, epoch int, value string, other string").repartition(7)
    got = sequences.numbered(df, "run", [F.col("epoch"), F.col("value")])
    want = {}
    for run, epoch, value, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want[value] = sum(1 for v in want if by_value[v] == run)
    assert {r["value"]: r["pos"] for r in got.collect()} == want


def test_joined_sha256(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 2, 2, 2, 2, 9]), i, "v" * rnd.randint(0, 30) + "é") for i in range(3000)] + [(100 + i, 0, str(i)) for i in range(50)]
    for limit in (1_000_000, 300):
        monkeypatch.setattr(sequences, "PIECE_BYTES", limit)
        got = {r["run"]: r["sha256"] for r in sequences.joined_sha256(spark.createDataFrame(rows, "run int, at int, v string"), ["run"], ["at"], "v", ",").collect()}
        want = {k: hashlib.sha256(",".join(v for r, _, v in rows if r == k).encode()).hexdigest() for k in {r for r, _, _ in rows}}
        assert got == want


def rebuilt(rows):
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append(r)
    turns = {c: [(r["role"] or "", r["text"] or "") for r in sorted(v, key=lambda r: (r["turn"] is not None, r["turn"] or 0))] for c, v in by.items()}
    return {c: (turns.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)]) + t[h:] for c, t in turns.items()}


def check_op12(df, histories):
    want = brute_trie(histories)
    got = {(r["conv_id"], r["depth"]): r for r in df.collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        r = got[k]
        assert (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) == (v["parent_run"], v["n_runs"], v["n_children"], v["n_leaves"], v["saved_chars"])
        assert r["ends_sha256"] == hashlib.sha256(",".join(map(str, v["ends"])).encode()).hexdigest()


def test_op12_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    check_op12(driver.queries()["op12_prefix_trie"](spark, SF), rebuilt(rows))


def test_op12_query_on_odd_rows(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(c, t if t else None, rnd.choice(["user", None, "system"]), rnd.choice(["hi", None, "", "höher"]), "x") for c in (0, 1, 3, 7, 105, 106, 230, 231) for t in range(rnd.randint(1, 9))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    check_op12(driver.queries()["op12_prefix_trie"](spark, str(tmp_path)), rebuilt(table.collect()))
