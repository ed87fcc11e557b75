"""Leak, alignment, policy and snapshot checks. Each returns a small frame of findings."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.constants import SPLITS
from labelops.lineage import cut, join_on, literal_rows
from labelops.operators.ranking import first_rows


def name_key() -> Column:
    return F.concat(F.col("class"), F.lit("/"), F.col("file_name"))


def split_overlap(df: DataFrame, key: Column, check: str) -> DataFrame:
    """Keys seen in two splits, per pair of splits, and keys repeated inside one (left = right).

    One pre-aggregated shuffle on the key; no self join."""
    per_key = df.select(key.alias("_key"), "split").groupBy("_key").agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    )
    found = [(s, s, F.col(s) > 1) for s in SPLITS]
    found += [(a, b, (F.col(a) > 0) & (F.col(b) > 0)) for a, b in combinations(SPLITS, 2)]
    counts = per_key.agg(
        *[x for i, (_, _, hit) in enumerate(found)
          for x in (F.count_if(hit).alias(f"n{i}"), F.min(F.when(hit, F.col("_key"))).alias(f"e{i}"))]
    )
    rows = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(a).alias("left_split"), F.lit(b).alias("right_split"),
                 F.col(f"n{i}").alias("shared_keys"), F.col(f"e{i}").alias("example"))
        for i, (a, b, _) in enumerate(found)
    ])
    return counts.select(F.inline(rows))


def leak_report(df: DataFrame) -> DataFrame:
    """Overlap by class/file name and by content."""
    return split_overlap(df, name_key(), "name").unionByName(split_overlap(df, F.col("content_hash"), "content"))


def class_alignment(df: DataFrame) -> DataFrame:
    """Per class, its rows in each split and the splits that miss it."""
    counts = df.groupBy("class").agg(*[F.count_if(F.col("split") == s).alias(s) for s in SPLITS])
    missing = F.array_compact(F.array(*[F.when(F.col(s) == 0, F.lit(s)) for s in SPLITS]))
    return counts.withColumn("missing_in", F.array_join(missing, ",")).withColumn("aligned", F.size(missing) == 0)


def class_policy(df: DataFrame, required: Sequence[str], forbidden: Sequence[str], col: str = "class") -> DataFrame:
    """Broken rules: (rule, class) with missing_required or forbidden_present."""
    present = df.select(F.col(col).alias("class")).distinct()
    bad = present.where(F.col("class").isin(list(forbidden))).select(F.lit("forbidden_present").alias("rule"), "class")
    if not required:
        return bad
    wanted = literal_rows(df.sparkSession, ["class"], [(c,) for c in required])
    absent = join_on(wanted, present, ["class"], "left_anti")
    return bad.unionByName(absent.select(F.lit("missing_required").alias("rule"), "class"))


def class_diff(a: DataFrame, b: DataFrame, col: str = "class") -> DataFrame:
    """Classes present on one side only."""
    left, right = a.select(col).distinct(), b.select(col).distinct()
    return (
        left.exceptAll(right).withColumn("side", F.lit("left_only"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right_only")))
    )


def name_sets(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct names tagged both, left_only or right_only: one union and one aggregate."""
    tagged = a.select(*cols, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        b.select(*cols, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    side = F.when((F.col("l") > 0) & (F.col("r") > 0), "both").when(F.col("l") > 0, "left_only").otherwise("right_only")
    return tagged.groupBy(*cols).agg(F.max("l").alias("l"), F.max("r").alias("r")).select(*cols, side.alias("side"))


def check_class_order(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The class-order list against every split: position in the list and by name, counts per split.

    ``ok`` needs the same position in the list and in the data and at least one row per split."""
    order = literal_rows(df.sparkSession, ["listed_at", "class"], list(enumerate(names)))
    counts = df.groupBy("class").agg(*[F.count_if(F.col("split") == s).alias(s) for s in SPLITS])
    found = class_index(df).withColumnRenamed("label", "found_at")
    present = join_on(found, counts, ["class"])
    both = order.join(present, "class", "full_outer")
    ok = F.col("listed_at").eqNullSafe(F.col("found_at"))
    for s in SPLITS:
        ok = ok & (F.coalesce(s, F.lit(0)) > 0)
    return both.select(
        "class", "listed_at", "found_at", *[F.coalesce(s, F.lit(0)).alias(s) for s in SPLITS], ok.alias("ok")
    )


def class_index(df: DataFrame, col: str = "class") -> DataFrame:
    """Class -> label by case-insensitive name order. Runs on the class list, not on the rows."""
    names = df.select(F.col(col).alias("class")).distinct()
    place = F.row_number().over(Window.orderBy(F.lower("class"), F.col("class"))) - 1
    return names.withColumn("label", place.cast("int"))


def score_violations(df: DataFrame, k: int, col: str = "probs") -> DataFrame:
    """One row: vectors checked and vectors whose length is not k."""
    return df.agg(
        F.count(F.lit(1)).alias("vectors"),
        F.count_if(~F.coalesce(F.size(col) == k, F.lit(False))).alias("wrong_length"),
    )


def small_classes(df: DataFrame, minimum: int = 10, accepted: str = "accepted") -> DataFrame:
    """Classes with fewer accepted rows than the minimum; ``empty`` marks those with none."""
    kept = df.groupBy("class").agg(F.count_if(F.col(accepted)).alias("accepted_rows"))
    return kept.where(F.col("accepted_rows") < minimum).withColumn("empty", F.col("accepted_rows") == 0)


def snapshot(
    df: DataFrame, path: str = "path", group: str = "class", length: str = "length", stamp: Column | None = None
) -> DataFrame:
    """One row: classes, files, bytes and a digest of all (path, size, time) lines.

    The digest must not collect or sort the listing, so line hashes are added up: four 60-bit lanes of
    each line's SHA-256, summed exactly. Sums merge map-side and do not depend on the row order."""
    sums = _line_sums(df.select("*", F.col(group).alias("_group")), ["_group"], path, length, stamp)
    total = sums.agg(
        F.count(F.lit(1)).alias("class_count"), F.sum("files").alias("file_count"), F.sum("bytes").alias("total_bytes"), *_lane_sums(),
    )
    return total.select("class_count", "file_count", "total_bytes", _lane_digest().alias("digest"))


LANES = [f"_s{i}" for i in range(4)]


def _line_sums(df: DataFrame, keys: Sequence[str], path: str, length: str, stamp: Column | None) -> DataFrame:
    """(keys, files, bytes, lanes) of the (path, size, time) lines."""
    stamp = F.unix_micros("mtime") if stamp is None else stamp
    line = F.concat_ws("|", F.lit("F"), F.col(path), F.col(length).cast("string"), stamp.cast("string"))
    hashed = df.select(*keys, F.col(length).alias("_len"), F.sha2(line, 256).alias("_h"))
    lanes = [F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    return hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("_len").alias("bytes"), *[F.sum(lane).alias(s) for s, lane in zip(LANES, lanes)]
    )


def _lane_sums() -> list[Column]:
    return [F.sum(s).cast("decimal(38,0)").alias(s) for s in LANES]


def _lane_digest() -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(s).cast("string") for s in LANES]), 256)


def path_range(path: str = "path", group: str = "class", digits: int = 2) -> Column:
    """The range a file belongs to: its class and the leading hex digits of its path's SHA-256, 16**digits even ranges a class."""
    return F.concat(F.coalesce(F.col(group), F.lit("")), F.lit("/"), F.substring(F.sha2(F.col(path).cast("string").cast("binary"), 256), 1, digits))


def snapshot_tree(
    df: DataFrame, path: str = "path", group: str = "class", length: str = "length", stamp: Column | None = None, digits: int = 2
) -> DataFrame:
    """A tree of digests over a listing: (level, range, parent, files, bytes, digest).

    Level 0 is the whole listing (range empty), level 1 a class, level 2 a range of a class (``path_range``). A node's sums are
    those of its children, so the tree costs one aggregate over the listing and two over its ranges. Two
    trees of the same ``digits`` are compared by ``changed_ranges``."""
    keyed = df.withColumns({"_class": F.coalesce(F.col(group), F.lit("")), "_range": path_range(path, group, digits)})
    leaves = _line_sums(keyed, ["_class", "_range"], path, length, stamp)
    level = lambda n, name, parent: [F.lit(n).alias("level"), name.alias("range"), parent.alias("parent"), "files", "bytes", _lane_digest().alias("digest")]
    totals = [F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), *_lane_sums()]
    classes = leaves.groupBy("_class").agg(*totals)
    none = F.lit(None).cast("string")
    return (
        leaves.select(level(2, F.col("_range"), F.col("_class")))
        .unionByName(classes.select(level(1, F.col("_class"), F.lit(""))))
        .unionByName(leaves.agg(*totals).where(F.col("files").isNotNull()).select(level(0, F.lit(""), none)))
    )


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nodes of two snapshot trees that differ: (level, range, files_before, files_after, bytes_before, bytes_after).

    A side that has no such node counts 0 files."""
    sides = [
        t.select("level", "range", F.lit(tag).alias("_side"), "files", "bytes", "digest") for tag, t in (("b", before), ("a", after))
    ]
    pick = lambda tag, c: F.max(F.when(F.col("_side") == tag, F.col(c)))
    both = sides[0].unionByName(sides[1]).groupBy("level", "range").agg(
        *[F.coalesce(pick(t, c), F.lit(0).cast("long")).alias(f"{c}_{name}") for c in ("files", "bytes") for t, name in (("b", "before"), ("a", "after"))],
        pick("b", "digest").alias("_b"), pick("a", "digest").alias("_a"),
    )
    return both.where(~F.col("_b").eqNullSafe(F.col("_a"))).drop("_a", "_b")


#: Changed ranges up to this number are handed to the scan as a list, which a sorted listing can skip by.
LISTED_RANGES = 1000


def write_listing(df: DataFrame, folder: str, path: str = "path", group: str = "class", digits: int = 2, mode: str = "errorifexists") -> None:
    """Keep a listing for later comparison, ordered by range, so that a comparison reads only the ranges that changed."""
    ranged = df.withColumn("_range", path_range(path, group, digits))
    ranged.repartitionByRange("_range").sortWithinPartitions("_range").write.mode(mode).parquet(folder)


def changed_files(
    before: DataFrame, after: DataFrame, ranges: DataFrame, path: str = "path", group: str = "class", length: str = "length",
    stamp: Column | None = None, digits: int = 2,
) -> DataFrame:
    """(path, class, change) of the files in changed ranges: added, removed or changed (size or time).

    ``ranges`` is the result of ``changed_ranges``. Only the files of its level-2 ranges are compared; a listing kept by
    ``write_listing`` is read there alone."""
    stamp = F.unix_micros("mtime") if stamp is None else stamp
    wanted = cut(ranges.where("level = 2").select("range"))
    few = [r["range"] for r in wanted.limit(LISTED_RANGES + 1).collect()]

    def side(df: DataFrame, sign: int) -> DataFrame:
        own = F.col("_range") if "_range" in df.columns else path_range(path, group, digits)
        rows = df.withColumn("_range", own)
        rows = rows.where(F.col("_range").isin(few)) if len(few) <= LISTED_RANGES else rows.join(wanted.withColumnRenamed("range", "_range"), "_range", "left_semi")
        line = F.struct(F.col(length).alias("length"), stamp.alias("stamp"))
        return rows.select(F.col(path).alias("path"), F.col(group).alias("class"), line.alias("_line"), F.lit(sign).alias("_sign"))

    both = side(before, -1).unionByName(side(after, 1))
    at = lambda sign: F.sort_array(F.collect_list(F.when(F.col("_sign") == sign, F.col("_line"))))
    found = both.groupBy("path", "class").agg(at(-1).alias("_old"), at(1).alias("_new")).where(F.col("_old") != F.col("_new"))
    change = F.when(F.size("_old") == 0, "added").when(F.size("_new") == 0, "removed").otherwise("changed")
    return found.select("path", "class", change.alias("change"))


def require_same_files(before: DataFrame, after: DataFrame, named: int = 20) -> None:
    """Raise when two listings differ, naming the ranges and up to ``named`` files."""
    ranges = cut(changed_ranges(snapshot_tree(before), snapshot_tree(after)))
    if ranges.isEmpty():
        return
    files = changed_files(before, after, ranges)
    listed = [f"{r['change']} {r['path']}" for r in files.orderBy("path").limit(named).collect()]
    count = ranges.where("level = 2").count()
    raise ValueError(f"source changed in {count} ranges: {', '.join(listed)}{' and more' if len(listed) == named else ''}")


def assert_unchanged(before: DataFrame, after: DataFrame) -> None:
    """Raise when two one-row snapshots differ."""
    old, new = before.first(), after.first()
    if old != new:
        raise ValueError(f"source changed: before={old}, after={new}")


def reconcile(plan: DataFrame, written: DataFrame, keys: Sequence[str] = ("split", "class", "file_name")) -> DataFrame:
    """Keys that were planned more often than written (not_written), or written more often than planned."""
    tagged = plan.select(*keys, F.lit(1).alias("_n")).unionByName(written.select(*keys, F.lit(-1).alias("_n")))
    counts = tagged.groupBy(*keys).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return counts.select(*keys, F.when(F.col("_n") > 0, "not_written").otherwise("not_planned").alias("side"))


def preview(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 30) -> DataFrame:
    """At most n example rows per group."""
    return first_rows(df, keys, order, n)


def validation_summary(
    df: DataFrame, required: Sequence[str] = (), forbidden: Sequence[str] = (), has_hash: bool = True
) -> DataFrame:
    """One row of counts and booleans over all checks of one split dataset."""
    leaks = (leak_report(df) if has_hash else split_overlap(df, name_key(), "name")).agg(
        F.coalesce(F.sum(F.when(F.col("left_split") != F.col("right_split"), F.col("shared_keys"))), F.lit(0)).alias("leaked_keys"),
        F.coalesce(F.sum(F.when(F.col("left_split") == F.col("right_split"), F.col("shared_keys"))), F.lit(0)).alias("repeated_keys"),
    )
    aligned = class_alignment(df).agg(
        F.count(F.lit(1)).alias("class_count"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(f"{s}_rows") for s in SPLITS],
        F.count_if(~F.col("aligned")).alias("misaligned_classes"),
    )
    policy = class_policy(df, required, forbidden).agg(
        F.count_if(F.col("rule") == "forbidden_present").alias("forbidden_present"),
        F.count_if(F.col("rule") == "missing_required").alias("missing_required"),
    )
    parts = aligned.unionByName(leaks, True).unionByName(policy, True)
    row = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    bad = F.col("leaked_keys") + F.col("repeated_keys") + F.col("misaligned_classes")
    bad = bad + F.col("forbidden_present") + F.col("missing_required")
    return row.withColumn("valid", (bad == 0) & (F.col("class_count") > 0))
