"""Quality rules and cross-document line frequency, in DataFrame functions only.

The project has no texts of lines or hosts; the operator is general and takes any frame with an id (``path``), a host and a text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.llm import text

#: A line in more documents of one host than this goes.
MAX_DOCS = 100
#: Share of its words a document must keep.
KEEP_SHARE = 0.5
MIN_WORDS = 50
#: Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Up to so many repeated windows are looked up one by one, more by sorting; both find the same.
FEW = 64


def _words(body: Column) -> Column:
    return F.filter(F.split(body, text.SPACE + "+"), lambda w: w != "")


def _repeated(windows: Column, sorted_windows: Column) -> Column:
    """Words that lie in a three-word window found twice or more; windows are hashes in text order."""
    twice = F.array_distinct(F.filter(sorted_windows, lambda x, i: x == F.get(sorted_windows, i - 1)))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(places, start, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")))["n"]

    def looked_up(found: Column) -> Column:
        marked = F.transform(windows, lambda x, i: F.when(F.array_contains(found, x), i))
        return F.filter(marked, lambda p: p.isNotNull())

    def sorted_places() -> Column:
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        paired = F.transform(F.array(placed), lambda p: F.filter(p, lambda s, i: (s["x"] == F.get(p, i - 1)["x"]) | (s["x"] == F.get(p, i + 1)["x"])))
        return F.sort_array(F.transform(paired[0], lambda s: s["i"]))

    # a value that a lambda uses for each element is bound by a one-element array, so that it is worked out once
    counted = F.transform(F.array(twice), lambda t: F.when(F.size(t) == 0, F.lit(0)).when(F.size(t) <= FEW, covered(looked_up(t))).otherwise(covered(sorted_places())))
    return counted[0]


def _base(items: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = items.select(F.col(id_col).alias("path"), _host(host_col).alias("host"), F.col(text_col).alias("whole"), body.alias("body"))
    rows = rows.withColumn("words", _words(F.col("body"))).withColumn("lines", _lines(F.col("body")))
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    rows = rows.withColumn("windows", F.when(n >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("sorted", F.sort_array("windows"))
    return rows.select(
        "path", "host", "whole",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("windows"), F.col("sorted")).cast("long").alias("n_repeat_words"),
    )


def normalised(line: Column) -> Column:
    """A line in lower case with white space as one space and digits as zeros."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, text.SPACE + "+", " ")), "[0-9]", "0"))


def _lines(body: Column) -> Column:
    return F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit("\x00"))


def _frequent(items: DataFrame, id_col: str, host_col: str, text_col: str, max_docs: int) -> DataFrame:
    """(path, host, line, n): the lines of each document that too many share, as hashes, and their words."""
    hashed = F.transform(_lines(F.col(text_col)), lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.size(_words(x)).alias("n")))
    rows = items.select(F.col(id_col).alias("path"), _host(host_col).alias("host"), F.inline(hashed))
    rows = rows.groupBy("path", "host", "line").agg(F.sum("n").alias("n"))
    frequent = rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > max_docs).select("host", "line")
    return rows.join(frequent, ["host", "line"], "left_semi")


def frequent_words(items: DataFrame, id_col: str = "path", host_col: str = "source", text_col: str = "text", max_docs: int = MAX_DOCS) -> DataFrame:
    """``id_col`` and ``removed``: words of its lines that more than ``max_docs`` documents of its host share.

    Each document counts once for a line. A NULL host is a host of its own; documents without such lines are not listed.
    """
    removed = _frequent(items, id_col, host_col, text_col, max_docs).groupBy("path").agg(F.sum("n").alias("removed"))
    return removed.withColumnRenamed("path", id_col)


def quality(
    items: DataFrame, id_col: str = "path", host_col: str = "source", text_col: str = "text", max_docs: int = MAX_DOCS, keep_share: float = KEEP_SHARE
) -> DataFrame:
    """One row per document: ``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed, and
    ``text_col`` without the lines removed (NULL stays NULL).

    Words are cut at ASCII white space; a document fails the base rules with fewer than 50 words, or with over
    half of its words in three-word windows that it repeats. Else it is kept if at least ``keep_share`` of its words
    remain once lines shared by more than ``max_docs`` documents of its host are removed. NULL and empty texts have no
    words and fail. Ids have to tell documents apart: rows with one id and host count once for a line.
    """
    base = _base(items, id_col, host_col, text_col)
    gone = _frequent(items, id_col, host_col, text_col, max_docs).groupBy("path", "host").agg(F.collect_set("line").alias("gone"))
    gone = gone.withColumnsRenamed({"path": "_path", "host": "_host"})
    joined = base.join(gone, base["path"].eqNullSafe(gone["_path"]) & (base["host"] == gone["_host"]), "left")
    stay = F.filter(F.split("whole", "\n"), lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains("gone", F.xxhash64(normalised(x)))))
    joined = joined.withColumn("left", F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.array_join(stay, "\n")))
    joined = joined.withColumn("n_removed", F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.col("n_words") - F.size(_words(F.col("left")))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stays = F.col("n_words") - F.col("n_removed") >= F.lit(keep_share) * F.col("n_words")
    return joined.select(
        F.col("path").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & stays).alias("kept"), F.col("n_removed").cast("long").alias("n_removed"),
        F.col("left").alias(text_col),
    )
