"""Lines that repeat an earlier line up to a few edits: a segment-partition edit join in DataFrame functions.

Every line is cut into ``edits + 1`` segments, so a line within ``edits`` edits keeps one of them whole. A
line looks up the segments of lines up to ``edits`` shorter, at the few places a kept segment can have moved
to; what meets is verified with a banded bit-parallel edit distance.

The project has no texts of lines; the operator is general and takes any frame with an id (``path``) and a text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.lineage import broadcast_if_small, stored
from labelops.llm.components import components

EDITS = 2
#: Lines from this length on may be EDITS apart, those from SHORT_CHARS on one edit; a few edits turn any shorter line into
#: another, so these hang together with their exact copies alone. Of two lines the shorter one decides.
MIN_CHARS = 25
SHORT_CHARS = 12
#: Lines that share a key and meet in one task; those of a key with more are dealt in slices.
CROWD, SLICE = 32, 500
#: Fixed value: letters whose counts a line's signature holds, common ones in European languages.
LETTERS = "etaoinsrhldcumgb"


def _lines(items: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    split = items.select(F.col(id_col).alias("path"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    return split.filter(F.length("line") >= min_chars).withColumn("line_id", F.unhex(F.md5("line")))


def _tolerance(chars: Column, edits: int) -> Column:
    """Edits that a line and one at least as long may be apart."""
    return F.when(chars >= MIN_CHARS, F.lit(edits)).when(chars >= SHORT_CHARS, F.lit(min(1, edits))).otherwise(F.lit(0))


def _keys(points: Column, chars: Column, long: Column, edits: int) -> Column:
    """Keys a line is looked up by, of its ``_segment_keys`` for all edits; the first, one more than its tolerance, are also those it is found under."""
    few = min(1, edits)
    short = _segment_keys(points, chars, few)
    # a line just long enough also looks up short ones by theirs
    reach = (chars >= MIN_CHARS) & (chars < MIN_CHARS + few)
    keys = F.when(reach, F.concat(long, short)).when(chars >= MIN_CHARS, long).when(chars >= SHORT_CHARS, short)
    return keys.otherwise(F.array().cast("array<bigint>"))


def _with_keys(rows: DataFrame, edits: int) -> DataFrame:
    """The lines with ``chars`` and ``keys``; what keys share is worked out once, which Spark does in a column of its own but not below a condition.

    Segments are cut from four bytes a character: a place in text is found by walking there from its start, for each key anew.
    """
    points, chars = F.col("_points"), F.col("chars")
    measured = rows.withColumn("chars", F.length("line")).withColumn("_points", F.encode("line", "UTF-32")).withColumn("_long", _segment_keys(points, chars, edits))
    return measured.withColumn("keys", _keys(points, chars, F.col("_long"), edits)).drop("_points", "_long")


def _segment_keys(points: Column, chars: Column, edits: int) -> Column:
    """Keys of segments and of where they can have moved to; few operations each, as code over 8,000 bytes a method is not compiled by the JVM.

    Those of lines too short for ``edits`` may reach over an end; what meets is verified.
    """
    own, probes = [], []
    for shorter in range(edits + 1):
        length = chars - shorter
        cuts = [F.lit(0), *[F.floor(length * n / (edits + 1)).cast("int") for n in range(1, edits + 1)], length]
        for n in range(edits + 1):
            size = cuts[n + 1] - cuts[n] if n else cuts[1]
            for move in range(max(-n, shorter - (edits - n)), min(n, shorter + edits - n) + 1):
                key = F.xxhash64(F.lit(n), length, F.substring(points, (cuts[n] + move) * 4 + 1, size * 4))
                (own if shorter == move == 0 else probes).append(key)
    return F.array(*own, *probes)


def _signature(line: Column) -> Column:
    """Letter counts modulo 4, each in a two-bit Gray code: one edit changes two counts by one, so at most two bits."""
    total = F.lit(0).cast("long")
    for i, letter in enumerate(LETTERS):
        count = (F.length(line) - F.length(F.replace(line, F.lit(letter), F.lit("")))).cast("long").bitwiseAND(F.lit(3))
        total = total + F.shiftleft(count.bitwiseXOR(F.shiftright(count, 1)), 2 * i)
    return total


def _may_be_near(sx: Column, sy: Column, cx: Column, cy: Column, edits: int) -> Column:
    """False only for two lines whose letter counts and lengths are too far apart for their tolerance."""
    return F.bit_count(sx.bitwiseXOR(sy)) <= 2 * _tolerance(F.least(cx, cy), edits) - F.abs(cx - cy)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """True if two texts are at most ``edits`` insertions, deletions or replacements apart.

    Column by column of the band |i - j| <= edits, one word of 2 * edits + 1 bits per number of edits holds the
    diagonals that can be reached with it; matches, replacements, insertions and deletions are and, or and shifts.
    """
    band, full = 2 * edits + 1, (1 << (2 * edits + 1)) - 1
    long = lambda v: F.lit(v).cast("long")
    chars = lambda x: F.filter(F.split(x, ""), lambda c: c != "")

    def matches(pattern: Column, char: Column, j: Column) -> Column:
        bits = [F.when(F.get(pattern, j + (d - edits)).eqNullSafe(char), long(1 << d)).otherwise(long(0)) for d in range(band)]
        return sum(bits[1:], bits[0])

    def step(state: Column, match: Column) -> Column:
        new = [state["r0"].bitwiseAND(match)]
        for e in range(1, edits + 1):
            before = state[f"r{e - 1}"]
            moved = before.bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(new[-1], 1))
            new.append(state[f"r{e}"].bitwiseAND(match).bitwiseOR(moved).bitwiseAND(long(full)))
        return F.struct(*[r.alias(f"r{e}") for e, r in enumerate(new)])

    start = F.struct(*[long(((1 << (e + 1)) - 1) << edits).alias(f"r{e}") for e in range(edits + 1)])
    columns = F.transform(F.array(F.struct(chars(a).alias("p"), chars(b).alias("t"))), lambda x: F.transform(x["t"], lambda c, j: matches(x["p"], c, j)))[0]
    end = F.aggregate(columns, start, step)[f"r{edits}"]
    apart = F.length(a) - F.length(b)
    hit = F.getbit(end, F.greatest(F.lit(0), F.least(F.lit(2 * edits), apart + edits))) == 1
    return F.when(F.abs(apart) > edits, False).otherwise(F.coalesce(hit, F.lit(False)))


def _texts(docs: DataFrame, lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, line_id, line, sign) of wanted short ids; a line is read at its first place alone, however many copies it has."""
    places = lines.select("line_id", "first", F.xxhash64("line_id").alias("h")).join(wanted, "h", "left_semi").withColumnRenamed("line_id", "_id")
    # few lines meet another, so as a rule their places are handed to the lines where they lie, and only texts with such a place are split
    found = stored(places)
    places = broadcast_if_small(found)
    held = docs if places is found else docs.join(places.select(F.col("first.path").alias("_path")), F.col("path").eqNullSafe(F.col("_path")), "left_semi")
    rows = _lines(held, "path", "text", 0)
    there = (rows["line_id"] == places["_id"]) & rows["path"].eqNullSafe(places["first.path"]) & (rows["line_no"] == places["first.line_no"])
    # signed before copies go: what letters share is worked out once there, but not on top of a grouping
    return rows.join(places, there).select("h", "line_id", "line", _signature(F.col("line")).alias("sign")).distinct()


def _candidates(docs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """(x, y) short ids of different lines that share a key, x < y.

    A key of many lines (a common part of counters or dates) is not one task's: its lines are dealt in slices on both sides, slices meet
    two by two, and only pairs whose letter counts allow it leave the join.
    """
    narrow = lines.select(F.xxhash64("line_id").alias("h"), "keys", "chars")
    found = narrow.select(F.explode(F.slice("keys", F.lit(1), _tolerance(F.col("chars"), edits) + 1)).alias("key"), F.col("h").alias("x"), F.col("chars").alias("cx"))
    looked = narrow.select(F.explode("keys").alias("key"), F.col("h").alias("y"), F.col("chars").alias("cy"))
    once = (F.col("x") != F.col("y")) & ((F.col("cx") < F.col("cy")) | (F.col("x") < F.col("y")))
    crowded = stored(found.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") > CROWD))
    ordered = lambda met: met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    if crowded.isEmpty():
        return ordered(found.join(looked, "key").filter(once)).distinct()
    few = broadcast_if_small(crowded)
    pairs = ordered(found.join(few, "key", "left_anti").join(looked, "key").filter(once))
    found, looked = stored(found.join(few, "key")), stored(looked.join(few.select("key"), "key"))
    busy = looked.groupBy("key").agg(F.count(F.lit(1)).alias("others"))
    signs = stored(_texts(docs, lines, found.select(F.col("x").alias("h")).union(looked.select(F.col("y").alias("h"))).distinct()).select("h", "sign"))
    sizes = stored(crowded.join(busy, "key").select("key", F.ceil(F.col("lines") / SLICE).cast("int").alias("n"), F.ceil(F.col("others") / SLICE).cast("int").alias("m")))
    sizes = broadcast_if_small(sizes)
    found = found.join(signs.select(F.col("h").alias("x"), F.col("sign").alias("sx")), "x").join(sizes, "key").withColumn("i", F.pmod(F.xxhash64("x"), F.col("n")).cast("int"))
    looked = looked.join(signs.select(F.col("h").alias("y"), F.col("sign").alias("sy")), "y").join(sizes, "key").withColumn("j", F.pmod(F.xxhash64("y"), F.col("m")).cast("int"))
    found = found.select("key", "x", "cx", "sx", "i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
    looked = looked.select("key", "y", "cy", "sy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), "j")
    near = _may_be_near(F.col("sx"), F.col("sy"), F.col("cx"), F.col("cy"), edits)
    return pairs.unionByName(ordered(found.join(looked, ["key", "i", "j"]).filter(once & near))).distinct()


def line_links(items: DataFrame, id_col: str = "path", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line of at least ``min_chars`` code points (0: every line), with the class of lines it hangs together with.

    ``id_col``, ``line_no`` (from 0, lines end at ``\\n``), ``first_<id_col>`` and ``first_line_no`` (the place of the
    first line of its class, by id, then number), ``n_links`` (different lines within ``edits`` edits, fewer for lines
    under MIN_CHARS; exact copies are one line) and ``kept`` (true for the first place of a class). NULL texts have no lines; rows with a NULL id
    come first; a repeated row repeats its lines, and all of them carry the flags of their place.
    """
    docs = items.select(F.col(id_col).alias("path"), F.col(text_col).alias("text"))
    rows = _lines(docs, "path", "text", min_chars)
    first = F.min(F.struct("path", "line_no"))
    lines = stored(
        _with_keys(rows, edits).select("line_id", "path", "line_no", "keys", "chars")
        .groupBy("line_id").agg(first.alias("first"), F.first("keys").alias("keys"), F.first("chars").alias("chars"))
    )
    pairs = stored(_candidates(docs, lines, edits))
    wanted = pairs.select(F.col("x").alias("h")).union(pairs.select(F.col("y").alias("h"))).distinct()
    texts = stored(_texts(docs, lines, wanted))
    left = texts.select(F.col("h").alias("x"), F.col("line_id").alias("a"), F.col("line").alias("line_a"), F.col("sign").alias("sx"))
    right = texts.select(F.col("h").alias("y"), F.col("line_id").alias("b"), F.col("line").alias("line_b"), F.col("sign").alias("sy"))
    a, b = F.col("line_a"), F.col("line_b")
    near = F.when(F.least(F.length(a), F.length(b)) >= MIN_CHARS, within_edits(a, b, edits)).otherwise(within_edits(a, b, min(1, edits)))
    likely = _may_be_near(F.col("sx"), F.col("sy"), F.length(a), F.length(b), edits)
    links = pairs.join(left, "x").join(right, "y").filter(likely & near).select("a", "b")
    links = stored(links.distinct())
    degree = links.select(F.col("a").alias("line_id")).union(links.select("b")).groupBy("line_id").agg(F.count(F.lit(1)).alias("n_links"))
    roots = components(links).withColumnsRenamed({"node": "line_id"})
    classes = lines.select("line_id", "first").join(roots, "line_id", "left").withColumn("root", F.coalesce("root", "line_id"))
    firsts = classes.filter(F.col("root") != F.col("line_id")).groupBy("root").agg(F.min("first").alias("other"))
    # most lines hang on nothing: only roots with others below them change their place
    own = classes.filter(F.col("root") == F.col("line_id")).join(firsts, "root", "left").select("root", F.least("first", "other").alias("first"))
    linked = classes.filter(F.col("root") != F.col("line_id")).select("line_id", "root").join(own, "root").select("line_id", "first")
    placed = own.select(F.col("root").alias("line_id"), "first").unionByName(linked).join(degree, "line_id", "left")
    return rows.select("path", "line_no", "line_id").join(placed, "line_id").select(
        F.col("path").alias(id_col), "line_no", F.col("first.path").alias(f"first_{id_col}"), F.col("first.line_no").alias("first_line_no"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.struct("path", "line_no").eqNullSafe(F.col("first"))).alias("kept"),
    )


def drop_repeated_lines(items: DataFrame, id_col: str = "path", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The items, all columns and rows, without the lines whose class has an earlier place (see ``line_links``).

    Blank lines stay. A text all of whose lines go becomes empty; NULL stays NULL. Ids have to tell the rows apart; rows that share
    an id lose the lines that either of them has to lose.
    """
    gone = line_links(items, id_col, text_col, edits, min_chars).filter(~F.col("kept")).groupBy(id_col).agg(F.collect_set("line_no").alias("_gone"))
    gone = gone.withColumnRenamed(id_col, "gone_id")
    # the row travels as one value, so that none of its columns can clash with those added here
    whole = items.select(F.struct("*").alias("row"), F.col(id_col).alias("row_id"), F.col(text_col).alias("body"))
    left = F.filter(F.split("body", "\n"), lambda x, i: ~(F.array_contains("_gone", i) & x.rlike(r"[^\x20\x09-\x0D]")))
    text = F.when(F.col("_gone").isNull(), F.col("body")).otherwise(F.array_join(left, "\n"))
    joined = whole.join(gone, F.col("row_id").eqNullSafe(F.col("gone_id")), "left")
    return joined.select(F.col("row").withField(text_col, text).alias("row")).select("row.*")
