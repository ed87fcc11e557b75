"""Packing token sequences into windows: non-negative least squares over shallow length combinations.

A text longer than the window first gives whole windows. What is left of it has one of ``window - 1`` lengths, so a
histogram of bounded size says all the plan needs. Lengths are rounded up to classes, every combination of up to three
classes that fills a window is listed, the repeat counts are solved against the histogram and rounded within it, what is left
over is packed greedily, best fit first, and only texts that fill no window well are laid end to end and cut where a window ends. No text passes through the driver and no row
waits for another: each works out its place from its number among texts of its length. Places are worked out on
narrow rows; at the end each text's ids meet its pieces once and are cut.

The project has no token sequences; the operator is general and takes any frame with an id (``path``) and a text column.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import stored
from labelops.llm import text

WINDOW = 2048
END_ID = 1
#: Width of a length class: what a combination may waste per piece.
WIDTH = 8
#: Left-over texts are cut at multiples of this, or inside their last tokens.
BLOCK = 64
ROUNDS = 400
#: Least share of a window that the greedy packing of residuals has to fill.
FILL = 0.97
#: Texts of one length that are numbered in one task: so many, or this share of all texts.
NUMBERED, NUMBERED_SHARE = 1_000, 0.0005
#: Fixed value: marks that often end a word; none begins a contraction.
MARKS = frozenset(".,;:!?")
#: Units a worker remembers, words with a space before them included; results do not depend on it.
CACHE_UNITS = 1_000_000
#: How byte-level vocabularies write a byte: printable ones as they are, the others from character 256 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
UNPRINTED = [b for b in range(256) if b not in PRINTED]
#: How they write a space.
SPACED = chr(256 + UNPRINTED.index(32))
BYTE_CHARS = [chr(b) if b in PRINTED else chr(256 + UNPRINTED.index(b)) for b in range(256)]


# --- tokens -------------------------------------------------------------------------------------


class UnitIds(dict):
    """Token ids (little-endian, 32-bit or as ``code`` says) of a unit of text, remembered; starts afresh when full.

    A unit is a run without a space, with the one space before it. The tokenizer's own pattern never joins
    what stands on both sides of a space that a visible character follows, so units can be encoded alone.
    """

    def __init__(self, path: str, code: str = "I"):
        super().__init__()
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.code = code
        self.spaced = Spaced(self)

    @cached_property
    def whole(self):
        """The tokenizer as it is, for texts with an added token; units hold none."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __missing__(self, unit: str) -> bytes:
        ids = self.alone(unit)
        self.make_room()
        self[unit] = ids
        return ids

    def make_room(self) -> None:
        if len(self) + len(self.spaced) >= CACHE_UNITS:
            self.clear()
            self.spaced.clear()

    def alone(self, unit: str) -> bytes:
        # the pattern also ends a piece between a letter or digit and a mark after it, and after a line feed before it
        if unit[-1:] in MARKS and unit[-2:-1].isalnum():
            body = unit[:-1]
            return (self.spaced[body[1:]] if body[:1] == " " else self[body]) + self[unit[-1]]
        if unit[:1] == "\n" and unit[1:2].isalnum():
            return self["\n"] + self[unit[1:]]
        if unit.isalpha() or unit[:1] == " " and unit[1:].isalpha():
            # letters with at most one space before them are one piece, so the vocabulary's merges apply at once
            found = [t.id for t in self.model.tokenize("".join(map(BYTE_CHARS.__getitem__, unit.encode())))]
        else:
            found = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return array(self.code, found).tobytes()

    def mixed(self, part: str) -> bytes:
        """Ids of text with any white space; units start at a space that no other white space follows."""
        first, *rest = part.split(" ")
        units = [first]
        for u in rest:
            if u and not u[0].isspace():
                units.append(" " + u)
            else:
                units[-1] += " " + u
        return b"".join(map(self.__getitem__, units))

    def of(self, body: str) -> bytes:
        """Ids of a whole text. Lines of words with single spaces are units at once; other lines are held together,
        since white space around a line feed forms one run.
        """
        if self.added is not None and self.added.search(body):
            return array(self.code, self.whole.encode(body, add_special_tokens=False).ids).tobytes()
        out, held = [], None
        for n, line in enumerate(body.split("\n")):
            mark = "\n" if n else ""
            if line and line.isprintable() and line[0] != " " and line[-1] != " " and "  " not in line:
                if held is not None:
                    out.append(self.mixed(held))
                    held = None
                first, *rest = line.split(" ")
                out.append(self[mark + first])
                out.extend(map(self.spaced.__getitem__, rest))
            else:
                held = (held or "") + mark + line
        if held is not None:
            out.append(self.mixed(held))
        return b"".join(out)


class Spaced(dict):
    """Ids of words with the space before them, by the word alone."""

    def __init__(self, units: UnitIds):
        super().__init__()
        self.units = units

    def __missing__(self, word: str) -> bytes:
        units = self.units
        if word.isalpha():
            # a plain word is one piece; the bytes of ASCII letters are written as they are
            piece = SPACED + word if word.isascii() else "".join(map(BYTE_CHARS.__getitem__, (" " + word).encode()))
            ids = array(units.code, [t.id for t in units.model.tokenize(piece)]).tobytes()
        elif word[-1:] in MARKS and word[-2:-1].isalnum():
            ids = self[word[:-1]] + units[word[-1]]
        else:
            ids = units.alone(" " + word)
        units.make_room()
        self[word] = ids
        return ids


_WORKER: dict[str, UnitIds] = {}


def _code(path: str) -> str:
    """Type code of stored ids: 16 bits where the vocabulary fits, else 32."""
    from tokenizers import Tokenizer

    return "H" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"


def token_ids(items: DataFrame, id_col: str = "path", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per item: tokens, ids (little-endian unsigned, 16-bit where the vocabulary fits, else 32-bit), the closing id included."""
    path = tokenizer or default_tokenizer()
    code = _code(path)
    schema = text.plus(items, id_col, [("tokens", T.LongType()), ("ids", T.BinaryType())])
    end = array(code, [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _WORKER.get(path) or _WORKER.setdefault(path, UnitIds(path, code))
        for batch in text.pieces(batches, "text"):
            ids = [(units.of(body) if body else b"") + end for body in batch.column("text").to_pylist()]
            yield text.record(batch.column("id"), schema, [[len(x) // len(end) for x in ids], ids])

    return items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- plan ---------------------------------------------------------------------------------------


def combinations(units: int) -> np.ndarray:
    """All ways to fill ``units`` with up to three classes, largest first; 0 for no class."""
    found = [(units, 0, 0)] + [(units - b, b, 0) for b in range(1, units // 2 + 1)]
    for c in range(1, units // 3 + 1):
        found += [(units - b - c, b, c) for b in range(c, (units - c) // 2 + 1)]
    return np.array(found)


def repeats(combos: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Whole repeat counts x >= 0 of the combinations that come near the class counts and never exceed them.

    Least squares |A x - counts| under x >= 0 by accelerated projected gradient. Rounding is down first, then up, the
    largest remainders first, each as far as the counts reach: a thin histogram gives many combinations less than one
    text each, and rounding all of them down would place none.
    """
    total = counts.sum()
    if total == 0:
        return np.zeros(len(combos), np.int64)
    goal = counts / total
    goal[0] = 0
    used = (combos > 0).astype(float)

    def residue(x):
        have = np.bincount(combos.ravel(), (used * x[:, None]).ravel(), len(counts))
        have[0] = 0
        return have - goal

    slope = lambda r: (r[combos] * used).sum(1)
    norm = x = np.ones(len(combos))
    for _ in range(20):
        norm = slope(residue(norm / np.linalg.norm(norm)) + goal)
    step = 1 / np.linalg.norm(norm)
    x, ahead, pace = np.zeros(len(combos)), np.zeros(len(combos)), 1.0
    for _ in range(rounds):
        new = np.maximum(0, ahead - step * slope(residue(ahead)))
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, x, pace = new + (pace - 1) / faster * (new - x), new, faster
    wanted = x * total
    whole, left = np.zeros(len(combos), np.int64), counts.astype(np.int64).copy()
    for goal_times in (np.floor(wanted + 1e-6), np.ceil(wanted - 1e-6)):
        more = goal_times.astype(np.int64) - whole
        order = np.lexsort((np.arange(len(combos)), -(wanted - np.floor(wanted)), -more))
        for i in order[more[order] > 0].tolist():
            parts, need = np.unique(combos[i][combos[i] > 0], return_counts=True)
            fit = min(int(more[i]), int((left[parts] // need).min()))
            if fit > 0:
                whole[i] += fit
                left[parts] -= fit * need
    return whole


def residuals(left: np.ndarray, units: int, least: float = FILL) -> list[tuple[tuple[int, ...], int]]:
    """Greedy windows of what the combinations leave over: (classes, times), best fit from the largest class down.

    A pattern is repeated as often as its rarest class allows, so each step uses up a class or sets it aside: windows that
    would be filled by less than ``least`` are not made.
    """
    left, found = left.copy(), []
    for top in range(units, 0, -1):
        while left[top] > 0:
            parts, room, use = [top], units - top, left.copy()
            use[top] -= 1
            c = min(top, room)
            while c > 0:
                take = min(room // c, int(use[c]))
                parts += [c] * take
                room -= c * take
                c = min(c - 1, room)
            if units - room < least * units:
                break
            kinds, need = np.unique(parts, return_counts=True)
            times = int((left[kinds] // need).min())
            left[kinds] -= times * need
            found.append((tuple(parts), times))
    return found


def plan(lengths: dict[int, int], window: int = WINDOW, width: int = WIDTH) -> tuple[list[tuple], list[tuple], int]:
    """From texts per left-over length: places in combinations, places in the stream of cut texts, sequences planned.

    The texts of a class are numbered by length. Place rows are (class, from, to, sequence of the first, slot): number
    ``from + i`` goes to sequence ``first + i``. Stream rows are (length, number of the class's first text of that
    length, first number that is left over, blocks before it, tail tokens before it).
    """
    units = window // width
    counts = np.zeros(units + 1)
    for n, c in lengths.items():
        counts[-(-n // width)] += c
    combos = combinations(units)
    times = repeats(combos, counts)
    filled = list(zip(combos[times > 0].tolist(), times[times > 0].tolist()))
    used = np.zeros(units + 1, np.int64)
    for combo, x in filled:
        np.add.at(used, combo, x)
    used[0] = 0
    taken, places, sequences = np.zeros(units + 1, np.int64), [], 0
    for combo, x in filled + residuals(counts.astype(np.int64) - used, units):
        for slot, c in enumerate(combo):
            if c:
                places.append((c, int(taken[c]), int(taken[c]) + x, sequences, slot))
                taken[c] += x
        sequences += x
    stream, blocks, tail, before = [], 0, 0, np.zeros(units + 1, np.int64)
    for n in sorted(lengths):
        c = -(-n // width)
        first = int(before[c])
        before[c] += lengths[n]
        left = max(int(taken[c]), first)
        over = max(0, first + lengths[n] - left)
        stream.append((n, first, left, blocks, tail))
        blocks += over * (n // BLOCK)
        tail += over * (n % BLOCK)
    return places, [(*row[:4], blocks * BLOCK + row[4]) for row in stream], sequences


# --- pieces -------------------------------------------------------------------------------------


def _cut(schema: T.StructType, window: int):
    """Pieces of a text in the stream: its blocks at one place, its last tokens at another, cut where a window ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema.fields]
            for row in batch.to_pylist():
                start = row["start"]
                parts = ((row["block_at"] * BLOCK, row["rest"] // BLOCK * BLOCK), (row["tail_at"], row["rest"] % BLOCK))
                for at, left in parts:
                    while left:
                        fit = min(left, window - at % window)
                        for col, v in zip(out, (row["row"], start, fit, row["sequence"] + at // window, at % window)):
                            col.append(v)
                        start, at, left = start + fit, at + fit, left - fit
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=schema.names)

    return run


def _frame(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in columns.split()))


def pack(items: DataFrame, id_col: str = "path", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids, ids_crc32, <id_col>_tokens, sequence, offset.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers, ``ids_crc32`` is their checksum.
    Each text is its ids and one closing id; NULL is an empty text. Every id lies in exactly one piece; pieces
    of a sequence follow each other from offset 0 without a gap. Texts with the same or a NULL id are packed one by
    one; an empty frame gives no pieces. Only texts the plan leaves over are cut inside a window.
    ``tokenizer`` is the path of a ``tokenizers`` file, the 50k byte-level one unless given.
    """
    spark = items.sparkSession
    # the number of a row is written with it, so it stays what it is
    texts = stored(token_ids(items, id_col, text_col, tokenizer).withColumnRenamed(id_col, "id").withColumn("row", F.monotonically_increasing_id()))
    code = _code(tokenizer or default_tokenizer())
    width = 2 if code == "H" else 4
    full = F.floor(F.col("tokens") / window).cast("long")
    rows = texts.select("row", (F.col("tokens") % window).cast("int").alias("rest"), full.alias("full"))
    found = rows.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")).orderBy("rest").collect()
    places, stream, planned = plan({r["rest"]: r["n"] for r in found if r["rest"]}, window)
    whole = sum(r["full"] for r in found)
    starts = np.concatenate(([0], np.cumsum([r["full"] for r in found])[:-1])).astype(int).tolist() if found else []

    share = max(NUMBERED, int(NUMBERED_SHARE * sum(r["n"] for r in found)))
    parts = max([1, *(-(-r["n"] // share) for r in found)])
    salt = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    group = Window.partitionBy("rest", "salt").orderBy("row")
    numbered = rows.withColumn("salt", salt)
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("rest", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("f"))
    offsets = offsets.select("rest", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("f").over(before), F.lit(0)).alias("f_before"))
    bases = _frame(spark, [(r["rest"], s) for r, s in zip(found, starts)], "rest base")
    numbered = numbered.withColumns({"k": F.row_number().over(group) - 1, "f_upto": F.sum("full").over(group.rowsBetween(Window.unboundedPreceding, 0))})
    numbered = numbered.join(offsets, ["rest", "salt"]).join(F.broadcast(bases), "rest").withColumns({
        "k": F.col("k") + F.col("n_before"), "sequence": F.col("base") + F.col("f_before") + F.col("f_upto") - F.col("full")
    })
    numbered = stored(numbered.select("row", "rest", "full", "k", "sequence"))

    names = ["row", "start", "length", "sequence", "offset"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    wholes = numbered.filter("full > 0").select("row", "sequence", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("i")).select(
        "row", (F.col("i") * F.lit(window)).alias("start"), F.lit(window).cast("long").alias("length"),
        (F.col("sequence") + F.col("i")).alias("sequence"), F.lit(0).cast("long").alias("offset"),
    )
    left = numbered.filter("rest > 0").withColumn("class", F.ceil(F.col("rest") / WIDTH).cast("long"))
    left = left.withColumn("start", F.col("full") * F.lit(window)).drop("sequence", "full")
    left = left.join(F.broadcast(_frame(spark, stream, "rest class_first left blocks_before tail_before")), "rest")
    left = left.withColumn("place", F.col("k") + F.col("class_first"))
    table = _frame(spark, places, "class from_n to_n first slot")
    fits = left.filter(F.col("place") < F.col("left")).join(
        F.broadcast(table), (left["class"] == table["class"]) & (F.col("place") >= F.col("from_n")) & (F.col("place") < F.col("to_n"))
    )
    upto = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    fits = fits.select(
        "row", "start", F.col("rest").cast("long").alias("length"),
        (F.lit(whole) + F.col("first") + F.col("place") - F.col("from_n")).alias("sequence"), "slot",
    ).withColumn("offset", F.coalesce(F.sum("length").over(upto), F.lit(0)))
    over = left.filter(F.col("place") >= F.col("left")).withColumn("j", F.col("place") - F.col("left"))
    cut = over.select(
        "row", "start", "rest", (F.col("blocks_before") + F.col("j") * F.floor(F.col("rest") / BLOCK)).alias("block_at"),
        (F.col("tail_before") + F.col("j") * (F.col("rest") % BLOCK)).alias("tail_at"), F.lit(whole + planned).cast("long").alias("sequence"),
    ).mapInArrow(_cut(schema, window), schema)
    pieces = wholes.unionByName(fits.select(names)).unionByName(cut)
    pieces = pieces.groupBy("row").agg(F.collect_list(F.struct(*names[1:])).alias("pieces"))
    ids = lambda p: F.substring(F.col("ids"), (width * p["start"] + 1).cast("int"), (width * p["length"]).cast("int"))
    cut_up = F.transform("pieces", lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), ids(p).alias("ids"), p["sequence"].alias("sequence"), p["offset"].alias("offset")))
    found = texts.select("row", "id", "ids", "tokens").join(pieces, "row").select("id", "tokens", F.inline(cut_up))
    found = found.select(F.col("id").alias(id_col), "start", "length", "ids", F.col("tokens").alias(f"{id_col}_tokens"), "sequence", "offset")
    schema = T.StructType([*found.schema.fields, T.StructField("ids_crc32", T.LongType())])
    order = [id_col, "start", "length", "ids", "ids_crc32", f"{id_col}_tokens", "sequence", "offset"]
    return found.mapInArrow(_widened(code), schema).select(order)


def _widened(code: str):
    """Ids of the pieces as 32-bit numbers, and their checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.pieces(batches, "ids"):
            ids = batch.column("ids").to_pylist()
            if code == "H":
                ids = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in ids]
            columns = [pa.array(ids, pa.binary()) if n == "ids" else c for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([zlib.crc32(x) for x in ids], pa.int64())], names=[*batch.schema.names, "ids_crc32"])

    return run
