"""Class-based bigram language model: exchange clustering, class transitions, word emissions, smoothed perplexity.

Words are counted exactly over all training texts, as a distributed table of any size. The most frequent words set up the
classes; every other word first belongs to the form of its last letters, and forms are clustered along with the
words. An exchange round moves each unit to the class that gains most likelihood given the classes of its neighbours
(counts of unit and class, gathered over the whole corpus). Then every other training word leaves its form for the class
that gains most given its own neighbours; words and classes stay a distributed table, and class transitions are counted
anew over all texts. Only words that training never saw keep the class of their form. A word's probability is that of its
class after the class before it, times its own share of the class.

Texts are split into words once: each chunk of texts numbers its own words, and every later step meets these numbers with what the
distributed word table has of them, so no worker holds words again.

The project has no running text to model; the operator is general and takes any frame with an id (``path``) and a text column.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import shuffles_dropped, stored
from labelops.llm import text

#: Units that set up the classes: frequent words, then forms of the other words.
WORDS = 6000
FORMS = 2000
CLASSES = 64
ROUNDS = 4
ADD = 0.1
#: Share of the class model in the mixture with the plain word counts.
MIX = 0.8
#: Text of one chunk, whose words have numbers of their own.
CHUNK_BYTES = 16_000_000
#: Tokens that are scored at once.
SCORED_TOKENS = 1_000_000
#: Fixed value: the closing token; no word has a space.
END = b" "


def _words(body: str | None) -> list[bytes]:
    return text.ascii_words(body)


def _form(word: bytes) -> bytes:
    """The last two characters, after a mark no word can be equal to."""
    return b" " + "".join(word.decode("utf-8", "replace")[-2:]).encode("utf-8", "replace")


@dataclass
class Model:
    """What all texts share: bounded by WORDS + FORMS and CLASSES, whatever the corpus."""

    units: dict[bytes, int]
    classes: np.ndarray
    moves: np.ndarray  # log10 of class after class
    uses: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # distinct training words of each class
    tokens: int
    distinct: int

    @property
    def end(self) -> int:
        """Class of the closing token."""
        return int(self.classes[self.units[END]])

    def unit(self, word: bytes) -> int:
        found = self.units.get(word)
        if found is None:
            found = self.units.get(_form(word), len(self.classes) - 1)
        return found


class Numbers(dict):
    """Number of each word of a chunk, by first sight; the closing token is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


# --- texts as numbers ---------------------------------------------------------------------------


def _numbered(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of texts (id, text, train): (chunk, id, train, tokens), and the (chunk, at, word, n) of each chunk's words.

    ``tokens`` are places ``at`` in the words of the chunk, the closing one (0) included; ``n`` counts tokens of training texts.
    A chunk holds about CHUNK_BYTES of texts that one task has read, whatever their contents.
    """
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("id", items.schema["id"].dataType), T.StructField("train", T.BooleanType()), T.StructField("tokens", T.ArrayType(T.IntegerType())),
        T.StructField("at", T.IntegerType()), T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, volume, numbers, counts = TaskContext.get().partitionId() << 32, 0, Numbers(), np.zeros(0, np.int64)

        def record(rows: int, **columns) -> pa.RecordBatch:
            return text.record(pa.array(np.full(rows, chunk)), schema, [columns.get(f.name, pa.nulls(rows)) for f in schema.fields[1:]])

        def words() -> Iterator[pa.RecordBatch]:
            found = list(numbers)
            for a in range(0, len(found), 100_000):
                some = pa.array(found[a : a + 100_000], pa.binary())
                yield record(len(some), at=pa.array(np.arange(a, a + len(some), dtype=np.int32)), word=some, n=pa.array(counts[a : a + len(some)]))

        for batch in text.pieces(batches, "text"):
            rows = []
            for body in batch.column("text").to_pylist():
                found = _words(body)
                found.append(END)
                rows.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                volume += len(body or "")
            train = batch.column("train").to_numpy(zero_copy_only=False)
            sizes = np.array([len(r) for r in rows])
            tokens = np.concatenate(rows)
            counts = np.bincount(tokens[np.repeat(train, sizes)], minlength=len(numbers)) + np.pad(counts, (0, len(numbers) - len(counts)))
            starts = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield record(batch.num_rows, id=batch.column("id"), train=batch.column("train"), tokens=pa.ListArray.from_arrays(starts, pa.array(tokens)))
            if volume >= CHUNK_BYTES or len(numbers) > text.CACHE_WORDS:
                yield from words()
                chunk, volume, numbers, counts = chunk + 1, 0, Numbers(), np.zeros(0, np.int64)
        if len(counts):
            yield from words()

    text.small_batches(items.sparkSession)
    table = stored(items.select("id", "text", "train").mapInArrow(run, schema))
    return table.filter("tokens is not null").select("chunk", "id", "train", "tokens"), table.filter("word is not null").select("chunk", "at", "word", "n")


def _flat(tokens: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of all texts one after another, and where each text starts."""
    lists = tokens.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)


def _by_place(known: pa.Table, name: str) -> np.ndarray:
    """A column of a chunk's words by their place."""
    values = known.column(name).to_numpy()
    out = np.empty(len(values), values.dtype)
    out[known.column("at").to_numpy()] = values
    return out


def _before(own: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """What stands before each token; the closing one before the first of a text."""
    before = np.concatenate(([end], own[:-1])) if len(own) else own
    before[starts] = end
    return before


def _bigrams(size: int):
    """Counts of pairs of units in a chunk."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        pair, n = np.empty(0, np.int64), np.empty(0, np.int64)
        if docs.num_rows:
            tokens, starts = _flat(docs.column("tokens"))
            own = _by_place(known, "unit").astype(np.int64)[tokens]
            pair, n = np.unique(_before(own, starts, 0) * size + own, return_counts=True)
        return pa.table({"pair": pa.array(pair), "n": pa.array(n, pa.int64())})

    return run


# --- exchange clustering ------------------------------------------------------------------------


def _class_counts(shared, size: int):
    """Of a part of the bigram table: neighbours of each unit by their class, before and after it, as one dense block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, k = shared.value
        before, after = np.zeros(size * k, np.int64), np.zeros(size * k, np.int64)
        for batch in batches:
            pair, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n"))
            a, b = np.divmod(pair, size)
            np.add.at(before, b * k + classes[a], n)
            np.add.at(after, a * k + classes[b], n)
        for side, block in ((0, before), (1, after)):
            at = np.flatnonzero(block)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), side), pa.int32()), pa.array(at), pa.array(block[at])], names=["side", "cell", "n"])

    return run


def exchange(before: np.ndarray, after: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """One round: each unit in turn (by falling count) goes to the class with the most likelihood.

    ``before[u, c]`` and ``after[u, c]`` count neighbours of unit u in class c, and stay as they were at the start
    of the round; the class totals follow every move.
    """
    k = before.shape[1]
    moves = np.zeros((k, k))
    np.add.at(moves, classes, after.astype(float))
    totals = moves.sum(1)
    classes = classes.copy()
    for u in np.argsort(-before.sum(1), kind="stable"):
        seen, follow, n = before[u].astype(float), after[u].astype(float), float(before[u].sum())
        if n == 0:
            continue
        own = classes[u]
        moves[:, own] -= seen
        moves[own] -= follow
        totals[own] -= n
        np.maximum(moves, 0, out=moves)
        into = np.log((moves + 0.1) / (totals[None, :] + 0.1 * k))  # share of class c's entries that come from each class
        out = np.log((moves + 0.1) / (totals[:, None] + 0.1 * k))
        gain = seen @ into + follow @ out.T
        best = int(np.argmax(gain))
        classes[u] = best
        moves[:, best] += seen
        moves[best] += follow
        totals[best] += n
    return classes


def learn(training: DataFrame, text_col: str = "text", words: int = WORDS, forms: int = FORMS, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """Model and the (word, n, class) table of all training tokens; NULL texts are texts without words.

    Counts cover every training text; the table also has the ``class`` of every training word. Only the units' class
    counts (units x classes) come to the driver.
    """
    rows = training.select(F.lit(None).cast("int").alias("id"), F.col(text_col).alias("text"), F.lit(True).alias("train"))
    with shuffles_dropped(training.sparkSession):
        docs, found = _numbered(rows)
        model, table, places = _classes(docs, found, words, forms, classes)
        return _with_transitions(model, docs, places), table.filter("n > 0").select("word", "n", "class")


def learn_and_score(
    items: DataFrame, training: Column, id_col: str = "path", text_col: str = "text", words: int = WORDS, forms: int = FORMS, classes: int = CLASSES, mix: float = MIX
) -> DataFrame:
    """``score`` of all items under the model of those for which ``training`` is true (NULL: not), texts being split into words once for all.

    Transitions are counted and texts scored from the numbers of their words.
    """
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    with shuffles_dropped(items.sparkSession):
        docs, found = _numbered(rows)
        model, table, places = _classes(docs, found, words, forms, classes)
        model = _with_transitions(model, docs, places)
    return _scored(docs, places, model, mix).withColumnRenamed("id", id_col)


def _classes(docs: DataFrame, found: DataFrame, words: int, forms: int, classes: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model without its transitions, the (wid, word, n, class) of all words, n 0 outside training, and the (chunk, at, n, class) of their places."""
    spark = docs.sparkSession
    counts = stored(found.groupBy("word").agg(F.sum("n").alias("n")).withColumn("wid", F.monotonically_increasing_id()))
    trained = counts.filter("n > 0")
    size = trained.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = int(size[0] or 0), int(size[1] or 0)
    top = [bytes(r["word"]) for r in trained.filter(F.col("word") != F.lit(END)).orderBy(F.desc("n"), "word").limit(words).collect()]
    units = {END: 0} | {w: i for i, w in enumerate(top, 1)}

    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some: Counter[bytes] = Counter()
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if w not in units:
                    some[_form(w)] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(some), pa.binary()), pa.array(list(some.values()), pa.int64())], names=["word", "n"])

    tails = trained.mapInArrow(formed, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(forms).collect()
    for r in tails:
        units[bytes(r["word"])] = len(units)
    total = len(units) + 1
    k = max(2, min(classes, total))
    model = Model(units, np.arange(total) % k, np.zeros((k, k)), np.zeros(k), np.zeros(k), tokens, distinct)
    numbered = counts.mapInArrow(_units(spark.sparkContext.broadcast(model)), "wid long, word binary, n long, unit int")
    places = stored(found.select("chunk", "at", "word").join(numbered.select("word", "wid", "unit"), "word").select("chunk", "at", "wid", "unit"))
    train = docs.filter("train").select("chunk", "tokens").groupBy("chunk")
    chunk_units = train.cogroup(places.select("chunk", "at", "unit").groupBy("chunk"))
    pairs = stored(chunk_units.applyInArrow(_bigrams(total), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))

    def gathered(mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = spark.sparkContext.broadcast((mine, k))
        cells = pairs.mapInArrow(_class_counts(shared, total), "side int, cell long, n long").groupBy("side", "cell").agg(F.sum("n").alias("n"))
        table = cells.toArrow()
        out = np.zeros((2, total * k), np.int64)
        out[table["side"].to_numpy(), table["cell"].to_numpy()] = table["n"].to_numpy()
        return out[0].reshape(total, k), out[1].reshape(total, k)

    mine = model.classes
    for _ in range(ROUNDS):
        mine = exchange(*gathered(mine), mine)
    _, after = gathered(mine)
    moves = np.zeros((k, k))
    np.add.at(moves, mine, after)
    shared = spark.sparkContext.broadcast((mine, len(top), moves))
    around = train.cogroup(places.groupBy("chunk")).applyInArrow(_neighbours(shared), "wid long, cells array<int>, n array<int>")
    placed = around.repartition("wid").sortWithinPartitions("wid").mapInArrow(_placed(shared), "wid long, class int")
    table = stored(numbered.join(placed, "wid", "left").mapInArrow(_filled(shared), "wid long, word binary, n long, class int"))
    uses, kinds = np.zeros(k), np.zeros(k)
    for r in table.filter("n > 0").groupBy("class").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("kinds")).collect():
        uses[r["class"]], kinds[r["class"]] = r["uses"], r["kinds"]
    return replace(model, classes=mine, uses=uses, kinds=kinds), table, places.join(table.select("wid", "n", "class"), "wid").select("chunk", "at", "n", "class")


def _units(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            unit = pa.array([model.unit(w) for w in batch.column("word").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("wid"), batch.column("word"), batch.column("n"), unit], names=["wid", "word", "n", "unit"])

    return run


def _with_transitions(model: Model, docs: DataFrame, places: DataFrame) -> Model:
    """The model with the class transitions of the training texts."""
    k = len(model.uses)
    moves = np.zeros(k * k)
    met = docs.filter("train").select("chunk", "tokens").groupBy("chunk").cogroup(places.select("chunk", "at", "class").groupBy("chunk"))
    for r in met.applyInArrow(_transitions(k, model.end), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        moves[r["cell"]] = r["n"]
    moves = moves.reshape(k, k)
    logs = np.log10((moves + ADD) / (moves.sum(1, keepdims=True) + ADD * k))
    return replace(model, moves=logs)


def _neighbours(shared):
    """Of each word of a chunk that is no unit: how often each class stands before it (cells from 0) and after it (from k)."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        mine, core, moves = shared.value
        k = len(moves)
        cell, n, wid = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        if docs.num_rows:
            tokens, starts = _flat(docs.column("tokens"))
            unit, wid = _by_place(known, "unit"), _by_place(known, "wid")
            kind = mine[unit][tokens]
            before = _before(kind, starts, mine[0])
            # the closing token is a unit, so every other one has a token after it
            at = np.flatnonzero((unit > core)[tokens])
            word = tokens[at].astype(np.int64) * (2 * k)
            cell, n = np.unique(np.concatenate([word + before[at], word + k + kind[at + 1]]), return_counts=True)
        word, cell = np.divmod(cell, 2 * k)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        starts = pa.array(np.append(first, len(word)), pa.int32())
        return pa.table({
            "wid": pa.array(wid[word[first]]), "cells": pa.ListArray.from_arrays(starts, pa.array(cell, pa.int32())), "n": pa.ListArray.from_arrays(starts, pa.array(n, pa.int32()))
        })

    return run


def _placed(shared):
    """The class of each word with the most likelihood, from rows sorted by word; class totals stay as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = shared.value[-1]
        k = len(moves)
        totals = moves.sum(1)
        into = np.log((moves + 0.1) / (totals[None, :] + 0.1 * k))
        out = np.log((moves + 0.1) / (totals[:, None] + 0.1 * k))
        worth = np.concatenate([into, out.T])  # of a neighbour (cell), for each class

        def best(words: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            kinds = []
            # most words have few neighbours: their cells are added up one by one, a bounded number at once
            first = np.flatnonzero(np.diff(code // (2 * k), prepend=-1))
            ends = np.append(first[1:], len(code))
            a = 0
            while a < len(first):
                b = max(a + 1, int(np.searchsorted(ends, first[a] + 50_000, "right")))
                part = slice(first[a], ends[b - 1])
                kinds.append(np.add.reduceat(worth[code[part] % (2 * k)] * n[part, None], first[a:b] - first[a]).argmax(1))
                a = b
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.concatenate(kinds) if kinds else [], pa.int32())], names=["wid", "class"])

        # rows of one word may go on in the next batch
        last, cells, held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words = batch.column("wid").to_numpy()
            names = np.unique(np.concatenate([last, words]))
            rows = np.repeat(np.searchsorted(names, words), batch.column("cells").value_lengths().to_numpy(zero_copy_only=False))
            code = np.concatenate([cells, rows * (2 * k) + batch.column("cells").flatten().to_numpy()])
            code, at = np.unique(code, return_inverse=True)
            n = np.bincount(at, np.concatenate([held, batch.column("n").flatten().to_numpy()])).astype(np.int64)
            cut = np.searchsorted(code, (len(names) - 1) * 2 * k)
            yield best(names[:-1], code[:cut], n[:cut])
            last, cells, held = names[-1:], code[cut:] % (2 * k), n[cut:]
        yield best(last, cells, held)

    return run


def _filled(shared):
    """Words that were not placed have the class of their unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, *_ = shared.value
        for batch in batches:
            of_unit = pa.array(mine[batch.column("unit").to_numpy()], pa.int32())
            found = pa.compute.coalesce(batch.column("class"), of_unit)
            yield pa.RecordBatch.from_arrays([batch.column("wid"), batch.column("word"), batch.column("n"), found], names=["wid", "word", "n", "class"])

    return run


def _transitions(k: int, end: int):
    """Counts of pairs of classes in a chunk."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        cells = np.zeros(k * k, np.int64)
        if docs.num_rows:
            tokens, starts = _flat(docs.column("tokens"))
            own = _by_place(known, "class").astype(np.int64)[tokens]
            cells = np.bincount(_before(own, starts, end) * k + own, minlength=k * k)
        at = np.flatnonzero(cells)
        return pa.table({"cell": pa.array(at, pa.int32()), "n": pa.array(cells[at])})

    return run


# --- scoring ------------------------------------------------------------------------------------


def _looked_up(shared):
    """Words unseen in training have count 0 and the class of their unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            found = [int(model.classes[model.unit(w)]) if c is None else c for w, c in zip(batch.column("word").to_pylist(), batch.column("class").to_pylist())]
            n = pa.compute.fill_null(batch.column("n"), 0)
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("at"), n, pa.array(found, pa.int32())], names=["chunk", "at", "n", "class"])

    return run


def score(items: DataFrame, model: Model, counts: DataFrame, id_col: str = "path", text_col: str = "text", mix: float = MIX) -> DataFrame:
    """``id_col``, n_tokens, n_known, train_tokens, base_score, score, perplexity of every whole text.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one closing token. ``base_score`` adds up log10((c + 0.1) /
    (N + 0.1 (V + 1))); ``score`` is the log10 probability of the text under the mixture of class model and
    plain counts, each of which leaves room for unseen words. NULL and empty texts have the closing token alone.
    """
    docs, found = _numbered(items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(False).alias("train")))
    shared = items.sparkSession.sparkContext.broadcast(model)
    known = found.select("chunk", "at", "word").join(counts, "word", "left").select("chunk", "at", "word", "n", "class")
    places = known.mapInArrow(_looked_up(shared), "chunk long, at int, n long, class int")
    return _scored(docs, places, model, mix).withColumnRenamed("id", id_col)


def _scored(docs: DataFrame, places: DataFrame, model: Model, mix: float) -> DataFrame:
    """Scores of texts (chunk, id, tokens): each chunk meets the counts and classes of its own words, so no task sees the whole table."""
    schema = T.StructType([
        docs.schema["id"], *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
        *[T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "perplexity")],
    ])
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, units={END: model.units[END]}))

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        m: Model = shared.value
        chance, size = 10**m.moves, m.uses + ADD * (m.kinds + 1)
        counts, kinds = _by_place(known, "n").astype(float), _by_place(known, "class")
        # what a word has by itself, whatever stands before it
        plains = (counts + ADD) / (m.tokens + ADD * (m.distinct + 1))
        shares, bases = mix * (counts + ADD) / size[kinds], np.log10(plains)
        rows = max(1, texts.num_rows * SCORED_TOKENS // max(1, pa.compute.sum(pa.compute.list_value_length(texts.column("tokens"))).as_py()))
        done = []
        for a in range(0, texts.num_rows, rows):
            part = texts.slice(a, rows)
            tokens, starts = _flat(part.column("tokens"))
            own = kinds[tokens]
            added = lambda x: np.add.reduceat(x, starts)  # noqa: E731 - every text has its closing token
            value = added(np.log10(chance[_before(own, starts, m.end), own] * shares[tokens] + (1 - mix) * plains[tokens]))
            count = added(np.ones(len(tokens), np.int64))
            columns = [count, added((counts > 0)[tokens].astype(np.int64)), np.full(len(count), m.tokens), added(bases[tokens]), value, 10 ** np.minimum(300.0, -value / count)]
            done.append(text.record(part.column("id").combine_chunks(), schema, columns))
        return pa.Table.from_batches(done)

    met = docs.select("chunk", "id", "tokens").groupBy("chunk").cogroup(places.select("chunk", "at", "n", "class").groupBy("chunk"))
    return met.applyInArrow(run, schema)
