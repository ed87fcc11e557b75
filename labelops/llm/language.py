"""Language of a text by unigram pieces, summed over all ways to cut a word into pieces of a public vocabulary.

For each language every piece has a probability; a word's probability is the sum over its segmentations, found by
the forward recursion over its characters. The probabilities are learned by expectation maximisation
(forward and backward sums) on a bounded sample of labelled texts.

The project has no running text; the operator is general and takes any frame with an id (``path``) and a text column.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import stored
from labelops.llm import text

#: Least share of the posterior that the language of a text that stays has.
MIN_SCORE = 0.5
UNKNOWN = "und"
#: About so many labelled texts of each language are learned from; fewer where there are fewer.
SAMPLE = 1500
ROUNDS = 2
#: Probability of a character that no piece has, the same in every language.
RARE = 1e-7
#: Pieces of the pooled languages that each language's counts are blended with.
BLEND = 2000.0
#: Longer words are summed one by one with rescaling, in learning as in scoring.
LONG = 40
SIEVE_BITS = 20
#: Words summed at once; their sums over all prefixes are held meanwhile.
AT_ONCE = 5_000
#: Words a worker remembers the scores of, and text whose words it takes at once; what a text gives does not depend on them.
CACHE_WORDS, GROUP_CHARS = 150_000, 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece file, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Pieces:
    """The vocabulary as hashes, for looking up all substrings of many words at once."""

    def __init__(self, names: list[str]):
        self.index = {p: i for i, p in enumerate(names)}
        self.longest = max(map(len, names), default=1)
        codes = [np.frombuffer(p.encode("utf-32-le"), "<u4") for p in names]
        hashes = np.array([self._hash(c) for c in codes], np.uint64)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[self._slot(self.sorted)] = True

    @staticmethod
    def _hash(codes: np.ndarray) -> int:
        h = 0
        for c in codes.tolist():
            h = (h * int(BASE) + c + 1) % 2**64
        return h

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SIEVE_BITS)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose hash is a piece, and the piece."""
        row = np.flatnonzero(self.sieve[self._slot(hashes)])
        at = np.minimum(np.searchsorted(self.sorted, hashes[row]), len(self.sorted) - 1)
        hit = self.sorted[at] == hashes[row]
        return row[hit], self.order[at[hit]]

    def spans(self, words: list[str]) -> tuple[np.ndarray, list[list[tuple[int, np.ndarray, np.ndarray]]], np.ndarray]:
        """Order of the words by falling length; per end position the (length, rows, pieces) found there; lengths."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        width = int(sizes[0]) if len(sizes) else 0
        flat = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        start = np.cumsum(sizes) - sizes
        prefix = [np.zeros(len(words), np.uint64)]
        power = [np.uint64(1)]
        ends = []
        for i in range(1, width + 1):
            n = int(np.searchsorted(-sizes, -i, "right"))
            with np.errstate(over="ignore"):
                prefix.append(prefix[-1][:n] * BASE + flat[start[:n] + i - 1])
                power.append(power[-1] * BASE)
                found = []
                for size in range(1, min(i, self.longest) + 1):
                    rows, pieces = self.find(prefix[i] - prefix[i - size][:n] * power[size])
                    found.append((size, rows, pieces))
            ends.append(found)
        return order, ends, sizes


def forward(ends: list, sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Sums over segmentations of every prefix: (position, word, language)."""
    width = len(ends)
    sums = np.zeros((width + 1, len(sizes), chances.shape[1]))
    sums[0] = 1
    for i, found in enumerate(ends, 1):
        n = int(np.searchsorted(-sizes, -i, "right"))
        plain = np.ones(n, bool)
        for size, rows, pieces in found:
            sums[i, rows] += sums[i - size, rows] * chances[pieces]
            if size == 1:
                plain[rows] = False
        rows = np.flatnonzero(plain)
        sums[i, rows] += sums[i - 1, rows] * RARE
    return sums


def expected(ends: list, sizes: np.ndarray, chances: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the words, for one language."""
    sums = forward(ends, sizes, chances[:, None])[:, :, 0]
    back = np.zeros_like(sums)
    back[sizes, np.arange(len(sizes))] = 1
    total = sums[sizes, np.arange(len(sizes))]
    uses = np.zeros(len(chances))
    for i in range(len(ends), 0, -1):
        n = int(np.searchsorted(-sizes, -i, "right"))
        plain = np.ones(n, bool)
        for size, rows, pieces in ends[i - 1]:
            gain = chances[pieces] * back[i, rows]
            np.add.at(uses, pieces, times[rows] * sums[i - size, rows] * gain / total[rows])
            back[i - size, rows] += gain
            if size == 1:
                plain[rows] = False
        rows = np.flatnonzero(plain)
        back[i - 1, rows] += back[i, rows] * RARE
    return uses


def expected_long(word: str, index: dict[str, int], longest: int, chances: np.ndarray, times: float, uses: np.ndarray) -> None:
    """Add the expected uses of each piece in one word of any length, for one language; sums are kept as logs."""

    def add(values: list[float]) -> float:
        top = max(values)
        return top + log(sum(exp(v - top) for v in values))

    steps, ahead = [], [0.0]
    for i in range(1, len(word) + 1):
        found = [(i - 1, -1, log(RARE))] if word[i - 1] not in index else []
        for size in range(1, min(i, longest) + 1):
            piece = index.get(word[i - size : i])
            if piece is not None:
                found.append((i - size, piece, log(chances[piece])))
        steps.append(found)
        ahead.append(add([ahead[a] + p for a, _, p in found]))
    back: list[list[float]] = [[] for _ in word] + [[0.0]]
    for i in range(len(word), 0, -1):
        # every character can be a step of its own, so something follows each place
        rest = add(back[i])
        back[i] = []
        for a, piece, p in steps[i - 1]:
            back[a].append(p + rest)
            if piece >= 0:
                uses[piece] += times * exp(ahead[a] + p + rest - ahead[-1])


def long_word(word: str, index: dict[str, int], longest: int, chances: np.ndarray) -> np.ndarray:
    """Log of the sum over segmentations of one long word, per language, rescaled as it goes."""
    sums = [np.ones(chances.shape[1])]
    log = np.zeros(chances.shape[1])
    for i in range(1, len(word) + 1):
        total = np.zeros(chances.shape[1])
        if word[i - 1] not in index:
            total += sums[-1] * RARE
        for size in range(1, min(i, longest) + 1):
            piece = index.get(word[i - size : i])
            if piece is not None:
                total += sums[-size] * chances[piece]
        sums = [*sums[-(longest - 1) :], total] if longest > 1 else [total]
        if i % 16 == 0:
            scale = np.max(sums, axis=0)
            sums = [s / scale for s in sums]
            log += np.log(scale)
    return log + np.log(sums[-1])


def word_scores(words: list[str], pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word (with its leading mark) in each language."""
    out = np.empty((len(words), chances.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= LONG]
    for a in range(0, len(short), AT_ONCE):
        part = short[a : a + AT_ONCE]
        order, ends, sizes = pieces.spans([words[i] for i in part])
        sums = forward(ends, sizes, chances)
        out[np.array(part)[order]] = np.log(sums[sizes, np.arange(len(sizes))])
    for i, w in enumerate(words):
        if len(w) > LONG:
            out[i] = long_word(w, pieces.index, pieces.longest, chances)
    return out


def _marked(body: str | None) -> list[str]:
    return ["▁" + w for w in (body or "").split()]


class WordScores(dict):
    """Scores of words by number, remembered for about CACHE_WORDS words; new words are scored together.

    Texts are taken in groups of about GROUP_CHARS, so that what is new at once is bounded too. When there are too many words,
    the half of them stays that was used most. What is returned does not depend on it.
    """

    def __init__(self, pieces: Pieces, chances: np.ndarray):
        super().__init__()
        self.pieces, self.chances = pieces, chances
        self.table = np.empty((0, chances.shape[1]))
        self.uses = np.empty(0, np.int64)
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n

    def totals(self, texts: list[str | None]) -> np.ndarray:
        group = np.cumsum([len(t or "") for t in texts]) // GROUP_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        return np.concatenate([self._totals(texts[a:b]) for a, b in zip(cuts, cuts[1:])])

    def _totals(self, texts: list[str | None]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self._forget()
        rows = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in map(_marked, texts)]
        if self.fresh:
            self.table = np.concatenate([self.table, word_scores(self.fresh, self.pieces, self.chances)])
            self.uses = np.concatenate([self.uses, np.zeros(len(self.fresh), np.int64)])
            self.fresh = []
        for r in rows:
            np.add.at(self.uses, r, 1)
        return np.array([self.table[r].sum(0) for r in rows]).reshape(len(texts), -1)

    def _forget(self) -> None:
        keep = np.sort(np.argpartition(-self.uses, CACHE_WORDS // 2)[: CACHE_WORDS // 2])
        words = list(self)
        self.clear()
        self.update(zip([words[i] for i in keep.tolist()], range(len(keep))))
        # older uses count less each time
        self.table, self.uses = self.table[keep], self.uses[keep] // 2


# --- learning -----------------------------------------------------------------------------------


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "path", vocab: str | None = None, sample: int = SAMPLE) -> dict:
    """Model of all languages in ``lang_col``: names, their share of the texts, pieces, piece probabilities.

    About ``sample`` texts of each language are used, those with the smallest hash of the id: the one documented
    bound of the fit. Rows without language or text are left out; no labelled row gives a model without languages.
    """
    names = vocabulary(vocab or default_vocabulary())
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("h")
    )
    counts = rows.groupBy("lang").count()
    known = {r["lang"]: r["count"] for r in counts.collect()}
    langs = sorted(known)
    if not langs:
        return {"langs": [], "share": np.empty(0), "names": names, "chances": np.empty((len(names), 0))}
    limit = F.lit(-(1 << 63)).cast("double") + F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count")) * F.lit(2.0**64)
    # one row a language, and these are known here already; no text is shuffled by language
    chosen = stored(rows.join(F.broadcast(counts), "lang").filter(F.col("h").cast("double") <= limit).select("lang", "text"))
    chances = np.full((len(names), len(langs)), 1.0 / len(names))
    for _ in range(ROUNDS):
        shared = labelled.sparkSession.sparkContext.broadcast((names, langs, chances))
        parts = chosen.mapInArrow(_expect(shared), "lang string, piece int, uses double")
        uses = np.zeros_like(chances)
        for r in parts.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[r["piece"], langs.index(r["lang"])] = r["uses"]
        pooled = uses.sum(1) + 0.01
        pooled /= pooled.sum()
        chances = (uses + BLEND * pooled[:, None]) / (uses.sum(0) + BLEND)
    share = np.array([known[k] for k in langs], float)
    return {"langs": langs, "share": share / share.sum(), "names": names, "chances": chances}


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, langs, chances = shared.value
        pieces = Pieces(names)
        uses: dict[str, np.ndarray] = {}
        for batch in text.pieces(batches, "text", GROUP_CHARS):
            words: dict[str, dict[str, int]] = {}
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = words.setdefault(lang, {})
                for w in _marked(body):
                    own[w] = own.get(w, 0) + 1
            for lang, own in words.items():
                part = [w for w in own if len(w) <= LONG]
                total = uses.setdefault(lang, np.zeros(len(names)))
                for a in range(0, len(part), AT_ONCE):
                    some = part[a : a + AT_ONCE]
                    order, ends, sizes = pieces.spans(some)
                    times = np.array([own[w] for w in some], float)[order]
                    total += expected(ends, sizes, np.ascontiguousarray(chances[:, langs.index(lang)]), times)
                for w in own:
                    if len(w) > LONG:
                        expected_long(w, pieces.index, pieces.longest, chances[:, langs.index(lang)], own[w], total)
        for lang, total in uses.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])], names=["lang", "piece", "uses"])

    return run


# --- prediction ---------------------------------------------------------------------------------


class Judge:
    """Languages of texts and their posterior shares, under one model."""

    def __init__(self, model: dict):
        self.model = model
        self.scores = WordScores(Pieces(model["names"]), model["chances"]) if model["langs"] else None

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        sure = np.array([self.scores is not None and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
        langs, chance = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if sure.any():
            total = self.scores.totals([t for t, s in zip(texts, sure) if s]) + np.log(self.model["share"])
            total -= total.max(1, keepdims=True)
            share = np.exp(total) / np.exp(total).sum(1, keepdims=True)
            langs[sure] = np.array(self.model["langs"], object)[total.argmax(1)]
            chance[sure] = share.max(1)
        return langs, chance


def identify(items: DataFrame, model: dict, id_col: str = "path", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score``: the likeliest language of each whole text and its posterior share.

    A NULL text, one without a letter, and any text under a model without languages give ``und`` and 0. Texts
    and words of any length count whole. Ties go to the first language by name.
    """
    schema = text.plus(items, id_col, [("lang_pred", T.StringType()), ("score", T.DoubleType())])
    shared = items.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in text.pieces(batches, "text"):
            langs, chance = judge(batch.column("text").to_pylist())
            yield text.record(batch.column("id"), schema, [langs.tolist(), chance])

    return items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep_identified(items: DataFrame, model: dict, id_col: str = "path", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The items, all columns, without those whose language cannot be told.

    That is a text that gives ``und`` (see ``identify``) or one no language has at least ``min_score`` of. Every row is judged by
    its own text and goes through whole, so nothing is shuffled; ``id_col`` is not looked at.
    """
    rows = items.select(F.struct("*").alias("row"))
    text.small_batches(items.sparkSession)
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType)])
    shared = items.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            # the text is read inside the row, so that it is held once
            langs, chance = judge(batch.column("row").field(text_col).to_pylist())
            kept = pa.array((langs != UNKNOWN) & (chance >= min_score))
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(kept)], names=["row"])

    return rows.mapInArrow(run, schema).select("row.*")
