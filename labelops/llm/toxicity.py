"""Toxic passages by maximum-scoring segments over token log-odds, with extreme-value calibration.

A token's score is its log-odds between texts marked toxic and others, under Dirichlet priors, less a drift
that makes an ordinary text's running sum fall. One scan finds all maximal segments; by the extreme-value law of such scores each has an
expected number of equals in ordinary text of that length, and the evidence of the significant ones is added up
and turned into a probability.

The project has no running text to score; the operator is general and takes any frame with an id (``path``) and a text column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import broadcast_if_small, stored
from labelops.llm import text

#: About so many labelled texts of either label are learned from.
SAMPLE = 20_000
#: Tokens with a score of their own: those with the clearest excess in toxic texts.
TOKENS = 50_000
PRIOR = 5.0
#: Standard errors above zero a token's log-odds must be to count for anything but the drift.
CLEAR = 3.0
DRIFT = 0.25
#: Segments expected less often than this in ordinary text of the same length are significant.
EXPECTED = 1.0
EULER = 0.5772156649015329
STEP = 0.25
BINS = 400
#: Fixed value: ASCII punctuation separates tokens as white space does.
BREAKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass
class Model:
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    rate: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


def _tokens(texts: list[str | None], cache: text.WordHashes) -> tuple[np.ndarray, np.ndarray]:
    parts, starts = [], np.zeros(len(texts) + 1, np.int64)
    for i, body in enumerate(texts):
        words = (body or "").encode("utf-8", "replace").lower().translate(BREAKS).split()
        parts.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
        starts[i + 1] = starts[i] + len(words)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), starts


def segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a text whose other tokens score -drift.

    Linear in the number of scored tokens: each new segment looks back for one that starts lower than it, and
    joins with it where that raises the score (the method of all maximal scoring subsequences). A link to the
    nearest segment that starts lower saves looking at those in between again.
    """
    held: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, link
    total, at = 0.0, 0
    for place, score in zip(places, scores):
        total -= drift * (place - at)
        at = place + 1
        first, before = place, total
        total += score
        after = total
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= before:
                j = held[j][4]
            if j < 0 or held[j][3] >= after:
                held.append((first, place, before, after, j))
                break
            first, before = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, after - before) for a, b, before, after, _ in held]


def _scan(model: Model, texts: list[str | None], cache: text.WordHashes) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Per text its number of tokens and its segments."""
    words, starts = _tokens(texts, cache)
    at = np.minimum(np.searchsorted(model.tokens, words), max(0, len(model.tokens) - 1))
    hit = np.flatnonzero(model.tokens[at] == words) if len(model.tokens) else np.empty(0, int)
    bounds = np.searchsorted(hit, starts)
    for i in range(len(texts)):
        mine = hit[bounds[i] : bounds[i + 1]]
        found = segments((mine - starts[i]).tolist(), model.scores[at[mine]].tolist(), DRIFT) if len(mine) else []
        yield int(starts[i + 1] - starts[i]), found


def _evidence(model: Model, n: int, found: list[tuple[int, int, float]]) -> tuple[float, list[tuple[int, int, float]]]:
    """Sum over significant segments of how much rarer than expected each is, in logs; those segments."""
    base = model.log_k + np.log(max(n, 1))
    rare = [(a, b, model.rate * s - base) for a, b, s in found]
    rare = [x for x in rare if x[2] > -np.log(EXPECTED)]
    return sum(x[2] for x in rare), rare


# --- learning -----------------------------------------------------------------------------------


def learn(
    items: DataFrame, toxic_col: str = "toxic", text_col: str = "text", id_col: str = "path", sample: int = SAMPLE, marks: DataFrame | None = None
) -> Model:
    """Scores and calibration from texts and their marks (0 or 1; other marks, NULL texts and NULL ids are left out).

    Marks are a column of the items, or a frame (id, mark) of its own with one row per id. About ``sample`` of either kind are used, those with the
    smallest hash of the id: the documented bound of the fit. They are drawn from ids and marks alone, so that no text
    travels but the chosen ones. Without toxic or without other texts the model scores every text 0.
    """
    own = F.col(id_col).isNotNull() & F.col(toxic_col).isin(0, 1)
    drawn = [F.col(toxic_col).cast("int").alias("toxic"), F.xxhash64(F.col(id_col).cast("string")).alias("h")]
    texts = items.filter(F.col(text_col).isNotNull())
    rows = texts.filter(own).select(*drawn, F.col(text_col).alias("text")) if marks is None else marks.filter(own).select(*drawn, F.col(id_col).alias("_id"))
    counts = rows.groupBy("toxic").count()
    known = {r["toxic"]: r["count"] for r in counts.collect()}
    if len(known) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), shift=-30.0)
    limit = F.lit(-(1 << 63)).cast("double") + F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count")) * F.lit(2.0**64)
    # two rows of counts, and about 2 * sample ids
    chosen = rows.join(F.broadcast(counts), "toxic").filter(F.col("h").cast("double") <= limit)
    if marks is not None:
        few = broadcast_if_small(stored(chosen.select("toxic", "_id")))
        chosen = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(few, "_id")
    chosen = stored(chosen.select("toxic", "text"))

    parts = chosen.mapInArrow(_count, "token long, toxic int, n long").groupBy("token").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("y1"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("y0"),
    )
    parts = stored(parts)
    n1, n0 = (float(x or 0) for x in parts.agg(F.sum("y1"), F.sum("y0")).first())
    if not n1 or not n0:
        return Model(np.empty(0, np.uint64), np.empty(0), shift=-30.0)
    a1, a0 = PRIOR * n1 / max(1.0, n1 + n0), PRIOR * n0 / max(1.0, n1 + n0)
    one, other = F.col("y1") + a1, F.col("y0") + a0
    odds = F.log(one / (F.lit(n1 + PRIOR) - one)) - F.log(other / (F.lit(n0 + PRIOR) - other))
    scored = parts.withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(1 / one + 1 / other))
    top = scored.filter(F.col("z") >= CLEAR).orderBy(F.desc("z"), "token").limit(TOKENS).select("token", "odds", "y0").collect()
    top = [r for r in top if r["odds"] > DRIFT]
    tokens = np.array([r["token"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    model = Model(tokens[order], np.array([r["odds"] for r in top])[order] - DRIFT)
    if not len(tokens):
        model.shift = -30.0
        return model
    chance = np.array([r["y0"] for r in top], float)[order] + a0
    model.rate = _rate(model.scores, chance / (n0 + PRIOR + a0 * len(top)))

    shared = items.sparkSession.sparkContext.broadcast(model)
    best = chosen.filter("toxic = 0").mapInArrow(_maxima(shared), "value double").agg(F.avg("value"), F.count("value")).first()
    model.log_k = (best[0] if best[1] else 0.0) - EULER
    shared = items.sparkSession.sparkContext.broadcast(model)
    bins = chosen.mapInArrow(_binned(shared), "toxic int, bin int").groupBy("toxic", "bin").count().collect()
    model.slope, model.shift = _logistic([(r["bin"] * STEP, r["toxic"], r["count"]) for r in bins])
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = text.WordHashes()
    for batch in text.pieces(batches, "text"):
        words, starts = _tokens(batch.column("text").to_pylist(), cache)
        label = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False), np.diff(starts))
        for toxic in (0, 1):
            token, n = np.unique(words[label == toxic], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(np.full(len(token), toxic), pa.int32()), pa.array(n, pa.int64())], names=["token", "toxic", "n"])


def _rate(scores: np.ndarray, chance: np.ndarray) -> float:
    """The positive root of the mean of exp(rate * score) = 1 in ordinary text; scores fall on average there."""
    rest = max(0.0, 1 - chance.sum())
    mean = lambda x: float((chance * np.exp(x * scores)).sum() + rest * np.exp(-x * DRIFT))
    low, high = 1e-6, 1e-3
    if mean(low) >= 1:
        return low
    while mean(high) < 1 and high < 100:
        low, high = high, high * 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return low


def _maxima(shared):
    """Best segment of each ordinary text on the extreme-value scale, for those that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, text.WordHashes()
        for batch in text.pieces(batches, "text"):
            out = [model.rate * max(s for _, _, s in found) - np.log(n) if found else -np.log(max(n, 1)) for n, found in _scan(model, batch.column("text").to_pylist(), cache)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64())], names=["value"])

    return run


def _binned(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, text.WordHashes()
        for batch in text.pieces(batches, "text"):
            values = [min(BINS, round(_evidence(model, n, found)[0] / STEP)) for n, found in _scan(model, batch.column("text").to_pylist(), cache)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(values, pa.int32())], names=["toxic", "bin"])

    return run


def _logistic(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (evidence, label, count) points."""
    x, y, w = (np.array(v, float) for v in zip(*points))
    w /= w.sum()
    design = np.stack([x / 10, np.ones_like(x)], 1)
    loss = lambda v: float((w * (np.logaddexp(0, design @ v) - y * (design @ v))).sum() + 5e-6 * v @ v)
    theta = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        grad = design.T @ (w * (y - p)) - 1e-5 * theta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-5 * np.eye(2)
        step, now = np.linalg.solve(hess, grad), loss(theta)
        while loss(theta + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        theta = theta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]) / 10, float(theta[1])


# --- scoring ------------------------------------------------------------------------------------


def score(items: DataFrame, model: Model, id_col: str = "path", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (0 to 1), ``n_tokens``, ``segments``: the significant passages as (first, last, evidence).

    Whole texts of any length; NULL and empty texts have no passage and the score of a text without one. Tokens are cut at white
    space and ASCII punctuation, A-Z lower-cased; ``first`` and ``last`` count tokens from 0. Repeated rows score alike.
    """
    passage = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("evidence", T.DoubleType())])
    schema = text.plus(items, id_col, [("score", T.DoubleType()), ("n_tokens", T.LongType()), ("segments", T.ArrayType(passage))])
    shared = items.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, text.WordHashes()
        for batch in text.pieces(batches, "text"):
            counts, values, spans = [], [], []
            for n, found in _scan(m, batch.column("text").to_pylist(), cache):
                total, rare = _evidence(m, n, found)
                counts.append(n)
                values.append(1 / (1 + np.exp(-np.clip(m.slope * total + m.shift, -30, 30))))
                spans.append([{"first": a, "last": b, "evidence": float(e)} for a, b, e in rare])
            yield text.record(batch.column("id"), schema, [values, counts, spans])

    return items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
