"""Every stage of the corpus pipeline against a plain rule over its own input, and the chain of all."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from labelops.llm import packing

WORDS = {"en": "the old river runs past seven quiet farms where people grow apples and sell bread on market days under tall trees".split(),
         "es": "el viejo río pasa junto a siete granjas donde la gente cultiva manzanas y vende pan los días de mercado bajo árboles".split()}
ITEM = "which of these seven planets has the longest day and the shortest year of them all in our system"


def make(rnd, lang, n):
    words = [rnd.choice(WORDS[lang]) + rnd.choice(["", "", "s", "x", "o"]) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd = random.Random(12)
    rows = [(i, make(rnd, ("en", "es")[i % 2], rnd.choice([40, 90, 200])), ("en", "es")[i % 2], "src", 7) for i in range(44)]
    texts = {r[0]: r[1] for r in rows}
    odd = [(50, None), (51, ""), (52, "123 456 !"), (53, texts[3]), (54, texts[4].replace("river", "rivers", 1)), (55, f"{make(rnd, 'en', 30)} {ITEM} {make(rnd, 'en', 30)}"),
           (56, texts[5].split("\n")[0] + "\n" + make(rnd, "es", 60)), (57, texts[6].split("\n")[0] + "z\n" + make(rnd, "en", 60)), (None, make(rnd, "en", 50)), (58, "word " * 3000)]
    rows += [(i, t, "en", "src", 7) for i, t in odd]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def near(a, b, edits):
    if abs(len(a) - len(b)) > edits:
        return False
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j: min(left + 1, row[j] + 1, row[j - 1] + (c != b[j - 1])), initial=i))
    return row[-1] <= edits


def tolerance(a, b):
    n = min(len(a), len(b))
    return 2 if n >= 25 else 1 if n >= 12 else 0


def without_repeated_lines(docs):
    places = [(d is not None, d or 0, n, x) for d, t in docs for n, x in enumerate((t or "").split("\n")) if t is not None]
    lines = sorted({p[3] for p in places})
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(lines, 2):
        if tolerance(a, b) and near(a, b, tolerance(a, b)):
            root[find(b)] = find(a)
    first = {}
    for p in sorted(places):
        first.setdefault(find(p[3]), p[:3])
    keep = lambda d, n, x: not x.strip(" \t\n\x0b\x0c\r") or first[find(x)] == (d is not None, d or 0, n)
    return {d: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if keep(d, n, x)) for d, t in docs}


def fingerprint(t):
    w = (t or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stages_and_chain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] if name != "packing" else before_packing
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        texts = dict(before)
        if name == "language_id":
            assert after == {d: t for d, t in before if t is not None and re.search(r"[^\W\d_]", t)}
        elif name == "line_dedup":
            assert after == without_repeated_lines(before)
            assert {r["doc_id"]: r["n_chars"] for r in docs.collect()} == {d: len(t) for d, t in after.items()}
        elif name == "near_dedup":
            prints = {d: fingerprint(t) for d, t in before}
            label = {d: d for d in prints}
            for a, b in itertools.combinations(prints, 2):
                if (prints[a] ^ prints[b]).bit_count() <= 4 and label[a] != label[b]:
                    small, large = sorted((label[a], label[b]), key=lambda d: (d is not None, d or 0) if None in (label[a], label[b]) else (True, d))
                    if small is None:
                        small, large = large, small
                    label = {d: small if x == large else x for d, x in label.items()}
            assert after == {d: t for d, t in before if label[d] == d}
            assert len(after) < len(before)
        else:
            assert after == {d: t for d, t in before if ITEM not in (t or "")} and len(after) == len(before) - 1
        seen.append(name)
        before_packing = list(after.items())
    assert seen == ["language_id", "line_dedup", "near_dedup", "decontamination"]
    tokenizer = packing.UnitIds(packing.default_tokenizer()).whole
    want = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in before_packing}
    for pieces in (docs.collect(), corpus_pipeline.run(spark, sf_dir).collect()):
        found = {}
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert len(found.setdefault(r["doc_id"], [])) == r["start"]
            found[r["doc_id"]] += np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert found == want


def test_stages_on_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
