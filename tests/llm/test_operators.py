"""Numbered operators against brute force, with NULLs, empty tables, repeated rows and clashing columns."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelops.lineage import CLEANUP
from labelops.llm import brown, components, decontaminate, language, line_dedup, line_frequency, near_groups, ownership, packing, page_text, toxicity
from labelops.llm import text as text_batches

SCHEMA = "path long, text string, source string, h long, score double, line_no int, first int"


def frame(spark, texts, sources=None):
    """Items with columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, (sources or {}).get(i, "s"), 1, 0.5, 3, 2) for i, t in texts], SCHEMA)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j: min(left + 1, row[j] + 1, row[j - 1] + (c != b[j - 1])), initial=i))
    return row[-1]


def test_within_edits(spark):
    rnd = random.Random(3)
    pairs = []
    for _ in range(300):
        a = "".join(rnd.choice("abé ") for _ in range(rnd.randint(1, 9)))
        b = list(a)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(b))
            b[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "é"])
        pairs.append((a, "".join(b)))
    pairs += [("", "ab"), ("", ""), ("abc", "")]
    got = spark.createDataFrame(pairs, "a string, b string").withColumn("near", line_dedup.within_edits(F.col("a"), F.col("b"), 2)).collect()
    assert [(r["a"], r["b"]) for r in got if r["near"] != (distance(r["a"], r["b"]) <= 2)] == []


def test_line_links_and_dedup(spark):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(40)) for _ in range(12)]
    lines = list(base)
    for x in base:
        for _ in range(3):
            y = list(x)
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(y))
                y[at : at + rnd.randint(0, 1)] = rnd.choice(["", "z", "a"])
            lines.append("".join(y))
    rnd.shuffle(lines)
    texts = [(i, "\n".join(lines[i * 6 : i * 6 + 6] + ["short"])) for i in range(8)] + [(100, None), (101, "")]
    docs = frame(spark, texts)
    got = {(r["path"], r["line_no"]): r for r in line_dedup.line_links(docs).collect()}
    places = [(i, n, x) for i, t in texts for n, x in enumerate((t or "").split("\n")) if len(x) >= 25]
    assert set(got) == {(i, n) for i, n, _ in places}
    group = {p: p for p in got}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for (i, n, x), (j, m, y) in itertools.combinations(places, 2):
        if distance(x, y) <= 2:
            a, b = sorted((root((i, n)), root((j, m))))
            group[b] = a
    for i, n, x in places:
        near = {y for _, _, y in places if y != x and distance(x, y) <= 2}
        r = got[i, n]
        assert (r["first_path"], r["first_line_no"], r["n_links"], r["kept"]) == (*root((i, n)), len(near), root((i, n)) == (i, n))
    kept = {r["path"]: r["text"] for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert kept[100] is None and kept[101] == ""
    for i, t in texts[:8]:
        assert kept[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if len(x) < 25 or root((i, n)) == (i, n))
    assert line_dedup.line_links(docs.limit(0)).count() == 0 and line_dedup.drop_repeated_lines(docs).columns == docs.columns


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_simhash(spark):
    texts = [(1, "One two THREE four five Ünd"), (2, "a b"), (3, ""), (4, None), (5, "x \t y\n z w v " * 50)]

    def brute(t):
        w = (t or "").encode().lower().split()
        shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = {r["path"]: r["simhash"] % 2**64 for r in near_groups.simhash(frame(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in texts}


@pytest.mark.parametrize("cell", [4096, 16])
def test_near_groups_of_perceptual_hashes(spark, cell, monkeypatch):
    """A dense ball of fingerprints, exact copies and lone ones; small cells force hot buckets to be dealt over slices."""
    monkeypatch.setattr(near_groups, "CELL", cell)
    rnd = random.Random(7)
    center = rnd.getrandbits(64)
    words = [center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(150)] + [rnd.getrandbits(64) for _ in range(150)]
    words += [0] * 5 + [words[0]] * 40
    rows = [(i, w - 2**64 if w >> 63 else w, "x") for i, w in enumerate(words)] + [(1000, None, "x")]
    profile = spark.createDataFrame(rows, "path long, perceptual_hash long, node string")
    got = {r["path"]: r["group"] for r in near_groups.near_groups(profile).collect()}
    label = list(range(len(words)))
    for i, j in itertools.combinations(range(len(words)), 2):
        if (words[i] ^ words[j]).bit_count() <= 4 and label[i] != label[j]:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    assert got == {**dict(enumerate(label)), 1000: 1000}
    assert near_groups.near_groups(profile.limit(0)).count() == 0


def test_masks_meet_every_near_pair():
    rnd = random.Random(2)
    for n in (10, 10**6, 10**10):
        masks = near_groups.masks(n, 4)
        for _ in range(300):
            flipped = sum(1 << b for b in rnd.sample(range(64), 4))
            assert any(flipped & m == 0 for m in masks)


def test_benchmark_overlaps(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    make = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [make(30), make(9), make(3), make(20)]
    spoiled = list(items[0])
    for at in (5, 11, 17, 23):
        spoiled[at] = "zzz"
    far = [w if i % 3 else "zzz" for i, w in enumerate(items[3])]
    texts = [(1, " ".join(make(50) + items[0] + make(9)).upper()), (2, " ".join(make(20) + spoiled + make(3))), (3, "\n".join(items[1])),
             (4, " ".join(make(20) + far)), (5, " ".join(items[2])), (6, None), (7, ""), (8, " ".join(make(300)))]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None)], "item_id int, text string")
    docs = frame(spark, texts)
    got = {(r["path"], r["item_id"]): (r["start"], r["item_start"], r["words"], r["equal"]) for r in decontaminate.benchmark_overlaps(docs, bench).collect()}
    assert got == {(1, 0): (50, 0, 30, 30), (2, 0): (20, 0, 30, 26), (3, 1): (0, 0, 9, 9)}
    assert sorted(r["path"] for r in decontaminate.drop_contaminated(docs, bench).collect()) == [4, 5, 6, 7, 8]
    assert decontaminate.benchmark_overlaps(docs, bench.limit(0)).count() == 0 and decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0


def test_token_units():
    units = packing.UnitIds(packing.default_tokenizer())
    rnd = random.Random(1)
    alphabet = list("ab1é,.!'s \n\t  日¹ ½-_\r\x0b\x1c\u0085🙂́")
    for _ in range(4000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14)))
        assert np.frombuffer(units.of(t), "<u4").tolist() == units.tokenizer.encode(t, add_special_tokens=False).ids


def test_pack_round_trip(spark):
    rnd = random.Random(4)
    texts = [(i, " ".join(rnd.choice(("alpha", "beta,", "Straße.\nNeu", "x")) for _ in range(rnd.choice((3, 40, 200, 700, 1500))))) for i in range(150)]
    texts += [(900, None), (901, ""), (902, "twice"), (902, "twice"), (None, "no id")]
    pieces = packing.pack(frame(spark, texts)).collect()
    tokenizer = packing.UnitIds(packing.default_tokenizer()).tokenizer
    for i, t in texts:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted((p for p in pieces if p["path"] == i), key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == len(ids) * sum(x[0] == i for x in texts)
        for p in own:
            assert zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] and p["path_tokens"] == len(ids)
    total = 0
    for _, group in itertools.groupby(sorted(pieces, key=lambda p: (p["sequence"], p["offset"])), key=lambda p: p["sequence"]):
        at = 0
        for p in group:
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        total += 1
    tokens = sum(p["length"] for p in pieces)
    assert tokens > 0.97 * 2048 * (total - 1)
    assert packing.pack(frame(spark, texts).limit(0)).count() == 0


def test_repeats_never_exceed_the_histogram():
    rng = np.random.default_rng(0)
    combos = packing.combinations(32)
    for scale in (1, 50, 5000):
        counts = np.concatenate(([0], rng.integers(0, scale, 32)))
        times = packing.repeats(combos, counts.astype(float))
        used = np.zeros(33, int)
        for combo, n in zip(combos, times):
            for c in combo[combo > 0]:
                used[c] += n
        assert (times >= 0).all() and (used <= counts).all()
    assert used.sum() > 0.5 * counts.sum()


def test_forward_sums_all_segmentations():
    names = ["a", "b", "ab", "ba", "aba", "▁", "▁a"]
    pieces = language.Pieces(names)
    chances = np.random.default_rng(1).random((len(names), 2)) / 10

    def brute(word):
        if not word:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, len(word) + 1):
            piece = word[:n]
            if piece in names:
                total += chances[names.index(piece)] * brute(word[n:])
            elif n == 1:
                total += language.RARE * brute(word[n:])
        return total

    words = ["▁ab", "▁abaab", "▁é", "▁", "▁bababab"]
    assert np.allclose(language.word_scores(words, pieces, chances), np.log([brute(w) for w in words]))
    assert np.allclose(language.long_word(words[1], pieces.index, pieces.longest, chances), np.log(brute(words[1])))
    _, ends, sizes = pieces.spans(["▁abab"])
    uses = language.expected(ends, sizes, chances[:, 0].copy(), np.ones(1))
    assert np.isclose(sum(u * len(n) for u, n in zip(uses, names)), 5)


def test_identify(spark):
    sample = {"en": "the and that with this from have they would there ", "de": "der und nicht mit dieser haben werden für über ich "}
    rnd = random.Random(0)
    rows = [(i, " ".join(rnd.sample(sample[k].split(), 8)), k) for i, k in enumerate(["en", "de"] * 40)]
    docs = spark.createDataFrame([*rows, (500, None, "en"), (501, "12 34 --", None), (502, "", "de")], "path long, text string, lang string")
    model = language.learn(docs)
    got = {r["path"]: r for r in language.identify(docs, model).collect()}
    assert all(got[i]["lang_pred"] == k and got[i]["score"] > 0.9 for i, _, k in rows)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert language.keep_identified(docs, model).count() == 80
    nothing = language.learn(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def test_segments_are_the_best_disjoint_ones():
    rnd = random.Random(6)
    for _ in range(200):
        scored = sorted(rnd.sample(range(40), 8))
        values = [rnd.uniform(0.1, 3) for _ in scored]
        line = np.full(40, -0.5)
        line[scored] = values
        found = toxicity.segments(scored, values, 0.5)
        sums = np.concatenate(([0], np.cumsum(line)))
        best = max(sums[b] - sums[a] for a in range(41) for b in range(a, 41))
        assert np.isclose(max(s for _, _, s in found), best)
        assert all(np.isclose(sums[b + 1] - sums[a], s) for a, b, s in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))


def test_toxicity(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(300):
        body = [rnd.choice(words) for _ in range(60)]
        if i % 3 == 0:
            body[20:23] = ["vile,", "Vile", "rotten"]
        rows.append((i, " ".join(body), int(i % 3 == 0)))
    docs = spark.createDataFrame([*rows, (900, None, None), (901, "", 0)], "path long, text string, toxic int")
    model = toxicity.learn(docs.filter("path % 5 > 0"))
    got = {r["path"]: r for r in toxicity.score(docs, model).collect()}
    assert all((got[i]["score"] >= 0.5) == bool(y) for i, _, y in rows)
    assert got[900]["score"] == got[901]["score"] < 0.5 and got[0]["segments"][0]["first"] == 20 and got[0]["segments"][0]["last"] == 22
    assert max(r["score"] for r in toxicity.score(docs, toxicity.learn(docs.filter("toxic = 0"))).collect()) < 1e-6


def test_page_text(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></ul></nav>
    <div class="ad">Buy now.</div><article><h1>Head&nbsp;line</h1><p>First  <b>bold</b> &amp; text.<br><p>Second one.</p><aside>Aside note.</aside>
    <div class="comments"><p>I think so.</p></div></article><footer>&copy; x.</footer>"""
    pages = spark.createDataFrame([(i, f"u{i}", page) for i in range(20)] + [(90, "u", None), (91, "u", ""), (92, "u", "<<p")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in page_text.main_text(pages, page_text.learn(pages)).collect()}
    assert got[0]["text"] == "Head line\nFirst bold & text.\nSecond one." and got[0]["n_chars"] == len(got[0]["text"])
    assert [(got[i]["text"], got[i]["n_chars"]) for i in (90, 91)] == [("", 0)] * 2
    assert page_text.main_text(pages, page_text.learn(pages.limit(0))).count() == 23


def test_chain_sums():
    rng = np.random.default_rng(2)
    scores = [(0.0, float(x)) for x in rng.normal(size=5)]
    moves = rng.normal(size=4).tolist()
    weight = {s: np.exp(sum(scores[i][y] for i, y in enumerate(s)) + sum(moves[2 * a + b] for a, b in zip(s, s[1:]))) for s in itertools.product((0, 1), repeat=5)}
    total = sum(weight.values())
    ones, used = page_text.marginals(scores, moves)
    assert np.allclose(ones, [sum(w for s, w in weight.items() if s[i]) / total for i in range(5)])
    assert np.isclose(sum(map(sum, used)), 4)
    names = [[str(i)] for i in range(5)]
    model = {"weights": {str(i): s[1] for i, s in enumerate(scores)}, "moves": moves}
    assert tuple(page_text.decode(names, model)) == max(weight, key=weight.get)


def test_quality_and_line_frequency(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, "\n".join(" ".join(rnd.choice(words) for _ in range(12)) for _ in range(rnd.randint(1, 9)))) for i in range(12)]
    texts += [(i, "Shared  LINE 1\n" + " ".join("own" + chr(77 + i) + chr(97 + j % 26) * (1 + j // 26) for j in range(55))) for i in range(20, 26)]
    texts += [(i, "\n".join(f"boiler {j} plate of the host is here" for j in range(12)) + f"\nown {i}") for i in range(30, 36)]
    texts += [(50, None), (51, ""), (52, "a b c " * 300), (53, "#x $y\n#x $y")]
    got = {r["path"]: r for r in line_frequency.quality(frame(spark, texts, {35: "other"}), max_docs=4).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + d for k, x in enumerate(windows) if windows.count(x) > 1 for d in range(3)} if len(w) < 1000 else set(range(len(w)))
        lines = [x for x in t.split("\n") if x.strip()]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert all(got[i]["kept"] and got[i]["n_removed"] == 3 for i in range(20, 26))
    assert not any(got[i]["kept"] for i in range(30, 35)) and got[35]["kept"] == (not got[35]["base_failed"])


def test_secrets(spark):
    live, shared = "q8Zx0011aaBBcc", "EXAMPLEexample99"
    issued = "ghp_" + "Ab1" * 13
    texts = [(1, f"é token = '{live}' and hex {'0f' * 16} AKIA{'Z' * 12}"), (2, f"password: {shared}"), (3, f"PASSWORD={shared} token=secret:abcdefghij"),
             (4, f"x {issued} y"), (5, None), (6, ""), (7, "token: short")]
    got = {r["path"]: r for r in ownership.secrets(frame(spark, texts, {2: "a", 3: "b"})).collect()}
    spans = [("assign", 2, 2 + len(f"token = '{live}")), ("hex", texts[0][1].index("0f0f"), 32), ("access", texts[0][1].index("AKIA"), 16)]
    spans = [spans[0], *[(k, a, a + n) for k, a, n in spans[1:]]]
    assert got[1]["base_spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert [got[1][f"n_{k}"] for k in ("assign", "access", "hex")] == [1, 1, 1] and got[1]["n_live"] == 3
    text3 = texts[2][1]
    end = text3.index(" token")
    assert got[3]["base_spans"] == f"assign:0:{end}" and got[3]["n_live"] == got[2]["n_live"] == 0
    assert got[4]["base_spans"] == "" and got[4]["spans"] == got[4]["live_spans"] == f"forge:2:{2 + len(issued)}"
    assert [got[i]["spans"] for i in (5, 6, 7)] == ["", "", ""]
    assert ownership.secrets(frame(spark, texts).limit(0)).count() == 0


def test_class_model(spark):
    rnd = random.Random(12)
    en, de = ["the", "cat", "sat", "on", "mat"], ["der", "hund", "und", "die", "katze"]
    texts = [(i, " ".join(rnd.choice(en if i % 2 else de) for _ in range(30))) for i in range(60)] + [(90, None), (91, ""), (92, "unheard words Cat")]
    docs = frame(spark, texts)
    model, counts = brown.learn(docs.filter("path < 50"), words=20, forms=5, classes=4)
    got = {r["path"]: r for r in brown.score(docs, model, counts).collect()}
    table: dict = {}
    for i, t in texts:
        if i < 50:
            for w in [*t.split(), None]:
                table[w] = table.get(w, 0) + 1
    n, v = sum(table.values()), len(table)
    for i, t in texts:
        words = [*(t or "").lower().split(), None]
        assert np.isclose(got[i]["base_score"], sum(np.log10((table.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(words), sum(w in table for w in words), n)
    assert sum(got[i]["score"] for i in range(50, 60)) > sum(got[i]["base_score"] for i in range(50, 60))
    # after any class the probabilities of all words and of one unheard word per class add up to one
    share = (model.uses + 0.1 * (model.kinds + 1)) / model.uses.clip(0.1 * (model.kinds + 1))
    assert np.allclose((10 ** model.moves).sum(1), 1) and (share >= 1).all()


def odd_documents(spark):
    """NULLs in every column, empty and long texts, repeated rows, and columns named like those added inside."""
    line = "one line of some length that every copy of it repeats"
    body = " ".join(f"w{i % 97}" for i in range(60))
    rows = [(1, body, "s"), (2, body, None), (2, body, None), (3, None, "s"), (4, "", None), (None, body + " own", "s"), (None, None, None),
            (5, "\n".join([line, line, "x"]), "s"), (6, "long " * 200_000, "s"), (7, "\n", "s"), (8, " \t ", "s"), (9, "ünï 日本 🙂 " * 20, "s")]
    docs = spark.createDataFrame(rows, "path long, text string, source string")
    for name in ("row", "gone_id", "row_id", "body", "_gone", "_text", "_id", "id", "hash", "group", "line", "word", "chunk", "spans", "words", "n", "toxic", "lang"):
        docs = docs.withColumn(name, F.lit(None).cast("string") if name in ("toxic", "lang") else F.lit("clash"))
    return docs


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents(spark, empty):
    """No operator loses or invents rows: one result a row, an empty table gives an empty one."""
    docs = odd_documents(spark)
    docs = docs.limit(0) if empty else docs
    n = 0 if empty else 12
    assert toxicity.score(docs, toxicity.learn(docs.withColumn("toxic", F.lit(None).cast("int")))).count() == n
    assert language.identify(docs, language.learn(docs)).filter("lang_pred = 'und'").count() == n
    assert brown.score(docs, *brown.learn(docs, words=10, forms=3, classes=2)).count() == n
    assert line_frequency.quality(docs).count() == n
    assert ownership.secrets(docs).count() == n
    assert near_groups.near_groups(near_groups.simhash(docs), "path", "simhash").count() == n
    pieces = packing.pack(docs)
    assert pieces.filter("start = 0").count() == n
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (None, None), (2, "")], "item_id int, text string")
    assert sorted(str(r["path"]) for r in decontaminate.benchmark_overlaps(docs, bench).collect()) == ([] if empty else ["1", "2", "2", "None"])
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == n
    if not empty:
        texts = {r["path"]: r["text"] for r in left.filter("path is not null").collect()}
        assert texts[5] == "one line of some length that every copy of it repeats\nx" and texts[3] is None and texts[6] == "long " * 200_000
        groups = {r["path"]: r["group"] for r in near_groups.near_groups(near_groups.simhash(docs), "path", "simhash").filter("path is not null").collect()}
        assert groups[1] == groups[2] == 1 and groups[3] == groups[4] == groups[7] == groups[8] == 3


def test_class_model_places_rare_words_by_their_neighbours(spark):
    """Words beyond the frequent ones that share an ending but not their neighbours fall into different classes."""
    rnd = random.Random(13)
    sides = [["the", "cat", "sat", "on", "mat"], ["der", "hund", "und", "die", "katze"]]
    rare = [[f"{x}{i}ing" for i in range(6)] for x in "pq"]
    texts = [(i, " ".join(rnd.choice(rare[i % 2] if j % 7 == 3 else sides[i % 2]) for j in range(30))) for i in range(120)]
    model, counts = brown.learn(frame(spark, texts), words=10, forms=3, classes=4)
    found = {bytes(r["word"]).decode(): r for r in counts.collect()}
    words = [w for _, t in texts for w in t.split()]
    assert {w: r["n"] for w, r in found.items()} == {**{w: words.count(w) for w in words}, " ": len(texts)}
    one, two = ({found[w]["class"] for w in side} for side in rare)
    assert not one & two
    # transitions and class sizes are those of the words' final classes
    moves, sizes = np.zeros((4, 4)), np.zeros(4)
    for _, t in texts:
        row = [found[w]["class"] for w in [" ", *t.split(), " "]]
        np.add.at(moves, (row[:-1], row[1:]), 1)
        np.add.at(sizes, row[1:], 1)
    assert np.allclose(10**model.moves, (moves + 0.1) / (moves.sum(1, keepdims=True) + 0.4)) and (model.uses == sizes).all()


def test_pack_returns_the_token_ids(spark):
    rnd = random.Random(14)
    texts = [(i, " ".join(rnd.choice(("alpha", "beta,", "Straße.\nNeu", "x")) for _ in range(rnd.choice((3, 40, 700, 5000))))) for i in range(40)] + [(90, None), (91, "")]
    pieces = packing.pack(frame(spark, texts)).collect()
    tokenizer = packing.UnitIds(packing.default_tokenizer()).tokenizer
    for i, t in texts:
        own = sorted((p for p in pieces if p["path"] == i), key=lambda p: p["start"])
        assert np.frombuffer(b"".join(bytes(p["ids"]) for p in own), "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        assert all(len(p["ids"]) == 4 * p["length"] and zlib.crc32(bytes(p["ids"])) == p["ids_crc32"] for p in own)


def test_quality_returns_texts_without_frequent_lines(spark):
    texts = [(i, f"Shared  LINE {i}\n\nown {chr(97 + i)}\n shared line 7") for i in range(6)] + [(50, None), (51, ""), (52, "shared line 1\nend"), (53, "shared line 1")]
    got = {r["path"]: r for r in line_frequency.quality(frame(spark, texts, {52: "other"}), max_docs=4).collect()}
    # each document counts once for a line, digits count as zeros, and hosts are told apart
    assert {i: (got[i]["text"], got[i]["n_removed"]) for i, _ in texts} == {
        **{i: (f"\nown {chr(97 + i)}", 6) for i in range(6)}, 50: (None, 0), 51: ("", 0), 52: (texts[8][1], 0), 53: ("", 3)}


def test_page_text_skips_raw_elements_whole():
    """A '<' before a letter inside script, style and the like must not swallow their end tag."""
    for raw in ("<script>for(i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b&&c>'d){}</Script >", "<style>a<b{}</style>", "<textarea>x<y \"</textarea>",
                "<iframe><p 'x</iframe>", "<svg><script>i<n</script></svg>", "<script>s='<!--'</script>", "<template><style>a<b</style></template>"):
        assert [b[0] for b in page_text.blocks(f"<p>Before.</p>{raw}<article><p>Body text.</p></article>")] == ["Before.", "Body text."], raw
    assert [b[0] for b in page_text.blocks("<title>a <b &amp; c</title><p>Body text.</p><script>open<x")] == ["a <b & c", "Body text."]


def test_line_links_of_every_line(spark):
    """Short lines have rows too: from 12 characters on one edit links them, below that only exact copies."""
    rnd = random.Random(15)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in (1, 3, 8, 11, 12, 13, 18, 23, 24, 24, 25, 25, 26, 26, 27, 40)]
    lines = [*base, "", "", " ", "yes", "yes", "yet"]
    for x in base:
        for k in (0, 1, 1, 2, 2, 3):
            y = list(x)
            for _ in range(k):
                at = rnd.randrange(len(y) + 1)
                y[at : at + rnd.randint(0, 1)] = rnd.choice(["", "z", "a"])
            lines.append("".join(y))
    rnd.shuffle(lines)
    texts = [(i, "\n".join(lines[i * 9 : i * 9 + 9])) for i in range(-(-len(lines) // 9))] + [(100, None), (101, "")]
    docs = frame(spark, texts)
    got = {(r["path"], r["line_no"]): r for r in line_dedup.line_links(docs, min_chars=0).collect()}
    places = [(i, n, x) for i, t in texts if t is not None for n, x in enumerate(t.split("\n"))]
    assert set(got) == {(i, n) for i, n, _ in places}

    def near(x, y):
        n = min(len(x), len(y))
        return distance(x, y) <= (2 if n >= 25 else 1 if n >= 12 else 0)

    group = {p: p for p in got}
    for (i, n, x), (j, m, y) in itertools.combinations(places, 2):
        if near(x, y) and group[i, n] != group[j, m]:
            a, b = sorted((group[i, n], group[j, m]))
            group = {p: a if g == b else g for p, g in group.items()}
    for i, n, x in places:
        r, first = got[i, n], group[i, n]
        links = len({y for _, _, y in places if y != x and near(x, y)})
        assert (r["first_path"], r["first_line_no"], r["n_links"], r["kept"]) == (*first, links, first == (i, n)), x
    kept = {r["path"]: r["text"] for r in line_dedup.drop_repeated_lines(docs, min_chars=0).collect()}
    for i, t in texts:
        assert kept[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if not x.strip() or group[i, n] == (i, n)))


def test_learning_from_long_words(spark):
    """Expected uses in a long word are those of the dense sums, and languages without spaces are learned."""
    names = ["a", "b", "ab", "ba", "aba", "▁", "▁a"]
    pieces = language.Pieces(names)
    chances = np.random.default_rng(3).random(len(names)) / 10
    for word in ("▁abaab", "▁éab", "▁" + "abbaé" * 4):
        _, ends, sizes = pieces.spans([word])
        uses = np.zeros(len(names))
        language.expected_long(word, pieces.index, pieces.longest, chances, 2.0, uses)
        assert np.allclose(uses, 2 * language.expected(ends, sizes, chances, np.ones(1)))
    endless = np.zeros(len(names))
    language.expected_long("▁" + "ab" * 3000, pieces.index, pieces.longest, chances, 1.0, endless)
    assert np.isclose(sum(u * len(n) for u, n in zip(endless, names)), 6001)
    sample = {"ja": "のにをはがとしたですまる", "zh": "的是不了在人有我他这中大"}
    rnd = random.Random(16)
    rows = [(i, "".join(rnd.choice(sample[k]) for _ in range(77)), k) for i, k in enumerate(["ja", "zh"] * 20)]
    docs = spark.createDataFrame(rows, "path long, text string, lang string")
    got = {r["path"]: r for r in language.identify(docs, language.learn(docs)).collect()}
    assert all(got[i]["lang_pred"] == k and got[i]["score"] > 0.9 for i, _, k in rows)


def test_short_benchmark_items(spark):
    """Items under eight words are met with one replaced word at any place inside, those under five words where all are equal."""
    items = [[f"i{n}w{k}" for k in range(n)] for n in range(1, 9)]
    texts, wanted = [], {}
    for i, item in enumerate(items):
        for at in [None, *range(len(item))]:
            body = [w if k != at else "zzz" for k, w in enumerate(item)]
            texts.append((len(texts), " ".join(["x", "y", *body, "z"])))
            n = len(item)
            if at is None or n >= 5 and 0 < at < n - 1:
                wanted[len(texts) - 1, i] = (2, 0, n, n - (at is not None))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(90, ""), (91, None)], "item_id int, text string")
    docs = frame(spark, [*texts, (900, None), (901, "")])
    found = lambda **more: {(r["path"], r["item_id"]): (r["start"], r["item_start"], r["words"], r["equal"]) for r in decontaminate.benchmark_overlaps(docs, bench, **more).collect()}
    assert found(min_item_words=1) == wanted
    assert found() == {k: v for k, v in wanted.items() if v[2] >= 5}


def test_marks_of_their_own(spark):
    """Marks in a frame of their own give the model that a column gives; marks of unknown ids and NULL ids count for nothing."""
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["vile", "foul"] if i % 2 and rnd.random() < 0.4 else ["calm", "blue", "tree", "sun"]) for _ in range(30)), i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "path long, text string, toxic int")
    one = toxicity.learn(docs)
    marks = docs.select("path", "toxic").unionByName(spark.createDataFrame([(None, 1), (7, 5)], "path long, toxic int"))
    two = toxicity.learn(docs.drop("toxic"), marks=marks)
    assert (one.tokens == two.tokens).all() and np.allclose(one.scores, two.scores) and np.isclose(one.slope, two.slope)
    assert toxicity.learn(docs.drop("toxic"), marks=marks.withColumn("path", F.col("path") + 1000)).shift == -30.0


@pytest.mark.parametrize("crowd,part", [(2, 3), (500, 500)])
def test_crowded_keys(spark, crowd, part, monkeypatch):
    """Many lines of one length with a common part; dealt in slices or not, all links are found."""
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "SLICE", part)
    lines = [f"Page {i:06d} of the yearly report on weather." for i in range(0, 3000, 37)] + [f"Page {i} of the yearly report on weather" for i in (1, 2)]
    docs = frame(spark, [(i, x) for i, x in enumerate(lines)])
    got = {r["path"]: r["n_links"] for r in line_dedup.line_links(docs, min_chars=0).collect()}
    assert got == {i: sum(j != i and distance(x, y) <= 2 for j, y in enumerate(lines)) for i, x in enumerate(lines)}


def test_languages_that_nothing_is_sure_of(spark):
    docs = spark.createDataFrame([(i, "uno dos tres" if i % 2 else "one two three", ["es", "en"][1 - i % 2]) for i in range(40)], "path long, text string, lang string")
    model = language.learn(docs)
    odd = spark.createDataFrame([(1, "uno dos", 1), (1, None, 2), (None, "three two", 3), (2, "123 !", 4)], "path long, text string, row int")
    assert sorted(r["row"] for r in language.keep_identified(odd, model).collect()) == [1, 3]
    assert language.keep_identified(odd, model, min_score=1.1).count() == 0 and language.keep_identified(odd, model).columns == odd.columns


def test_added_tokens_keep_their_ids(spark):
    """A text with an added token gives what the unchanged tokenizer gives."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    units, narrow = packing.UnitIds(packing.default_tokenizer()), packing.UnitIds(packing.default_tokenizer(), "H")
    added = plain.get_added_tokens_decoder()[50256].content
    rnd = random.Random(8)
    for _ in range(600):
        t = "".join(rnd.choice([added, added[:-1], "ab", " ", "\n", "1,", "é", " Word."]) for _ in range(rnd.randint(0, 9)))
        want = plain.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(units.of(t), "<u4").tolist() == want == np.frombuffer(narrow.of(t), "<u2").tolist()
    (piece,) = packing.pack(frame(spark, [(1, f"a {added} b")])).collect()
    assert np.frombuffer(bytes(piece["ids"]), "<u4").tolist() == plain.encode(f"a {added} b", add_special_tokens=False).ids + [1] and 50256 in np.frombuffer(bytes(piece["ids"]), "<u4")


@pytest.mark.parametrize("n", [5, 200, 1000, 100_000])
def test_the_plan_places_most_texts(n):
    """Thin histograms too: every text has one place or a part of the stream, windows are not overfull, few texts are cut."""
    rng = np.random.default_rng(n)
    drawn = np.clip(rng.lognormal(6, 1, n).astype(int), 1, 2047)
    lengths = dict(zip(*[x.tolist() for x in np.unique(drawn, return_counts=True)]))
    places, stream, windows = packing.plan(lengths)
    load, placed = np.zeros(windows, int), np.zeros(257, int)
    for c, a, b, first, _ in places:
        assert placed[c] == a and first + b - a <= windows
        placed[c] = b
        load[first : first + b - a] += 8 * c
    assert load.max(initial=0) <= 2048 and (placed <= np.bincount(-(-drawn // 8), minlength=257)).all()
    over = sum(max(0, first + lengths[length] - max(left, first)) for length, first, left, *_ in stream)
    assert placed.sum() + over == n
    if n >= 200:
        assert over < 0.15 * n and load.mean() > 0.95 * 2048


def test_greedy_residuals():
    left = np.zeros(257, np.int64)
    left[[200, 56, 128, 100, 3]] = [5, 3, 2, 1, 7]
    found = packing.residuals(left, 256)
    used = np.zeros(257, np.int64)
    for parts, times in found:
        assert 0.97 * 256 <= sum(parts) <= 256
        np.add.at(used, list(parts), times)
    assert (used <= left).all() and used[200] == 3 and used[128] == 2


def test_class_model_scores_by_hand(spark):
    """``score`` from transitions and class counts made anew, text by text; one pass over the texts gives what two give."""
    rnd = random.Random(5)
    texts = [(i, " ".join(rnd.choice(["the", "a", "cat", "dog", f"w{rnd.randint(0, 30)}", "sat"]) for _ in range(rnd.randint(0, 12)))) for i in range(60)] + [(100, None), (101, "neverseen cat"), (None, "the cat")]
    docs = frame(spark, texts)
    train = F.col("path") < 40
    model, counts = brown.learn(docs.filter(train), words=10, forms=4, classes=4)
    known = {bytes(r["word"]): (r["n"], r["class"]) for r in counts.collect()}
    words = lambda t: [w for w in (t or "").lower().encode().split()] + [brown.END]
    kind = lambda w: known[w][1] if w in known else int(model.classes[model.unit(w)])
    moves = np.zeros((4, 4))
    for i, t in texts:
        if i is not None and i < 40:
            row = [brown.END, *words(t)]
            for a, b in zip(row, row[1:]):
                moves[kind(a), kind(b)] += 1
    chance = (moves + 0.1) / (moves.sum(1, keepdims=True) + 0.4)
    uses, kinds = np.zeros(4), np.zeros(4)
    for n, c in known.values():
        uses[c] += n
        kinds[c] += 1
    tokens = sum(n for n, _ in known.values())
    want = {}
    for i, t in texts:
        row, total = [brown.END, *words(t)], 0.0
        for a, b in zip(row, row[1:]):
            n = known.get(b, (0, 0))[0]
            plain = (n + 0.1) / (tokens + 0.1 * (len(known) + 1))
            total += np.log10(0.8 * chance[kind(a), kind(b)] * (n + 0.1) / (uses[kind(b)] + 0.1 * (kinds[kind(b)] + 1)) + 0.2 * plain)
        want[i] = total
    once = {r["path"]: r for r in brown.learn_and_score(docs, train, words=10, forms=4, classes=4).collect()}
    twice = {r["path"]: r for r in brown.score(docs, model, counts).collect()}
    for i in want:
        assert np.isclose(once[i]["score"], want[i]) and np.isclose(twice[i]["score"], want[i]) and once[i]["n_tokens"] == len(words(dict(texts)[i]))


def test_class_model_numbers_words_by_chunk(spark):
    """Chunks of a few texts give back every word and the training counts; batches to workers are bounded and the setting for shuffle files is put back."""
    rnd = random.Random(8)
    texts = [(i, None if i == 7 else " ".join(f"W{rnd.randint(0, 9)}" for _ in range(i % 9))) for i in range(50)]
    before = spark.conf.get(CLEANUP, None)
    brown.learn_and_score(frame(spark, texts), F.col("path") < 30, words=4, forms=2, classes=2).collect()
    assert spark.conf.get(CLEANUP, None) == before and int(spark.conf.get(text_batches.BYTE_LIMIT).rstrip("bB")) <= text_batches.BATCH_BYTES
    docs, found = brown._numbered(frame(spark, texts).repartition(6).select(F.col("path").alias("id"), "text", (F.col("path") < 30).alias("train")))
    words = {(r["chunk"], r["at"]): (bytes(r["word"]), r["n"]) for r in found.collect()}
    rows, counts = docs.collect(), {}
    assert len({r["chunk"] for r in rows}) > 4
    for r in rows:
        assert [words[r["chunk"], t][0] for t in r["tokens"]] == [*(dict(texts)[r["id"]] or "").lower().encode().split(), brown.END]
        for t in r["tokens"]:
            counts[r["chunk"], t] = counts.get((r["chunk"], t), 0) + r["train"]
    assert counts == {k: n for k, (w, n) in words.items()} and sorted(r["id"] for r in rows) == list(range(50))


def test_line_keys_are_worked_out_once(spark):
    """Segment keys of long lines are a column of their own, and each line has the keys of its tolerance."""
    rows = spark.createDataFrame([("x" * n,) for n in (0, 11, 12, 24, 25, 26, 90)], "line string")
    keyed = line_dedup._with_keys(rows, 2)
    assert keyed._jdf.queryExecution().optimizedPlan().toString().count("AS _long#") == 1
    assert {len(r["line"]): (r["chars"], len(r["keys"])) for r in keyed.collect()} == {0: (0, 0), 11: (11, 0), 12: (12, 4), 24: (24, 4), 25: (25, 16), 26: (26, 12), 90: (90, 12)}


def test_line_keys_are_compiled(spark, capsys):
    """The JVM does not compile a method of over 8,000 bytes; the keys' code ran uncompiled at 13,763."""
    rows = spark.createDataFrame([("x" * 40, 1)], "line string, n int")
    line_dedup._with_keys(rows, 2).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("handed", [True, False])
def test_line_links_of_any_characters(spark, handed, monkeypatch):
    """Links are counted in characters of any width; ids may be NULL or repeat. The same whether or not places are few enough to be handed out."""
    if not handed:
        monkeypatch.setattr(line_dedup, "broadcast_if_small", lambda df: df)
    rnd = random.Random(23)
    base = ["".join(rnd.choice("ab é中😀𝒳") for _ in range(n)) for n in (12, 18, 25, 26, 31, 44)]
    lines = list(base)
    for x in base:
        for k in (1, 2, 3):
            y = list(x)
            for at in rnd.sample(range(len(y)), k):
                y[at] = rnd.choice(["", "😀😀", "z"])
            lines.append("".join(y))
    docs = frame(spark, [(None if i % 5 == 0 else i % 7, x) for i, x in enumerate(lines)] + [(50, "\n".join(lines)), (51, "alone here, near nothing at all")])
    got = {r["line_no"]: r["n_links"] for r in line_dedup.line_links(docs, min_chars=0).filter("path = 50").collect()}
    near = lambda x, y: x != y and distance(x, y) <= (2 if min(len(x), len(y)) >= 25 else 1 if min(len(x), len(y)) >= 12 else 0)
    assert got == {n: len({y for y in lines if near(x, y)}) for n, x in enumerate(lines)}


def test_what_a_worker_remembers_is_bounded(monkeypatch):
    """Scores and token ids are the same however few words are remembered, and no more than that are held at once."""
    names = ["▁", "▁a", *"abcdefgh"]
    pieces, chances = language.Pieces(names), np.random.default_rng(2).random((10, 3)) / 10
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(20)) for _ in range(200)]
    want = np.array([language.word_scores(["▁" + w for w in t.split()], pieces, chances).sum(0) for t in texts])
    monkeypatch.setattr(text_batches, "CACHE_WORDS", 100)
    monkeypatch.setattr(language, "CACHE_WORDS", 100, raising=False)
    monkeypatch.setattr(language, "GROUP_CHARS", 300, raising=False)
    scores, held = language.WordScores(pieces, chances), []
    plain = language.word_scores
    monkeypatch.setattr(language, "word_scores", lambda words, *rest: held.append(len(scores)) or plain(words, *rest))
    for _ in range(2):
        assert np.array_equal(scores.totals(texts), want)
    assert max(held) < 300 and len(scores.table) == len(scores)

    path = packing.default_tokenizer()
    monkeypatch.setattr(packing, "CACHE_UNITS", 50)
    units = packing.UnitIds(path)
    for t in texts:
        body = t.replace(" b", "\nb").replace("a ", "a, ")
        assert np.frombuffer(units.of(body), "<u4").tolist() == units.whole.encode(body, add_special_tokens=False).ids
        assert len(units) + len(units.spaced) <= 50


def test_sums_of_many_words_are_not_held_at_once():
    import tracemalloc

    rnd = random.Random(6)
    pieces, chances = language.Pieces(list("▁ab")), np.ones((3, 4)) / 3
    words = ["▁" + "".join(rnd.choice("ab") for _ in range(39)) for _ in range(20_000)]
    tracemalloc.start()
    language.word_scores(words, pieces, chances)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25_000_000
