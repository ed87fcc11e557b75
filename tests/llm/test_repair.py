"""Log repair against a shortest-path search that knows no grammar, words or matrices."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

import __spark_entry__ as driver
from labelops.llm import repair

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def brute_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows, roles=("user", "assistant")):
    """Dijkstra over (rows done, grammar state) by (cost, initials)."""
    faults = brute_faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, made
        turn = "a" if state == "u" else "u"
        name = roles[0] if turn == "u" else roles[1]
        heapq.heappush(heap, (cost + 2, audit + "I", i, turn, made + ((name, ""),)))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, made))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, turn, made + ((name, text),)))
                if role[:1] == turn or role[:1] == "s" and state == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], made + ((role, text),)))


def brute(rows, turns, roles=("user", "assistant")):
    faults = brute_faults(rows)
    cost, audit, made = brute_repair(rows, roles)
    known = [t for t in turns if t is not None]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"), "illegal": sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": audit, "made": made,
    }


def random_log(rnd, n):
    texts = ["Yes.", "no", "", " \t", "ok!", "why?\n", "é.", "a.b"] + [f"t{i}." for i in range(20)]
    return [(rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rnd.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("chunk", [256, 3, 1])
def test_repair(spark, chunk, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rnd = random.Random(chunk)
    logs = {i: random_log(rnd, rnd.randint(1, 12)) for i in range(120)}
    logs |= {200 + i: [("system", "Go."), ("user", f"{i % 2}?"), ("assistant", "ok.")] for i in range(60)}
    steps = {i: sorted((rnd.choice([None, *range(9)]) for _ in v), key=lambda t: (t is not None, t or 0)) for i, v in logs.items()}
    steps = {i: list(range(len(v))) if len(set(steps[i])) < len(v) else steps[i] for i, v in logs.items()}
    rows = [(i, t, r, x, 0, "k") for i, v in logs.items() for t, (r, x) in zip(steps[i], v)]
    rnd.shuffle(rows)
    repaired, audit = repair.repair_logs(spark.createDataFrame(rows, "run long, step int, role string, text string, pos int, word string"))
    got = {r["run"]: r.asDict() for r in audit.collect()}
    made = {}
    for r in sorted(repaired.collect(), key=lambda r: (r["run"], r["place"])):
        made.setdefault(r["run"], []).append((r["edit"], r["role"], r["text"]))
    assert set(got) == set(logs)
    for i, v in logs.items():
        want = brute(v, steps[i])
        assert {k: got[i][k] for k in want if k != "made"} == {k: x for k, x in want.items() if k != "made"}, (i, v)
        assert "".join(e for e, _, _ in made[i]) == want["audit"]
        assert tuple((r, x) for e, r, x in made[i] if e != "D") == want["made"]
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for e, r, _ in made[i] if e != "D"))


def test_upload_sessions(spark):
    """Other role names with the same initials; NULL role and text are empty; rows without a run are left out."""
    rows = [(1, 0, "setup", "Gate 0.5."), (1, 1, "upload", "a.png."), (1, 2, "upload", "b.png."), (1, 3, "answer", "guava."), (2, None, None, None), (None, 0, "upload", "x.")]
    repaired, audit = repair.repair_logs(spark.createDataFrame(rows, "run long, step int, role string, text string"), roles=("upload", "answer"))
    assert {(r["run"], r["cost"], r["audit"], r["blank"]) for r in audit.collect()} == {(1, 2, "KKIKK", 0), (2, 3, "D", 1)}
    assert [r["role"] for r in repaired.filter("run = 1").orderBy("place").collect()] == ["setup", "upload", "answer", "upload", "answer"]
    with pytest.raises(ValueError):
        repair.repair_logs(repaired, roles=("request", "answer"))
    empty = repair.repair_logs(spark.createDataFrame([], "run long, step int, role string, text string"))
    assert [f.count() for f in empty] == [0, 0]


def test_long_and_hot_logs(spark):
    """One log holds most rows and spans many words; texts are long and repeated."""
    rnd = random.Random(3)
    logs = {1: random_log(rnd, 900), 2: [("user", "x" * 200_000 + "."), ("assistant", "x" * 200_000 + ".")] * 3}
    rows = [(i, t, r, x) for i, v in logs.items() for t, (r, x) in enumerate(v)]
    _, audit = repair.repair_logs(spark.createDataFrame(rows, "run long, step int, role string, text string"))
    got = {r["run"]: r.asDict() for r in audit.collect()}
    for i, v in logs.items():
        want = brute(v, range(len(v)))
        assert {k: got[i][k] for k in want if k != "made"} == {k: x for k, x in want.items() if k != "made"}


def damaged(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or " ", r["text"] or " ")):
        role, text = r["role"] if r["role"] is not None else " ", r["text"] if r["text"] is not None else " "
        log = by.setdefault(r["conv_id"], [])
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn'] if r['turn'] is not None else ' '}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        log += [(r["turn"], "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return by


def check_op13(df, rows):
    got = {r["conv_id"]: r.asDict() for r in df.collect()}
    logs = damaged(rows)
    assert set(got) == set(logs)
    for c, log in logs.items():
        want = brute([x[1:] for x in log], [x[0] for x in log])
        want["repaired_sha256"] = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in want.pop("made")).encode()).hexdigest()
        assert {k: got[c][k] for k in want} == want


def test_op13_query(spark):
    check_op13(driver.queries()["op13_log_repair"](spark, SF), spark.read.parquet(f"{SF}/conversations.parquet").collect())


def test_op13_query_on_odd_rows(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(c, t if t else None, rnd.choice(["user", None, "system", "assistant"]), rnd.choice(["Hi.", None, "", "höher!", "cut", "x.\n"]), "x") for c in range(40) for t in range(rnd.randint(1, 7))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    check_op13(driver.queries()["op13_log_repair"](spark, str(tmp_path)), table.collect())
