"""Repair of alternating logs: a shared Re-Pair grammar over their rows, one min-plus matrix per rule.

A session log is an optional setup row, then pairs of a request and an answer: initials ``(s?(ua)+)?``. Rows may be
blank, repeated, truncated or of the wrong role. The repair is the cheapest list of edits: Keep 0, Rerole 2, Delete 3,
Insert 2, and 1 more for a truncated row that stays; blank and repeated rows have to be deleted. Of equally cheap lists
the one whose initials are least in ASCII order is taken.

A row is one of nine letters (initial and fault), a stretch of CHUNK rows is a word. Rules that replace the commonest
pairs are drawn up over all distinct words, in rounds: each round counts every pair there is and replaces pairs
that share no letter. A letter's matrix says, for each state before and after it, the cost of the best edits and their
initials; a rule's matrix is the min-plus product of its two, made once, bottom up, and its initials are a rope that
refers to those of its parts. A word costs one product per letter of its compressed form, whatever
number of logs hold it.

Edits that end in a word never insert behind its last row, so two lists of equal cost are never the beginning of
each other, and the least of joined initials is found part by part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import broadcast_if_small, stored
from labelops.llm.sequences import join_counted, numbered

#: Rows of a log in one word.
CHUNK = 256
#: Rounds of the grammar and rules a round may add; they change the time taken, never the result.
ROUNDS = 8
RULES = 48
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Fixed value: ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
#: Letters: a row to delete, a row that may stay, a truncated one; ``o`` is any other initial.
MUST_GO, SOUND, CUT_OFF = "x", "suao", "SUAO"
#: States: nothing yet, after the setup row, after a request, after an answer.
STATES, REQUEST, ANSWER = 4, {0: 2, 1: 2, 3: 2}, {2: 3}
FIRST_RULE = 0xE000


# --- matrices -----------------------------------------------------------------------------------
# An entry is None or (cost, rope); a rope is a text or a pair of ropes.


def flat(rope) -> str:
    """The text of a rope, without recursion."""
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def _better(a, b):
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if flat(a[1]) <= flat(b[1]) else b


def product(a: list, b: list) -> list:
    """Min-plus product of two matrices."""
    out = []
    for row in a:
        new = []
        for j in range(STATES):
            best = None
            for k, x in enumerate(row):
                if x is not None and b[k][j] is not None:
                    y = b[k][j]
                    best = _better(best, (x[0] + y[0], (x[1], y[1]) if x[1] and y[1] else x[1] or y[1]))
            new.append(best)
        out.append(new)
    return out


def _moves(inserting: bool, steps: list[tuple[int, int, int, str]]) -> list:
    m: list[list] = [[None] * STATES for _ in range(STATES)]
    for i, j, cost, name in steps:
        m[i][j] = _better(m[i][j], (cost, name))
    if inserting:
        for i in range(STATES):
            m[i][i] = (0, "")
    return m


_ONE = _moves(True, [(i, j, INSERT, "I") for turn in (REQUEST, ANSWER) for i, j in turn.items()])
#: Up to two rows inserted; more would only come back to a state that fewer reach.
BETWEEN = product(_ONE, _ONE)


def letter(symbol: str) -> list:
    """Matrix of a row, with what may be inserted before it."""
    steps = [(i, i, DELETE, "D") for i in range(STATES)]
    if symbol != MUST_GO:
        extra = TRUNCATED if symbol.isupper() else 0
        own = {"s": {0: 1}, "u": REQUEST, "a": ANSWER}.get(symbol.lower(), {})
        steps += [(i, j, extra, "K") for i, j in own.items()]
        steps += [(i, j, REROLE + extra, "R") for turn in (REQUEST, ANSWER) for i, j in turn.items()]
    return product(BETWEEN, _moves(False, steps))


def matrices(rules: Sequence[tuple[str, str]]) -> dict[str, list]:
    """Matrix of every letter and of every rule (symbol, its pair), bottom up."""
    found = {s: letter(s) for s in MUST_GO + SOUND + CUT_OFF}
    for symbol, pair in rules:
        found[symbol] = product(found[pair[0]], found[pair[1]])
    return found


#: A log starts with nothing; a matrix of this one row keeps a product to the states that can be reached.
START = [[(0, ""), None, None, None]]
NOTHING = [[(0, "") if i == j else None for j in range(STATES)] for i in range(STATES)]
#: Per state the cheapest way to the end of a log, rows inserted after the last one included.
END = [_better(BETWEEN[i][0], BETWEEN[i][3]) for i in range(STATES)]


def word_matrix(word: str, known: dict[str, list], start: list = NOTHING) -> list:
    for symbol in word:
        start = product(start, known[symbol])
    return start


# --- grammar ------------------------------------------------------------------------------------


def grammar(words: DataFrame, rounds: int = ROUNDS, per_round: int = RULES) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Adds ``packed``, the compressed form of ``word`` (weights in ``n``); and the rules, each after those it uses.

    Every round counts all pairs of all words and takes the commonest ones that share no symbol, so that they can
    be replaced at once; it ends when no pair is left that occurs twice. What comes to the driver is the head of the pair counts.
    """
    now, rules = stored(words.withColumn("packed", F.col("word"))), []
    for _ in range(rounds):
        places = F.when(F.length("packed") > 1, F.sequence(F.lit(1), F.length("packed") - 1))
        pairs = now.select("n", F.explode(F.transform(places, lambda i: F.substring("packed", i, F.lit(2)))).alias("pair"))
        counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        top = [r["pair"] for r in counts.orderBy(F.desc("n"), "pair").limit(4 * per_round).collect()]
        used, new = set(), []
        for pair in top:
            if not used & set(pair) and len(new) < per_round:
                used |= set(pair)
                new.append((chr(FIRST_RULE + len(rules) + len(new)), pair))
        if not new:
            break
        packed = F.col("packed")
        for symbol, pair in new:
            packed = F.replace(packed, F.lit(pair), F.lit(symbol))
        rules += new
        now = stored(now.withColumn("packed", packed))
    return now, rules


# --- rows ---------------------------------------------------------------------------------------


def _rows(log: DataFrame, run_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """(run, pos, order, role, text, h): the rows of each run, numbered and written once."""
    rows = log.filter(F.col(run_col).isNotNull()).select(
        F.col(run_col).alias("run"), F.col(order_col).alias("order"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    h = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    return numbered(rows.withColumn("h", h), "run", [F.col("order"), F.col("role"), F.col("h")])


def _faults(rows: DataFrame) -> DataFrame:
    """(run, pos, order, initial, fault), without texts: the first fault of each row or NULL."""
    first = rows.groupBy("run", "h").agg(F.min("pos").alias("pos")).select("run", "pos", F.lit(True).alias("first"))
    shown = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select("run", "pos", "order", _initial().alias("initial"), (shown == "").alias("empty"), F.right(shown, F.lit(1)).isin(".", "!", "?").alias("closed"))
    fault = F.when(F.col("empty"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("closed"), "truncated")
    return narrow.join(first, ["run", "pos"], "left").select("run", "pos", "order", "initial", fault.alias("fault"))


def _initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def _words(faults: DataFrame) -> DataFrame:
    """Per run and stretch of CHUNK rows: its word, counts of faults, and what its neighbours have to know."""
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    of = lambda kind: F.sum((F.col("fault").eqNullSafe(F.lit(kind))).cast("long")).alias(kind)
    cells = faults.select("run", "pos", "fault", symbol.alias("symbol"), "initial").groupBy("run", F.floor(F.col("pos") / CHUNK).alias("c")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "symbol", "initial"))).alias("cell"), of("blank"), of("duplicate"), of("truncated"),
    )
    text = lambda name: F.array_join(F.col(f"cell.{name}"), "")
    cells = cells.select("run", "c", text("symbol").alias("word"), text("initial").alias("initials"), "blank", "duplicate", "truncated")
    places = F.when(F.length("initials") > 1, F.sequence(F.lit(1), F.length("initials") - 1)).otherwise(F.array().cast("array<int>"))
    bad = F.size(F.filter(places, lambda i: ~F.substring("initials", i, F.lit(2)).isin("su", "ua", "au"))).cast("long")
    return stored(cells.withColumn("illegal", bad))


def _long_runs(schema: T.StructType):
    """Edits of runs of several words: costs from the end to the start, then the choices from the start on."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("c")
        steps = [[None if x["cost"] is None else x["cost"] for x in m] for m in table.column("matrix").to_pylist()]
        togo = [[e[0] if e else None for e in END]]
        for m in reversed(steps):
            after = togo[-1]
            togo.append([min((m[STATES * i + j] + after[j] for j in range(STATES) if m[STATES * i + j] is not None and after[j] is not None), default=None) for i in range(STATES)])
        togo.reverse()
        total, state, audits, before = togo[0][0], 0, [], []
        ropes = table.column("matrix")
        for n, m in enumerate(steps):
            before.append(state)
            entries = ropes[n].as_py()
            fits = [(entries[STATES * state + j]["audit"], j) for j in range(STATES) if m[STATES * state + j] is not None and togo[n + 1][j] is not None and m[STATES * state + j] + togo[n + 1][j] == togo[n][state]]
            audit, state = min(fits)
            audits.append(audit)
        audits[-1] += END[state][1]
        count = len(steps)
        return pa.table([pa.array([key[0].as_py()] * count), table.column("c"), pa.array(audits, pa.string()), pa.array(before, pa.int32()), pa.array([total] + [0] * (count - 1), pa.int64())], names=[f.name for f in schema])

    return run


def _edits(words: DataFrame) -> DataFrame:
    """(run, c, audit, before, cost): initials of the edits of each word, the state before it, and (in the first word of a run) their cost."""
    several = broadcast_if_small(stored(words.filter("c = 1").select("run", F.lit(True).alias("long"))))
    words = words.select("run", "c", "word").join(several, "run", "left").withColumn("long", F.coalesce("long", F.lit(False)))
    words = stored(words)
    distinct = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max("long").alias("long"))
    packed, rules = grammar(distinct)
    known = matrices(rules)
    entry = T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    schema = T.StructType([
        T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("matrix", T.ArrayType(entry)),
    ])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            costs, audits, whole = [], [], []
            for word, long in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                best = None
                for x, e in zip(word_matrix(word, known, START)[0], END):
                    if x is not None and e is not None:
                        best = _better(best, (x[0] + e[0], (x[1], e[1])))
                costs.append(best[0])
                audits.append(flat(best[1]))
                m = word_matrix(word, known) if long else []
                whole.append([{"cost": x and x[0], "audit": x and flat(x[1])} for row in m for x in row] if long else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(whole, target.field(4).type)], schema=target)

    solved = stored(packed.select("word", "n", "packed", "long").repartition("word").mapInArrow(solve, schema))
    short = join_counted(words.filter("not long"), solved.select("word", "n", "cost", "audit"), ["word"], "n")
    short = short.select("run", "c", "audit", F.lit(0).alias("before"), "cost")
    long = join_counted(words.filter("long"), solved.filter("matrix is not null").select("word", "n", "matrix"), ["word"], "n").select("run", "c", "matrix")
    out = T.StructType([words.schema["run"], T.StructField("c", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("before", T.IntegerType()), T.StructField("cost", T.LongType())])
    return short.unionByName(long.groupBy("run").applyInArrow(_long_runs(out), out))


def _apply(schema: T.StructType, roles: tuple[str, str]):
    """The edits of a word on its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            out: list[list] = [[] for _ in target]
            for r in batch.to_pylist():
                state, rows, place = r["before"], iter(r["cell"]), r["c"] * 4 * CHUNK
                for edit in r["audit"]:
                    row = None if edit == "I" else next(rows)
                    turn = 0 if state in REQUEST else 1
                    role, body = (row["role"], row["text"]) if edit in "KD" else (roles[turn], row["text"] if row else "")
                    if edit == "K":
                        state = {"s": 1, "u": 2, "a": 3}[role[:1]]
                    elif edit != "D":
                        state = 3 if turn else 2
                    for col, v in zip(out, (r["run"], place, row and row["pos"], role, body, edit)):
                        col.append(v)
                    place += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, target)], schema=target)

    return run


def repair_logs(
    log: DataFrame, run_col: str = "run", order_col: str = "step", role_col: str = "role", text_col: str = "text",
    roles: tuple[str, str] = ("user", "assistant"),
) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and one audit row per run, from log rows (run, step, role, text).

    Repaired rows: ``run_col``, ``place`` (their order in the run; it has gaps), ``pos`` (place of the row in the log as it
    was, NULL for an inserted one), role, text and ``edit`` (K, R, D or I); rows with D are those that go. Audit: ``run_col``, ``gaps``
    (numbers missing between the least and the largest step), ``blank``, ``duplicate``, ``truncated`` (first fault of each
    row: no visible character; role and text seen earlier in the run; last visible character not one of ``.!?``),
    ``illegal`` (neighbours whose initials are not su, ua or au), ``cost`` and ``audit`` (the edits' initials).

    Rows of a run are in the order of ``order_col`` (a number), NULL first, then role and text. NULL role or text counts as empty.
    Rows without a run belong to none and are left out; an empty log gives two empty frames. ``roles`` are the names, with
    the initials u and a, that inserted and changed rows get. Columns of other names are not looked at.

    The project writes no alternating logs (its nearest records are a run's metric lines and epochs), so this is general: upload sessions with
    the roles setup, upload and answer fit as well as conversations. A run's audit is one text, so the words of
    a run meet in one task, one row for CHUNK rows.
    """
    if (roles[0][:1], roles[1][:1]) != ("u", "a"):
        raise ValueError("roles must begin with u and a")
    rows = _rows(log, run_col, order_col, role_col, text_col)
    faults = stored(_faults(rows))
    words = _words(faults)
    edits = stored(_edits(words))

    schema = T.StructType([
        words.schema["run"], T.StructField("place", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("edit", T.StringType()),
    ])
    cells = rows.groupBy("run", F.floor(F.col("pos") / CHUNK).alias("c")).agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("cell"))
    repaired = cells.join(edits.select("run", "c", "audit", "before"), ["run", "c"]).mapInArrow(_apply(schema, roles), schema)

    # neighbours on both sides of a word's end
    ends = words.filter("c > 0").select("run", (F.col("c") - 1).alias("c"), F.substring("initials", 1, 1).alias("next"))
    seams = words.select("run", "c", F.right("initials", F.lit(1)).alias("prev")).join(ends, ["run", "c"]).filter(~F.concat("prev", "next").isin("su", "ua", "au"))
    counts = words.select("run", "blank", "duplicate", "truncated", "illegal").unionByName(
        seams.select("run", *[F.lit(0).cast("long").alias(n) for n in ("blank", "duplicate", "truncated")], F.lit(1).cast("long").alias("illegal"))
    ).groupBy("run").agg(*[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal")])
    steps = faults.groupBy("run", "order").agg(F.lit(1)).groupBy("run").agg(
        F.coalesce(F.max("order") - F.min("order") + 1 - F.count("order"), F.lit(0)).cast("long").alias("gaps")
    )
    audits = edits.groupBy("run").agg(F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("c", "audit"))).alias("parts"))
    audits = audits.select("run", "cost", F.array_join("parts.audit", "").alias("audit"))
    summary = steps.join(counts, "run").join(audits, "run").select("run", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    named = {"run": run_col, "role": role_col, "text": text_col}
    return repaired.withColumnsRenamed(named), summary.withColumnRenamed("run", run_col)
