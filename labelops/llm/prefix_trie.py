"""Prefix trie of training histories: fixed-length block hashing first, turn boundaries only where siblings diverge.

A training run is a sequence of epochs. Runs that were resumed or branched from a common start share their first
epochs; the trie shows every shared start once, who shares it, and what storing it once saves. Any ordered records
of a key will do: the turns of conversations as well as the epochs of runs.

Each run is cut into blocks of ``block`` records. A prefix is known by two 64-bit numbers: the exclusive or of the
hashes of its whole blocks, each of which includes the block's place, with the hash of the records after them. So prefixes of
runs of any length come from running sums, and blocks, not records, are grouped by (place, prefix before, prefix after).
A block without a sibling is a chain of nodes with the same runs, and no record in it is looked at again. Where blocks
share the prefix before them, and only there, the records inside are grouped one by one.

Sums over subtrees need no walk over the tree. A node belongs to its smallest run; what a run holds before the first
node that is its own is repeated from others. So a node's saving is the sum, over its runs, of their repeated records from
the node's depth on, and its leaves are the runs below it that own a leaf: sums over the same groups of blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.lineage import broadcast_if_small, stored
from labelops.llm.sequences import join_counted, numbered

BLOCK = 4
#: Blocks of a run whose running sums are made in one task.
STRETCH = 4096
SPOT = ["depth", "k1", "k2"]
UP = ["up", "u1", "u2"]


def _lanes(hashes: list[Column], place: Column) -> list[list[Column]]:
    """Two 64-bit hashes of each start of a block."""
    found = []
    for lane in (1, 2):
        h, out = F.xxhash64(F.lit(lane), place), []
        for x in hashes:
            h = F.xxhash64(h, x) if lane == 1 else F.xxhash64(x, h)
            out.append(h)
        found.append(out)
    return found


def _running(blocks: DataFrame) -> DataFrame:
    """Adds the prefix before each block (b1, b2), the text before it (``chars_before``) and whether it is the run's last.

    A run's blocks are dealt in stretches of STRETCH; only runs of several stretches take part in the second step.
    """
    whole = blocks.withColumn("stretch", F.floor(F.col("b") / STRETCH))
    long = whole.filter(F.col("b") >= STRETCH - 1).select("run").distinct()
    parts = whole.join(broadcast_if_small(stored(long)), "run", "left_semi").groupBy("run", "stretch").agg(
        F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"), F.sum("block_chars").alias("s_chars"), F.max("b").alias("s_last")
    )
    ahead = Window.partitionBy("run").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "run", "stretch", F.bit_xor("s1").over(ahead).alias("o1"), F.bit_xor("s2").over(ahead).alias("o2"), F.sum("s_chars").over(ahead).alias("o_chars"),
        F.max("s_last").over(Window.partitionBy("run")).alias("end"),
    )
    inside = Window.partitionBy("run", "stretch").orderBy("b")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    whole = whole.withColumns({
        "b1": F.coalesce(F.bit_xor("x1").over(upto), zero), "b2": F.coalesce(F.bit_xor("x2").over(upto), zero),
        "chars_before": F.coalesce(F.sum("block_chars").over(upto), zero), "next": F.lead("b").over(inside),
    })
    whole = whole.join(broadcast_if_small(stored(parts)), ["run", "stretch"], "left")
    return whole.withColumns({
        "b1": F.col("b1").bitwiseXOR(F.coalesce("o1", zero)), "b2": F.col("b2").bitwiseXOR(F.coalesce("o2", zero)),
        "chars_before": F.col("chars_before") + F.coalesce("o_chars", zero),
        "last": F.col("next").isNull() & (F.col("end").isNull() | (F.col("end") == F.col("b"))),
    }).drop("o1", "o2", "o_chars", "end", "next", "stretch", "x1", "x2", "block_chars")


def _steps(groups: DataFrame, block: int) -> DataFrame:
    """One row per record of each block: its node, the node above, and sums of what follows in the block."""
    at = lambda name, j: F.get(F.col(name), j)
    base = F.col("b") * block

    def step(j: Column) -> Column:
        first = j == 0
        return F.struct(
            (base + j + 1).alias("depth"), F.col("b1").bitwiseXOR(at("w1", j)).alias("k1"), F.col("b2").bitwiseXOR(at("w2", j)).alias("k2"),
            (base + j).alias("up"), F.when(first, F.col("b1")).otherwise(F.col("b1").bitwiseXOR(at("w1", j - 1))).alias("u1"),
            F.when(first, F.col("b2")).otherwise(F.col("b2").bitwiseXOR(at("w2", j - 1))).alias("u2"),
            at("chars", j).alias("last_chars"), (j + 1 == F.size("w1")).alias("at_end"),
            F.aggregate(F.slice("chars", j + 1, F.lit(block)), F.lit(0).cast("long"), lambda a, x: a + x).alias("rest_chars"), j.alias("j"),
        )

    return groups.withColumn("step", F.explode(F.transform(F.sequence(F.lit(0), F.size("w1") - 1), step))).select("*", "step.*").drop("step")


def history_trie(
    epochs: DataFrame, runs: DataFrame | None = None, run_col: str = "run", epoch_col: str = "epoch", role_col: str = "stage",
    text_col: str = "value", block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie and where each run ends, from one row per epoch (run, epoch, stage, value).

    Nodes: ``run_col`` (the smallest run that starts with this prefix), ``depth``, parent_<run_col>, ``n_runs``,
    ``n_children``, ``n_leaves``, ``saved_chars``, and the node's key ``k1``, ``k2``. A node is a sequence of the first ``depth``
    records (role and text) of a run; the root has depth 0 and no text. ``saved_chars`` adds up, over the node's subtree with the node itself,
    (n_runs - 1) times the characters of the node's last text. Ends: (``run_col``, ``depth``, ``k1``, ``k2``), one row per run.

    Records of a run are in the order of ``epoch_col``, NULL first, then role and text; repeated rows are records
    of their own. NULL role or text counts as empty. Rows without a run belong to none and are left out. ``runs`` (a frame
    with the run column) adds runs without a record, which end at the root. Without any run there is no node. Columns of other names are
    not looked at, so they may be called anything.
    """
    steps = epochs.filter(F.col(run_col).isNotNull()).select(
        F.col(run_col).alias("run"), F.col(epoch_col).alias("epoch"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    # role and text are told apart by the length of the role; from here on no text travels
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    steps = numbered(steps.select("run", "epoch", digest.alias("h"), F.length("text").cast("long").alias("chars")), "run", [F.col("epoch"), F.col("h")])

    cells = steps.groupBy("run", F.floor(F.col("pos") / block).alias("b")).agg(F.sort_array(F.collect_list(F.struct("pos", "h", "chars"))).alias("cell"))
    hashes = [F.get(F.col("cell.h"), F.lit(i)) for i in range(block)]
    one, two = _lanes(hashes, F.col("b"))
    cells = cells.select("run", "b", F.col("cell.chars").alias("chars"), *[F.slice(F.array(*w), 1, F.size("cell")).alias(f"w{i}") for i, w in ((1, one), (2, two))])
    cells = cells.withColumns({
        "x1": F.element_at("w1", -1), "x2": F.element_at("w2", -1), "block_chars": F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    })
    cells = stored(_running(cells))

    # blocks
    ends = [F.col("b1").bitwiseXOR(F.element_at("w1", -1)).alias("e1"), F.col("b2").bitwiseXOR(F.element_at("w2", -1)).alias("e2")]
    spot = ["b", "b1", "b2", "e1", "e2"]
    groups = cells.select("run", "b", "b1", "b2", *ends, "last").groupBy(*spot).agg(
        F.count(F.lit(1)).alias("n"), F.min("run").alias("run"), F.sum(F.col("last").cast("long")).alias("ended")
    )
    groups = stored(groups.join(cells.select("run", "b", "w1", "w2", "chars"), ["run", "b"]))
    siblings = stored(groups.groupBy("b", "b1", "b2").agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1"))
    groups = stored(join_counted(groups, siblings, ["b", "b1", "b2"], "blocks", "left").withColumn("split", F.col("blocks").isNotNull()).drop("blocks"))

    # nodes
    inner = _steps(groups, block).withColumn("ended", F.when(F.col("at_end"), F.col("ended")).otherwise(0))
    kept = [*SPOT, *UP, "run", "n", "ended", "last_chars"]
    refined = inner.filter("split").groupBy(*SPOT, *UP).agg(
        F.min("run").alias("run"), F.sum("n").alias("n"), F.sum("ended").alias("ended"), F.max("last_chars").alias("last_chars")
    )
    nodes = stored(inner.filter("not split").select(kept).unionByName(refined.select(kept)))

    # per run: the depth from which nodes are its own, whether it owns a leaf, and the text before that depth
    owners = stored(nodes.groupBy("run").agg(F.min("depth").alias("own"), F.max((F.col("n") == F.col("ended")).cast("int")).alias("leaf")))
    lengths = cells.join(owners, "run", "left").withColumn("skip", F.col("own") - 1 - F.col("b") * block)
    total = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    head = F.aggregate(F.slice("chars", 1, F.greatest("skip", F.lit(0)).cast("int")), F.lit(0).cast("long"), lambda a, x: a + x)
    shared = F.when(F.col("own").isNull() & F.col("last"), F.col("chars_before") + total).when(F.col("skip").between(0, block - 1), F.col("chars_before") + head)
    facts = lengths.groupBy("run").agg(F.max(shared).alias("shared"), F.max("own").alias("own"), F.coalesce(F.max("leaf"), F.lit(0)).cast("long").alias("leaf"))
    facts = stored(facts)
    after = cells.select("run", "b", "b1", "b2", *ends, (F.col("chars_before") + total).alias("upto")).join(facts.select("run", "shared", "leaf"), "run")
    sums = after.groupBy(*spot).agg(F.sum(F.greatest(F.col("shared") - F.col("upto"), F.lit(0))).alias("beyond"), F.sum("leaf").alias("leaves"))

    below = _steps(groups.join(sums, spot).join(facts.select("run", "own"), "run"), block)
    # the block's smallest run repeats what lies before its own depth, every other run of the block repeats all of it
    own_from = F.greatest(F.col("j"), F.coalesce(F.col("own") - 1 - F.col("b") * block, F.lit(block)).cast("int"))
    owned = F.aggregate(F.slice("chars", own_from + 1, F.lit(block)), F.lit(0).cast("long"), lambda a, x: a + x)
    below = below.withColumn("saved", F.col("beyond") + F.col("n") * F.col("rest_chars") - owned)
    chain = below.filter("not split").select(*SPOT, "leaves", "saved")
    summed = below.filter("split").groupBy(*SPOT).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select(*SPOT, "leaves", "saved")
    children = nodes.filter("up > 0").groupBy(*[F.col(u).alias(s) for u, s in zip(UP, SPOT)]).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(chain.unionByName(summed), SPOT).join(children, SPOT, "left")
    full = stored(full.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # a node's parent belongs to the same run, except for the first node that is a run's own
    tops = stored(full.join(owners.select(F.col("run"), F.col("own").alias("depth")), ["run", "depth"], "left_semi").filter("up > 0").select("run", *UP))
    above = full.filter("n_children > 0").select(*[F.col(s).alias(u) for s, u in zip(SPOT, UP)], F.col("run").alias("parent"), "n_children")
    parents = join_counted(tops, above, UP, "n_children").select("run", (F.col("up") + 1).alias("depth"), "parent")

    everyone = cells.filter("last").select("run")
    if runs is not None:
        everyone = everyone.unionByName(runs.filter(F.col(run_col).isNotNull()).select(F.col(run_col).alias("run")))
    everyone = stored(everyone.distinct())
    zero = F.lit(0).cast("long")
    firsts = nodes.filter("up = 0").agg(F.count(F.lit(1)).alias("n_children"))
    sums = facts.agg(F.coalesce(F.sum("shared"), zero).alias("saved_chars"), F.coalesce(F.sum("leaf"), zero).alias("leaves"))
    # three frames of one row each
    root = everyone.agg(F.min("run").alias("run"), F.count(F.lit(1)).alias("n_runs")).filter("n_runs > 0")
    root = stored(reduce(lambda a, c: a.join(c.withColumn("one", F.lit(1)), "one"), [firsts, sums], root.withColumn("one", F.lit(1))))
    top = F.broadcast(root.select(F.col("run").alias("root_run"), F.lit(1).cast("long").alias("depth")))
    full = full.join(parents, ["run", "depth"], "left").join(top, "depth", "left")
    out = ["run", "depth", "parent_run", "n_runs", "n_children", "n_leaves", "saved_chars", "k1", "k2"]
    full = full.withColumn("parent_run", F.when(F.col("depth") == 1, F.col("root_run")).otherwise(F.coalesce("parent", "run")))
    full = full.withColumnsRenamed({"n": "n_runs", "leaves": "n_leaves", "saved": "saved_chars"})
    root = root.withColumns({
        "depth": zero, "parent_run": F.lit(None).cast(root.schema["run"].dataType), "n_leaves": F.greatest("leaves", F.lit(1).cast("long")), "k1": zero, "k2": zero
    })
    last = cells.filter("last").select("run", (F.col("b") * block + F.size("w1")).alias("depth"), *[c.alias(k) for c, k in zip(
        (F.col("b1").bitwiseXOR(F.element_at("w1", -1)), F.col("b2").bitwiseXOR(F.element_at("w2", -1))), ("k1", "k2"))])
    bare = everyone.join(last.select("run"), "run", "left_anti").select("run", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"))
    named = {"run": run_col, "parent_run": f"parent_{run_col}"}
    return full.select(out).unionByName(root.select(out)).withColumnsRenamed(named), last.unionByName(bare).withColumnsRenamed(named)
