"""Secrets in texts, told from widely copied examples by how many owners hold them; DataFrame functions only.

The project has no code or texts with owners; the operator is general and takes any frame with an id (``path``), an owner, a repository and a text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.lineage import stored

# Kinds in the order they are listed, pattern, group that holds the candidate, its least length.
BASE_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Public formats of issued tokens and key files, which the frequency rule has to clear.
ISSUED_KINDS = (
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("cloud", r"AIza[A-Za-z0-9_-]{35}", 0, 39),
    ("web", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+", 0, 40),
)
KINDS = BASE_KINDS + ISSUED_KINDS
#: A candidate that more owners hold is a copied example.
MAX_OWNERS = 1
#: And one that more repositories hold, whoever owns them.
MAX_REPOS = 20
#: Fixed value: a text without any of these has no candidate of a kind, so its patterns need not run.
HINTS = {"access": "AKIA", "forge": "gh", "chat": "xox", "cloud": "AIza", "web": "eyJ", "pem": "-----BEGIN"}


def _spans(body: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """(start, kind, end, value) of every match of one kind from left to right; matches with a short group are dropped."""
    between, matches = F.split(body, pattern, -1), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(body, F.lit(pattern), F.lit(group)) if group else matches
    row = "struct<start:int,kind:int,end:int,value:string>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{row}>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["0"])
        end = start + F.length(x["1"])
        found = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), x["2"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["out"], found).alias("out"))

    zipped = F.transform(F.arrays_zip(between.alias("0"), matches.alias("1"), values.alias("2")), lambda x: x)
    found = F.aggregate(F.filter(zipped, lambda x: x["1"].isNotNull()), begin, step)["out"]
    return F.filter(found, lambda s: F.length(s["value"]) >= least)


def candidates(items: DataFrame, id_col: str = "path", text_col: str = "text") -> DataFrame:
    """All columns and rows, with ``spans``: candidates of all kinds by start, then kind. NULL text has none."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    parts = []
    for number, (kind, pattern, group, least) in enumerate(KINDS):
        there = body.contains(HINTS[kind]) if kind in HINTS else body.rlike(pattern)
        none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
        parts.append(F.when(there, _spans(body, number, pattern, group, least)).otherwise(none))
    return items.withColumn("spans", F.sort_array(F.flatten(F.array(*parts))))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(
    items: DataFrame, id_col: str = "path", owner_col: str = "source", repo_col: str = "path", text_col: str = "text",
    max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS,
) -> DataFrame:
    """One row per text: ``id_col``, n_assign, n_access, n_hex, base_spans, spans, n_live, live_spans.

    ``base_spans`` lists the base kinds, ``spans`` those and issued tokens that look live; ``live_spans`` all that look live: held by
    at most ``max_owners`` owners and ``max_repos`` repositories in the whole corpus, by the candidate's hash. Spans are
    kind:start:end in code points, end exclusive, joined by commas. Empty and NULL texts have none; NULL owners and
    repositories count as one each; repeated rows do not raise a count, and ids have to tell texts apart.
    """
    found = candidates(items.select(F.col(id_col).alias("_id"), F.col(owner_col).alias("_owner"), F.col(repo_col).alias("_repo"), F.col(text_col).alias("_text")), "_id", "_text")
    rows = stored(found.select("_id", "_owner", "_repo", "spans"))
    held = rows.select("_owner", "_repo", F.explode(F.transform("spans", lambda s: F.sha2(s["value"], 256))).alias("hash"))
    owner, repo = (F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("_owner", "_repo"))
    spread = held.select("hash", owner.alias("owner"), repo.alias("repo")).distinct()
    spread = spread.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("pairs")).groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("pairs").alias("repos"))
    live = spread.filter((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)).select("hash")
    each = rows.select("_id", F.explode("spans").alias("span")).withColumn("hash", F.sha2(F.col("span.value"), 256))
    lived = each.join(live, "hash", "left_semi").groupBy("_id").agg(F.sort_array(F.collect_set("span")).alias("live")).withColumnRenamed("_id", "_live_id")
    joined = rows.join(lived, rows["_id"].eqNullSafe(lived["_live_id"]), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    joined = joined.withColumn("live", F.coalesce("live", none))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    shown = F.sort_array(F.concat(base, F.filter("live", lambda s: s["kind"] >= len(BASE_KINDS))))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return joined.select(
        F.col("_id").alias(id_col), *[count(i).alias(f"n_{k[0]}") for i, k in enumerate(BASE_KINDS)], _joined(base).alias("base_spans"),
        _joined(shown).alias("spans"), F.size("live").cast("long").alias("n_live"), _joined(F.col("live")).alias("live_spans"),
    )
