"""Class-name tokens and name lookups, all as native column expressions.

The lookups take a bounded Python list or dict (a class list is a dimension, not data). A prefix
match is turned into set membership: a known name followed by ``_`` is one of the name's own
underscore prefixes, so each row tests its few prefixes instead of every known name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from labelops.constants import CLASS_METADATA, KNOWN_CLASSES, LABEL_ALIASES, MERGE_RULES, OTHER
from labelops.lineage import broadcast_if_small, cut


def _squash(col: Column) -> Column:
    """Runs of anything but ``a-z0-9`` become one ``_``; none at the ends."""
    return F.regexp_replace(F.regexp_replace(col, "[^a-z0-9]+", "_"), "^_|_$", "")


def safe_token(col: Column, empty: str | None = None) -> Column:
    token = _squash(F.lower(col))
    return token if empty is None else F.when(token == "", F.lit(empty)).otherwise(token)


def basic_token(col: Column) -> Column:
    """``safe_token`` without one trailing ``_c``."""
    return F.regexp_replace(safe_token(col), "_c$", "")


@F.pandas_udf(StringType())
def _strip_marks(names: pd.Series) -> pd.Series:
    def fold(name):
        if name is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))

    return names.map(fold)


def ascii_token(df: DataFrame, col: str, out: str = "ascii_token") -> DataFrame:
    """Accent-folded token. Only distinct non-ASCII names reach Python; the rest stays native.

    The folded names are written once and broadcast when they are few, as folder names are."""
    plain = F.coalesce(~F.col(col).rlike("[^\\x00-\\x7F]"), F.lit(True))
    folded = cut(
        df.where(~plain)
        .select(F.col(col).alias("_name"))
        .distinct()
        .withColumn("_folded", _squash(_strip_marks(F.lower(F.trim("_name")))))
    )
    # only rows with something to fold take part in the join
    joined = df.where(~plain).join(broadcast_if_small(folded), F.col(col) == F.col("_name"), "left")
    return df.where(plain).withColumn(out, safe_token(F.col(col))).unionByName(
        joined.withColumn(out, F.col("_folded")).drop("_name", "_folded")
    )


def _stem(token: Column) -> Column:
    """The token without its last part when that part is a number."""
    return F.regexp_replace(token, "(^|_)[0-9]+$", "")


def _longest_known_prefix(stem: Column, known: Iterable[str]) -> Column:
    parts = F.split(stem, "_")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_")
    )
    return F.try_element_at(F.filter(prefixes, lambda p: p.isin(sorted(known))), F.lit(-1))


def lookup(col: Column, table: Mapping[str, str]) -> Column:
    """Value of a bounded dict for a column, NULL when absent."""
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), col)


def resolve_known(col: Column, known: Iterable[str] = KNOWN_CLASSES) -> Column:
    """Exact name, then the name without its number, then the longest known prefix, then itself."""
    token = basic_token(col)
    return F.when(token.isin(sorted(known)), token).otherwise(
        F.coalesce(_longest_known_prefix(_stem(token), known), token)
    )


def merge_class(col: Column, rules: Mapping[str, str] = MERGE_RULES, known: Iterable[str] = KNOWN_CLASSES) -> Column:
    name = resolve_known(col, known)
    return F.coalesce(lookup(name, rules), name)


def clean_label(col: Column, aliases: Mapping[str, str] = LABEL_ALIASES) -> Column:
    """Loader rule: alias, else alias of the longest known prefix, else (numbered) first token."""
    token = basic_token(col)
    prefix = _longest_known_prefix(_stem(token), aliases)
    rest = F.when(token.rlike("(^|_)[0-9]+$"), F.split(token, "_")[0]).otherwise(token)
    return F.when(token == "", F.raise_error(F.lit("blank class name")).cast("string")).otherwise(
        F.coalesce(lookup(token, aliases), lookup(prefix, aliases), rest)
    )


def class_metadata(col: Column, table: Mapping[str, tuple[str, str]] = CLASS_METADATA) -> Column:
    """STRUCT<english, vietnamese> with the fallback names for an unknown class."""
    key = basic_token(col)
    english = {k: v[0] for k, v in table.items()}
    vietnamese = {k: v[1] for k, v in table.items()}
    fallback = F.when(key == "", F.lit("unknown")).otherwise(key)
    return F.struct(
        F.coalesce(lookup(key, english), fallback).alias("english"),
        F.coalesce(lookup(key, vietnamese), F.lit("khong_ro")).alias("vietnamese"),
    )


def folder_name(metadata: Column, count: Column) -> Column:
    return F.concat_ws("_", safe_token(metadata["english"]), safe_token(metadata["vietnamese"]), count.cast("string"))


def is_other(col: Column) -> Column:
    return safe_token(col) == OTHER


def binary_label(col: Column, aliases: Mapping[str, str] = LABEL_ALIASES) -> Column:
    """0 for the ``other`` class, 1 for every real class."""
    return F.when(clean_label(col, aliases) == OTHER, F.lit(0)).otherwise(F.lit(1))
