"""Every driver query against its SQL on the smallest tables, and its plan against broad rules."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", [n for n in driver.queries() if n in driver.oracle_sql()])
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = duck.execute(driver.oracle_sql()[name])
    found = [d[0] for d in rel.description]
    assert sorted(found) == cols
    want = sorted(tuple(plain(r[found.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", [n for n in driver.queries() if n not in driver.oracle_sql()])
def test_query_without_sql_has_rows(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 1


def test_split_sizes_have_every_class_of_parts(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet").groupBy("p_type", "p_brand").count().collect()
    got = {r["class"]: r for r in driver.queries()["split_sizes"](spark, SF).collect()}
    found = {f"{r['p_type']}/{r['p_brand']}": r["count"] for r in parts}
    assert {c: r["n"] for c, r in got.items() if c in found} == found and min(found.values()) < 3
    assert all((got[c]["train"] is None) == (n < 3) for c, n in found.items())


def test_near_dups_equal_the_greedy_rule(spark):
    """Brute force over all documents: 64-bit sums over the words' md5, then one row after another."""
    import hashlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()
    kept = []
    for r in sorted(docs, key=lambda d: d["doc_id"]):
        votes = [0] * 64
        for w in r["text"].lower().split():
            h = int(hashlib.md5(w.encode()).hexdigest()[:16], 16)
            for b in range(64):
                votes[b] += 1 if h >> (63 - b) & 1 else -1
        h = sum(1 << (63 - b) for b in range(64) if votes[b] > 0)
        if not any(k[1] == r["lang"] and (k[2] ^ h).bit_count() <= 3 for k in kept):
            kept.append((r["doc_id"], r["lang"], h))
    got = {r["doc_id"] for r in driver.queries()["near_dups"](spark, SF).collect()}
    assert got == {k[0] for k in kept}
