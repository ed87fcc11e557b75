"""WARC archives: exact round trips, byte ranges, equal files."""

import gzip
import hashlib
import random

import pytest

import __spark_entry__ as driver
from labelops.llm import archives

SF = "/root/testdata/sf0.001"
SCHEMA = "path string, content binary, offset int, digest string"


def brute(files, least=1000):
    """[(path, content)] -> sorted rows (path, bytes, digest, type, refers_to)."""
    out, taken = [], set()
    key = lambda p: (p is not None, p if p is not None else 0)
    best = {}
    for p, c in files:
        c = c or b""
        if c not in best or key(p) > key(best[c]):
            best[c] = p
    for p, c in files:
        c = c or b""
        first = len(c) < least or (p == best[c] and c not in taken)
        if first and len(c) >= least:
            taken.add(c)
        out.append((p, len(c), hashlib.sha1(c).hexdigest(), "response" if first else "revisit", None if first else best[c]))
    return sorted(out, key=repr)


def collection():
    rnd = random.Random(2)
    files = [(f"raw/class {i % 3}/{i}.jpg", rnd.randbytes(rnd.randint(0, 3000))) for i in range(60)]
    same = rnd.randbytes(5000)
    files += [(f"raw/copy/{i}.jpg", same) for i in range(40)] + [("raw/small/1.png", b"abc\r\n\r\nWARC/1.1\r\n\r\n"), ("raw/small/2.png", b"abc\r\n\r\nWARC/1.1\r\n\r\n")]
    return files + [("raw/none.gif", None), ("raw/empty.gif", b""), ("raw/long.bmp", bytes(3_000_000)), ("raw/copy/39.jpg", same), ("raw/copy/39.jpg", same)]


def test_round_trip(spark, tmp_path):
    files = collection()
    frame = spark.createDataFrame([(p, c, 1, "x") for p, c in files], SCHEMA).repartition(5)
    index = archives.archive_files(frame, str(tmp_path))
    got = archives.read_files(index, str(tmp_path)).collect()
    plain = lambda p: p and p.replace(" ", "%20")
    assert sorted(((r["path"], r["bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == sorted(
        ((plain(p), n, d, t, plain(f)) for p, n, d, t, f in brute(files)), key=repr
    )
    stored = {plain(p): c or b"" for p, c in files}
    assert all(bytes(r["content"]) == stored[r["path"]] for r in got if r["record_type"] == "response")
    assert all(bytes(r["content"]) == stored[r["path"]] for r in archives.with_content(archives.read_files(index, str(tmp_path))).collect())
    # every archive is a gzip file of whole records, and the index covers it without a gap
    spans = {}
    for r in index.collect():
        spans.setdefault(r["archive"], []).append((r["offset"], r["length"]))
    for name, found in spans.items():
        data = (tmp_path / name).read_bytes()
        end = 0
        for at, n in sorted(found):
            assert at == end and gzip.decompress(data[at : at + n]).startswith(b"WARC/1.1\r\n")
            end = at + n
        assert end == len(data)


def test_selected_records_and_reads(spark, tmp_path):
    frame = spark.createDataFrame([(p, c, 1, "x") for p, c in collection()], SCHEMA).coalesce(1)
    index = archives.archive_files(frame, str(tmp_path), archive_bytes=20_000)
    assert index.select("archive").distinct().count() > 3
    some = index.filter("url like '%class%20%1/%' or url like '%class 1/%'")
    some = some.unionByName(some)  # asked for twice
    got = {r["url"] for r in archives.read_files(some, str(tmp_path)).collect()}
    assert got == {p.replace(" ", "%20") for p, _ in collection() if "class 1/" in p}
    for gap, size in ((0, 1), (0, 8_000_000), (10**9, 10**9), (100, 3000)):
        found = archives.reads(index, gap, size).collect()
        held = sorted((r["archive"], x["offset"], x["length"]) for r in found for x in r["records"])
        assert held == sorted((r["archive"], r["offset"], r["length"]) for r in index.select("archive", "offset", "length").collect())
        assert all(r["start"] == r["records"][0]["offset"] and r["stop"] == max(x["offset"] + x["length"] for x in r["records"]) for r in found)
        assert all(r["records"][-1]["offset"] - r["start"] < size for r in found)
    every = archives.reads(index, 10**9, 10**9)
    assert every.count() == index.select("archive").distinct().count()
    assert archives.reads(index.filter("offset = 0"), 0).count() == every.count()


def test_scanned_images(spark, tmp_path):
    (tmp_path / "raw/guava").mkdir(parents=True)
    for i in range(4):
        (tmp_path / f"raw/guava/{i}.jpg").write_bytes(bytes([i // 2]) * 2000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "raw"))
    found = archives.read_files(archives.archive_files(files, str(tmp_path / "out")), str(tmp_path / "out")).collect()
    kinds = sorted((r["path"].rsplit("/", 1)[1], r["record_type"], (r["refers_to"] or "").rsplit("/", 1)[-1]) for r in found)
    assert kinds == [("0.jpg", "revisit", "1.jpg"), ("1.jpg", "response", ""), ("2.jpg", "revisit", "3.jpg"), ("3.jpg", "response", "")]


def test_damaged_and_empty(spark, tmp_path):
    empty = archives.archive_files(spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert empty.count() == 0 and archives.read_files(empty, str(tmp_path)).count() == 0
    record = archives.build_record("a", "a b", b"content", 7, hashlib.sha1(b"content").hexdigest(), None, "text/plain")
    assert archives.parse_record(record)["content"] == b"content" and archives.parse_record(record)["url"] == "a%20b"
    for bad in (record.replace(b"content\r\n", b"konTent\r\n"), record[:-1], record + b"x", b"x" + record):
        with pytest.raises(ValueError):
            archives.parse_record(bad)


def check_op11(df, rows):
    want = brute([(r["page_id"], None if r["html"] is None else r["html"].encode()) for r in rows])
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()]
    assert sorted(got, key=repr) == want


def test_op11_query(spark):
    check_op11(driver.queries()["op11_warc"](spark, SF), spark.read.parquet(f"{SF}/pages.parquet").collect())


def test_op11_query_on_odd_rows(spark, tmp_path):
    html = "<p>é\r\n\r\n</p>" * 100
    rows = [(i, f"http://x/{i}", html, "d") for i in range(30)] + [(9, "http://x/9b", html + "!", "d"), (29, None, html, "d"), (40, "u\r\nWARC-Type: x", "", "d"), (41, "u", None, "d"), (42, "u", None, "d"), (None, "n", html + "?", "d"), (None, "n", html + "?", "d")]
    rows += [(50, "s", "x" * 999, "d"), (51, "s", "x" * 999, "d"), (52, "s", "x" * 1000, "d"), (53, "s", "x" * 1000, "d")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    table.write.parquet(f"{tmp_path}/pages.parquet")
    check_op11(driver.queries()["op11_warc"](spark, str(tmp_path)), table.collect())
