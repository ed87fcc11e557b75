"""WARC archives of files: an index of byte ranges first, then coalesced reads of the records that are asked for.

Every task writes its files as gzip members, one per record, into an archive of its own name and lists them in the index:
archive, offset, length, URL, digest, type. The index is a table that Spark commits, so an archive of a task that was
lost or ran twice is named by no row. Reading starts from the index: it is filtered first, and the byte ranges of the
records that are left are sorted and joined to few reads per archive.

Equal files of at least ``MIN_BYTES`` bytes are kept once, by the one with the largest path; the others are revisit
records that refer to it. Only digests are compared, so no content is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import broadcast_if_small, stored
from labelops.llm.sequences import join_counted, numbered
from labelops.sources.folders import filesystem

#: Smaller files are kept whole, a reference would not be shorter.
MIN_BYTES = 1000
#: An archive is closed when it has reached this size.
ARCHIVE_BYTES = 1_000_000_000
#: Bytes between two ranges that are read rather than skipped, and the size at which a read ends.
GAP_BYTES, READ_BYTES = 64_000, 8_000_000
#: The WARC version line, the revisit profile of equal payloads, the end of a record.
VERSION, PROFILE, END = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"\r\n\r\n"
#: Fixed value: the date of records whose files carry none, so that archives repeat byte for byte.
NO_DATE = "1970-01-01T00:00:00Z"
INDEX = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("bytes", T.LongType()),
])
WHITE = re.compile(r"[\x00-\x20\x7f]")


# --- records ------------------------------------------------------------------------------------


def _field(value: str) -> str:
    """A header value on one line; white space and control characters are percent-encoded."""
    return WHITE.sub(lambda m: f"%{ord(m[0]):02X}", value)


def record_id(key: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {digest}')}>"


def build_record(key: str, url: str, content: bytes | None, size: int, digest: str, refers_to: str | None, kind: str) -> bytes:
    """A response record, or without content a revisit record of the file with the key ``refers_to``; keys are kept in headers."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nContent-Length: {size}\r\n\r\n".encode() + (content or b"")
    lines = [
        VERSION, f"WARC-Type: {'revisit' if content is None else 'response'}", f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {NO_DATE}",
        f"WARC-Target-URI: {_field(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Record-Key: {_field(key)}",
    ]
    if content is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Key: {_field(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + END


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "surrogatepass").partition(": ")
        found[name] = value
    return found, rest


def parse_record(data: bytes) -> dict:
    """Header values and content of one record; a record that does not hold what its headers say is an error."""
    if not data.startswith(VERSION.encode()):
        raise ValueError("not a WARC record")
    warc, rest = _headers(data)
    size = int(warc["Content-Length"])
    if len(rest) != size + len(END) or rest[size:] != END:
        raise ValueError(f"record of {warc.get('WARC-Target-URI')} ends in the wrong place")
    http, content = _headers(rest[:size])
    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(content).hexdigest() != digest:
        raise ValueError(f"content of {warc.get('WARC-Target-URI')} differs from its digest")
    return {
        "url": warc["WARC-Target-URI"], "digest": digest, "record_type": kind, "content": content if kind == "response" else None,
        "bytes": int(http["Content-Length"]), "key": warc["X-Record-Key"], "refers_to": warc.get("X-Refers-To-Key"),
    }


# --- writing ------------------------------------------------------------------------------------


def _repeats(rows: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Files that an equal file with a larger path replaces, and equal files of one path; without their content."""
    large = rows.filter(F.col("bytes") >= min_bytes)
    groups = stored(large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("path").alias("kept")).filter("n > 1"))
    found = stored(join_counted(large, groups, ["digest"], "n"))
    same = F.col("path").eqNullSafe(F.col("kept"))
    last = F.coalesce(F.col("kept").cast("string"), F.lit("")).alias("refers_to")
    again = found.filter(same).groupBy("digest").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("digest")
    again = found.filter(same).join(again, "digest", "left_semi").select("digest", "path", "key", "url", "bytes", last)
    return found.filter(~same).select("digest", "path", "key", "url", "bytes", last), numbered(again, "digest", [F.col("url")])


def archive_files(
    files: DataFrame, folder: str, path_col: str = "path", content_col: str = "content", url_col: str | None = None,
    min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES, kind: str = "application/octet-stream",
) -> DataFrame:
    """Write one WARC record per file, and the index: archive, offset, length, url, digest (SHA-1), record_type, bytes.

    ``files`` has a path and binary content, as Spark's ``binaryFile`` lists a collection; ``url_col`` is the path unless
    given. NULL content is empty, a NULL path or URL is written as empty text. Of files with equal content of
    at least ``min_bytes`` bytes the one with the largest path (NULL is the smallest) is a response record and the others are revisit records;
    smaller files are response records each. Of repeated rows of that path one is the response. An empty frame gives
    an empty index. The index is written below the folder too (``index``) and is what names the archives: a file that
    no index row names is no part of the collection. ``folder`` is one that executors can write to. Other columns may have any name.
    """
    content = F.coalesce(F.col(content_col), F.lit(b""))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = files.select(F.col(path_col).alias("path"), text(path_col).alias("key"), text(url_col or path_col).alias("url"), F.length(content).cast("long").alias("bytes"), F.sha1(content).alias("digest"), content.alias("content"))
    replaced, again = [stored(x) for x in _repeats(stored(rows.drop("content")), min_bytes)]
    known = broadcast_if_small(stored(replaced.select("digest", "path").unionByName(again.select("digest", "path")).distinct()).withColumnsRenamed({"digest": "_digest", "path": "_path"}))
    match = (F.col("digest") == F.col("_digest")) & F.col("path").eqNullSafe(F.col("_path"))
    none = F.lit(None).cast("string").alias("refers_to")
    columns = ["key", "url", "bytes", "digest", "content", "refers_to"]
    alone = rows.join(known, match, "left_anti").withColumn("refers_to", none).select(columns)
    first = again.filter("pos = 0").select("key", "url", F.col("digest").alias("_digest"), F.col("path").alias("_path"))
    bodies = rows.join(broadcast_if_small(stored(first)).select("_digest", "_path"), match).groupBy("digest").agg(F.first("content").alias("content"), F.first("bytes").alias("bytes"))
    first = bodies.join(first.withColumnRenamed("_digest", "digest"), "digest").withColumn("refers_to", none).select(columns)
    revisits = replaced.select("key", "url", "bytes", "digest", "refers_to").unionByName(again.filter("pos > 0").select("key", "url", "bytes", "digest", "refers_to"))
    revisits = revisits.withColumn("content", F.lit(None).cast("binary")).select(columns)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        name = stream = None
        at = 0
        try:
            for batch in batches:
                out: list[tuple] = []
                for key, url, size, digest, body, refers_to in zip(*batch.columns):
                    if stream is None:
                        name, at = f"{uuid.uuid4()}.warc.gz", 0
                        fs.create_dir(root, recursive=True)
                        stream = fs.open_output_stream(f"{root}/{name}", compression=None)
                    key, url, size, digest, body, refers_to = (x.as_py() for x in (key, url, size, digest, body, refers_to))
                    member = gzip_member(build_record(key, url, body, size, digest, refers_to, kind))
                    stream.write(member)
                    out.append((name, at, len(member), url, digest, "revisit" if body is None else "response", size))
                    at += len(member)
                    if at >= archive_bytes:
                        stream.close()
                        stream = None
                if out:
                    yield _arrow(out, INDEX)
        finally:
            if stream is not None:
                stream.close()

    index = alone.unionByName(first).unionByName(revisits).mapInArrow(write, INDEX)
    index.write.mode("overwrite").parquet(f"{folder}/index")
    return files.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _arrow(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [[] for _ in target]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)


# --- reading ------------------------------------------------------------------------------------


def reads(index: DataFrame, gap: int = GAP_BYTES, size: int = READ_BYTES) -> DataFrame:
    """(archive, start, stop, records): byte ranges that hold the index rows, sorted, joined over gaps up to ``gap``.

    A read ends at ``size`` bytes or with the record that crosses it. An archive's rows are sorted in one task; its size bounds them.
    """
    place = Window.partitionBy("archive").orderBy("offset")
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    far = F.coalesce(F.col("offset") > F.lag(F.col("offset") + F.col("length")).over(place) + gap, F.lit(True))
    found = index.select("archive", "offset", "length").distinct().withColumn("far", far)
    found = found.withColumn("run", F.sum(F.col("far").cast("long")).over(upto))
    begin = F.min("offset").over(Window.partitionBy("archive", "run"))
    found = found.withColumn("part", F.floor((F.col("offset") - begin) / size))
    return found.groupBy("archive", "run", "part").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")
    ).select("archive", "start", "stop", "records")


RECORD = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("path", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("bytes", T.LongType()), T.StructField("content", T.BinaryType()),
])


def read_files(index: DataFrame, folder: str, gap: int = GAP_BYTES, size: int = READ_BYTES) -> DataFrame:
    """The records of index rows: archive, offset, path, url, digest, record_type, refers_to (a path), bytes, content.

    Filter the index first; only the byte ranges of its rows are read, in few reads. Each record is checked against
    its headers and a response's content against its digest. A revisit has NULL content (``with_content`` adds it).
    Repeated index rows give one record; an empty index gives none. White space in paths and URLs is percent-encoded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{root}/{r['archive']}") as source:
                    source.seek(r["start"])
                    data = memoryview(source.read(r["stop"] - r["start"]))
                out, held = [], 0
                for x in r["records"]:
                    at = x["offset"] - r["start"]
                    p = parse_record(zlib.decompress(data[at : at + x["length"]], 31))
                    out.append((r["archive"], x["offset"], p["key"], p["url"], p["digest"], p["record_type"], p["refers_to"], p["bytes"], p["content"]))
                    held += p["bytes"]
                    if held >= size:
                        yield _arrow(out, RECORD)
                        out, held = [], 0
                if out:
                    yield _arrow(out, RECORD)

    return reads(index, gap, size).mapInArrow(run, RECORD)


def with_content(records: DataFrame) -> DataFrame:
    """Revisit records with the content of the response they refer to, by digest; the responses must be among the records."""
    bodies = records.filter("record_type = 'response'").groupBy("digest").agg(F.first("content").alias("_content"))
    found = records.filter("record_type = 'revisit'").join(bodies, "digest", "left").withColumn("content", F.col("_content")).select(records.columns)
    return records.filter("record_type = 'response'").unionByName(found)
