"""Web archives written and read as a table of chunks.

A payload is a run of rows (record, chunk, data) of bounded size from the moment it leaves
its source: a chunk becomes one record of the archive (a response, or a continuation of
one, as the format's segments provide), and reading gives the same rows back. Digests of
payloads in several chunks are carried along from chunk to chunk, so no step but the source
holds a whole payload.

Archives are lines of Spark's text format whose ends are the blank lines between records,
and are read in lines that end where the next record's version stands; no chunk contains
that version, as writing cuts it in two. So they are written and read in parallel, by
Spark's own committing writers, on any file system it knows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet.llm.store import bounded_batches, written

VERSION = "WARC/1.1\r\n"
_BLANK = "\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _cuts(payload: Column, chunk_chars: int) -> Column:
    """Where chunks begin: every ``chunk_chars`` characters, and inside of each version line in the payload."""
    parts = F.split(payload, VERSION.replace(".", r"\."), -1)
    seen = F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("n"))
    step = F.aggregate(
        F.slice(parts, 1, F.size(parts) - 1),
        seen,
        lambda s, part: F.struct(F.array_append(s.at, s.n + F.length(part) + 5).alias("at"), (s.n + F.length(part) + len(VERSION)).alias("n")),
    )
    even = F.sequence(F.lit(0), F.greatest(F.length(payload) - 1, F.lit(0)), F.lit(chunk_chars))
    return F.when(F.contains(payload, F.lit(VERSION)), F.array_sort(F.array_union(even, step.at))).otherwise(even)


def chunk_table(pages: DataFrame, *, key: str, url: str, payload: str, chunk_chars: int = 1 << 16) -> DataFrame:
    """record, key, url, chunk, last, data: the payloads in chunks, written to the shared folder.

    ``record`` numbers the rows of ``pages``. A null payload is empty; an empty one has one empty chunk.
    """
    named = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"))
    named = named.withColumn("record", F.monotonically_increasing_id()).withColumn("cuts", _cuts(F.col("payload"), chunk_chars))
    chunks = named.select("*", F.posexplode("cuts").alias("chunk", "start"))
    end = F.coalesce(F.get("cuts", F.col("chunk") + 1), F.length("payload"))
    data = F.when(F.size("cuts") == 1, F.col("payload")).otherwise(F.substring("payload", F.col("start") + 1, end - F.col("start")))
    return written(chunks.select("record", "key", "url", "chunk", (F.col("chunk") == F.size("cuts") - 1).alias("last"), data.alias("data")))


def _carried_digests(kind: pa.DataType):
    """Chunks in order in; the digest and size of each record out, from a state that goes on from chunk to chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, state, size, expected, broken = None, hashlib.sha1(), 0, 0, False
        done: tuple[list, list, list] = ([], [], [])

        def close() -> None:
            if record is not None:
                for column, value in zip(done, (record, size, None if broken or expected != -1 else state.hexdigest()), strict=True):
                    column.append(value)

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(done[0], kind), pa.array(done[1], pa.int64()), pa.array(done[2], pa.string())], ["record", "bytes", "sha1"])
            for column in done:
                column.clear()
            return out

        for rows in batches:
            for name, chunk, last, data in zip(*(rows[c] for c in ("record", "chunk", "last", "data")), strict=True):
                if name.as_py() != record:
                    close()
                    record, state, size, expected, broken = name.as_py(), hashlib.sha1(), 0, 0, False
                value = data.as_py()
                state.update(value)
                size += len(value)
                broken |= chunk.as_py() != expected
                expected = -1 if last.as_py() else expected + 1
            yield batch()
        close()
        yield batch()

    return run


def digests(chunks: DataFrame) -> DataFrame:
    """record, bytes, sha1 of each record of ``chunks`` (record, chunk, last, data).

    Records of one chunk are digested where they are; the others are put in order and
    streamed. A record with a missing or repeated chunk has no digest.
    """
    bounded_batches(chunks, 256)
    binary = F.col("data").cast("binary")
    whole = F.col("last") & (F.col("chunk") == 0)
    single = chunks.filter(whole).select("record", F.octet_length(binary).cast("long").alias("bytes"), F.sha1(binary).alias("sha1"))
    kind = chunks.schema["record"].dataType.simpleString()
    several = chunks.filter(~whole).select("record", "chunk", "last", binary.alias("data"))
    ordered = several.repartition("record").sortWithinPartitions("record", "chunk")
    arrow = {"bigint": pa.int64(), "string": pa.string()}[kind]
    return single.unionByName(ordered.mapInArrow(_carried_digests(arrow), f"record {kind}, bytes long, sha1 string"))


def _record_id(number: Column, archive: str) -> Column:
    """A URN that belongs to a record of this archive."""
    h = F.md5(F.concat(F.lit(f"{archive}|"), number.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(fields: list[tuple[str, Column | None]]) -> Column:
    """Header lines of the fields whose value is not null."""
    return F.concat_ws("\r\n", *(F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields))


def _record(kind: str, fields: list[tuple[str, Column]], block: Column) -> Column:
    head = _lines([("WARC-Type", F.lit(kind)), *fields, ("Content-Length", F.octet_length(block))])
    return F.concat(F.lit(VERSION), head, F.lit(_BLANK), block)


def write_archives(pages: DataFrame, path: str, *, key: str, url: str, payload: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z", chunk_chars: int = 1 << 16) -> None:
    """Writes a record per row of ``pages`` to compressed archives, one per task, in the folder ``path``.

    Of the records with equal payloads of at least ``least`` bytes, the one with the largest
    key is a response (of several with that key, any: they are alike but for their URL); the
    others are revisits of it and hold no payload. All smaller ones are responses. Null keys
    are smallest. Control characters in a URL become %20; a null URL has no header.
    """
    archive = uuid.uuid4().hex
    chunks = chunk_table(pages, key=key, url=url, payload=payload, chunk_chars=chunk_chars)
    first = chunks.filter("chunk = 0").select("record", "key", "url", "last")
    # Sizes and digests are narrow; they are written before they are joined, so that a join can split a frequent payload.
    records = written(digests(chunks).join(first, "record"))
    shared = records.filter(F.col("bytes") >= least)
    chosen = shared.groupBy("sha1", "bytes").agg(F.max(F.struct("key", (-F.col("record")).alias("number"), "url")).alias("of"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha1", "bytes", "of")
    revisits = written(shared.join(written(chosen), ["sha1", "bytes"]).filter("record != -of.number").select("record", "key", "url", "sha1", "of"))

    def named(number: Column, key: Column, url: Column) -> list[tuple[str, Column]]:
        address = F.regexp_replace(url, r"[\x00-\x20\x7f]+", "%20")
        return [("WARC-Record-ID", _record_id(number, archive)), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", address), ("X-Record-Key", F.url_encode(key.cast("string")))]

    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"), F.lit(_BLANK))
    own = named(F.col("record"), F.col("key"), F.col("url"))
    sha1 = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))
    again = _record(
        "revisit",
        [*own, http, sha1, ("WARC-Profile", F.lit(_REVISIT)), ("WARC-Refers-To", _record_id(-F.col("of.number"), archive)), ("WARC-Refers-To-Target-URI", F.regexp_replace("of.url", r"[\x00-\x20\x7f]+", "%20"))],
        answer,
    )
    stored = chunks.join(revisits.select("record"), "record", "left_anti")
    whole = F.col("last") & (F.col("chunk") == 0)
    single = stored.filter(whole).withColumn("sha1", F.sha1(F.col("data").cast("binary")))
    single = single.select(_record("response", [*own, http, sha1], F.concat(answer, F.col("data"))).alias("value"))
    several = stored.filter(~whole).join(records.filter("not last").select("record", "sha1", "bytes"), "record")
    segment = ("WARC-Segment-Number", F.col("chunk") + 1)
    begin = _record("response", [*own, http, sha1, segment], F.concat(answer, F.col("data")))
    part = [("WARC-Record-ID", _record_id(F.concat_ws("/", "record", "chunk"), archive)), ("WARC-Date", F.lit(date)), segment, ("WARC-Segment-Origin-ID", _record_id(F.col("record"), archive))]
    total = ("WARC-Segment-Total-Length", F.when(F.col("last"), F.col("bytes") + F.octet_length(answer)))
    several = several.select(F.when(F.col("chunk") == 0, begin).otherwise(_record("continuation", [*part, total], F.col("data"))).alias("value"))
    lines = single.union(several).union(revisits.select(again.alias("value")))
    lines.write.option("lineSep", _BLANK).option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives at ``path``: id, type, key, url, sha1, refers_to, origin, chunk, last, data.

    ``data`` is the payload: the block of a response without its HTTP header. Fails at a record
    that is shorter or longer than it says (also where a foreign archive has the version line
    in a payload), so that nothing is lost unseen.
    """
    lines = spark.read.option("lineSep", "\n" + VERSION).text(path)
    text = F.when(F.startswith("value", F.lit(VERSION)), F.substring("value", len(VERSION) + 1, 2**31 - 1)).otherwise(F.col("value"))
    head = F.substring_index("text", _BLANK, 1)
    rows = lines.select(text.alias("text")).filter("text != ''").select(head.alias("head"), F.col("text").cast("binary").alias("bytes"))

    def field(name: str) -> Column:
        value = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
        return F.when(value != "", value)

    offset = F.octet_length("head") + len(_BLANK)
    length = field("Content-Length").cast("int")
    rest = F.substring("bytes", offset + length + 1, F.lit(8)).cast("string")
    fits = (offset + length <= F.octet_length("bytes")) & (F.regexp_replace(rest, "[\r\n]", "") == "")
    block = F.when(F.coalesce(fits, F.lit(False)), F.substring("bytes", offset + 1, length)).otherwise(F.raise_error(F.concat(F.lit("not one whole record: "), F.substring("head", 1, 200))))
    rows = rows.select("head", block.alias("block"))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), _BLANK, 1)) + len(_BLANK)
    after = F.substring("block", http + 1, F.octet_length("block"))
    segment = F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1))
    return rows.select(
        field("WARC-Record-ID").alias("id"),
        field("WARC-Type").alias("type"),
        F.url_decode(field("X-Record-Key")).alias("key"),
        field("WARC-Target-URI").alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("sha1"),
        field("WARC-Refers-To").alias("refers_to"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin"),
        (segment - 1).alias("chunk"),
        (field("WARC-Segment-Number").isNull() | field("WARC-Segment-Total-Length").isNotNull()).alias("last"),
        F.when(F.coalesce(field("Content-Type"), F.lit("")).startswith("application/http"), after).otherwise(F.col("block")).alias("data"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """key, url, payload_bytes, payload_digest, record_type, refers_to (a key) of every response and revisit at ``path``.

    Size and digest are of the whole payload as read back, a revisit's those of the response
    that it names. Fails where a payload is not what its record says, a chunk is missing, or a
    revisit names no response of the same digest.
    """
    records = read_records(spark, path)
    payloads = records.filter("type in ('response', 'continuation')").select(F.col("origin").alias("record"), "chunk", "last", "data")
    # The digests are written before revisits are joined to them, so that a response with very many of them can be split.
    found = records.filter("type = 'response'").select("id", "key", "url", F.col("sha1").alias("said"))
    responses = written(digests(payloads).join(found, F.col("record") == F.col("id"), "full_outer").select("id", "key", "url", "said", "bytes", "sha1"))
    right = F.col("said") == F.col("sha1")
    checked = F.when(F.coalesce(right, F.lit(False)), F.col("sha1")).otherwise(F.raise_error(F.concat(F.lit("payload and digest differ: "), F.coalesce("id", F.lit("")))))
    stored = responses.select("key", "url", F.col("bytes").alias("payload_bytes"), checked.alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"))
    again = records.filter("type = 'revisit'").select("key", "url", F.col("sha1").alias("said"), "refers_to", F.col("id").alias("own"))
    again = again.join(responses.select(F.col("id").alias("refers_to"), F.col("key").alias("first"), "bytes", "sha1"), "refers_to", "left")
    named = F.when(F.coalesce(right, F.lit(False)), F.col("sha1")).otherwise(F.raise_error(F.concat(F.lit("no such payload: "), "own")))
    revisits = again.select("key", "url", F.col("bytes").alias("payload_bytes"), named.alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("first").alias("refers_to"))
    return stored.unionByName(revisits)
