"""WARC archives: writing with revisits and segments, reading back with reassembly.

Writing. Payloads are HTTP response bodies in chunked transfer framing. A block longer than SEGMENT bytes becomes several
records: the first (segment 1) and continuations that name it as their origin, the last with the total length. Records are
lines of a text file with the record separator as line end, so Spark writes real WARC files (gzip) to any store it can
write to. No block of ours holds the separator that the reader looks for: chunks and segments end inside it.

Reading. Files are cut at that separator and the pieces put together by the records' own lengths, so archives of others,
whose payloads may hold it, are read too. Continuations are grouped by their origin, ordered by segment number, joined and
checked against the total length; then the chunked framing is decoded. Records of one segment need no grouping.

Of records with equal payloads of at least REVISIT_FROM bytes the one with the largest id is the response, the others
are revisits that refer to it and have no body. A null payload is empty. Every row is a record of its own, named by the
page's id and a UUID, so repeated rows and rows without an id come back one by one. A record whose id is null is written
and read like others, but nothing refers to it and it never revisits. An empty table gives an empty
archive.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import narrowed
from kindred.session import discarded, removed, scratch, settled

#: Block bytes in a record, and chunk bytes in a block. Longer pages are written in segments.
SEGMENT, CHUNK = 1 << 14, 1 << 12
REVISIT_FROM = 1000
#: Block bytes that a task hands on at a time.
BATCH_BYTES = 4 << 20
VERSION = b"WARC/1.1"
#: Between two records, with what begins the next one: a reader cuts here.
_MARK = VERSION + b"\r\n"
_END = b"\r\n\r\n"
RECORD_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, origin_id string, segment int, total_length long, payload_digest string, block binary"


def chunked(payload: bytes) -> bytes:
    """The payload in chunked framing. A chunk ends inside each mark of the payload, and inside what the line end behind the
    chunk would complete to one."""
    out, at = [], 0
    while at < len(payload):
        stop = min(at + CHUNK, len(payload))
        mark = payload.find(_MARK, at, stop)
        if mark < 0 and payload.endswith(VERSION, at, stop):
            mark = stop - len(VERSION)
        if mark >= 0:
            stop = mark + 4
        out.append(b"%x\r\n%b\r\n" % (stop - at, payload[at:stop]))
        at = stop
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def segments(block: bytes) -> list[bytes]:
    """The block in parts of SEGMENT bytes, less where the line end behind a part would complete it to a mark."""
    out, at = [], 0
    while at < len(block):
        stop = at + SEGMENT
        if stop < len(block) and block.endswith(VERSION, at, stop):
            stop -= 4
        out.append(block[at:stop])
        at = stop
    return out


def dechunked(body: bytes) -> bytes:
    """What chunked framing holds; a broken frame is an error."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        if len(out[-1]) != size:
            raise ValueError("a chunk is cut short")
        at = line + 2 + size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its closing separator."""
    head = b"".join(b"%b: %b\r\n" % (k.encode(), str(v).encode()) for k, v in headers if v is not None)
    return b"%b%bContent-Length: %d\r\n\r\n%b" % (_MARK, head, len(block), block)


def response_records(record_id: str, uri: str, payload: bytes, digest: str) -> list[bytes]:
    """A response's records: one, or several segments."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    own = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= SEGMENT:
        return [record(own, block)]
    parts = segments(block)
    out = [record([*own, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}/{k}>"), ("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", k)]
        out.append(record([*more, ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)], part))
    return out


def revisit_record(record_id: str, uri: str, digest: str, refers_to: str) -> bytes:
    return record(
        [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Type", "application/http; msgtype=response")],
        b"HTTP/1.1 200 OK\r\n\r\n",
    )


def page_of(name: str) -> Column:
    """The page id in a column of record names."""
    return F.expr(f"try_cast(substring_index(substring_index({name}, 'urn:page:', -1), ':', 1) as long)")


def write(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Writes gzip'd WARC files to the folder. Records are named first, in a settled table, as names have to stay the same
    where others refer to them. Equal payloads are found by digest and length; the aggregate leaves a row for each task and
    payload, and the join back is one that Spark splits where a payload is common."""
    pages = narrowed(df, id=(id_col, "long"), url=(url_col, "string"), payload=(payload_col, "string"))
    pages = pages.withColumn("payload", F.coalesce("payload", F.lit("")).cast("binary"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.expr("uuid()"))
    pages = settled(pages.withColumns({"digest": F.unhex(F.sha1("payload")), "length": F.octet_length("payload"), "name": name}), "named-pages")
    large = pages.where((F.col("length") >= REVISIT_FROM) & F.col("id").isNotNull())
    repeated = large.groupBy("digest", "length").agg(F.max(F.struct("id", "name")).alias("newest"), F.min("id").alias("oldest")).where("newest.id > oldest")
    repeated = settled(repeated.select("digest", F.col("newest.id").alias("newest"), F.col("newest.name").alias("target")), "repeated-payloads")
    marked = pages.join(repeated, "digest", "left")

    def records(batches):
        for batch in batches:
            out = []
            ids, names, urls, payloads, newest, targets = (batch.column(i).to_pylist() for i in range(6))
            for page, own, url, payload, last, target in zip(ids, names, urls, payloads, newest, targets, strict=True):
                digest, uri = hashlib.sha1(payload).hexdigest(), re.sub(r"[\r\n]", " ", url) if url else "urn:none"
                if last is not None and page is not None and page != last:
                    out.append(revisit_record(own, uri, digest, target))
                else:
                    out += response_records(own, uri, payload, digest)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    lines = marked.select("id", "name", "url", "payload", "newest", "target").mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", _END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    discarded(pages, repeated)


_HEAD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*\r?$", re.M)


def parse(line: bytes) -> tuple | None:
    """A record's columns (see RECORD_SCHEMA) from its bytes after the version line."""
    head, found, rest = line.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = {k.lower(): v.decode("utf-8", "replace") for k, v in _HEAD.findall(head)}
    length = int(fields.get(b"content-length", "0"))
    if len(rest) < length:
        raise ValueError(f"record {fields.get(b'warc-record-id')} is cut short: {len(rest)} of {length} bytes")

    def name(key: bytes):
        return fields[key].strip("<>") if key in fields else None

    segment, total = fields.get(b"warc-segment-number"), fields.get(b"warc-segment-total-length")
    digest = fields.get(b"warc-payload-digest")
    return name(b"warc-record-id"), fields.get(b"warc-type"), fields.get(b"warc-target-uri"), name(b"warc-refers-to"), name(b"warc-segment-origin-id"), segment and int(segment), total and int(total), digest and digest.partition(":")[2], rest[:length]


def _needed(line: bytes) -> int | None:
    """Bytes of the record that begins the line, by its own length; None where the line has no end of a header."""
    head, found, _ = line.partition(_END)
    if not found:
        return None
    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return len(head) + len(_END) + (int(length[1]) if length else 0)


def parsed(lines):
    """The records of (file, line) pieces in the order of the files. A record whose payload holds the separator is several
    lines, put together until its length is reached. A line can hold several records, as the reader misses a separator that
    goes over the end of its buffer when what comes before looks like its beginning."""
    parts, have, need, current = [], 0, 0, None
    for file, line in lines:
        if file != current:
            if parts and need is not None:
                raise ValueError(f"the last record of {current} is cut short: {have} of {need} bytes")
            parts, have, current, line = [], 0, file, line.removeprefix(_MARK)
        elif parts:
            line = _END + _MARK + line
        parts.append(line)
        have += len(line)
        if len(parts) == 1 or need is None:
            # a header that ends where its block begins with a mark was cut there
            need = _needed(b"".join(parts))
        while parts and need is not None and have >= need:
            whole = parts[0] if len(parts) == 1 else b"".join(parts)
            parts, have = [], 0
            yield parse(whole)
            if whole.startswith(_END + _MARK, need):
                rest = whole[need + len(_END) + len(_MARK) :]
                parts, have, need = [rest], len(rest), _needed(rest)
    if parts and need is not None:
        raise ValueError(f"the last record of {current} is cut short: {have} of {need} bytes")


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records of a folder of archives. A compressed file is read by one task, in order."""
    lines = spark.read.option("lineSep", (_END + _MARK).decode()).text(path).select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("line"))

    def run(batches):
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary())
        names = ["record_id", "record_type", "target_uri", "refers_to", "origin_id", "segment", "total_length", "payload_digest", "block"]
        pieces = (x for batch in batches for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        rows, size = [], 0
        for row in parsed(pieces):
            rows.append(row)
            size += len(row[-1])
            if size > BATCH_BYTES or len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return lines.mapInArrow(run, RECORD_SCHEMA)


def reassembled(found: DataFrame) -> DataFrame:
    """Whole records: continuations joined to the record they go on. A group is one record's segments; numbers have to
    run from 1 and the lengths to add up to the total."""
    single = found.where("segment is null").drop("origin_id", "segment", "total_length")
    parts = found.where("segment is not null").withColumn("origin", F.coalesce("origin_id", "record_id"))
    own = F.col("segment") == 1
    groups = parts.groupBy("origin").agg(
        F.max(F.when(own, F.col("record_type"))).alias("record_type"),
        F.max(F.when(own, F.col("target_uri"))).alias("target_uri"),
        F.max(F.when(own, F.col("refers_to"))).alias("refers_to"),
        F.max(F.when(own, F.col("payload_digest"))).alias("payload_digest"),
        F.max("total_length").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    block = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["block"]))
    whole = groups.withColumn("block", block)
    right = (F.size("parts") == F.element_at("parts", -1)["segment"]) & (F.octet_length("block") == F.col("total"))
    whole = whole.withColumn("block", F.when(right, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("segments are missing of "), F.col("origin")))))
    return single.unionByName(whole.select(F.col("origin").alias("record_id"), "record_type", "target_uri", "refers_to", "payload_digest", "block"))


def payloads(whole: DataFrame) -> DataFrame:
    """Whole records with their payload: the HTTP body, its chunked framing decoded."""

    @F.pandas_udf("binary")
    def body(blocks):
        import pandas as pd

        out = []
        for block in blocks:
            head, _, rest = bytes(block).partition(b"\r\n\r\n")
            out.append(dechunked(rest) if re.search(rb"(?im)^transfer-encoding:\s*chunked", head) else rest)
        return pd.Series(out)

    return whole.withColumn("payload", body("block")).drop("block")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, target_uri, refers_to, payload_digest, payload) of every whole record."""
    return payloads(reassembled(records(spark, path)))


def op1(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(pages, path)
    found = read(spark, path)
    # a revisit has no body of its own; length and digest are those of the full payload it stands for
    found = found.select(
        "record_id",
        F.octet_length("payload").cast("long").alias("length"),
        F.sha1("payload").alias("own_digest"),
        F.col("payload_digest"),
        "record_type",
        "refers_to",
    )
    found = settled(found, "archive-index")
    removed(spark, path)
    first = found.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("length").alias("full"))
    targets = found.where("record_type = 'revisit'").select("refers_to").distinct()
    known = settled(first.join(targets, "refers_to", "left_semi"), "revisited")
    revisits = found.where("record_type = 'revisit'").join(known, "refers_to", "left").select(page_of("record_id").alias("page_id"), F.col("full").alias("payload_bytes"), "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))
    responses = found.where("record_type <> 'revisit'").select(page_of("record_id").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
