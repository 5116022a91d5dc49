"""WARC archives: written from rows, read back, segmented records put together.

**Writing** is DataFrame functions and Spark's text writer: a record's head and block are one value,
and the writer's line separator (CR LF) is the second half of the two that end a record.  Payloads
travel in HTTP responses in chunked transfer framing.  A block longer than ``segment`` bytes becomes a
first record and continuation records (``WARC-Segment-Number``, ``WARC-Segment-Origin-ID``, and
``WARC-Segment-Total-Length`` on the last), so that no record and, as the records of a file are
limited, no file grows with the longest payload.  Equal payloads are written once; the other records
are of type revisit and name the digest.

**Reading** takes every file apart by its records' lengths (gzip in one or many members, or plain).
Continuation records are grouped by the identifier of their origin, ordered by segment number, and
checked: numbers 1 to n without a gap, one block a number, the total length that the last one gives.
Then the chunked framing is decoded and the payload's digest compared.  What fails a check is a row
with its ``problem``, never an exception or a guess.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Scratch, ship

#: Bytes of a block beyond which it is continued in further records.
SEGMENT = 16_384
#: Bytes of a chunk of the transfer framing.
CHUNK = 4_096
#: Records of a file: at most 4,096 segments of 16 KB and their heads.
PER_FILE = 4_096

CRLF = "\r\n"
_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- writing -----------------------------------------------------------------------------------
def _parts(data: Column, size: Column, width: int, make: Callable[[Column], Column]) -> Column:
    """``make`` of each piece of ``width`` bytes of a binary column (none of an empty one)."""
    count = F.ceil(size / F.lit(width)).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), count),
                         lambda k: make(F.substring(data, (k - 1) * width + 1, F.lit(width))))
    return F.when(count > 0, pieces).otherwise(F.array().cast(T.ArrayType(T.StringType())))


def chunked(payload: Column, chunk: int = CHUNK) -> Column:
    """A binary column in chunked transfer framing, as bytes in a string column."""
    one = lambda p: F.concat(F.hex(F.octet_length(p)), F.lit(CRLF), p.cast("string"), F.lit(CRLF))
    return F.concat(F.array_join(_parts(payload, F.octet_length(payload), chunk, one), ""),
                    F.lit(f"0{CRLF}{CRLF}"))


def _field(name: str, value: Column) -> Column:
    """A line of a record's head; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def write_warc(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id",
               url_col: str = "url", payload_col: str = "html", least: int = 1000,
               date: str = "2024-01-01T00:00:00Z", segment: int = SEGMENT, chunk: int = CHUNK) -> None:
    """Write a record per row of ``pages`` into gzipped archives under ``path``.

    Of the records with equal payloads of ``least`` bytes or more, that of the largest id is the
    response and the others revisit it; smaller payloads are responses each.  Null payloads are
    empty, a null id counts as the smallest and a record without id has none in its head; rows that
    share the largest id are all responses.  Control characters and spaces are left out of a URL; a
    null one has no line.  Other columns are ignored, an empty table gives archives without a record.

    Digests are compared before texts move: rows that repeat a digest are counted with partial sums,
    and only the digests that repeat are joined back (Spark broadcasts them if they measure less than
    its threshold, and splits a payload that a third of all rows hold)."""
    scratch = Scratch(spark, "warc_digests")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"),
                        F.regexp_replace(F.col(url_col).cast("string"), r"[\x00-\x20\x7F]", "").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload"), "digest": F.sha1("payload")})
    shared = scratch.write(
        rows.filter(F.col("size") >= least).groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), F.max("id").alias("kept"), F.max_by("url", "id").alias("kept_url"))
        .filter("n > 1").select(F.col("digest").alias("shared"), "kept", "kept_url"), "shared")
    # a payload that is too small meets nothing, and need not gather with its equals
    meets = F.when(F.col("size") >= least, F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string")))
    rows = rows.withColumn("meets", meets).join(shared, F.col("meets") == F.col("shared"), "left")
    revisit = F.col("shared").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    rows = rows.select("id", "url", "digest", "kept", "kept_url", revisit.alias("revisit"), F.when(
        revisit, F.lit(_HEAD + CRLF)).otherwise(F.concat(
            F.lit(f"{_HEAD}Transfer-Encoding: chunked{CRLF}{CRLF}"), chunked(F.col("payload"), chunk)))
        .cast("binary").alias("block")).withColumn("record", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
    rows = rows.withColumn("total", F.octet_length("block"))
    parts = rows.select("*", F.posexplode(_parts(F.col("block"), F.col("total"), segment, lambda p: p.cast("string")))
                        .alias("k", "part")).drop("block")
    first, several = F.col("k") == 0, F.col("total") > segment
    last = (F.col("k") + 1) * segment >= F.col("total")
    kind = F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    line = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, F.col("record")).otherwise(
            F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
        _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", F.col("url")),
        _field("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("X-Document-ID", F.when(first, F.col("id"))),
        _field("WARC-Profile", F.when(F.col("revisit"), F.lit(_PROFILE))),
        _field("WARC-Refers-To-Target-URI", F.when(F.col("revisit"), F.col("kept_url"))),
        _field("WARC-Refers-To-Date", F.when(F.col("revisit"), F.lit(date))),
        _field("X-Refers-To-Document-ID", F.when(F.col("revisit"), F.col("kept"))),
        _field("WARC-Segment-Number", F.when(several, F.col("k") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(several & ~first, F.col("record"))),
        _field("WARC-Segment-Total-Length", F.when(several & last, F.col("total"))),
        _field("Content-Length", F.octet_length("part")), F.lit(CRLF), F.col("part"), F.lit(CRLF))
    (parts.select(line.alias("value")).write.option("lineSep", CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", PER_FILE).text(path))
    scratch.keep()


# -- reading -----------------------------------------------------------------------------------
_RECORD = ("file string, record string, kind string, doc_id long, uri string, part long, origin string, "
           "total long, declared string, refers_to long, content_type string, block binary, "
           "payload_bytes long, payload_sha1 string, payload binary, problem string")
_NAMES = [c.split()[0] for c in _RECORD.split(", ")]
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _RECORD.split(", ")])
_DONE = ("file", "record", "kind", "doc_id", "uri", "declared", "refers_to", "payload_bytes",
         "payload_sha1", "payload", "problem")
_DONE_ARROW = pa.schema([_ARROW.field(c) for c in _DONE])
_DONE_SCHEMA = ", ".join(c for c in _RECORD.split(", ") if c.split()[0] in _DONE)


def _long(value: str | None) -> int | None:
    try:
        return int(value) if value is not None else None
    except ValueError:
        return None


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None, str | None]]:
    """(head, block, problem) of the records of an archive file, gzipped or not."""
    raw = io.BytesIO(data)
    file = io.BufferedReader(gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw)
    while True:
        try:
            line = file.readline()
            while line in (b"\r\n", b"\n"):
                line = file.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                yield {}, None, "no record head"
                return
            head: dict[str, str] = {}
            name = ""
            while (line := file.readline()) not in (b"\r\n", b"\n", b""):
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if text[:1] in " \t" and name:
                    head[name] += " " + text.strip()
                    continue
                name, _, value = text.partition(":")
                name = name.strip().lower()
                head[name] = value.strip()
            length = _long(head.get("content-length"))
            if length is None or length < 0:
                yield head, None, "no content length"
                return
            block = file.read(length)
        except (OSError, EOFError) as broken:
            yield {}, None, f"unreadable: {type(broken).__name__}"
            return
        if len(block) < length:
            yield head, None, "truncated"
            return
        yield head, block, None


def decode_chunks(body: bytes) -> bytes | None:
    """The data of a body in chunked transfer framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            break
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2
    while body[at : at + 2] != b"\r\n":  # trailers
        at = body.find(b"\r\n", at) + 2
        if at < 2:
            return None
    return b"".join(out)


def _hex_digest(declared: str | None) -> str | None:
    """The lower-case hex of a labelled SHA-1, given in hex or base 32; None of another kind."""
    label, _, value = (declared or "").partition(":")
    if label.lower() != "sha1":
        return None
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()
    except ValueError:
        return "not a digest"


def _payload(kind: str | None, content_type: str | None, block: bytes) -> tuple[bytes | None, str | None]:
    """(payload, problem) of a whole block; revisits have none."""
    if kind == "revisit":
        return None, None
    if not (content_type or "").lower().startswith("application/http"):
        return block, None
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, "no HTTP head"
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked":
            body = decode_chunks(body)
            return body, None if body is not None else "chunk framing"
    return body, None


def _finish(row: dict, block: bytes, keep: bool) -> dict:
    payload, row["problem"] = _payload(row["kind"], row["content_type"], block)
    if payload is not None:
        row["payload_bytes"] = len(payload)
        row["payload_sha1"] = hashlib.sha1(payload).hexdigest()
        row["payload"] = payload if keep else None
        if (row["declared"] or row["payload_sha1"]) != row["payload_sha1"]:
            row["problem"] = "digest"
    elif row["kind"] == "revisit":
        row["payload_sha1"] = row["declared"]
    return row


def _parse(keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def row_of(path: str, head: dict[str, str], block: bytes | None, problem: str | None) -> dict:
        row = dict.fromkeys(_NAMES) | {
            "file": path, "record": head.get("warc-record-id"), "kind": head.get("warc-type"),
            "doc_id": _long(head.get("x-document-id")), "uri": head.get("warc-target-uri"),
            "part": _long(head.get("warc-segment-number")), "origin": head.get("warc-segment-origin-id"),
            "total": _long(head.get("warc-segment-total-length")),
            "declared": _hex_digest(head.get("warc-payload-digest")),
            "refers_to": _long(head.get("x-refers-to-document-id")),
            "content_type": head.get("content-type"), "problem": problem}
        if row["part"] is not None:
            row["origin"] = row["origin"] or row["record"]
            row["block"] = block
        elif block is not None:
            _finish(row, block, keep)
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, held = [], 0
                for head, block, problem in read_records(data.as_py()):
                    rows.append(row_of(path.as_py(), head, block, problem))
                    held += len(block or b"")
                    if held >= 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def _reassemble(keep: bool) -> Callable[[pa.Table], pa.Table]:
    """The records of one origin as one record."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["total"] is None))
        blocks, problem = {}, None
        for r in rows:
            if blocks.setdefault(r["part"], r["block"]) != r["block"]:
                problem = "segments differ"
        out = dict(rows[0])
        if rows[0]["part"] != 1:  # the head of the record is missing
            out |= {"record": rows[0]["origin"], "kind": None, "doc_id": None, "declared": None}
        totals = {r["total"] for r in rows if r["total"] is not None}
        if problem is None and any(r["problem"] for r in rows):
            problem = next(r["problem"] for r in rows if r["problem"])
        if problem is None and sorted(blocks) != list(range(1, len(blocks) + 1)):
            problem = "segment missing"
        if problem is None and totals != {sum(map(len, blocks.values()))}:
            problem = "total length" if totals else "segment missing"
        if problem is None:
            _finish(out, b"".join(blocks[k] for k in sorted(blocks)), keep)
        else:
            out["problem"] = problem
        return pa.Table.from_pylist([{c: out[c] for c in _DONE}], schema=_DONE_ARROW)

    return run


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives under ``path``, segments put together.

    One row a record: file, record (its id), kind (WARC-Type), doc_id and refers_to (null without
    such a head line), uri, declared (payload digest of the head, lower-case hex), payload_bytes,
    payload_sha1, payload (binary; null unless ``payloads``) and problem: null if all is right, else
    ``segment missing``, ``segments differ``, ``total length``, ``chunk framing``, ``no HTTP head``,
    ``digest``, ``truncated``, ``no record head``, ``no content length`` or ``unreadable``; what
    follows a damaged place in a file is not read.  A segment delivered twice counts once.  Revisits
    have no payload, and their digest is the declared one; see `resolve_revisits`.

    A task holds one file at a time, and one record's segments at a time."""
    ship(spark)
    scratch = Scratch(spark, "warc_records")
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    found = scratch.write(files.mapInArrow(_parse(payloads), _RECORD), "records")
    whole = found.filter("part IS NULL").select(*_DONE)
    split = (found.filter("part IS NOT NULL").groupBy("origin")
             .applyInArrow(_reassemble(payloads), _DONE_SCHEMA))
    return whole.unionByName(split)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give revisits the size of the payload they refer to, found by its digest; one that refers to
    nothing in ``records`` gets the problem ``dangling revisit``."""
    held = (records.filter("kind = 'response' AND problem IS NULL").groupBy("payload_sha1")
            .agg(F.max("payload_bytes").alias("held")).withColumnRenamed("payload_sha1", "sha1"))
    wants = F.when(F.col("kind") == "revisit", F.col("payload_sha1")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("record").cast("string")))  # responses ask for nothing
    rows = records.withColumn("wants", wants).join(held, F.col("wants") == F.col("sha1"), "left")
    lost = (F.col("kind") == "revisit") & F.col("held").isNull()
    return (rows.withColumn("payload_bytes", F.coalesce("payload_bytes", "held"))
            .withColumn("problem", F.coalesce("problem", F.when(lost, F.lit("dangling revisit"))))
            .drop("wants", "sha1", "held"))
