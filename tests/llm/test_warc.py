"""WARC archives: an exact round trip, hand-written archives, and damaged ones."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random

import pytest

from tessera.llm.common import new_path
from tessera.llm.warc import decode_chunks, read_warc, resolve_revisits, write_warc

SCHEMA = "page_id long, url string, html string, digest string, size int, block string, shared int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "b", 2) for r in rows], SCHEMA)


def sha1(b):
    return hashlib.sha1(b).hexdigest()


def expected(rows):
    kept = {}
    for i, _, html in rows:
        b = (html or "").encode()
        kept.setdefault(b, []).append(i)
    out = []
    for i, url, html in rows:
        b = (html or "").encode()
        best = max((x for x in kept[b] if x is not None), default=None)
        again = len(b) >= 1000 and i != best
        out.append((i, len(b), sha1(b), "revisit" if again else "response", best if again else None,
                    None if again else b))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    long = "".join(rng.choice(["WARC/1.1\r\n", "\r\n\r\n", "é", "<p>", "0\r\n\r\n", "日本", "a" * 500])
                   for _ in range(3000))
    copy = "<html>" + "copy " * 400 + "</html>"
    out = [(k, f"http://h/{k}", "x" * n) for k, n in enumerate(
        [0, 1, 999, 1000, 1001, 4095, 4096, 4097, 16383, 16384, 16385, 40_000])]
    out += [(100 + k, "http://copy/", copy) for k in range(50)]
    out += [(200 + k, None, "short copy") for k in range(5)]
    out += [(300, "http://l/", long), (301, "http://l/ \r\nWARC-Type: warcinfo", long), (302, "u", None),
            (None, "u", copy), (None, "u", "y" * 2000), (None, "u", "y" * 2000), (None, None, None),
            (400, "u", copy[:-1]), (401, "u", "z" * 1500), (401, "u", "z" * 1500), (-5, "u", "z" * 1500)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("segment", [16_384, 300])
def test_round_trip(spark, rows, segment):
    path = new_path(spark, "warc-test")
    write_warc(spark, pages(spark, rows).repartition(3), path, segment=segment)
    found = resolve_revisits(read_warc(spark, path)).collect()
    assert all(r.problem is None for r in found)
    got = [(r.doc_id, r.payload_bytes, r.payload_sha1, r.kind, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=str) == expected(rows)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".gz")]
    text = b"".join(gzip.open(os.path.join(path.removeprefix("file:"), f)).read() for f in files)
    assert text.count(b"WARC-Record-ID: ") == text.count(b"WARC-Type: ") > len(rows)
    assert text.count(b"WARC-Segment-Total-Length: ") > 0
    without = read_warc(spark, path, payloads=False)
    assert without.filter("payload IS NOT NULL").count() == 0 and without.count() == len(rows)


def test_empty_table(spark):
    path = new_path(spark, "warc-test")
    write_warc(spark, pages(spark, []), path)
    assert resolve_revisits(read_warc(spark, path)).count() == 0


def record(kind, ident, block, **head):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", f"Content-Length: {len(block)}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in head.items()]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def response(body, framing="Transfer-Encoding: chunked"):
    return f"HTTP/1.1 200 OK\r\n{framing}\r\n\r\n".encode() + body


def test_archives_of_others(spark, scratch):
    http = {"Content_Type": "application/http;msgtype=response"}
    whole = response(b"4;x=1\r\nWiki\r\n5\r\npedia\r\n0\r\nTrailer: 1\r\n\r\n")
    cut = [whole[:7], whole[7:30], whole[30:]]

    def pieces(name, *, order=(1, 2, 3), total=len(whole), blocks=cut):
        out = []
        for k in order:
            extra = {"WARC_Segment_Number": k}
            if k == 1:
                out.append(record("response", name, blocks[0], **http, **extra))
                continue
            extra["WARC_Segment_Origin_ID"] = f"<{name}>"
            if k == 3 and total is not None:
                extra["WARC_Segment_Total_Length"] = total
            out.append(record("continuation", f"{name}-{k}", blocks[k - 1], **extra))
        return out

    b32 = base64.b32encode(hashlib.sha1(b"Wikipedia").digest()).decode()
    archives = {
        "a.warc": [record("warcinfo", "info", b"software: x\r\n"), *pieces("right", order=(3, 1, 2)),
                   record("response", "plain", response(b"body", "Content-Length: 4"), **http),
                   record("resource", "file", b"\x00\xff raw", WARC_Payload_Digest="md5:1"),
                   record("response", "b32", whole, **http, WARC_Payload_Digest=f"sha1:{b32}"),
                   record("response", "wrong", whole, **http, WARC_Payload_Digest="sha1:" + "0" * 40),
                   record("response", "frame", response(b"4\r\nWikipedia"), **http),
                   record("response", "headless", b"HTTP/1.1 200 OK", **http),
                   record("revisit", "again", b"HTTP/1.1 200 OK\r\n\r\n", **http, WARC_Payload_Digest=f"sha1:{b32}"),
                   record("revisit", "lost", b"", **http, WARC_Payload_Digest="sha1:" + "1" * 40)],
        "b.warc.gz": [*pieces("gap", order=(1, 3)), *pieces("no-head", order=(2, 3)), *pieces("no-end", order=(1, 2)),
                      *pieces("long", total=99), *pieces("twice", order=(1, 2, 2, 3)), *pieces("no-total", total=None),
                      *pieces("differ"), record("continuation", "x", b"other", WARC_Segment_Number=2,
                                                WARC_Segment_Origin_ID="<differ>")],
        "c.warc": [record("resource", "before", b"1"), record("resource", "cut", b"12345")[:-8]],
        "d.warc": [b"no archive at all"], "e.warc": [],
        "f.warc.gz": [record("resource", "zipped", b"2" * 5000)],
    }
    for name, parts in archives.items():
        with open(os.path.join(scratch, name), "wb") as out:
            # a member a record, as archives have it; the last file is cut short
            data = b"".join(gzip.compress(p) for p in parts) if name.endswith("gz") else b"".join(parts)
            out.write(data[:-30] if name == "f.warc.gz" else data)
    found = resolve_revisits(read_warc(spark, scratch)).collect()
    got = {(r.record or os.path.basename(r.file)).strip("<>"): (r.problem, r.payload and bytes(r.payload)) for r in found}
    wiki = (None, b"Wikipedia")
    assert got == {
        "info": (None, b"software: x\r\n"), "right": wiki, "plain": (None, b"body"), "file": (None, b"\x00\xff raw"),
        "b32": wiki, "wrong": ("digest", b"Wikipedia"), "frame": ("chunk framing", None),
        "headless": ("no HTTP head", None), "again": (None, None), "lost": ("dangling revisit", None),
        "gap": ("segment missing", None), "no-head": ("segment missing", None), "no-end": ("segment missing", None),
        "long": ("total length", None), "twice": wiki, "no-total": ("segment missing", None),
        "differ": ("segments differ", None), "before": (None, b"1"), "cut": ("truncated", None),
        "d.warc": ("no record head", None), "f.warc.gz": ("unreadable: EOFError", None)}
    assert next(r.payload_bytes for r in found if r.record == "<again>") == 9


@pytest.mark.parametrize(("body", "want"), [
    (b"0\r\n\r\n", b""), (b"A\r\n0123456789\r\n0\r\n\r\n", b"0123456789"), (b"", None), (b"3\r\nab\r\n0\r\n\r\n", None),
    (b"2\r\nab\r\n", None), (b"-1\r\nx\r\n0\r\n\r\n", None), (b"0\r\nA: 1", None), (b"2\r\nab\r\n0\r\n", None)])
def test_chunks(body, want):
    assert decode_chunks(body) == want
