"""Blocks of documents and the exchange of hashes between them.

Operators that compare all windows of a corpus would drown a shuffle in one row a window.  Here the
documents are written once as *blocks* (a few MB of text a row, bucketed by block id in the shared
folder), and a pass works in three steps:

1. every block computes the keys it wants to know about, sorts them, drops repeats and sends each
   *key bucket* (a range of the hash space) one binary row;
2. ``groupBy(bucket)`` brings the rows of a bucket together; a vectorised function answers every
   row with a few bits a key.  A frequent key arrives at most once a block, so no bucket is hot;
3. the answers go back to the blocks by a cogroup on block id.  The block table is bucketed by that
   id, so only the answers are shuffled, never the text.

The block table and the answers are committed tables in the shared folder: losing an executor costs
the tasks it ran, and block ids cannot change between passes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, materialise, new_path, ship, shuffle_partitions

BLOCKS = "block long, ids array<bigint>, lens array<int>, bytes long, body binary"
ASKED = "bucket int, block long, keys binary, more binary, marks binary"
ANSWERS = "block long, bucket int, bits binary"
_ASKED_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
                          ("more", pa.binary()), ("marks", pa.binary())])
_ANSWERS_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())])


class Block:
    """The documents of one block: ids (None where null) and their bytes, each followed by a line
    feed; which texts are null; and the other columns as a struct array, if they are carried."""

    def __init__(self, block: int, ids: list, lens: np.ndarray, body: bytes,
                 extra: pa.StructArray | None = None):
        self.block, self.ids, self.extra = block, ids, extra
        self.null, lens = lens < 0, np.maximum(lens, 0)
        self.data = np.frombuffer(body, dtype=np.uint8)
        self.lens = lens
        self.ends = np.cumsum(lens + 1) - 1
        self.starts = self.ends - lens


def read_block(rows: pa.RecordBatch | pa.Table, k: int) -> Block:
    row = {c: rows.column(c)[k].as_py() for c in ("block", "ids", "lens", "body")}
    body = zstandard.ZstdDecompressor().decompress(row["body"])
    extra = rows.column("extra")[k].values if "extra" in rows.schema.names else None
    return Block(row["block"], row["ids"], np.array(row["lens"], dtype=np.int64), body, extra)


def _pack(size: int, encode: Callable[[bytes, np.ndarray], bytes] | None = None,
          ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("lens", pa.list_(pa.int32())), ("bytes", pa.int64()), ("body", pa.binary())])
    kinds = [f.type for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        ids, lens, texts, extra, held, n = [], [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            body = b"\n".join(texts) + b"\n"
            held_as = encode(body, np.array(lens, dtype=np.int64)) if encode else body
            packed = zstandard.ZstdCompressor(level=1).compress(held_as)
            cols = [[first + n], [ids], [lens], [len(body)], [packed]]
            arrays = [pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)]
            names = list(schema.names)
            if extra:
                whole = pa.concat_arrays(extra)
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole))
                names.append("extra")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            since = 0
            for k, (doc_id, text) in enumerate(zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), 1):
                ids.append(doc_id)
                lens.append(-1 if text is None else len(text))
                texts.append(text or b"")
                held += len(texts[-1]) + 1
                if held >= size or k == batch.num_rows:
                    if batch.num_columns > 2:
                        extra.append(batch.column(2).slice(since, k - since))
                    since = k
                if held >= size:
                    yield flush()
                    ids, lens, texts, extra, held, n = [], [], [], [], 0, n + 1
        if ids:
            yield flush()

    return run


class Blocks:
    """The block table of a set of documents."""

    def __init__(self, spark: SparkSession, docs: DataFrame, size: int, id_col: str = "doc_id",
                 text_col: str = "text", carry: bool = False, scratch: Scratch | None = None,
                 encode: Callable[[bytes, np.ndarray], bytes] | None = None):
        """``size``: bytes of text after which a block is closed (it holds at least a document).
        ``carry``: keep the documents' other columns, as ``extra``.  ``scratch``: the database that
        the table goes to, for its owner to drop.  ``encode(bytes of the block, lengths of its texts)``:
        what a block holds in place of its bytes, so that no pass has to derive it again."""
        ship(spark)
        self.spark = spark
        self.parts = shuffle_partitions(spark)
        cols = [F.col(id_col).cast("bigint").alias("id"),
                F.col(text_col).cast("binary").alias("text")]
        schema = BLOCKS
        if carry:
            others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
            cols.append(others.alias("extra"))
            kind = docs.select(others.alias("extra")).schema[0].dataType.simpleString()
            schema += f", extra array<{kind}>"
        packed = docs.select(*cols).mapInArrow(_pack(size, encode), schema)
        name = f"llm_blocks_{uuid.uuid4().hex}"
        writer = packed.write.bucketBy(self.parts, "block").option("compression", "uncompressed")
        if scratch:
            scratch.tables.append(name)
            name = f"{scratch.database}.{name}"
        else:
            writer = writer.option("path", new_path(spark, "blocks"))
        writer.saveAsTable(name)
        self.table = spark.table(name)
        self.bytes = self.table.agg(F.sum("bytes")).first()[0] or 0

    def buckets(self, keys_per_byte: float, per_bucket: int = 1_000_000) -> int:
        """Key buckets so that one holds about ``per_bucket`` keys, however large the corpus is."""
        return max(2 * self.parts, int(self.bytes * keys_per_byte / per_bucket) + 1)

    def ask(self, emit: Callable[[Block, dict], Iterator[tuple]], buckets: int,
            answers: dict[str, DataFrame] | None = None, packed: bool = False) -> DataFrame:
        """Rows of ASKED.  ``emit(block, answers of the block)`` returns (keys, more, marks):
        ascending distinct uint64 keys, a further array of as many items (or None), a byte a key.
        ``packed``: the arrays go through ``pack``; ``answer`` and ``said`` have to be told."""

        def rows(block: Block, known: dict) -> list[pa.RecordBatch]:
            return [split_by_bucket(block.block, *emit(block, known), buckets, packed)]

        return self.visit(rows, ASKED, _ASKED_ARROW, answers)

    def visit(self, work: Callable[[Block, dict], list], schema: str,
              arrow: pa.Schema | Callable[[pa.Schema], pa.Schema],
              answers: dict[str, DataFrame] | None = None) -> DataFrame:
        """``work(block, answers)`` over all blocks; ``answers`` maps a name to the (bucket, bits)
        rows of that block, by bucket.  ``arrow``: the schema of the result, or a function that
        makes it from the block table's."""
        if not answers:
            def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for k in range(batch.num_rows):
                        yield from work(read_block(batch, k), {})

            return self.table.mapInArrow(scan, schema)
        union = None
        for name, df in answers.items():
            df = df.select("block", F.lit(name).alias("step"), "bucket", "bits")
            union = df if union is None else union.unionByName(df)

        def both(left: pa.Table, right: pa.Table) -> pa.Table:
            known: dict[str, dict[int, bytes]] = {}
            for r in right.to_pylist():
                known.setdefault(r["step"], {})[r["bucket"]] = r["bits"]
            out = [b for k in range(left.num_rows) for b in work(read_block(left, k), known)]
            return pa.Table.from_batches(out, schema=arrow(left.schema) if callable(arrow) else arrow)

        return (self.table.groupBy("block").cogroup(union.groupBy("block"))
                .applyInArrow(both, schema))


def planes(items: np.ndarray, ascending: bool = False) -> bytes:
    """The items' first bytes, then their second bytes and so on; of ascending integers the
    differences.  Counts are mostly small and differences have zero bytes in front, so that most of
    these planes compress to nothing."""
    if ascending:
        items = np.diff(items, prepend=items.dtype.type(0))
    return np.ascontiguousarray(items).view(np.uint8).reshape(len(items), items.dtype.itemsize).T.tobytes()


def from_planes(raw, dtype, ascending: bool = False) -> np.ndarray:
    dtype = np.dtype(dtype)
    by_byte = np.frombuffer(raw, dtype=np.uint8).reshape(dtype.itemsize, -1)
    items = np.ascontiguousarray(by_byte.T).view(dtype).reshape(-1)
    return np.cumsum(items, dtype=dtype) if ascending else items


def pack(items: np.ndarray, ascending: bool = False) -> bytes:
    """The items' planes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(planes(items, ascending))


def unpack(raw: bytes, dtype, ascending: bool = False) -> np.ndarray:
    return from_planes(zstandard.ZstdDecompressor().decompress(raw), dtype, ascending)


def stable_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of uint64 keys.  Keys are sorted with the row number behind them, in place of
    their last bits if there is no room, which is cheaper than sorting row numbers by key; where keys
    differ in those bits alone, so that they are not in order then, they are sorted as they are."""
    if not len(keys):
        return np.empty(0, dtype=np.int64)
    low = np.uint64(len(keys).bit_length())
    rows = np.arange(len(keys), dtype=np.uint64)
    room = int(keys.max()).bit_length() + int(low) <= 64
    by = keys << low if room else keys >> low << low
    by |= rows
    by.sort()
    by &= (np.uint64(1) << low) - np.uint64(1)
    by = by.view(np.int64)
    if not room:
        there = keys[by]
        if (there[1:] < there[:-1]).any():
            return np.argsort(keys, kind="stable")
    return by


def key_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key: the integer part of key x buckets / 2^64.  Buckets are fewer than 2^31."""
    n, half, low = np.uint64(buckets), np.uint64(32), np.uint64(0xFFFFFFFF)
    return (((keys >> half) * n + (((keys & low) * n) >> half)) >> half).astype(np.int32)


def split_by_bucket(block: int, keys: np.ndarray, more: np.ndarray | None, marks: np.ndarray,
                    buckets: int, packed: bool = False) -> pa.RecordBatch:
    """One row a bucket that has keys; the others cost nothing, however many there are.  Buckets are
    ranges of the hash space, so ascending keys stay ascending over the buckets."""
    of = key_buckets(keys, buckets)
    cuts = np.append(np.flatnonzero(np.diff(of, prepend=np.int32(-1))), len(keys))

    def put(items: np.ndarray, ascending: bool = False) -> bytes:
        return pack(items, ascending) if packed else items.tobytes()

    rows = [(int(of[lo]), block, put(keys[lo:hi], True), None if more is None else put(more[lo:hi]),
             put(marks[lo:hi])) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in
                                       zip(cols, _ASKED_ARROW, strict=True)], schema=_ASKED_ARROW)


def answer(asked: DataFrame, decide: Callable[..., np.ndarray], key_type: str, more_type: str | None,
           mark_type: str = "u1", name: str = "answers",
           write: Callable[[DataFrame, str], DataFrame] = materialise,
           packed: bool = False) -> DataFrame:
    """Answer every asked row.  ``decide(keys, more, marks, row)`` gets the keys of a bucket (with
    their row numbers, ascending by block) and returns an array with an answer a key, or a pair of
    that and a summary of the bucket as bytes: a row of block -1 then carries the summary.
    ``packed``: the asked rows are packed, and the answers will be."""

    def get(column: pa.ChunkedArray, dtype, ascending: bool = False) -> list[np.ndarray]:
        return [unpack(k, dtype, ascending) if packed else np.frombuffer(k, dtype=dtype)
                for k in column.to_pylist()]

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("block").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        parts = get(group.column("keys"), key_type, True)
        sizes = np.array([len(p) for p in parts])
        keys = np.concatenate(parts)
        more = None if more_type is None else np.concatenate(get(group.column("more"), more_type))
        marks = np.concatenate(get(group.column("marks"), mark_type))
        said = decide(keys, more, marks, np.repeat(np.arange(len(parts)), sizes))
        said, summary = said if isinstance(said, tuple) else (said, None)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        bits = [pack(said[a:b]) if packed else said[a:b].tobytes()
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        to, bucket = group.column("block").to_pylist(), group.column("bucket").to_pylist()
        if summary is not None:
            bits, to, bucket = [*bits, summary], [*to, -1], [*bucket, bucket[0]]
        return pa.Table.from_arrays([pa.array(to, type=pa.int64()),
                                     pa.array(bucket, type=pa.int32()),
                                     pa.array(bits, type=pa.binary())], schema=_ANSWERS_ARROW)

    return write(asked.groupBy("bucket").applyInArrow(run, ANSWERS), name)


def said(known: dict, step: str, n: int, dtype: str = "u1", packed: bool = False) -> np.ndarray:
    """The answers of a step in the order of the block's ascending keys."""
    got = known.get(step, {})
    if packed:
        out = np.concatenate([np.empty(0, dtype), *[unpack(got[b], dtype) for b in sorted(got)]])
    else:
        out = np.frombuffer(b"".join(got[b] for b in sorted(got)), dtype=dtype)
    if len(out) != n:
        raise RuntimeError(f"{step}: {len(out)} answers to {n} keys")
    return out


def groups(keys: np.ndarray, more: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal (key, more) together, stable, and the starts of the runs in it."""
    if more is None:
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        new = k[1:] != k[:-1]
    else:
        order = np.lexsort((more, keys))
        k, m = keys[order], more[order]
        new = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    return order, np.flatnonzero(np.concatenate([[True], new])) if len(keys) else np.empty(0, int)
