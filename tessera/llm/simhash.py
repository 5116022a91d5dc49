"""SimHash near-dedup: 64-bit fingerprints, linked at a few differing bits, closed to components.

Method: segment-popcount embedding.  A fingerprint is cut into 32 segments of two bits; the bit
counts of the segments are a point in {0,1,2}^32.  The Manhattan distance of two points never
exceeds the Hamming distance of the fingerprints, so links are sought by a range join on a grid:
of the two halves of the segments one is within half the distance, and two points within distance
r of each other in a half share a grid cell within ceil(r/2) steps of both.  Each fingerprint is
posted to its own cell and the cells one step away, cells are joined, the Manhattan bound and then
the exact Hamming distance decide inside the join.

Skew.  Copies collapse first: everything runs on distinct fingerprints.  Cells with more than
``CELL_PAIRS`` fingerprints (dense clouds of near copies) are not paired: their members are linked
through the strings two bits away that they share, which is exact for the distance of four (two
fingerprints are within 2r bits iff a string lies within r bits of both), needs a fixed number of
rows a fingerprint, and gives a star a string instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship

SEED = 42
LOW = 0x5555555555555555  # the low bit of each segment
#: A cell with more fingerprints than this is linked by shared strings, not by pairs.
CELL_PAIRS = 512
#: Shingles that are counted in one go.
_CHUNK = 1 << 18


# fingerprints ------------------------------------------------------------------------------------
def _shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # bytes: lower-cases A-Z alone, splits on ASCII white space
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    after = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
    return [xxhash.xxh64_intdigest(joined[a : b - 1], SEED)
            for a, b in zip(after, after[shingle:], strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes (``counts`` each): the bits set in over half.

    Bits are added eight at a time in byte lanes, 255 hashes at most before a lane could overflow.
    """
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    pieces = -(-n // 255)
    starts = np.cumsum(n) - n
    piece = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = np.repeat(starts, pieces) + piece * 255
    groups = np.cumsum(pieces) - pieces
    lanes = np.uint64(0x0101010101010101)
    for j in range(8):
        summed = np.add.reduceat((hashes >> np.uint64(j)) & lanes, cuts)
        by_byte = np.add.reduceat(summed.astype("<u8").view(np.uint8).reshape(-1, 8), groups,
                                  axis=0, dtype=np.int64)
        for k in range(8):
            bit = (2 * by_byte[:, k] > n).astype(np.uint64)
            out[full] |= bit << np.uint64(8 * k + j)
    return out


def _fingerprints(shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0), 0
            hashes: list[int] = []
            counts: list[int] = []

            def flush(hashes=hashes, counts=counts, ids=ids) -> pa.RecordBatch:
                fp = majority(np.array(hashes, dtype=np.uint64), np.array(counts, dtype=np.int64))
                out = pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(counts)), pa.array(fp.view(np.int64))], schema=schema)
                hashes.clear()
                counts.clear()
                return out

            for text in batch.column(1):
                got = _shingle_hashes(text.as_py() or b"", shingle)
                hashes += got
                counts.append(len(got))
                if len(hashes) >= _CHUNK:
                    done = flush()
                    at += done.num_rows
                    yield done
            if counts:
                yield flush()

    return run


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text")).mapInArrow(
                           _fingerprints(shingle), "doc_id long, fp long")


# links -------------------------------------------------------------------------------------------
def _counts(fp: Column) -> Column:
    """The 32 segment counts, two bits each."""
    low, high = F.lit(LOW), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseXOR(high).bitwiseAND(low).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1))


def _half(fp: Column, half: Column) -> Column:
    """The counts of segments 0 to 15 (half 0) or 16 to 31 (half 1)."""
    counts = _counts(fp)
    return (F.when(half == 1, F.shiftrightunsigned(counts, 32)).otherwise(counts)
            .bitwiseAND(F.lit((1 << 32) - 1)))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings: counts 0..2 differ by 1 where the low bit of their
    exclusive or is set, by 2 where only the high bit is."""
    low = F.lit(LOW)
    x = a.bitwiseXOR(b)
    ones = F.bit_count(x.bitwiseAND(low))
    twos = F.bit_count(F.shiftrightunsigned(x, 1).bitwiseAND(F.bitwise_not(x)).bitwiseAND(low))
    return ones + 2 * twos


def _cells(half: Column, steps: int) -> Column:
    """The packed counts of a half (16 segments) and those at most ``steps`` unit steps away."""
    cells = F.array(half)
    for _ in range(steps):
        cells = F.array_distinct(F.flatten(F.transform(cells, lambda c: F.concat(
            F.array(c),
            *[F.when(F.shiftrightunsigned(c, 2 * i).bitwiseAND(F.lit(3)) < 2,
                     F.array(c + F.lit(1 << 2 * i))).otherwise(F.array().cast("array<bigint>"))
              for i in range(16)],
            *[F.when(F.shiftrightunsigned(c, 2 * i).bitwiseAND(F.lit(3)) > 0,
                     F.array(c - F.lit(1 << 2 * i))).otherwise(F.array().cast("array<bigint>"))
              for i in range(16)]))))
    return cells


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): enough links between distinct fingerprints at ``max_bits`` or fewer differing bits
    to give all components.  ``distinct`` has one column fp."""
    steps = -(-(max_bits // 2) // 2)
    posted = (distinct.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
              .select("fp", "half", F.explode(_cells(_half(F.col("fp"), F.col("half")), steps))
                      .alias("cell"))
              .select("fp", (F.col("cell") * 2 + F.col("half")).alias("cell")))
    posted = materialise(posted, "cells")
    dense = (posted.groupBy("cell").agg(F.count("*").alias("n"))
             .filter(F.col("n") > CELL_PAIRS).select("cell"))
    dense = materialise(dense, "dense-cells")
    sparse = posted.join(dense, "cell", "left_anti")
    a, b = sparse.alias("a"), sparse.alias("b")
    x, y = F.col("a.fp"), F.col("b.fp")
    half = F.col("a.cell").bitwiseAND(F.lit(1))
    cell, at_x, at_y = F.shiftright("a.cell", 1), _half(x, half), _half(y, half)
    near = (a.join(b, (F.col("a.cell") == F.col("b.cell")) & (x < y)
                   & (manhattan(_counts(x), _counts(y)) <= max_bits)
                   & (F.bit_count(x.bitwiseXOR(y)) <= max_bits)
                   # of the cells that two points share, report in the low ones alone
                   & ((cell < F.greatest(at_x, at_y)) | ((at_x == at_y) & (cell == at_x))))
            .select(x.alias("a"), y.alias("b")))
    crowd = posted.join(dense, "cell", "left_semi").select("fp").distinct()
    return near.unionByName(_shared_strings(crowd, max_bits)).distinct()


def _shared_strings(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Links among ``crowd`` by the strings within max_bits / 2 bits of several of them.  An odd
    distance posts one side only as far as the rest, so pairs are verified exactly."""
    reach = max_bits // 2
    masks = [0] + [1 << i for i in range(64)] if reach else [0]
    if reach > 1:
        masks += [1 << i | 1 << j for i in range(64) for j in range(i)]
    if reach > 2 or max_bits % 2:
        raise ValueError("max_bits must be 0, 2 or 4")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = crowd.select("fp", F.explode(F.transform(
        F.array(*map(F.lit, signed)), lambda m: F.col("fp").bitwiseXOR(m))).alias("string"))
    # at most len(masks) distinct fingerprints lie around one string
    stars = (posted.groupBy("string").agg(F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1))
    return (stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .filter(F.col("a") != F.col("b")))


# components --------------------------------------------------------------------------------------
def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node each node of ``edges`` (a, b) can reach.

    Alternating large-star and small-star rounds: a node's neighbours are hung on its least
    neighbour; rounds go on until no edge changes (logarithmic in practice)."""
    edges = materialise(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                        .filter("u < v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v")
                 .filter("u < v").distinct())
        # small star: a node's smaller neighbours and itself are hung on the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("u").alias("v")),
                                           F.struct(F.col("m").alias("u"), F.col("v").alias("v"))))
                         .alias("e")).select("e.u", "e.v").filter("u < v").distinct())
        edges = materialise(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def simhash_dedup(spark: SparkSession, docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its fingerprint and its component of near duplicates.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased; shingles are ``shingle`` words joined
    by a space, repeats included (a shorter text is one shingle).  A bit of the fingerprint is 1 if
    it is set in over half of the shingles' XXH64 hashes (seed 42).  Fingerprints with at most
    ``max_bits`` (0, 2 or 4) differing bits are linked; components are the closure.

    Null, empty and blank texts have fingerprint zero, which is linked like any other.  Rows with
    equal ids come back as they are; a null id stays null and never names a component of others.
    An empty table gives no rows.  Other columns are ignored.

    Returns doc_id, fp (signed integer), fingerprint (16 lowercase hex digits), component_id (least
    doc_id reachable).
    """
    marked = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    first = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fp")
    found = components(links(first.select("fp"), max_bits))
    placed = first.join(found, first.fp == found.node, "left").select(
        first.fp, "first", F.coalesce("component", first.fp).alias("component"))
    names = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialise(placed.join(names, "component").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
