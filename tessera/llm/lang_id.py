"""Language ID: nearest of several clustered centroids per language, by cosine.

A text is a vector of byte trigrams (letters lower-cased in ASCII, everything that is not a letter
a single space), hashed to ``dims`` components, with sublinear term counts times inverse document
frequency over all training documents, at length one.  Each language has ``clusters`` centroids by
spherical k-means over all its training texts; clusters of under a tenth of them are merged into the
others.  Only the starts come from a bounded sample.  The prediction is the language of the nearest
centroid.

A text is rejected if its cosine is under the bar of its length.  Short texts have low cosines, so
lengths are banded by powers of four trigrams.  A band's bar lies half way between what all but 1 %
of the training texts reach with their own language and what half of them reach with the nearest other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship
from tessera.llm.texts import LETTER, Texts, chunks

UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
#: More centroids than this do not go to every task.
MAX_CENTROIDS = 4096
_CHUNK = 1 << 19
#: Clusters of a smaller share of a language's sample are merged into the others.
LEAST_SHARE = 0.1
#: Bands of fewer training texts take the bar of the next shorter one; the shortest have none.
BAND_TEXTS = 20
BANDS = 16
#: Rounds of k-means over all training texts.
ROUNDS = 3
#: Bins of a cosine from 0 to 1, in which bars are counted.
BINS = 2000
#: Unit of the whole numbers that vectors are summed in: 2^39 texts before they overflow.
_ONE = 1 << 24
#: Texts whose vectors are held at once.
_ROWS = 128

# letters in lower case, all bytes of other scripts, a space for the rest
_MAP = np.full(256, 32, dtype=np.uint8)
_MAP[65:91] = _MAP[97:123] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def trigrams(texts: Texts, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Component and document of each trigram."""
    data = np.concatenate([[np.uint8(32)], _MAP[texts.data]])  # each text starts after a space
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    at = np.flatnonzero(keep)
    d = data[at].astype(np.uint32)
    if len(d) < 3:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    key = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    key *= np.uint32(0x9E3779B1)
    key >>= np.uint32(32 - dims.bit_length() + 1)
    # the middle byte's place decides the document; one that ends in the next text is of neither
    doc = np.minimum(np.searchsorted(texts.ends, at[1:-1] - 1, side="left"), texts.n - 1)
    own = at[2:] - 1 <= texts.ends[doc]
    return key[own].astype(np.int64), doc[own]


def counts(texts: Texts, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """Dense counts, some documents at a time: first document, matrix."""
    key, doc = trigrams(texts, dims)
    for a in range(0, texts.n, _ROWS):
        b = min(a + _ROWS, texts.n)
        lo, hi = np.searchsorted(doc, [a, b])
        flat = (doc[lo:hi] - a) * dims + key[lo:hi]
        yield a, np.bincount(flat, minlength=(b - a) * dims).reshape(b - a, dims)


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(count.astype(np.float32)) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(norm, 1e-12)[:, None]


def _texts(docs: DataFrame, text_col: str, *cols: Column) -> DataFrame:
    return docs.select(*cols, F.col(text_col).cast("binary").alias("text"))


def document_frequency(docs: DataFrame, dims: int, text_col: str = "text") -> np.ndarray:
    """Document frequency of each component and, last, the number of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, dtype=np.int64)
        for _, raw in chunks(batches, _CHUNK):
            total[dims] += len(raw)
            for _, count in counts(Texts(raw), dims):
                total[:dims] += (count > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(total)],
                                         names=["dim", "n"])

    out = np.zeros(dims + 1, dtype=np.int64)
    for dim, n in (_texts(docs, text_col, F.lit(0).alias("x")).mapInArrow(run, "dim long, n long")
                   .groupBy("dim").agg(F.sum("n")).collect()):
        out[dim] = n
    return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """At most ``k`` centroids at length one.  Starts from the mean's nearest row, then from rows
    drawn in proportion to their distance (k-means++, by a fixed seed), so that a single odd row
    seldom starts a cluster; one that holds under LEAST_SHARE of the rows is given up."""
    rng = np.random.default_rng(seed)
    picks = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(picks) < min(k, len(x)):
        far = np.maximum(1.0 - (x @ x[picks].T).max(axis=1).astype(np.float64), 0.0)
        far[picks] = 0.0
        if far.sum() < 1e-6:
            break
        picks.append(int(rng.choice(len(x), p=far / far.sum())))

    def settle(centroids: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            own = (x @ centroids.T).argmax(axis=1)
            sums = np.stack([x[own == c].sum(axis=0) for c in range(len(centroids))])
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centroids)
        return centroids

    centroids = settle(x[picks])
    while len(centroids) > 1:
        size = np.bincount((x @ centroids.T).argmax(axis=1), minlength=len(centroids))
        if size.min() >= LEAST_SHARE * len(x):
            break
        centroids = settle(np.delete(centroids, size.argmin(), axis=0))
    return centroids.astype(np.float32)


def band(n: np.ndarray) -> np.ndarray:
    """The length band of a number of trigrams."""
    return np.minimum((np.log2(np.maximum(n, 1)) / 2).astype(np.int64), BANDS - 1)


def settle(train: DataFrame, langs: list[str], centroids: np.ndarray,
           idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A round of spherical k-means over all texts of ``train``: each goes to the nearest centroid of
    its language.  The new centroids and the number of texts of each.  Sums are of whole numbers,
    so that they do not depend on the order."""
    spark, dims = train.sparkSession, centroids.shape[1]
    of, model = np.array(langs, dtype=object), spark.sparkContext.broadcast((centroids, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, idf = model.value
        sums: dict[int, np.ndarray] = {}
        for rows, raw in chunks(batches, _CHUNK):
            lang = np.array(rows.column(0).to_pylist(), dtype=object)
            for a, count in counts(Texts(raw), dims):
                x = vectors(count, idf)
                mine = lang[a : a + len(x), None] == of[None, :]
                own = np.where(mine, x @ centroids.T, -1.0).argmax(axis=1)
                own[~mine.any(axis=1)] = -1
                for c in np.unique(own[own >= 0]).tolist():
                    total = sums.setdefault(c, np.zeros(dims + 1, dtype=np.int64))
                    total[:dims] += np.rint(x[own == c].astype(np.float64) * _ONE).astype(np.int64).sum(axis=0)
                    total[dims] += int((own == c).sum())
        for c, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), c)), pa.array(at), pa.array(total[at])],
                                             names=["c", "dim", "n"])

    def pack(group: pa.Table) -> pa.Table:
        total = np.zeros(dims + 1, dtype=np.int64)
        total[group.column("dim").to_numpy()] = group.column("n").to_numpy()
        x = total[:dims].astype(np.float64)
        x /= max(np.linalg.norm(x), 1e-12)
        return pa.table({"c": group.column("c")[:1], "size": [int(total[dims])],
                         "centroid": [x.astype(np.float32).tobytes()]},
                        schema=pa.schema([("c", pa.int64()), ("size", pa.int64()), ("centroid", pa.binary())]))

    out, sizes = centroids.copy(), np.zeros(len(langs), dtype=np.int64)
    for r in (train.select("lang", "text").mapInArrow(run, "c long, dim long, n long")
              .groupBy("c", "dim").agg(F.sum("n").alias("n"))
              .groupBy("c").applyInArrow(pack, "c long, size long, centroid binary").collect()):
        sizes[r["c"]] = r["size"]
        found = np.frombuffer(r["centroid"], dtype=np.float32)
        if found.any():  # else only texts without a trigram
            out[r["c"]] = found
    model.unpersist()
    return out, sizes


def _quantile(n: np.ndarray, q: float) -> float:
    """The ``q`` quantile of cosines counted in bins."""
    return (np.searchsorted(np.cumsum(n), max(q * n.sum(), 1)) + 0.5) / len(n)


def bars(train: DataFrame, langs: list[str], centroids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The cosine a text of each band has to reach, from those of all texts of ``train``."""
    out = np.zeros(BANDS)
    if not langs:
        return out
    of, dims = np.array(langs, dtype=object), centroids.shape[1]
    model = train.sparkSession.sparkContext.broadcast((centroids, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, idf = model.value
        total = np.zeros(BANDS * 2 * BINS, dtype=np.int64)
        for rows, raw in chunks(batches, _CHUNK):
            lang = np.array(rows.column(0).to_pylist(), dtype=object)
            for a, count in counts(Texts(raw), dims):
                near = vectors(count, idf) @ centroids.T
                mine = lang[a : a + len(near), None] == of[None, :]
                for side, m in enumerate((mine, ~mine)):
                    cosine = np.where(m, near, 0.0).max(axis=1).clip(0, 1)
                    at = np.minimum((cosine * BINS).astype(np.int64), BINS - 1)
                    at += (band(count.sum(axis=1)) * 2 + side) * BINS
                    total += np.bincount(at, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    total = np.zeros(BANDS * 2 * BINS, dtype=np.int64)
    for at, n in (train.select("lang", "text").mapInArrow(run, "at long, n long")
                  .groupBy("at").agg(F.sum("n")).collect()):
        total[at] = n
    model.unpersist()
    for b, (own, off) in enumerate(total.reshape(BANDS, 2, BINS)):
        out[b] = out[b - 1] if b else 0.0
        if own.sum() >= BAND_TEXTS and _quantile(own, 0.01) > _quantile(off, 0.5):
            out[b] = (_quantile(own, 0.01) + _quantile(off, 0.5)) / 2
    return out


def fit(spark: SparkSession, train: DataFrame, dims: int, clusters: int, sample_per_lang: int,
        id_col: str, text_col: str, lang_col: str):
    """(languages, centroids, bars, idf), all from all training texts.  At most ``sample_per_lang``
    texts a language, those of least hashed id, only say where the clusters start."""
    df = document_frequency(train, dims, text_col)
    idf = (np.log((1 + df[dims]) / (1 + df[:dims])) + 1).astype(np.float32)
    # hashed ids thin each language to about twice the sample first, whatever its size
    rank = F.row_number().over(Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col))
    ids = train.select(id_col, lang_col)
    sizes = materialise(ids.groupBy(F.col(lang_col).alias("of_lang")).agg(F.count("*").alias("n")),
                        "lang-sizes")
    draw = F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 40)) / float(1 << 40)
    thinned = (ids.join(sizes, F.col(lang_col) == F.col("of_lang"))
               .filter(draw * F.col("n") < 2 * sample_per_lang).select(id_col, lang_col))
    chosen = materialise(thinned.withColumn("rank", rank)
                         .filter(F.col("rank") <= sample_per_lang).select(id_col).distinct(),
                         "lang-sample")
    # rows may share an id: the texts are counted off again
    again = F.row_number().over(Window.partitionBy("lang").orderBy("by", "text"))
    sample = _texts(train.join(chosen, id_col, "left_semi"), text_col,
                    F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("by"))
    sample = materialise(sample.withColumn("rank", again).filter(F.col("rank") <= sample_per_lang)
                         .select("lang", "text"), "lang-sample-texts")

    def cluster(group: pa.Table) -> pa.Table:
        texts = Texts([t or b"" for t in group.column("text").to_pylist()])
        x = np.concatenate([vectors(c, idf) for _, c in counts(texts, dims)])
        centroids = spherical_kmeans(x, clusters)
        lang = group.column("lang")[0].as_py()
        return pa.table({"lang": [lang] * len(centroids),
                         "centroid": [c.tobytes() for c in centroids]},
                        schema=pa.schema([("lang", pa.string()), ("centroid", pa.binary())]))

    rows = (sample.groupBy("lang").applyInArrow(cluster, "lang string, centroid binary")
            .limit(MAX_CENTROIDS + 1).collect())
    if len(rows) > MAX_CENTROIDS:
        raise ValueError(f"more than {MAX_CENTROIDS} centroids; lower clusters or the languages")
    rows.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = np.array([np.frombuffer(r["centroid"], dtype=np.float32) for r in rows],
                         dtype=np.float32).reshape(len(rows), dims)
    langs = [r["lang"] for r in rows]
    texts = _texts(train, text_col, F.col(lang_col).alias("lang"))
    for left in reversed(range(ROUNDS if langs else 0)):
        centroids, sizes = settle(texts, langs, centroids, idf)
        if left:  # the rounds left settle the texts of those given up
            own = {lang: [k for k, of in enumerate(langs) if of == lang] for lang in langs}
            least = {min(ks, key=lambda k: sizes[k]): sum(sizes[k] for k in ks)
                     for ks in own.values() if len(ks) > 1}
            keep = [k for k in range(len(langs)) if sizes[k] >= LEAST_SHARE * least.get(k, 0)]
            langs, centroids = [langs[k] for k in keep], centroids[keep]
    return langs, centroids, bars(texts, langs, centroids, idf), idf


def _has_letters(texts: Texts, raw: list[bytes]) -> np.ndarray:
    """ASCII letters by table; other texts are decoded and looked at."""
    out = texts.count(LETTER[texts.data]) > 0
    for k in np.flatnonzero(~out):
        out[k] = any(map(str.isalpha, raw[k].decode("utf-8", "ignore")))
    return out


def language_id(spark: SparkSession, docs: DataFrame, folds: int = 4, held_out: int = 2,
                dims: int = 4096, clusters: int = 3, sample_per_lang: int = 400,
                carry: bool = False, id_col: str = "doc_id",
                text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score, rejected.  With ``carry`` all columns
    of ``docs``, and those results in a struct column ``language_id`` (replaced if it is there).

    Training uses the whole text and non-null ``lang_col`` of documents whose crc32(id as text) mod ``folds``
    is not ``held_out``.  A prediction reads the text alone.  ``score`` is the cosine to the nearest
    centroid.  ``rejected``: no language, or a cosine under the bar of the text's length.

    A null text, one without letters, and any text where nothing could be learned are ``und`` with
    score 0, rejected.  Null ids do not train (held_out is false).  Rows with equal ids are judged
    one by one; ties between languages go to the first by name.  An empty table gives no rows.
    ``dims`` must be a power of two.  Other columns are ignored.
    """
    ship(spark)
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
    train = docs.filter((fold != held_out) & F.col(lang_col).isNotNull()
                        & F.col(text_col).isNotNull()).select(id_col, text_col, lang_col)
    langs, centroids, bar, idf = fit(spark, train, dims, clusters, sample_per_lang, id_col,
                                       text_col, lang_col)
    names = np.array([*langs, UNKNOWN], dtype=object)
    model = spark.sparkContext.broadcast((centroids, idf))
    fields = [("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
              ("rejected", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, idf = model.value
        for rows, raw in chunks(batches, _CHUNK):
            texts = Texts(raw)
            best = np.full(texts.n, len(langs))
            score, least = np.zeros(texts.n), np.zeros(texts.n)
            if langs:
                for a, count in counts(texts, dims):
                    near = vectors(count, idf) @ centroids.T
                    best[a : a + len(near)] = near.argmax(axis=1)
                    score[a : a + len(near)] = near.max(axis=1).clip(0, 1)
                    least[a : a + len(near)] = bar[band(count.sum(axis=1))]
                mute = ~_has_letters(texts, raw)
                best[mute], score[mute] = len(langs), 0.0
            far = score < least
            held = [i is not None and zlib.crc32(str(i).encode()) % folds == held_out
                    for i in rows.column(0).to_pylist()]
            kept = [rows.column(k) for k in range(rows.num_columns) if carry or k != 1]
            names_ = [n for n in rows.schema.names if carry or n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(held), pa.array(names[best], type=pa.string()), pa.array(score),
                 pa.array(far | (best == len(langs)))], names=[*names_, *(f for f, _ in fields)])

    docs = docs.drop("language_id") if carry else docs
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    cols = [F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(text_col).cast("binary").alias("text")]
    if not carry:
        return docs.select(*cols).mapInArrow(run, RESULT)
    cols.append(others.alias("extra"))
    kind = docs.select(others.alias("extra")).schema[0].dataType.simpleString()
    out = docs.select(*cols).mapInArrow(
        run, f"doc_id long, text binary, extra {kind}, {RESULT.partition(', ')[2]}")
    return out.select(*[F.col(f"extra.`{c}`").alias(c) if c != text_col else
                        F.col("text").cast("string").alias(c) for c in docs.columns],
                      F.struct(*(f for f, _ in fields)).alias("language_id"))
