"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic and one on
windows of ordinary text.  A window is one word in a fixed frame; its
distance is its compressed length with the ordinary dictionary less that with
the toxic one.  Only some windows of a toxic document are toxic, so the toxic
dictionary is trained again and again on those windows of toxic documents
that it compresses best and that no ordinary document shares; of the sizes and
rounds tried, the one that tells unseen documents apart best is kept.

A document's score is a logistic function of how many of its windows reach
each of the thresholds (2 to 6 bytes), fitted on labelled documents that the
dictionaries have not seen and weighted to the labels' base rate, so it is a
probability.

Labels are read from a bounded sample: at most ``n_toxic`` and ``n_ordinary``
documents, those with the smallest hashes of their ids, all words of which are
learnt from; scoring reads every text whole.  The driver holds the sample's
different words and, for each document, their numbers; how long they are
compressed is measured in tasks.

Defined cases: a null or empty text has no window and gets the score that the
model gives to none; labels that are null or of unknown documents are not
used, a document with several labels is toxic if one is; without a label of
each kind every score is the base rate; repeated rows are returned as often
as they come; an empty table gives no rows; columns other than the id and the
text are never read, and are carried along by ``reject_toxic``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_strings, saved, slices, text_rows

FRAME = b"........ "            # makes short windows long enough to be compressed
LEVELS = (2, 3, 4, 5, 6)        # bytes by which the toxic dictionary must win
ORDINARY_BYTES, TOXIC_BYTES = 65_536, (2048, 8192, 16_384)
ROUNDS = 4
CACHE_WORDS = 150_000
#: every byte but letters, digits and non-ASCII ones to a space, A-Z to lower case
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
N_FEATURES = 2 * len(LEVELS) + 1


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=lambda: [0.0] * N_FEATURES)
    bias: float = 0.0


def held_out(id_col: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def windows(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:                      # too few samples: their text is the dictionary
        return b"".join(samples)[-size:]


def _compressor(dictionary: bytes):
    params = zstd.ZstdCompressionParameters(
        window_log=18, hash_log=17, chain_log=17, search_log=5, min_match=3, target_length=32,
        strategy=zstd.STRATEGY_BTULTRA, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstd.FORMAT_ZSTD1_MAGICLESS)
    return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(dictionary), compression_params=params).compress


class Distance:
    """Distances of windows, remembered for the words met before."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = _compressor(ordinary), _compressor(toxic)
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> list[int]:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                window = FRAME + w + b" "
                known[w] = len(self.ordinary(window)) - len(self.toxic(window))
        return [known[w] for w in words]


def features(words: list[bytes], distance: Distance) -> list[float]:
    counts = Counter(words)
    d = np.array(distance.of(list(counts)), dtype=np.int64)
    return _features(d, np.fromiter(counts.values(), dtype=np.int64, count=len(counts)))


def _features(d: np.ndarray, n: np.ndarray) -> list[float]:
    """Features of a document whose different words have distances ``d`` and come ``n`` times."""
    total = int(n.sum())
    reach = [int(n[d >= k].sum()) for k in LEVELS]
    return [*(float(np.log1p(200 * x / max(1, total))) for x in reach), *(float(np.log1p(x)) for x in reach),
            float(np.log1p(total))]


def compressed_lengths(words: list[bytes], dictionary: bytes) -> list[int]:
    size = _compressor(dictionary)
    return [len(size(FRAME + w + b" ")) for w in words]


def train_dictionaries(vocabulary: list[bytes], toxic: list[np.ndarray], ordinary: list[np.ndarray],
                       lengths: Callable[[bytes], np.ndarray]) -> tuple[bytes, bytes]:
    """Dictionaries from toxic and ordinary documents, each given by the numbers
    of its different words in the sorted ``vocabulary``; ``lengths`` measures
    all words with a dictionary.  Of the toxic dictionaries of all sizes and
    rounds, the one whose distances tell a fifth of the documents apart best,
    which none of them has seen."""
    toxic, judged = toxic[len(toxic) // 5:], [(d, 1) for d in toxic[:len(toxic) // 5]]
    ordinary, judged = ordinary[len(ordinary) // 5:], judged + [(d, 0) for d in ordinary[:len(ordinary) // 5]]
    none = np.zeros(0, dtype=np.int64)
    plain = np.random.default_rng(0).permutation(np.concatenate([none, *ordinary]))
    framed = lambda ids: [FRAME + vocabulary[i] + b" " for i in ids.tolist()]
    first = _dictionary(framed(plain), ORDINARY_BYTES)
    base = lengths(first)
    shared = np.zeros(len(vocabulary), dtype=bool)
    shared[plain] = True
    long = np.array([len(w) > 2 for w in vocabulary], dtype=bool)
    bad = np.concatenate([none, *toxic])
    # toxic words come back in other documents; names, numbers and slips mostly do not
    again = np.bincount(bad, minlength=len(vocabulary)) >= 2
    start = bad[long[bad] & ~shared[bad] & again[bad]]
    start = start if len(start) >= 100 else bad[long[bad] & ~shared[bad]]
    found = []
    for size in TOXIC_BYTES:
        second = _dictionary(framed(start) or framed(plain[:1000]), size)
        for k in range(ROUNDS + 1):
            distance = base - lengths(second)
            found.append((_loss(judged, distance), -size, k, second))
            if k == ROUNDS:
                break
            telling = long & (distance >= 2) & ~shared & again
            chosen = []
            for d in toxic:
                own = d[long[d]]
                best = own[np.lexsort((own, -distance[own]))[:max(1, len(own) // 20)]]
                chosen.append(best[telling[best]])
            chosen = np.concatenate([none, *chosen])
            if len(chosen) < 100:
                break
            second = _dictionary(framed(chosen), size)
    return first, min(found)[-1]


def _loss(judged: list[tuple[np.ndarray, int]], distance: np.ndarray) -> float:
    """Log loss of a logistic function of the features, fitted on every other
    document and read on the rest, and the other way round."""
    x = np.array([_features(distance[d], np.ones(len(d), dtype=np.int64)) for d, _ in judged]).reshape(-1, N_FEATURES)
    y = np.array([t for _, t in judged], dtype=float)
    loss = 0.0
    for half in range(2):
        fit, read = np.arange(len(y)) % 2 == half, np.arange(len(y)) % 2 != half
        if not fit.any() or not read.any():
            continue
        weights, bias = logistic(x[fit], y[fit], np.ones(int(fit.sum())))
        p = 1 / (1 + np.exp(-np.clip(x[read] @ weights + bias, -30, 30)))
        loss -= float((y[read] * np.log(p) + (1 - y[read]) * np.log(1 - p)).sum())
    return loss


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weighted ridge logistic regression by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (p - y)) + penalty * beta
        hess = (a * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, n_toxic: int = 2500, n_ordinary: int = 5000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model learnt from the labels of documents that are not held out."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts.get(0) or not counts.get(1):
        rate = min(max(counts.get(1, 0) / max(1, sum(counts.values())), 1e-3), 1 - 1e-3)
        return Model(bias=float(np.log(rate / (1 - rate))))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    sample = (known.where("y = 1").orderBy(*order).limit(n_toxic)
              .unionByName(known.where("y = 0").orderBy(*order).limit(n_ordinary)))
    chosen = saved(sample.withColumn("learn", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)) < 3), "tox-sample")
    # at most n_toxic + n_ordinary ids
    texts = saved(text_rows(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id"), "tox-texts")

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = [sorted(set(windows(t))) for t in byte_strings(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("y"), part.column("doc_id"), pa.array(words, pa.list_(pa.binary()))],
                                             ["y", "doc_id", "words"])

    read = texts.where("learn").mapInArrow(different, "y int, doc_id long, words array<binary>").toArrow().sort_by("doc_id")
    y = read.column("y").to_numpy()
    if not (y == 0).any() or not (y == 1).any():
        rate = counts[1] / (counts[0] + counts[1])
        return Model(bias=float(np.log(rate / (1 - rate))))
    lists = read.column("words").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    number = np.empty(len(vocabulary), dtype=np.int64)
    number[sorted(range(len(vocabulary)), key=vocabulary.__getitem__)] = np.arange(len(vocabulary))
    vocabulary.sort()
    ids = number[coded.indices.to_numpy()]
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    each = np.split(ids, np.cumsum(sizes)[:-1])
    split = [[each[i] for i in np.flatnonzero(y == label).tolist()] for label in (1, 0)]
    ordinary, toxic = train_dictionaries(vocabulary, *split, _measured(docs.sparkSession, vocabulary))
    del read, lists, coded, ids, each, split, vocabulary
    shared = docs.sparkSession.sparkContext.broadcast((ordinary, toxic))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(*shared.value)
        for part in slices(batches):
            x = [features(windows(t), distance) for t in byte_strings(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("y"), part.column("doc_id"), pa.array(x, pa.list_(pa.float64()))],
                                             ["y", "doc_id", "x"])

    seen = texts.where("not learn").mapInArrow(measure, "y int, doc_id long, x array<double>").collect()
    seen.sort(key=lambda r: r.doc_id)
    y = np.array([r.y for r in seen], dtype=float)
    if not len(y) or y.min() == y.max():
        rate = counts[1] / (counts[0] + counts[1])
        return Model(ordinary, toxic, bias=float(np.log(rate / (1 - rate))))
    w = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    weights, bias = logistic(np.array([r.x for r in seen]), y, w * len(y) / w.sum())
    return Model(ordinary, toxic, weights.tolist(), bias)


def _measured(spark: SparkSession, vocabulary: list[bytes]) -> Callable[[bytes], np.ndarray]:
    """Compressed lengths of the sample's words, measured in tasks; a number a word comes back."""
    table = pa.table({"id": pa.array(range(len(vocabulary)), pa.int64()), "word": pa.array(vocabulary, pa.binary())})
    words = saved(spark.createDataFrame(table).repartition(4 * spark.sparkContext.defaultParallelism, "id"), "tox-words")

    def lengths(dictionary: bytes) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(compressed_lengths(b.column("word").to_pylist(), dictionary), pa.int32())], ["id", "n"])
        got = words.mapInArrow(run, "id long, n int").toArrow()
        out = np.zeros(len(vocabulary), dtype=np.int64)
        out[got.column("id").to_numpy()] = got.column("n").to_numpy()
        return out
    return lengths


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(row, text, score): ``row`` holds all columns of ``docs`` but the text,
    which is null unless asked for."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        distance = Distance(own.ordinary, own.toxic)
        weights = np.array(own.weights)
        for part in slices(batches):
            x = np.array([features(windows(t), distance) for t in byte_strings(part.column("text"))])
            z = x @ weights + own.bias
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("text") if keep_text else pa.nulls(part.num_rows, pa.string()),
                 pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["row", "text", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text string, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 from ``threshold`` on)."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    scored = score(text_rows(docs, id_col, text_col), model).select("row.doc_id", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they were."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    kept = score(docs, model, text_col, keep_text=True).where(F.col("score") < threshold)
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
