"""Toxicity by character n-grams: a logistic regression on presences scaled by naive Bayes log-count ratios.

The features are the distinct character n-grams of a text (lower-cased, blanks as single spaces, a space at either end), told apart by
64-bit hashes. On a bounded sample of labelled texts each n-gram has a log-count ratio

    r = log((p + 1) / (P + 2)) - log((q + 1) / (Q + 2))

of its document frequencies p among P toxic and q among Q other texts. The ``features`` n-grams whose ratio stands out
most from its own standard error are kept; a text's vector holds r where it has the n-gram, and a
logistic regression weighs them. Texts of the rarer class are all taken while the sample's
bound allows; weights restore the share of both classes. Scoring keeps a bitmap of the kept n-grams, so nearly all n-grams of a text
are passed over by one table lookup.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import staged
from .words import mix

ORDERS = (4, 6, 8, 10)
BITMAP_BITS = 22
PER_CLASS = 3_000
FEATURES = 1 << 16
_STEPS = [np.uint64(pow(0xA24BAED4963EE407, k, 1 << 64)) for k in range(1, 17)]
_SEGMENT = 1 << 20


def held_out():
    """Documents that teach nothing: crc32 of the doc_id as text, modulo 4, is 2."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def grams(text: str | None):
    """Hashes of the n-grams of a text, order by order, with repeats; long texts come in overlapping segments."""
    plain = " " + " ".join((text or "").lower().split()) + " "
    if len(plain) < ORDERS[0]:
        return
    for start in range(0, len(plain), _SEGMENT):
        points = np.frombuffer(plain[start : start + _SEGMENT + ORDERS[-1] - 1].encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
        for n in ORDERS:
            if len(points) >= n:
                total = points[: len(points) - n + 1] * _STEPS[0]
                for k in range(1, n):
                    total += points[k : len(points) - n + 1 + k] * _STEPS[k]
                total ^= total >> np.uint64(29)
                yield total * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)


def distinct_grams(text: str | None) -> np.ndarray:
    parts = list(grams(text))
    return np.unique(mix(np.concatenate(parts))) if parts else np.zeros(0, dtype=np.uint64)


def _counted(sample: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for label in (0, 1):
                found = [distinct_grams(t) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if y == label]
                if found:
                    values, n = np.unique(np.concatenate(found), return_counts=True)
                    zero = np.zeros(len(n), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n if label else zero), pa.array(zero if label else n)], names=["gram", "p", "q"])

    return sample.select("text", "label").mapInArrow(run, "gram long, p long, q long").groupBy("gram").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def _vectors(sample: DataFrame, kept: np.ndarray, ratios: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            at = []
            for text in batch.column(0).to_pylist():
                own = distinct_grams(text)
                place = np.minimum(np.searchsorted(kept, own), len(kept) - 1)
                at.append(place[kept[place] == own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(at, pa.list_(pa.int32())), pa.array([ratios[a] for a in at], pa.list_(pa.float64()))],
                names=["label", "weight", "at", "value"])

    return sample.select("text", "label", "weight").mapInArrow(run, "label int, weight double, at array<int>, value array<double>")


def train(docs: DataFrame, known: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES, regularisation: float = 0.002) -> bytes:
    """A model from texts (doc_id, text) and labels (doc_id, label 0/1), one per doc_id.

    It learns from at most ``per_class`` documents of each class, those of the smallest hash of doc_id. They are chosen by
    number, so only the chosen texts move. Without rows of both classes the model gives every text the share of label 1 (0 without any row).
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    present = docs.select(F.col("doc_id").cast("long")).distinct().join(known, "doc_id").select("doc_id", F.col("label").cast("int"))
    sizes = {r["label"]: r["count"] for r in present.groupBy("label").count().collect()}
    saved = io.BytesIO()
    if not (sizes.get(0) and sizes.get(1)):
        np.savez(saved, grams=np.zeros(0, np.uint64), weights=np.zeros(0), bias=np.array(40.0 if sizes.get(1) else -40.0))
        return saved.getvalue()
    turn = F.xxhash64("doc_id")
    chosen = []  # 2 * per_class numbers at most
    for y in (0, 1):
        weight = max(1.0, sizes[y] / per_class)
        chosen += [(r["doc_id"], y, weight) for r in present.where(F.col("label") == y).orderBy(turn, "doc_id").limit(per_class).collect()]
    numbers = F.broadcast(docs.sparkSession.createDataFrame(chosen, "chosen_id long, label int, weight double"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(numbers, F.col("doc_id") == F.col("chosen_id"))
    sample = staged(texts.select("text", "label", "weight").repartition(24), "sample")
    positive, negative = (min(per_class, sizes[y]) for y in (1, 0))
    ratio = F.log((F.col("p") + 1) / F.lit(positive + 2.0)) - F.log((F.col("q") + 1) / F.lit(negative + 2.0))
    ranked = _counted(sample).where("p + q >= 3").withColumn("ratio", ratio).withColumn("strength", F.abs("ratio") / F.sqrt(1 / (F.col("p") + 1) + 1 / (F.col("q") + 1)))
    best = ranked.orderBy(F.desc("strength"), "gram").limit(features).select("gram", "ratio").toArrow()
    kept, ratios = best.column("gram").to_numpy().view(np.uint64), best.column("ratio").to_numpy()
    order = np.argsort(kept)
    kept, ratios = kept[order], ratios[order]
    if not len(kept):
        np.savez(saved, grams=kept, weights=ratios, bias=np.array(np.log(sizes[1] / sizes[0])))
        return saved.getvalue()
    size = len(kept)
    vector = F.udf(lambda at, value: SparseVector(size, at, value), VectorUDT())
    rows = staged(_vectors(sample, kept, ratios), "vectors").select(F.col("label").cast("double").alias("label"), "weight", vector("at", "value").alias("features"))
    fitted = LogisticRegression(regParam=regularisation, maxIter=60, standardization=False, weightCol="weight").fit(rows)
    np.savez(saved, grams=kept, weights=fitted.coefficients.toArray() * ratios, bias=np.array(fitted.intercept))
    return saved.getvalue()


def score(docs: DataFrame, model: bytes, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs`` (doc_id, text); a null or empty text has the bias alone."""

    def run(batches):
        arrays = np.load(io.BytesIO(model))
        kept, weights, bias = arrays["grams"], arrays["weights"], float(arrays["bias"])
        # The bitmap looks at the hash before its last mixing, which only the n-grams that pass it undergo.
        table = np.zeros(1 << BITMAP_BITS, dtype=bool)
        table[_before_mix(kept) >> np.uint64(64 - BITMAP_BITS)] = True
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                passed = [g[table[g >> np.uint64(64 - BITMAP_BITS)]] for g in grams(text)]
                total = bias
                if passed and len(kept):
                    own = np.unique(mix(np.concatenate(passed)))
                    place = np.minimum(np.searchsorted(kept, own), len(kept) - 1)
                    total += float(weights[place[kept[place] == own]].sum())
                out.append(1 / (1 + np.exp(-min(max(total, -40.0), 40.0))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def _before_mix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    def unshift(y, by):
        out = y
        for _ in range(64 // by + 1):
            out = y ^ (out >> np.uint64(by))
        return out

    x = unshift(x, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = unshift(x, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshift(x, 30)


def toxicity(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic): null is no label, of several labels of one doc_id the highest counts. Held-out documents teach nothing. A null doc_id is scored and
    is not held out. Repeated rows give repeated results; other columns are ignored.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")).where(~held_out())
    model = train(docs.select("doc_id", "text"), known, **limits)
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
