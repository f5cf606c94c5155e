"""Cross-entropy difference of two matched n-gram models.

Both models are bigram models over the same words, the same bigrams and the same smoothing; one
is estimated on the target documents, the other on all documents. A document's score is the mean over its words of
the target model's loss minus the background model's: the lower, the more it reads like the target.

The models hold every word and every bigram of all documents:

    p(w) = (c(w) + 1/2) / (N + (V + 1) / 2)        p(w | h) = (c(h, w) + m p(w)) / (c(h) + m)

where V counts the distinct words. Words are lower-cased (A-Z); words and bigrams are told apart by 64-bit hashes.

No task holds a model. Documents are read in batches of about ``BATCH_TOKENS`` words; each batch sends every distinct word
and bigram once, with its counts, to the bucket of its hash, and a bucket answers each batch with the counts over all
batches. The buckets grow in number with the words, not in size, and a frequent key is one entry per batch. Keys travel as
sorted differences in byte planes.

With ``words`` or ``bigrams`` given, smaller models are used instead, which every task loads: the most frequent ``words`` words,
the others being one unknown word, and of the bigrams seen twice the ``bigrams`` most frequent; the others back off
to their word's unigram probability, with the weight that the kept bigrams of their history leave, c(h) summing those.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import staged
from .words import mix, word_hashes

WORDS = (1 << 16) - 2
BIGRAMS = 1 << 20
BATCH_TOKENS = 1 << 21
BUCKET_KEYS = 1 << 20
LEAST_BUCKETS = 32
SCORES = "doc_id long, n_words long, target_loss double, background_loss double, difference double"


def _most_frequent(counts: DataFrame, count: str, limit: int) -> DataFrame:
    """At most ``limit`` rows: those whose count is at least the smallest count that lets no more through."""
    level = F.floor(F.log2(F.col(count)) * 64).cast("int")
    least, total = None, 0
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # a few thousand levels at most
        total += row["count"]
        if total > limit:
            break
        least = row["level"]
    return counts.where(level >= least) if least is not None else counts.limit(0)


def vocabulary(docs: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes of the most frequent words."""

    def run(batches):
        for batch in batches:
            found = [word_hashes(t) for t in batch.column(0).to_pylist()]
            if found:
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["word", "n"])

    counts = staged(docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    return np.sort(_most_frequent(counts, "n", words).select("word").toArrow().column("word").to_numpy().view(np.uint64))


def pair_keys(text: str | None, vocabulary: np.ndarray) -> np.ndarray:
    """history << 16 | word for each word: 0 is the unknown word, 1.. the vocabulary, the last the start of a text."""
    hashes = word_hashes(text)
    if not len(hashes):
        return np.zeros(0, dtype=np.uint32)
    at = np.searchsorted(vocabulary, hashes)
    ids = np.zeros(len(hashes), dtype=np.uint32)
    if len(vocabulary):
        known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes
        ids[known] = at[known] + 1
    history = np.concatenate((np.array([len(vocabulary) + 1], dtype=np.uint32), ids[:-1]))
    return history << np.uint32(16) | ids


def bigram_counts(flagged: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(pair, n, target) over rows (text, target): sums within batches come first."""

    def run(batches):
        for batch in batches:
            texts, target = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                keys, marks, size = [], [], 0
                while at < len(texts) and size < BATCH_TOKENS:
                    keys.append(pair_keys(texts[at], vocabulary))
                    marks.append(np.full(len(keys[-1]), bool(target[at])))
                    size += len(keys[-1])
                    at += 1
                values, place, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
                of_target = np.bincount(place[np.concatenate(marks)], minlength=len(values))
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts), pa.array(of_target)], names=["pair", "n", "target"])

    return flagged.select("text", "target").mapInArrow(run, "pair long, n long, target long").groupBy("pair").agg(
        F.sum("n").alias("n"), F.sum("target").alias("target"))


class Models:
    """Losses of both models, as arrays: kept bigrams, and per word and history what the others cost."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, unigrams: np.ndarray, weight: float):
        order = np.argsort(pairs)
        self.pairs = pairs[order].astype(np.uint32)
        history, word = (self.pairs >> np.uint32(16)).astype(np.int64), (self.pairs & np.uint32(0xFFFF)).astype(np.int64)
        size = unigrams.shape[1]
        self.kept, self.open, self.single = [], [], []
        for own, words in zip(counts[:, order], unigrams):
            p = (words + 0.5) / (words.sum() + size / 2)
            total = np.bincount(history, weights=own, minlength=size + 1)
            self.kept.append((-np.log((own + weight * p[word]) / (total[history] + weight))).astype(np.float32))
            self.open.append(-np.log(weight / (total + weight)))
            self.single.append(-np.log(p))

    def losses(self, keys: np.ndarray) -> tuple[float, float]:
        history, word = (keys >> np.uint32(16)).astype(np.int64), (keys & np.uint32(0xFFFF)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
        kept = self.pairs[at] == keys if len(self.pairs) else np.zeros(len(keys), dtype=bool)
        return tuple(float(self.kept[k][at[kept]].sum(dtype=np.float64) + (self.open[k][history] + self.single[k][word])[~kept].sum()) for k in (0, 1))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as byte planes, compressed."""
    raw = b"".join([np.array([len(arrays), *map(len, arrays)], dtype="<i8").tobytes(), *[a.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]])
    return struct.pack("<q", len(raw)) + pa.Codec("zstd").compress(raw, asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(data[8:], struct.unpack("<q", data[:8])[0], asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    out, at = [], 8 * (n + 1)
    for size in np.frombuffer(raw, "<i8", n, 8).tolist():
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * size, at).reshape(8, size).T).view("<u8").reshape(size))
        at += 8 * size
    return out


def steps(keys: np.ndarray) -> np.ndarray:
    """Differences modulo 2**64, which ``np.cumsum`` undoes."""
    return np.diff(keys, prepend=np.uint64(0))


def batched(docs: DataFrame) -> DataFrame:
    """(batch, n, doc_ids, words, texts): hashes of the distinct words, frequent ones first; words per document and the number of each word."""

    def run(batches):
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId() << 32, 0

        def made(ids: list, found: list[np.ndarray]) -> pa.RecordBatch:
            words, place, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            order = np.lexsort((words, -counts))
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            return pa.RecordBatch.from_arrays(
                [pa.array([part + serial]), pa.array([len(place)]), pa.array([ids], pa.list_(pa.int64())), pa.array([packed(steps(words[order]))], pa.binary()),
                 pa.array([packed(np.array([len(f) for f in found]), rank[place])], pa.binary())], names=["batch", "n", "doc_ids", "words", "texts"])

        ids, found, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                found.append(word_hashes(text))
                size += len(found[-1]) + 1
                if size >= BATCH_TOKENS:
                    yield made(ids, found)
                    ids, found, size, serial = [], [], 0, serial + 1
        if ids:
            yield made(ids, found)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "batch long, n long, doc_ids array<long>, words binary, texts binary")


class Batch:
    """Words and bigrams of a batch by local numbers; the word after the last is the start of a text."""

    def __init__(self, words: bytes, texts: bytes):
        self.hashes = np.append(np.cumsum(unpacked(words)[0], dtype=np.uint64), mix(np.array([1], dtype=np.uint64)))
        self.sizes, ids = (a.astype(np.int64) for a in unpacked(texts))
        history = np.empty_like(ids)
        history[1:] = ids[:-1]
        history[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = len(self.hashes) - 1
        codes, self.place = np.unique(history << 32 | ids, return_inverse=True)
        self.history, self.word = codes >> 32, codes & 0xFFFFFFFF
        self.pairs = mix(self.hashes[self.history] * np.uint64(0xD1342543DE82EF95) + self.hashes[self.word])

    def parts(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, words, pairs) for each bucket that has any, in the order of their keys."""
        cut = []
        for keys in (self.hashes, self.pairs):
            order = np.argsort(keys)
            bucket = (keys[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            cut.append((order, np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))))
        for b in range(buckets):
            words, pairs = (order[bounds[b] : bounds[b + 1]] for order, bounds in cut)
            if len(words) or len(pairs):
                yield b, words, pairs

    def counts(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words (as word in target and all documents, as history in both) and of pairs (target, all); ``target`` marks documents."""
        size = len(self.pairs)
        pairs = np.stack([np.bincount(self.place[np.repeat(target, self.sizes)], minlength=size), np.bincount(self.place, minlength=size)])
        words = np.stack([np.bincount(at, weights=own, minlength=len(self.hashes)) for at in (self.word, self.history) for own in pairs])
        return words.astype(np.int64), pairs


def requests(batches: DataFrame, targets: DataFrame, buckets: int) -> DataFrame:
    """(batch, bucket, data): keys of words and pairs with their counts."""
    at = batches.select("batch", F.posexplode("doc_ids").alias("at", "doc_id")).where("doc_id is not null")
    marks = at.join(targets.hint("merge"), F.col("doc_id") == F.col("t")).groupBy("batch").agg(F.collect_list("at").alias("marks"))

    def run(rows):
        for row in rows:
            for batch, words, texts, marks in zip(*(c.to_pylist() for c in row.columns)):
                own = Batch(words, texts)
                target = np.zeros(len(own.sizes), dtype=bool)
                target[marks or []] = True
                of_words, of_pairs = own.counts(target)
                out = [(b, packed(steps(own.hashes[w]), *of_words[:, w], steps(own.pairs[p]), *of_pairs[:, p])) for b, w, p in own.parts(buckets)]
                yield pa.RecordBatch.from_arrays([pa.array([batch] * len(out)), pa.array([b for b, _ in out]), pa.array([d for _, d in out], pa.binary())], names=["batch", "bucket", "data"])

    return batches.select("batch", "words", "texts").join(marks.hint("merge"), "batch", "left").mapInArrow(run, "batch long, bucket long, data binary")


def answers(asked: DataFrame) -> DataFrame:
    """(batch, bucket, data, distinct, target, background): counts over all batches in the order of the request; the words of a bucket on one of its rows."""

    def run(table: pa.Table) -> pa.Table:
        found = [unpacked(d) for d in table.column("data").to_pylist()]
        out, sums = [[] for _ in found], None
        for first, last in ((0, 5), (5, 8)):
            values, place = np.unique(np.concatenate([np.cumsum(f[first], dtype=np.uint64) for f in found]), return_inverse=True)
            totals = np.stack([np.bincount(place, weights=np.concatenate([f[k] for f in found]), minlength=len(values)) for k in range(first + 1, last)]).astype(np.int64)
            sums = sums or [int((totals[1] > 0).sum()), int(totals[0].sum()), int(totals[1].sum())]
            for own, part in zip(out, np.split(place, np.cumsum([len(f[first]) for f in found])[:-1])):
                own += list(totals[:, part])
        rest = [0] * (len(found) - 1)
        return pa.table([table.column("batch"), table.column("bucket"), pa.array([packed(*o) for o in out], pa.binary()), *[pa.array([s, *rest]) for s in sums]],
                        names=["batch", "bucket", "data", "distinct", "target", "background"])

    return asked.groupBy("bucket").applyInArrow(run, "batch long, bucket long, data binary, distinct long, target long, background long")


def scored(batches: DataFrame, counted: DataFrame, buckets: int, sizes: tuple[int, int, int], weight: float) -> DataFrame:
    distinct, *totals = sizes

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        data = {r["bucket"]: r["data"] for r in rows if r["doc_ids"] is None}
        ids, words, texts = next((r["doc_ids"], r["words"], r["texts"]) for r in rows if r["doc_ids"] is not None)
        own = Batch(words, texts)
        of_words, of_pairs = np.zeros((4, len(own.hashes))), np.zeros((2, len(own.pairs)))
        for b, w, p in own.parts(buckets):
            found = unpacked(data[b])
            of_words[:, w], of_pairs[:, p] = found[:4], found[4:]
        n, losses = own.sizes, []
        doc = np.repeat(np.arange(len(n)), n)
        for k in (0, 1):
            p = (of_words[k][own.word] + 0.5) / (totals[k] + (distinct + 1) / 2)
            loss = -np.log((of_pairs[k] + weight * p) / (of_words[2 + k][own.history] + weight))
            losses.append(np.bincount(doc, weights=loss[own.place], minlength=len(n)) / np.maximum(n, 1))
        none = n == 0
        return pa.table([pa.array(ids, pa.int64()), pa.array(n), *[pa.array(x, mask=none) for x in (*losses, losses[0] - losses[1])]], names=[x.split()[0] for x in SCORES.split(", ")])

    none = F.lit(None)
    both = batches.select("batch", F.lit(-1).cast("long").alias("bucket"), "doc_ids", "words", "texts", none.cast("binary").alias("data")).unionByName(
        counted.select("batch", "bucket", none.cast("array<long>").alias("doc_ids"), none.cast("binary").alias("words"), none.cast("binary").alias("texts"), "data"))
    return both.groupBy("batch").applyInArrow(run, SCORES)


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, words: int | None = None, bigrams: int | None = None, weight: float = 16.0) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, difference) per row of ``docs`` (doc_id, text): losses in nats per word.

    ``target_ids`` (doc_id) names the target documents; ids twice or unknown or null do no harm. Every row counts for the background, repeated rows
    as often as they occur. A text without words has null losses. Without target documents the target model is the smoothing alone. Other
    columns are ignored.
    """
    targets = target_ids.where("doc_id is not null").select(F.col("doc_id").alias("t")).distinct()
    if words is not None or bigrams is not None:
        return with_small_models(docs, targets, WORDS if words is None else words, BIGRAMS if bigrams is None else bigrams, weight)
    batches = staged(batched(docs), "batches")
    buckets = max(LEAST_BUCKETS, (batches.agg(F.sum("n")).first()[0] or 0) // BUCKET_KEYS)
    counted = staged(answers(requests(batches, targets, buckets)), "counts")
    sizes = tuple(x or 0 for x in counted.agg(F.sum("distinct"), F.sum("target"), F.sum("background")).first())
    return scored(batches, counted, buckets, sizes, weight)


def with_small_models(docs: DataFrame, targets: DataFrame, words: int, bigrams: int, weight: float) -> DataFrame:
    if not 0 < words <= (1 << 16) - 2:
        raise ValueError("a pair of words must fit 32 bits")
    known = vocabulary(docs, words)
    # Joined by shuffling at every size: whether the ids fit a broadcast would change what large inputs cost.
    flagged = docs.select("doc_id", "text").join(targets.hint("merge"), F.col("doc_id") == F.col("t"), "left").select("text", F.col("t").isNotNull().alias("target"))
    counts = staged(bigram_counts(flagged, known), "bigrams")
    single = counts.groupBy(F.col("pair").bitwiseAND(0xFFFF).cast("int").alias("word")).agg(F.sum("target").alias("t"), F.sum("n").alias("n")).toArrow()
    unigrams = np.zeros((2, len(known) + 1))
    at = single.column("word").to_numpy()
    unigrams[0, at], unigrams[1, at] = single.column("t").to_numpy(), single.column("n").to_numpy()
    kept = _most_frequent(counts.where("n > 1"), "n", bigrams).toArrow()
    saved = io.BytesIO()
    np.savez_compressed(saved, vocabulary=known, pairs=kept.column("pair").to_numpy(), unigrams=unigrams,
                        counts=np.stack([kept.column("target").to_numpy(), kept.column("n").to_numpy()]).astype(np.float64))
    model = saved.getvalue()

    def run(batches):
        arrays = np.load(io.BytesIO(model))
        vocabulary = arrays["vocabulary"]
        models = Models(arrays["pairs"], arrays["counts"], arrays["unigrams"], weight)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                keys = pair_keys(text, vocabulary)
                n = len(keys)
                target, background = models.losses(keys) if n else (None, None)
                rows.append((n, target / n, background / n, (target - background) / n) if n else (0, None, None, None))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, [pa.int64()] + [pa.float64()] * 3)]], names=[x.split()[0] for x in SCORES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORES)
