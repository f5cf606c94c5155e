"""How the words of sources differ, from counts by chunk factorization.

Texts are cut at blanks. Every document's chunks are counted, batch by batch: a row per batch, language and chunk holds the occurrences by source
and the documents. Rows of a chunk then meet, each distinct chunk is tokenized once, its terms take over its counts, and
documents and occurrences are added up by term. A batch sends a chunk once, so no chunk has more rows than there are batches.

A term counts as frequent once it is in ``least_docs`` documents of its language. Two chunks of a term may share documents, so counts of
documents cannot be added; instead a chunk found in fewer documents names them all, and the union of a term's names decides. That is
exact and holds fewer than ``least_docs`` names a chunk.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import staged
from .words import segments

BATCH_WORDS = 1 << 22
#: Terms in lower-cased bytes of UTF-8: ASCII letters and whatever is beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")
SCALE = 1_000_000_000
CHUNKS = "lang string, chunk string, docs long, names array<long>, sources array<long>, counts array<long>"
TERMS = "lang string, term string, frequent boolean, names array<long>, sources array<long>, counts array<long>"


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values))


def _starts(*changed: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin; each array tells whether an element differs from the one before."""
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce(changed))))


class _Batch:
    """Chunks of some documents: numbers in order of appearance, counted per document."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.langs: list[str] = []
        self.sources: list[int] = []
        self.found: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.words = 0

    def add(self, lang: str, source: int, raw: bytes) -> None:
        # Bytes split at the six blanks of ASCII, none of which is part of a term.
        ids = [np.fromiter(map(self.number.__getitem__, piece.split()), dtype=np.int32) for piece in segments(raw)]
        found, counts = np.unique(ids[0] if len(ids) == 1 else np.concatenate(ids), return_counts=True)
        self.langs.append(lang)
        self.sources.append(source)
        self.found.append(found)
        self.counts.append(counts)
        self.words += int(counts.sum()) + 1

    def rows(self, first_name: int, least_docs: int) -> pa.RecordBatch:
        sizes = np.array([len(f) for f in self.found])
        chunk, count, doc = np.concatenate(self.found).astype(np.int64), np.concatenate(self.counts), np.repeat(np.arange(len(sizes)), sizes)
        langs, lang = np.unique(np.array(self.langs, dtype=object), return_inverse=True)
        sources, source = np.unique(np.array(self.sources, dtype=np.int64), return_inverse=True)
        key = lang[doc] * len(self.number) + chunk
        order = np.argsort(key * len(sources) + source[doc], kind="stable")
        key, count, doc = key[order], count[order], doc[order]
        begin = _starts(key[1:] != key[:-1])
        parts = _starts(key[1:] != key[:-1], np.diff(source[doc]) != 0)
        n_docs = np.diff(np.append(begin, len(key)))
        named = np.repeat(n_docs < least_docs, n_docs)
        texts = pa.array(self.number.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(key[begin] // len(self.number))), texts.take(pa.array(key[begin] % len(self.number))), pa.array(n_docs),
             _lists(doc[named] + first_name, np.where(n_docs < least_docs, n_docs, 0)),
             *[_lists(v, np.diff(np.append(np.searchsorted(parts, begin), len(parts)))) for v in (sources[source[doc[parts]]], np.add.reduceat(count, parts))]],
            names=["lang", "chunk", "docs", "names", "sources", "counts"])


def counted_chunks(docs: DataFrame, least_docs: int, batch_words: int = BATCH_WORDS) -> DataFrame:
    """A row per batch, language and chunk of ``docs`` (lang, source_hash, text): documents, their names if fewer than ``least_docs``, occurrences by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, own = TaskContext.get().partitionId() << 36, _Batch()
        for batch in batches:
            for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                own.add(lang, source, raw)
                if own.words >= batch_words:
                    if own.number:
                        yield own.rows(name, least_docs)
                    name, own = name + len(own.langs), _Batch()
        if own.number:
            yield own.rows(name, least_docs)

    return docs.select("lang", "source_hash", "text").mapInArrow(run, CHUNKS)


def joined_terms(chunks: DataFrame, least_docs: int) -> DataFrame:
    """The rows of each chunk as one, under each of its terms; ``frequent`` if the chunk alone is in ``least_docs`` documents of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_terms = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, chunk = batch.column(0), batch.column(1).cast(pa.binary())
            differs = lambda x: pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
            begin = _starts(differs(lang), differs(chunk))
            run_of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, batch.num_rows)))
            docs = np.add.reduceat(batch.column(2).to_numpy(), begin)
            # Names of the documents, where they are still needed.
            sizes = batch.column(3).value_lengths().to_numpy()
            at = np.repeat(run_of, sizes)
            needed = docs[at] < least_docs
            names = _lists(batch.column(3).flatten().to_numpy()[needed], np.bincount(at[needed], minlength=len(begin)))
            # Occurrences by source.
            known, source = np.unique(batch.column(4).flatten().to_numpy(), return_inverse=True)
            code = np.repeat(run_of, batch.column(4).value_lengths().to_numpy()) * len(known) + source
            codes, place = np.unique(code, return_inverse=True)
            per_run = np.bincount(codes // max(1, len(known)), minlength=len(begin))
            sums = np.bincount(place, weights=batch.column(5).flatten().to_numpy(), minlength=len(codes)).astype(np.int64)
            # Terms of each chunk, how often it holds them.
            runs, terms, times = [], [], []
            for k, text in enumerate(chunk.take(pa.array(begin)).to_pylist()):
                if text != last:
                    last, last_terms = text, TERM.findall(text.lower())
                if len(last_terms) == 1:
                    runs.append(k)
                    terms.append(last_terms[0])
                    times.append(1)
                else:
                    for term in dict.fromkeys(last_terms):
                        runs.append(k)
                        terms.append(term)
                        times.append(last_terms.count(term))
            runs, times = np.array(runs, dtype=np.int64), np.array(times, dtype=np.int64)
            take = pa.array(runs)
            counts = _lists(sums, per_run).take(take)
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(begin)).take(take), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(docs[runs] >= least_docs), names.take(take),
                 _lists(known[codes % max(1, len(known))], per_run).take(take), _lists(counts.flatten().to_numpy() * np.repeat(times, per_run[runs]), per_run[runs])],
                names=[c.split()[0] for c in TERMS.split(", ")])

    return chunks.repartition("chunk").sortWithinPartitions("chunk", "lang").mapInArrow(run, TERMS)


def frequent_terms(docs: DataFrame, least_docs: int, batch_words: int = BATCH_WORDS) -> DataFrame:
    """(lang, term, n, held) for terms in at least ``least_docs`` documents of their language: occurrences, and those by source hash."""
    rows = joined_terms(counted_chunks(docs, least_docs, batch_words), least_docs).repartition("lang", "term").groupBy("lang", "term").agg(
        F.max("frequent").alias("frequent"), *[F.flatten(F.collect_list(c)).alias(c) for c in ("names", "sources", "counts")])
    kept = rows.where(F.col("frequent") | (F.size(F.array_distinct("names")) >= least_docs))
    # The rows stay where they are: all sums below are within (lang, term).
    by_source = kept.select("lang", "term", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", "term", "sources").agg(F.sum("counts").alias("n"))
    return by_source.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.collect_list(F.struct(F.col("sources").alias("source_hash"), "n")).alias("held"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 2) / (total + 2 terms)), exact at any count."""
    wide = lambda x: x.cast("decimal(20,0)")
    return 1 + F.call_function("div", wide(count + 2) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + 2 * terms))


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence_audit(docs: DataFrame, least_docs: int = 10, top: int = 10, batch_words: int = BATCH_WORDS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs in ``docs`` (lang, source, text), nulls as empty strings.

    Terms are runs of ASCII letters and of anything beyond ASCII, A-Z as a-z. Each language keeps its V terms that are in at least
    ``least_docs`` of its documents (rows; repeated ones count again). A group has for each of them, occurring there or not, the share
    p = 1 + floor(10**9 (count + 2) / (N + 2 V)), N being its occurrences of kept terms; two shares differ by f = floor((p - q)**2 / (p + q)).
    Part ``pair``: every other source of the language, by the sum of f over the kept terms (0 without any). Part ``term``: the ``top`` terms of the
    source with p above the language's own share q, by f. Rank 1 is the largest value; ties go to the smaller item. An empty table gives no
    rows, texts without terms only pairs. Other columns are ignored.

    Groups are known by a 64-bit hash of their source until the end. The shares of a term in all sources of its language stand in one
    array, and pairs of them are added up where they are made: what moves is a row per pair of sources, as many as the result has.
    """
    empty = F.lit("")
    read = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).alias("text"))
    hashed = F.xxhash64("source").alias("source_hash")
    terms = staged(frequent_terms(read.select("lang", hashed, "text"), least_docs, batch_words), "terms")
    sums = terms.select("lang", F.inline("held")).groupBy("lang", "source_hash").agg(F.sum("n").alias("total"))
    whole = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    groups = staged(read.select("lang", "source").distinct().select("lang", "source", hashed).join(sums, ["lang", "source_hash"], "left").join(whole, "lang", "left").select(
        "lang", "source", "source_hash", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")]), "groups")
    return _pairs(terms, groups).unionByName(_terms(terms, groups, top))


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("int"))
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """Terms that a group has more often than its language."""
    own = terms.select("lang", "term", F.col("n").alias("all"), F.inline("held")).join(groups, ["lang", "source_hash"])
    shared = own.select("lang", "source", F.col("term").alias("item"), _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                        _share(F.col("all"), F.col("lang_total"), F.col("terms")).alias("q"))
    return _ranked(shared.where("p > q").select("lang", "source", "item", _distance(F.col("p"), F.col("q")).alias("value")), "term", top)


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Every two sources of a language."""
    listed = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "source_hash", "total"))).alias("groups"), F.max("terms").alias("terms"))
    held = F.map_from_entries("held")
    dense = terms.join(listed, "lang").withColumn("counts", held).select("lang", F.transform("groups", lambda g: _share(
        F.coalesce(F.try_element_at("counts", g["source_hash"]), F.lit(0).cast("long")), g["total"], F.col("terms"))).alias("shares"))
    # Half of the pairs, as f is symmetric; sums before the shuffle.
    left = dense.select("lang", "shares", F.posexplode("shares").alias("a", "p"))
    both = left.select("lang", "a", "p", F.posexplode(F.slice("shares", F.lit(1), F.col("a"))).alias("b", "q"))
    sums = both.groupBy("lang", "a", "b").agg(F.sum(_distance(F.col("p"), F.col("q"))).alias("value"))
    every = listed.select("lang", F.posexplode("groups").alias("x", "group"), F.col("groups").alias("others")).select(
        "lang", F.col("group.source").alias("source"), "x", F.posexplode("others").alias("y", "other")).where("x <> y").select(
        "lang", "source", F.col("other.source").alias("item"), F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    return _ranked(every.join(sums, ["lang", "a", "b"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")), "pair")
