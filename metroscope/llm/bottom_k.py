"""Bottom-k sketches of word shingles, in DataFrame functions only.

The sketch of a text is the sorted array of the k smallest distinct hashes of its shingles (runs of
``size`` words; fewer words count as one shingle; no words give an empty sketch). A sketch of fewer than k hashes is
the whole set. The sketch of a union is the k smallest of both sketches, so sketches of parts merge in
any order. From sketches alone follow the resemblance (Jaccard similarity), the containment of one set in
another and the number of distinct shingles; a sketch of k hashes has a standard error of about
1 / sqrt(k) of a resemblance near one half, and as much relative error of a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decision_lists import let, words_of

BUCKET_ROWS = 2_000


def sketch(text: Column, k: int = 128, size: int = 5) -> Column:
    def hashes(words: Column) -> Column:
        n = F.size(words)
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < size, F.array(F.xxhash64(words))).otherwise(
            F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.xxhash64(F.slice(words, i, size))))

    return F.slice(F.sort_array(F.array_distinct(let(words_of(text), hashes))), 1, k)


def merge(a: Column, b: Column, k: int = 128) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_by(rows: DataFrame, key: str, column: str, k: int = 128) -> DataFrame:
    """(key, sketch of the union) per key; the k smallest hashes are found by a ranked window, whose limit applies before the shuffle."""
    hashes = rows.select(key, F.explode(column).alias("hash")).distinct()
    ranked = hashes.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("hash"))).where(F.col("rank") <= k)
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list("hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sets."""
    return let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(u, a), b)).cast("double") / F.size(u)))


def distinct_shingles(a: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    place = (F.element_at(a, F.lit(k)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    share = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share / distinct_shingles(a, k)))


def fingerprint(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, **computed: Column) -> DataFrame:
    """(doc_id, text, computed columns, next_text and next_<column>) where next is the following row in ascending doc_id; the first follows the last.

    A null doc_id comes first; rows of one doc_id follow each other by a hash of their text. A single row is its own next. Null texts are empty.

    Rows meet by ranges of doc_id of about ``BUCKET_ROWS`` rows, so texts are shuffled once; only the
    last row of each range looks for its next elsewhere, in the table of the ranges' first rows.
    """
    bounds = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("rows")).first()
    shift = max(0, ((((bounds["high"] or 0) - (bounds["low"] or 0)) * BUCKET_ROWS) // max(1, bounds["rows"])).bit_length() - 1)
    # Where ids lie densely in places, the ranges get narrower.
    while shift and docs.groupBy(F.shiftright(F.col("doc_id").cast("long"), shift)).count().where(F.col("count") > 2 * BUCKET_ROWS).limit(1).count():
        shift -= 1
    low = (bounds["low"] or 0) >> shift
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.shiftright(F.col("doc_id").cast("long"), shift), F.lit(low - 1).cast("long")).alias("bucket")).repartition("bucket")
    order = Window.partitionBy("bucket").orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    names = ["text", *computed]
    kept = ["doc_id", *names, *[f"next_{c}" for c in names]]
    inner = placed.withColumns(computed).withColumns({f"next_{c}": F.lead(c).over(order) for c in names}).where("next_text is not null")
    # First and last rows of the ranges, few: computed columns come after the choice.
    edge = placed.withColumn("last", F.lead(F.lit(1)).over(order)).where("last is null").drop("last").withColumns(computed)
    heads = placed.withColumn("place", F.row_number().over(order)).where("place = 1").withColumns(computed).select(
        F.col("bucket").alias("head"), *[F.col(c).alias(f"next_{c}") for c in names])
    ranges = placed.select("bucket").distinct()
    first = F.min("bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = ranges.select(F.col("bucket").alias("from"), F.coalesce(F.lead("bucket").over(Window.orderBy("bucket")), first).alias("to"))
    closing = edge.join(following, F.col("bucket") == F.col("from")).join(heads, F.col("to") == F.col("head")).select(*kept)
    return inner.select(*kept).unionByName(closing)


def fingerprints(docs: DataFrame, k: int = 128, size: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its fingerprint, that of its edited text, and how alike they and the next document are.

    The edited text ends with the beginning of the next document's text instead of its own last half (rounded down). Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles (estimate), contained (estimated share of its shingles in the edited text). Other
    columns of ``docs`` are ignored.
    """
    rows = with_next(docs, sketch=sketch(F.col("text"), k, size))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    sketched = edited.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), k, size).alias("edited_sketch"))
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"), resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"), containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained"))
