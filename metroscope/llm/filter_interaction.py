"""How filters act together: what each removes in every order, and its Shapley value by potentials.

Documents are counted by the set of filters that they fail, per part: at most 2**n counts for n filters, however
many documents there are. The removal game of a part gives a coalition S of filters the number of documents that fail any
filter of S. Its Hart-Mas-Colell potential is found from the empty coalition upwards,

    P(empty) = 0        P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

and the Shapley value of filter i is P(all) - P(all without i). To stay in whole numbers the fold carries
|S|! P(S). A step of an order is a difference of two coalitions, so no order is ever run over documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import staged
from .words import segments


def removal_games(failures: DataFrame, part: str, filters: Sequence[str], losses: Sequence[str] = ()) -> DataFrame:
    """(part, documents, removed, one array per loss): arrays by coalition, the bit 2**k standing for ``filters[k]``.

    ``failures`` has a boolean column per filter (null: passes) and per loss, a property of documents worth counting (null: absent).
    """
    failed = sum((F.when(F.col(f), F.lit(1 << k)).otherwise(0) for k, f in enumerate(filters)), F.lit(0))
    sums = [F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in losses]]
    counted = failures.groupBy(F.col(part).alias(part), failed.alias("failed")).agg(*sums)
    # At most 2**n rows per part.
    listed = counted.groupBy(part).agg(F.sum("n").alias("documents"), F.collect_list(F.struct("failed", "n", *losses)).alias("sets"))

    def game(count: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1)), lambda s: F.aggregate(
            F.filter("sets", lambda x: x["failed"].bitwiseAND(s) != 0), F.lit(0).cast("long"), lambda total, x: total + x[count]))

    return listed.select(part, "documents", game("n").alias("removed"), *[game(c).alias(c) for c in losses])


def scaled_potentials(game: Column, n: int) -> Column:
    """|S|! P(S) for each coalition S of the game, an array by coalition: each is found from those with one filter less, which precede it."""

    def extended(found: Column, s: Column) -> Column:
        without = sum((F.when(s.bitwiseAND(1 << k) != 0, F.get(found, s.bitwiseXOR(F.lit(1 << k)))).otherwise(F.lit(0).cast("long")) for k in range(n)), F.lit(0).cast("long"))
        return F.concat(found, F.array(F.factorial(F.bit_count(s) - 1) * F.get(game, s) + without))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), F.array(F.lit(0).cast("long")), extended)


def filter_audit(failures: DataFrame, part: str, filters: Sequence[str], losses: Mapping[str, str] | None = None) -> DataFrame:
    """A row per part, order of all filters and step of it.

    Columns: part, filter_order (the names joined), step (from 1), and of the documents of the part: kept after the
    step, removed in it, redundant (failing the step's filter, removed before), unique_fails (failing that filter only), one column per
    entry of ``losses`` (name of the column: boolean column of ``failures``; documents removed in the step that have it) and
    shapley, the filter's Shapley value times the number of orders. A part without failing documents has rows of zeros. A null part
    is a part of its own. An empty table gives no rows.
    """
    losses = dict(losses or {})
    n, all_of = len(filters), (1 << len(filters)) - 1
    games = removal_games(failures, part, filters, list(losses.values()))
    valued = games.withColumn("potential", scaled_potentials(F.col("removed"), n))
    orders = [F.struct(F.lit("".join(filters[k] for k in order)).alias("filter_order"), F.array(*[F.lit(1 << k) for k in order]).alias("bits"))
              for order in itertools.permutations(range(n))]
    stepped = valued.withColumn("order", F.explode(F.array(*orders))).select("*", "order.filter_order", F.posexplode("order.bits").alias("at", "bit"))
    placed = stepped.withColumn("before", F.aggregate(F.slice("order.bits", F.lit(1), F.col("at")), F.lit(0), lambda x, y: x.bitwiseOR(y)))
    after = F.col("before").bitwiseOR(F.col("bit"))
    gained = lambda game: F.get(F.col(game), after) - F.get(F.col(game), F.col("before"))
    rest = F.lit(all_of).bitwiseXOR(F.col("bit"))
    return placed.select(
        part, "filter_order", (F.col("at") + 1).cast("int").alias("step"),
        (F.col("documents") - F.get("removed", after)).alias("kept"), gained("removed").alias("removed"),
        (F.get("removed", F.col("bit")) - gained("removed")).alias("redundant"),
        (F.get("removed", F.lit(all_of)) - F.get("removed", rest)).alias("unique_fails"),
        *[gained(c).alias(name) for name, c in losses.items()],
        (F.get("potential", F.lit(all_of)) - n * F.get("potential", rest)).alias("shapley"))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters A to D of whole texts. Splitting bytes took 4.1 s where ``split`` and ``array_distinct`` took 10.9 s (0.1 GB, six cores)."""
    capitals, marks = bytes(range(65, 91)), b"#$%&*|"
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        chars = pc.utf8_length(batch.column(2)).to_pylist()
        out = []
        for raw, n_chars in zip(texts.to_pylist(), chars):
            n_words, distinct = 0, set()
            for piece in segments(raw):
                words = piece.split()  # at the six blank bytes, as bytes go
                n_words += len(words)
                distinct.update(words)
            n_capitals = len(raw) - len(raw.translate(None, capitals))
            out.append((sha256(raw).digest(), n_words < 200, 100 * len(distinct) < 50 * n_words, 100 * n_capitals > 2 * n_chars, len(raw.translate(None, marks)) < len(raw)))
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(columns[0], pa.binary()), *[pa.array(c, pa.bool_()) for c in columns[1:]]],
                                         names=["doc_id", "part", "digest", "A", "B", "C", "D"])


def text_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, A, B, C, D, E, good, toxic) per row of ``docs`` (doc_id, text, source): which of five filters it fails.

    A: under 200 words. B: fewer than half of its words differ. C: over 2 % capital letters A-Z. D: any of ``#$%&*|``. E: its
    text is that of a smaller doc_id anywhere in the table. A null text is empty; the part is the source, null as an empty string. Rows
    that repeat a doc_id do not fail E because of each other; a row without doc_id never fails it. ``labels`` (doc_id,
    quality, toxic): a document is good or toxic if any of its labels says so. Other columns are ignored.

    Texts are read once and leave their task as a digest: a text with a third of all rows is one row of the
    table of first ids after partial minima, and the rows meet that table by digest and id together, which spreads copies.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    read = staged(texts.mapInArrow(_judged, "doc_id long, part string, digest binary, A boolean, B boolean, C boolean, D boolean"), "failures")
    first = read.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return read.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").select(
        "doc_id", "part", "A", "B", "C", "D", (F.col("doc_id").isNotNull() & F.col("first").isNull()).alias("E"), "good", "toxic")
