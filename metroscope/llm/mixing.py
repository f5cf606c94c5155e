"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Each source is a stream of blocks of equal text volume. With weights in whole parts summing to Q, the
j-th block (from 0) of a source of k parts may not start before floor(j Q / k) and must be done by
ceil((j + 1) Q / k). One block is served per slot, the released one with the earliest deadline first;
one server is then always enough, so at any slot every source is less than one block from its share.

Sources that have no weight of their own are equal, however many they are, and enter the schedule as one
supertask with the sum of their parts, which they take in turns. When the supertask is less than a block
from its share, a turn through m equals is less than one block of each of them from theirs, so the bound and
the windows hold for every source. The schedule repeats after Q slots. Only the slots of named sources are
computed on the driver, so what it holds is a parameter's size and not the data's; the supertask has all
other slots, and the slot of its n-th block is n plus the named slots before it.

Streams longer than their share run on after the others have ended, in the order of their slots: no
document is dropped or repeated.
"""

from __future__ import annotations

import heapq
import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import staged

MAX_NAMED_PARTS = 100_000
BUCKET_ROWS = 2_000
FILE_CHARS = 32 << 20
CELLS_PER_E = 64  # cells of slots while the slot grows e-fold
CELL_DIGITS = 3  # unnamed sources are numbered in 16^3 cells


def schedule(parts: dict, rest: int = 0) -> list[tuple]:
    """(name, block of the period, slot, release, deadline) of the named sources over one period, in the order of the slots.

    The period is the sum of ``parts`` and ``rest``, the parts of the supertask, which serves its own blocks earliest deadline
    first in the slots left over. Ties of deadlines go to the first name, None first, then to the supertask. The work depends on ``parts`` alone.
    """
    named = sum(parts.values())
    period = named + rest
    if any(k < 1 for k in parts.values()) or rest < 0 or named > MAX_NAMED_PARTS:
        raise ValueError(f"weights must be whole parts of 1 or more, those of named sources at most {MAX_NAMED_PARTS} in total")
    names = sorted(parts, key=lambda s: (s is not None, s))
    waiting = [(0, rank, 0) for rank in range(len(names))]  # release, rank, block
    ready: list[tuple[int, int, int]] = []
    out: list[tuple] = []
    slot = 0
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            _, rank, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * period // parts[names[rank]]), rank, block))
        turn = slot
        if ready and rest:
            # The first slot whose supertask block has no earlier deadline than the first ready block, or is not released.
            later = len(out) + (ready[0][0] - 1) * rest // period
            unreleased = -(-(len(out) * period + rest) // named)
            turn = max(slot, min(later, unreleased))
        if waiting and (not ready or waiting[0][0] <= turn):
            slot = waiting[0][0]
            continue
        deadline, rank, block = heapq.heappop(ready)
        k = parts[names[rank]]
        out.append((names[rank], block, turn, block * period // k, deadline))
        if block + 1 < k:
            heapq.heappush(waiting, ((block + 1) * period // k, rank, block + 1))
        slot = turn + 1
    return out


def _longs(values: list[int]) -> Column:
    """A constant array, as one literal of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _not_above(ascending: list[int], x: Column) -> Column:
    """How many of the constants are at most ``x``, by bisection."""
    if not ascending:
        return F.lit(0)
    constants = _longs(ascending)
    steps = [1 << i for i in reversed(range(len(ascending).bit_length()))]
    return F.reduce(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, step: F.when(
        F.get(constants, low + step - 1) <= x, low + step).otherwise(low))


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _numbered(sources: DataFrame) -> DataFrame:
    """(source, place) for distinct sources, numbered from 0 by the md5 of their names.

    Sources are numbered inside cells of the first digits; one window runs over the counts of the cells, 4,096 at most.
    """
    key = F.md5(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    keyed = sources.select("source", key.alias("key")).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    cells = keyed.groupBy("cell").agg(F.count("*").alias("n")).select("cell", (
        F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("sooner"))
    inside = F.row_number().over(Window.partitionBy("cell").orderBy("key", "source")) - 1
    return keyed.withColumn("inside", inside).join(cells, "cell").select("source", (F.col("sooner") + F.col("inside")).alias("place"))


def mixed(docs: DataFrame, carry: Column, weights: dict[str, int], default: int = 1, block_chars: int = 65_536) -> tuple[DataFrame, int]:
    """(row, source, turn, tie, chars, block, slot, release, deadline) per row of ``docs`` (doc_id, text, source), and the last slot.

    Inside its source a document's place is the md5 of its doc_id; a block is ``block_chars`` characters
    of that stream, a document belongs to the block in which it begins. ``weights`` are parts per named source, ``MAX_NAMED_PARTS``
    in total; each source not named has ``default`` parts, and there may be any number of them; a null source is a source of its own,
    not named. Named sources without rows have no share. A null text has no characters. Rows of one
    doc_id stand together in the order of their text's md5; a null doc_id counts as ''. ``carry`` is kept as ``row``, other columns are
    ignored. Empty input gives an empty result and -1.
    """
    if default < 1:
        raise ValueError("the parts of a source that is not named must be 1 or more")
    turn = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    text = F.coalesce("text", F.lit(""))
    base = docs.select(carry.alias("row"), F.col("source"), turn.alias("turn"), F.length(text).cast("long").alias("chars"), F.md5(text).alias("tie"))
    rows, = docs.agg(F.count("*")).first()
    digits = max(1, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 16))) if rows > BUCKET_ROWS else 1
    # Hot sources: the stream is cut at the first digits of the md5, sums of the cuts go before.
    bucket = F.substring("turn", 1, digits)
    narrow = docs.select("source", turn.alias("turn"), F.length(text).cast("long").alias("chars"))
    sums = staged(narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("chars").alias("sum")), "volumes")
    sources = staged(sums.groupBy("source").agg(F.coalesce(F.sum("sum"), F.lit(0)).alias("volume"), F.coalesce(
        F.col("source").isin(list(weights)), F.lit(False)).alias("named")), "sources")
    # At most one row per weight, and one number, reach the driver.
    present = {r["source"]: weights[r["source"]] for r in sources.where("named").select("source").collect()}
    equals = sources.where("not named").count()
    rest = default * equals
    period = sum(present.values()) + rest
    table = schedule(present, rest)
    # The slots of a named source stand together in one array; its place is where they begin.
    by_name = sorted(table, key=lambda x: (x[0], x[1]))
    places = {}
    for at, (name, *_) in enumerate(by_name):
        places.setdefault(name, at)
    named = docs.sparkSession.createDataFrame([(s, places[s], k) for s, k in present.items()], "name string, place long, parts long")
    turns = sources.where("named").join(named, F.col("source") == F.col("name")).select("source", "place", "parts", F.lit(True).alias("named")).unionByName(
        _numbered(sources.where("not named")).select("source", F.col("place").cast("long"), F.lit(default).cast("long").alias("parts"), F.lit(False).alias("named")))
    turns = staged(turns.select(F.col("source").alias("s"), "place", "parts", "named"), "turns")

    block = F.col("block")
    slot_of_name = _div(block, F.col("parts")) * period + F.get(
        _longs([slot for _, _, slot, *_ in by_name] or [0]), (F.col("place") + block % F.col("parts")).cast("int"))
    nth = block * equals + F.col("place")
    inner = nth % max(rest, 1)
    slot_of_equal = _div(nth, max(rest, 1)) * period + inner + _not_above([slot - n for n, (_, _, slot, *_) in enumerate(table)], inner)
    slot = F.when(F.col("named"), slot_of_name).otherwise(slot_of_equal).cast("long")
    release = _div(block * period, F.col("parts"))
    deadline = _div((block + 1) * period + F.col("parts") - 1, F.col("parts"))

    ends = sources.drop("named").join(turns, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", _div(F.col("volume"), block_chars))
    last = ends.agg(F.max(slot)).first()[0]
    before = sums.select("source", F.col("bucket").alias("b"), (
        F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("sum")).alias("before"))
    before = before.join(turns, F.col("source").eqNullSafe(F.col("s"))).drop("source")
    inside = Window.partitionBy("source", "bucket").orderBy("turn", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = base.withColumn("bucket", bucket).withColumn("inside", F.sum("chars").over(inside) - F.col("chars"))
    begun = counted.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn(
        "block", F.floor((F.col("before") + F.col("inside")) / block_chars))
    return begun.select("row", "source", "turn", "tie", "chars", "block", slot.alias("slot"), release.alias("release"), deadline.alias("deadline")), (
        -1 if last is None else last)


def in_mixed_order(docs: DataFrame, columns: tuple[str, ...], weights: dict[str, int], default: int = 1, block_chars: int = 65_536) -> DataFrame:
    """``columns`` of all ``docs`` in the mixed order: partition by partition, and so file by file when written.

    Slots thin out as sources end, so files hold equal volumes and not equal numbers of slots: the characters of cells of slots are
    counted, cells grow in proportion to the slot, and inside a cell a file is a stretch of slots.
    """
    placed, last = mixed(docs, F.struct(*columns), weights, default, block_chars)
    edges = [0]
    while edges[-1] <= last:
        edges.append(edges[-1] + max(FILE_CHARS // block_chars, edges[-1] // CELLS_PER_E, 1))
    cell = _not_above(edges, F.col("slot")) - 1
    # One number per cell, some hundreds for any number of slots.
    sums = {r["cell"]: r["sum"] for r in placed.groupBy(cell.alias("cell")).agg(F.sum("chars").alias("sum")).collect()}
    volumes = [sums.get(i, 0) for i in range(len(edges))]
    before = [0, *itertools.accumulate(volumes)]
    files = max(1, -(-before[-1] // FILE_CHARS))
    of_cell = lambda values: F.get(_longs(values), F.col("cell"))
    width = [b - a for a, b in itertools.pairwise(edges)] + [1]
    reached = of_cell(before[:-1]) + of_cell(volumes) * ((F.col("slot") - of_cell(edges)) / of_cell(width))
    file = F.least(F.floor(reached / FILE_CHARS), F.lit(files - 1)).cast("int")
    return placed.withColumn("cell", cell).withColumn("file", file).repartitionById(files, F.col("file")).sortWithinPartitions(
        "slot", "turn", "tie").select(*[F.col(f"row.{c}").alias(c) for c in columns])
