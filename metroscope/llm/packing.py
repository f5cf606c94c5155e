"""Hierarchical packing of documents into sequences of several context sizes.

Every input partition is packed by itself, in chunks of a bounded number of tokens, so nothing is
shuffled. In a chunk:

1. Whole windows of the longest size are cut from longer documents; what remains of each document is routed to
   the shortest tier (window size) that holds it.
2. Each piece of the longest tier opens a window; its gap is filled with the largest whole pieces of
   the shorter tiers that fit, and closed by cutting one short piece.
3. The middle tiers do the same with what the tiers below them still hold.
4. What is left is joined end to end and cut into windows, the last of them into the tiers it fills
   exactly; one sequence per chunk may stay open and is padded by the reader.
5. Sequences are dealt to step groups tier by tier, so that the groups of a chunk hold equal numbers of
   each tier, give or take one, and nearly equal numbers of tokens.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

TIERS = (256, 512, 1024)
CHUNK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 15
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "window int, step_id long")


class _Shelf:
    """Pieces (document, start, length) by length; the largest that fits is found by one bit operation."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.mask = 0

    def put(self, doc: int, start: int, length: int) -> None:
        self.by_length.setdefault(length, []).append((doc, start, length))
        self.mask |= 1 << length

    def take(self, at_most: int):
        fits = self.mask & ((1 << (at_most + 1)) - 1)
        if not fits:
            return None
        length = fits.bit_length() - 1
        piece = self.by_length[length].pop()
        if not self.by_length[length]:
            self.mask ^= 1 << length
        return piece

    def largest(self):
        return self.take(self.mask.bit_length() - 1) if self.mask else None


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list]]:
    """Sequences (window, [(document, start, length), ...]) that hold every token of documents of these lengths once."""
    top = tiers[-1]
    shelves = [_Shelf() for _ in tiers]
    done: list[tuple[int, list]] = []

    def route(doc: int, start: int, length: int) -> None:
        shelves[next(k for k, size in enumerate(tiers) if length <= size)].put(doc, start, length)

    for doc, n in enumerate(lengths):
        full = n // top * top
        done += [(top, [(doc, at, top)]) for at in range(0, full, top)]
        if n > full:
            route(doc, full, n - full)
    loose: list[tuple[int, int, int]] = []
    for k in range(len(tiers) - 1, -1, -1):
        while (piece := shelves[k].largest()) is not None:
            window, gap = [piece], tiers[k] - piece[2]
            while gap:
                found = next((f for shelf in shelves[k::-1] if (f := shelf.take(gap)) is not None), None)
                if found is None:
                    # Nothing fits whole: cut a piece of the shortest tier that has one.
                    longer = next((f for shelf in shelves[: k + 1] if (f := shelf.largest()) is not None), None)
                    if longer is None:
                        break
                    doc, start, length = longer
                    found = (doc, start, gap)
                    route(doc, start + gap, length - gap)
                window.append(found)
                gap -= found[2]
            if gap:
                loose += window
            else:
                done.append((tiers[k], window))
    return done + _joined(loose, tiers)


def _joined(pieces: list, tiers: tuple[int, ...]) -> list[tuple[int, list]]:
    left = sum(p[2] for p in pieces)
    out, queue = [], list(reversed(pieces))
    while left:
        size = next((s for s in reversed(tiers) if s <= left), tiers[-1])
        window, gap = [], size
        while gap and queue:
            doc, start, length = queue.pop()
            part = min(gap, length)
            window.append((doc, start, part))
            gap, left = gap - part, left - part
            if part < length:
                queue.append((doc, start + part, length - part))
        out.append((size, window))
    return out


def deal(sequences: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """The step group of each sequence: dealt round, longest windows first, each tier where the one before ended."""
    steps = max(1, round(sum(w for w, _ in sequences) / step_tokens))
    order = sorted(range(len(sequences)), key=lambda i: -sequences[i][0])
    out = [0] * len(sequences)
    for turn, i in enumerate(order):
        out[i] = turn % steps
    return out


def packed(docs: DataFrame, path: str, end_id: int = 0, tiers: tuple[int, ...] = TIERS,
           chunk_tokens: int = CHUNK_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it comes from, which sequence holds it and where.

    Ids are those of the vocabulary at ``path``, with ``end_id`` after each document; a null text is empty.
    ``window`` is the tier of the sequence. sequence_id and step_id count up within an input partition, whose number is in the high
    bits: they are unique, and stay the same when a lost task is run again on the same input. Rows are packed one by one, so
    repeated rows give repeated pieces and a null doc_id is kept; other columns are ignored.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        encode = encoder(path).ids
        sequence = step = base
        names: list = []
        held: list[bytes] = []
        tokens = 0

        def flush():
            nonlocal sequence, step
            lengths = [len(h) // 4 for h in held]
            sequences = pack(lengths, tiers)
            groups = deal(sequences, step_tokens)
            rows = []
            for (window, pieces), group in zip(sequences, groups):
                offset = 0
                for doc, start, length in pieces:
                    rows.append((names[doc], start, length, zlib.crc32(memoryview(held[doc])[4 * start : 4 * (start + length)]), lengths[doc], sequence, offset, window, step + group))
                    offset += length
                sequence += 1
            step += max(groups, default=-1) + 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                held.append(encode(text) + end)
                tokens += len(held[-1]) // 4
                if tokens >= chunk_tokens:
                    yield flush()
                    names, held, tokens = [], [], 0
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
