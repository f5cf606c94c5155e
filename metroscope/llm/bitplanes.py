"""Token ids in bit planes: shards of fixed-size blocks, each plane of a block compressed by itself.

Documents are ordered by doc_id, encoded and laid end to end; a shard is a range of doc_ids. Each block holds
``block_ids`` ids of its shard (the last fewer). Its ids are transposed: plane p holds bit p of every id, packed eight to a
byte; high planes are mostly zeros or runs and compress to almost nothing. A plane that no id of the block
needs is left out. The block's row is its chunk index: the compressed size of each plane, how many ids it
holds, which documents begin in it, where, and how long they are. So any document is found by its block
and read without the others. Blocks are rows of Parquet, which reaches any store that Spark writes to.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import staged
from .tokens import encoder

BLOCK_IDS = 1 << 16
SHARD_CHARS = 16 << 20
SCHEMA = ("shard int, block int, n_ids int, planes array<int>, payload binary, lead int, lead_rank long, first_rank long, "
          "doc_id array<long>, at array<int>, n_tokens array<long>")


def shuffled(ids: np.ndarray, level: int = 3) -> tuple[list[int], bytes]:
    """(compressed size of each plane, the planes one after another) of unsigned 32-bit ids."""
    packer = zstandard.ZstdCompressor(level=level)
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    columns = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    planes = []
    for byte in range((bits + 7) // 8):
        lanes = np.unpackbits(columns[byte].reshape(-1, 1), axis=1, bitorder="little").T
        planes += [packer.compress(np.packbits(lane).tobytes()) for lane in lanes[: bits - 8 * byte]]
    return [len(p) for p in planes], b"".join(planes)


def restored(n: int, sizes: list[int], payload: bytes) -> np.ndarray:
    """The ids of one block."""
    reader = zstandard.ZstdDecompressor()
    out = np.zeros((4, n), dtype=np.uint8)
    at = 0
    for plane, size in enumerate(sizes):
        bits = np.unpackbits(np.frombuffer(reader.decompress(payload[at : at + size], max_output_size=(n + 7) // 8), dtype=np.uint8), count=n)
        out[plane // 8] |= bits << np.uint8(plane % 8)
        at += size
    return np.ascontiguousarray(out.T).view("<u4").reshape(-1)


def write_blocks(docs: DataFrame, path: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text), written to the shared folder and read back as a table.

    A null text is empty and has its end id only; a null doc_id comes first; rows of one doc_id stand together, in the order of a hash of their text. Other columns are ignored.
    """
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(max(1, -(-chars // SHARD_CHARS)), "doc_id").sortWithinPartitions(
        "doc_id", F.xxhash64("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encode = encoder(path).ids
        held = bytearray()
        block = rank = 0
        lead, lead_rank, index = 0, -1, []  # ids at the block's start that belong to an earlier document; documents begun in it

        def blocks(last: bool):
            nonlocal block, lead, lead_rank, index
            while len(held) >= 4 * block_ids or (last and held):
                ids = np.frombuffer(bytes(held[: 4 * block_ids]), dtype="<u4")
                del held[: 4 * block_ids]
                here = [d for d in index if d[1] < len(ids)]
                sizes, payload = shuffled(ids)
                yield pa.RecordBatch.from_pylist([{
                    "shard": shard, "block": block, "n_ids": len(ids), "planes": sizes, "payload": payload, "lead": min(lead, len(ids)), "lead_rank": lead_rank,
                    "first_rank": here[0][3] if here else -1, "doc_id": [d[0] for d in here], "at": [d[1] for d in here], "n_tokens": [d[2] for d in here]}], schema=ARROW)
                block += 1
                if here:
                    _, at, n, lead_rank = here[-1]
                    lead = max(0, at + n - len(ids))
                else:
                    lead -= min(lead, len(ids))
                index = [(d, at - len(ids), n, r) for d, at, n, r in index[len(here):]]

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                index.append((name, len(held) // 4, len(ids) // 4, rank))
                rank += 1
                held += ids
                yield from blocks(False)
        yield from blocks(True)

    return staged(ordered.mapInArrow(run, SCHEMA), "id-blocks")


ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.int32())), ("payload", pa.binary()), ("lead", pa.int32()),
    ("lead_rank", pa.int64()), ("first_rank", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("n_tokens", pa.list_(pa.int64()))])


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the blocks with its ids (little-endian unsigned 32-bit bytes); start counts all ids before it.

    Documents inside one block come straight from it; the parts of the others meet by document.
    """
    return _pieces(blocks, lambda ids: ids, "binary", lambda ids: ids)


def read_digests(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the decoded ids."""
    return _pieces(blocks, zlib.crc32, "long", F.crc32).withColumnRenamed("ids", "ids_crc32")


def _pieces(blocks: DataFrame, value, kind: str, joined) -> DataFrame:
    arrow = pa.binary() if kind == "binary" else pa.int64()
    schema = f"shard int, rank long, part int, doc_id long, at long, n_tokens long, ids {kind}, bytes binary"

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = restored(row["n_ids"], row["planes"], row["payload"]).tobytes()
                if row["lead"]:
                    out.append((row["shard"], row["lead_rank"], row["block"], None, None, None, None, ids[: 4 * row["lead"]]))
                for k, (doc, at, n) in enumerate(zip(row["doc_id"], row["at"], row["n_tokens"])):
                    own, place = ids[4 * at : 4 * (at + n)], (row["shard"], row["first_rank"] + k, row["block"], doc, at, n)
                    out.append((*place, value(own), None) if len(own) == 4 * n else (*place, None, own))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), arrow, pa.binary()]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["shard", "rank", "part", "doc_id", "at", "n_tokens", "ids", "bytes"])

    # Positions from the index alone: a narrow window over a shard's blocks, and one over the shards' totals.
    starts = blocks.select(F.col("shard").alias("s"), F.col("block").alias("b"), "n_ids").withColumn(
        "block_start", F.coalesce(F.sum("n_ids").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n_ids")
    totals = blocks.groupBy(F.col("shard").alias("t")).agg(F.sum("n_ids").alias("total"))
    bases = totals.withColumn("base", F.coalesce(F.sum("total").over(Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("total")
    # Blocks are decoded where they lie; positions join the narrow pieces.
    found = staged(blocks.mapInArrow(run, schema), "id-pieces")
    complete = found.where("bytes is null").select("shard", "part", "doc_id", "at", "n_tokens", "ids")
    # The first part of a document cut by block ends has its number and place.
    parts = found.where("bytes is not null").groupBy("shard", "rank").agg(
        F.max("doc_id").alias("doc_id"), F.max("at").alias("at"), F.max("n_tokens").alias("n_tokens"), F.min("part").alias("part"),
        F.sort_array(F.collect_list(F.struct("part", "bytes"))).alias("pieces"))
    whole = F.aggregate("pieces", F.lit("").cast("binary"), lambda ids, piece: F.concat(ids, piece["bytes"]))
    cut = parts.select("shard", "part", "doc_id", "at", "n_tokens", joined(whole).alias("ids"))
    placed = complete.unionByName(cut).join(starts, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("b"))).join(bases, F.col("shard") == F.col("t"))
    return placed.select("doc_id", (F.col("base") + F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids")
