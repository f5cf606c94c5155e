"""Raw files in the published formats, written from the benchmark tables by Spark.

ZIP archives and encoded files are packed batch by batch: one blob holds at most one Arrow
batch of rows, so no group of rows is ever gathered.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOB = "path string, content binary"


def _groups(batch: pa.RecordBatch, keys: tuple[str, ...]) -> Iterator[tuple[tuple, str]]:
    """Each key with its lines as one text, both in the order of the batch; no row becomes a Python object."""
    if not batch.num_rows:
        return
    group = np.zeros(batch.num_rows, dtype=np.int64)
    for key in keys:
        cells = batch.column(key).dictionary_encode(null_encoding="encode")
        # Numbered anew after every key, so that the numbers stay below the rows of the batch.
        _, first, group = np.unique(group * len(cells.dictionary) + cells.indices.to_numpy(), return_index=True, return_inverse=True)
    ends = np.concatenate(([0], np.cumsum(np.bincount(group)))).astype(np.int32)
    lines = batch.column("line").take(pa.array(np.argsort(group, kind="stable")))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), lines), "\n")
    turns = pa.array(np.argsort(first))
    heads = [batch.column(k).take(pa.array(first)).take(turns).to_pylist() for k in keys]
    for *key, text in zip(*heads, texts.take(turns)):
        yield tuple(key), text.as_py()


def _encoded(header: str, lines: str, encoding: str) -> bytes:
    return "\n".join([header, lines, ""]).encode(encoding)


def _blobs(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    paths, contents = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        archives: dict[str, list] = {}
        for (path, member, header, encoding), lines in _groups(batch, ("path", "member", "header", "encoding")):
            archives.setdefault(path, []).append((member, _encoded(header, lines, encoding)))
        for path, members in archives.items():
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
                z.writestr("folder/", b"")
                z.writestr("older-archive.zip", b"PK")
                for member, data in members:
                    z.writestr(f"folder/{member}", data)
            yield _blobs([(path, buffer.getvalue())])


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (path, header, encoding), lines in _groups(batch, ("path", "header", "encoding")):
            yield _blobs([(path, _encoded(header, lines, encoding))])


def zip_archives(lines: DataFrame) -> DataFrame:
    """(path, member, header, encoding, line) -> ZIP blobs, each with a nested archive and a folder."""
    return lines.select("path", "member", "header", "encoding", "line").mapInArrow(_zip, BLOB)


def text_files(lines: DataFrame) -> DataFrame:
    """(path, header, encoding, line) -> encoded text blobs."""
    return lines.select("path", "header", "encoding", "line").mapInArrow(_files, BLOB)


def delimited(sep: Column | str, *cells: Column) -> Column:
    """Cells joined by a separator that may differ from row to row; a null cell is empty."""
    sep = F.lit(sep) if isinstance(sep, str) else sep
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in cells]
    joined = texts[0]
    for text in texts[1:]:
        joined = F.concat(joined, sep, text)
    return joined


def _value_batch(values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"value": pa.array(values, pa.string())})


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """Put the header first in every file that will be written."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _value_batch([header])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

    return lines.mapInArrow(emit, "value string")


def as_json_arrays(records: DataFrame) -> DataFrame:
    """One line per Arrow batch of records: a JSON array."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _value_batch(["[" + ",".join(batch.column(0).to_pylist()) + "]"])

    return records.select(F.to_json(F.struct(*records.columns)).alias("value")).mapInArrow(emit, "value string")


def write_text(lines: DataFrame, path: str, compression: str = "none") -> str:
    lines.write.option("compression", compression).text(path)
    return path
