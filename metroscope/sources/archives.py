"""From raw files to string tables: ZIP members, encodings, separators, headers.

Bytes become decoded lines inside ``mapInArrow`` (Spark's own readers know neither ZIP members
nor cp1252); from there on everything is a Spark expression. A member is streamed, never held
whole, and leaves its task as chunk rows of about a megabyte, so one huge member spreads over
the cluster after the next shuffle or after ``stage``.
"""

from __future__ import annotations

import codecs
import csv
import gzip
import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import canonical_name, plain_name
from ..session import scratch_folder

# Member and archive names as published, and the encodings tried in turn.
MEMBER_PATTERN = r"(?i)([0-9]{4})\s*_?\s*([ST][0-9])\s*_\s*(NB|PROFIL)\s*_\s*(FER|SURFACE)\s*\.(?:txt|csv)$"
YEAR_ARCHIVE_PATTERN = r"(?i)opendata_txt_([0-9]{4})\.zip$"
ACCIDENT_TABLE_PATTERNS = (
    ("caracteristiques", r"(?i)^car[^-_]*[-_]?([0-9]{4})"),
    ("lieux", r"(?i)^lieux[-_]?([0-9]{4})"),
    ("usagers", r"(?i)^usagers[-_]?([0-9]{4})"),
    ("vehicules", r"(?i)^vehicules[-_]?([0-9]{4})"),
)
EIGHT_BIT_ENCODINGS = ("utf-8", "cp1252", "latin-1")
WIDE_MARKS = (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)

CHUNK_SCHEMA = "path string, member string, header string, chunk int, lines array<string>"
_CHUNK_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("member", pa.string()),
        ("header", pa.string()),
        ("chunk", pa.int32()),
        ("lines", pa.list_(pa.string())),
    ]
)
CHUNK_CHARS = 1 << 20

Opener = Callable[[], io.BufferedIOBase]


# -- raw files ----------------------------------------------------------------------------

def raw_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files with their bytes: (path, modificationTime, length, content)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def index_archive(files: DataFrame) -> DataFrame:
    """Size and content digest of every raw file."""
    return files.select(
        "path", F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


# -- encodings ----------------------------------------------------------------------------

def pick_encoding(open_bytes: Opener) -> str:
    """Byte-order marks first, then NULs as a sign of wide characters, then 8-bit encodings.

    One pass over the whole member tests all candidates. latin-1 accepts anything, so it can only
    come last.
    """
    with open_bytes() as stream:
        block = stream.read(1 << 20)
        if block[:2] in WIDE_MARKS:
            return "utf-16"
        marked = block.startswith(codecs.BOM_UTF8)
        open_decoders = {e: codecs.getincrementaldecoder(e)() for e in ("utf-8", "cp1252", "utf-16-le", "utf-16-be")}
        nuls, at = [0, 0], 0
        while True:
            last = not block
            if b"\0" in block:
                even = block[at % 2 :: 2].count(b"\0")
                nuls[0] += even
                nuls[1] += block.count(b"\0") - even
            for encoding, decoder in list(open_decoders.items()):
                try:
                    decoder.decode(block, final=last)
                except UnicodeDecodeError:
                    del open_decoders[encoding]
            at += len(block)
            if last:
                break
            block = stream.read(1 << 20)
    if any(nuls):
        # The high byte of most wide characters is zero: second in little-endian text, first in big-endian.
        wide = "utf-16-le" if nuls[1] >= nuls[0] else "utf-16-be"
        if wide in open_decoders:
            return wide
    if marked and "utf-8" in open_decoders:
        return "utf-8-sig"
    return next((e for e in EIGHT_BIT_ENCODINGS if e in open_decoders), "latin-1")


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            raw = content.as_py()
            encoding = pick_encoding(lambda: io.BytesIO(raw))
            row = {"path": [path.as_py()], "encoding": [encoding], "text": [raw.decode(encoding)]}
            yield pa.RecordBatch.from_pydict(row)


def decode_member(files: DataFrame) -> DataFrame:
    """The whole text of each (small) file: (path, encoding, text). Large files: ``expand_archive``."""
    return files.select("path", "content").mapInArrow(_decode_batches, "path string, encoding string, text string")


# -- members and lines --------------------------------------------------------------------

def widest_separator(header: str) -> str:
    """The most frequent of ``; , TAB |`` outside a header line's quoted cells; the first of them among equals."""
    bare = re.sub(r'"(?:[^"]|"")*"', "", header)
    return max((";", ",", "\t", "|"), key=bare.count)


def _ends_open(line: str, separator: str, is_open: bool) -> bool:
    """Whether a quoted cell is open at the end of a line, given whether one is at its beginning.

    A quote opens a cell only at its beginning; inside, two quotes are one character.
    """
    at = 0
    if not is_open:
        if line.startswith('"'):
            is_open, at = True, 1
    while True:
        if is_open:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            is_open, at = False, at + 1
        at = line.find(separator + '"', at)
        if at < 0:
            return False
        is_open, at = True, at + len(separator) + 1


def _records(text: Iterable[str], separator: str | None = None) -> Iterator[str]:
    """Lines, joined where a quoted cell runs over the line end; blank lines are dropped.

    The separator is the first line's own unless given. A quote that nothing closes before the end is a
    character: its line stands alone and the lines after it are read again.
    """
    queue, lines = [], iter(text)
    pending: list[str] = []
    is_open = False
    while True:
        line = queue.pop() if queue else next(lines, None)
        if line is None:
            if not pending:
                return
            first, *rest = pending
            queue = rest[::-1]
            pending, is_open = [], False
            if first := first.rstrip("\r\n"):
                yield first
            continue
        if separator is None:
            separator = widest_separator(line)
        if not is_open and '"' not in line:
            if record := line.rstrip("\r\n"):
                yield record
            continue
        is_open = _ends_open(line, separator, is_open)
        pending.append(line)
        if not is_open:
            record = "".join(pending).rstrip("\r\n")
            pending = []
            if record:
                yield record


def _chunk(path: str, member: str, header: str | None, number: int, lines: list[str]) -> pa.RecordBatch:
    columns = {"path": [path], "member": [member], "header": [header], "chunk": [number], "lines": [lines]}
    return pa.RecordBatch.from_pydict(columns, schema=_CHUNK_ARROW)


def _member_chunks(
    path: str, member: str, open_bytes: Opener, encoding: str | None, separator: str | None = None, header_only: bool = False
) -> Iterator[pa.RecordBatch]:
    chosen, errors = (encoding, "replace") if encoding else (pick_encoding(open_bytes), "strict")
    with open_bytes() as stream:
        records = _records(io.TextIOWrapper(stream, encoding=chosen, errors=errors, newline="\n"), separator)
        header = next(records, None)
        if header_only:
            yield _chunk(path, member, header, 0, [])
            return
        number, size, lines = 0, 0, []
        for record in records:
            lines.append(record)
            size += len(record)
            if size >= CHUNK_CHARS:
                yield _chunk(path, member, header, number, lines)
                number, size, lines = number + 1, 0, []
        if lines or number == 0:
            yield _chunk(path, member, header, number, lines)


#: What a damaged or unsupported archive or member raises: broken structure, checksums, compression methods, passwords.
UNREADABLE = (zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError, UnicodeDecodeError)
UNREADABLE_CHUNK = -1


def _expander(encoding: str | None, wanted: str | None, separator: str | None = None, header_only: bool = False, tolerant: bool = False):
    pattern = re.compile(wanted) if wanted else None

    def guarded(path: str, name: str, chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What can be read, and a row that tells why the rest cannot."""
        try:
            yield from chunks
        except UNREADABLE as error:
            if not tolerant:
                raise
            yield _chunk(path, name, None, UNREADABLE_CHUNK, [f"{type(error).__name__}: {error}"])

    def members(path: str, buffer: pa.Buffer) -> Iterator[pa.RecordBatch]:
        with zipfile.ZipFile(pa.BufferReader(buffer)) as archive:
            for info in archive.infolist():
                if info.is_dir():
                    continue
                name = info.filename.rsplit("/", 1)[-1]
                if pattern is None and not name.lower().endswith(".zip") or pattern and pattern.search(name):
                    yield from guarded(path, name, _member_chunks(path, name, lambda: archive.open(info), encoding, separator, header_only))
                else:
                    yield _chunk(path, name, None, 0, [])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_cell, content in zip(batch.column("path"), batch.column("content")):
                path, buffer = path_cell.as_py(), content.as_buffer()
                name = path.rsplit("/", 1)[-1]
                if path.lower().endswith(".zip"):
                    yield from guarded(path, name, members(path, buffer))
                    continue
                plain = lambda: pa.BufferReader(buffer)
                packed = lambda: gzip.GzipFile(fileobj=pa.BufferReader(buffer))
                yield from guarded(path, name, _member_chunks(path, name, packed if name.lower().endswith(".gz") else plain, encoding, separator, header_only))

    return expand


def expand_archive(files: DataFrame, wanted: str | None = None, encoding: str | None = None, tolerant: bool = False) -> DataFrame:
    """ZIP members (or plain files) as chunk rows: path, member, header, chunk, lines.

    Nested archives, and members ``wanted`` does not match, appear with a null header so that
    reports can name them; they are not opened. Directories are left out. ``encoding`` overrides
    the per-member choice and replaces undecodable bytes. A member that cannot be read ends the job; with ``tolerant`` it
    becomes a row of ``unreadable_members``, and so does an archive whose directory cannot be read.
    """
    return files.select("path", "content").mapInArrow(_expander(encoding, wanted, tolerant=tolerant), CHUNK_SCHEMA)


def unreadable_members(chunks: DataFrame) -> DataFrame:
    """(path, member, reason) of what a tolerant expansion could not read, or not to its end."""
    return chunks.where(F.col("chunk") == UNREADABLE_CHUNK).select("path", "member", F.get("lines", F.lit(0)).alias("reason"))


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back: expensive expansion is not repeated, and lineage is cut."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# -- separators and names -----------------------------------------------------------------

def _occurrences(header: Column, separator: str) -> Column:
    return F.length(header) - F.length(F.replace(header, F.lit(separator), F.lit("")))


def sniff_separator(header: Column) -> Column:
    """``;`` when the header has more of them than tabs, else a tab."""
    return F.when(_occurrences(header, ";") > _occurrences(header, "\t"), ";").otherwise("\t")


def sniff_widest_separator(header: Column) -> Column:
    """The most frequent of ``; , TAB |``; the first of them among equals."""
    candidates = (";", ",", "\t", "|")
    scored = [
        F.struct(_occurrences(header, s).alias("n"), F.lit(-i).alias("rank"), F.lit(s).alias("sep"))
        for i, s in enumerate(candidates)
    ]
    return F.array_max(F.array(*scored))["sep"]


def classify_members(members: DataFrame, expected_year: Column | None = None, name: str = "member") -> DataFrame:
    """File name -> year, period, kind, network; otherwise why the member is skipped."""
    part = lambda i: F.nullif(F.upper(F.regexp_extract(name, MEMBER_PATTERN, i)), F.lit(""))
    labels = dict(zip(("year", "period", "kind", "network"), map(part, (1, 2, 3, 4))))
    status = F.when(F.lower(name).endswith(".zip"), "nested archive").when(labels["year"].isNull(), "unrecognised")
    if expected_year is not None:
        status = status.when(labels["year"] != expected_year, "wrong year")
    return members.withColumns({**labels, "status": status.otherwise("ok")})


def classify_yearly_tables(files: DataFrame, name: str = "name") -> DataFrame:
    """File name -> (table, year), tolerant of misspelt prefixes; null when not a CSV of these tables."""
    stem = F.regexp_extract(name, r"(?i)^(.*)\.csv$", 1)
    years = [(t, F.nullif(F.regexp_extract(stem, p, 1), F.lit(""))) for t, p in ACCIDENT_TABLE_PATTERNS]
    table = F.coalesce(*[F.when(y.isNotNull(), F.lit(t)) for t, y in years])
    return files.withColumns({"table": table, "year": F.coalesce(*[y for _, y in years])})


def classify_year_archives(files: DataFrame, name: str = "name") -> DataFrame:
    return files.withColumn("year", F.nullif(F.regexp_extract(name, YEAR_ARCHIVE_PATTERN, 1), F.lit("")))


# -- chunk rows to string columns ---------------------------------------------------------

def _header_cells(header: str, separator: str, rule: Callable[[str], str]) -> list[str]:
    names = [rule(c) for c in next(csv.reader([header], delimiter=separator))]
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise ValueError(f"header names {sorted(repeated)} twice: {header!r}")
    return names


def header_shapes(chunks: DataFrame, separator: Callable[[Column], Column] | str, rule=canonical_name) -> list[tuple[str, str, list[str]]]:
    """The distinct headers with their separator and cell names.

    Reads the header column only: one row per layout reaches the driver. A layout that lacks what
    the feed needs is refused by the gate on required columns.
    """
    sep = F.lit(separator) if isinstance(separator, str) else separator(F.col("header"))
    found = chunks.where(F.col("header").isNotNull()).select(sep.alias("sep"), "header").distinct().collect()
    return [(r.sep, r.header, _header_cells(r.header, r.sep, rule)) for r in sorted(found)]


def _case(branches: Iterable[tuple[Column, Column]]) -> Column:
    """A CASE over (condition, value) pairs; null when none holds."""
    branches = list(branches)
    out = F.when(*branches[0])
    for condition, value in branches[1:]:
        out = out.when(condition, value)
    return out


def parse_members(
    chunks: DataFrame,
    separator: Callable[[Column], Column] | str = sniff_separator,
    rule: Callable[[str], str] = canonical_name,
    carry: Sequence[str] = ("path", "member"),
    shapes: list[tuple[str, str, list[str]]] | None = None,
) -> DataFrame:
    """All members as one string table under canonical names, whatever their layouts.

    One pass for every layout: each line goes through ``from_csv`` with its chunk's own
    separator into positional cells, and a cell gets its name from the layout number. Short
    rows are null-filled, long rows truncated, names missing in a layout null. ``shapes`` are the
    chunks' ``header_shapes`` when the caller has them already.
    """
    shapes = shapes if shapes is not None else header_shapes(chunks, separator, rule)
    if not shapes:
        return chunks.select(*carry).limit(0)
    width = max(len(names) for *_, names in shapes)
    cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])

    def record(sep: str) -> Column:
        # A one-element array under ``inline``: the generator parses each line once, while plain
        # field access on ``from_csv`` would parse it again for every column.
        return F.array(F.from_csv("_line", cells.simpleString(), {"sep": sep, "escape": '"'}))

    layout = _case((F.col("header") == header, F.lit(i)) for i, (_, header, _) in enumerate(shapes))
    sep_of = _case((F.col("_shape") == i, F.lit(sep)) for i, (sep, *_) in enumerate(shapes))
    parsed = _case((F.col("_sep") == sep, record(sep)) for sep in sorted({sep for sep, *_ in shapes}))
    rows = (
        chunks.where(F.col("header").isNotNull())
        .withColumn("_shape", layout)
        .withColumn("_sep", sep_of)
        .select(*carry, "_shape", "_sep", F.explode("lines").alias("_line"))
        .select(*carry, "_shape", F.inline(parsed))
    )

    names = list(dict.fromkeys(n for *_, ns in shapes for n in ns if n not in carry))

    def cell(name: str) -> Column:
        places: dict[int, list[int]] = {}
        for i, (*_, ns) in enumerate(shapes):
            if name in ns:
                places.setdefault(ns.index(name), []).append(i)
        if len(places) == 1 and sum(map(len, places.values())) == len(shapes):
            return F.col(f"_c{next(iter(places))}").alias(name)
        return _case((F.col("_shape").isin(of), F.col(f"_c{place}")) for place, of in places.items()).alias(name)

    return rows.select(*carry, *[cell(n) for n in names])


# -- plain readers ------------------------------------------------------------------------

def ends_open(line: Column, separator: str) -> Column:
    """Whether a quoted cell is open at the end of a line that begins outside of one (``_ends_open`` as one expression)."""
    opening = rf'\Q{separator}\E"'
    plain = rf"(?:(?!{opening})[\s\S])*+{opening}"
    quoted = r'(?:[^"]++|"")*+'
    return F.when(F.contains(line, F.lit('"')), line.rlike(rf'\A(?:"|(?!"){plain})(?:{quoted}"{plain})*+{quoted}\z')).otherwise(False)


def _whole_file_chunks(spark: SparkSession, paths: list[str], sep: str, encoding: str, header_only: bool) -> DataFrame:
    # Paths come from a listing: characters that stand for patterns are themselves.
    escaped = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]
    return raw_files(spark, escaped).select("path", "content").mapInArrow(_expander(encoding, None, sep, header_only=header_only), CHUNK_SCHEMA)


def read_delimited_text(spark: SparkSession, path, sep: str = ";", encoding: str = "utf-8-sig", file_col: str | None = None) -> DataFrame:
    """Header CSV (plain or gzip) with every column as text, each file under its own header.

    Columns may come in another order or be missing from file to file; quoted cells may hold line breaks. A first
    pass finds each file's header and whether a line ends inside a quoted cell. Files without such lines are read
    line by line, so that a large one is many tasks; those that have them, ZIP archives and encodings other than UTF-8 are
    read whole, one task each, up to Spark's 2 GB for one cell. The paths of the latter reach the driver. Empty files give no rows.
    ``file_col`` adds the path of each row's file, for feeds that label rows by file name.
    """
    by_line = None
    if encoding.lower() in ("utf-8", "utf-8-sig"):
        text = spark.read.text(path, lineSep="\n", recursiveFileLookup=True)
        # Both passes read the same splits, so a line has the same number in each.
        lines = text.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("number"),
            F.make_valid_utf8(F.rtrim("value", F.lit("\r"))).alias("line")).where("line <> ''")
        # collect_set makes this a hash aggregate of objects; with min alone, Spark would sort all lines by path.
        heads = lines.groupBy("path").agg(
            F.min(F.struct("start", "number", "line")).alias("head"), F.collect_set(ends_open(F.ltrim("line", F.lit("\ufeff")), sep)).alias("open"))
        # The metadata column holds an encoded path, listings a plain one.
        file = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
        heads = stage(heads.select("path", file.alias("file"), F.col("head.number").alias("first"), F.regexp_replace("head.line", "^\ufeff", "").alias("header"),
                                   F.array_contains("open", True).alias("open")), scratch_folder(spark, "heads"))
        archive = F.lower("file").endswith(".zip")
        by_line = heads.where(~F.col("open") & ~archive)
        taken = [r.file for r in heads.where(F.col("open") | archive).select("file").collect()]
    else:
        taken = [r.path for r in raw_files(spark, path).select("path").collect()]
    parts, headers = [], []
    if by_line is not None:
        headers.append(by_line.select("header"))
        parts.append(lines.join(by_line.select("path", "file", "first", "header"), "path").where("number <> first").select(F.col("file").alias("path"), "header", F.array("line").alias("lines")))
    if taken:
        headers.append(_whole_file_chunks(spark, taken, sep, encoding, True).select("header"))
        parts.append(_whole_file_chunks(spark, taken, sep, encoding, False).select("path", "header", "lines"))
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    rows = parse_members(union(parts), sep, plain_name, ("path",), header_shapes(union(headers), sep, plain_name))
    return rows.withColumnRenamed("path", file_col) if file_col else rows.drop("path")


def read_gzip_csv(spark: SparkSession, path, sep: str = ";", partitions: int | None = None, file_col: str | None = None) -> DataFrame:
    """Gzip CSV. A gzip file is one task, so spread the rows before heavy work."""
    df = read_delimited_text(spark, path, sep, file_col=file_col)
    return df.repartition(partitions) if partitions else df


def _variant_field(root: str, path: str, kind: T.DataType) -> Column:
    """A field of a JSON value under a type; null when absent or of another type."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_variant_field(root, f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind])
    return F.try_variant_get(root, path, kind.simpleString())


def json_elements(text: Column) -> Column:
    """The elements of a JSON array as variants; null when the text is not an array.

    Parsed once, in time linear in the text. ``from_json`` on a long array searches the text
    from its start for every number read as text.
    """
    return F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")


def read_json_payloads(spark: SparkSession, path, file_col: str = "file") -> DataFrame:
    """Whole JSON bodies with the path of their file: (file, payload). One poll is one file."""
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return text.select(F.col("_metadata.file_path").alias(file_col), F.col("value").alias("payload"))


def read_json_records(
    spark: SparkSession, path, schema: T.StructType | str, array_per_line: bool = False, file_col: str | None = None
) -> DataFrame:
    """Arrays of records under a fixed schema; absent keys are null, unreadable text is an error.

    A file is one array (a poll or a paged reference, megabytes); ``array_per_line`` reads files
    with an array on every line, which Spark can split. ``file_col`` adds the file's path.
    """
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = spark.read.text(path, wholetext=not array_per_line, recursiveFileLookup=True)
    unreadable = F.raise_error(F.concat(F.lit("not an array of records: "), F.substring("value", 1, 100)))
    origin = [F.col("_metadata.file_path").alias(file_col)] if file_col else []
    records = text.select(*origin, F.explode(F.coalesce(json_elements(F.col("value")), unreadable)).alias("_r"))
    kept = [file_col] if file_col else []
    return records.select(*kept, *[_variant_field("_r", f"$.{f.name}", f.dataType).alias(f.name) for f in record])
