"""CSV reading with the reference file format.

Format: header row, ``,`` delimiter, optional ``"`` enclosure with ``""`` as
the escaped quote, blanks around unquoted fields trimmed, and the tokens
``NULL``, ``null`` and the empty field (quoted or not) read as NULL.

Everything is read as text first; types come from :mod:`eventmart.sources.inference`
or from a target schema (:func:`bind_by_name`).  ``multi_line=True`` is for files with
newlines inside quotes; large files are split either way.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.sources.records import ends_inside, quoted_records, raw_lines

# Text read as NULL (after trimming).
NULL_TOKENS = ("NULL", "null", "")

READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "inferSchema": "false",
    "mode": "FAILFAST",
}

WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    # The writer trims by default; keep values as they are.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def plain_path(path: Column) -> Column:
    """A path as it is written: ``_metadata.file_path`` is URL-encoded, readers are not."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


#: Bytes of a file that are read for its header; more only where the header is longer.
HEAD_BYTES = 1 << 16


def first_record(data: bytes, multi_line: bool, complete: bool) -> bytes | None:
    """The first record of a file's first bytes, as Spark's reader finds its header: blank
    lines are skipped, and with ``multi_line`` a quoted field may hold line breaks.

    None if the bytes end before the record does (``complete``: they are the whole file),
    or hold none.
    """
    data = data.removeprefix(b"\xef\xbb\xbf")
    lines = data.split(b"\n") if multi_line else re.split(rb"\r\n|\n|\r", data)
    got: list[bytes] = []
    inside = False
    for i, line in enumerate(lines):
        if not got and not line.strip(b" \t\r"):
            continue
        got.append(line)
        inside = multi_line and ends_inside(line, inside)
        if not inside:
            return b"\n".join(got).rstrip(b"\r") if complete or i + 1 < len(lines) else None
    return b"\n".join(got) if got and complete else None


def _open(path: str):
    """A file of a listing, opened in a task; a compressed one (by its name) is unpacked."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + (rest if colon else path).lstrip("/"))
    store, inner = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{quote(rest)}")
    return store.open_input_stream(inner)


def file_headers(listing: DataFrame, multi_line: bool) -> DataFrame:
    """file, header, reached: the first record of each file of a listing (path).

    A task reads a file's first block only.  ``reached`` is false for a file in a store
    that Python has no way into.
    """
    def run(batches):
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                try:
                    with _open(path) as stream:
                        data, more = b"", HEAD_BYTES
                        while True:
                            block = stream.read(more)
                            data += block
                            header = first_record(data, multi_line, complete=not block)
                            if header is not None or not block:
                                break
                            more = len(data)
                    out.append((path, header, True))
                except (OSError, ValueError, NotImplementedError, ImportError):
                    out.append((path, None, False))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.bool_()), strict=True)],
                names=["file", "header", "reached"])

    return listing.select("path").mapInArrow(run, "file string, header binary, reached boolean")


def scanned_headers(lines: DataFrame) -> DataFrame:
    """file, header by a scan of the lines (path, start, line): for stores that only Spark
    reads.  A header with line breaks is known by its first line."""
    at = F.struct("start", F.monotonically_increasing_id().alias("id"))
    bare = F.trim(F.col("line").cast("string"), F.lit(" \t\r\ufeff"))
    return lines.select(plain_path(F.col("path")).alias("file"), at.alias("at"), bare.alias("line")).where(
        F.col("line") != "").groupBy("file").agg(F.min_by("line", "at").cast("binary").alias("header"))


def header_groups(spark: SparkSession, paths: Sequence[str], multi_line: bool, recursive: bool,
                  labels: DataFrame | None = None) -> list[tuple[bytes | None, str | None, list[str]]]:
    """The files of ``paths`` by header: (header, its label, files), one read for each.

    Spark binds all files of one read to one header by position, so files that
    name their columns in another order need a read of their own.  Headers come from
    the files' first blocks, read by tasks.  The file list comes to the driver only where
    headers differ; with one header (the normal case) the paths are returned as given.
    ``labels`` (file_path, detected_encoding): headers beyond ASCII are told apart by the
    file's label too, and the label is given.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    def kinds_of(found: DataFrame) -> DataFrame:
        if labels is None:
            found = found.withColumn("label", F.lit(None).cast("string"))
        else:
            named = labels.select(F.col("file_path").alias("labelled"), F.col("detected_encoding").alias("label"))
            found = found.join(named, F.col("file") == F.col("labelled"), "left")
            ascii_only = ~F.decode(F.col("header"), "ISO-8859-1").rlike(r"[^\x00-\x7F]")
            found = found.withColumn("label", F.when(ascii_only, F.lit(None)).otherwise(F.col("label")))
        return found.groupBy("header", "label")

    found = file_headers(reader.load(list(paths)), multi_line).where("header is not null or not reached")
    kinds = kinds_of(found)
    few = kinds.agg(F.min("reached").alias("reached")).orderBy("reached").limit(2).collect()
    if few and not few[0]["reached"]:
        kinds = kinds_of(scanned_headers(raw_lines(spark, paths, recursive)))
        few = kinds.count().limit(2).collect()
    if not few:
        return [(None, None, list(paths))]
    if len(few) == 1:
        return [(bytes(few[0]["header"]), few[0]["label"], list(paths))]
    groups = kinds.agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header", "label")
    return [(bytes(r["header"]), r["label"], r["files"]) for r in groups.collect()]


def column_names(header: str, trim: bool = True) -> list[str]:
    """The column names of a header record, by the rules of Spark's reader: an empty name
    becomes its place, repeated ones get theirs added."""
    names = next(csv.reader([header], skipinitialspace=trim))
    names = [n.strip(" ") for n in names] if trim else names
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n
            for i, n in enumerate(names)]


def read_csv_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool = False,
    encoding: str = "UTF-8",
    with_file_path: bool = False,
    recursive: bool = False,
    trim: bool = True,
    labels: DataFrame | None = None,
    decode_name: Callable[[bytes, str | None], str] | None = None,
) -> DataFrame:
    """Read CSV files with every column as string, header names kept verbatim.

    Each file's columns are bound by its own header: files with another header
    are read apart and joined by name, columns they lack are NULL.  With
    ``multi_line`` quoted fields may hold line breaks; a large file is still read by many
    tasks (:mod:`eventmart.sources.records`).  ``trim=False`` keeps blanks around
    unquoted fields.  ``labels`` and ``decode_name`` are for files of several encodings
    (:mod:`eventmart.sources.encoding`): names are decoded by the file's label.
    """
    options = READ_OPTIONS | {} if trim else READ_OPTIONS | {
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

    def listing():
        reader = spark.read.options(**options).option("encoding", encoding)
        if recursive:
            reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
        return reader

    given = [paths] if isinstance(paths, str) else list(paths)
    parts = []
    for header, label, files in header_groups(spark, given, multi_line, recursive, labels):
        own = ["_file_path"] if with_file_path else []
        if header is None:  # no line in any file
            df = spark.createDataFrame([], ", ".join(f"{c} string" for c in own) or T.StructType())
            parts.append(df)
            continue
        # Spark's reader skips the same line, but takes the names from another one where a
        # line of tabs comes first.
        names = column_names(header.decode(encoding, errors="replace"), trim)
        if multi_line:
            rows = quoted_records(spark, files, recursive).where(~F.col("first"))
            text = F.col("value").cast("string") if encoding == "UTF-8" else F.decode("value", encoding)
            schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
            parse = {k: v for k, v in options.items() if k not in ("header", "inferSchema")} | {"multiLine": "true"}
            df = rows.select(plain_path(F.col("path")).alias("_file_path"), F.from_csv(text, schema, parse).alias("row"))
            df = df.select("row.*", *own)
        else:
            df = listing().schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(files)
            if with_file_path:
                df = df.withColumn("_file_path", plain_path(F.col("_metadata.file_path")))
        if decode_name is not None:
            df = df.toDF(*column_names(decode_name(header, label), trim), *own)
        parts.append(df)
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def null_token_free(c: Column) -> Column:
    """``c``, or NULL when it equals one of the null tokens.

    Written as nested ``nullif`` rather than ``CASE WHEN c IN (...)``: on wide
    files (48+ columns) the CASE form overflows the generated-method size limit
    and Spark falls back to interpreted evaluation, several times slower.
    """
    for token in NULL_TOKENS:
        c = F.nullif(c, F.lit(token))
    return c


def null_tokens_to_null(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """S3: ``NULL``, ``null`` and empty strings become NULL in every string column."""
    skip = set(exclude)
    cols: list[Column] = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name not in skip and isinstance(field.dataType, T.StringType):
            c = null_token_free(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def bind_by_name(df: DataFrame, target: T.StructType, strict: bool = True) -> DataFrame:
    """Bind columns to ``target`` by name, case-insensitively.

    Missing columns are NULL, extra ones dropped, values cast to the target
    type (``strict`` raises on a bad value, as a bulk load would; otherwise the
    value becomes NULL).
    """
    have = {c.lower(): c for c in df.columns}
    cols = []
    for field in target.fields:
        name = have.get(field.name.lower())
        if name is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        src = F.col(f"`{name}`")
        if strict:
            cols.append(src.cast(field.dataType).alias(field.name))
        else:
            cols.append(src.try_cast(field.dataType).alias(field.name))
    return df.select(*cols)


def read_by_name(
    spark: SparkSession,
    paths: str | Sequence[str],
    target: T.StructType,
    multi_line: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """S11 + S6: load delta files into a table's schema, columns matched by name."""
    text = null_tokens_to_null(read_csv_text(spark, paths, multi_line, encoding))
    return bind_by_name(text, target)


# Fixed value: line end of the normalised (canonical) landing copies.
CANONICAL_LINE_SEP = "\r\n"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """Write CSV with header, minimal quoting and ``""`` escapes."""
    opts = dict(WRITE_OPTIONS)
    opts.update({k: str(v) for k, v in options.items()})
    df.write.mode(mode).options(**opts).csv(path)


def write_normalized(df: DataFrame, path: str) -> None:
    """The canonical copy of a landing file — UTF-8, minimal quoting,
    ``\r\n`` line ends — replacing any earlier copy."""
    write_csv(df, path, mode="overwrite", encoding="UTF-8", lineSep=CANONICAL_LINE_SEP)
