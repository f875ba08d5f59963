"""Records of CSV files whose quoted fields hold line breaks, read by many tasks a file.

Spark splits files at lines, and a line alone does not tell whether it begins inside a
quoted field.  So each split is read twice:

1. A task goes through its split's lines twice over, as if the split began outside and
   as if it began inside a quoted field, and says where each ends: a function of one bit.
   (Where quotes only ever enclose fields this is the parity of the split's quotes; a
   quote within an unquoted field is text and does not count, as for Spark's reader.)
2. Over the splits of a file these functions are composed in order; that is a window over
   one small row per split, and tells how each split really begins.
3. The splits are read again, now knowing this.  Lines become records; what a split holds
   of a record that began before it or ends after it is put together in a last step, a
   shuffle of these fragments only (at most two a split).

The table of splits goes to all tasks: a row for each split of the scan, which Spark's
driver lists itself.  A split that is not in it - the files or the split size changed
meanwhile - is an error, not a guess.  Lines end with ``\\n`` or ``\\r\\n``; the ``\\r`` of a
line end is kept inside quotes only.  Blank lines between records are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BLANKS = re.compile(rb"[ \t]*")
_BOM = b"\xef\xbb\xbf"
_PARTS = 1 << 12   # records a task hands over at once


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether the text after this line is inside a quoted field.

    A quote opens a field at its start (behind blanks); inside, two quotes are one
    character and a single one closes; then all up to the next comma belongs to the field.
    """
    if not inside and b'"' not in line:
        return False
    at = 0
    while True:
        if not inside:
            at = _BLANKS.match(line, at).end()
            if line[at:at + 1] == b'"':
                inside, at = True, at + 1
        while inside:
            at = line.find(b'"', at) + 1
            if not at:
                return True
            if line[at:at + 1] == b'"':
                at += 1
            else:
                inside = False
        at = line.find(b",", at) + 1
        if not at:
            return False


def _is_blank(line: bytes) -> bool:
    return not line.strip(b" \t\r")


def raw_lines(spark: SparkSession, paths: Sequence[str], recursive: bool) -> DataFrame:
    """path, start (of the split), line (bytes, without the ``\\n``), in order within a split."""
    reader = spark.read.option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    return reader.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes]]]:
    """Lines by split: ((path, start, ...), some of its lines), in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lines = [x or b"" for x in batch.column(2).to_pylist()]
        paths, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        first = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or starts[i] != starts[first] or paths[i] != paths[first]:
                rest = tuple(batch.column(c)[first].as_py() for c in range(3, batch.num_columns))
                yield (paths[first], starts[first], *rest), lines[first:i]
                first = i


def _bare(line: bytes, start: int, first: bool) -> bytes:
    return line[len(_BOM):] if first and start == 0 and line.startswith(_BOM) else line


def _outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split and assumed beginning: where it ends, and whether a record begins in it."""
    names = ["path", "start", "from_outside", "from_inside", "begins_outside", "begins_inside"]
    kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
    key, ends, begins = None, [False, True], [False, False]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip([*key, *ends, *begins], kinds, strict=True)], names=names)

    for at, lines in _runs(batches):
        fresh = at != key
        if fresh:
            if key is not None:
                yield row()
            key, ends, begins = at, [False, True], [False, False]
        for n, line in enumerate(lines):
            line = _bare(line, at[1], fresh and n == 0)
            for i in (0, 1):
                begins[i] = begins[i] or not (ends[i] or _is_blank(line))
            if b'"' in line:
                ends = [ends_inside(line, e) for e in ends] if ends[0] != ends[1] else [ends_inside(line, ends[0])] * 2
            # Without a quote both stay as they are.
    if key is not None:
        yield row()


def splits(lines: DataFrame) -> DataFrame:
    """path, start, inside (the split begins within a quoted field), header (the file's
    first record begins in it)."""
    found = lines.mapInArrow(_outcomes, "path string, start long, from_outside boolean, from_inside boolean, begins_outside boolean, begins_inside boolean")
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # A split either fixes where it ends (both functions agree), flips it or keeps it.
    flips = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = found.withColumn("flips", flips).withColumn(
        "fixed", F.when(F.col("from_outside") == F.col("from_inside"), (F.col("from_outside").cast("long") + F.col("flips")) % 2))
    since = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(0))
    marked = marked.withColumn("inside", (since + F.coalesce(F.last("flips").over(before), F.lit(0))) % 2 == 1)
    marked = marked.withColumn("begins", F.when(F.col("inside"), F.col("begins_inside")).otherwise(F.col("begins_outside")))
    earlier = F.coalesce(F.max("begins").over(before), F.lit(False))
    return marked.select("path", "start", "inside", (F.col("begins") & ~earlier).alias("header"))


#: Whole records, and what a split holds of others: their end, their middle, their beginning.
WHOLE, END, MIDDLE, BEGINNING = 0, 1, 2, 3


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, start, kind, first (the file's first record), value: records and fragments of them."""
    rows: list[tuple] = []

    def handed(force: bool) -> Iterator[pa.RecordBatch]:
        if rows and (force or len(rows) >= _PARTS):
            columns = zip(*rows, strict=True)
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["path", "start", "kind", "first", "value"])
            rows.clear()

    key = None
    inside = began = header = False
    open_: list[bytes] = []

    def close(last: bool) -> None:
        """The record in ``open_`` ends, or (``last``) its split does."""
        nonlocal header
        kind = (BEGINNING if began else MIDDLE) if last else (WHOLE if began else END)
        text = b"\n".join(open_)
        rows.append((key[0], key[1], kind, began and header, text if last or not text.endswith(b"\r") else text[:-1]))
        header = header and not began
        open_.clear()

    for at, lines in _runs(batches):
        fresh = key is None or at[:2] != key[:2]
        if fresh:
            if open_:
                close(last=True)
            if at[2] is None:
                raise ValueError(f"split {at[1]} of {at[0]} was not there a moment ago")
            key, inside, began, header = at, at[2], False, at[3]
        for n, line in enumerate(lines):
            line = _bare(line, at[1], fresh and n == 0)
            if not inside:
                if _is_blank(line):
                    continue
                began = True
            open_.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                close(last=False)
        yield from handed(False)
    if open_:
        close(last=True)
    yield from handed(True)


def quoted_records(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> DataFrame:
    """path (as the metadata column has it), first, value (bytes): a row for each record."""
    lines = raw_lines(spark, paths, recursive)
    known = splits(lines).withColumnRenamed("path", "of").withColumnRenamed("start", "from")
    told = lines.join(F.broadcast(known), (F.col("path") == F.col("of")) & (F.col("start") == F.col("from")), "left")
    pieces = told.select("path", "start", "line", "inside", "header").mapInArrow(
        _pieces, "path string, start long, kind int, first boolean, value binary")
    whole = pieces.where(F.col("kind") == WHOLE).select("path", "first", "value")
    order = Window.partitionBy("path").orderBy("start", "kind")
    parts = pieces.where(F.col("kind") != WHOLE).withColumn("record", F.sum((F.col("kind") == BEGINNING).cast("long")).over(order))
    joined = parts.groupBy("path", "record").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "kind", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: F.hex(p["value"])), "0A")
    return whole.unionByName(joined.select("path", "first", F.unhex(text).alias("value")))
