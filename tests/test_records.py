"""Quoted line breaks read by several tasks, and headers read from the first block."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from eventmart.sources import csv as csv_src
from eventmart.sources import records


def _write(path, rows, lineterminator="\n", encoding="utf-8", quoting=csv.QUOTE_MINIMAL):
    buf = io.StringIO()
    csv.writer(buf, lineterminator=lineterminator, quoting=quoting).writerows(rows)
    path.write_bytes(buf.getvalue().encode(encoding))
    return str(path)


def _random_rows(seed, n):
    rnd = random.Random(seed)
    words = ["a", "b,c", 'say ""hi""'.replace('""', '"'), "two\nlines", "x\r\ny", "\n\n", "é", "", "plain text", '"', ',"\n']
    return [["id", "note, with comma", "tail"]] + [
        [str(i), " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))).strip(" "), rnd.choice(["z", "end\n" * 3 + "x"])]
        for i in range(n)]


@pytest.fixture()
def small_splits(spark):
    """Splits of 512 bytes, so that most begin in the middle of something."""
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plain(spark, paths):
    """Spark's own reader: one task a file."""
    return spark.read.options(**csv_src.READ_OPTIONS).option("multiLine", "true").csv(paths)


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_rows_equal_the_multi_line_reader(spark, tmp_path, small_splits, ends):
    folder = tmp_path / "in"
    folder.mkdir()
    paths = [_write(folder / f"f{i}.csv", _random_rows(i, 80), ends, quoting=q)
             for i, q in enumerate([csv.QUOTE_MINIMAL, csv.QUOTE_ALL, csv.QUOTE_MINIMAL])]
    # In a file of \r\n lines Spark's reader turns those inside quotes into \n; here they stay.
    plain = lambda rows: sorted((tuple(v and v.replace("\r\n", "\n") for v in r) for r in rows), key=str)
    want = plain(_plain(spark, paths).collect())
    assert any("\n" in (r[1] or "") for r in want)
    got = csv_src.read_csv_text(spark, paths, multi_line=True)
    assert got.columns == ["id", "note, with comma", "tail"]
    assert plain(got.collect()) == want and any("\r\n" in (r[1] or "") for r in got.collect())
    scan = records.raw_lines(spark, paths, False)
    assert scan.rdd.getNumPartitions() > 3 * len(paths)     # several tasks a file
    assert plain(csv_src.read_csv_text(spark, str(folder), multi_line=True).collect()) == want


def test_a_field_over_many_splits_and_no_closing_quote(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(600))
    path = _write(tmp_path / "long.csv", [["k", "v"], ["1", long], ["2", "x"], ["3", long + '"']])
    got = {r["k"]: r["v"] for r in csv_src.read_csv_text(spark, path, multi_line=True).collect()}
    assert got == {"1": long, "2": "x", "3": long + '"'}
    begins = records.splits(records.raw_lines(spark, [path], False)).orderBy("start").collect()
    assert sum(r["inside"] for r in begins) > 5 and [r["header"] for r in begins] == [True] + [False] * (len(begins) - 1)


def test_a_quote_within_an_unquoted_field_is_text(spark, tmp_path, small_splits):
    body = "k,v\n" + "".join(f'{i},5" pipe\n{i}b, "quo\nted"\n' for i in range(120))
    path = tmp_path / "stray.csv"
    path.write_text(body)
    got = sorted(map(tuple, csv_src.read_csv_text(spark, str(path), multi_line=True).collect()))
    assert got == sorted(map(tuple, _plain(spark, str(path)).collect()))
    assert ("7", '5" pipe') in got and ("7b", "quo\nted") in got


def test_blank_lines_and_byte_order_mark(spark, tmp_path, small_splits):
    path = tmp_path / "bom.csv"
    path.write_bytes("﻿\n  \n\"first\nname\",v\n\n1,2\n \n3,\"4\n\n5\"\n".encode())
    got = csv_src.read_csv_text(spark, str(path), multi_line=True)
    assert got.columns == ["first\nname", "v"]
    assert sorted(map(tuple, got.collect())) == [("1", "2"), ("3", "4\n\n5")]


def test_a_malformed_record_fails(spark, tmp_path):
    path = _write(tmp_path / "bad.csv", [["a", "b"], ["1", "x\ny"], ["2"]])
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_src.read_csv_text(spark, path, multi_line=True).collect()


def test_the_split_table_must_match(spark, tmp_path, monkeypatch):
    path = _write(tmp_path / "f.csv", _random_rows(3, 20))
    real = records.splits
    monkeypatch.setattr(records, "splits", lambda lines: real(lines).where(F.lit(False)))
    with pytest.raises(Exception, match="was not there a moment ago"):
        records.quoted_records(spark, [path]).collect()


def test_columns_named_like_the_readers_own(spark, tmp_path):
    path = _write(tmp_path / "f.csv", [["path", "first", "row", "value"], ["a\nb", "1", "2", "3"]])
    got = csv_src.read_csv_text(spark, path, multi_line=True, with_file_path=True)
    assert got.columns == ["path", "first", "row", "value", "_file_path"]
    assert tuple(got.first())[:4] == ("a\nb", "1", "2", "3") and got.first()[4].endswith("/f.csv")


def test_files_that_begin_with_a_blank_line_keep_their_columns(spark, tmp_path):
    """The header is the first line that is not blank, for Spark and for the grouping."""
    for name, text in (("a", "\nevent_id,yes,maybe\nx1,1,2\n"), ("b", " \t\n\r\nevent_id,maybe,yes\nx2,2,1\n"),
                       ("c", "﻿maybe,yes,event_id\n2,1,x3\n"), ("empty", ""), ("blank", "\n \n")):
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    for multi_line in (False, True):
        got = csv_src.read_csv_text(spark, str(tmp_path), multi_line=multi_line).select("event_id", "yes", "maybe")
        assert sorted(map(tuple, got.collect())) == [("x1", "1", "2"), ("x2", "1", "2"), ("x3", "1", "2")]


@pytest.mark.parametrize("data, multi_line, want", [
    (b"a,b\n1,2", False, b"a,b"), (b"\n \t\r\na,b\r\n1", False, b"a,b"), (b"a\rb", False, b"a"),
    (b"\xef\xbb\xbf\r\na,b\r\n1", True, b"a,b"), (b'"a\nb",c\n1', True, b'"a\nb",c'), (b'"a\nb",c\n1', False, b'"a'),
    (b"a,b", False, None), (b'"a\n', True, None)])
def test_first_record(data, multi_line, want):
    assert csv_src.first_record(data, multi_line, complete=False) == want
    if want is None:
        assert csv_src.first_record(data, multi_line, complete=True).strip() == data.strip()


def test_headers_come_from_the_first_block(spark, tmp_path, monkeypatch):
    """Only the first bytes are read, more where the header is longer; a store that Python
    cannot open is scanned by Spark."""
    from pyspark.sql import DataFrame

    names = [f"column_{i}" for i in range(40)]
    for name in ("a", "b"):
        _write(tmp_path / f"{name}.csv", [names if name == "a" else names[::-1]] + [["1"] * 40] * 50)
    monkeypatch.setattr(csv_src, "HEAD_BYTES", 16)
    listing = spark.read.format("binaryFile").load(str(tmp_path))
    found = csv_src.file_headers(listing, False)
    assert {bytes(r["header"]).decode() for r in found.collect()} == {",".join(names), ",".join(names[::-1])}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert "FileScan text" not in plan
    groups = csv_src.header_groups(spark, [str(tmp_path)], False, False)
    unreached = lambda listing, m: listing.select(F.col("path").alias("file"), F.lit(None).cast("binary").alias("header"), F.lit(False).alias("reached"))
    monkeypatch.setattr(csv_src, "file_headers", unreached)
    scanned = csv_src.header_groups(spark, [str(tmp_path)], False, False)
    assert scanned == groups and [f[0].rpartition("/")[2] for _, _, f in groups] == ["a.csv", "b.csv"]
    assert isinstance(csv_src.read_csv_text(spark, str(tmp_path)), DataFrame)
