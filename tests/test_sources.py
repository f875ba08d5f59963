"""CSV format, null tokens, by-name binding, type inference and encodings."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.sources import csv as csv_src
from eventmart.sources import encoding, inference


def _write(path, name, data: bytes) -> str:
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "wb") as fh:
        fh.write(data)
    return p


def _label_and_rows(spark, path, multi_line=False):
    rows, labels = encoding.load_csv_any_encoding(spark, path, multi_line=multi_line)
    label = {r["detected_encoding"] for r in labels.collect()}
    data = rows.drop("_file_path", "detected_encoding")
    return label, data.columns, [tuple(r) for r in data.collect()]


def test_utf8_file_is_labelled_utf8_sig(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", "id,name\n1,Marta\n".encode("utf-8"))
    label, cols, data = _label_and_rows(spark, p)
    assert label == {"utf-8-sig"}
    assert cols == ["id", "name"] and data == [("1", "Marta")]


# Fixed value: the name in this fixture.
def test_latin1_file_is_labelled_cp1252(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", "id,name\n1,José\n".encode("latin-1"))
    label, _, data = _label_and_rows(spark, p)
    assert label == {"cp1252"}
    assert data == [("1", "José")]


def test_bom_is_stripped_from_first_header(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", "\ufeffid,name\n1,Ana\n".encode("utf-8"))
    label, cols, _ = _label_and_rows(spark, p)
    assert label == {"utf-8-sig"}
    assert cols == ["id", "name"]


def test_cp1252_specific_bytes_are_translated(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", b"id,price\n1,\x80 caf\xe9\n")
    label, _, data = _label_and_rows(spark, p)
    assert label == {"cp1252"}
    assert data == [("1", "€ café")]


def test_unassigned_cp1252_byte_falls_back_to_latin1(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", b"id,name\n1,\xe9\x81\n")
    label, _, data = _label_and_rows(spark, p)
    assert label == {"iso-8859-1"}
    assert data == [("1", "é\u0081")]


def test_files_are_labelled_independently(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "u.csv", "id,name\n1,Zoë\n".encode("utf-8"))
    _write(d, "c.csv", "id,name\n2,Zoë\n".encode("cp1252"))
    labels = encoding.detect_encodings(spark, d)
    got = {os.path.basename(r["file_path"]): r["detected_encoding"] for r in labels.collect()}
    assert got == {"u.csv": "utf-8-sig", "c.csv": "cp1252"}
    rows, _ = encoding.load_csv_any_encoding(spark, d)
    assert sorted(r["name"] for r in rows.collect()) == ["Zoë", "Zoë"]


def test_cp1252_table_matches_python_codec():
    assert len(encoding.CP1252_FROM) == len(encoding.CP1252_TO) == 27
    assert [hex(ord(c)) for c in encoding.CP1252_HOLES] == ["0x81", "0x8d", "0x8f", "0x90",
                                                           "0x9d"]
    raw = bytes(range(0x80, 0xA0))
    for ch_from, ch_to in zip(encoding.CP1252_FROM, encoding.CP1252_TO):
        assert ch_from.encode("latin-1").decode("cp1252") == ch_to
    assert raw  # all 32 positions covered by FROM + HOLES
    assert len(encoding.CP1252_FROM) + len(encoding.CP1252_HOLES) == 32


def test_null_tokens(spark, tmp_path):
    p = _write(str(tmp_path), "n.csv",
               b'a,b,c,d,e,f\nNULL,null,,"",  NULL  ,x\n')
    df = csv_src.null_tokens_to_null(csv_src.read_csv_text(spark, p))
    assert [tuple(r) for r in df.collect()] == [(None, None, None, None, None, "x")]


def test_quotes_commas_and_newlines(spark, tmp_path):
    p = _write(str(tmp_path), "q.csv",
               b'id,text\n1,"a ""q"" b"\n2,"x, y"\n3,"line1\nline2"\n4,"  kept  "\n')
    df = csv_src.read_csv_text(spark, p, multi_line=True)
    got = {r["id"]: r["text"] for r in df.collect()}
    assert got == {"1": 'a "q" b', "2": "x, y", "3": "line1\nline2", "4": "  kept  "}


def test_bind_by_name_reordered_recased_extra_missing(spark, tmp_path):
    p = _write(str(tmp_path), "r.csv", b"EXTRA,Name,ID\nz,Ann,7\n")
    target = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("missing", T.DoubleType())])
    df = csv_src.read_by_name(spark, p, target)
    assert df.columns == ["id", "name", "missing"]
    assert [tuple(r) for r in df.collect()] == [(7, "Ann", None)]


def test_inference_with_dotted_names_and_null_tokens(spark, tmp_path):
    p = _write(str(tmp_path), "d.csv",
               b"event_id,fee.amount,rating.count,flag,when,venue.zip,note\n"
               b"1,12.5,3,true,2024-01-02 10:00:00,01234,a\n"
               b"2,NULL,4,false,2024-01-03,NULL,NULL\n"
               b"3,7,null,TRUE,2024-02-01 00:00:00,99999,NULL\n")
    text = csv_src.null_tokens_to_null(csv_src.read_csv_text(spark, p))
    schema = inference.infer_schema(text)
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert types == {"event_id": "string", "fee.amount": "double", "rating.count": "bigint",
                     "flag": "boolean", "when": "timestamp", "venue.zip": "string",
                     "note": "string"}
    typed = inference.apply_schema(text, schema)
    got = typed.orderBy("event_id").select("`fee.amount`", "`rating.count`", "flag",
                                            "`venue.zip`").collect()
    assert [tuple(r) for r in got] == [(12.5, 3, True, "01234"), (None, 4, False, None),
                                       (7.0, None, True, "99999")]


@pytest.mark.parametrize("value, expected", [
    ("y", T.StringType()), ("1.0d", T.StringType()), ("NaN", T.StringType()),
    ("Infinity", T.StringType()), ("2020", T.LongType()), ("2.5e3", T.DoubleType()),
])
def test_inference_guards(spark, value, expected):
    df = spark.createDataFrame([(value,), ("1",)], "c string")
    assert inference.infer_schema(df).fields[0].dataType == expected


def test_all_null_column_stays_string(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    assert inference.infer_schema(df).fields[0].dataType == T.StringType()


def test_canonical_write_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"', None), (2, " lead", "a,b")],
                               "id long, t string, u string")
    out = str(tmp_path / "out")
    csv_src.write_csv(df, out)
    back = csv_src.null_tokens_to_null(csv_src.read_csv_text(spark, out))
    got = sorted(tuple(r) for r in back.collect())
    # Unquoted blanks are trimmed at load, as the reference file format does.
    assert got == [("1", 'say "hi"', None), ("2", "lead", "a,b")]


def _normalized_bytes(spark, src_path, out_dir):
    rows, labels = encoding.load_csv_any_encoding(spark, src_path)
    csv_src.write_normalized(rows.drop("_file_path", "detected_encoding").coalesce(1), out_dir)
    part = [f for f in os.listdir(out_dir) if f.endswith(".csv")]
    assert len(part) == 1
    with open(os.path.join(out_dir, part[0]), "rb") as fh:
        return fh.read(), {r["detected_encoding"] for r in labels.collect()}


def test_normalized_copy_of_utf8_file(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", "id,name\n1,Marta\n".encode("utf-8"))
    data, label = _normalized_bytes(spark, p, str(tmp_path / "norm"))
    assert data == b"id,name\r\n1,Marta\r\n" and label == {"utf-8-sig"}


def test_normalized_copy_of_latin1_file(spark, tmp_path):
    p = _write(str(tmp_path), "a.csv", "id,name\n1,José\n".encode("latin-1"))
    data, label = _normalized_bytes(spark, p, str(tmp_path / "norm"))
    assert data == "id,name\r\n1,José\r\n".encode("utf-8") and label == {"cp1252"}


def test_label_is_per_file_not_per_line(spark, tmp_path):
    # UTF-8 lines plus one Latin-1 line: the whole file is not valid UTF-8, so every
    # line is decoded as cp1252 (the reference decodes whole files, strictly).
    data = "id,name\n1,Zoë\n".encode("utf-8") + "2,José\n".encode("latin-1")
    p = _write(str(tmp_path), "mixed.csv", data)
    label, _, rows_ = _label_and_rows(spark, p)
    assert label == {"cp1252"}
    assert sorted(rows_) == [("1", "ZoÃ«"), ("2", "José")]


def test_wide_tables_code_their_values_by_one_expression(spark, monkeypatch):
    calls = []
    code = inference.value_code
    monkeypatch.setattr(inference, "value_code", lambda c: calls.append(1) or code(c))
    names = [f"c.{i}" for i in range(60)]
    rows = [tuple("7" if i % 3 == 0 else None if i % 3 == 1 else f"x{i}" for i in range(60)),
            tuple("8.5" if i % 6 == 0 else None if i % 3 == 1 else "9" for i in range(60))]
    df = spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    kinds = [f.dataType.simpleString() for f in inference.infer_schema(df).fields]
    assert kinds == ["double" if i % 6 == 0 else "bigint" if i % 3 == 0 else "string" for i in range(60)]
    assert len(calls) == 1


def test_first_characters_decide_no_type_alone(spark):
    values = ["t", "True", "-", "+7", ".5", "f", "FALSE", "e5", " 7", "2024-01-02", "2024-13-02", "", "-.5e3"]
    kinds = ["string", "boolean", "string", "bigint", "double", "string", "boolean", "string", "string",
             "timestamp", "string", "string", "double"]
    df = spark.createDataFrame([tuple(values)], T.StructType(
        [T.StructField(f"c{i}", T.StringType()) for i in range(len(values))]))
    assert [f.dataType.simpleString() for f in inference.infer_schema(df).fields] == kinds


def test_codes_of_numbers_are_those_of_their_patterns(spark):
    import re

    from eventmart.sources import inference as inf

    texts = ["0", "7", "-7", "+7", "007", "+-7", "-", "+", "7-", "7 ", "7\t", "7.", ".7", "7.5", "-.5", "1e5", "1e", "12345678901234",
             "123456789012345", "-12345678901234", "-123456789012345", "1234567890123456", "9" * 19, "1" * 39, "7\u00a0", "\u0667", "7a",
             "0x7", "1_000", "1,000", "7L", "true", "FALSE", "tru", "2024-01-01", "2024-13-01", "text", "7\u0000"]
    got = {r["v"]: r["code"] for r in spark.createDataFrame([(t,) for t in texts], "v string").select(
        "v", inf.value_code(F.col("v")).alias("code")).collect()}
    for t in texts:
        whole = re.fullmatch(r"[+-]?[0-9]+", t, re.ASCII)
        digits = len(t.strip("+-"))
        if whole and digits <= 15:
            assert got[t] == inf._INT * inf._SIZES, t
        elif not whole:
            assert got[t] // inf._SIZES != inf._INT, t
    assert got["true"] == got["FALSE"] == inf._BOOL * inf._SIZES and got["tru"] == inf._TEXT * inf._SIZES
    assert got["1" * 39] == inf._TEXT * inf._SIZES


def test_bytes_of_valid_characters_count_for_a_file_that_is_not_utf8(spark, tmp_path):
    from eventmart.sources import encoding as enc

    (tmp_path / "a.csv").write_bytes(b"k\n\xc3\x81\n\xe9\n")   # 81 is unassigned in cp1252
    (tmp_path / "b.csv").write_bytes(b"k\nabc\n\xe9\n")
    (tmp_path / "c.csv").write_bytes(b"k\n\xc3\x81\n")
    found = {r["file_path"][-5]: r["detected_encoding"] for r in enc.detect_encodings(spark, str(tmp_path)).collect()}
    assert found == {"a": "iso-8859-1", "b": "cp1252", "c": "utf-8-sig"}


def test_landing_files_of_the_csv_queries_are_compressed(spark, tmp_path, monkeypatch):
    from eventmart.plans import registry

    for query, left in ((registry.q_csv_load_typed, True), (registry.q_inferred_template, False)):
        path = tmp_path / query.__name__
        monkeypatch.setattr(registry, "scratch_path", lambda *a, path=path: str(path))
        written = []
        write = registry.csv_src.write_csv
        with monkeypatch.context() as m:
            m.setattr(registry.csv_src, "write_csv", lambda df, to, **k: write(df, to, **k) or written.extend(
                x.name for x in path.glob("part-*")))
            out = query(spark, "/root/testdata/sf0.001")
            assert out.count() > 40
        assert written and all(x.endswith(".csv.gz") for x in written)
        assert path.exists() == left
