"""The pipeline on the edge table, on an empty one, and without its optional parts."""

from __future__ import annotations

import subprocess
import sys

import pytest

import corpus_pipeline


def written_tables(docs, labels, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_every_stage_takes_the_edge_table(spark, edge_docs, labels, tmp_path):
    sf_dir = written_tables(edge_docs, labels, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {(r["doc_id"], r["lang"], r["source"]) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes, name
        rows = [(r["doc_id"], r["lang"], r["source"]) for r in out.collect()]
        assert 0 < len(rows) <= docs.count() and set(rows) <= before, name
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert pieces and all(r["length"] >= 1 and r["offset"] + r["length"] <= 2048 for r in pieces)
    # Null, empty and blank texts are one group: of those with an id the smallest is left.
    assert len({r["doc_id"] for r in pieces} & {100, 101, 105}) <= 1


def test_an_empty_table_passes_through(spark, no_docs, labels, tmp_path):
    sf_dir = written_tables(no_docs, labels, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes and out.count() == 0, name
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


@pytest.mark.parametrize("missing, fails", [("eventmart.llm", False), ("corpus_pipeline", False), ("sentencepieces_needs_this", True)])
def test_only_the_optional_parts_may_be_missing(missing, fails):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        f"        if name == {missing!r} or {fails!r} and name == 'eventmart.llm.words':\n"
        f"            raise ModuleNotFoundError(f'No module named {missing}', name={missing!r})\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "print(sorted(q for q in e.queries() if q.startswith('op') or q == 'pipeline')[:1], len(e.queries()) > 40)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert (done.returncode != 0) == fails, done.stderr
    if missing == "eventmart.llm":
        assert done.stdout.strip() == "[] True"
