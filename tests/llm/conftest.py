from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"

#: Columns beside those of documents; the names are ones that the operators use themselves.
CLASHING = "score double, held_out boolean, component_id long, fp long, blob string, spans string, row long, c long, c0 long, at long, cell int, edited string, block long, start long, place long, label_id long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def texts_of(seed: int, n: int) -> list[str]:
    """Texts with shared passages, copies, near copies, odd white space and other scripts."""
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "Delta", "été", "日本", "x1", "of", "the", "12.5", "foo-bar", "😀"]
    passage = " ".join(rnd.choice(words) for _ in range(30)) + "."
    out = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))
        if i % 3 == 0:
            text = f"{text}\n{passage} {text[:20]}"
        if i % 7 == 0 and out:
            text = rnd.choice(out)
        if i % 5 == 0:
            text += rnd.choice(["  ", "\t", " \n ", " ", "▁", "<|endoftext|>", "\x00", "\r\n"]) + rnd.choice(words)
        out.append(text)
    return out


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null, empty and very long texts, repeated rows, ties, rows without an id, clashing columns."""
    texts = texts_of(1, 40)
    rows: list[tuple] = [(i, t, "en" if i % 2 else "fr", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, "the of " * 20_000, "en", "s", 140_000), (103, "a" * 30_000, "fr", None, 30_000)]
    rows += [(7, texts[7], "en", "s", len(texts[7]))] * 2 + [(104, texts[3], None, "s", 1), (None, texts[3], "en", "s", 5), (None, None, None, None, None), (105, " \n ", "en", "s", 3)]
    extra = (0.5, True, 3, 4, "b", "sp", 5, 6, 7, 8, 9, "e", 10, 11, 12, 13)
    return spark.createDataFrame([r + extra for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF2}/labels.parquet")
