"""Operators 11 to 13 against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from eventmart.llm import collocations, contamination, filter_audit
from eventmart.llm import words as W

from .conftest import SCHEMA


# ---- words ------------------------------------------------------------------

def test_words_and_hashes_agree_with_bytes(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(W, "SLICE", 64)
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab c\té日") for _ in range(rnd.randint(0, 90))) for _ in range(60)] + ["", None, "x" * 500, " " * 300]
    inside = np.ones(256, bool)
    inside[[9, 32]] = False
    for column in (pa.array(texts), pa.array(["skipped", *texts]).slice(1)):
        data, offsets = W.buffers(column)
        seen, got = {}, []
        for first, last in W.groups(offsets):
            low = int(offsets[first])
            part = data[low : int(offsets[last])]
            for t, s, e, h in zip(*W.words(part, inside, offsets[first : last + 1] - low), strict=True):
                got.append((first + t, part[s:e].tobytes()))
                assert seen.setdefault(part[s:e].tobytes(), h) == h
        assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(rb"[^ \t]+", (t or "").encode())]
        assert len(set(seen.values())) == len(seen)


# ---- filter audit -----------------------------------------------------------

def plain_audit(docs, labels):
    good, toxic = defaultdict(int), defaultdict(int)
    for i, q, t in labels:
        if i is not None:
            good[i], toxic[i] = max(good[i], int(q == 1)), max(toxic[i], int(t == 1))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^ \t-\r]+", text)
        fails = "".join(x for x, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)), ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
            ("D", bool(re.search(r"[#$%&*|]", text))), ("E", text in first and (i is None or i > first[text]))) if bad)
        parts[lang or ""].append((fails, good[i] if i is not None else 0, toxic[i] if i is not None else 0))
    out = []
    for part, rows in parts.items():
        shapley = Counter()
        found = []
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                stay = [r for r in left if x not in r[0]]
                shapley[x] += len(gone)
                found.append((part, "".join(order), step, len(stay), len(gone), sum(x in r[0] for r in rows) - len(gone), sum(r[0] == x for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), x))
                left = stay
        out += [(*r[:-1], shapley[r[-1]]) for r in found]
    return sorted(out)


def test_filter_audit_against_every_order(spark, edge_docs):
    rnd = random.Random(2)
    extra = []
    for i in range(120):
        n = rnd.choice([5, 150, 260])
        words = [rnd.choice(["Alpha", "beta", "x#", "of", "été"]) if rnd.random() < 0.3 else f"w{rnd.randint(0, 400)}" for _ in range(n)]
        extra.append((1000 + i, " ".join(words) if i % 4 else "same text " * 120, rnd.choice(["en", "fr", None, ""])))
    extra += [(None, "same text " * 120, "en"), (1003, "other", "en"), (1003, "other", "en")]
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text", "lang").collect()] + extra
    df = edge_docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"), allowMissingColumns=True)
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(1000, 1100)] + [(1003, 1, 1), (1003, 0, None), (None, 1, 1), (7, 1, 0)]
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)


def test_filter_audit_without_documents(spark, no_docs, labels):
    got = filter_audit.audit(no_docs, labels)
    assert got.count() == 0
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit_of_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a", "x"), (3, "b", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels, filters=lambda t: {"P": t.contains("a"), "Q": t.contains("b")}, copies=None)
    rows = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in got.collect()}
    assert rows["x", "PQ", 1] == (0, 2, 0, 1, 3) and rows["x", "PQ", 2] == (0, 0, 1, 0, 1)
    assert rows["", "QP", 1] == (0, 1, 0, 1, 2) and len(rows) == 8


# ---- collocations -----------------------------------------------------------

def plain_phrases(docs, longest=3):
    grams = defaultdict(Counter)
    for text, lang in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            ws = re.findall(r"[^ \t]+", piece)
            for n in range(1, longest + 1):
                for i in range(len(ws) - n + 1):
                    grams[lang or "und"][tuple(ws[i : i + n])] += 1
    return grams


def plain_mine(docs, least, top, longest=3, share=50):
    out = []
    for lang, f in plain_phrases(docs, longest).items():
        size = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        rows = []
        for p, a in found.items():
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * longer[p] < share * a:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, size, -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def some_docs(seed, n):
    rnd = random.Random(seed)
    words = [f"W{i}" for i in range(12)] + ["été", "日本", "x1"]
    passage = " ".join(rnd.choice(words) for _ in range(60))
    out = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", " ", "\t ", ". ", ",", "\r\n"]) for _ in range(rnd.randint(0, 90)))
        out.append((passage + " " + text if i % 3 == 0 else text, rnd.choice(["en", "en", "de", None])))
    return out + [(None, "en"), ("", "fr"), (" . ,", "fr"), ("the of " * 5000, "en")]


def test_collocations_against_plain_counting(spark, edge_docs, monkeypatch):
    docs = some_docs(3, 200)
    df = spark.createDataFrame([(i % 50, t, lang) for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string").unionByName(edge_docs, allowMissingColumns=True).repartition(5)
    docs += [tuple(r) for r in edge_docs.select("text", "lang").collect()]
    for top in (2000, 7):
        got = collocations.mine(df, least=3, top=top)
        assert sorted(tuple(r) for r in got.collect()) == plain_mine(docs, 3, top)
    got = collocations.mine(df, least=5, longest=4, share=80, top=50)
    assert sorted(tuple(r) for r in got.collect()) == plain_mine(docs, 5, 50, longest=4, share=80)


def test_parse_counts_each_phrase_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "EVERY", 4)
    docs = some_docs(4, 60)
    df = spark.createDataFrame(docs, "text string, lang string")
    for longest in (2, 3, 5):
        table = collocations.dictionary(df, longest=longest)
        assert table.agg({"times": "max"}).first()[0] > 1
        plain = plain_phrases(docs, longest)
        of = lambda n: {(lang, " ".join(p), c) for lang, f in plain.items() for p, c in f.items() if len(p) == n}
        first = collocations.first_pass(table, longest, 4).collect()
        assert {(r["grp"], r["phrase"], r["f"]) for r in first if r["key"] is None} == of(1)
        assert len({r["key"] for r in first} - {None}) == sum(c >= 4 for n in range(2, longest + 1) for _, _, c in of(n))
        keys = spark.createDataFrame([(r["key"],) for r in collocations.first_pass(table, longest, 1).collect() if r["key"] is not None], "key long")
        got = collocations.second_pass(table, longest, keys).groupBy("grp", "phrase").sum("times").collect()
        assert {tuple(r) for r in got} == set().union(*(of(n) for n in range(2, longest + 1)))


def test_tallies_that_are_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_KEYS", 50)
    monkeypatch.setattr(W, "SLICE", 256)
    docs = some_docs(9, 60)
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string")
    assert sorted(tuple(r) for r in collocations.mine(df, least=3, top=50).collect()) == plain_mine(docs, 3, 50)


def test_equal_phrases_are_added_up_and_different_ones_never(monkeypatch):
    import numpy as np

    data = np.frombuffer(b"ab cd ab xy ab", np.uint8)
    starts, lengths, groups, times = np.array([0, 3, 6, 9, 12]), np.full(5, 2), np.array([0, 0, 0, 0, 1]), np.array([1, 2, 4, 8, 16])
    one, sums = collocations.alike(data, np.array([5, 7, 5, 9, 6], np.uint64), starts, lengths, times, groups)
    assert dict(zip(one.tolist(), sums.tolist(), strict=True)) == {0: 5, 1: 2, 3: 8, 4: 16}
    for keys in ([5, 5, 5, 9, 6], [5, 7, 5, 9, 5]):  # other bytes, or another group, under one key
        one, sums = collocations.alike(data, np.array(keys, np.uint64), starts, lengths, times, groups)
        assert one.tolist() == [0, 1, 2, 3, 4] and sums.tolist() == times.tolist()


def test_collocations_of_nothing(spark, no_docs):
    got = collocations.mine(no_docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_scores_beyond_64_bits(spark):
    """a^2 10^6 of ten million occurrences has 20 digits; the chunk table carries the weight."""
    table = spark.createDataFrame([("en", "a b\n", True, 10_000_000), ("en", "a b c d\n", True, 3_000_001)], "grp string, chunk string, closed boolean, times long")
    real = collocations.dictionary
    try:
        collocations.dictionary = lambda *a: table
        rows = {r["phrase"]: (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in collocations.mine(table).collect()}
    finally:
        collocations.dictionary = real
    n = 2 * 10_000_000 + 4 * 3_000_001
    assert rows["a b"] == (13_000_001, 13_000_001, 13_000_001, n, 1_000_000)
    assert rows["a b c"] == (3_000_001, 13_000_001, 3_000_001, n, 10**6 * 3_000_001 // 13_000_001)


# ---- decontamination --------------------------------------------------------

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_report(docs, items, window=10):
    windows = defaultdict(set)
    for name, text in items:
        ws = item_words(text)
        for i in range(max(len(ws) - window + 1, 1) if ws else 0):
            windows[tuple(ws[i : i + window])].add(str(name) if name is not None else "")
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        ws, hit, names = item_words(text), set(), set()
        for k in sizes:
            for i in range(len(ws) - k + 1):
                if (found := windows.get(tuple(ws[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    names |= found
        out.append((doc_id, len(ws), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leaky_docs(seed, n, vocabulary=("a", "b", "c", "D", "été", "x1")):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", "-", "\n", "’ "]) for _ in range(k))
    items = [(i, text(rnd.choice([3, 9, 10, 11, 14, 40]))) for i in range(12)]
    items += [(5, items[3][1]), (None, text(12)), (90, None), (91, ""), (92, " - "), (93, items[4][1]), (93, items[4][1])]
    docs = []
    for i in range(n):
        body = text(rnd.randint(0, 80))
        if i % 3 == 0:
            item = rnd.choice(items)[1] or ""
            body = text(9) + item[rnd.randint(0, 8) :].upper() + " " + text(20)
        docs.append((i, body))
    return docs, items


@pytest.mark.parametrize("short", [False, True])
def test_decontamination_against_plain_search(spark, edge_docs, short):
    docs, items = leaky_docs(6, 150)
    items = items + [(200, "a")] if short else [(i, t) for i, t in items if len(item_words(t)) >= 9]
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(edge_docs, allowMissingColumns=True).repartition(3)
    docs = docs + [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    items += [(300, docs[7][1]), (301, "the of " * 30), (302, "alpha beta gamma")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as words", "'x' as block", "2 as doc_id")
    got = contamination.report(df, benchmark)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_report(docs, items)


def test_decontamination_in_blocks(spark, monkeypatch):
    """Many blocks, long items in parts: the same result."""
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 150)
    monkeypatch.setattr(contamination, "PART_WORDS", 25)
    docs, items = leaky_docs(8, 60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(contamination.blocks(benchmark, 10))) > 1
    got = contamination.report(df, benchmark)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_report(docs, items)


def test_decontamination_edges(spark, no_docs):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    assert contamination.report(no_docs, benchmark).count() == 0
    docs = spark.createDataFrame([(1, "x One, two three four five six seven eight nine TEN yes"), (2, None), (None, "Éa")], "doc_id long, text string")
    none = contamination.report(docs, benchmark.limit(0)).orderBy("n_words").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in none] == [(2, 0, 0, 0, empty, False), (None, 1, 0, 0, empty, False), (1, 12, 0, 0, empty, False)]


def test_spans_are_cut_and_covered_documents_go(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    leak = "One two three four five six seven, eight nine TEN"
    rows = [(1, f"é before {leak}. after {leak}! and quite a lot of other words stand here behind it all so that most of the text is clean"), (2, leak), (3, None), (4, "日本 clean")]
    docs = spark.createDataFrame(rows, SCHEMA.split(", lang")[0])
    got = {r["doc_id"]: r["text"] for r in contamination.decontaminate(docs, benchmark, coverage=0.6).collect()}
    assert got == {1: "é before . after ! and quite a lot of other words stand here behind it all so that most of the text is clean", 3: None, 4: "日本 clean"}
