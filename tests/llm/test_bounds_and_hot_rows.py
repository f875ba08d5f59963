"""Bounded fits without lost keys, and rows that share an id or a text."""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import language_id, packing, secret_scan, sentencepieces, toxicity
from eventmart.llm.common import held_out, scratch
from eventmart.llm.queries import vocabulary


# ---- toxicity ---------------------------------------------------------------

def training_ids(spark, n):
    """Ids that are not held out."""
    return [r["id"] for r in spark.range(2 * n + 20).where(~held_out(F.col("id"))).limit(n).collect()]


def test_training_rows_are_bounded_where_an_id_repeats(spark):
    a, b = training_ids(spark, 2)
    rnd = random.Random(1)
    text = lambda: " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(30))
    docs = spark.createDataFrame([(a, text()) for _ in range(900)] + [(b, text()) for _ in range(40)] + [(b, "same")] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(a, 1), (b, 0)], "doc_id long, toxic int")
    rows = toxicity.labelled(docs, labels, 50, 70).groupBy("toxic").count().collect()
    assert {r["toxic"]: r["count"] for r in rows} == {1: 50, 0: 41}


def test_only_copies_count_once(spark):
    """Texts that share a long passage - and so their smallest hashes - are not copies."""
    ids = training_ids(spark, 60)
    rnd = random.Random(2)
    words = lambda n: " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(n))
    passage = words(60)
    copy = words(80)
    texts = [f"{words(60)} {passage}" for _ in range(20)] + [copy + " x" * (i % 2) for i in range(20)] + [words(40) for _ in range(20)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")
    kept = [r["text"] for r in toxicity.labelled(docs, labels, 100, 100).collect()]
    assert sum(t.startswith(copy) for t in kept) == 1 and len(kept) == 41


def test_many_tables_find_what_one_does(monkeypatch):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdeo") for _ in range(n))
    terms = list({word(rnd.randint(3, 9)): bool(rnd.random() < 0.3) for _ in range(40)}.items())
    texts = [" ".join(rnd.choice([word(rnd.randint(2, 10)), rnd.choice(terms)[0], rnd.choice(terms)[0][:-1] + "x"]) for _ in range(80)) for _ in range(30)]
    monkeypatch.setattr(toxicity, "TRIE", 1000)
    one = toxicity.hits(toxicity.automata(terms), texts)
    monkeypatch.setattr(toxicity, "TRIE", 7)
    tables = toxicity.automata(terms)
    many = toxicity.hits(tables, texts)
    assert len(tables) == math.ceil(len(terms) / 7) and len(one[0]) > 500
    key = lambda h: sorted(zip(h[0].tolist(), h[1].tolist(), (h[2] % 3).tolist(), h[3].tolist(), strict=True))
    assert key(one) == key(many) and one[4].tolist() == many[4].tolist()
    exact = {t for t, stem in terms}
    for text, at, label in zip(*(x.tolist() for x in many[:3]), strict=True):
        if texts[text].split()[at] in exact:
            assert label % 3 == 0


def test_the_lexicon_has_no_fixed_size(spark):
    """More terms than one table holds, each in a few toxic documents only."""
    rnd = random.Random(3)
    bad = ["".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(8)) for _ in range(150)]
    good = [f"plain{i}" for i in range(60)]
    rows = [(1, " ".join(rnd.sample(bad, 40) + rnd.sample(good, 10))) for _ in range(60)] + [(0, " ".join(rnd.sample(good, 30))) for _ in range(1200)]
    found = toxicity.lexicon(spark.createDataFrame(rows, "toxic int, text string"), 60, 1200)
    assert sum(any(w == t or stem and w.startswith(t) for t, stem in found) for w in bad) == len(bad) > toxicity.TRIE
    assert not any(t.startswith("plai") for t, _ in found)


# ---- language ---------------------------------------------------------------

def test_keys_whose_slot_is_taken_are_found(monkeypatch):
    monkeypatch.setattr(language_id, "_SLOTS", 6)
    names = [f"word{i}" for i in range(50)]
    counts = np.arange(100, dtype=float).reshape(50, 2)
    t = language_id.table(names, counts, language_id.word_key)
    asked = np.array([language_id.word_key(n) for n in [*names, *(f"no{i}" for i in range(200))]], np.uint64)
    assert t.find(asked).tolist() == [*range(50), *[-1] * 200]


def plain_sums(docs, texts, languages, longest=4, smooth=0.1):
    """Log frequencies by language, words first, then the longest known n-gram at each letter."""
    letters = lambda text: re.findall(r"[^\W\d_]+", text.lower())
    words, grams = defaultdict(Counter), [defaultdict(Counter) for _ in range(longest + 1)]
    for lang, text in docs:
        words_here = Counter(letters(text))
        for w, n in words_here.items():
            words[w][lang] += n
    for lang in languages:
        for w in [w for w, by in words.items() if by[lang]]:
            for i in range(1, len(w) + 1):
                for n in range(1, min(longest, i + 1) + 1):
                    grams[n][(" " + w)[i + 1 - n : i + 1]][lang] += 1
    total = lambda t: {lang: sum(by[lang] for by in t.values()) for lang in languages}
    totals = [total(words), *(total(g) for g in grams[1:])]
    log = lambda t, key, lang, k: math.log((t[key][lang] + smooth) / (totals[k][lang] + smooth * len(t)))
    out = []
    for text in texts:
        sums = dict.fromkeys(languages, 0.0)
        for w in letters(text):
            if w in words:
                for lang in languages:
                    sums[lang] += log(words, w, lang, 0)
                continue
            for i in range(1, len(w) + 1):
                for n in range(longest, 0, -1):
                    g = (" " + w)[i + 1 - n : i + 1]
                    if i + 1 - n >= 0 and g in grams[n]:
                        for lang in languages:
                            sums[lang] += log(grams[n], g, lang, n)
                        break
        out.append([sums[lang] for lang in languages])
    return np.array(out)


def test_language_scores_equal_plain_backing_off(spark):
    rnd = random.Random(8)
    syllables = {"aa": ["ba", "lo", "été"], "bb": ["ki", "ba", "zu"], "cc": ["日", "本", "lo"]}
    word = lambda lang: "".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 4)))
    ids = training_ids(spark, 45)
    train = [(i, lang, " ".join(word(lang) for _ in range(20)) + " " + "long" * 30) for i, lang in zip(ids, ["aa", "bb", "cc"] * 15, strict=True)]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, lang string, text string"))
    texts = [" ".join(word(rnd.choice(list(syllables))) + rnd.choice(["", "q", "zz"]) for _ in range(12)) for _ in range(40)]
    texts += ["", "12", "long" * 30, "x" * 300, "Ba LO-été"]
    got, _, has = language_id.sums(model, texts)
    assert model.languages == ["aa", "bb", "cc"]
    assert has.tolist() == [bool(re.search(r"[^\W\d_]", unicodedata.normalize("NFC", t))) for t in texts]
    np.testing.assert_allclose(got, plain_sums([r[1:] for r in train], texts, model.languages), rtol=1e-4, atol=1e-4)


def test_hundreds_of_languages(spark):
    ids = training_ids(spark, 300)
    rows = [(i, f"l{n:03}", f"only{chr(97 + n % 26)}{chr(97 + n // 26)} the") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language_id.fit(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    assert len(model.languages) == 300 and all(got[i] == lang for i, lang, _ in rows)


# ---- packing, secrets, pieces -----------------------------------------------

def test_packing_spreads_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "")] * 600 + [(i, f"text {i}") for i in range(600)], "doc_id long, text string").repartition(4)
    got = packing.pack(docs, vocabulary("byte_bpe_50k.json"), length=64, end_id=1)
    parts = Counter(r["sequence_id"] >> 40 for r in got.where("doc_id is null").collect())
    assert sum(parts.values()) == 600 and len(parts) >= 2 and max(parts.values()) < 500


def test_copies_without_an_id_are_scanned_once(spark):
    secret = "password = hunter2hunter2"
    docs = spark.createDataFrame([(None, secret)] * 400 + [(None, "other")] * 3 + [(i, f"AKIA{'A' * 16} {i % 7}") for i in range(100)], "doc_id long, text string").repartition(4)
    path = scratch(spark, "hot-ledger")
    rows = secret_scan.report(docs, path).collect()
    assert Counter((r["n_assign"], r["n_access"]) for r in rows) == {(1, 0): 400, (0, 0): 3, (0, 1): 100}
    ledger = spark.read.parquet(path)
    assert ledger.count() == ledger.select("blob").distinct().count() == 9
    secret_scan.report(docs, path).collect()      # the same rows again: nothing is unseen
    assert spark.read.parquet(path).count() == 9


def test_a_worker_keeps_its_table():
    model = vocabulary("piece_bpe_32k.model")
    table = sentencepieces.table_of(model)
    list(table.encode(["some words here"]))
    assert sentencepieces.table_of(model) is table and "words" in table.ids


@pytest.mark.parametrize("name", ["op1", "op2"])
def test_nothing_to_learn_or_to_predict(spark, no_docs, name):
    docs = spark.createDataFrame([(0, None), (1, "x"), (None, "")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    if name == "op1":
        none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        assert toxicity.score(no_docs, toxicity.fit(no_docs, none)).count() == 0
        assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    else:
        assert language_id.predict(no_docs, language_id.fit(no_docs)).count() == 0
        assert {(r["lang_pred"], r["score"]) for r in language_id.predict(docs, language_id.fit(docs)).collect()} == {("und", 0.0)}
