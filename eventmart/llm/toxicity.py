"""Toxicity by a lexicon trie intersected with Levenshtein automata.

Learning, from labelled rows that are not held out (at most ``TOXIC_ROWS`` toxic
and ``CLEAN_ROWS`` clean ones, the first by a hash of id and text; of copies one):

1. The lexicon is all terms - whole words, and stems that begin words - whose log-odds
   of being in a toxic document, and the lower bound of these, are high enough, without
   those that others cover.  The bounds alone choose.
2. The lexicon's trie is intersected with the automata of all strings within
   the allowed edits (substitution, insertion, deletion, swapped neighbours; one
   edit from 4 letters on, two from 9), as a table of states and letters: one for each
   ``TRIE`` terms, as a table's states grow faster than its terms.
3. Each (term, number of edits) gets a weight: its log-odds over the labelled rows.
4. A logistic regression over a document's window scores gives the score.

Scoring runs the tables over all words of a text at once; a word counts for the term
that it is nearest to.  Every hit counts, those
in quotation marks apart from the others.  A hit's window is the ``REACH`` words on
either side; its score is the sum of the weights of the hits of its kind in it,
each term with its number of edits once a window.  What repetition beyond a window
means, the regression decides by the number of all hits and their share of the words.
Letters are folded (case, accents, common digit look-alikes) first; ``@ $ *``
count as letters between two letters.

Null and empty texts have no hits and get the score of a text without any.
Without toxic and clean training labels every score is the toxic share of the
labels there are (0 without any).  Rows that repeat a doc_id are scored each.
A document with several labels counts as toxic if one of them says so.  An empty table
gives no row; texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import held_out, ids_and_texts, small_batches, written
from .simhash import shingle_hashes

TOXIC_ROWS, CLEAN_ROWS = 5000, 10_000
#: Terms of one table.
TRIE = 96
#: Smallest shingle hashes that are compared to tell copies, and the share that must agree.
SKETCH, SAME = 24, 0.8
#: Least log-odds of a term, and least lower bound of them (three standard errors down).
LEAST_ODDS, LEAST_BOUND = 3.0, 0.75
REACH = 10
#: Characters that a slice of a batch holds, about.
SLICE = 1_000_000
#: Digits and signs that stand for letters.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "*": "*"}
QUOTES = '"“”„«»＂「」『』'
#: Values that ``features`` gives for a text.
FEATURES = 8
_CODES = 0x110000


@dataclass
class Automaton:
    classes: np.ndarray  # of each code point: 0 no letter, else a letter class
    inner: np.ndarray  # code points that are letters only between letters
    quotes: np.ndarray
    table: np.ndarray  # state x class -> state; state 0 is dead
    final: np.ndarray  # state -> term * 3 + edits, or -1
    start: int


@dataclass
class Model:
    automaton: list[Automaton] | None
    weights: np.ndarray
    coefficients: np.ndarray
    centre: np.ndarray
    prior: float


def folded(text: str) -> str:
    out = []
    for c in text.lower():
        parts = unicodedata.normalize("NFKD", c)
        # Accents go; what a syllable or a kana's sound is made of stays.
        accented = all(unicodedata.combining(m) and m not in "\u3099\u309a" for m in parts[1:])
        whole = parts[0] if accented else unicodedata.normalize("NFKC", c)
        base = (whole if len(whole) == 1 else parts[0]).lower()[0]
        out.append(LOOK_ALIKE.get(base, base))
    return "".join(out)


_FOLDED: list[dict[int, str]] = []


def folded_letters() -> dict[int, str]:
    """Of each code point that is a letter or a digit, or stands for one, what it is folded to."""
    if not _FOLDED:
        signs = (chr(cp) for cp in range(_CODES))
        _FOLDED.append({ord(c): folded(c)[0] for c in signs if c.isalnum() or c in "@$*"})
    return _FOLDED[0]


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


def automaton(terms: list[tuple[str, bool]], numbers: list[int] | None = None) -> Automaton:
    """The table for folded ``terms``; the flag marks stems, which any ending may follow.

    ``numbers``: what the terms are called in the labels (their places, if not given).
    """
    called = list(range(len(terms))) if numbers is None else numbers
    letters = sorted({c for t, _ in terms for c in t})
    number = {c: i + 2 for i, c in enumerate(letters)}  # 1: any other letter
    classes = np.zeros(_CODES, np.int32)
    for cp, c in folded_letters().items():
        classes[cp] = number.get(c, 1)

    def flag(signs: str) -> np.ndarray:
        out = np.zeros(_CODES, bool)
        out[[ord(c) for c in signs]] = True
        return out

    # A state of the intersection: (term, letters read, edits, swap pending).
    def close(states: set) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            t, i, e, swap = todo.pop()
            word, stem = terms[t]
            if not swap and i < len(word) and e < edits_allowed(word):
                nxt = (t, i + 1, e + 1, False)  # deletion
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        best: dict = {}
        for t, i, e, swap in seen:
            if best.get((t, i, swap), 9) > e:
                best[t, i, swap] = e
        return frozenset((t, i, e, swap) for (t, i, swap), e in best.items())

    def move(states: frozenset, c: str | None) -> frozenset:
        out = set()
        for t, i, e, swap in states:
            word, stem = terms[t]
            if swap:
                if c == word[i]:
                    out.add((t, i + 2, e, False))
                continue
            if i == len(word) and stem:
                out.add((t, i, e, False))
                continue
            if i < len(word) and c == word[i]:
                out.add((t, i + 1, e, False))
            if e < edits_allowed(word):
                out.add((t, i, e + 1, False))  # insertion
                if i < len(word):
                    out.add((t, i + 1, e + 1, False))  # substitution
                if i + 1 < len(word) and c == word[i + 1]:
                    out.add((t, i, e + 1, True))
        return close(out)

    def end(states: frozenset) -> int:
        ends = [(e, called[t]) for t, i, e, swap in states if not swap and i == len(terms[t][0])]
        return min(ends)[1] * 3 + min(ends)[0] if ends else -1

    first = close({(t, 0, 0, False) for t in range(len(terms))})
    known, todo, rows, finals = {frozenset(): 0, first: 1}, [first], [[0] * (len(letters) + 2), None], [-1, end(first)]
    while todo:
        states = todo.pop()
        row = [0]
        for c in [None, *letters]:
            nxt = move(states, c)
            if nxt not in known:
                known[nxt] = len(rows)
                rows.append(None)
                finals.append(end(nxt))
                todo.append(nxt)
            row.append(known[nxt])
        rows[known[states]] = row
    return Automaton(classes, flag("@$*"), flag(QUOTES), np.array(rows, np.int32), np.array(finals, np.int32), 1)


def automata(terms: list[tuple[str, bool]]) -> list[Automaton]:
    """Tables for all terms, ``TRIE`` in each: neighbours in the alphabet share their prefixes."""
    order = sorted(range(len(terms)), key=lambda i: terms[i])
    return [automaton([terms[i] for i in part], part) for part in (order[at : at + TRIE] for at in range(0, len(order), TRIE))]


def hits(tables: Automaton | list[Automaton], texts: list[str]) -> tuple[np.ndarray, ...]:
    """Of all hits: text, number of the word in it, term * 3 + edits, quoted; and the texts' word counts.

    A word that several terms are near to counts for the one with the fewest edits, then
    the first.
    """
    if isinstance(tables, Automaton):
        return hits_of(tables, texts)
    found = [hits_of(a, texts) for a in tables]
    if len(found) == 1:
        return found[0]
    text, word, label, quoted = (np.concatenate([f[i] for f in found]) for i in range(4))
    order = np.lexsort((label // 3, label % 3, word, text))
    text, word, label, quoted = text[order], word[order], label[order], quoted[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (word[1:] != word[:-1])
    return text[first], word[first], label[first], quoted[first], found[0][4]


def hits_of(a: Automaton, texts: list[str]) -> tuple[np.ndarray, ...]:
    lines = "\n".join(texts) + "\n"
    cp = np.frombuffer(lines.encode("utf-32-le", "replace"), np.uint32)
    kind = a.classes[cp]
    odd = np.flatnonzero(a.inner[cp])
    if len(odd):
        letter = kind > 0
        letter[odd] = False
        beside = letter[np.maximum(odd - 1, 0)] & letter[np.minimum(odd + 1, len(cp) - 1)]
        kind = kind.copy()
        kind[odd[~beside]] = 0
    letter = kind > 0
    start = letter.copy()
    start[1:] &= ~letter[:-1]
    starts = np.flatnonzero(start)
    ends = np.cumsum([len(t) + 1 for t in texts])
    of_word = np.searchsorted(ends, starts, side="right")
    counts = np.bincount(of_word, minlength=len(texts))
    alive, state, step = np.arange(len(starts)), np.full(len(starts), a.start, np.int32), 0
    found_word, found_label = [], []
    while len(alive):
        c = kind[starts[alive] + step]
        over = c == 0
        label = a.final[state]
        done = over & (label >= 0)
        found_word.append(alive[done])
        found_label.append(label[done])
        state = a.table[state, c]
        on = ~over & (state > 0)
        alive, state = alive[on], state[on]
        step += 1
    word = np.concatenate(found_word) if found_word else np.empty(0, np.int64)
    label = np.concatenate(found_label) if found_label else np.empty(0, np.int32)
    order = np.argsort(word, kind="stable")
    word, label = word[order], label[order]
    text = of_word[word]
    quoted = np.zeros(len(word), bool)
    if len(word):
        marks = np.flatnonzero(a.quotes[cp])
        breaks = np.flatnonzero(cp == 10)
        at = starts[word]
        line = np.searchsorted(breaks, at)
        line_start = np.where(line > 0, breaks[np.maximum(line - 1, 0)], -1)
        line_end = breaks[line]
        ahead = np.searchsorted(marks, at) - np.searchsorted(marks, line_start)
        after = np.searchsorted(marks, line_end) - np.searchsorted(marks, at)
        quoted = (ahead % 2 == 1) & (after > 0)
    first = np.cumsum(counts) - counts
    return text, word - first[text], label, quoted, counts


def features(a: Automaton | list[Automaton] | None, weights: np.ndarray, texts: list[str]) -> np.ndarray:
    """Per text: best window outside and inside quotations, weights of the distinct terms (log),
    share of all hits' weights in the words, and outside and inside quotations the distinct
    terms and all hits."""
    out = np.zeros((len(texts), FEATURES))
    if a is None or not texts:
        return out
    text, word, label, quoted, counts = hits(a, texts)
    counted = weights[label] > 0
    text, word, label, quoted = text[counted].astype(np.int64), word[counted], label[counted].astype(np.int64), quoted[counted]
    if not len(text):
        return out
    w = weights[label]
    once = np.unique(text * len(weights) + label, return_index=True)[1]
    out[:, 2] = np.log1p(np.bincount(text[once], w[once], len(texts)))
    out[:, 3] = np.sqrt(np.bincount(text, w, len(texts)) / np.maximum(counts, 1))
    for column, kind in enumerate((~quoted, quoted)):
        t, at, l, v = text[kind], word[kind], label[kind], w[kind]
        if not len(t):
            continue
        spot = t * (int(counts.max()) + 4 * REACH) + at
        low, high = np.searchsorted(spot, spot - REACH), np.searchsorted(spot, spot + REACH, side="right")
        # A hit counts in the windows that begin after the hit before it of the same term.
        group = t * len(weights) + l
        order = np.argsort(group, kind="stable")
        same = group[order[1:]] == group[order[:-1]]
        before = np.full(len(t), -1)
        before[order[1:][same]] = order[:-1][same]
        window = np.zeros(len(t))
        for step in range(int((high - low).max())):
            j = np.minimum(low + step, len(t) - 1)
            window += np.where((low + step < high) & (before[j] < low), v[j], 0)
        np.maximum.at(out[:, column], t, window)
        out[:, 4 + column] = np.log1p(np.bincount(t[before < 0], minlength=len(texts)))
        out[:, 6 + column] = np.log1p(np.bincount(t, minlength=len(texts)))
    return out


def slices(texts: list[str]) -> Iterator[slice]:
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) <= SLICE):
            held += len(texts[to])
            to += 1
        yield slice(at, to)
        at = to


# ---- learning ---------------------------------------------------------------

def labelled(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """text, toxic: the bounded training rows."""
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out(F.col("label_id")))
    )
    first = lambda value, n: known.where(F.col("toxic") == value).orderBy(F.xxhash64("label_id"), "label_id").limit(n)
    chosen = first(1, toxic_rows).union(first(0, clean_rows))
    rows = ids_and_texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    rows = written(rows.select("text", "toxic", F.xxhash64("label_id", "text").alias("h")), "labelled-rows")
    # The ids are bounded, but any of them may have many rows: their hashes are bounded too.
    keys = rows.select("toxic", "h").distinct()
    ends_at = {value: keys.where(F.col("toxic") == value).orderBy("h").limit(n).agg(F.max("h")).first()[0] for value, n in ((1, toxic_rows), (0, clean_rows))}
    last = F.when(F.col("toxic") == 1, F.lit(ends_at[1])).otherwise(F.lit(ends_at[0])).cast("long")
    rows = rows.where(F.col("h") <= last).groupBy("toxic", "h").agg(F.first("text").alias("text"))

    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.unique(np.array(shingle_hashes(t.as_py(), 3) or [0], np.uint64)) for t in batch.column(0)]
            low, high = (pa.array([x[i].astype(np.int64) for x in hashes], pa.int64()) for i in (0, -1))
            least = pa.array([x[:SKETCH].astype(np.int64).tolist() for x in hashes], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, low, high, least], names=["text", "toxic", "h", "low", "high", "least"])

    # Copies would make every word of theirs look like a sign of their label.  Rows that share
    # their smallest or their largest shingle hash with an earlier one, and most of their
    # sketch, are copies of it.
    marked = rows.select("text", "toxic", "h").mapInArrow(sketched, "text string, toxic int, h long, low long, high long, least array<long>")
    for side in ("low", "high"):
        of = Window.partitionBy("toxic", side).orderBy("h")
        marked = marked.withColumn("one", F.first("least").over(of)).withColumn("place", F.row_number().over(of))
        alike = F.size(F.array_intersect("least", "one")) >= SAME * F.greatest(F.size("least"), F.size("one"))
        marked = marked.where((F.col("place") == 1) | ~alike).drop("one", "place")
    return marked.select("text", "toxic")


def terms_of(text: str) -> set[tuple[str, bool]]:
    """The words of a text, and the stems of 4 to 8 letters that begin them (flag set)."""
    words = {w for w in re.split(r"[\W_]+", text.lower()) if 3 <= len(w) <= 40}
    return {(w, False) for w in words} | {(w[:k], True) for w in words for k in range(4, min(8, len(w) - 1) + 1)}


def counted(rows: DataFrame, name: str) -> DataFrame:
    """t, stem, ``name``: in how many of ``rows`` each term occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0):
                found.update(terms_of(text.as_py()))
            if found:
                (t, stem), n = zip(*found, strict=True), list(found.values())
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(stem), pa.array(n)], names=["t", "stem", "n"])

    return rows.select("text").mapInArrow(run, "t string, stem boolean, n long").groupBy("t", "stem").agg(F.sum("n").alias(name))


def lexicon(rows: DataFrame, toxic: int, clean: int) -> list[tuple[str, bool]]:
    """The terms that stand out in the toxic ones of the bounded training rows."""
    counts = counted(rows.where("toxic = 1"), "p").join(counted(rows.where("toxic = 0"), "n"), ["t", "stem"], "left").fillna(0, ["n"])
    odds = F.log((F.col("p") + 0.5) / (toxic - F.col("p") + 0.5)) - F.log((F.col("n") + 0.5) / (clean - F.col("n") + 0.5))
    bound = odds - 3 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5))
    best = counts.withColumn("bound", bound).where((F.col("bound") > LEAST_BOUND) & (odds > LEAST_ODDS)).collect()
    best.sort(key=lambda r: (-r["bound"], r["stem"], -len(r["t"]), r["t"]))
    chosen: dict[tuple[str, bool], None] = {}
    stems: set[str] = set()
    begun: set[str] = set()  # beginnings of the chosen terms
    for row in best:
        term, stem = folded(row["t"]), row["stem"]
        covered = (term, False) in chosen or any(term[:k] in stems for k in range(1, len(term) + 1)) or stem and term in begun
        if not covered:
            chosen[term, stem] = None
            begun.update(term[:k] for k in range(1, len(term) + 1))
            if stem:
                stems.add(term)
    return list(chosen)


def regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for a logistic regression; the first coefficient is the constant."""
    x = np.column_stack((np.ones(len(x)), x))
    b = np.zeros(x.shape[1])
    penalty = np.full(len(b), ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return b


def fit(docs: DataFrame, labels: DataFrame, *, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    small_batches(docs.sparkSession)
    rows = written(labelled(docs, labels, toxic_rows, clean_rows), "labelled")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    share = {r["toxic"]: r["count"] for r in labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    prior = share.get(1, 0) / max(1, sum(share.values()))
    nothing = Model(None, np.zeros(0), np.zeros(FEATURES + 1), np.ones(FEATURES), prior)
    if not toxic or not clean:
        return nothing
    terms = lexicon(rows, toxic, clean)
    if not terms:
        return nothing
    a = automata(terms)

    def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, label = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for s in slices(texts):
                text, _, found, _, _ = hits(a, texts[s])
                pairs = np.unique(np.column_stack((text, found)), axis=0).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1]), pa.array(label[s][pairs[:, 0]].astype(np.int64))], names=["hit", "toxic"])

    weights = np.full(len(terms) * 3, math.log(1 / (toxic + 2)) - math.log(0.5 / (clean + 1)))
    for r in rows.mapInArrow(seen, "hit long, toxic long").groupBy("hit").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")).collect():
        weights[r["hit"]] = math.log((r["p"] + 1) / (toxic + 2)) - math.log((r["n"] + 0.5) / (clean + 1))

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for s in slices(texts):
                x = features(a, weights, texts[s])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(s.start, s.stop - s.start).cast(pa.int64()), *(pa.array(x[:, i]) for i in range(FEATURES))], names=["toxic", *(f"x{i}" for i in range(FEATURES))])

    table = rows.mapInArrow(measured, "toxic long, " + ", ".join(f"x{i} double" for i in range(FEATURES))).toPandas()
    x, y = table[[f"x{i}" for i in range(FEATURES)]].to_numpy(), table["toxic"].to_numpy()
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    centre = np.maximum(x.std(axis=0), 1e-9)
    centre[x.max(axis=0) == 0] = 1
    weight = np.where(y == 1, prior / toxic, (1 - prior) / clean) * len(y)
    return Model(a, weights, regression(x / centre, y, weight), centre, prior)


# ---- scoring ----------------------------------------------------------------

def scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    x = features(model.automaton, model.weights, texts)
    if model.automaton is None:
        return np.full(len(texts), model.prior), x
    b = model.coefficients
    return 1 / (1 + np.exp(-np.clip(b[0] + (x / model.centre) @ b[1:], -30, 30))), x


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, window (best outside quotations),
    quoted_window, for every row of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for s in slices(texts):
                p, x = scores(m, texts[s])
                part = batch.slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(x[:, 0]), pa.array(x[:, 1])],
                    names=["doc_id", "held_out", "score", "predicted", "window", "quoted_window"],
                )

    return ids_and_texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, window double, quoted_window double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, with all their columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            clean = np.concatenate([scores(shared.value, texts[s])[0] < threshold for s in slices(texts)]) if texts else np.zeros(0, bool)
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
