"""Language identification by words first, backing off to shorter character n-grams.

Learning, from at most about ``ROWS_PER_LANGUAGE`` documents of each language
(those with the lowest hashes of id; held-out and null-language ones never):
the ``WORDS`` most frequent words with their counts in each language, and for
n = ``LONGEST`` ... 1 the ``GRAMS`` most frequent n-grams of the distinct words
(a word is read with one boundary character before it).

Scoring: a word of the table adds its log frequency in each language.  For any
other word, each of its letters adds the log frequency of the longest known
n-gram that ends there: the next shorter one where that is unknown, none below
one letter.  The language with the largest sum wins (ties: the first by name);
``score`` is its share after a softmax over the sums per unit, times at most
``EVIDENCE`` units.

Words are runs of letters, lower-cased.  A text that is null or has no letter is
``und`` with score 0; so is any text when nothing could be learned.  Rows that
repeat a doc_id are predicted each; an empty table gives no row.  Texts of any
length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, ids_and_texts, small_batches, written

ROWS_PER_LANGUAGE = 2000
WORDS, GRAMS, LONGEST = 40_000, 40_000, 4
EVIDENCE = 12
SLICE = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20  # bits
_BOUNDARY = 32


@dataclass
class Table:
    """A hash table of keys; one whose slot is taken has the next free slot behind it."""

    slots: np.ndarray
    keys: np.ndarray
    logs: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        place = slot(keys)
        found = self.slots[place]
        left = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(left):
            place[left] = (place[left] + 1) & (len(self.slots) - 1)
            found[left] = self.slots[place[left]]
            left = left[(found[left] >= 0) & (self.keys[found[left]] != keys[left])]
        return found


@dataclass
class Model:
    languages: list[str]
    words: Table | None
    grams: list[Table]  # by length - 1


def slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _SLOTS)).astype(np.int64)


def letters() -> np.ndarray:
    """Of each code point its lower-case letter, 0 where it is none."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


_LETTERS: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(letters())
    return _LETTERS[0]


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_keys(cp: np.ndarray, n: int) -> np.ndarray:
    """A key for the n characters that end at each position from n - 1 on."""
    h = cp[: len(cp) - n + 1].astype(np.uint64) + np.uint64(n)
    for i in range(1, n):
        h = h * _BASE + cp[i : len(cp) - n + 1 + i]
    return h


def word_keys(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A key for the characters of each word: sum of character i times BASE^(length - i)."""
    longest = int((ends - starts).max(initial=1))
    h = np.zeros(len(starts), np.uint64)
    alive = np.arange(len(starts))
    for i in range(longest):
        alive = alive[starts[alive] + i < ends[alive]]
        h[alive] = (h[alive] + cp[starts[alive] + i]) * _BASE
        if len(alive) < 64 and i > 64:
            break
    for w in alive if longest > 65 else ():
        value = 0
        for c in cp[starts[w] : ends[w]].tolist():
            value = (value + c) * int(_BASE) & 0xFFFFFFFFFFFFFFFF
        h[w] = value
    return h


def table(names: list[str], counts: np.ndarray, key) -> Table:
    """``counts``: a row for each name, most frequent first, a column for each language."""
    keys = np.array([key(n) for n in names], np.uint64) if names else np.empty(0, np.uint64)
    slots = np.full(1 << _SLOTS, -1, np.int32)
    for i, at in enumerate(slot(keys).tolist()):
        while slots[at] >= 0:
            at = (at + 1) & (len(slots) - 1)
        slots[at] = i
    smooth = 0.1
    logs = np.log((counts + smooth) / (counts.sum(axis=0) + smooth * max(1, len(names)))) if names else np.zeros((1, counts.shape[1]))
    return Table(slots, keys if len(keys) else np.zeros(1, np.uint64), logs.astype(np.float32))


def word_key(word: str) -> int:
    cp = np.array([ord(c) for c in word], np.uint32)
    return int(word_keys(cp, np.array([0]), np.array([len(cp)]))[0])


def gram_key(gram: str) -> int:
    return int(gram_keys(np.array([ord(c) for c in gram], np.uint32), len(gram))[0])


def fit(docs: DataFrame, *, rows_per_language: int = ROWS_PER_LANGUAGE, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST) -> Model:
    small_batches(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where(
        "doc_id is not null and lang is not null and text is not null"
    ).where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], None, [])
    number = {name: i for i, name in enumerate(languages)}
    # The share of a language's rows that the bound allows, of a hash spread evenly over 0 ... 10^9.
    # A row for each language: the model has far more of each, and it goes to every task.
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, rows_per_language / n)) for name, n in counts.items()], "counted string, share double")
    chosen = known.join(F.broadcast(shares), F.col("lang") == F.col("counted"))
    rows = written(
        chosen.where(F.pmod(F.xxhash64("doc_id"), F.lit(10**9)) < F.col("share") * 10**9)
        .select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
        .where("w <> ''")
        .groupBy("lang", "w")
        .agg(F.count("*").alias("n")),
        "language-words",
    )

    def top(frame: DataFrame, column: str, limit: int) -> tuple[list[str], np.ndarray]:
        """The most frequent values, and a row of counts by language for each."""
        best = frame.groupBy(column).agg(F.sum("n").alias("n_all")).orderBy(F.desc("n_all"), column).limit(limit)
        of = best.join(frame, column).groupBy(column, "n_all").agg(F.collect_list(F.struct("lang", "n")).alias("by")).collect()
        of.sort(key=lambda r: (-r["n_all"], r[column].encode()))
        matrix = np.zeros((len(of), len(languages)))
        for i, r in enumerate(of):
            for lang, n in r["by"]:
                matrix[i, number[lang]] = n
        return [r[column] for r in of], matrix

    found = table(*top(rows, "w", words), word_key)
    each = F.expr(
        f"explode(flatten(transform(sequence(1, length(w)), i -> transform(sequence(1, least({longest}, i + 1)), n -> substring(concat(' ', w), i + 2 - n, n)))))"
    )
    parts = rows.select("lang", F.lit(1).alias("n"), each.alias("g")).groupBy("lang", "g").agg(F.sum("n").alias("n"))
    tables = [table(*top(parts.where(F.length("g") == n), "g", grams), gram_key) for n in range(1, longest + 1)]
    return Model(languages, found, tables)


def sums(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the log frequencies by language, the units that gave them, and whether it has a letter."""
    n_lang = len(model.languages)
    out, units = np.zeros((len(texts), n_lang)), np.zeros(len(texts))
    joined = " " + " ".join(texts) + " "
    cp = letter_table()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    ends_of_text = np.cumsum([len(t) + 1 for t in texts]) + 1
    inside = cp > 0
    edge = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    text = np.searchsorted(ends_of_text, starts, side="right")
    has_letter = np.bincount(text, minlength=len(texts)) > 0
    if not len(starts) or model.words is None:
        return out, units, has_letter
    cp[~inside] = _BOUNDARY
    at = model.words.find(word_keys(cp, starts, ends))

    def add(rows: np.ndarray, t: np.ndarray, logs: np.ndarray) -> None:
        for language in range(n_lang):
            out[:, language] += np.bincount(t, logs[rows, language], len(texts))
        np.add(units, np.bincount(t, minlength=len(texts)), out=units)

    known = at >= 0
    add(at[known], text[known], model.words.logs)
    # The letters of the other words.
    starts, ends, text = starts[~known], ends[~known], text[~known]
    sizes = ends - starts
    if not len(starts):
        return out, units, has_letter
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[word]
    weight = 1 / np.maximum(sizes, 1)
    for n in range(len(model.grams), 0, -1):
        ok = place - (n - 1) >= starts[word] - 1
        keys = np.zeros(len(place), np.uint64)
        keys[ok] = gram_keys(cp, n)[place[ok] - (n - 1)]
        found = np.where(ok, model.grams[n - 1].find(keys), -1)
        hit = found >= 0
        t = text[word[hit]]
        for language in range(n_lang):
            out[:, language] += np.bincount(t, model.grams[n - 1].logs[found[hit], language], len(texts))
        np.add(units, np.bincount(t, weight[word[hit]], len(texts)), out=units)
        word, place = word[~hit], place[~hit]
    return out, units, has_letter


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, "und"], object)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            at = 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and (to == at or held + len(texts[to]) <= SLICE):
                    held += len(texts[to])
                    to += 1
                total, units, has = sums(m, texts[at:to])
                if m.languages:
                    evidence = total * (np.minimum(units, EVIDENCE) / np.maximum(units, 1e-9))[:, None]
                    share = np.exp(evidence - evidence.max(axis=1, keepdims=True))
                    best = np.where(has, total.argmax(axis=1), len(m.languages))
                    score = np.where(has, share.max(axis=1) / share.sum(axis=1), 0.0)
                else:
                    best, score = np.zeros(to - at, np.int64), np.zeros(to - at)
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])
                at = to

    return ids_and_texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
