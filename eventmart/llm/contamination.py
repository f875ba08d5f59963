"""Benchmark decontamination with a suffix automaton of the test items.

1. Test items are normalised to words and dealt to blocks of about ``BLOCK_WORDS`` words
   (an item of more than ``PART_WORDS`` falls into overlapping parts, so that each window
   lies in one).  Block sizes are checked; blocks are made more until all are small.
2. Of each block a generalised suffix automaton is built: its states are the items'
   contiguous word sequences, its suffix links the longest suffix that leads elsewhere.
   Every state knows the window that its last ``window`` words are, and the items with it.
3. All documents stream through each block's automaton, one block after the other, and
   keep the longest match that ends at each word.  Where it reaches the window's length
   - or is a whole shorter item - the window's words are hit.

Most words need no step: a match of two words or more consists of word pairs that the
items have.  The pairs' hashes set bits of a table; words are only walked through the
automaton in stretches of such pairs that can hold the shortest window, by their bytes
and not their hashes.

Null and empty texts have no words; an item without words has no window, one without an
id counts under the empty id, items that repeat an id are one item.  Rows that repeat a
doc_id are documents of their own.  An empty benchmark hits nothing, an empty table of
documents gives no row.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import written

#: Words of a block of items, about, and of a part of an item, at most.
BLOCK_WORDS, PART_WORDS = 1 << 17, 1 << 14
#: Bits of the table of word pairs.
PAIR_BITS = 22

_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# ---- the items --------------------------------------------------------------

def parts(benchmark: DataFrame, window: int) -> DataFrame:
    """item, words: the items' word sequences, long ones in overlapping parts, each once."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.regexp_extract_all(lower, F.lit(_PATTERN), F.lit(0)).alias("all"))
    step = PART_WORDS - window + 1
    starts = F.expr(f"filter(sequence(0, size(all), {step}), s -> s = 0 or s + {window} <= size(all))")
    cut = items.where(F.size("all") > 0).withColumn("start", F.explode(starts))
    return cut.select("item", F.expr(f"slice(all, start + 1, {PART_WORDS})").alias("words")).distinct()


def blocks(benchmark: DataFrame, window: int) -> Iterator[list[tuple[str, list[str]]]]:
    """The items' parts, block by block, none of more than twice ``BLOCK_WORDS`` words."""
    found = written(parts(benchmark, window), "benchmark-parts")
    total = found.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_WORDS))
    while total:
        dealt = found.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n)))
        if dealt.groupBy("block").agg(F.sum(F.size("words")).alias("size")).agg(F.max("size")).first()[0] <= 2 * BLOCK_WORDS:
            break
        n *= 2
    for block in range(n if total else 0):
        yield [(r["item"], list(r["words"])) for r in dealt.where(F.col("block") == block).orderBy("item", "words").collect()]


# ---- the automaton ----------------------------------------------------------

class Automaton:
    """Suffix automaton of a block's items, with the windows that its states end in."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        sequences = [[self.ids.setdefault(w.encode(), len(self.ids)) for w in words] for _, words in items]
        self.size = max(len(self.ids), 1)
        self.length, self.link = [0], [-1]
        steps: list[dict[int, int]] = [{}]
        for sequence in sequences:
            last = 0
            for w in sequence:
                last = self._extend(steps, last, w)
        self.steps = {s * self.size + w: t for s, out in enumerate(steps) for w, t in out.items()}
        self._windows([name for name, _ in items], sequences)
        self._pairs(sequences)

    def _extend(self, steps: list[dict[int, int]], last: int, w: int) -> int:
        """The state of the sequence that ``last`` stands for with ``w`` behind it."""
        length, link = self.length, self.link
        if (known := steps[last].get(w)) is not None:
            return known if length[known] == length[last] + 1 else self._split(steps, last, w, known)
        new = self._state(steps, length[last] + 1, {}, 0)
        at = last
        while at >= 0 and w not in steps[at]:
            steps[at][w] = new
            at = link[at]
        if at >= 0:
            there = steps[at][w]
            link[new] = there if length[there] == length[at] + 1 else self._split(steps, at, w, there)
        return new

    def _state(self, steps: list[dict[int, int]], length: int, out: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        steps.append(out)
        return len(steps) - 1

    def _split(self, steps: list[dict[int, int]], at: int, w: int, there: int) -> int:
        """A state of its own for the shorter sequences of ``there``, from ``at`` by ``w``."""
        copy = self._state(steps, self.length[at] + 1, dict(steps[there]), self.link[there])
        self.link[there] = copy
        while at >= 0 and steps[at].get(w) == there:
            steps[at][w] = copy
            at = self.link[at]
        return copy

    def _windows(self, names: list[str], sequences: list[list[int]]) -> None:
        """Which window a state's last words are; windows' items; whole short items at a state."""
        window, length, link = self.window, self.length, self.link
        order = sorted(range(len(length)), key=length.__getitem__)
        self.ends = [-1] * len(length)
        for s in order[1:]:
            if length[s] >= window:
                self.ends[s] = s if length[link[s]] < window else self.ends[link[s]]
        found: dict[int, set[str]] = {}
        whole: dict[int, dict[int, set[str]]] = {}
        for name, sequence in zip(names, sequences, strict=True):
            at = 0
            for i, w in enumerate(sequence):
                at = self.steps[at * self.size + w]
                if i + 1 >= window:
                    found.setdefault(self.ends[at], set()).add(name)
            if len(sequence) < window:
                whole.setdefault(at, {}).setdefault(len(sequence), set()).add(name)
        self.items = {s: tuple(sorted(n)) for s, n in found.items()}
        # Of each state: lengths and items of the whole short items that are its suffixes.
        self.short: dict[int, tuple[tuple[int, tuple[str, ...]], ...]] = {}
        for s in order[1:] if whole else ():
            own = tuple((k, tuple(sorted(n))) for k, n in sorted(whole.get(s, {}).items()))
            if all_ := self.short.get(link[s], ()) + own:
                self.short[s] = all_
        self.shortest = min([window, *(k for lengths in whole.values() for k in lengths)])

    def _pairs(self, sequences: list[list[int]]) -> None:
        """Tables of the hashes of words and of word pairs."""
        text = list(self.ids)
        data, lengths = np.frombuffer(b"".join(text), np.uint8), np.array([len(w) for w in text], np.int64)
        ends = np.cumsum(lengths)
        starts, found, at = ends - lengths, [], 0
        while at < len(starts):
            upto = max(int(np.searchsorted(ends, starts[at] + W.SLICE, "right")), at + 1)
            found.append(W.hashes(data, starts[at:upto], ends[at:upto]))
            at = upto
        hashed = np.concatenate(found) if found else np.zeros(0, np.uint64)
        self.single, self.pair = np.zeros(2**PAIR_BITS, bool), np.zeros(2**PAIR_BITS, bool)
        self.single[places(hashed)] = True
        for sequence in sequences:
            h = hashed[sequence]
            self.pair[places(W.joined(h[:-1], h[1:]))] = True

    def walk(self, ids: list[int]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, word behind the last, items) of every window in a stretch of word ids."""
        steps, link, length, size, window, ends, short = self.steps, self.link, self.length, self.size, self.window, self.ends, self.short
        at = matched = 0
        for i, w in enumerate(ids):
            to = steps.get(at * size + w) if w >= 0 else None
            while to is None and at and w >= 0:
                at = link[at]
                matched = length[at]
                to = steps.get(at * size + w)
            if to is None:
                at = matched = 0
                continue
            at, matched = to, matched + 1
            if matched >= window:
                yield i + 1 - window, i + 1, self.items[ends[at]]
            for k, items in short.get(at, ()):
                if k <= matched:
                    yield i + 1 - k, i + 1, items


def places(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def stretches(automaton: Automaton, texts: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of words, within a text, that may hold a window."""
    known = automaton.single[places(hashed)]
    linked = known[:-1] & known[1:] & (texts[1:] == texts[:-1])
    at = np.flatnonzero(linked)
    linked[at] = automaton.pair[places(W.joined(hashed[at], hashed[at + 1]))]
    starts, ends = W.runs(linked)
    ends = ends + 1
    if automaton.shortest == 1:
        alone = known.copy()
        for k in (0, 1):
            alone[np.flatnonzero(linked) + k] = False
        more = np.flatnonzero(alone)
        starts, ends = np.concatenate((starts, more)), np.concatenate((ends, more + 1))
    enough = ends - starts >= automaton.shortest
    return starts[enough], ends[enough]


# ---- the operator -----------------------------------------------------------

def scanned(docs: DataFrame, automaton: Broadcast) -> DataFrame:
    """doc_id, text, n_words, hits (places of hit words' runs, in words: start, end, ...),
    spans (the same in bytes) and items, with those of this block added to those before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: Automaton = automaton.value
        for batch in batches:
            data, offsets = W.buffers(batch.column(1))
            before = {i: (h, it) for i, (h, it) in enumerate(zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)) if h}
            counts, hit, spans, items = [], [], [], []
            for first, last in W.groups(offsets):
                low, ends_of = int(offsets[first]), offsets[first : last + 1]
                part = _FORM[data[low : int(ends_of[-1])]]
                texts, starts, ends, hashed = W.words(part, _IN_WORD, ends_of - low)
                firsts = np.searchsorted(texts, np.arange(last - first + 1))
                found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
                for a, b in zip(*stretches(auto, texts, hashed), strict=True):
                    ids = [auto.ids.get(part[s:e].tobytes(), -1) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                    doc = int(texts[a])
                    base = int(a) - int(firsts[doc])
                    for s, e, names in auto.walk(ids):
                        places_, all_ = found.setdefault(doc, ([], set()))
                        if places_ and s + base <= places_[-1][1] and s + base >= places_[-1][0]:
                            places_[-1] = (places_[-1][0], max(e + base, places_[-1][1]))
                        else:
                            places_.append((s + base, e + base))
                        all_.update(names)
                counts += np.diff(firsts).tolist()
                for doc in range(last - first):
                    own, names = found.get(doc, ([], set()))
                    old, old_names = before.get(first + doc, ([], []))
                    runs_ = merged(own + list(zip(old[::2], old[1::2], strict=True)))
                    hit.append([p for r in runs_ for p in r])
                    zero = int(ends_of[doc]) - low
                    spans.append([int(x) - zero for s, e in runs_ for x in (starts[firsts[doc] + s], ends[firsts[doc] + e - 1])])
                    items.append(sorted(names | set(old_names)))
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
            made = [pa.array(c, k) for c, k in zip((counts, hit, spans, items), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["doc_id", "text", "n_words", "hits", "spans", "items"])

    return docs.mapInArrow(run, _SCHEMA)


#: Ends less starts: the places' sum with alternating signs, as their number is even.
_HIT = "aggregate(hits, 0L, (t, p) -> p - t)"
_SCHEMA = "doc_id long, text string, n_words long, hits array<long>, spans array<long>, items array<string>"


def merged(places_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(places_):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """Per document: doc_id, text, n_words, hits, spans, items (see :func:`scanned`)."""
    spark = docs.sparkSession
    empty = F.array().cast("array<long>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"), empty.alias("hits"), empty.alias("spans"), F.array().cast("array<string>").alias("items"))
    blocks_ = blocks(benchmark, window)
    out = scanned(rows, spark.sparkContext.broadcast(Automaton(next(blocks_, []), window)))
    for block in blocks_:
        # Written between blocks, so that a task never holds two automata.
        out = scanned(written(out, "scanned"), spark.sparkContext.broadcast(Automaton(block, window)))
    return out


def report(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.expr(_HIT)
    found = find(docs, benchmark, window=window)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, coverage: float = 0.5) -> DataFrame:
    """doc_id and text without the hit spans; documents with at least ``coverage`` of their
    words hit go.  A null text stays null."""
    found = find(docs, benchmark, window=window).withColumn("n_hit", F.expr(_HIT))
    kept = found.where(f"n_words = 0 or n_hit < {coverage} * n_words")
    # What stands between the spans, the text's start and its end.
    cuts = "concat(array(0L), spans, array(cast(octet_length(text) as bigint)))"
    between = "decode(substring(cast(text as binary), cast(cuts[2 * i] + 1 as int), cast(cuts[2 * i + 1] - cuts[2 * i] as int)), 'UTF-8')"
    clean = f"array_join(transform(sequence(0, size(spans) div 2), i -> {between}), '')"
    kept = kept.withColumn("cuts", F.expr(cuts))
    return kept.select("doc_id", F.expr(f"if(size(spans) = 0, text, {clean})").alias("text"))
