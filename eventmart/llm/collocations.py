"""Phrase collocations, counted on a prefix-free parse of the corpus.

1. Each document's words are parsed into chunks.  A chunk ends, and the next begins, at
   words whose hash (with their followers') is 0 modulo ``EVERY``, so equal passages fall
   into equal chunks wherever they stand.  Neighbouring chunks overlap by one word less
   than the longest phrase; a phrase belongs to the chunk in which it starts before the
   overlap, so each occurrence is counted once.
2. The dictionary of distinct chunks with their frequencies replaces the corpus: phrases
   are counted inside distinct chunks only, times the chunk's frequency.
3. A first pass counts words, and of longer phrases their hashes of 40 bits, which travel
   packed by buckets.  A phrase can be frequent only if its hash is.  The frequent hashes
   set bits of a table of fixed size (``FILTER_BITS``, 8 MB, whatever the corpus; with few
   frequent phrases it lets little else through, with very many all of them), which every
   task gets.  It only saves work: phrases that come through in the second pass are
   counted by their words, exactly.
4. Scores take frequencies from the counted phrases by joins, in exact decimals.

Null texts count as empty and null groups as ``und``.  A document without words has no
chunk; rows that repeat a doc_id are documents of their own, as doc_id is not read.
Pieces and texts of any length are read whole; ties go by the phrase's bytes.  An empty
table has no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import words as W
from .common import partitions, written

#: Words of a chunk, on average.
EVERY = 32
FILTER_BITS = 26
#: Words of 64 bits of the table that are packed at once.
SEGMENT = 1 << 14
#: Bits of a 64-bit hash that are left out; keys and words that a task adds up before it hands them on.
KEY_SHIFT = np.uint64(24)
MOST_KEYS, MOST_WORDS = 1 << 21, 1 << 20
#: Rows of phrases that a task hands over at once.
ROWS = 1 << 16

_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[list(_BREAKS)] = ord("\n")
_FORM[list(_BLANKS)] = ord(" ")
_IN_WORD = np.ones(256, bool)
_IN_WORD[[ord("\n"), ord(" ")]] = False


def stretch_places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all bytes of the stretches, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow column of the stretches [start, end) of ``data``."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[stretch_places(starts, lengths)])])
    return made.cast(pa.binary()).cast(kind)


# ---- the parse --------------------------------------------------------------

def one_separator(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one byte after each: a line break where a piece or text ends, else a blank.

    Also the words' starts and ends there.
    """
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == ord("\n"), out=breaks[1:])
    last = np.ones(len(starts), bool)
    last[:-1] = (texts[1:] != texts[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])
    lengths = ends - starts + 1
    new_ends = np.cumsum(lengths)
    new_starts = new_ends - lengths
    out = np.empty(int(new_ends[-1]) if len(new_ends) else 0, np.uint8)
    places = np.arange(len(out)) + np.repeat(starts - new_starts, lengths)
    out[:] = data[np.minimum(places, len(data) - 1)]
    out[new_ends - 1] = np.where(last, ord("\n"), ord(" "))
    return out, new_starts, new_ends - 1


def chunks(docs: DataFrame, group: str, longest: int) -> DataFrame:
    """group, chunk, closed: the chunks of all documents, repeats included.

    Words are lower-cased (A-Z).  A line break stands after the last word of a piece.
    ``closed``: the document ends with this chunk, so all its phrases are its own.
    """
    over = longest - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.buffers(batch.column(1))
            for first, last in W.groups(offsets):
                low, high = int(offsets[first]), int(offsets[last])
                part = _FORM[data[low:high]]
                texts, starts, ends, hashed = W.words(part, _IN_WORD, offsets[first : last + 1] - low)
                n = len(starts)
                if not n:
                    continue
                out, starts, ends = one_separator(part, starts, ends, texts)
                # Words left in the text, this one included.
                text_end = np.searchsorted(texts, texts, "right")
                ahead = text_end - np.arange(n)
                window = hashed.copy()
                for k in range(1, min(over, n)):
                    window[: n - k] = W.joined(window[: n - k], hashed[k:])
                opens = (window % np.uint64(EVERY) == 0) & (ahead > over)
                opens |= np.concatenate(([True], texts[1:] != texts[:-1]))
                at = np.flatnonzero(opens)
                upto = np.minimum(np.append(at[1:], n) + over, text_end[at])
                closed = np.append(at[1:], n) >= text_end[at]
                chunk = gathered(out, starts[at], ends[upto - 1] + 1, pa.string())
                group_ = batch.column(0).slice(first, last - first).take(pa.array(texts[at]))
                yield pa.RecordBatch.from_arrays([group_, chunk, pa.array(closed)], names=["grp", "chunk", "closed"])

    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.col("text").alias("body"))
    return rows.mapInArrow(run, "grp string, chunk string, closed boolean")


def dictionary(docs: DataFrame, group: str = "lang", longest: int = 3) -> DataFrame:
    """The distinct chunks of each group with their frequencies."""
    return chunks(docs, group, longest).groupBy("grp", "chunk", "closed").agg(F.count("*").alias("times"))


# ---- counting ---------------------------------------------------------------

def bits_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a key in the table of frequent phrases."""
    low = np.uint64(2**FILTER_BITS - 1)
    return (keys & low).astype(np.int64), ((keys * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def group_hash(names: pa.Array) -> np.ndarray:
    """A hash of each name; equal names have equal ones."""
    data, offsets = W.buffers(names)
    return np.array([W.hashes(data, offsets[i : i + 1], offsets[i + 1 : i + 2])[0] if offsets[i + 1] > offsets[i] else 1 for i in range(len(names))], np.uint64)


@dataclass
class Slice:
    """The words of some chunks of a batch (grp, chunk, closed, times)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashed: np.ndarray
    rows: np.ndarray  # the chunk of each word, by its row in the batch
    group: np.ndarray  # hash of the chunk's group
    mine: np.ndarray  # whether a phrase that starts here is the chunk's own
    goes_on: np.ndarray  # whether the next word is of the same piece and chunk

    def begins(self, n: int) -> np.ndarray:
        """The words with which the chunks' phrases of ``n`` words begin."""
        ok = self.mine.copy()
        for k in range(n - 1):
            ok[: len(ok) - k] &= self.goes_on[k:]
            ok[len(ok) - k :] = False
        return np.flatnonzero(ok)

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the group and the ``n`` words from each place on."""
        key = W.joined(self.group[at], self.hashed[at])
        for k in range(1, n):
            key = W.joined(key, self.hashed[at + k])
        return key


def slices(batch: pa.RecordBatch, longest: int) -> Iterator[Slice]:
    if not batch.num_rows:
        return
    names = batch.column(0).dictionary_encode()
    own = group_hash(names.dictionary)[names.indices.to_numpy()]
    data, offsets = W.buffers(batch.column(1))
    closed = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
    for first, last in W.groups(offsets):
        low, ends_of = int(offsets[first]), offsets[first : last + 1]
        part = data[low : int(ends_of[-1])]
        texts, starts, ends, hashed = W.words(part, _IN_WORD, ends_of - low)
        goes_on = np.zeros(len(starts), bool)
        goes_on[:-1] = (part[ends[:-1]] == ord(" ")) & (texts[1:] == texts[:-1])
        behind = np.searchsorted(texts, texts, "right")
        mine = np.arange(len(starts)) < behind - np.where(closed[first:last][texts], 0, longest - 1)
        yield Slice(part, starts, ends, hashed, first + texts, own[first + texts], mine, goes_on)


class Known:
    """The broadcast table of frequent phrases."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def has(self, keys: np.ndarray) -> np.ndarray:
        a, b = bits_of(keys)
        return ((self.packed[a >> 3] >> (a & 7).astype(np.uint8)) & (self.packed[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def packed_bits(keys: DataFrame) -> np.ndarray:
    """The table that holds these keys (key): 2^FILTER_BITS bits, each key sets two.

    Tasks give places; an aggregate joins them to words of 64 bits, 2^FILTER_BITS / 64 at
    most, and these are packed in segments, so the driver gets the table's bytes and no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(bits_of(batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array(np.int64(1) << (place & 63))], names=["at", "bits"])

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words_ = np.zeros(SEGMENT, np.int64)
        words_[rows["at"].to_numpy(np.int64) % SEGMENT] = rows["bits"].to_numpy(np.int64)
        return pd.DataFrame({"segment": [key[0]], "words": [words_.tobytes()]})

    found = keys.select("key").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    segments = found.groupBy(F.floor(F.col("at") / SEGMENT).alias("segment")).applyInPandas(packed, "segment long, words binary")
    table = np.zeros(2**FILTER_BITS // 64, np.int64)
    for row in segments.collect():
        at = row["segment"] * SEGMENT
        table[at : at + SEGMENT] = np.frombuffer(row["words"], np.int64)
    return table.view(np.uint8)


def alike(data: np.ndarray, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray, times: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One phrase of each kind, and the sum of its kind's times.

    Kinds are found by ``keys``, hashes of group and phrase, and every member is compared
    with the one that stands for it, byte by byte; should two kinds share a key, all stay.
    """
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    opens = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    one = order[opens]
    others = np.ones(len(keys), bool)
    others[opens] = False
    member, its = order[others], np.repeat(one, np.diff(np.append(opens, len(keys))) - 1)
    same = (lengths[member] == lengths[its]).all() and (groups[member] == groups[its]).all()
    if same and (data[stretch_places(starts[member], lengths[member])] == data[stretch_places(starts[its], lengths[its])]).all():
        return one, np.add.reduceat(times[order], opens)
    return np.arange(len(keys)), times


def handed(batch: pa.RecordBatch, s: Slice, at: np.ndarray, n: int, times: np.ndarray) -> Iterator[tuple[pa.Array, ...]]:
    """grp, phrase and times of the phrases of ``n`` words from these places on."""
    for i in range(0, len(at), ROWS):
        some = at[i : i + ROWS]
        phrase = gathered(s.data, s.starts[some], s.ends[some + n - 1], pa.string())
        yield batch.column(0).take(pa.array(s.rows[some])), phrase, pa.array(times[i : i + ROWS])


class Tally:
    """What a task has counted so far: words by bucket, and hashes of longer phrases."""

    def __init__(self, buckets: int, least: int):
        self.buckets, self.least = buckets, least
        self.clear()

    def clear(self) -> None:
        self.words: list[dict[tuple[int, bytes], int]] = [{} for _ in range(self.buckets)]
        self.held = self.keys_held = 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add_words(self, s: Slice, times: np.ndarray, groups: np.ndarray) -> None:
        at = s.begins(1)
        if not len(at):
            return
        keys = s.keys(at, 1)
        kept, sums = alike(s.data, keys, s.starts[at], s.ends[at] - s.starts[at], times[s.rows[at]], groups[s.rows[at]])
        to = (keys[kept] & np.uint64(self.buckets - 1)).tolist()
        at = at[kept]
        raw = s.data.tobytes()
        for bucket, group, a, b, n in zip(to, groups[s.rows[at]].tolist(), s.starts[at].tolist(), s.ends[at].tolist(), sums.tolist(), strict=True):
            table, word = self.words[bucket], (group, raw[a:b])
            table[word] = table.get(word, 0) + n
        self.held += len(at)

    def add_keys(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(keys >> KEY_SHIFT)
        self.times.append(np.minimum(times, self.least).astype(np.int32))
        self.keys_held += len(keys)

    def full(self) -> bool:
        return self.held > MOST_WORDS or self.keys_held > MOST_KEYS

    def rows(self, names: list) -> pa.RecordBatch:
        """A row for each bucket and group: its words and their counts; one for its keys."""
        out: list[tuple] = []
        for bucket, table in enumerate(self.words):
            by_group: dict[int, list[tuple[bytes, int]]] = {}
            for (group, word), n in table.items():
                by_group.setdefault(group, []).append((word, n))
            for group, found in by_group.items():
                text, counts = zip(*found, strict=True)
                out.append((bucket, names[group], b"\n".join(text), np.array(counts, "<i8").tobytes()))
        if self.keys_held:
            keys, sums = summed(np.concatenate(self.keys), np.concatenate(self.times), self.least)
            to = (keys & np.uint64(self.buckets - 1)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(self.buckets + 1))
            for bucket in range(self.buckets):
                own = order[cuts[bucket] : cuts[bucket + 1]]
                if len(own):
                    out.append((bucket, None, packed_keys(keys[own]), sums[own].astype("<u4").tobytes()))
        self.clear()
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "grp", "found", "times"])


def summed(keys: np.ndarray, times: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and the sum of its times, ``least`` at most."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    opens = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[opens], np.minimum(np.add.reduceat(times[order], opens, dtype=np.int64), least) if len(keys) else times


def packed_keys(keys: np.ndarray) -> bytes:
    """Keys of 40 bits as five bytes each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def first_pass(chunk_table: DataFrame, longest: int, least: int) -> DataFrame:
    """grp, phrase, key, f: all words with their counts (key null), and the hashes of
    longer phrases that may occur ``least`` times (grp, phrase null)."""
    # Each bucket is put together by one task: as many as there are partitions.
    buckets = 1 << max(6, (partitions(chunk_table.sparkSession) - 1).bit_length())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, names, number = Tally(buckets, least), [], {}
        for batch in batches:
            times = batch.column(3).to_numpy(zero_copy_only=False)
            coded = batch.column(0).dictionary_encode()
            for name in coded.dictionary.to_pylist():
                if name not in number:
                    number[name] = len(names)
                    names.append(name)
            groups = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
            for s in slices(batch, longest):
                tally.add_words(s, times, groups)
                for n in range(2, longest + 1):
                    at = s.begins(n)
                    tally.add_keys(s.keys(at, n), times[s.rows[at]])
                if tally.full():
                    yield tally.rows(names)
        yield tally.rows(names)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        tables: dict[str, dict[bytes, int]] = {}
        keys, times = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for group, found, counts in zip(rows["grp"], rows["found"], rows["times"], strict=True):
            if group is None:
                keys.append(unpacked_keys(found))
                times.append(np.frombuffer(counts, "<u4").astype(np.int64))
                continue
            table = tables.setdefault(group, {})
            for word, n in zip(found.split(b"\n"), np.frombuffer(counts, "<i8").tolist(), strict=True):
                table[word] = table.get(word, 0) + n
        often, sums = summed(np.concatenate(keys), np.concatenate(times), least)
        often = often[sums >= least]
        words_ = [(group, word.decode("utf-8", "replace"), n) for group, table in tables.items() for word, n in table.items()]
        made = pd.DataFrame(words_, columns=["grp", "phrase", "f"]).assign(key=None)
        hashes_ = pd.DataFrame({"grp": None, "phrase": None, "f": least, "key": pd.array(often.astype(np.int64), "Int64")})
        return pd.concat([x for x in (made, hashes_) if len(x)] or [made])[["grp", "phrase", "key", "f"]]

    sent = chunk_table.select("grp", "chunk", "closed", "times").mapInArrow(run, "bucket long, grp string, found binary, times binary")
    return sent.groupBy("bucket").applyInPandas(meet, "grp string, phrase string, key long, f long")


def second_pass(chunk_table: DataFrame, longest: int, keys: DataFrame) -> DataFrame:
    """grp, words, phrase, times: phrases of 2 words or more inside the distinct chunks, each
    where it starts, whose hash may be among ``keys``."""
    # 2^FILTER_BITS / 8 bytes, whatever the corpus.
    table = chunk_table.sparkSession.sparkContext.broadcast(packed_bits(keys))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(table.value)
        for batch in batches:
            times = batch.column(3).to_numpy(zero_copy_only=False)
            for s in slices(batch, longest):
                for n in range(2, longest + 1):
                    at = s.begins(n)
                    at = at[known.has(s.keys(at, n) >> KEY_SHIFT)]
                    for group, phrase, count in handed(batch, s, at, n, times[s.rows[at]]):
                        yield pa.RecordBatch.from_arrays([group, pa.array(np.full(len(count), n, np.int32)), phrase, count], names=["grp", "words", "phrase", "times"])

    return chunk_table.select("grp", "chunk", "closed", "times").mapInArrow(run, "grp string, words int, phrase string, times long")


def counted(chunk_table: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(sizes, frequent): words of each group (grp, n); phrases of 1 to ``longest`` words
    (grp, words, phrase, f) with f >= least."""
    first = written(first_pass(chunk_table, longest, least), "words")
    words_ = first.where(F.col("key").isNull())
    sizes = words_.groupBy("grp").agg(F.sum("f").alias("n"))
    sums = second_pass(chunk_table, longest, first.where(F.col("key").isNotNull())).groupBy("grp", "words", "phrase").agg(F.sum("times").alias("f"))
    longer = written(sums.where(F.col("f") >= least), "phrases")
    return sizes, words_.where(F.col("f") >= least).select("grp", F.lit(1).alias("words"), "phrase", "f").unionByName(longer)


# ---- scores -----------------------------------------------------------------

def mine(docs: DataFrame, *, group: str = "lang", longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each group: lang (the group), rank, phrase, a, l, r, n, score.

    a, l, r: occurrences of the phrase and of its two parts at its lowest-scoring cut; score:
    floor(10^6 a^2 / (l r)).  Phrases within a longer one that has ``share`` percent of
    their occurrences or more are left out.
    """
    table = written(dictionary(docs, group, longest), "chunks")
    sizes, frequent = counted(table, longest, least)
    found = frequent.where("words > 1").select("grp", "words", F.col("phrase"), F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    # All cuts of all candidates, then both parts' frequencies: parts of a frequent phrase are frequent.
    cuts = found.select("grp", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("grp", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("right"))
    part = lambda name, f: frequent.select(F.col("grp").alias(f"{name}_grp"), F.col("phrase").alias(name), F.col("f").alias(f))
    for name, f in (("left", "l"), ("right", "r")):
        side = part(f"{name}_part", f)
        cuts = cuts.join(side, (F.col("grp") == F.col(f"{name}_part_grp")) & (F.col(name) == F.col(f"{name}_part"))).drop(f"{name}_part_grp", f"{name}_part", name)
    scored = cuts.withColumn("score", F.expr("cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = scored.groupBy("grp", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The most frequent longer candidate around each phrase.
    inner = found.where("words > 2").select("grp", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")).alias("inside"))
    around = inner.groupBy(F.col("grp").alias("in_grp"), "inside").agg(F.max("a").alias("longer"))
    alone = best.join(around, (F.col("grp") == F.col("in_grp")) & (F.col("phrase") == F.col("inside")), "left").where(f"longer is null or 100 * longer < {share} * a")
    order = Window.partitionBy("grp").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = sizes.withColumnRenamed("grp", "size_grp")
    return ranked.join(sizes, F.col("grp") == F.col("size_grp")).select(
        F.col("grp").alias("lang"), "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("long").alias("score"))
