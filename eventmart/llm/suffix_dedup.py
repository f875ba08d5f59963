"""Removal of repeated passages through maximal repeats of an enhanced suffix array.

A byte goes when a ``window``-byte string that covers it also starts in a
document with a smaller doc_id.  Strings are judged on the input, never on what
is left, and never cross from one document into the next.

1. Blocks.  Documents are written as blocks of about ``BLOCK_BYTES``, compressed
   and bucketed by block, so that later steps meet them without another shuffle.
2. Keys.  The key of a window is the smallest hash of its ``GRAM``-byte grams;
   equal windows have equal keys.  Neighbouring windows mostly share theirs, so a
   block has about 2 / (window - GRAM + 2) keys a byte, and sends each once.  Only
   keys of two documents can belong to a repeated window.
3. Contexts.  A run of windows of one such key, as bytes, is a context.  Contexts
   of a key meet in one task, equal ones of a block as one.  A key with more than
   ``HOT`` contexts is dealt out by its windows' own contents instead, each window
   a context, equal ones of a block as one: no text pattern gathers in one task.
4. Suffix array.  Where a key has different contexts, the task sorts their
   suffixes, the keys of about ``PART_WINDOWS`` windows at a time, takes the common-prefix lengths of neighbours, and scans them with a
   stack.  Each interval of ``window`` bytes or more whose occurrences differ in
   the byte before them is a maximal repeat; it is returned with all occurrences.
   Every repeated window lies in a maximal repeat with the same occurrences (moved
   to the left), so the repeats cover what has to go and nothing else.
5. Spans return to their blocks, are merged and cut out.

Null and empty texts have no bytes and lose none; texts shorter than the window
lose none.  Rows that repeat a doc_id do not remove each other's text; rows
without a doc_id come after all others.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, partitions, scratch, small_batches

WINDOW = 50
GRAM = 16
BLOCK_BYTES = 1_000_000
#: Bytes of text whose keys and contexts one bucket holds, on average.
BUCKET_BYTES = 8_000_000
HOT = 2048
#: Windows of one context at most; longer runs (periodic texts) become several.
RUN = 128
#: Bytes hashed, and windows sorted, at a time: a task's arrays do not grow with its bucket.
PART_BYTES = 1 << 20
PART_WINDOWS = 1 << 17
_PAD = 40


# ---- keys -------------------------------------------------------------------

def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as big-endian numbers; needs 8 bytes of padding."""
    n = len(data) - 8
    out = np.empty(n, ">u8")
    raw = data.tobytes()
    for shift in range(8):
        part = np.frombuffer(raw, ">u8", count=(n - shift + 7) // 8, offset=shift)
        out[shift::8] = part
    return out.astype(np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position on; the last ones hash padding."""
    word = words_at(np.concatenate((data, np.zeros(16, np.uint8))))
    h = word[: len(data)] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += word[8 : len(data) + 8]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(30)
    return h


def window_keys(data: np.ndarray, window: int) -> np.ndarray:
    """For each position where a whole window fits the smallest gram hash in it."""
    h = gram_hashes(data)[: len(data) - GRAM + 1]
    width, have = window - GRAM + 1, 1
    while have * 2 <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    rest = width - have
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def runs(data: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: key, document (row of the block), first window and number of windows of each run."""
    empty = np.empty(0, np.int64)
    if len(data) < window:
        return np.empty(0, np.uint64), empty, empty, empty
    keys = window_keys(data, window)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    place = np.arange(len(keys))
    row = np.repeat(np.arange(len(lengths)), lengths)[: len(keys)]
    fits = place + window <= ends[row]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    new &= fits
    last = np.flatnonzero(new)
    if not len(last):
        return np.empty(0, np.uint64), empty, empty, empty
    # A run ends before the next one or where windows stop fitting.
    until = np.minimum(np.append(last[1:], len(keys)), ends[row[last]] - window + 1)
    n = until - last
    pieces = -(-n // RUN)
    if (pieces > 1).any():
        first = np.repeat(last, pieces)
        step = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        n = np.minimum(np.repeat(n, pieces) - step * RUN, RUN)
        last = first + step * RUN
    return keys[last], row[last], last - starts[row[last]], n


# ---- suffix array -----------------------------------------------------------

def suffix_array(data: np.ndarray, places: np.ndarray, before: np.ndarray, left: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the suffixes at ``places`` that can begin a maximal repeat, in
    order, and the common prefix of each with the one before it (under ``window``: 0).

    ``left`` is the number of bytes a suffix has, ``before`` the byte in front of
    it; ``data`` is padded at its end.  Suffixes are sorted by their first
    ``window`` bytes, eight at a time.  Those that agree on them and all follow the
    same byte begin no maximal repeat, so they are left out; the others are ordered
    by the bytes that follow.
    """
    word = words_at(np.concatenate((data, np.zeros(8, np.uint8))))
    keys = [word[places + at] for at in range(0, window - 7, 8)]
    if window % 8:
        keys.append(word[places + window - window % 8] >> np.uint64(64 - 8 * (window % 8)))
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), np.int64)
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    r = rank[order]
    first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.empty(0, np.int64)
    if not len(first):
        return first, first
    b = before[order]
    diverse = np.minimum.reduceat(b, first) != np.maximum.reduceat(b, first)
    keep = np.repeat(diverse, np.diff(np.append(first, len(r))))
    order, r = order[keep].tolist(), r[keep].tolist()
    tails = [data[p : p + k].tobytes() for p, k in zip((places[order] + window).tolist(), (left[order] - window).tolist(), strict=True)]
    put = sorted(range(len(order)), key=lambda x: (r[x], tails[x]))
    lcp = [0] * len(put)
    for i in range(1, len(put)):
        x, y = put[i - 1], put[i]
        if r[x] == r[y]:
            lcp[i] = window + common(tails[x], tails[y])
    return np.array([order[x] for x in put], np.int64), np.array(lcp, np.int64)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        half = (low + n) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            n = half
    return low


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, before: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, end): each maximal repeat with all its occurrences, order[first:end].

    ``before`` is the byte before each suffix, or a number of its own where there
    is none.  The stack holds the open intervals of the common-prefix tree: length,
    first suffix, and the byte before all suffixes seen so far (-1: they differ).
    """
    lefts = before[order].tolist()
    lengths = [*lcp.tolist(), 0]
    stack: list[list[int]] = []
    for i in range(1, len(lengths)):
        now, start, mark = lengths[i], i - 1, lefts[i - 1]
        while stack and stack[-1][0] > now:
            length, start, own = stack.pop()
            mark = own if own == mark else -1
            if mark == -1:
                yield length, start, i
        if now >= window:
            if stack and stack[-1][0] == now:
                stack[-1][2] = mark if stack[-1][2] == mark else -1
            else:
                stack.append([now, start, mark])


def context_keys(contexts: list[bytes]) -> np.ndarray:
    """The smallest gram hash of each context, ``PART_BYTES`` of text at a time."""
    sizes = np.array([len(c) + _PAD for c in contexts], np.int64)
    part = (np.cumsum(sizes) - sizes) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(contexts)]
    out = []
    for a, b in itertools.pairwise(cuts):
        data = np.frombuffer(b"".join(c + bytes(_PAD) for c in contexts[a:b]), np.uint8)
        ends = np.cumsum(sizes[a:b])
        h = gram_hashes(data)
        for back in range(GRAM - 1 + _PAD):
            h[ends - 1 - back] = np.iinfo(np.uint64).max
        out.append(np.minimum.reduceat(h, ends - sizes[a:b]))
    return np.concatenate(out)


def repeated_spans(contexts: list[bytes], docs: np.ndarray, window: int) -> np.ndarray:
    """(context, start, end), sorted: of the distinct ``contexts`` the byte ranges that repeat in one with a smaller doc.

    Contexts of one key meet in one suffix array; one array holds about
    ``PART_WINDOWS`` windows, or those of a single key.
    """
    if not contexts:
        return np.empty((0, 3), np.int64)
    # Only contexts that share their key with another one can have a window in common
    # with it, and of two that are single windows neither has the other's.
    keys = context_keys(contexts)
    windows = np.array([len(c) for c in contexts], np.int64) - window + 1
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    count = np.diff(np.append(first, len(order)))
    many = (count > 1) & (np.maximum.reduceat(windows[order], first) > 1)
    chosen = order[np.repeat(many, count)]
    if not len(chosen):
        return np.empty((0, 3), np.int64)
    of_key = np.add.reduceat(windows[order], first)[many]
    part = np.repeat((np.cumsum(of_key) - of_key) // PART_WINDOWS, count[many])
    found = [spans_of(contexts, own, docs, window) for own in np.split(chosen, np.flatnonzero(np.diff(part)) + 1)]
    return np.array(merged(np.concatenate(found)), np.int64).reshape(-1, 3)


def spans_of(contexts: list[bytes], chosen: np.ndarray, docs: np.ndarray, window: int) -> np.ndarray:
    """(context, start, end) by one suffix array over the ``chosen`` contexts."""
    data = np.frombuffer(b"".join(contexts[c] + bytes(_PAD) for c in chosen.tolist()), np.uint8)
    sizes = np.array([len(contexts[c]) for c in chosen.tolist()], np.int64)
    starts = np.cumsum(sizes + _PAD) - sizes - _PAD
    windows = sizes - window + 1
    of = np.repeat(np.arange(len(chosen)), windows)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    places = starts[of] + offset
    before = np.where(offset > 0, data[places - 1].astype(np.int64), 256 + of)
    order, lcp = suffix_array(data, places, before, sizes[of] - offset, window)
    # Of each suffix the longest repeat that a smaller doc has too.
    doc = docs[chosen[of[order]]]
    longest = np.zeros(len(order), np.int64)
    for length, first, end in maximal_repeats(order, lcp, before, window):
        own = doc[first:end]
        part = longest[first:end]
        np.maximum(part, np.where(own > own.min(), length, 0), out=part)
    gone = np.flatnonzero(longest)
    return np.column_stack((chosen[of[order[gone]]], offset[order[gone]], offset[order[gone]] + longest[gone]))


# ---- steps ------------------------------------------------------------------

def packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = np.array([a.nbytes for a in arrays], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def unpacked(raw: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(raw)
    sizes = np.frombuffer(data, "<u4", len(kinds))
    ends = np.cumsum(sizes) + 4 * len(kinds)
    return [np.frombuffer(data[e - s : e], kind) for s, e, kind in zip(sizes.tolist(), ends.tolist(), kinds, strict=True)]


BLOCK_KINDS = ("<i8", "<i8", "u1")  # doc ids, lengths, bytes
CONTEXT_KINDS = ("u1", "<u4", "<u4", "<u4", "<u4", "<i8")  # bytes; lengths, occurrences of each; row, position, doc of each


def blocks(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """The documents as compressed blocks in a table bucketed by ``block``.

    ``carry``: a struct that goes with each document, in the column ``carried``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    carry = F.struct(F.lit(None).cast("boolean").alias("c0")) if carry is None else carry
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"), carry.alias("carried")
    )
    kind = texts.schema["carried"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        ids: list[int] = []
        held: list[bytes] = []
        carried: list[pa.Array] = []
        size = 0

        def block() -> pa.RecordBatch:
            data = packed(np.array(ids, "<i8"), np.array([len(t) for t in held], "<i8"), np.frombuffer(b"".join(held), np.uint8))
            rows = pa.ListArray.from_arrays([0, len(ids)], pa.concat_arrays(carried))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([data], pa.binary()), rows], names=["block", "bytes", "data", "carried"])

        for batch in batches:
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                raw = text.as_py()
                if held and size + len(raw) > BLOCK_BYTES:
                    yield block()
                    number, ids, held, carried, size = number + 1, [], [], [], 0
                ids.append(doc)
                carried.append(batch.column(2).slice(i, 1))
                held.append(raw)
                size += len(raw)
        if held:
            yield block()

    n = partitions(spark)
    name = f"llm_blocks_{uuid.uuid4().hex}"
    made = texts.mapInArrow(run, f"block long, bytes long, data binary, carried array<{kind}>").repartition(n, "block")
    made.write.bucketBy(n, "block").option("path", scratch(spark, "blocks")).option("compression", "none").saveAsTable(name)
    return spark.table(name)


def shared_keys(table: DataFrame, buckets: int, window: int) -> DataFrame:
    """block, found (binary): the block's keys that two documents have, and of those the hot ones."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, lengths, data = unpacked(raw.as_py(), *BLOCK_KINDS)
                keys, rows, _, _ = runs(data, lengths, window)
                order = np.argsort(keys, kind="stable")
                keys, rows = keys[order], rows[order]
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
                if not len(first):
                    continue
                count = np.diff(np.append(first, len(keys)))
                twice = rows[first] != rows[first + count - 1]
                mark = np.minimum(count, 127).astype(np.uint8) | (twice.astype(np.uint8) << 7)
                keys = keys[first]
                to = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cut = np.flatnonzero(np.diff(to[order], prepend=-1))
                parts = [(keys[o].tobytes(), mark[o].tobytes()) for o in np.split(order, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[order][cut]), pa.array([number] * len(parts)), pa.array([k for k, _ in parts], pa.binary()), pa.array([m for _, m in parts], pa.binary())],
                    names=["bucket", "block", "keys", "marks"],
                )

    def meet(rows):
        import pandas as pd

        sizes = [len(m) for m in rows["marks"]]
        keys = np.frombuffer(b"".join(rows["keys"]), np.uint64)
        marks = np.frombuffer(b"".join(rows["marks"]), np.uint8)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
        sent = np.diff(np.append(first, len(keys)))
        twice = (sent > 1) | (np.maximum.reduceat(marks[order], first) >= 128)
        hot = np.add.reduceat((marks[order] & 127).astype(np.int64), first) > HOT
        state = np.empty(len(keys), np.uint8)
        state[order] = np.repeat(twice.astype(np.uint8) + (twice & hot), sent)
        out = []
        for block, k, s in zip(rows["block"], np.split(keys, np.cumsum(sizes)[:-1]), np.split(state, np.cumsum(sizes)[:-1]), strict=True):
            if s.any():
                out.append((block, packed(k[s > 0], k[s > 1])))
        return pd.DataFrame(out, columns=["block", "found"])

    sent = table.select("block", "data").mapInArrow(send, "bucket long, block long, keys binary, marks binary")
    return sent.groupBy("bucket").applyInPandas(meet, "block long, found binary")


def contexts(table: DataFrame, keys: DataFrame, buckets: int, window: int) -> DataFrame:
    """bucket, block, contexts (binary): the runs of shared keys, equal ones of a block as one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw, replies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                ids, lengths, data = unpacked(raw.as_py(), *BLOCK_KINDS)
                found = [unpacked(r, "<u8", "<u8") for r in replies.as_py()]
                shared, hot = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                keys, rows, at, n = runs(data, lengths, window)
                here = np.isin(keys, shared)
                keys, rows, at, n = keys[here], rows[here], at[here], n[here]
                if len(hot) and (burst := np.isin(keys, hot)).any():
                    # Each window a context of its own, dealt by its content.
                    times = np.where(burst, n, 1)
                    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    single = np.repeat(burst, times)
                    keys, rows, at = np.repeat(keys, times), np.repeat(rows, times), np.repeat(at, times) + step
                    n = np.where(single, 1, np.repeat(n, times))
                else:
                    single = np.zeros(len(keys), bool)
                starts = (np.cumsum(lengths) - lengths)[rows] + at
                text = data.tobytes()
                place: dict[bytes, list[int]] = {}
                for i, (a, b) in enumerate(zip(starts.tolist(), (starts + n + window - 1).tolist(), strict=True)):
                    place.setdefault(text[a:b], []).append(i)
                groups: dict[int, list[bytes]] = {}
                for context, own in place.items():
                    i = own[0]
                    to = int.from_bytes(hashlib.blake2b(context, digest_size=8).digest(), "little") if single[i] else int(keys[i])
                    groups.setdefault(to % buckets, []).append(context)
                payloads = []
                for group in groups.values():
                    own = np.array([i for c in group for i in place[c]], np.int64)
                    payloads.append(packed(
                        np.frombuffer(b"".join(group), np.uint8), np.array([len(c) for c in group], "<u4"), np.array([len(place[c]) for c in group], "<u4"),
                        rows[own].astype("<u4"), at[own].astype("<u4"), ids[rows[own]],
                    ))
                if groups:
                    yield pa.RecordBatch.from_arrays([pa.array(list(groups)), pa.array([number] * len(groups)), pa.array(payloads, pa.binary())], names=["bucket", "block", "contexts"])

    replies = keys.groupBy("block").agg(F.collect_list("found").alias("found"))
    return table.select("block", "data").join(replies, "block").mapInArrow(run, "bucket long, block long, contexts binary")


def spans(sent: DataFrame, window: int) -> DataFrame:
    """block, spans (binary): row, start and end of what has to go."""

    def meet(rows):
        import pandas as pd

        number: dict[bytes, int] = {}
        held, lows = [], []
        for block, raw in zip(rows["block"], rows["contexts"], strict=True):
            text, sizes, times, row, at, doc = unpacked(raw, *CONTEXT_KINDS)
            text, ends = text.tobytes(), np.cumsum(sizes).tolist()
            own = np.array([number.setdefault(text[e - s : e], len(number)) for s, e in zip(sizes.tolist(), ends, strict=True)], np.int64)
            lows.append((own, np.minimum.reduceat(doc, np.cumsum(times, dtype=np.int64) - times)))
            held.append((block, own, times, row, at, doc))
        all_contexts = list(number)
        number.clear()
        sizes = np.array([len(c) for c in all_contexts], np.int64)
        least = np.full(len(all_contexts), NULL_ID)
        for own, low in lows:
            np.minimum.at(least, own, low)
        ranges = repeated_spans(all_contexts, least, window)
        start = np.searchsorted(ranges[:, 0], np.arange(len(all_contexts) + 1))
        out = []
        for block, own, times, row, at, doc in held:
            context = np.repeat(own, times)
            whole = doc > least[context]
            # What occurs first keeps all but what its ranges name.
            n = np.where(whole, 1, start[context + 1] - start[context])
            of = np.repeat(np.arange(len(n)), n)
            if not len(of):
                continue
            context, whole = context[of], whole[of]
            a, b = np.zeros(len(of), np.int64), sizes[context]
            part = (start[context] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))[~whole]
            a[~whole], b[~whole] = ranges[part, 1], ranges[part, 2]
            out.append((block, packed(np.column_stack((row[of], at[of] + a, at[of] + b)).astype("<u4"))))
        return pd.DataFrame(out, columns=["block", "spans"])

    return sent.groupBy("bucket").applyInPandas(meet, "block long, spans binary")


def merged(gone: np.ndarray) -> list[tuple[int, int, int]]:
    """Sorted (row, start, end) without overlaps or touching ranges."""
    out: list[tuple[int, int, int]] = []
    for row, a, b in gone[np.lexsort((gone[:, 1], gone[:, 0]))].tolist():
        if out and out[-1][0] == row and a <= out[-1][2]:
            out[-1] = (row, out[-1][1], max(out[-1][2], b))
        else:
            out.append((row, a, b))
    return out


def with_cuts(docs: DataFrame, window: int, carry: Column | None = None) -> DataFrame:
    """data, carried, spans: every block with what has to go from it."""
    if window < GRAM or window > RUN:
        raise ValueError(f"window must be between {GRAM} and {RUN} bytes")
    spark = docs.sparkSession
    table = blocks(docs, carry)
    total = table.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(partitions(spark), -(-total // BUCKET_BYTES))
    small_batches(spark, 16)
    gone = spans(contexts(table, shared_keys(table, buckets, window), buckets, window), window)
    per_block = gone.groupBy("block").agg(F.collect_list("spans").alias("spans"))
    return table.select("block", "data", "carried").join(per_block, "block", "left").select("data", "carried", "spans")


def cut(raw: bytes, replies: list[bytes] | None) -> Iterator[tuple[int, int, bytes, int]]:
    """Of each document of a block: id, bytes, what is kept, spans removed."""
    ids, lengths, data = unpacked(raw, *BLOCK_KINDS)
    found = [unpacked(r, "<u4")[0].reshape(-1, 3) for r in replies or []]
    cuts: dict[int, list[tuple[int, int]]] = {}
    for row, a, b in merged(np.concatenate(found).astype(np.int64)) if found else []:
        cuts.setdefault(row, []).append((a, b))
    text, start = data.tobytes(), 0
    for row, n in enumerate(lengths.tolist()):
        own, mine = text[start : start + n], cuts.get(row, [])
        kept = b"".join(own[x:y] for x, y in zip([0, *(b for _, b in mine)], [*(a for a, _ in mine), n], strict=True))
        yield int(ids[row]), n, kept, len(mine)
        start += n


def remove_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, replies in zip(batch.column(0), batch.column(1), strict=True):
                rows = [(None if doc == NULL_ID else doc, n, n - len(kept), spans_, hashlib.sha256(kept).hexdigest()) for doc, n, kept, spans_ in cut(raw.as_py(), replies.as_py())]
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_cuts(docs, window).select("data", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeats cut from ``text`` (bytes of a character cut in two go
    too; null texts stay null) and ``n_chars``, where there is one, counted anew."""
    columns = docs.columns
    others = [c for c in columns if c != "text"]
    carry = F.struct(docs["text"].isNotNull().alias("c"), *(docs[c].alias(f"c{i}") for i, c in enumerate(others)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(cut(batch.column(0)[i].as_py(), batch.column(2)[i].as_py()))
                texts = pa.array([kept.decode("utf-8", "ignore") for _, _, kept, _ in rows], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(1)[i].values, texts, pa.array([n for _, _, _, n in rows], pa.int64())], names=["carried", "text", "cuts"])

    fields = ", ".join(f"c{i}: {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(others))
    made = with_cuts(docs, window, carry).select("data", "carried", "spans").mapInArrow(run, f"carried struct<c: boolean{', ' if fields else ''}{fields}>, text string, cuts long")
    text = F.when(F.col("carried.c"), F.col("text"))

    def column(c: str):
        if c == "text":
            return text.alias(c)
        old = F.col("carried")[f"c{others.index(c)}"]
        if c == "n_chars":
            return F.when(F.col("cuts") > 0, F.char_length(text).cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)

    return made.select(*(column(c) for c in columns))
