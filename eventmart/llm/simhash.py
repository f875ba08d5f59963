"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprint: texts are lower-cased (A-Z only) and split at ASCII white space;
each shingle of ``shingle_words`` words, repeats included, is hashed with XXH64
(seed 42); a bit is 1 when it is set in over half of the hashes.  Fewer words
than that form one shingle; a text without words (null and empty ones too) has
the fingerprint zero, which links like any other.

Search: every fingerprint bit gets a non-zero vector of r + 1 bits.  Mask v
(one for each of the 2^(r+1) - 1 non-zero vectors) keeps the bits whose vector
has an odd inner product with v.  Two fingerprints that differ in at most r
bits span at most r dimensions, so some v is orthogonal to all of them: the two
agree on that mask and meet in that table.  No pair is missed.

* Equal fingerprints are one node before any table is built, so copies cost nothing.
* A bucket of more than ``BLOCK`` nodes is dealt out as pairs of blocks, each in
  a group of its own; every pair of nodes is still compared in exactly one group.
* A group returns a spanning path of what it linked, never its pairs.
* Components come from alternating star rounds over written tables.

Null doc_ids count as larger than every other id; rows that repeat a doc_id are
rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, ids_and_texts, small_batches, written

BLOCK = 2048
SEED = 42


# ---- fingerprints -----------------------------------------------------------

def shingle_hashes(text: str, shingle_words: int) -> list[int]:
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return []
    if n <= shingle_words:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle_words + 1].tolist()
    ends = ends[shingle_words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of ``hashes``; ``counts`` are the runs' lengths, all over 0."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    bits = np.zeros((len(counts), 64), np.int64)
    step = 65_536
    run = np.repeat(np.arange(len(counts)), counts)
    for at in range(0, len(hashes), step):
        piece = np.unpackbits(hashes[at : at + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = run[at], run[min(at + step, len(hashes)) - 1]
        cut = np.maximum(starts[first : last + 1] - at, 0)
        bits[first : last + 1] += np.add.reduceat(piece, cut, axis=0, dtype=np.int64)
    over = (bits * 2 > counts[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) for each row of ``docs``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            held: list[np.ndarray] = []
            rows: list[int] = []

            def flush() -> None:
                if rows:
                    out[rows] = majority(np.concatenate(held), np.array([len(h) for h in held]))
                    held.clear()
                    rows.clear()

            size = 0
            for i in range(batch.num_rows):
                hashes = shingle_hashes(batch.column(1)[i].as_py(), shingle_words)
                if hashes:
                    held.append(np.array(hashes, np.uint64))
                    rows.append(i)
                    size += len(hashes)
                if size > 200_000:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, fp long")


# ---- covering tables --------------------------------------------------------

def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The 2^(radius+1) - 1 masks over 64 bits, as signed longs."""
    top = 2 ** (radius + 1) - 1
    vector = np.random.default_rng(seed).permutation(64) % top + 1
    masks = []
    for v in range(1, top + 1):
        value = sum(1 << bit for bit in range(64) if int(vector[bit] & v).bit_count() % 2)
        masks.append(value - 2**64 if value >= 2**63 else value)
    return masks


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component under the links a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        label = label[label]
        if np.array_equal(label, before):
            break
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    while not np.array_equal(label[label], label):
        label = label[label]
    return label


def links_within(group: np.ndarray, block: np.ndarray, fp: np.ndarray, across: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning path of the links inside each run of equal ``group`` numbers.

    Where ``across`` is true, only nodes of different blocks are compared: the
    others meet in the group of their own block.
    """
    edge = np.flatnonzero(np.diff(group)) + 1
    starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(group)]))
    lefts, rights = [], []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= radius
        near &= ~across[i] | (block[i] != block[j])
        lefts.append(i[near])
        rights.append(j[near])

    sizes = ends - starts
    small = sizes <= 64
    index = np.flatnonzero(np.repeat(small, sizes))
    for step in range(1, int(sizes[small].max(initial=1))):
        ahead = index[index + step < len(group)]
        ahead = ahead[group[ahead] == group[ahead + step]]
        keep(ahead, ahead + step)
        index = ahead
    for at, to in zip(starts[~small], ends[~small], strict=True):
        for i in range(at, to - 1):
            rest = np.arange(i + 1, to)
            keep(np.full(len(rest), i), rest)
    a, b = np.concatenate(lefts or [np.empty(0, np.int64)]), np.concatenate(rights or [np.empty(0, np.int64)])
    label = least_labels(len(group), a, b)
    order = np.argsort(label, kind="stable")
    same = label[order][1:] == label[order][:-1]
    return fp[order[:-1][same]], fp[order[1:][same]]


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) whose components are those of "differs in at most radius bits".

    ``nodes`` holds distinct fingerprints in column ``fp``.
    """
    small_batches(nodes.sparkSession, 10_000)
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(covering_masks(radius))))
    rows = nodes.select("fp", F.explode(tables).alias("e")).select("e.t", "e.key", "fp")
    full = rows.groupBy("t", "key").agg(F.count("*").alias("m")).where("m > 1")
    dealt = (
        rows.join(full, ["t", "key"])
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("t", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp")
    )
    keys = ["t", "key", "i", "j"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(table: pa.Table) -> pa.RecordBatch:
            cols = [table.column(c).to_numpy() for c in keys]
            new = np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in cols])))
            a, b = links_within(np.cumsum(new), table.column("block").to_numpy(), table.column("fp").to_numpy(), cols[2] != cols[3], radius)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            rest = now if rest is None else pa.concat_tables([rest, now])
            last = np.logical_and.reduce([(c := rest.column(k).to_numpy()) == c[-1] for k in keys])
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield found(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield found(rest)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


# ---- components -------------------------------------------------------------

def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; root is its component's smallest node.

    Alternating large-star and small-star rounds; each round is written.
    """
    def small(e: DataFrame) -> DataFrame:
        e = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    seen = None
    edges = written(edges.select("a", "b").where("a <> b"), "links")
    while True:
        edges = written(small(large(edges)), "stars")
        mark = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.max(F.xxhash64("b", "a")).alias("y")).first()
        if mark == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark


def near_duplicates(docs: DataFrame, *, shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    marked = written(fingerprints(docs, shingle_words), "simhash")
    nodes = marked.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("least"))
    star = stars(links(nodes.select("fp"), radius))
    placed = nodes.join(star, nodes.fp == star.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "placed")
    roots = placed.groupBy("root").agg(F.min("least").alias("component"))
    classes = placed.join(roots, "root").select(F.col("fp").alias("of"), "component")
    return marked.join(classes, F.col("fp") == F.col("of")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.nullif(F.col("component"), F.lit(NULL_ID)).alias("component_id"),
    )


def representatives(docs: DataFrame, *, shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the smallest doc_id.

    Of rows that repeat that id, all stay; rows without an id stay, as nothing names them.
    """
    classes = near_duplicates(docs, shingle_words=shingle_words, radius=radius)
    gone = classes.where("doc_id > component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
