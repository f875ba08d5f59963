"""Packing of documents into token sequences along a space-filling curve.

1. Each document's tokens are hashed into a few signed sums (a random projection
   of its token-count vector); their directions are cut to ``BITS`` bits a
   dimension and give its place on a Hilbert curve, so that documents with
   alike tokens lie near each other.
2. Documents are range-sorted by (place, doc_id).  A place that many documents
   share - copies, empty texts - is split among partitions by the id, and rows
   that share that too by a hash of their number in the written table.
3. Along each partition documents follow one another without a gap and are cut
   at every multiple of ``length``.  Only a partition's last sequence is short,
   which is all the padding there is.

Tokens are those of the byte-level BPE file; every document ends with ``end_id``
(null and empty texts consist of it).  Sequence ids are unique, not consecutive:
partition number * 2^40 + number within the partition.  Rows without a doc_id
or with a repeated one are documents of their own, ordered by their tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts, partitions, small_batches, written

DIMENSIONS = 4
BITS = 15

class Tokens:
    """Ids of texts as 16-bit little-endian bytes.

    The tokenizer file's vocabulary runs in the faster of two public libraries:
    merge ranks are the ids, and token bytes are read through the usual
    byte-level alphabet.  The vocabulary's splitting rule looks ahead only to
    tell the last of several white-space characters apart, so texts without two
    in a row take the rule without that look-ahead, which is twice as fast.
    Texts that hold a special token's string go through the file's own library.
    """

    def __init__(self, tokenizer_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        if self.tokenizer.get_vocab_size() > 2**16:
            raise ValueError("ids of this vocabulary take more than 16 bits")
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if token not in self.special}
        rule = public_tokenizers.PATTERN
        made = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.any_spaces, self.single_spaces = made("any", rule), made("single", rule.replace(r"\s+(?!\S)|", ""))
        for line, fast in ((" the quick\nbrown 12345 don't été!?\n日本語 \U0001f600 x\u200by", self.single_spaces), ("a  b \n\t c\r\n  ", self.any_spaces)):
            if fast(line) != self.whole(line):
                raise ValueError("the two libraries split this vocabulary's words in different ways")

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.whole(text)
        else:
            ids = (self.single_spaces if text.replace("\n", " ") == " ".join(text.split()) else self.any_spaces)(text)
        return np.array(ids, "<u2").tobytes()


# ---- places on the curve ----------------------------------------------------

def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of rows of non-negative integers below 2^bits.

    John Skilling's transposition (AIP Conf. Proc. 707, 2004), on all rows at once.
    """
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def directions(seed: int = 11) -> np.ndarray:
    """For each of 65,536 token ids a point of the projection: signs in each dimension."""
    return np.random.default_rng(seed).integers(0, 2, (2**16, DIMENSIONS)).astype(np.float32) * 2 - 1


def places(ids: list[bytes], table: np.ndarray) -> np.ndarray:
    """Hilbert keys of the documents with these token ids."""
    points = np.zeros((len(ids), DIMENSIONS), np.float32)
    for i, text in enumerate(ids):
        if text:
            sums = table[np.frombuffer(text, "<u2")].sum(axis=0, dtype=np.float64)
            points[i] = sums / (len(text) / 2)
    top = 2**BITS - 1
    cells = np.clip((points * 4 + 1) / 2, 0, 1) * top
    return hilbert_keys(cells.astype(np.int64), BITS)


# ---- the operator -----------------------------------------------------------

def tokenised(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """doc_id, place, ids (16-bit little-endian, end_id last)."""
    end = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, table = Tokens(tokenizer_file), directions()
        for batch in batches:
            ids = [tokens.encode(text.as_py()) for text in batch.column(1)]
            out = [pa.array(places(ids, table)), pa.array([x + end for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], names=["doc_id", "place", "ids"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, place long, ids binary")


def pack(docs: DataFrame, tokenizer_file: str, *, length: int = 2048, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset; with ``keep_ids`` also ids (binary, 32-bit little-endian)."""
    spark = docs.sparkSession
    small_batches(spark)
    marked = written(tokenised(docs, tokenizer_file, end_id), "tokens")
    parts = partitions(spark)
    # Rows of one id, or without one, are dealt by where the written table has them.
    salt = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    dealt = (
        marked.withColumn("salt", salt).repartitionByRange(parts, F.col("place"), F.col("doc_id"), F.col("salt"))
        .sortWithinPartitions("place", "doc_id", "ids", "salt")
        .drop("salt")
        .withColumn("part", F.spark_partition_id())
    )
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids binary" if keep_ids else ""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            rows: list[tuple] = []
            docs_, parts_, all_ids = batch.column(0).to_pylist(), batch.column(3), batch.column(2)
            for i, doc in enumerate(docs_):
                ids = np.frombuffer(all_ids[i].as_buffer(), "<u2").astype("<u4")
                base, start = parts_[i].as_py() << 40, 0
                while start < len(ids):
                    offset = at % length
                    n = min(length - offset, len(ids) - start)
                    raw = ids[start : start + n].tobytes()
                    rows.append((doc, start, n, zlib.crc32(raw), len(ids), base + at // length, offset) + ((raw,) if keep_ids else ()))
                    start += n
                    at += n
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 7 + [pa.binary()] * keep_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: len(kinds)]
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return dealt.mapInArrow(run, schema)
