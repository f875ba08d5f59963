"""SentencePiece encoding and decoding through a distinct-chunk table.

In the model's normal form every space is a marker, and no piece of the model
holds a marker after another character.  Pieces therefore cannot cross from one
marked word into the next, and each distinct marked word is segmented once: a
table per Python worker maps the word to its ids, and a document's ids are the
table's entries joined back by position.

* A document that the plain split cannot describe (two spaces in a row, a space
  at either end, or the marker character itself) is segmented whole by the library.
* Words of more than ``LONG_WORD`` characters are segmented but not kept in the
  table; the table starts anew at ``TABLE_WORDS`` entries.  Both bound memory
  only; every id is produced either way.
* Null and empty texts have no ids and decode to the empty text.
* A model with pieces that cross markers, a normalisation rule or another prefix
  rule is refused by ``Chunks`` (ValueError).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ids_and_texts, small_batches

MARK = "▁"
LONG_WORD = 48
TABLE_WORDS = 500_000


class Chunks:
    """The distinct-chunk table of one worker."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        m = self.model
        if any(MARK in m.id_to_piece(i).lstrip(MARK) for i in range(m.get_piece_size())):
            raise ValueError("pieces of this model cross whitespace markers")
        if m.normalize("a b ﬁ  C") != f"{MARK}a{MARK}b ﬁ{MARK}{MARK}C":
            raise ValueError("this model normalises texts; words cannot be taken from the raw text")
        self.decimal = [str(i).encode() for i in range(m.get_piece_size())]
        self.first = np.array([m.id_to_piece(i).startswith(MARK) for i in range(m.get_piece_size())])
        self.ids: dict[str, bytes] = {}
        #: Words whose decoded form differs from the word.
        self.changed: dict[str, str] = {}

    def learn(self, words: Iterable[str]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > TABLE_WORDS:
            self.ids.clear()
            self.changed.clear()
            new = list(words)
        # Several words are one line for the library; the marker shows where each begins.
        lines = [" ".join(new[at : at + 64]) for at in range(0, len(new), 64)]
        for n, (line, ids) in enumerate(zip(lines, self.model.encode(lines, num_threads=1), strict=True)):
            part = new[n * 64 : n * 64 + 64]
            starts = np.flatnonzero(self.first[ids]).tolist()
            text = list(map(self.decimal.__getitem__, ids))
            for word, a, b in zip(part, starts, [*starts[1:], len(ids)], strict=True):
                self.ids[word] = b",".join(text[a:b])
            if self.model.decode(ids) != line:
                for word, a, b in zip(part, starts, [*starts[1:], len(ids)], strict=True):
                    if (back := self.model.decode(ids[a:b])) != word:
                        self.changed[word] = back

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text the decimal ids joined by commas, and the decoded text."""
        split: list[list[str] | None] = []
        words: set[str] = set()
        for text in texts:
            plain = text and "  " not in text and text[0] != " " and text[-1] != " " and MARK not in text
            split.append(text.split(" ") if plain else None)
            if plain:
                words.update(split[-1])
        long = {w for w in words if len(w) > LONG_WORD}
        self.learn(words - long)
        table = self.ids
        for word in long:
            ids = self.model.encode(word)
            table[word] = ",".join(map(str, ids)).encode()
            if (back := self.model.decode(ids)) != word:
                self.changed[word] = back
        for text, parts in zip(texts, split, strict=True):
            if parts is None:
                ids = self.model.encode(text) if text else []
                yield ",".join(map(str, ids)).encode(), self.model.decode(ids) if ids else ""
                continue
            joined = b",".join(map(table.__getitem__, parts))
            if self.changed and not self.changed.keys().isdisjoint(parts):
                text = " ".join(self.changed.get(w, w) for w in parts)
            yield joined, text
        for word in long:
            table.pop(word, None)
            self.changed.pop(word, None)


#: The worker's tables by model file; a Python worker serves many tasks.
_TABLES: dict[str, Chunks] = {}


def table_of(model_file: str) -> Chunks:
    if model_file not in _TABLES:
        _TABLES[model_file] = Chunks(model_file)
    return _TABLES[model_file]


def groups_of(texts: list[str], chars: int = 1_000_000) -> Iterator[slice]:
    """Slices of about ``chars`` characters, of one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def encode_documents(docs: DataFrame, model_file: str, *, keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with
    ``keep_ids`` also ids (decimal, joined by commas) and decoded (the text)."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids string, decoded string" if keep_ids else ""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(model_file)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows: list[tuple] = []
            for part in groups_of(texts):
                for ids, decoded in table.encode(texts[part]):
                    row = (ids.count(b",") + 1 if ids else 0, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                    rows.append(row + ((ids.decode(), decoded) if keep_ids else ()))
            columns = list(zip(*rows, strict=True)) or [()] * (5 if keep_ids else 3)
            kinds = [pa.int64()] + [pa.string()] * (len(columns) - 1)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(columns) + 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return ids_and_texts(docs).mapInArrow(run, schema)
