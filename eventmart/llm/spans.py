"""Pattern matches with their places, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,kind_rank:int,end:bigint,kind:string,value:string>>"


def matches(text: Column, pattern: str, kind: str, rank: int, valid: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern``: places in code points, end exclusive.

    The text between the matches and the matches themselves are read in turn; a
    text without a match is scanned once.  ``valid`` drops matches by their text.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast(SPAN)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["value"])
        span = F.struct(start.cast("long").alias("start"), F.lit(rank).alias("kind_rank"), end.cast("long").alias("end"), F.lit(kind).alias("kind"), pair["value"].alias("value"))
        return F.struct(end.cast("long").alias("at"), F.array_append(state["spans"], span).alias("spans"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    spans = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")), step, lambda s: s["spans"])
    if valid is not None:
        spans = F.filter(spans, lambda s: valid(s["value"]))
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(empty)


def digest(spans: Column, base_kinds: int | None = None) -> Column:
    """kind:start:end of sorted spans, comma-joined; only the first ``base_kinds`` kinds."""
    if base_kinds is not None:
        spans = F.filter(spans, lambda s: s["kind_rank"] < base_kinds)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_rank"] == rank)).cast("long")
