"""Filter interaction audit: what each of several filters removes, in every order.

Filters are tests on a document's text; each has a one-letter name.  For a coalition S
of filters v(S) is the number of documents that any of them removes.  The removal game's
Hart-Mas-Colell potential is built up from smaller coalitions to larger ones,

    P(S) = (v(S) + sum over i in S of P(S without i)) / |S|,

and the Shapley value of a filter is P(all) - P(all without it).  n! P(S) is a whole
number, so the values summed over all orders, n! Shapley, are exact.  What filter i
removes after the filters S is v(S with i) - v(S): every step of every order is a
difference of coalitions.

1. One scan gives each document a bit mask of the filters that it fails.
2. "Copy of an earlier document" needs the table: the smallest id of each text (by
   SHA-256) is found by a partial aggregate, and rows meet it by (text, id), so a text
   with many copies is spread by their ids.
3. Rows become counts by part and mask, one per combination and task, before the shuffle.

Null texts count as empty, null parts as the empty string.  A row without a doc_id has no
smaller one before it unless its text has a row with an id; rows that share the smallest
id of a text all come first.  Of several labels of an id the largest counts; a row
without an id has none.  Texts of any length are read whole; an empty table gives no part
and so no row.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Maximal runs without ASCII white space.
_SPACES = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def quality_filters(text: Column) -> dict[str, Column]:
    """When a document fails: too short, repetitive, too many capitals, special characters."""
    words = words_of(text)
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": F.rlike(text, F.lit("[#$%&*|]")),
    }


def failures(docs: DataFrame, filters, copies: str | None, part: str) -> DataFrame:
    """part, doc_id, mask and n: how many rows of that id fail just those filters.

    ``filters``: a function of the text's column to {letter: fails}; ``copies``: the
    letter of the filter that removes copies of documents with a smaller id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    tests = filters(F.col("text"))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(tests.values())), F.lit(0))
    if copies is None:
        return rows.select("part", "doc_id", mask.alias("mask")).groupBy("part", "doc_id", "mask").agg(F.count("*").alias("n"))
    rows = rows.select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("body"), mask.alias("mask"))
    counted = rows.groupBy("body", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    first = counted.groupBy(F.col("body").alias("first_body")).agg(F.min("doc_id").alias("first_id"))
    same = (F.col("body") == F.col("first_body")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    copy = F.when(F.col("first_body").isNull(), 1 << len(tests)).otherwise(0)
    return counted.join(first, same, "left").select("part", "doc_id", (F.col("mask") + copy).alias("mask"), "n")


def coalitions(failed: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """Per part: arrays over all coalitions (by mask) of what they remove - documents,
    good ones, toxic ones - and of the potential times ``size``!; and all documents."""
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = failed.join(marked, failed["doc_id"] == marked["label_id"], "left")
    by_mask = known.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    # At most 2^size rows a part.
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"), F.sum("n").alias("documents"))
    removed = {f: F.expr(f"transform(sequence(0, {2**size - 1}), s -> aggregate(masks, 0L, (t, m) -> t + if((m.mask & s) <> 0, m.{f}, 0L)))") for f in ("n", "good", "toxic")}
    orders = 1
    for k in range(2, size + 1):
        orders *= k
    smaller = f"aggregate(sequence(0, {size - 1}), 0L, (t, i) -> t + if((s & shiftleft(1, i)) <> 0, p[s ^ shiftleft(1, i)], 0L))"
    potential = f"aggregate(sequence(1, {2**size - 1}), array(0L), (p, s) -> array_append(p, ({orders} * n[s] + {smaller}) div bit_count(s)))"
    return parts.select("part", "documents", *(c.alias(f) for f, c in removed.items())).withColumn("potential", F.expr(potential))


def audit(docs: DataFrame, labels: DataFrame, *, filters=quality_filters, copies: str | None = "E", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    letters = "".join([*filters(F.col("text")), *(copies or "")])
    size, full = len(letters), 2 ** len(letters) - 1
    games = coalitions(failures(docs, filters, copies, part), labels, size)
    orders = ",".join("".join(o) for o in permutations(letters))
    steps = games.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(size))))
    bits = f"transform(sequence(1, {size}), i -> shiftleft(1, instr('{letters}', substring(filter_order, i, 1)) - 1))"
    steps = steps.withColumn("bits", F.expr(bits)).withColumn("own", F.expr("bits[step - 1]"))
    steps = steps.withColumn("before", F.expr("aggregate(slice(bits, 1, step - 1), 0, (t, b) -> t | b)"))
    lost = lambda f: F.expr(f"{f}[before | own] - {f}[before]")
    return steps.select(
        "part",
        "filter_order",
        "step",
        F.expr("documents - n[before | own]").alias("kept"),
        lost("n").alias("removed"),
        F.expr("n[own] - (n[before | own] - n[before])").alias("redundant"),
        F.expr(f"n[{full}] - n[{full} ^ own]").alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.expr(f"potential[{full}] - potential[{full} ^ own]").alias("shapley"),
    )
