"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Base kinds, in this order: email, ip (parts at most 255), card (14 to 19 digits,
Luhn), phone (10 to 15 digits).  Further kinds: iban (mod-97) and ssn, a bare
number pattern that counts only near a word that names it.

A span's score is its kind's own, raised by ``CONTEXT_GAIN`` when a context word
of the kind stands within ``REACH`` code points before it or ``REACH_AFTER``
after.  Base spans are kept at any score; the others from ``LEAST`` on.

Null texts count as empty; both have no spans.  Rows that repeat a doc_id and
rows without one are rows like any other.  No shuffle: each row is on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts
from .spans import count_of, digest, matches

#: Kind -> pattern.  ``(?:\G|(?<!...))`` starts only where a run of
#: the first class starts or the last match ended; no other start can match.
#: Possessive repeats take what the greedy ones would, without going back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE_KINDS = 4
OWN_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": "e-?mail|mailto|contact|write to",
    "ip": r"\bip\b|address|server|host",
    "card": "card|visa|master|credit|debit|payment",
    "phone": r"phone|call|\btel\b|mobile|fax",
    "iban": "iban|account|bank",
    "ssn": r"\bssn\b|social security",
}
CONTEXT_GAIN, REACH, REACH_AFTER, LEAST = 0.3, 40, 20, 0.5


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = digits_of(value)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(d, F.char_length(d) - i + 1, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(i % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    return F.char_length(d).between(14, 19) & (F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), add) % 10 == 0)


def mod_97(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.char_length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    letters = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.char_length(plain).between(15, 34) & (F.aggregate(letters, F.lit(0), add) == 1)


def small_parts(value: Column) -> Column:
    short = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(value, r"\."), lambda p: F.when(F.char_length(short(p)) > 3, False).otherwise(F.concat(F.lit("0"), F.substring(short(p), 1, 3)).cast("int") <= 255))


VALID = {
    "ip": small_parts,
    "card": luhn,
    "phone": lambda v: F.char_length(digits_of(v)).between(10, 15),
    "iban": mod_97,
}


def with_spans(rows: DataFrame, text: Column, name: str) -> DataFrame:
    """``rows`` with the column ``name``: spans of start, kind_rank, end, kind, value, score; by start, then kind."""
    own = {kind: f"__pii_{kind}" for kind in PATTERNS}
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        rows = rows.withColumn(own[kind], matches(text, pattern, kind, rank, VALID.get(kind)))

    def scored(s: Column) -> Column:
        before = F.greatest(s["start"] - REACH, F.lit(0))
        around = F.lower(F.substring(text, (before + 1).cast("int"), (s["end"] - before + REACH_AFTER).cast("int")))
        base = F.coalesce(*(F.when(s["kind"] == k, F.lit(v)) for k, v in OWN_SCORE.items()))
        near = F.coalesce(*(F.when(s["kind"] == k, F.rlike(around, F.lit(p))) for k, p in CONTEXT.items()))
        return s.withField("score", F.least(F.lit(1.0), base + F.when(near, F.lit(CONTEXT_GAIN)).otherwise(0.0)))

    found = F.transform(F.concat(*(F.col(c) for c in own.values())), scored)
    kept = F.filter(found, lambda s: (s["kind_rank"] < BASE_KINDS) | (s["score"] >= LEAST))
    return rows.withColumn(name, F.sort_array(kept)).drop(*own.values())


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``spans`` for every row."""
    return with_spans(ids_and_texts(docs), F.col("text"), "spans")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores for every row."""
    rows = find(docs)
    spans = F.col("spans")
    return rows.select(
        "doc_id",
        *(count_of(spans, rank).alias(f"n_{kind}") for rank, kind in enumerate(list(PATTERNS)[:BASE_KINDS])),
        F.sha2(digest(spans, BASE_KINDS), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by [KIND] of the first."""

    def step(state: Column, s: Column) -> Column:
        covered = s["end"] <= state["at"]
        overlaps = s["start"] < state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(covered | overlaps, state["out"]).otherwise(F.concat(state["out"], gap, mark)).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    end = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, end))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with its spans replaced in ``text`` and ``n_chars``, where there is one, counted anew.

    Null texts stay null.  All other columns are as they were.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = with_spans(docs, text, "__pii_spans")
    rows = rows.withColumn("text", F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col("__pii_spans"))))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size("__pii_spans") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
