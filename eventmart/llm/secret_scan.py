"""Secret scan with an incremental ledger of blobs.

Every version of a text is a blob, named by its SHA-256.  The ledger is a folder
of Parquet files with a row for each (blob, rule version) that was scanned, and
the spans found there.  A scan takes the pairs that the ledger lacks, reads one
version of each such blob, appends the result, and joins the findings of the
current rules back to all rows: a text under many paths is scanned once, a text
seen in an earlier run not at all, and after a change of the rules each once more.

Base kinds, in this order: assign (value of 6 or more characters), access (20 or
more), hex (24 or more).  Further kinds: private_key, jwt and url (a password in
an address).  Null texts count as empty; both are a blob without findings.  Rows
without a doc_id, or that repeat one, are versions like any other.

The ledger is only appended to, after the scan's job has ended.  Should two runs
scan the same pair, its findings are the same; the join back reads each once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, ids_and_texts, partitions
from .spans import SPAN, count_of, digest, matches

RULE_VERSION = "1"
BASE_KINDS = 3
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind -> pattern.
RULES = {
    "assign": _ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
    "private_key": r"-----BEGIN\x20(?:[A-Z]{1,20}\x20){0,4}PRIVATE\x20KEY-----",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "url": r"://[^\x00-\x20/:@\"']{1,128}:[^\x00-\x20/:@\"']{1,128}@",
}
VALID = {"assign": lambda value: F.char_length(F.regexp_extract(value, _ASSIGN, 2)) >= 6}
LEDGER = f"blob binary, rule_version string, spans {SPAN}"


def ledger_of(spark, path: str) -> DataFrame:
    """The ledger's rows; none where the folder does not exist yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def found_in(rows: DataFrame) -> DataFrame:
    """``rows`` with the column spans, by start, then kind, of their ``text``."""
    text = F.col("text")
    for rank, (kind, pattern) in enumerate(RULES.items()):
        rows = rows.withColumn(f"__s_{kind}", matches(text, pattern, kind, rank, VALID.get(kind)))
    columns = [f"__s_{kind}" for kind in RULES]
    return rows.withColumn("spans", F.sort_array(F.concat(*(F.col(c) for c in columns)))).drop(*columns)


def scan(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """doc_id, blob and spans for every row of ``docs``; brings the ledger up to date."""
    spark = docs.sparkSession
    versions = ids_and_texts(docs).withColumn("blob", F.unhex(F.sha2("text", 256))).withColumn("at", F.coalesce("doc_id", F.lit(NULL_ID)))
    current = lambda: ledger_of(spark, ledger).where(F.col("rule_version") == rule_version)
    new = versions.groupBy("blob").agg(F.min("at").alias("at")).join(current().select("blob"), "blob", "left_anti")
    # One row of each unseen blob: those of its smallest id meet by (blob, id).  Where that is
    # many rows - copies without an id - tasks first keep one each.
    pairs = versions.groupBy("blob", "at").agg(F.count("*").alias("n"))
    total, parts = pairs.agg(F.sum("n")).first()[0] or 0, partitions(spark)
    often = pairs.where(F.col("n") > max(1, total // parts)).select("blob", "at").collect()  # at most ``parts``
    texts = versions.select("blob", "at", "text")
    if often:
        hot = F.broadcast(spark.createDataFrame([tuple(r) for r in often], "blob binary, at long"))
        few = texts.join(hot, ["blob", "at"], "left_semi").groupBy("blob", "at").agg(F.first("text").alias("text"))
        texts = texts.join(hot, ["blob", "at"], "left_anti").unionByName(few)
    unseen = texts.join(new, ["blob", "at"], "left_semi").dropDuplicates(["blob", "at"])
    scanned = found_in(unseen).select("blob", F.lit(rule_version).alias("rule_version"), "spans").dropDuplicates(["blob"])
    scanned.write.mode("append").option("compression", "zstd").parquet(ledger)
    findings = current().where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    return versions.select("doc_id", "blob").join(findings, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPAN)))


def report(docs: DataFrame, ledger: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row."""
    spans = F.col("spans")
    return scan(docs, ledger).select(
        "doc_id",
        *(count_of(spans, rank).alias(f"n_{kind}") for rank, kind in enumerate(list(RULES)[:BASE_KINDS])),
        F.sha2(digest(spans, BASE_KINDS), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
    )
