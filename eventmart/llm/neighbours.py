"""Approximate nearest neighbours by randomly rotated one-bit codes (RaBitQ).

Index: every vector is scaled to length 1, rotated by one random orthogonal
matrix and kept as its sign bits, packed, with two scalars: its length and the
inner product of the code with the rotated vector.  The estimate of an inner
product is  |x| |q| <code, q'> / <code, x'>  and is off by at most

    |x| |q| sqrt((1 - c^2) / c^2) * bound / sqrt(D - 1),     c = <code, x'>,

except with a probability that falls with ``bound``.

Search: queries and vectors meet block against block.  In a pair of blocks the k
vectors with the best estimates are scored on the original components, in double
precision; a further vector is reranked when its estimate plus error reaches the
lowest of these scores.  Each pair of blocks returns k rows a query at most, and
the k best of those are the result.

* Vectors that are null, zero, empty or hold null or non-finite components take
  no part.  So do rows without a vec_id.  Vectors of another dimension than the
  query's are no candidates of it: each dimension is searched on its own.
* Ties go to the smaller vec_id; rows that repeat a vec_id other than the
  query's are candidates each.
* Fewer candidates than k: all of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, written

#: Rows of a block of vectors and of a block of queries.
VECTORS, QUERIES = 4096, 4096
#: Queries that are estimated at once within a pair of blocks.
STEP = 256
BOUND = 3.0


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of code and rotated unit vector."""
    norms = np.linalg.norm(vectors, axis=1)
    turned = (vectors / norms[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), norms, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, x (doubles), dim: the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return (
        df.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
        .where(F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad) & F.exists("x", lambda v: v != 0))
        .withColumn("dim", F.size("x"))
    )


def index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The index: id, x, dim, code (binary), norm, fit; every usable row is in it."""
    small_batches(df.sparkSession, 4096)

    def run(parts):
        for part in parts:
            for dim, rows in part.groupby("dim"):
                code, norms, fit = codes(np.stack(rows["x"].to_numpy()), rotation(dim))
                yield rows.assign(code=[c.tobytes() for c in code], norm=norms, fit=fit)

    return usable(df, id_col, vector_col).mapInPandas(run, "id long, x array<double>, dim int, code binary, norm double, fit double")


def best_of_pair(queries: pd.DataFrame, rows: pd.DataFrame, k: int, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, vector ids and scores of the k best of ``rows`` for each of ``queries``.

    The k rows with the best estimates are scored first; the lowest of these
    scores is the floor that any other row's estimate plus error has to reach.
    """
    q, x = np.stack(queries["x"].to_numpy()), np.stack(rows["x"].to_numpy())
    qid, xid = queries["id"].to_numpy(), rows["id"].to_numpy()
    dim = x.shape[1]
    bits = np.unpackbits(np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1), axis=1, count=dim)
    norm, fit = rows["norm"].to_numpy(), np.minimum(rows["fit"].to_numpy(), 1)
    signs = ((bits * 2.0 - 1) / np.sqrt(dim) * (norm / fit)[:, None]).T.astype(np.float32)
    spread = (norm * np.sqrt((1 - fit**2) / fit**2) * bound / np.sqrt(max(dim - 1, 1)) + 1e-5 * norm).astype(np.float32)
    turned = (q @ rotation(dim)).astype(np.float32)
    lengths = np.linalg.norm(q, axis=1).astype(np.float32)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), STEP):
        part = slice(at, at + STEP)
        estimate = turned[part] @ signs
        own = qid[part][:, None] == xid[None, :]
        estimate[own] = -np.inf
        if len(rows) > k:
            best = np.argpartition(estimate, len(rows) - k, axis=1)[:, len(rows) - k :]
            exact = np.einsum("id,ikd->ik", q[part], x[best])
            exact[np.take_along_axis(own, best, axis=1)] = -np.inf
            estimate += lengths[part][:, None] * spread[None, :]
            near = estimate >= exact.min(axis=1).astype(np.float32)[:, None] - np.float32(1e-5) * lengths[part][:, None]
            if np.count_nonzero(near) > near.size // 50:
                # Many to rerank: all products in one multiplication, of which those near the k-th best go on.
                product = q[part] @ x.T
                product[own | ~near] = -np.inf
                floor = np.partition(product, len(rows) - k, axis=1)[:, len(rows) - k]
                near &= product >= (floor - 1e-9 * lengths[part] * norm.max())[:, None]
            i, j = np.nonzero(near & ~own)
        else:
            i, j = np.nonzero(~own)
        score = np.empty(len(i))
        for start in range(0, len(i), 100_000):
            s = slice(start, start + 100_000)
            score[s] = np.einsum("ij,ij->i", q[part][i[s]], x[j[s]])
        order = np.lexsort((xid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((qid[part][i[top]], xid[j[top]], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def search(
    df: DataFrame,
    is_query: Callable[[Column], Column],
    *,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    bound: float = BOUND,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of each query row.

    ``is_query`` takes the id column.  The answer is exact but for the error
    bound's small chance of failure; score is the inner product in double precision.
    """
    made = written(index(df, id_col, vector_col), "codes")
    size = {r["dim"]: (r["n"], r["q"]) for r in made.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query(F.col("id"))).alias("q")).collect()}
    blocks = lambda at, rows: F.greatest(F.lit(1), *(F.when(F.col("dim") == d, F.lit(-(-n[at] // rows))).otherwise(1) for d, n in size.items())) if size else F.lit(1)
    vectors = made.withColumn("v", F.pmod(F.xxhash64("id", F.lit(1)), blocks(0, VECTORS)).cast("int"))
    asked = (
        made.where(is_query(F.col("id")))
        .withColumn("q", F.pmod(F.xxhash64("id", F.lit(2)), blocks(1, QUERIES)).cast("int"))
        .withColumn("v", F.explode(F.sequence(F.lit(0), blocks(0, VECTORS) - 1)))
    )
    per = F.explode(F.sequence(F.lit(0), blocks(1, QUERIES) - 1))
    keys = ["dim", "v", "q"]
    vectors = vectors.withColumn("q", per)

    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        a, b, s = best_of_pair(queries, rows, k, bound)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    met = asked.select(*keys, "id", "x").groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
