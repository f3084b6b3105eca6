"""Exact top-k search by inner product with MaxScore.

A vector's components are terms: component d with a positive weight and with a negative one are two of them. Within
a shard of vectors every term has a bound, the most it can add to a query's score. Terms are taken by bound; those
whose bounds together stay under the k-th best score so far are non-essential: a vector that is in no essential
posting cannot get into the result. Essential postings are traversed, and what they leave is probed in the other
terms, those of large bounds first, only while it can still compete. Shards' results are merged.

Queries and vectors meet in blocks of bounded size: each task has one shard and one block of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a shard and queries in a block, about.
SHARD, BLOCK = 16_384, 2_048
#: For the first threshold: this many vectors of each of the so many terms with the largest bounds.
SEED_ROWS, SEED_TERMS = 40, 8
#: Non-essential terms that are probed between two looks at who still competes.
PROBE = 8


def scaled(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as long; null if the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


class Shard:
    """Postings of one shard: a column of weights and a vector order by weight for each component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.columns = np.ascontiguousarray(rows.T)
        self.most, self.least = rows.max(axis=0), rows.min(axis=0)
        self.order = np.argsort(self.columns, axis=1, kind="stable").astype(np.int32)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, row numbers) of the k best other vectors, ties to the smaller id."""
        terms = np.flatnonzero(query)
        bounds = np.maximum(np.where(query[terms] > 0, query[terms] * self.most[terms], query[terms] * self.least[terms]), 0)
        by_bound = np.argsort(bounds, kind="stable")
        terms, bounds = terms[by_bound], bounds[by_bound]
        below = np.cumsum(bounds)  # what a vector can get from the terms up to here

        # a first threshold from the tops of the largest postings
        seeds = [self.order[t, -SEED_ROWS:] if query[t] > 0 else self.order[t, :SEED_ROWS] for t in terms[-SEED_TERMS:]]
        seeds = np.unique(np.concatenate(seeds)) if seeds else np.zeros(0, np.int32)
        seeds = seeds[self.ids[seeds] != own]
        known = self.rows[seeds] @ query
        threshold = np.partition(known, -k)[-k] if len(known) >= k else None

        split = 0 if threshold is None else int(np.searchsorted(below, threshold, side="left"))
        rest, essential = terms[:split], terms[split:]
        if threshold is None or threshold <= 0:  # vectors without any positive term may belong to the result
            alive = np.arange(len(self.ids))
        else:
            reach = np.zeros(len(self.ids), self.rows.dtype)
            for t in essential:
                gain = query[t] * self.columns[t]
                np.maximum(gain, 0, out=gain)
                reach += gain
            may = below[split - 1] if split else 0
            alive = np.flatnonzero((reach > 0) & (reach + may >= threshold))
        score = self.rows[np.ix_(alive, essential)] @ query[essential]
        while len(rest):
            if threshold is not None:
                keep = score + below[len(rest) - 1] >= threshold
                alive, score = alive[keep], score[keep]
            probed, rest = rest[-PROBE:], rest[:-PROBE]
            score = score + self.rows[np.ix_(alive, probed)] @ query[probed]
        other = self.ids[alive] != own
        alive, score = alive[other], score[other]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return score[best], alive[best]


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of weights, shorter vectors filled with zeros."""
    lists = vectors.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(1, int(lengths.max(initial=1)))), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _search(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    names = ["query_id", "query_hash", "vec_id", "score"]
    out = []
    if left.num_rows and right.num_rows:
        rows, asked = _matrix(left["vector"]), _matrix(right["vector"])
        width = max(rows.shape[1], asked.shape[1])
        rows, asked = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, asked))
        if float(np.abs(rows).max()) * float(np.abs(asked).max()) * width < 2 ** 31:
            rows, asked = rows.astype(np.int32), asked.astype(np.int32)
        shard = Shard(left["vec_id"].to_numpy(), rows)
        for query_id, query_hash, query in zip(right["vec_id"].to_pylist(), right["hash"].to_pylist(), asked, strict=True):
            score, found = shard.top(query_id, query, k)
            out.append(pa.Table.from_arrays(
                [pa.array(np.full(len(found), query_id)), pa.array(np.full(len(found), query_hash)), pa.array(shard.ids[found]), pa.array(score.astype(np.int64))], names=names))
    schema = pa.schema([(n, pa.int64()) for n in names])
    return pa.concat_tables(out).cast(schema) if out else schema.empty_table()


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k best other vectors by inner product.

    Both sides have (vec_id long, vector array<long>). Rows with a null id or vector take no part; equal rows count once;
    rows with equal ids and different vectors are different vectors and different queries. Missing components count as
    zero. A query's own id is never in its result. Ties go to the smaller id. Scores must fit in 64 bits.
    """
    plain = lambda df: df.where("vec_id is not null and vector is not null").groupBy("vec_id", "vector").agg(
        F.first(F.xxhash64("vec_id", "vector")).alias("hash"))
    held, asked = plain(vectors), plain(queries)
    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    spread = lambda df, own, n, other, m: df.select(
        "vec_id", "hash", "vector", F.pmod("hash", F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))
    left = spread(held, "shard", shards, "block", blocks).groupBy("shard", "block")
    right = spread(asked, "block", blocks, "shard", shards).groupBy("shard", "block")
    schema = "query_id long, query_hash long, vec_id long, score long"
    found = left.cogroup(right).applyInArrow(lambda a, b: _search(a, b, k), schema)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
