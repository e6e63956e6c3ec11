"""Exact top-k search by inner product.

Queries are dealt into blocks and candidates into shards, both by the hash of
their id. A tile is one block against one shard: an exact matrix product, from
which every query keeps its k best. The lists of a query are merged in rounds
of `fan` shards each, so no task gets the lists of all shards.

Defined results. Vectors that are null or hold a null or a value that is not
finite take no part; neither do rows without an id. Vectors meet only vectors
of their own length. Rows that repeat an id: every row is a candidate of its
own, and the id is asked once, with the smallest of its vectors. A score
beyond the range of a long is held at the end of that range. No candidates give
no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.shared import stage

LIST = "query long, part int, vec_id long, score long, copy long"


@dataclass(frozen=True)
class Settings:
    k: int = 5
    block: int = 512
    shard: int = 2048
    fan: int = 16


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a whole double; missing if the vector cannot take part."""
    usable = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: _floor(x.cast("double") * scale)))


def _floor(x: Column) -> Column:
    # floor() gives a long, which large values do not fit; those have no fraction anyway.
    return F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows.

    No partial sum is larger than the product of the two lengths, so single or
    double precision is exact below its limit; beyond, Python's integers.
    """
    with np.errstate(over="ignore"):
        bound = math.sqrt(float((queries ** 2).sum(axis=1).max(initial=0))) * math.sqrt(float((vectors ** 2).sum(axis=1).max(initial=0)))
    if bound < 2.0 ** 24:
        return (queries.astype(np.float32) @ vectors.astype(np.float32).T).astype(np.int64)
    if bound < 2.0 ** 53:
        return (queries @ vectors.T).astype(np.int64)
    whole = lambda a: np.array([[int(x) for x in row] for row in a], object).reshape(a.shape)
    exact = whole(queries) @ whole(vectors).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the columns of its k highest allowed scores, ties to the smaller column.

    Only columns at or above the k-th score are sorted.
    """
    low = np.iinfo(np.int64).min
    held = np.where(allowed, scores, low)
    out = []
    if scores.shape[1] > k:
        edge = np.partition(held, -k, axis=1)[:, -k]
    else:
        edge = np.full(len(scores), low)
    for row, limit, fit in zip(held, edge, allowed):
        at = np.flatnonzero((row >= limit) & fit)
        above = at[row[at] > limit]
        at = np.concatenate([above, at[row[at] == limit][:k]])
        out.append(at[np.lexsort((at, ~row[at]))][:k])
    return out


def _matrix(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of one length each as a matrix, and their places; grouped by length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    groups = {}
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        groups[int(size)] = (rows, flat[begin[rows][:, None] + np.arange(size)] if size else np.zeros((len(rows), 0)))
    return groups


def _tile(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {name: [] for name in ("query", "vec_id", "score", "copy")}
        if left.num_rows and right.num_rows:
            asked = _matrix(left.column("vector").combine_chunks())
            order = np.argsort(right.column("vec_id").to_numpy(), kind="stable")
            right = right.take(pa.array(order))
            offered = _matrix(right.column("vector").combine_chunks())
            ask, have, row = left.column("query").to_numpy(), right.column("vec_id").to_numpy(), right.column("copy").to_numpy()
            for size, (rows, matrix) in asked.items():
                if size not in offered:
                    continue
                places, vectors = offered[size]
                for at in range(0, len(rows), 128):
                    some = rows[at:at + 128]
                    scores = products(matrix[at:at + 128], vectors)
                    for query, line, top in zip(ask[some], scores, best(scores, ask[some][:, None] != have[places][None, :], k)):
                        found["query"].append(np.full(len(top), query))
                        found["vec_id"].append(have[places[top]])
                        found["score"].append(line[top])
                        found["copy"].append(row[places[top]])
        gather = lambda name: pa.array(np.concatenate(found[name]) if found[name] else np.zeros(0, np.int64), pa.int64())
        part = int(right.column("part")[0].as_py()) if right.num_rows else 0
        query = gather("query")
        return pa.table([query, pa.array(np.full(len(query), part, np.int32)), gather("vec_id"), gather("score"), gather("copy")],
                        ["query", "part", "vec_id", "score", "copy"])
    return run


def top_k(vectors: DataFrame, asked: Column, settings: Settings = Settings(), vec_id: str = "vec_id",
          vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row that `asked` selects.

    `asked` is a condition over the column `vec_id`. A shard's rows go to every
    block of queries and a block's queries to every shard, so a tile holds at most
    about one of each, whatever the size of the table.
    """
    given = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    rows = stage(given.select("vec_id", quantised(F.col("v"), scale).alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
                 .withColumn("copy", F.monotonically_increasing_id()), "vectors")
    queries = rows.where(asked).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumnRenamed("vec_id", "query")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(asked, 1)).alias("q")).first()
    shards, blocks = max(1, math.ceil(counts.n / settings.shard)), max(1, math.ceil(counts.q / settings.block))
    deal = lambda n, key: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = (queries.withColumn("block", deal(blocks, "query"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    right = (rows.withColumn("part", deal(shards, "copy"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    lists = (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
             .applyInArrow(_tile(settings.k), LIST))
    while True:
        order = Window.partitionBy("query", "part").orderBy(F.desc("score"), "vec_id", "copy")
        merged = lists.withColumn("part", F.floor(F.col("part") / settings.fan).cast("int")) if shards > 1 else lists
        lists = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k)
        shards = math.ceil(shards / settings.fan)
        if shards <= 1:
            return lists.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
        lists = lists.drop("rank")
