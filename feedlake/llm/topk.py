"""Exact top-k search by integer inner product, as tiled matrix products.

Vectors are packed into blocks of bounded size. A tile is one group of query blocks against
one group of shard blocks; it multiplies them chunk by chunk, selects the best `k` of each
query partially, and passes on only those. The lists of a query meet in a tree: `fanout` tiles
at a time, then the results of those, until one list is left. Queries and shards are dealt to
tiles by blocks, so neither side is ever broadcast or whole in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch

QUERY_ROWS, SHARD_ROWS = 8192, 8192
FANOUT = 16
#: Rows of a product computed at a time: with a full shard block, 8 MB of scores.
CHUNK = 128
BLOCK_SCHEMA = "part int, dim int, ids binary, cells binary"
LIST_SCHEMA = "query_id long, vec_id long, score long"


def finite(vector: Column) -> Column:
    """True for a vector without NULL, NaN or infinite components; false for a NULL vector."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector.cast("array<double>"), bad), F.lit(False))


def quantised(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of every component x, as long; beyond its range the nearest long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, vec_id, cells) rows to one row for each part, length of vector and batch."""
    for batch in rows:
        parts, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cells = batch.column(2)
        starts = cells.offsets.to_numpy()
        flat = cells.values.to_numpy()
        dims = np.diff(starts)
        out = []
        for part, dim in {(int(p), int(d)) for p, d in zip(parts, dims, strict=True)}:
            mine = np.flatnonzero((parts == part) & (dims == dim))
            at = starts[mine][:, None] + np.arange(dim)
            out.append((part, dim, ids[mine].astype("<i8").tobytes(), flat[at].astype("<i8").tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int32()),
                    pa.array([o[1] for o in out], pa.int32()),
                    pa.array([o[2] for o in out], pa.binary()),
                    pa.array([o[3] for o in out], pa.binary()),
                ],
                names=["part", "dim", "ids", "cells"],
            )


def _unpack(blocks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    dim = int(blocks["dim"].iloc[0])
    ids = np.concatenate([np.frombuffer(b, "<i8") for b in blocks["ids"]])
    cells = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, dim) if dim else np.zeros((len(i) // 8, 0), "<i8") for b, i in zip(blocks["cells"], blocks["ids"], strict=True)])
    order = np.argsort(ids, kind="stable")
    return ids[order], cells[order]


def _exact(queries: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in a type whose products are exact: double where sums stay below 2**53.

    Otherwise 64-bit integers, or Python's where even those could overflow.
    """
    top = lambda m: max((abs(int(m.min())), abs(int(m.max())))) if m.size else 0
    bound = top(queries) * top(shard) * max(1, queries.shape[1])
    kind = np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object
    return queries.astype(kind), shard.astype(kind)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the `k` largest of each row, ties to the smaller column.

    The k-th largest score is found by partial selection; only scores that reach it are sorted.
    """
    if scores.shape[1] > k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        rows, cols = np.nonzero(scores >= cut[:, None])
    else:
        rows, cols = (a.ravel() for a in np.indices(scores.shape))
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[rank < k], cols[rank < k]


def _tile(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(queries) and len(shard):
        query_ids, left = _unpack(queries)
        ids, right = _unpack(shard)
        left, right = _exact(left, right)
        for at in range(0, len(left), CHUNK):
            own = query_ids[at : at + CHUNK]
            scores = left[at : at + CHUNK] @ right.T
            mine = own[:, None] == ids[None, :]
            if scores.dtype == object:
                scores = np.clip(scores, -(2**63) + 1, 2**63 - 1)
                held = np.where(mine, -(2**70), scores)
            elif scores.dtype == np.float64:
                held = np.where(mine, -np.inf, scores)
            else:
                held = np.where(mine, np.iinfo(np.int64).min, scores)
            rows, cols = _best(held, k + 1)
            kept = ~mine[rows, cols]
            rows, cols = rows[kept], cols[kept]
            values = np.array([int(v) for v in scores[rows, cols]], np.int64) if scores.dtype == object else scores[rows, cols].astype(np.int64)
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
            first = rank < k
            found.append(pd.DataFrame({"query_id": own[rows[first]], "vec_id": ids[cols[first]], "score": values[first]}))
    if not found:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
    return pd.concat(found, ignore_index=True)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: the `k` best partners of every query.

    `vectors` has `vec_id` and `embedding`; `is_query` is a condition on `vec_id`. The score is
    the inner product of floor(`scale` * x). Ties go to the smaller vec_id; a query is no
    partner of itself. Rows whose vector is NULL or holds NULL or non-finite components, and
    rows without an id, take no part. Of rows that share a vec_id, the largest vector counts.
    Vectors of different length do not meet. Scores beyond a long become the nearest long.
    Fewer than `k` partners give fewer rows, an empty table gives none.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "top-k")
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    valid = valid.filter(F.col("vec_id").isNotNull() & finite(F.col("vector")))
    valid = valid.select("vec_id", quantised(F.col("vector"), scale).alias("cells"))
    valid = valid.groupBy("vec_id").agg(F.max("cells").alias("cells"))
    valid = scratch.keep(valid, "cells")
    total, asked = valid.select(F.count("*"), F.count_if(is_query)).head()
    shards, groups = max(1, math.ceil(total / SHARD_ROWS)), max(1, math.ceil(asked / QUERY_ROWS))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("part")

    def blocks(rows: DataFrame, parts: int) -> DataFrame:
        return rows.select(part(parts), "vec_id", "cells").mapInArrow(_pack, BLOCK_SCHEMA)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks(valid.filter(is_query), groups).select("*", every(shards).alias("shard"))
    right = blocks(valid, shards).withColumnRenamed("part", "shard").select("*", every(groups).alias("part"))
    tiles = left.groupBy("part", "shard", "dim").cogroup(right.groupBy("part", "shard", "dim"))

    def tile(key: tuple, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        return _tile(queries, shard, k).assign(node=np.int32(key[1]))

    lists = tiles.applyInPandas(tile, f"{LIST_SCHEMA}, node int")
    nodes = shards
    while True:
        nodes = math.ceil(nodes / FANOUT)
        lists = lists.withColumn("node", F.expr(f"node div {FANOUT}").cast("int"))
        order = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if nodes <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
