"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits the directions of the vectors again and again at the median of a random
projection; vectors close to a cut go to both sides (spill), so that few near pairs are parted,
and many trees make up for those that are. The cuts are fitted on a bounded sample of distinct
vectors (`FIT_ROWS`); every vector is indexed. Levels below those the sample can support split
at the sample's mean in the leaf, so the trees deepen with the table and leaves stay small.
A node is not cut where a good part of its sampled pairs (`DENSE`) link: cuts would go through
a dense group again and again and part its links in every tree.

Within a leaf all pairs are verified by exact cosine, as products of blocks: a leaf of more
than `LEAF_ROWS` vectors is dealt out as tiles of blocks. A tile does not write its pairs. It
counts the links of each vector, leaving out those that an earlier leaf has counted already
(each row carries all its leaves), and writes a spanning forest of the links. So the output is
linear however many vectors are alike. Equal vectors are one row from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch, add_columns, components
from feedlake.llm.topk import finite

#: Vectors the cuts are fitted on, sample vectors a node needs to be cut at its own median.
FIT_ROWS, NODE_ROWS = 20_000, 32
#: Vectors in a leaf, as intended and as the largest side of a tile.
TARGET_ROWS, LEAF_ROWS = 512, 2048
TREES = 8
#: Half width of the spill, in standard deviations of the projections in the node.
SPILL = 0.08
CHUNK = 256
#: A node is a leaf if this share of its pairs link, judged by so many of its sample vectors. A
#: group that holds every median, half of the node, has a quarter of the pairs.
DENSE, DENSE_ROWS = 0.2, 256


class Tree:
    """Directions for each level; cut and spill for each node, and for each deep level and leaf."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int, threshold: float):
        rng = np.random.default_rng(seed)
        self.directions = rng.standard_normal((depth, sample.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        projected = sample @ self.directions.T
        self.top = max(0, min(depth, int(math.log2(max(1, len(sample) / NODE_ROWS)))))
        self.cuts: list[np.ndarray] = []
        node = np.zeros(len(sample), np.int64)
        whole = np.zeros(1, bool)
        for level in range(depth):
            count = 1 << min(level, self.top)
            cut, width = np.zeros(count), np.zeros(count)
            values = projected[:, level]
            if level <= self.top:
                whole = np.array([_dense(sample[np.flatnonzero(node == one)[:DENSE_ROWS]], threshold) for one in range(count)])
            for one in range(count):
                own = values[node == one]
                if whole[one]:
                    cut[one] = np.inf  # all rows stay on one side, at all levels below as well
                elif len(own):
                    cut[one] = np.median(own) if level < self.top else own.mean()
                    width[one] = SPILL * own.std()
            self.cuts.append(np.stack([cut, width]))
            if level < self.top:
                node = 2 * node + (values > cut[node])

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of every place a row of `unit` falls into."""
        projected = unit @ self.directions.T
        row, node = np.arange(len(unit)), np.zeros(len(unit), np.int64)
        for level, (cut, width) in enumerate(self.cuts):
            own = node >> (level - min(level, self.top))
            away = projected[row, level] - cut[own]
            right = away > 0
            spilled = np.flatnonzero(np.abs(away) < width[own])
            row, node = (
                np.concatenate([row, row[spilled]]),
                np.concatenate([2 * node + right, 2 * node[spilled] + ~right[spilled]]),
            )
        return row, node


def _dense(unit: np.ndarray, threshold: float) -> bool:
    """Whether at least `DENSE` of the pairs of these rows link."""
    n = len(unit)
    return n > 1 and np.count_nonzero(np.triu(unit @ unit.T >= threshold, 1)) >= DENSE * n * (n - 1) / 2


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def _fit(spark: SparkSession, distinct: DataFrame, dim: int, rows: int, trees: int, threshold: float) -> list[Tree]:
    """A forest on the `FIT_ROWS` vectors of smallest hash; all of them if there are fewer."""
    sample = distinct.filter(F.col("dim") == dim)
    share = 1.2 * FIT_ROWS / max(1, rows)
    if share < 1:  # hashes that far down hold them, so no partition has to send as many
        sample = sample.filter(F.xxhash64("vector") < F.lit(int(share * 2**64) - 2**63))
    sample = sample.orderBy(F.xxhash64("vector"), "vec_id").limit(FIT_ROWS)
    unit = _unit(_matrix(sample.select("vector").toPandas()["vector"]))
    depth = max(0, math.ceil(math.log2(rows / TARGET_ROWS)))
    return [Tree(unit, depth, 1000 * dim + t, threshold) for t in range(trees)]


def _compare(left: pd.DataFrame, right: pd.DataFrame, tree: int, leaf: int, threshold: float, same: bool) -> pd.DataFrame:
    """Links of a tile: for each vector the number that no earlier leaf has, and a forest edge.

    `same` marks a block against itself, of which the upper triangle counts.
    """
    a, b = _unit(_matrix(left["vector"])), _unit(_matrix(right["vector"]))
    ids_a, ids_b = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
    counts_a, counts_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    copies_a, copies_b = left["copies"].to_numpy(), right["copies"].to_numpy()
    offset = 0 if same else len(a)
    label = np.arange(offset + len(b))
    leaves_a, leaves_b = _leaf_columns(left["leaves"], tree), _leaf_columns(right["leaves"], tree)
    for at in range(0, len(a), CHUNK):
        product = a[at : at + CHUNK] @ b.T
        rows, cols = np.nonzero(product >= threshold)
        rows += at
        if same:
            upper = rows < cols
            rows, cols = rows[upper], cols[upper]
        if not len(rows):
            continue
        new = ~_shared_before(leaves_a, leaves_b, rows, cols, leaf)
        counts_a += np.bincount(rows[new], copies_b[cols[new]], len(a)).astype(np.int64)
        counts_b += np.bincount(cols[new], copies_a[rows[new]], len(b)).astype(np.int64)
        # rows ascend: each row's links join what they reach, the smallest place is the label
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        for row, linked in zip(rows[first].tolist(), np.split(cols, first[1:]), strict=True):
            reached = label[offset + linked]
            if (reached != label[row]).any():
                joined = np.unique(np.append(reached, label[row]))
                label[np.isin(label, joined)] = joined[0]
    ids = ids_b if same else np.concatenate([ids_a, ids_b])
    counts = counts_a + counts_b if same else np.concatenate([counts_a, counts_b])
    roots = ids[label]
    out = pd.DataFrame({"vec_id": ids, "links": counts, "root": roots})
    return out[(out["links"] > 0) | (out["vec_id"] != out["root"])]


def _leaf_columns(leaves: pd.Series, tree: int) -> list[np.ndarray]:
    """For each tree up to `tree` the leaves of every row, -1 where a row has fewer."""
    columns = []
    for t in range(tree + 1):
        own = [row[t] for row in leaves]
        table = np.full((len(own), max(map(len, own))), -1, np.int64)
        for i, places in enumerate(own):
            table[i, : len(places)] = places
        columns.append(table)
    return columns


def _shared_before(a: list[np.ndarray], b: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, leaf: int) -> np.ndarray:
    """Whether pairs share a leaf of an earlier tree, or one before `leaf` in the last of them."""
    found = np.zeros(len(rows), bool)
    for t, (x, y) in enumerate(zip(a, b, strict=True)):
        for p in range(x.shape[1]):
            left = np.flatnonzero(~found)
            own = x[rows[left], p]
            some = (own >= 0) & (own < leaf) if t == len(a) - 1 else own >= 0
            left, own = left[some], own[some]
            for q in range(y.shape[1]):
                found[left[own == y[cols[left], q]]] = True
    return found


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, trees: int = TREES) -> DataFrame:
    """`vectors` with `n_links`, `component_id` and `kept`.

    Two vectors link if the forest brings them into one leaf and their cosine in double
    precision is at least `threshold`. `n_links` counts the other vectors linked directly,
    copies included; `component_id` is the smallest vec_id reachable by links, `kept` is true
    where that is the own one. Input columns of these names are replaced.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing.
    Vectors of different length do not link. Rows without a vec_id link with nothing and have
    component NULL, kept true; rows that share a vec_id count as one vector, the largest.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "embedding-dedup")
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    usable = F.col("vec_id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    ids = narrow.filter(usable).groupBy("vec_id").agg(F.max("vector").alias("vector"))
    ids = scratch.keep(ids.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit("second"), "vector")), "ids")
    classes = ids.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = scratch.keep(classes, "classes")
    distinct = ids.join(classes, ["h1", "h2", "vec_id"]).select("vec_id", "vector", "copies", F.size("vector").alias("dim"))
    distinct = scratch.keep(distinct, "distinct")
    dims = {r["dim"]: r["count"] for r in distinct.groupBy("dim").count().collect()}
    forest = {dim: _fit(spark, distinct, dim, rows, trees, threshold) for dim, rows in dims.items()}

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                unit = _unit(_matrix(own["vector"]))
                leaves: list[list[list[int]]] = [[[] for _ in range(trees)] for _ in range(len(own))]
                for t, tree in enumerate(forest[dim]):
                    for row, leaf in zip(*(x.tolist() for x in tree.leaves(unit)), strict=True):
                        leaves[row][t].append(leaf)
                yield own.assign(leaves=[[sorted(own) for own in row] for row in leaves])

    schema = "vec_id long, vector array<double>, copies long, dim int, leaves array<array<long>>"
    indexed = scratch.keep(distinct.mapInPandas(index, schema), "indexed")
    found = [
        scratch.keep(_tree_links(indexed, tree, threshold, scratch), "links") for tree in range(trees)
    ]
    links = found[0]
    for other in found[1:]:
        links = links.unionByName(other)
    groups = components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")), scratch)
    groups = groups.withColumnRenamed("node", "vec_id").withColumnRenamed("component", "group")
    counts = links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    table = scratch.keep(
        classes.join(counts, "vec_id", "left")
        .join(groups, "vec_id", "left")
        .select(
            "h1",
            "h2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("group", "vec_id").alias("group"),
        ),
        "table",
    )
    answers = scratch.keep(ids.select("vec_id", "h1", "h2").join(table, ["h1", "h2"]).select("vec_id", "links", "group"), "answers")
    rows = vectors.select(F.struct("*").alias("row"), F.col("vec_id").cast("long").alias("vec_id"))
    out = rows.join(answers, "vec_id", "left").select(
        "row.*", F.coalesce("links", F.lit(0)).alias("__links"), F.coalesce("group", "vec_id").alias("__group"), F.col("vec_id").alias("__id")
    )
    return add_columns(
        out,
        n_links=F.col("__links").cast("long"),
        component_id=F.col("__group"),
        kept=F.coalesce(F.col("__group") == F.col("__id"), F.lit(True)),
    ).drop("__links", "__group", "__id")


def _tree_links(indexed: DataFrame, tree: int, threshold: float, scratch: Scratch) -> DataFrame:
    """`vec_id`, `links`, `root` of one tree, tile by tile."""
    rows = indexed.withColumn("leaf", F.explode(F.get("leaves", F.lit(tree))))
    sizes = rows.groupBy("dim", "leaf").count().withColumn("blocks", F.ceil(F.col("count") / LEAF_ROWS).cast("int"))
    large = scratch.keep(sizes.filter("blocks > 1").select("dim", "leaf", "blocks"), "large-leaves")
    rows = rows.join(large, ["dim", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, leaf, low, high = key
        left, right = frame[frame["block"] == low], frame[frame["block"] == high]
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("vec_id", "links", "root")})
        return _compare(left, right, tree, leaf, threshold, low == high)

    return (
        rows.select("dim", "leaf", "low", "high", "block", "vec_id", "vector", "copies", "leaves")
        .groupBy("dim", "leaf", "low", "high")
        .applyInPandas(compare, "vec_id long, links long, root long")
    )
