"""Approximate nearest neighbours: a navigable small-world graph per shard.

Distinct vectors are dealt to shards of about ``SHARD_VALUES`` components by hash.  Each shard
becomes one row of a stored index: its vectors, the ids of their copies, and for
every layer a flat array of neighbours.  A search visits every shard; queries
reach it as a stream after its graph, so a task holds one graph and one batch of
queries however many there are, and the shards' results are merged by rank.

Construction and search advance a whole block of points together: in each turn
every point expands its best open candidates, and all distances of the turn are
one product.  Neighbours are chosen so that none is closer to a chosen one than
to the point itself, which keeps the graph connected between clusters.

Copies of a vector are one node.  Only the ``k + 1`` smallest ids of a node can
be among k results (one may be the query's own), so those are kept and every
row is in the index.  Nearness is the cosine in double precision on the vectors
as given; equal scores go to the smaller id.  Rows without an id, and vectors
that are NULL, zero or not finite, take no part; vectors of different lengths
are in different shards and never meet.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotativa.llm.vectors import comparable, cosines, first_copies, matrix, unit
from rotativa.session import stored

SHARD_VALUES = 1 << 21  # components of a shard's vectors, about; bounds a task's memory whatever the length of a vector
ENTRIES = 8  # a query's own nodes that a layer hands to the one below
LINKS = 16
BUILD_WIDTH = 80
SEARCH_WIDTH = 240
BLOCK = 256
OPENED = 4


@dataclass
class Layer:
    """``nodes`` sorted; ``near[i]`` holds the neighbours of ``nodes[i]`` as node numbers, -1 where none."""

    nodes: np.ndarray
    near: np.ndarray

    def of(self, nodes: np.ndarray) -> np.ndarray:
        return self.near[nodes if len(self.nodes) == self.nodes[-1] + 1 else np.searchsorted(self.nodes, nodes)]


def _walk(points: np.ndarray, layer: Layer, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes nearest to it that a best-first walk finds from its own entries, nearest first (node -1: none)."""
    many = len(queries)
    seen = np.zeros((many, len(points) + 1), bool)
    seen[:, -1] = True  # no node
    seen[np.arange(many)[:, None], entries] = True
    node = np.full((many, width), -1)
    far = np.full((many, width), np.inf, np.float32)
    opened = np.ones((many, width), bool)
    first = 1 - np.einsum("qed,qd->qe", points[entries], queries)
    first[entries < 0] = np.inf
    order = np.argsort(first, axis=1)[:, :width]
    held = order.shape[1]
    node[:, :held] = np.take_along_axis(entries, order, 1)
    far[:, :held] = np.take_along_axis(first, order, 1)
    opened[:, :held] = node[:, :held] < 0
    active = np.arange(many)
    while len(active):
        rank = np.argsort(opened[active], axis=1, kind="stable")[:, :OPENED]  # best first: open ones keep their order
        fresh = ~np.take_along_axis(opened[active], rank, 1)
        going = fresh[:, 0]
        active, rank, fresh = active[going], rank[going], fresh[going]
        if not len(active):
            break
        chosen = np.where(fresh, np.take_along_axis(node[active], rank, 1), -1)
        opened[active[:, None], rank] = True
        near = np.where(chosen[:, :, None] >= 0, layer.of(np.maximum(chosen, layer.nodes[0])), -1).reshape(len(active), -1)
        near = np.where(seen[active[:, None], near], -1, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[active[:, None], near] = True
        used = np.flatnonzero((near >= 0).any(0))
        if not len(used):
            continue
        near = near[:, used[0] :]
        away = 1 - np.einsum("qmd,qd->qm", points[near], queries[active])
        away[near < 0] = np.inf
        all_far = np.concatenate((far[active], away), 1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        far[active] = np.take_along_axis(all_far, best, 1)
        node[active] = np.take_along_axis(np.concatenate((node[active], near), 1), best, 1)
        opened[active] = np.take_along_axis(np.concatenate((opened[active], near < 0), 1), best, 1)
    return node, far


def _select(points: np.ndarray, node: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Neighbours out of candidates (nearest first): those nearer to the point than to any chosen before, then the nearest rest."""
    here = points[np.maximum(node, 0)]
    apart = 1 - here @ here.transpose(0, 2, 1)
    valid = node >= 0
    chosen = np.zeros(node.shape, bool)
    for i in range(node.shape[1]):
        blocked = (chosen[:, :i] & (apart[:, i, :i] < far[:, i : i + 1])).any(1)
        chosen[:, i] = valid[:, i] & ~blocked & (chosen[:, :i].sum(1) < most)
    rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(np.where(valid, node, -1), rank, 1)


def _link(points: np.ndarray, layer: Layer, new: np.ndarray, chosen: np.ndarray) -> None:
    """Store the neighbours of new nodes and let these answer; a full list is chosen anew."""
    most = layer.near.shape[1]
    place = np.searchsorted(layer.nodes, new)
    layer.near[place, : chosen.shape[1]] = chosen
    source, target = np.repeat(new, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    changed, begin, count = np.unique(target, return_index=True, return_counts=True)
    for low in range(0, len(changed), 1024):
        part = slice(low, low + 1024)
        rows = np.searchsorted(layer.nodes, changed[part])
        added = np.full((len(rows), count[part].max()), -1)
        turn = np.arange(added.shape[1])
        inside = turn < count[part][:, None]
        added[inside] = source[(begin[part][:, None] + turn)[inside]]
        both = np.concatenate((layer.near[rows], added), 1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both[both == changed[part][:, None]] = -1
        away = 1 - np.einsum("nmd,nd->nm", points[both], points[changed[part]])
        away[both < 0] = np.inf
        order = np.argsort(away, axis=1, kind="stable")[:, : most + 24]
        node, far = np.take_along_axis(both, order, 1), np.take_along_axis(away, order, 1)
        fits = (node >= 0).sum(1) <= most
        kept = np.full((len(rows), most), -1)
        kept[fits] = np.pad(node[fits], ((0, 0), (0, max(0, most - node.shape[1]))), constant_values=-1)[:, :most]
        if not fits.all():
            kept[~fits] = _select(points, node[~fits], far[~fits], most)
        layer.near[rows] = kept


def build_graph(points: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 7) -> list[Layer]:
    """Layers of the graph over unit vectors, the lowest first; nodes enter highest layer first."""
    count = len(points)
    points = np.ascontiguousarray(points, np.float32)
    random = np.random.default_rng(seed)
    height = np.floor(-np.log(1 - random.random(count)) / np.log(links)).astype(int)
    layers = []
    for level in range(height.max() + 1):
        nodes = np.flatnonzero(height >= level)
        layers.append(Layer(nodes, np.full((len(nodes), 2 * links if level == 0 else links), -1)))
    order = np.argsort(-height, kind="stable")
    done, size = 1, 1
    while done < count:
        new = order[done : done + size]
        for level in range(height[new].max(), -1, -1):
            own = np.sort(new[height[new] >= level])
            entry = _descend(points, layers, points[own], level, order[:1])
            node, far = _walk(points, layers[level], points[own], entry, width)
            mates = 1 - points[own] @ points[own].T  # those that enter together know each other
            np.fill_diagonal(mates, np.inf)
            several = min(len(own) - 1, 16)
            if several:
                closest = np.argpartition(mates, several - 1, axis=1)[:, :several]
                node = np.concatenate((node, own[closest]), 1)
                far = np.concatenate((far, np.take_along_axis(mates, closest, 1).astype(np.float32)), 1)
            rank = np.argsort(far, axis=1, kind="stable")[:, :width]
            node, far = np.take_along_axis(node, rank, 1), np.take_along_axis(far, rank, 1)
            _link(points, layers[level], own, _select(points, node, far, links))
        done += len(new)
        size = min(2 * size, BLOCK)
    return layers


def _descend(points: np.ndarray, layers: list[Layer], queries: np.ndarray, level: int, top: np.ndarray) -> np.ndarray:
    """Each query's entry nodes for a layer: the nearest that its walk through the layers above finds, -1 where none."""
    entry = np.broadcast_to(top, (len(queries), len(top)))
    for above in range(len(layers) - 1, level, -1):
        node, _ = _walk(points, layers[above], queries, entry, ENTRIES)
        entry = node
    return entry


def search_graph(points: np.ndarray, layers: list[Layer], queries: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> np.ndarray:
    """The k nearest nodes found for each query (unit vectors), nearest first, -1 where there are fewer."""
    points, top = np.ascontiguousarray(points, np.float32), layers[-1].nodes[:1]
    found = []
    for low in range(0, len(queries), BLOCK):
        block = queries[low : low + BLOCK].astype(np.float32)
        entry = _descend(points, layers, block, 0, top)
        node, _ = _walk(points, layers[0], block, entry, max(width, k))
        found.append(node[:, :k])
    return np.concatenate(found) if found else np.zeros((0, k), int)


INDEX = (
    "size INT, shard INT, vectors ARRAY<DOUBLE>, ids ARRAY<ARRAY<BIGINT>>, "
    "layers ARRAY<STRUCT<nodes: ARRAY<INT>, width: INT, near: ARRAY<INT>>>"
)


def build_index(rows: DataFrame, id_: str, vector: str, copies: int, shard_values: int = SHARD_VALUES) -> DataFrame:
    """The stored index: a row per shard. ``copies`` ids of each vector are kept, enough for k results."""
    usable = rows.where(comparable(F.col(vector)) & F.col(id_).isNotNull())
    nodes = stored(first_copies(usable.select(F.col(id_).alias("id"), F.col(vector).alias("vector")), "id", "vector", copies), "index-nodes")
    values = nodes.agg(F.sum(F.size("vector")).alias("n")).first()["n"] or 0
    shards = max(1, -(-values // shard_values))
    dealt = nodes.select(
        F.size("vector").alias("size"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids"
    )

    def graph(key, table):
        order = np.argsort([ids[0] for ids in table.column("ids").to_pylist()], kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        points = matrix(table.column("vector").combine_chunks())
        layers = build_graph(unit(points))
        row = {
            "size": key[0].as_py(),
            "shard": key[1].as_py(),
            "vectors": points.ravel(),
            "ids": table.column("ids").to_pylist(),
            "layers": [{"nodes": x.nodes, "width": x.near.shape[1], "near": x.near.ravel()} for x in layers],
        }
        return pa.Table.from_pylist([row], schema=_INDEX_SCHEMA)

    return stored(dealt.groupBy("size", "shard").applyInArrow(graph, INDEX), "index")


_INDEX_SCHEMA = pa.schema(
    [
        ("size", pa.int32()),
        ("shard", pa.int32()),
        ("vectors", pa.list_(pa.float64())),
        ("ids", pa.list_(pa.list_(pa.int64()))),
        (
            "layers",
            pa.list_(pa.struct([("nodes", pa.list_(pa.int32())), ("width", pa.int32()), ("near", pa.list_(pa.int32()))])),
        ),
    ]
)


def _search_shards(k: int, width: int):
    """For mapInArrow over rows sorted by shard, a shard's graph before its queries."""

    def run(batches):
        points = None
        for batch in batches:
            is_graph = batch.column("vectors").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.append(np.flatnonzero(is_graph), batch.num_rows)
            if points is not None and cuts[0] > 0:
                yield _answers(points, ids, layers, batch.slice(0, cuts[0]), k, width)  # noqa: F821
            for low, high in zip(cuts[:-1], cuts[1:]):
                row = batch.slice(low, 1)
                ids = row.column("ids")[0].as_py()
                points = np.asarray(row.column("vectors")[0].values, np.float64).reshape(len(ids), -1)
                layers = [
                    Layer(np.asarray(x["nodes"].values, np.int64), np.asarray(x["near"].values, np.int64).reshape(-1, x["width"].as_py()))
                    for x in row.column("layers")[0]
                ]
                if high > low + 1:
                    yield _answers(points, ids, layers, batch.slice(low + 1, high - low - 1), k, width)

    return run


def _answers(points, ids, layers, queries: pa.RecordBatch, k: int, width: int) -> pa.RecordBatch:
    """The k best rows of a shard for each query; one place more is searched, as the query itself may be found."""
    asked = matrix(queries.column("query"))
    found = search_graph(unit(points), layers, unit(asked), k + 1, width)
    made = ([], [], [])
    for number, vector, nodes in zip(queries.column("query_id").to_pylist(), asked, found):
        nodes = nodes[nodes >= 0]
        score = cosines(points[nodes], vector)
        best = sorted((-s, i) for s, node in zip(score.tolist(), nodes.tolist()) for i in ids[node] if i != number)[:k]
        made[0].extend([number] * len(best))
        made[1].extend(i for _, i in best)
        made[2].extend(-s for s, _ in best)
    return pa.RecordBatch.from_arrays(
        [pa.array(made[0], pa.int64()), pa.array(made[1], pa.int64()), pa.array(made[2], pa.float64())],
        names=["query_id", "vec_id", "score"],
    )


def search(index: DataFrame, queries: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for queries (query_id, query)."""
    asked = index.select("size", "shard").join(queries.withColumn("size", F.size("query")), "size")
    work = index.withColumns({"query_id": F.lit(None).cast("long"), "query": F.lit(None).cast("array<double>")}).unionByName(
        asked.select("size", "shard", "query_id", F.col("query").cast("array<double>").alias("query")), allowMissingColumns=True
    )
    shards = max(1, index.count())
    found = (
        work.repartitionByRange(shards, "size", "shard")
        .sortWithinPartitions("size", "shard", F.col("query_id").asc_nulls_first())
        .mapInArrow(_search_shards(k, width), "query_id BIGINT, vec_id BIGINT, score DOUBLE")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def nearest(rows: DataFrame, id_: str, vector: str, every: int, k: int = 5) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by ``every``."""
    index = build_index(rows, id_, vector, k + 1)
    queries = (
        rows.where((F.col(id_) % every == 0) & comparable(F.col(vector)))
        .groupBy(F.col(id_).alias("query_id"))
        .agg(F.min(vector).alias("query"))  # an id that stands in several rows asks once
    )
    return search(index, queries, k)
