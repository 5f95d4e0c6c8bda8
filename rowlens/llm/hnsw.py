"""Nearest neighbours by one hierarchical navigable small-world graph per shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowlens.llm.common import map_batches, stage
from rowlens.llm.embeddings import usable

#: Vectors of a shard and queries of a block: with the dimension they bound a task's memory.
SHARD, QUERIES = 8192, 1024
_BATCH = 256  # nodes that are linked at a time

INDEX_SCHEMA = "shard int, dim int, ids binary, vectors binary, levels array<binary>, links array<binary>"


def _select(nodes: np.ndarray, near: np.ndarray, sims: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates (nearest first, -1: none) up to ``most``: those nearer to the node than to one chosen before, then the nearest of the rest."""
    some = near >= 0
    among = vectors[np.maximum(near, 0)]
    between = among @ among.transpose(0, 2, 1)
    chosen = np.zeros(near.shape, bool)
    count = np.zeros(len(near), int)
    for k in range(near.shape[1]):
        closest = np.where(chosen, between[:, k, :], -np.inf).max(axis=1)
        take = some[:, k] & (count < most) & (sims[:, k] > closest)
        chosen[:, k] = take
        count += take
    rank = np.where(chosen, 0, np.where(some, 1, 2)) * near.shape[1] + np.arange(near.shape[1])
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.full((len(near), most), -1, np.int32)
    out[:, : first.shape[1]] = np.where(np.take_along_axis(some, first, 1), np.take_along_axis(near, first, 1), -1)
    return out


def _top(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the k largest of each row, largest first; -1 where it is -inf."""
    k = min(k, sims.shape[1])
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.broadcast_to(np.arange(k), sims.shape)
    value = np.take_along_axis(sims, at, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    at, value = np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1)
    return np.where(np.isneginf(value), -1, at).astype(np.int32), value


def link_level(vectors: np.ndarray, width: int, considered: int) -> np.ndarray:
    """One level's graph as a flat array of neighbours, (nodes x 2 width), -1 for none.

    Nodes are inserted in order: each links to ``width`` of the nodes before it, chosen from its ``considered`` nearest, which a
    bounded shard can afford to find exactly. Links go both ways; a node with over 2 width keeps those that selection picks.
    """
    n = len(vectors)
    source, target, sim = [], [], []
    for low in range(0, n, _BATCH):
        nodes = np.arange(low, min(low + _BATCH, n))
        sims = vectors[nodes] @ vectors[: nodes[-1] + 1].T
        sims[np.arange(nodes[-1] + 1)[None, :] >= nodes[:, None]] = -np.inf
        near, value = _top(sims, considered)
        picked = _select(nodes, near, value, vectors, width)
        i, j = np.nonzero(picked >= 0)
        source.append(nodes[i])
        target.append(picked[i, j])
    a, b = np.concatenate(source), np.concatenate(target)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    sim = np.einsum("ij,ij->i", vectors[a], vectors[b])
    order = np.lexsort((-sim, a))
    a, b, sim = a[order], b[order], sim[order]
    first = np.searchsorted(a, np.arange(n + 1))
    out = np.full((n, 2 * width), -1, np.int32)
    degree = np.diff(first)
    place = np.arange(len(a)) - first[a]
    fits = (degree[a] <= 2 * width)
    out[a[fits], place[fits]] = b[fits]
    full = np.flatnonzero(degree > 2 * width)
    kept = place < considered  # the nearest of a hub's links are what selection looks at
    for low in range(0, len(full), _BATCH):
        nodes = full[low : low + _BATCH]
        near = np.full((len(nodes), considered), -1, np.int32)
        value = np.full((len(nodes), considered), -np.inf, np.float32)
        row = np.full(n, -1)
        row[nodes] = np.arange(len(nodes))
        of = (row[a] >= 0) & kept
        near[row[a[of]], place[of]] = b[of]
        value[row[a[of]], place[of]] = sim[of]
        out[nodes] = _select(nodes, near, value, vectors, 2 * width)
    return out


def build(ids: np.ndarray, vectors: np.ndarray, width: int, considered: int, seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels, the lowest first: nodes in order of insertion (the higher levels' first), and their neighbours as places in it."""
    rng = np.random.default_rng(seed)
    height = np.floor(rng.exponential(1 / np.log(width), len(ids))).astype(int)
    order = np.lexsort((ids, -height))
    levels = []
    for level in range(int(height.max()) + 1):
        nodes = order[: int((height >= level).sum())]
        levels.append((nodes.astype(np.int32), link_level(vectors[nodes], width, considered)))
    return levels


def _beam(queries: np.ndarray, vectors: np.ndarray, links: np.ndarray, found: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one level for all queries at once, from the entry points ``found`` (-1: none)."""
    n, many = len(vectors), np.arange(len(queries))[:, None]
    seen = np.zeros((len(queries), n + 1), bool)  # place n stands for none
    at = np.full((len(queries), breadth), n)
    value = np.full((len(queries), breadth), -np.inf, np.float32)
    done = np.ones((len(queries), breadth), bool)

    def add(rows, new):
        new = np.where(new < 0, n, new)
        new = np.where(seen[rows[:, None], new], n, new)
        seen[rows[:, None], new] = True
        seen[:, n] = False
        sims = np.einsum("qmd,qd->qm", vectors[np.minimum(new, n - 1)], queries[rows])
        sims[new == n] = -np.inf
        every = np.concatenate([value[rows], sims], axis=1)
        best = np.argpartition(-every, breadth - 1, axis=1)[:, :breadth]
        value[rows] = np.take_along_axis(every, best, 1)
        at[rows] = np.take_along_axis(np.concatenate([at[rows], new], axis=1), best, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], new == n], axis=1), best, 1)

    add(many[:, 0], found)
    while True:
        open_ = np.where(done, -np.inf, value)
        rows = np.flatnonzero(~np.isneginf(open_).all(axis=1))
        if not len(rows):
            break
        best = np.argpartition(-open_[rows], 1, axis=1)[:, :2] if breadth > 2 else open_[rows].argmax(axis=1)[:, None]
        valid = ~np.isneginf(open_[rows[:, None], best])
        nodes = np.where(valid, at[rows[:, None], best], n)
        done[rows[:, None], best] = True
        steps = np.where((nodes == n)[:, :, None], -1, links[np.minimum(nodes, n - 1)])
        steps = steps.reshape(len(rows), -1)
        if steps.shape[1] > links.shape[1]:  # a node may be a neighbour of both
            steps = np.sort(steps, axis=1)
            steps[:, 1:][steps[:, 1:] == steps[:, :-1]] = -1
        add(rows, steps)
    order = np.argsort(-value, axis=1, kind="stable")
    at, value = np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1)
    return np.where(np.isneginf(value), -1, at), value


def search(queries: np.ndarray, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], k: int, breadth: int) -> np.ndarray:
    """Rows of ``vectors`` nearest to each query, nearest first, -1 for none: down the levels, wide on the lowest."""
    found = np.zeros((len(queries), 1), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        nodes, links = levels[level]
        found, _ = _beam(queries, vectors[nodes], links, found, breadth if level == 0 else 16)
    found = found[:, :k]
    return np.where(found >= 0, levels[0][0][np.maximum(found, 0)], -1)


def _raise(rows: np.ndarray, longest: float) -> np.ndarray:
    """One more number that makes all vectors equally long: then the largest inner product is the smallest distance."""
    more = np.sqrt(np.maximum(longest**2 - (rows * rows).sum(axis=1), 0))
    return np.concatenate([rows, more[:, None]], axis=1).astype(np.float32)


def _rows(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    width: int = 24,
    considered: int = 64,
    breadth: int = 200,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` rows of ``vectors`` with the largest inner products.

    ``queries`` has the columns of ``vectors``; a row with the query's own key is no candidate. Equal vectors are indexed
    once. They are dealt to shards of about 8,192 by a hash of the key; a shard's graph is a row of flat neighbour arrays in a
    staged table. Blocks of 1,024 queries meet every shard, and the shards' results are merged by query. Scores are formed in double
    precision from the given vectors; ties go to the smaller key. The search is approximate: ``breadth`` buys recall.

    Vectors that are null, zero, or hold null or non-finite numbers take no part, nor do null keys; vectors meet only those of their
    dimension. A repeated row is a candidate like others, and a repeated query gives repeated rows' union once. Runs its jobs when called.
    """
    plain = lambda df: df.select(
        df[f"`{key}`"].cast("long").alias("id"), df[f"`{vector}`"].cast("array<double>").alias("vector")
    ).where(usable("vector") & F.col("id").isNotNull())
    every = stage(plain(vectors).withColumn("dim", F.size("vector")), "vectors")
    spark = every.sparkSession
    classes = every.groupBy("vector", "dim").agg(F.min("id").alias("rep"))
    longest = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    classes = stage(classes.withColumn("length", longest), "classes")
    found = {r["dim"]: (r["n"], r["length"]) for r in classes.groupBy("dim").agg(F.count("*").alias("n"), F.max("length").alias("length")).collect()}
    shards = {d: -(-n // SHARD) for d, (n, _) in found.items()}
    parts = F.coalesce(*(F.when(F.col("dim") == d, n) for d, n in shards.items()), F.lit(1)) if shards else F.lit(1)

    def index(of: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = _rows(table.column("vector"))
        ids = table.column("rep").to_numpy().astype(np.int64)
        dim = of[0].as_py()
        levels = build(ids, _raise(rows, found[dim][1]), width, considered)
        made = [of[1].as_py(), dim, ids.tobytes(), rows.tobytes(), [n.tobytes() for n, _ in levels], [x.tobytes() for _, x in levels]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
        return pa.table([pa.array([x], t) for x, t in zip(made, kinds, strict=True)], ["shard", "dim", "ids", "vectors", "levels", "links"])

    placed = classes.withColumn("shard", F.pmod(F.xxhash64("rep"), parts).cast("int"))
    indexed = stage(placed.groupBy("dim", "shard").applyInArrow(index, INDEX_SCHEMA), "index")

    asked = stage(plain(queries).withColumn("dim", F.size("vector")).distinct(), "queries")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("blocks"))

    def pack(of: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        made = [of[0].as_py(), of[1].as_py(), table.column("id").to_numpy().astype(np.int64).tobytes(), _rows(table.column("vector")).tobytes()]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array([x], t) for x, t in zip(made, kinds, strict=True)], ["dim", "block", "query_ids", "queries"])

    numbered = asked.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    packed = stage(numbered.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, query_ids binary, queries binary"), "blocks")

    def meet(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list[np.ndarray]] = [[], [], []]
        for row in batch.to_pylist():
            ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["query_ids"], np.int64)
            rows = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
            wanted = np.frombuffer(row["queries"], np.float64).reshape(len(query_ids), -1)
            levels = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.int32).reshape(-1, 2 * width)) for a, b in zip(row["levels"], row["links"], strict=True)]
            raised = np.concatenate([wanted, np.zeros((len(wanted), 1))], axis=1).astype(np.float32)
            near = search(raised, _raise(rows, found[row["dim"]][1]), levels, k + 1, breadth)
            q, at = np.nonzero(near >= 0)
            hit = near[q, at]
            out[0].append(query_ids[q])
            out[1].append(ids[hit])
            out[2].append(np.einsum("ij,ij->i", wanted[q], rows[hit]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query_id", "rep", "score"])

    each = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    pairs = each.join(indexed, ["dim", "shard"]).repartition(spark.sparkContext.defaultParallelism * 4, "block", "shard", "dim")
    hits = map_batches(pairs, meet, "query_id long, rep long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    hits = stage(hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n"), "hits")

    # Of many equal vectors a query needs only the k + 1 smallest keys; the window's limit applies before the shuffle.
    members = every.join(classes.select("vector", "rep"), "vector").select("rep", "id")
    least = Window.partitionBy("rep").orderBy("id")
    members = members.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    named = hits.join(members, "rep").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return named.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
