"""Near-duplicate vectors by int8 tile products with rigorous error bounds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import map_batches, stage, unstage
from rowlens.llm.graph import components, spanning_forest

#: Vectors in a block. Two blocks and one tile of products bound a task's memory.
BLOCK = 4096
#: Vectors whose cells the blocks are cut from; a fixed bound, and only the order of the work depends on them.
PIVOTS = 256
_ROWS = 512  # of a block, multiplied at a time
_SLACK = 1e-6  # over rounding in single precision sums of integers below 2**24, and of the bounds themselves

BLOCK_SCHEMA = "block long, n int, dim int, ids binary, copies binary, vectors binary, axis array<double>, angle double"


def usable(vector: str | Column) -> Column:
    """Whether a vector holds only finite numbers, and one that is not zero."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    number = lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))  # noqa: E731  (NaN is greater than every number)
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _block_row(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    vectors = table.column("vector").combine_chunks()
    dim = len(vectors[0])
    rows = _matrix(vectors, dim)
    unit = _unit(rows)
    axis = unit.sum(axis=0)
    axis = axis / (np.sqrt(axis @ axis) or 1.0)
    angle = float(np.arccos(np.clip(unit @ axis, -1, 1)).max())
    made = [
        key[0].as_py(),
        len(rows),
        dim,
        table.column("class").to_numpy().astype(np.int64).tobytes(),
        table.column("copies").to_numpy().astype(np.int64).tobytes(),
        rows.astype(np.float32 if pa.types.is_float32(vectors.type.value_type) else np.float64).tobytes(),  # as they were given
        axis.tolist(),
        angle,
    ]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64()]
    names = ["block", "n", "dim", "ids", "copies", "vectors", "axis", "angle"]
    return pa.table([pa.array([x], t) for x, t in zip(made, kinds, strict=True)], names)


class _Block:
    """A block's vectors in full precision, as int8 numbers of one scale, and each vector's distance from what these stand for."""

    def __init__(self, row: dict, side: str):
        self.ids = np.frombuffer(row[f"ids{side}"], np.int64)
        self.copies = np.frombuffer(row[f"copies{side}"], np.int64)
        given, dim = row[f"vectors{side}"], row[f"dim{side}"]
        self.unit = _unit(np.frombuffer(given, np.float32 if len(given) == 4 * len(self.ids) * dim else np.float64).reshape(-1, dim))
        self.scale = float(np.abs(self.unit).max()) / 127
        self.int8 = np.rint(self.unit / self.scale).astype(np.int8)
        self.error = np.sqrt(((self.unit - self.int8 * self.scale) ** 2).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows. Sums of up to 1,024 products of int8 numbers are exact in single precision."""
    if a.shape[1] <= 1024:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum(_products(a[:, i : i + 1024], b[:, i : i + 1024]).astype(np.float64) for i in range(0, a.shape[1], 1024))


def _linked(a: _Block, b: _Block, least: float) -> np.ndarray:
    """Which vectors of two blocks have a cosine of at least ``least``.

    With u = s q + r and v = t p + o, |u v - s t (q p)| <= |r| + (1 + |r|) |o|. A pair whose product of int8 vectors leaves no doubt
    is decided by it; the others are computed again in double precision.
    """
    out = np.zeros((len(a.ids), len(b.ids)), bool)
    step = a.scale * b.scale
    worst = a.error.max() + (1 + a.error.max()) * b.error.max() + _SLACK
    for low in range(0, len(a.ids), _ROWS):
        rows = slice(low, low + _ROWS)
        product = _products(a.int8[rows], b.int8)
        near = product >= (least - worst) / step
        if not near.any():
            continue
        i = np.flatnonzero(near.any(axis=1))
        j = np.flatnonzero(near.any(axis=0))
        about = product[np.ix_(i, j)].astype(np.float64) * step
        err = a.error[rows][i]
        bound = err[:, None] + (1 + err[:, None]) * b.error[j][None, :] + _SLACK
        sure, maybe = about - bound >= least, about + bound >= least
        doubt = maybe & ~sure
        if doubt.any():
            r, c = np.flatnonzero(doubt.any(axis=1)), np.flatnonzero(doubt.any(axis=0))
            exact = a.unit[rows][i[r]] @ b.unit[j[c]].T
            doubt[np.ix_(r, c)] &= exact >= least
        out[np.ix_(low + i, j)] = sure | doubt
    return out


def _tile(batch: pa.RecordBatch, least: float) -> pa.RecordBatch:
    counts: list[tuple[int, int]] = []
    links: list[tuple[int, int]] = []
    for row in batch.to_pylist():
        a, b = _Block(row, "1"), _Block(row, "2")
        linked = _linked(a, b, least)
        if row["block1"] == row["block2"]:
            linked |= linked.T  # rounding may differ with the order
            np.fill_diagonal(linked, False)
        else:
            counts += zip(b.ids.tolist(), (a.copies @ linked).tolist(), strict=True)
        counts += zip(a.ids.tolist(), (linked @ b.copies).tolist(), strict=True)
        keyed = linked & (a.ids >= 0)[:, None] & (b.ids >= 0)  # no component passes by a vector without a key
        links += spanning_forest(keyed, a.ids, b.ids)
    counts = [x for x in counts if x[1]]
    a = [x for x, _ in counts] + [x for x, _ in links]
    b = [None] * len(counts) + [x for _, x in links]
    n = [x for _, x in counts] + [None] * len(links)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """(key, n_links, component_id, kept): how many other vectors have a cosine of at least ``least``, and the smallest key reached by links.

    Equal vectors become one with a count. Blocks of up to about 4,096 vectors hold int8 numbers of one scale; a task multiplies two blocks
    and knows each vector's quantisation error, so that only pairs that may be on either side of the threshold are computed
    in double precision. A task returns link counts and a spanning forest, never all pairs. Blocks are cut from cells around
    pivots (a bounded sample), and two blocks whose cones of directions lie further apart than the threshold's angle are
    not multiplied: what is left grows with the square of a cell, or of the table where directions are spread evenly. That is time
    alone: blocks meet where their files are read, in a task for two files, and are not shuffled.

    Vectors that are null, zero, or hold null or non-finite numbers link with nothing, and vectors only link with others of
    their dimension. Repeated rows are other vectors. A row with a null key counts its links and is
    counted as the other end of links, but has no component: nothing is reached by it. Other columns are ignored; an empty table gives no rows.
    Runs its jobs when called.
    """
    kind = vectors.schema[vector].dataType.simpleString()
    every = vectors.select(
        vectors[f"`{key}`"].cast("long").alias("id"), vectors[f"`{vector}`"].cast(kind if kind == "array<float>" else "array<double>").alias("vector")
    )
    good = every.where(usable("vector"))
    # Numbers of classes without a key are negative.
    number = F.monotonically_increasing_id()
    classes = good.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = stage(classes.withColumn("class", F.when(F.col("rep").isNull(), -1 - number).otherwise(number)), "classes")
    # From here on a row is known by its class, so that vectors are on disk once, or twice while blocks are made.
    rows = stage(every.join(classes.select("vector", "class"), "vector", "left").select("id", "class"), "rows")
    known = stage(classes.select("class", "rep", "copies"), "known")
    size = F.size("vector").alias("dim")
    spark = vectors.sparkSession
    sample = classes.select(size, "vector", F.xxhash64("vector").alias("h")).orderBy("h", "vector").limit(PIVOTS).collect()
    pivots = {d: _unit(np.array([r["vector"] for r in sample if r["dim"] == d])) for d in {r["dim"] for r in sample}}
    total = max(1, classes.count())

    def cells(batch: pa.RecordBatch) -> pa.RecordBatch:
        column, cell = batch.column(batch.schema.names.index("vector")), np.zeros(batch.num_rows, np.int64)
        dims = np.diff(np.asarray(column.offsets))
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            near = pivots.get(int(d))
            wanted = max(1, min(len(near), math.ceil(total / BLOCK))) if near is not None else 1
            best = (_unit(_matrix(column.take(pa.array(at)), int(d))) @ near[:wanted].T).argmax(axis=1) if wanted > 1 else 0
            cell[at] = int(d) * PIVOTS + best
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    kind = classes.schema["vector"].dataType.simpleString()
    placed = map_batches(classes.select("vector", "copies", "class"), cells, f"vector {kind}, copies long, class long, cell long")
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("parts"))
    block = F.xxhash64("cell", F.pmod(F.xxhash64("vector"), F.col("parts")))
    blocks = placed.join(parts, "cell").withColumn("block", block).select("block", "class", "copies", "vector")
    tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(total / BLOCK))
    blocks = stage(blocks.repartition(tasks, "block").groupBy("block").applyInArrow(_block_row, BLOCK_SCHEMA), "blocks")
    unstage(classes)
    # Every file of blocks meets every other where it is read: pairs of blocks grow with the square of the table, and are never on disk.
    one, two = (blocks.select(*(F.col(c).alias(f"{c}{side}") for c in blocks.columns)).hint("shuffle_replicate_nl") for side in (1, 2))
    cosine = F.aggregate(F.zip_with("axis1", "axis2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))) - F.col("angle1") - F.col("angle2")
    near = (F.col("block1") >= F.col("block2")) & F.col("dim1").between(F.col("dim2"), F.col("dim2")) & (apart <= math.acos(least) + 1e-6)
    told = [f"{c}{side}" for c in ("block", "dim", "ids", "copies", "vectors") for side in (1, 2)]
    tiles = one.join(two, near).select(*told)
    found = stage(map_batches(tiles, lambda batch: _tile(batch, least), "a long, b long, n long"), "found")
    counts = found.where("n is not null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    reached = components(found.where("b is not null")).select(F.col("id").alias("class"), F.col("component_id").alias("home"))
    reached = stage(reached.join(known.select("class", "rep"), "class"), "reached")
    reached = reached.join(reached.groupBy("home").agg(F.min("rep").alias("component_id")), "home").select("class", "component_id")
    known = known.join(counts, "class", "left").join(reached, "class", "left")
    known = known.select("class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component_id", "rep").alias("c"))
    return rows.join(known, "class", "left").select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("c", "id"), F.lit(True)).alias("kept"),
    )
