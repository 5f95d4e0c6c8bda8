"""Connected components of links between rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id): every row that a link names, and the smallest id that links reach from it.

    Each round, every row moves to the neighbour (or itself) of the least random rank, then to where that one moved; links
    shrink to links between the rows moved to. Ranks are new in each round, so a round takes away a fixed share of the
    rows on average, of long chains too, and rounds grow with the logarithm of their number. Sums per row are formed before
    rows are shuffled, so a row with very many links is no hot key. Runs its jobs when called; each round is a staged table.
    """
    left, right = F.col(a).cast("long"), F.col(b).cast("long")
    links = links.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
    links = stage(links.where("a < b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    homes: DataFrame | None = None
    step = 0
    while not links.isEmpty():
        step += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("rank"), F.col(c).alias("id"))  # noqa: E731,B023
        ways = links.select("a", rank("b").alias("to")).unionByName(links.select(F.col("b").alias("a"), rank("a").alias("to")))
        moved = ways.groupBy("a").agg(F.min("to").alias("to")).select("a", F.least(rank("a"), F.col("to"))["id"].alias("to"))
        moved = stage(moved, "moved")
        again = moved.select(F.col("a").alias("to"), F.col("to").alias("then"))
        moved = stage(moved.join(again, "to").select("a", F.col("then").alias("to")), "moved")
        homes = (
            moved.select(F.col("a").alias("id"), "to")
            if homes is None
            else homes.join(moved.select(F.col("a").alias("to"), F.col("to").alias("then")), "to", "left").select("id", F.coalesce("then", "to").alias("to"))
        )
        homes = stage(homes, "homes")
        ends = links.join(moved, "a").select(F.col("to").alias("c"), "b")
        ends = ends.join(moved.select(F.col("a").alias("b"), F.col("to").alias("d")), "b").where("c <> d")
        links = stage(ends.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(), "links")
    least = homes.groupBy("to").agg(F.min("id").alias("component_id"))
    return homes.join(least, "to").select("id", "component_id")


def spanning_forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """As few links as connect what ``linked`` connects."""
    rows, out = linked.any(axis=1), []
    while rows.any():
        first = int(rows.argmax())
        frontier, cols = np.array([first]), np.zeros(linked.shape[1], bool)
        rows[first] = False
        while len(frontier):
            new = linked[frontier].any(axis=0) & ~cols
            cols |= new
            out += [(int(left[first]), x) for x in right[new].tolist()]
            at = np.flatnonzero(rows)
            frontier = at[linked[np.ix_(at, np.flatnonzero(new))].any(axis=1)]
            rows[frontier] = False
            out += [(int(left[first]), x) for x in left[frontier].tolist()]
    return out
