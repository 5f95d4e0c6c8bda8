"""Shards of near-equal size by sampled splitters."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowlens.llm.common import stage, two_columns

#: Ranges that are cut for each shard, and sampled keys for each range: what the driver holds is 16 * 64 * shards keys.
RANGES, SAMPLED = 64, 16
_PREFIX = 12  # leading bits of a key by which rows find their range


def _splitters(sample: list[tuple[int, float]], ranges: int) -> list[int]:
    """Lower bounds of the ranges but the first: weighted quantiles of the sampled keys. A key over a whole quantile, by all its rows, stands alone."""
    weights: dict[int, float] = {}
    for key, weight in sample:
        weights[key] = weights.get(key, 0.0) + weight
    total = sum(weights.values())
    bounds, done, step = [], 0.0, 1
    for key, weight in sorted(weights.items()):
        hit = 0
        while step < ranges and done + weight >= total * step / ranges:
            step, hit = step + 1, hit + 1
        if hit:
            bounds.append(key)
        if hit > 1 and key < (1 << 63) - 1:
            bounds.append(key + 1)
        done += weight
    return sorted(set(bounds))


def _deal(sizes: dict, shards: int) -> dict:
    """Largest range first, each to the shard that holds least so far."""
    heap = [(0, 0, s) for s in range(shards)]
    out = {}
    for part in sorted(sizes, key=lambda p: (-sizes[p][0], -sizes[p][1], p)):
        held, rows, shard = heap[0]
        out[part] = (shard, rows)
        heapq.heapreplace(heap, (held + sizes[part][0], rows + sizes[part][1], shard))
    return out


def shard_rows(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """Deal all rows to ``shards`` shards of near-equal bytes: (key, size, text_crc32, part, sub, shard, slot).

    ``size`` is the text's UTF-8 bytes plus ``overhead``. Rows are ordered by a hash of their text, so copies stay
    together. Keys are sampled with chances in proportion to size, and their quantiles cut the key's range into 64 ranges
    for each shard. Every range's bytes are then summed exactly. One with over twice its share is subdivided by a second hash
    of the text; copies of one text, by a hash of the key once they fill over half a shard, and what shares that too by a number that each row has. Shards get whole (sub)ranges, the largest first.
    ``slot`` numbers a shard's rows without gaps. Runs on the same files agree.

    A null text has no bytes and the checksum 0; null keys and repeated rows are rows like others; an empty table gives
    none. Other columns are ignored. Only keys, sizes and checksums are staged and shuffled; the driver holds the sampled
    keys and one row per range, both bounded by ``shards``. Runs its jobs when called.
    """
    body = F.coalesce(F.col("value"), F.lit(""))
    rows = stage(
        two_columns(docs, key, text).select(
            "id",
            (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
            F.xxhash64(body).alias("by"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    share = max(1.0, total / (shards * RANGES))
    weight = F.col("size") * F.lit(SAMPLED / share)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(1), "by", "id", "row"), 11) / F.lit(float(1 << 53))
    sample = rows.where(chance < weight).select("by", F.greatest(weight, F.lit(1.0)).alias("w"))
    bounds = _splitters([(r["by"], r["w"]) for r in sample.collect()], shards * RANGES)
    low, cuts = -(1 << 63), []
    for part, high in enumerate([*bounds, 1 << 63]):
        cuts += [(p, low, high - 1, part) for p in range(low >> (64 - _PREFIX), (high - 1 >> (64 - _PREFIX)) + 1)] if high > low else []
        low = high
    spark = rows.sparkSession
    # At most one row for each prefix and splitter, so its size is bounded by the number of shards.
    ranges = F.broadcast(spark.createDataFrame(cuts, "prefix long, low long, high long, part int"))
    placed = rows.withColumn("prefix", F.shiftright("by", 64 - _PREFIX)).join(ranges, "prefix").where("by between low and high")
    filled = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.min("by").alias("one"), F.max("by").alias("other")).collect()
    pieces = []
    for r in filled:
        alone = r["one"] == r["other"]
        if r["bytes"] > (total / shards / 2 if alone else 2 * share):
            pieces.append((r["part"], int(-(-r["bytes"] // share)), alone))
    divided = F.broadcast(spark.createDataFrame(pieces, "part int, pieces int, alone boolean"))
    second = F.when(F.col("alone"), F.xxhash64(F.lit(2), "id")).otherwise(F.xxhash64(F.lit(2), "by"))
    placed = placed.join(divided, "part", "left").withColumn("sub", F.coalesce(F.pmod(second, F.col("pieces")), F.lit(0)).cast("int"))
    # What a copied text's keys do not divide has one key, or none: rows that only their number tells apart.
    whole = placed.where("alone").groupBy("part", "sub").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > 2 * share).collect()
    equal = F.broadcast(spark.createDataFrame([(r["part"], r["sub"], int(-(-r["bytes"] // share))) for r in whole], "part int, sub int, rows int"))
    third = F.coalesce(F.pmod(F.xxhash64(F.lit(3), "row"), F.col("rows")), F.lit(0)).cast("int")
    placed = placed.join(equal, ["part", "sub"], "left").withColumn("third", third)
    sums = placed.groupBy("part", "sub", "third").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    dealt = _deal({(r["part"], r["sub"], r["third"]): (r["bytes"], r["n"]) for r in sums}, shards)
    home = F.broadcast(spark.createDataFrame([(*p, *s) for p, s in dealt.items()], "part int, sub int, third int, shard int, before long"))
    order = Window.partitionBy("part", "sub", "third").orderBy("by", "id", "text_crc32")
    return placed.join(home, ["part", "sub", "third"]).select(
        F.col("id").alias(key),
        "size",
        "text_crc32",
        "part",
        "sub",
        "shard",
        (F.row_number().over(order) - 1 + F.col("before")).alias("slot"),
    )
