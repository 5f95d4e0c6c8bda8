"""Near-duplicate texts by HyperMinHash registers, banding, and verification on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import map_batches, stage, two_columns
from rowlens.llm.graph import components, spanning_forest
from rowlens.llm.words import mix, sequences, whole, words_of

#: Registers of a sketch (a power of two), and registers of a band. At a similarity of 0.8 all 32 bands miss with a chance of 5e-8.
REGISTERS, BAND = 128, 4
MANTISSA = 10  # bits kept after the leading one
TILE = 256  # sketches on a side of a tile in which members of a band are compared
#: An estimate this far below the threshold is no candidate: over five standard deviations of 128 registers.
MARGIN = 0.2

_EMPTY = np.uint16(0xFFFF)
_WIDTH = 64 - int(np.log2(REGISTERS))


def _probes() -> np.ndarray:
    """For each bucket an order of all buckets, the same everywhere, in which an empty one looks for a full one."""
    with np.errstate(over="ignore"):
        rank = mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))
    return np.argsort(rank.reshape(REGISTERS, REGISTERS), axis=1)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles in lower case; of fewer words, the hash of all of them."""
    words = words_of(texts)
    hashes = words.hashes(lower=True)
    grams, inside = sequences(hashes, n), whole(words.first, n)
    out = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if high - low >= n:
            out.append(np.unique(grams[low : high - n + 1]))
        elif high > low:
            out.append(sequences(hashes[low:high], high - low) + np.uint64(high - low))
        else:
            out.append(np.zeros(0, np.uint64))
    assert inside.sum() == sum(max(0, h - l - n + 1) for l, h in zip(words.first[:-1], words.first[1:], strict=True))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash sketches: of each bucket's least hash, the count of leading zeros (6 bits) and the 10 bits after the first one.

    The first bits of a hash name its bucket. Empty buckets take over a register by a fixed probing order, so that sets of few
    shingles have as many registers to compare; an empty set has none.
    """
    out = np.full((len(sets), REGISTERS), _EMPTY, np.uint16)
    sizes = [len(s) for s in sets]
    if sum(sizes):
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        bucket = (every >> np.uint64(_WIDTH)).astype(np.int64)
        cell = owner * REGISTERS + bucket
        first = np.flatnonzero(np.diff(np.concatenate([[-1], cell])))  # sets are sorted, so the first of a bucket is its least
        value = (every[first] & np.uint64((1 << _WIDTH) - 1)) >> np.uint64(_WIDTH - 53)  # 53 bits are exact in double precision
        length = np.frexp(value.astype(np.float64))[1].astype(np.int64)
        zeros = 53 - length
        shift = length - 1 - MANTISSA
        top = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64))
        out.reshape(-1)[cell[first]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | top & np.uint64((1 << MANTISSA) - 1)).astype(np.uint16)
    full = out != _EMPTY
    some = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    if len(some):
        source, have = out[some].copy(), full[some]
        filled, rows = have.copy(), out[some]
        for step in _probes().T:
            take = ~filled & have[:, step]
            rows[take] = source[:, step][take]
            filled |= take
            if filled.all():
                break
        out[some] = rows
    return out


def _sketch(batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
    sets = shingle_sets(batch.column(1), n)
    made = registers(sets)
    with np.errstate(over="ignore"):
        low = [int(s.sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
        high = [int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
    columns = [
        batch.column(0),
        pa.array([len(s) for s in sets], pa.int64()),
        pa.array(np.array(low, np.uint64).view(np.int64)),
        pa.array(np.array(high, np.uint64).view(np.int64)),
        pa.array([r.tobytes() for r in made], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "low", "high", "sketch"])


def _estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarities of two sides' sketches, and the first band in which a pair is equal (or the number of bands).

    Two different registers of one bucket agree by chance with about 2**-MANTISSA / 3; that share of the unequal ones is taken off.
    """
    equal = a[:, None, :] == b[None, :, :]
    chance = 2.0**-MANTISSA / 3
    share = equal.mean(axis=2)
    bands = equal.reshape(len(a), len(b), -1, BAND).all(axis=3)
    return (share - chance) / (1 - chance), np.where(bands.any(axis=2), bands.argmax(axis=2), REGISTERS // BAND)


def _shared(left: list[np.ndarray], right: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of two sides' sets, where ``pairs`` is true."""
    out = np.zeros(pairs.shape, np.int64)
    if pairs.sum() <= 256:
        for i, j in zip(*np.nonzero(pairs), strict=True):
            out[i, j] = len(np.intersect1d(left[i], right[j], assume_unique=True))
        return out
    rows, cols = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
    sides = [[left[i] for i in rows], [right[j] for j in cols]]
    both = np.intersect1d(*(np.concatenate(side) for side in sides))
    found = []
    for side in sides:
        every, owner = np.concatenate(side), np.repeat(np.arange(len(side)), [len(x) for x in side])
        at = np.searchsorted(both, every).clip(max=max(0, len(both) - 1))
        hit = both[at] == every if len(both) else np.zeros(len(every), bool)
        found.append((at[hit], owner[hit]))
    counts = np.zeros((len(rows), len(cols)), np.float32)
    for low in range(0, len(both), 4096):  # columns of two 0/1 matrices; their product counts what is shared
        matrices = []
        for (at, owner), side in zip(found, sides, strict=True):
            now = (at >= low) & (at < low + 4096)
            matrix = np.zeros((len(side), 4096), np.float32)
            matrix[owner[now], at[now] - low] = 1
            matrices.append(matrix)
        counts += matrices[0] @ matrices[1].T
    out[np.ix_(rows, cols)] = counts.astype(np.int64)
    return out


def _compare(table: pa.Table, percent: int) -> pa.Table:
    """Links of a tile: pairs not yet connected, first equal in this band, similar enough by the estimate, and then by their sets.

    A spanning forest of the links is returned, as pairs of components, so that many links of one group are a few rows.
    """
    side, band = np.array(table.column("side").to_pylist()), table.column("band")[0].as_py()
    comp = table.column("comp").to_numpy()
    sets = [np.array(x.values).view(np.uint64) for x in table.column("shingles")]
    sizes, sketch = np.array([len(x) for x in sets]), registers(sets)
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)  # side 0: both
    linked = np.zeros((len(left), len(right)), bool)
    for low in range(0, len(left), 32):
        i = left[low : low + 32]
        similar, first = _estimate(sketch[i], sketch[right])
        linked[low : low + 32] = (similar >= percent / 100 - MARGIN) & (first == band) & (comp[i][:, None] != comp[right][None, :])
    shared = _shared([sets[i] for i in left], [sets[j] for j in right], linked)
    linked &= 100 * shared >= percent * (sizes[left][:, None] + sizes[right][None, :] - shared)
    made = spanning_forest(linked, comp[left], comp[right])
    return pa.table([pa.array([x for x, _ in made], pa.int64()), pa.array([x for _, x in made], pa.int64())], ["one", "other"])


def _comparer(percent: int):
    return lambda table: _compare(table, percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets share at least ``percent`` of their union."""
    one, two = (sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def near_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, percent: int = 80, with_members: bool = False
) -> DataFrame:
    """(key, n_shingles, component_id, kept): texts linked by at least ``percent`` of shared shingles, and the smallest key reached.

    Texts with equal sets become one class. Each class has a sketch of 128 registers of 16 bits; 32 bands of 4 registers
    are the keys under which classes meet. A band's members are linked in two passes, both verified on full sets. First every
    member is compared with the smallest, which connects most groups of copies at one row each. Then the members outside a band's largest
    component meet all of the band in tiles of up to 256 by 256 members, spread over tasks: pairs whose corrected estimate is near the threshold or
    above are verified there, and a tile returns a spanning forest, never all pairs.

    Texts without words have no shingles and link with nothing; null keys too. Rows that share a key are merged by it. Extra columns are
    ignored; an empty table gives no rows. Runs its jobs when called.
    """
    rows = two_columns(docs, key, text)
    schema = "id long, n_shingles long, low long, high long, sketch binary"
    sketched = stage(map_batches(rows, lambda b: _sketch(b, shingle), schema), "sketches")
    usable = sketched.where("id is not null and n_shingles > 0")
    # Two sums of 64-bit hashes and the size stand for a set's identity; equal texts are verified by it.
    same = ["n_shingles", "low", "high"]
    classes = stage(usable.groupBy(*same).agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")), "classes")
    spark = classes.sparkSession
    bands = [F.xxhash64(F.lit(i), F.substring("sketch", 2 * BAND * i + 1, 2 * BAND)) for i in range(REGISTERS // BAND)]
    keyed = classes.select(F.col("rep").alias("id"), F.posexplode(F.array(*bands)).alias("band", "key"))
    groups = stage(keyed.groupBy("band", "key").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1"), "groups")
    members = stage(keyed.join(groups, ["band", "key"]), "members")

    wanted = members.select("id").distinct()

    def shingles(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), shingle)]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "shingles"])

    texts = rows.where("id is not null").join(wanted, "id", "left_semi")
    # A key that several rows share stands for one of them.
    sets = map_batches(texts, shingles, "id long, shingles array<long>").where(F.size("shingles") > 0)
    if rows.groupBy("id").count().where("count > 1 and id is not null").isEmpty() is False:
        sets = sets.groupBy("id").agg(F.max("shingles").alias("shingles"))
    sets = stage(sets, "sets")

    star = members.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(_verified(star, sets, percent), "links")
    homes = members.select("id").distinct().join(components(links), "id", "left").select("id", F.coalesce("component_id", "id").alias("comp"))
    homes = stage(homes, "homes")
    marked = stage(members.join(homes, "id"), "marked")
    # Of a band, only the members outside its largest component ("rows") need to meet the others: row block i, column block j.
    parts = marked.groupBy("band", "key", "comp").agg(F.count("*").alias("m"))
    parts = parts.groupBy("band", "key").agg(F.max_by("comp", F.struct("m", "comp")).alias("largest"), F.max("m").alias("m"), F.sum("m").alias("all"))
    parts = parts.where("m < all")
    blocks = lambda n: F.ceil(n / F.lit(TILE)).cast("int")
    parts = parts.select("band", "key", "largest", blocks(F.col("all")).alias("cols"), blocks(F.col("all") - F.col("m")).alias("rows"))
    dealt = marked.join(parts, ["band", "key"])
    dealt = dealt.withColumns({f"own_{x}": F.pmod(F.xxhash64("id"), F.col(x)).cast("int") for x in ("rows", "cols")})
    tile = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_col = F.transform(upto("rows"), lambda i: tile(i, F.col("own_cols"), 2))
    as_row = F.transform(upto("cols"), lambda j: tile(F.col("own_rows"), j, 1))
    both = F.concat(
        F.array(tile(F.col("own_rows"), F.col("own_cols"), 0)),
        F.filter(as_col, lambda t: t["i"] != F.col("own_rows")),
        F.filter(as_row, lambda t: t["j"] != F.col("own_cols")),
    )
    dealt = dealt.withColumn("tile", F.explode(F.when(F.col("comp") == F.col("largest"), as_col).otherwise(both)))
    dealt = dealt.select("band", "key", "tile.i", "tile.j", "tile.side", "id", "comp")
    tiles = dealt.join(sets, "id").groupBy("band", "key", "i", "j")
    more = tiles.applyInArrow(_comparer(percent), "one long, other long")
    joined = components(more, "one", "other").withColumnRenamed("id", "comp")
    homes = homes.join(joined, "comp", "left").select(F.col("id").alias("rep"), F.coalesce("component_id", "comp").alias("component"))
    known = classes.join(homes, "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    placed = sketched.join(known, same, "left")
    alone = F.col("id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return placed.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def drop_near_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those that a smaller key stands for; columns as they are."""
    gone = near_texts(docs, key, text, shingle, percent).where(~F.col("kept")).select(F.col(key).alias("_gone"))
    return docs.join(gone, docs[f"`{key}`"] == gone["_gone"], "left_anti")
