"""How filters of documents interact: what each removes in every order, from masks of failed filters; duplicates by radix tries.

Equal texts are found in compressed tries of whole texts with the least id at each end. A task first puts what it reads into a trie of
bounded size, which keeps one row for each of its texts. These are range-partitioned by prefixes: by short ones, and by longer and
longer ones where the texts of a prefix are more than a trie should hold. Then counts by mask of failed filters say everything else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import stage

#: Bytes of text in a task's trie before its rows are passed on, and of the texts of a prefix before it is divided.
LIMIT = 32 << 20
#: Characters of the first prefixes; each division takes GROWTH times as many.
FIRST, GROWTH, SHOWN = 4, 4, 64

LETTERS = "ABCDE"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"

_ROW = "id bigint, part string, mask int, n bigint, text string"


class Trie:
    """A compressed trie of byte strings. A node is [text, start, end, children, least, rows]: its edge is text[start:end], its path text[:end].

    ``least`` is the least id of the text that ends at a node, None where none does, and ``rows`` counts the rows of that id by (part, mask).
    """

    def __init__(self) -> None:
        self.root: list = [b"", 0, 0, {}, None, None]
        self.size = 0

    def end_of(self, text: bytes) -> list:
        """The node at which ``text`` ends; made if need be, by dividing an edge where texts part."""
        node, at = self.root, 0
        while at < len(text):
            child = node[3].get(text[at])
            if child is None:
                node[3][text[at]] = child = [text, at, len(text), {}, None, None]
                self.size += len(text) - at + 200
                return child
            edge = child[0][child[1] : child[2]]
            if not text.startswith(edge, at):
                low, high = 1, min(len(edge), len(text) - at)
                while low < high:
                    middle = (low + high + 1) // 2
                    low, high = (middle, high) if text.startswith(edge[:middle], at) else (low, middle - 1)
                upper = [child[0], child[1], child[1] + low, {edge[low]: child} if low < len(edge) else {}, None, None]
                child[1] += low
                node[3][text[at]] = child = upper
                self.size += 200
            node, at = child, at + child[2] - child[1]
        return node

    def insert(self, text: bytes, key: int, kind: tuple, n: int) -> list[tuple]:
        """Put rows in; the (id, kind, n) that are now known to have a smaller id with the same text."""
        node = self.end_of(text)
        if node[4] is None or key < node[4]:
            beaten = [] if node[4] is None else [(node[4], *row) for row in node[5].items()]
            node[4], node[5] = key, {kind: n}
            return beaten
        if key > node[4]:
            return [(key, kind, n)]
        node[5][kind] = node[5].get(kind, 0) + n
        return []

    def ends(self) -> Iterator[tuple]:
        """(text, id, kind, n) of the least id of every text."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            waiting += node[3].values()
            if node[4] is not None:
                text = node[0][: node[2]]
                for kind, n in node[5].items():
                    yield text, node[4], kind, n


def failed(text: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a text fails: few words, few different words, many capitals, symbols."""
    words = text.split()
    out = len(words) < 200
    out |= (100 * len(set(words)) < 50 * len(words)) << 1
    out |= (100 * (len(text) - len(text.translate(None, _UPPER))) > 3 * n_chars) << 2
    return out | (len(text) != len(text.translate(None, _SYMBOLS))) << 3


class _Rows:
    """Rows on their way out."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, key: int | None, kind: tuple, n: int, again: bool, text: bytes | None = None) -> None:
        self.rows.append((key, kind[0], kind[1] | again << 4, n, text))
        self.size += 50 + len(text or b"")

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*self.rows, strict=True), kinds, strict=True)]
        columns[4] = columns[4].cast(pa.string())
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(columns, names=["id", "part", "mask", "n", "text"])


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def _near(limit: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a task as (id, part, mask, n, text): the text where a smaller id may be in another task, null where all is known."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, out = Trie(), _Rows()
        for batch in batches:
            chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            for key, part, text, n_chars in zip(batch.column("id").to_pylist(), batch.column("part").to_pylist(), _bytes(batch.column("text")), chars, strict=True):
                kind = (part, failed(text, n_chars))
                if key is None:
                    out.add(key, kind, 1, False)
                    continue
                for beaten in trie.insert(text, key, kind, 1):
                    out.add(*beaten, True)
                if trie.size > limit:
                    for text, key, kind, n in trie.ends():
                        out.add(key, kind, n, False, text)
                        if out.size > 4 << 20:
                            yield out.batch()
                    trie = Trie()
                if out.size > 4 << 20:
                    yield out.batch()
        for text, key, kind, n in trie.ends():
            out.add(key, kind, n, False, text)
            if out.size > 4 << 20:
                yield out.batch()
        if out.rows:
            yield out.batch()

    return run


def _far(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their prefix as (id, part, mask, n, text null); a trie for each prefix."""
    trie, head, out = Trie(), None, _Rows()
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("head", "id", "part", "mask", "n"))
        for at, key, part, mask, n, text in zip(*columns, _bytes(batch.column("text")), strict=True):
            if at != head:
                for _, *row in trie.ends():
                    out.add(*row, False)
                trie, head = Trie(), at
            for beaten in trie.insert(text, key, (part, mask), n):
                out.add(*beaten, True)
            if out.size > 4 << 20:
                yield out.batch()
    for _, *row in trie.ends():
        out.add(*row, False)
    if out.rows:
        yield out.batch()


def _head(length: int) -> Column:
    """A prefix of ``text``; a long one as its beginning and a hash."""
    if length <= SHOWN:
        return F.left("opening", F.lit(length))
    return F.concat("opening", F.hex(F.xxhash64(F.left("text", F.lit(length)))))


def _with_heads(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Rows with the prefix by which they are dealt as ``head``, and the bytes of all their texts.

    No prefix has texts of more than ``limit`` bytes, unless all are one text. Only the prefixes that are divided are looked up; there are
    no more of them than the bytes of all texts over ``limit``.
    """
    length, total, heads = FIRST, None, rows.withColumn("head", _head(FIRST))
    while True:
        sizes = heads.groupBy("head").agg(F.sum("size").alias("size"), F.max("size").alias("longest"), F.max(F.length("text") > length).alias("more"))
        sizes = stage(sizes, "prefixes")
        if total is None:
            total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        hot = sizes.where((F.col("size") > limit) & F.col("more")).select(F.col("head").alias("hot"))
        if hot.isEmpty():
            return heads, total
        length *= GROWTH
        # A head that was not divided in the last round is not hot now, either.
        heads = heads.join(hot, F.col("head") == F.col("hot"), "left")
        heads = heads.withColumn("head", F.when(F.col("hot").isNotNull(), _head(length)).otherwise(F.col("head"))).drop("hot")


def failed_filters(docs: DataFrame, key: str = "doc_id", part: str = "lang", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, part, mask, n): rows by id, part and the filters they fail; bits 0 to 3 are A to D, bit 4 says that a smaller id has the same text.

    Rows equal in id, part and text are one row with their number ``n``, or several that add up to it. A null text is empty, a null part is the
    empty string; a row with a null id is no duplicate, nor is any row for its sake. Other columns of ``docs`` play no part, whatever
    their names; an empty table gives no rows. A task holds the texts of one prefix, ``limit`` bytes or one longer text. Copies of a
    text are one row for each ``limit`` bytes that a task reads before they are shuffled. Runs its jobs when called.
    """
    part_of = F.coalesce(docs[f"`{part}`"].cast("string"), F.lit("")).alias("part")
    rows = docs.select(docs[f"`{key}`"].cast("long").alias("id"), part_of, docs[f"`{text}`"].cast("string").alias("text"))
    near = rows.mapInArrow(_near(limit), _ROW)
    near = stage(near.withColumns({"size": F.octet_length("text").cast("long"), "opening": F.left("text", F.lit(SHOWN))}), "near")
    heads, total = _with_heads(near.where("text is not null"), limit)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // limit))
    ranges = heads.select("head", "id", "part", "mask", "n", "text").repartitionByRange(tasks, "head").sortWithinPartitions("head")
    far = ranges.mapInArrow(_far, _ROW).drop("text")
    return far.unionByName(near.where("text is null").select(*far.columns))


def interactions(masks: DataFrame, labels: DataFrame, key: str = "doc_id", good: str = "quality", bad: str = "toxic") -> DataFrame:
    """One row for each part, order of the five filters and step: what the step's filter does after those before it.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley). A document counts as good or toxic if
    any of its rows in ``labels`` says 1. ``shapley`` is what the filter removes, summed over all 120 orders: a document that fails k filters is removed by each
    of them in 120 / k orders. Rows are added up by id before they meet the labels, and by mask after; then a part has 32 rows at most.
    """
    marks = labels.select(labels[f"`{key}`"].cast("long").alias("id"), labels[f"`{good}`"].alias("good"), labels[f"`{bad}`"].alias("bad"))
    marks = marks.groupBy("id").agg(*(F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("good", "bad")))
    rows = masks.groupBy("id", "part", "mask").agg(F.sum("n").alias("n")).join(marks, "id", "left")
    counts = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.sum(F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "bad")))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(LETTERS)))
    each = counts.withColumn("filter_order", F.explode(orders))
    bits = F.expr(f"transform(split(filter_order, ''), c -> shiftleft(1, instr('{LETTERS}', c) - 1))")
    each = each.select("*", F.posexplode(bits).alias("step", "bit"), bits.alias("bits")).withColumn("step", F.col("step") + 1)
    each = each.withColumn("earlier", F.expr("aggregate(slice(bits, 1, step - 1), 0, (all, b) -> all | b)"))
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    total = lambda test, value: F.coalesce(F.sum(F.when(test, value)), F.lit(0)).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, F.col("n")).alias("kept"),
        total(fails & ~gone, F.col("n")).alias("removed"),
        total(fails & gone, F.col("n")).alias("redundant"),
        total(F.col("mask") == F.col("bit"), F.col("n")).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("bad")).alias("toxic_lost"),
        total(fails, F.expr("n * 120 div greatest(bit_count(mask), 1)")).alias("shapley"),
    )
