"""Removal of word passages that stand earlier in the corpus, by suffix automata of reference shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import map_batches, stage, two_columns
from rowlens.llm.words import Words, sequences, whole, words_of

#: Words of a reference shard, and of the passages that one copy of its automaton reads.
SHARD_WORDS, STREAM_WORDS = 100_000, 400_000
_PLACE = (1 << 26) - 1


class Automaton:
    """Suffix automaton of word sequences, added in order; each state knows the first place where its sequences end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, length: int, edges: dict[int, int], link: int, first: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], self.first[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], place: int) -> None:
        """Add a sequence whose first word is at ``place``."""
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for at, c in enumerate(sequence, place):
            q = nexts[last].get(c)
            if q is not None:
                last = q if length[last] + 1 == length[q] else self._split(last, c, q)
                continue
            p, last = last, self._state(length[last] + 1, {}, 0, at)
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = last
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[last] = q if length[p] + 1 == length[q] else self._split(p, c, q)

    def matches(self, sequence: list[int], least: int) -> list[int]:
        """Matching statistics cut at ``least``: for each word the first place where the ``least`` words up to it end in the reference, or -1."""
        nexts, link, length, first = self.next, self.link, self.length, self.first
        state, n, out = 0, 0, []
        for c in sequence:
            q = nexts[state].get(c)
            while q is None and state:
                state = link[state]
                n = length[state]
                q = nexts[state].get(c)
            if q is None:
                out.append(-1)
                continue
            state, n = q, n + 1
            if n < least:
                out.append(-1)
                continue
            while length[link[state]] >= least:  # the state of exactly the last words
                state = link[state]
            n = min(n, length[state])
            out.append(first[state])
        return out


def _anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of all ``gram`` words; of each window, whether it lies in one text and the place of its anchor.

    A window's anchor is its gram with the least hash, the last of equals: equal windows have equal anchors at equal places.
    """
    hashes = words.hashes()
    grams = sequences(hashes, gram)
    if len(hashes) < window:
        none = np.zeros(0, np.int64)
        return hashes, grams, none.astype(bool), none
    keys = (grams & ~np.uint64(_PLACE)) | (_PLACE - np.arange(len(grams))).astype(np.uint64)
    width, have = window - gram + 1, 1
    while have * 2 <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    if width > have:
        keys = np.minimum(keys[: -(width - have)], keys[width - have :])
    return hashes, grams, whole(words.first, window), _PLACE - (keys & np.uint64(_PLACE)).astype(np.int64)


def _find_anchors(batch: pa.RecordBatch, window: int, gram: int) -> pa.RecordBatch:
    words = words_of(batch.column(1))
    _, grams, inside, anchor = _anchors(words, window, gram)
    picked = np.zeros(len(grams), bool)
    picked[anchor[inside]] = True
    at = np.flatnonzero(picked)
    text = np.searchsorted(words.first, at, "right") - 1
    ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
    columns = [pa.array(ids[text]), pa.array((at - words.first[text]).astype(np.int32)), pa.array(grams[at].view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["id", "at", "gram"])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past last of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _find_passages(batch: pa.RecordBatch, window: int, gram: int) -> pa.RecordBatch:
    words = words_of(batch.column(1))
    hashes, grams, inside, anchor = _anchors(words, window, gram)
    hits = batch.column(2)
    repeated = np.zeros(len(grams) + 1, bool)
    text = np.repeat(np.arange(len(hits)), np.diff(np.asarray(hits.offsets)))
    at = words.first[text] + np.asarray(hits.flatten().to_numpy(zero_copy_only=False), np.int64)
    repeated[at[at < words.first[text + 1]].clip(max=len(grams))] = True  # a row may share its key with another text
    candidate = inside & repeated[anchor] if len(anchor) else np.zeros(0, bool)
    # Runs must not join windows of two texts: the last windows of a text are not inside it, so they don't.
    first, last = _runs(candidate)
    owner = np.searchsorted(words.first, first, "right") - 1
    ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
    parts = [hashes[a : b + window - 1].tobytes() for a, b in zip(first, last, strict=True)]
    columns = [pa.array(ids[owner]), pa.array((first - words.first[owner]).astype(np.int32)), pa.array((last - first + window - 1).astype(np.int32))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], ["id", "start", "n", "words"])


def _windows(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    ids, out, owner = batch.column(0).to_pylist(), [], []
    for i, words in zip(ids, batch.column(3).to_pylist(), strict=True):
        out.append(sequences(np.frombuffer(words, np.uint64), window).view(np.int64))
        owner.append(np.full(len(out[-1]), i, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(owner)), pa.array(np.concatenate(out))], ["id", "window"])


def _match_shard(table: pa.Table, window: int) -> pa.Table:
    """Build the automaton of the group's reference passages and stream the other passages through it."""
    table = table.sort_by([("reference", "descending"), ("id", "ascending"), ("start", "ascending")])
    ids, starts = table.column("id").to_pylist(), table.column("start").to_pylist()
    words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
    _, code = np.unique(np.concatenate(words), return_inverse=True)
    code = np.split(code, np.cumsum([len(w) for w in words])[:-1])
    reference = table.column("reference").to_pylist()
    automaton, place = Automaton(), 0
    of_id, of_start = [], []
    out: list[tuple[int, int, int]] = []
    memory: dict[bytes, list[int]] = {}
    for i, start, symbols, is_reference in zip(ids, starts, code, reference, strict=True):
        if is_reference:
            automaton.add(symbols.tolist(), place)
            place += len(symbols)
            of_id.append(np.full(len(symbols), i, np.int64))
            of_start.append(np.arange(start, start + len(symbols)))
            continue
        if isinstance(of_id, list):
            of_id, of_start = np.concatenate(of_id), np.concatenate(of_start)
        ends = memory.get(key := symbols.tobytes())
        if ends is None:  # equal passages match alike
            ends = memory[key] = np.array(automaton.matches(symbols.tolist(), window))
        at = np.flatnonzero(ends >= 0)
        ref, begin = of_id[ends[at]], of_start[ends[at]] - window + 1
        mine = start + at - window + 1
        mine = mine[(ref < i) | ((ref == i) & (begin < mine))]
        if len(mine):
            cut = np.flatnonzero(np.diff(mine) > window)
            out += [(i, int(a), int(b) + window) for a, b in zip(mine[np.r_[0, cut + 1]], mine[np.r_[cut, len(mine) - 1]], strict=True)]
    columns = list(zip(*out, strict=True)) or [[], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["id", "begin", "end"])


def earlier_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, gram: int = 8) -> DataFrame:
    """(id, begin, end): maximal spans of words covered by windows of ``window`` words that also start earlier in the corpus.

    Earlier means: in a text with a smaller key, or before in the same text.
    1. Anchors (the least of the ``gram``-word hashes in a window) that occur once exclude the windows they stand for; runs of
       the other windows are candidate passages, as arrays of word hashes.
    2. The smallest key that holds a passage's window says which texts serve as reference. These are cut into shards of about
       100,000 words, so that an automaton's size is bounded, and a text's passages go to the shards that hold its windows.
    3. A task builds the suffix automaton of one shard and streams passages through it: the matching statistics and the first
       place of each match decide what is a span. A shard with many readers is copied, one copy for 400,000 words of them.

    Counts are formed before rows are shuffled, and copies of a passage only ever meet their reference, not each other. Words
    are compared by 64-bit hashes. Null texts and keys take part in nothing; rows with the same key count as one text. Runs its jobs when called.
    """
    rows = two_columns(docs, key, text).where("id is not null and value is not null")
    anchors = stage(map_batches(rows, lambda b: _find_anchors(b, window, gram), "id long, at int, gram long"), "anchors")
    repeated = anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    hits = anchors.join(repeated, "gram", "left_semi").groupBy("id").agg(F.collect_list("at").alias("hits"))
    marked = rows.join(stage(hits, "hits"), "id").select("id", "value", "hits")
    passages = stage(map_batches(marked, lambda b: _find_passages(b, window, gram), "id long, start int, n int, words binary"), "passages")

    windows = map_batches(passages, lambda b: _windows(b, window), "id long, window long")
    held = windows.groupBy("window").agg(F.min("id").alias("ref"), F.count("*").alias("n")).where("n > 1").select("window", "ref")
    routes = stage(windows.join(held, "window").select("id", "ref").distinct(), "routes")

    refs = routes.select(F.col("ref").alias("id")).distinct()
    lengths = passages.groupBy("id").agg(F.sum("n").alias("n"))
    total = refs.join(lengths, "id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(max(1, -(-total // SHARD_WORDS)))).cast("int")
    readers = stage(routes.select("id", shard("ref").alias("shard")).distinct(), "readers")
    copies = readers.join(lengths, "id").groupBy("shard").agg(F.ceil(F.sum("n") / F.lit(STREAM_WORDS)).cast("int").alias("copies"))
    copies = stage(copies, "copies")
    dealt = readers.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("id"), "copies").cast("int"))
    given = refs.withColumn("shard", shard("id")).join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    both = given.select("id", "shard", "copy", F.lit(True).alias("reference")).unionByName(dealt.select("id", "shard", "copy", F.lit(False).alias("reference")))
    work = both.join(passages, "id").groupBy("shard", "copy")
    return work.applyInArrow(lambda table: _match_shard(table, window), "id long, begin long, end long")


def _remove(batch: pa.RecordBatch, with_text: bool) -> pa.RecordBatch:
    out: list[list] = [[], [], [], []]
    for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
        words = (text or "").encode().split()
        n, kept = len(words), words
        if spans:
            covered = np.zeros(n + 1, np.int64)
            for span in spans:
                covered[min(span["begin"], n)] += 1
                covered[min(span["end"], n)] -= 1
            inside = np.cumsum(covered[:-1]) > 0
            kept = [w for w, x in zip(words, inside.tolist(), strict=True) if not x]
        joined = b" ".join(kept)
        for column, x in zip(out, (n, n - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None), strict=True):
            column.append(x)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, with_text: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256[, kept_text]) of every row after the spans of :func:`earlier_spans` are taken out.

    Kept words are joined by one space. A null text has no words; a row with a null key keeps all its words. Repeated rows get
    equal results, extra columns are ignored, an empty table gives no rows.
    """
    spans = stage(earlier_spans(docs, key, text, window), "spans")
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    rows = two_columns(docs, key, text).join(spans, "id", "left").select("id", "value", "spans")
    schema = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    made = map_batches(rows, lambda b: _remove(b, with_text), schema).withColumnRenamed("id", key)
    return made if with_text else made.drop("kept_text")
