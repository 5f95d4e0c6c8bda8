"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A run is a stretch of consecutive words with smallest period q, at least ``shortest`` and 2 q words long, that no neighbouring word
extends keeping period q. A square whose next word breaks the period (a branching one) starts where two suffixes, a period apart, part
after exactly that period: they lie in different children of an interval of equal LCP whose depth is the period. So for each interval
the suffixes of its smaller child are looked up a period before and after themselves in the inverse suffix array. Each such square is
the last of its run; it is rotated to the left as far as the words agree, and squares of one stretch are merged to its least period.
Intervals are bounds in arrays: no tree is built. All texts of an Arrow batch share one suffix array, in which they never match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowlens.llm.common import map_batches
from rowlens.llm.words import Words, mix, sequences, whole, words_of

PAIRS = 1 << 20  # suffixes looked up at a time; it bounds memory, not what is looked up


def _stretches(hashes: np.ndarray, first: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that can hold runs.

    Every word of a run lies in one of its sequences of half of ``shortest`` words that stands in the run twice, a period apart. Words that
    lie in no sequence that its stretch repeats are in no run, and a stretch is cut at them until it only holds others.
    """
    half = (shortest + 1) // 2
    grams = sequences(hashes, half)
    low, high = first[:-1], first[1:]
    while True:
        long = high - low >= shortest
        low, high = low[long], high[long]
        sizes = high - low - half + 1
        total = int(sizes.sum())
        if not total:
            return low, high
        owner = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(total) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        keys = grams[at] + mix(owner.astype(np.uint64) + np.uint64(1))
        order = np.argsort(keys)
        equal = keys[order[1:]] == keys[order[:-1]]
        again = np.zeros(total, bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        opens, closes = at[again], at[again] + half
        # Sequences of one stretch that touch or overlap are one stretch; those of two stretches are not.
        new = np.ones(len(opens), bool)
        new[1:] = (opens[1:] > closes[:-1]) | (owner[again][1:] != owner[again][:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(opens))[: len(starts)] - 1
        before = int((high - low).sum())
        low, high = opens[starts], closes[ends]
        if int((high - low).sum()) == before:
            return low, high


def _ranks(words: np.ndarray, end: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Ranks of the sequences of 1, 2, 4, ... words from each place on, cut at the end of the stretch, until all differ.

    Equal sequences of one stretch have equal ranks, others don't. One more entry is at the end, which equals nothing.
    """
    n = len(words)
    _, word = np.unique(words, return_inverse=True)
    _, rank = np.unique(owner * np.int64(n + 1) + word, return_inverse=True)
    levels, step, place = [], 1, np.arange(n)
    while True:
        levels.append(np.append(rank, -1))
        if n == 0 or rank.max() == n - 1:
            return levels
        inside = place + step < end
        then = np.where(inside, rank[np.minimum(place + step, n - 1)] + 1, 0)
        _, rank = np.unique(rank * np.int64(n + 1) + then, return_inverse=True)
        step *= 2


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words in which the suffixes at ``a`` and ``b`` agree."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        out += (levels[k][a + out] == levels[k][b + out]).astype(np.int64) << k
    return out


def _common_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words in which what stands before ``a`` and before ``b`` agrees."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a - out - (1 << k), b - out - (1 << k)
        same = (x >= 0) & (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(y, 0)])
        out += same.astype(np.int64) << k
    return out


def _nearest(depth: np.ndarray, step: int, lower: bool) -> np.ndarray:
    """For each entry above 0 the nearest one in direction ``step`` that is less (or not greater), by jumps along those found so far.

    The first and the last entry are below 0.
    """
    jump = np.arange(len(depth)) + step
    jump[0], jump[-1] = 0, len(depth) - 1
    todo = np.flatnonzero(depth > 0)
    while len(todo):
        to = depth[jump[todo]]
        todo = todo[to >= depth[todo]] if lower else todo[to > depth[todo]]
        jump[todo] = jump[jump[todo]]
    return jump


def _squares(levels: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, period) of every branching square."""
    inverse = levels[-1][:-1]
    n = len(inverse)
    if n < 2:
        return
    suffix = np.empty(n, np.int64)
    suffix[inverse] = np.arange(n)
    depth = np.full(n + 1, -1, np.int64)
    depth[1:n] = _common(levels, suffix[:-1], suffix[1:])
    left, right = _nearest(depth, -1, True), _nearest(depth, 1, False)
    # A border k of depth d parts the suffixes left[k] to k - 1 from those at k to right[k] - 1.
    border = np.flatnonzero(depth > 0)
    low, high, period = left[border], right[border], depth[border]
    before = border - low <= high - border
    count = np.where(before, border - low, high - border)
    begin = np.where(before, low, border)
    upto = np.cumsum(count)
    at = 0
    while at < len(border):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] - count[at] + PAIRS, "right")))
        sizes = count[at:to]
        own = np.repeat(np.arange(at, to), sizes)
        member = suffix[begin[own] + np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        # The other child of the member's border.
        open_, close = np.where(before, border, low)[own], np.where(before, high, border)[own]
        for other in (member + period[own], member - period[own]):
            place = inverse[np.clip(other, 0, n - 1)]
            hit = (other >= 0) & (other < n) & (place >= open_) & (place < close)
            yield np.minimum(member, other)[hit], period[own][hit]
        at = to


def word_runs(hashes: np.ndarray, first: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period; text i has the words ``first[i]`` to ``first[i + 1] - 1``."""
    low, high = _stretches(hashes, first, shortest)
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    back = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) + np.repeat(low - back, sizes)
    levels = _ranks(hashes[place], np.repeat(back + sizes, sizes), owner)
    found = list(_squares(levels))
    start = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.int64)
    period = np.concatenate([p for _, p in found]) if found else np.zeros(0, np.int64)
    end = start + 2 * period
    start = start - _common_before(levels, start, start + period)
    long = end - start >= shortest
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return place[start], place[end - 1] + 1, period


def _collapsed(words: Words, gone: np.ndarray, text: int) -> str:
    low, high = words.first[text], words.first[text + 1]
    at = np.flatnonzero(~gone[low:high]) + low
    data = words.data
    return b" ".join(data[s:e].tobytes() for s, e in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)).decode("utf-8")


def _plain(words: Words, text: int) -> str:
    return b" ".join(words.data[words.offset[text] : words.offset[text + 1]].tobytes().split()).decode("utf-8")


def _batch(batch: pa.RecordBatch, shortest: int) -> pa.RecordBatch:
    words = words_of(batch.column("value"))
    start, end, period = word_runs(words.hashes(), words.first, shortest)
    edge = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    gone = np.cumsum(edge[:-1]) > 0
    text = np.searchsorted(words.first, start, "right") - 1
    lists = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
    fields = {"start": start - words.first[text], "length": end - start, "period": period}
    runs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in fields.values()], names=list(fields))
    texts = [_collapsed(words, gone, i) if lists[i] < lists[i + 1] else _plain(words, i) for i in range(batch.num_rows)]
    columns = [batch.column("id"), pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(lists), runs), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 12) -> DataFrame:
    """(key, n_words, runs, collapsed) for each row: its runs by start and period, and its text without what they repeat.

    ``runs`` holds (start, length, period) in words from 0. ``collapsed`` has the words, joined by one space, that no run contains after its
    first period. Words are runs of characters other than 0x20 and 0x09-0x0D, compared by 64-bit hashes. A text is looked at as a whole,
    on its own, where it is read: nothing is shuffled. A null or empty text has no words, no runs and an empty collapsed text; a null key
    stays null; repeated rows get equal results; a very long text takes memory in proportion to it, times the logarithm of its repeated part.
    An empty table gives none, and other columns of ``docs`` play no part, whatever their names. Runs no job.
    """
    if shortest < 2:
        raise ValueError("a run has two words at least")
    rows = docs.select(docs[f"`{key}`"].alias("id"), docs[f"`{text}`"].cast("string").alias("value"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return map_batches(rows, lambda batch: _batch(batch, shortest), schema).withColumnRenamed("id", key)
