"""Packing of tokenised texts into sequences of equal length by Karmarkar-Karp differencing."""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rowlens.llm.common import two_columns
from rowlens.llm.tokencount import load_tokenizer

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Characters that both libraries class alike in every version of Unicode's tables.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")

#: Share of the tokens that is packed as pieces of a GRAINS-th of a window at first, and the share of windows by which the count may rise
#: before that share is doubled.
CUT, GRAINS, SPARE = 0.06, 32, 0.02

_encodings: dict = {}


def _encode(texts: list[str], tokenizer: str, ranks: str | None) -> Iterator[np.ndarray]:
    """Ids of each text. With ``ranks`` (the tokenizer's vocabulary as ranks) plain texts go the faster way."""
    exact, _ = load_tokenizer(tokenizer)
    if ranks and ranks not in _encodings:
        import tiktoken

        with open(ranks if "/" in ranks else public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = [t.content for t in exact.get_added_tokens_decoder().values()]
        _encodings[ranks] = (tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}), special)
    for text in texts:
        if ranks and not any(s in text for s in _encodings[ranks][1]) and (text.isascii() and text.isprintable() or not _PLAIN.search(text)):
            yield _encodings[ranks][0].encode_to_numpy(text, disallowed_special=())
        else:
            yield np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def difference(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: the window of each size, and the windows' sums.

    Each size begins as a partial partition that fills one window. The two partitions with the largest spread are merged
    again and again, the fullest window of one with the emptiest of the other, until one partition is left.
    """
    heap, merges = [], []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        heap.append((-size if windows > 1 else 0, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = left + right[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        merges.append((a, b, order))
        heapq.heappush(heap, (int(sums[0] - sums[-1]), len(sizes) + len(merges) - 1, sums))
    place = {heap[0][1]: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        slots = np.empty(windows, np.int64)
        slots[order] = place.pop(len(sizes) + k)
        place[a], place[b] = slots, slots[::-1]
    return np.array([place[i][-1] for i in range(len(sizes))]), heap[0][2]


def cut_some(sizes: list[int], share: float, grain: int) -> list[tuple[int, int, int]]:
    """(item, from, length): every item whole, but for some that hold about ``share`` of the tokens, cut into pieces of at most ``grain``."""
    pieces, due = [], 0.0
    for i, size in enumerate(sizes):
        due += size * share
        n = 1
        if due >= size:
            due -= size
            n = -(-size // grain)
        pieces += [(i, size * k // n, size * (k + 1) // n - size * k // n) for k in range(n)]
    return pieces


def pack_sizes(sizes: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Pieces (item, from, length, window): near-equal windows, as few as differencing brings below ``capacity``.

    The count of windows begins at the least that could hold all sizes and rises while any window is over capacity; no window is mended
    afterwards. Items of at most ``capacity`` mostly stay whole. Differencing levels windows down to the smallest sizes it is given, so a share of
    the tokens goes in as small pieces. Where the count would still rise by more than SPARE, that share is doubled first.
    """
    least = max(1, -(-sum(sizes) // capacity))
    share, grain = CUT, max(1, capacity // GRAINS)
    while True:
        pieces, windows = cut_some(sizes, share, grain), least
        while share >= 1 or windows - least <= SPARE * windows:
            at, sums = difference([n for *_, n in pieces], windows)
            over = int(np.maximum(sums - capacity, 0).sum())
            if not over:
                return [(*piece, int(window)) for piece, window in zip(pieces, at, strict=True)]
            windows += max(1, over // capacity)
        share = min(1.0, 2 * share)


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    tokenizer: str = TOKENIZER,
    ranks: str | None = RANKS,
    end_id: int = 0,
    group: int = 512,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens, one row per piece of a document.

    A text becomes its ids and ``end_id``. Pieces of exactly ``capacity`` tokens are cut off its front and fill a
    sequence each; the rests (of ``group`` documents at a time) are spread over near-equal windows by
    :func:`pack_sizes`, which fills none over ``capacity``. Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, ids.

    A null text counts as empty: its only id is ``end_id``. A text of any length is held once, as its ids. Repeated rows are packed each on
    their own, null keys too, other columns are ignored, an empty table gives no rows. Each task packs its own rows, so nothing is shuffled; ``sequence_id`` holds
    the number of the task's partition in its upper bits. A task that is run again on the same files gives the same pieces.
    """
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        rests: list[tuple] = []
        pieces: list[tuple] = []

        def piece(doc, ids, start, length, at, offset):
            part = ids[start : start + length]
            row = (doc, start, length, zlib.crc32(part.astype("<u4").tobytes()), len(ids), at, offset)
            pieces.append((*row, part.astype(np.int64)) if with_ids else row)

        def pack_rests():
            nonlocal sequence
            found = pack_sizes([len(ids) - start for _, ids, start in rests], capacity)
            filled = [0] * (1 + max(window for *_, window in found))
            for i, since, length, window in found:
                doc, ids, start = rests[i]
                piece(doc, ids, start + since, length, sequence + window, filled[window])
                filled[window] += length
            sequence += len(filled)
            rests.clear()

        def made():
            columns = list(zip(*pieces, strict=True))
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * with_ids
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)
            pieces.clear()
            return batch

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), _encode(texts, tokenizer, ranks), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                for start in range(0, len(ids) - capacity + 1, capacity):
                    piece(doc, ids, start, capacity, sequence, 0)
                    sequence += 1
                if start := len(ids) % capacity:
                    rests.append((doc, ids, len(ids) - start))
                if len(rests) == group:
                    pack_rests()
            if pieces:
                yield made()
        if rests:
            pack_rests()
            yield made()

    schema = ", ".join(f"{n} long" for n in names[:7]) + ", ids array<long>" * with_ids
    return two_columns(docs, key, text).mapInArrow(run, schema).withColumnRenamed("id", key)
