"""Token counts of every prefix of a text, by dynamic programming over its words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import map_batches, two_columns
from rowlens.llm.words import words_of

TOKENIZER = "word_bpe_49k.json"
#: Words whose counts a Python worker remembers; beyond it, it starts anew. This bounds memory and changes no result.
REMEMBERED = 1_000_000

_tokenizers: dict = {}


def load_tokenizer(name: str):
    """The tokenizer file of that name (or path), once for each Python worker, without truncation or padding."""
    if name not in _tokenizers:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _tokenizers[name] = (tokenizer, {})
    return _tokenizers[name]


def _word_tables(name: str, keys: list[int], text_of: Callable[[int], str], within: bool) -> dict[int, np.ndarray]:
    """Token counts by word for all ``keys``, or with ``within`` the counts of all prefixes of a word by characters.

    ``text_of`` gives the word of an entry of ``keys``. The memory is started anew before words are looked up, so all of them are in it then.
    """
    tokenizer, remembered = load_tokenizer(name)
    known = remembered.setdefault(within, {})
    if len(known) > REMEMBERED:
        known.clear()
    new = [(h, text_of(i)) for i, h in enumerate(keys) if h not in known]
    parts = [[word[:n] for n in range(1, len(word) + 1)] if within else [word] for _, word in new]
    flat = tokenizer.encode_batch_fast([p for ps in parts for p in ps], add_special_tokens=False)
    at = 0
    for (h, _), ps in zip(new, parts, strict=True):
        counts = [len(e.ids) for e in flat[at : at + len(ps)]]
        known[h] = np.array(counts, np.int32) if within else counts[0]
        at += len(ps)
    return known


def _prefixes(batch: pa.RecordBatch, name: str, within: bool) -> pa.RecordBatch:
    words = words_of(batch.column(1))
    code, unique = pd.factorize(words.hashes())
    seen = np.full(len(unique), 0, np.int64)
    seen[code[::-1]] = np.arange(len(code))[::-1]  # a place where the word stands
    keys = unique.tolist()
    known = _word_tables(name, keys, lambda i: words.data[words.start[seen[i]] : words.end[seen[i]]].tobytes().decode("utf-8"), within)
    n_bytes = np.diff(words.offset)
    if not within:
        each = np.array([known[h] for h in keys], np.int32)[code] if keys else np.zeros(0, np.int32)
        total = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        n_tokens = total[words.first[1:]] - total[words.first[:-1]]
        counts = (total[1:] - np.repeat(total[words.first[:-1]], np.diff(words.first))).astype(np.int32)
        ends = (words.end - np.repeat(words.offset[:-1], np.diff(words.first))).astype(np.int32)
        split = words.first.astype(np.int32)
    else:
        rows, n_tokens = [], np.zeros(len(n_bytes), np.int64)
        for k, text in enumerate(batch.column(1).to_pylist()):
            low, first, last = words.offset[k], words.first[k], words.first[k + 1]
            raw = words.data[low : words.offset[k + 1]]
            heads = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes where a character begins
            row = np.zeros(len(heads) + 1, np.int32)
            opens = np.searchsorted(heads, words.start[first:last] - low)
            done = 0
            for i, at in zip(range(first, last), opens, strict=True):
                table = known[keys[code[i]]]
                row[at + 1 : at + 1 + len(table)] = done + table
                done += int(table[-1])
                to = np.searchsorted(heads, words.start[i + 1] - low) if i + 1 < last else len(heads)
                row[at + 1 + len(table) : to + 1] = done
            rows.append(row)
            n_tokens[k] = done
        ends = np.concatenate([np.arange(len(r), dtype=np.int32) for r in rows])
        counts = np.concatenate(rows)
        split = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(split, pa.int32()), pa.array(v, pa.int32())) for v in (ends, counts)]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), *lists], ["id", "n_bytes", "n_tokens", "ends", "counts"]
    )


def token_prefixes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, within_words: bool = False
) -> DataFrame:
    """Token counts of the prefixes of every text: (key, n_bytes, n_tokens, ends array, counts array).

    The tokenizer drops white space and never joins characters across it, so T[end of word] = T[end of the word before] +
    tokens of the word; each different word is encoded once for each worker. ``counts[i]`` is the exact count of the
    text up to byte ``ends[i]``, the end of word i. With ``within_words`` the same recurrence gives the count of every
    prefix by characters: ``counts[i]`` is that of the first ``ends[i]`` = i characters, from a table of each word's prefixes.

    A null or empty text has no words and no tokens. Rows are kept as they are: repeated rows and null keys give one row
    each, other columns are ignored, an empty table gives no rows. Nothing is shuffled; memory is that of a batch of texts.
    """
    rows = two_columns(docs, key, text)
    made = map_batches(
        rows, lambda batch: _prefixes(batch, tokenizer, within_words), "id long, n_bytes long, n_tokens long, ends array<int>, counts array<int>"
    )
    return made.withColumnRenamed("id", key)


def words_within(budget: int) -> Column:
    """Of a row of :func:`token_prefixes`: how many whole words fit into ``budget`` tokens."""
    return F.size(F.filter("counts", lambda n: n <= budget))


def bytes_within(budget: int) -> Column:
    """Of a row of :func:`token_prefixes`: where to cut the text (UTF-8 bytes) so that ``budget`` tokens suffice."""
    return F.coalesce(F.element_at("ends", F.nullif(words_within(budget), F.lit(0))), F.lit(0))
