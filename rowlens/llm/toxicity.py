"""Toxic texts by a learnt lexicon, matched with Levenshtein automata and weighed by context."""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import map_batches, stage
from rowlens.llm.minhash import shingle_sets
from rowlens.llm.words import words_of

#: Labelled rows of either kind that a model is fitted on at most.
TOXIC_ROWS, CLEAN_ROWS = 4_000, 24_000
#: A term is a word of any length, or the start of a longer word of one of these lengths.
STEMS = range(4, 10)
#: Least log-likelihood ratio of a term (a chance of about one in 100,000), and least share of toxic rows among its rows.
EVIDENCE, PURITY = 20.0, 0.8
#: Terms of this length and more also match with one edit.
FUZZY = 5
#: Words on either side within which quotation marks or a reporting word make a quotation, and words of a dense passage.
CONTEXT, DENSE = 10, 20
REMEMBERED = 300_000
_SLICE = 2 << 20  # bytes of text looked at at a time

_OPEN, _CLOSE = "\"'“‘«„‹", "\"'”’»“›"
_REPORT = frozenset(
    "said says wrote writes quoted quotes called calls reported reports term word slur insult "
    "dit écrit sagte schrieb nannte zitat mot dijo escribió llamó palabra".split()
)


class LexiconAutomaton:
    """A trie of terms intersected with Levenshtein automata, determinised as far as words need it.

    A state is the set of trie nodes that the letters so far reach with no or one edit. Whole terms must match a whole word, stems
    its start. Short terms match without edits only.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.whole, self.stem, self.edits = [False], [False], [0]
        for term, is_stem in terms:
            node, edits = 0, int(len(term) >= FUZZY)
            self.edits[0] |= edits
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    for flags in (self.whole, self.stem):
                        flags.append(False)
                    self.edits.append(0)
                node = self.children[node][c]
                self.edits[node] |= edits
            (self.stem if is_stem else self.whole)[node] = True
        self.fuzzy_end = {}
        self._clear()

    def _clear(self) -> None:
        self.sets: list[dict[int, int]] = []
        self.known: dict[tuple, int] = {}
        self.step: list[dict[str, int]] = []
        self.ends: list[tuple[int, int]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        for node, e in list(nodes.items()):  # a letter of the term is left out
            if e == 0 and self.edits[node]:
                for child in self.children[node].values():
                    if self.edits[child]:
                        nodes[child] = min(nodes.get(child, 1), 1)
        key = tuple(sorted(nodes.items()))
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(nodes)
            self.step.append({})
            end = lambda flags: min((e for n, e in nodes.items() if flags[n]), default=2)
            self.ends.append((end(self.whole), end(self.stem)))
        return self.known[key]

    def _next(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for node, e in self.sets[state].items():
            child = self.children[node].get(c)
            if child is not None and (not e or self.edits[child]):
                nodes[child] = min(nodes.get(child, 2), e)
            if e == 0 and self.edits[node]:
                nodes[node] = min(nodes.get(node, 2), 1)  # a letter too many
                for other in self.children[node].values():
                    if self.edits[other]:
                        nodes[other] = min(nodes.get(other, 2), 1)  # another letter
        return self._state(nodes)

    def distance(self, word: str) -> int:
        """Edits (0 or 1) between the word and the nearest term, or 2."""
        if len(self.sets) > 100_000:
            self._clear()
        state, best = self.start, 2
        for c in word:
            nxt = self.step[state].get(c)
            if nxt is None:
                nxt = self.step[state][c] = self._next(state, c)
            state = nxt
            best = min(best, self.ends[state][1])
            if not self.sets[state] or best == 0:
                return best
        return min(best, self.ends[state][0])


@dataclass
class ToxicityModel:
    """Terms (with whether each is a stem) and the weights of a logistic model of what is counted of them."""

    terms: list[tuple[str, bool]]
    weights: list[float]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


_models: dict = {}


def _bare(word: str) -> str:
    """The word in lower case without marks at its ends."""
    word = word.lower()
    low, high = 0, len(word)
    while low < high and not word[low].isalnum():
        low += 1
    while high > low and not word[high - 1].isalnum():
        high -= 1
    return word[low:high]


def _tell(automaton: LexiconAutomaton, raw: str) -> int:
    """Bits: distance + 1 of a hit (0: none), opens a quotation, closes one, reports one."""
    bare = _bare(raw)
    d = automaton.distance(bare)
    head, tail = raw[: len(raw) - len(raw.lstrip("([" + _OPEN))], raw.rstrip(".,;:!?)]")[-1:]
    return (d + 1 if d < 2 else 0) | 4 * any(c in _OPEN for c in head) | 8 * (tail != "" and tail in _CLOSE) | 16 * (bare in _REPORT)


def _features(texts: pa.Array, model: ToxicityModel) -> np.ndarray:
    """For each text: logarithms of exact hits, of inexact ones and of those in a quotation, of the densest passage's, of hits for 100 words; any exact hit; 1."""
    automaton, memory = _models.setdefault(model.name, (LexiconAutomaton(model.terms), {}))
    words = words_of(texts)
    code, unique = pd.factorize(words.hashes())
    seen = np.zeros(len(unique), np.int64)
    seen[code[::-1]] = np.arange(len(code))[::-1]
    if len(memory) > REMEMBERED:
        memory.clear()
    told = np.zeros(len(unique), np.int64)
    for k, (h, i) in enumerate(zip(unique.tolist(), seen.tolist(), strict=True)):
        if (x := memory.get(h)) is None:
            x = memory[h] = _tell(automaton, words.data[words.start[i] : words.end[i]].tobytes().decode("utf-8"))
        told[k] = x
    told = told[code]
    n = len(words.first) - 1
    at = np.flatnonzero(told & 3)
    owner = np.searchsorted(words.first, at, "right") - 1
    low, high = words.first[owner], words.first[owner + 1]
    totals = [np.concatenate([[0], np.cumsum(told & bit > 0)]) for bit in (4, 8, 16)]
    within = lambda t, a, b: t[np.minimum(b, high)] > t[np.maximum(a, low)]
    quoted = within(totals[0], at - CONTEXT, at + 1) & within(totals[1], at, at + CONTEXT + 1)
    quoted |= within(totals[2], at - CONTEXT // 2, at)
    exact = (told[at] & 3) == 1
    count = lambda which: np.bincount(owner[which], minlength=n).astype(float)
    plain, fuzzy, inside = count(exact & ~quoted), count(~exact & ~quoted), count(quoted)
    dense = np.zeros(n)
    np.maximum.at(dense, owner, np.searchsorted(at, np.minimum(at + DENSE, high)) - np.arange(len(at)))
    length = np.maximum(np.diff(words.first), 1)
    rate = np.minimum(100 * (plain + fuzzy / 2) / length, 10)
    columns = [np.log1p(plain), np.log1p(fuzzy), np.log1p(inside), np.log1p(dense), np.log1p(rate), (count(exact) > 0).astype(float), np.ones(n)]
    return np.stack(columns, axis=1)


def _slices(texts: pa.Array):
    """The texts in slices of about _SLICE bytes, at least one text each."""
    sizes = np.cumsum([len(t) if t else 0 for t in texts.to_pylist()])
    low = 0
    while low < len(texts):
        base = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, base + _SLICE, "right")))
        yield texts.slice(low, high - low)
        low = high


def score_column(model: ToxicityModel, text: str | Column) -> Column:
    """The score of a text column, from 0 to 1; a null or empty text has that of a text without hits."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        made = [_features(part, model) @ np.array(model.weights) for part in _slices(pa.array(texts, pa.string(), from_pandas=True))]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.concatenate([*made, np.zeros(0)]), -30, 30))))

    return score(text)


def _with_least_shingle(batch: pa.RecordBatch) -> pa.RecordBatch:
    least = [int(s[0]) if len(s) else 0 for s in shingle_sets(batch.column(0), 4)]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(least, np.uint64).view(np.int64))], ["text", "toxic", "least"])


def _terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(term, stem, toxic rows, clean rows) of a batch of labelled texts."""
    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        words = {_bare(w) for w in (text or "").split()}
        found = {(w, False) for w in words if w}
        found |= {(w[:n], True) for w in words for n in STEMS if len(w) > n}
        counts[bool(toxic)].update(found)
    terms = list(counts[True].keys() | counts[False].keys())
    columns = [
        pa.array([t for t, _ in terms], pa.string()),
        pa.array([s for _, s in terms], pa.bool_()),
        pa.array([counts[True][t] for t in terms], pa.int64()),
        pa.array([counts[False][t] for t in terms], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["term", "stem", "toxic", "clean"])


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(key: str | Column) -> Column:
    """Rows that no model is fitted on: a third, by the checksum of the key as text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Learn terms and weights from labelled rows that are not held out.

    At most 4,000 toxic and 24,000 clean rows are used, by a hash of the key; the documented bound of what is read for learning, of
    the broadcast keys, and of the features that reach the driver. A term is kept if the rows that hold it are toxic far more
    often than chance allows, however many are; a stem replaces the longer terms that begin with it. Without toxic and clean rows, the model has no terms.
    """
    given = labels.where(~held_out(key) & labels[f"`{key}`"].isNotNull() & labels[label].isNotNull())
    given = given.groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).alias("toxic"))
    some = [given.where(F.col("toxic") == t).orderBy(F.xxhash64("id"), "id").limit(n) for t, n in ((True, TOXIC_ROWS), (False, CLEAN_ROWS))]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # 28,000 keys at most
    rows = docs.select(docs[f"`{key}`"].alias("id"), docs[f"`{text}`"].alias("text")).join(chosen, "id").select("text", "toxic")
    # Copies and most near copies share their least shingle; one of them is evidence once.
    rows = map_batches(rows, _with_least_shingle, "text string, toxic boolean, least long")
    rows = stage(rows.groupBy("toxic", "least").agg(F.min("text").alias("text")).select("text", "toxic"), "labelled")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return ToxicityModel([], [0.0] * 6 + [-5.0 if not n.get(True) else 5.0])
    base = n[True] / (n[True] + n[False])
    counted = map_batches(rows, _terms, "term string, stem boolean, toxic long, clean long").groupBy("term", "stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = F.col("t") / (F.col("t") + F.col("c"))
    log = lambda part, p: F.when(part > 0, part * F.log(p)).otherwise(0.0)
    ratio = 2 * (log(F.col("t"), share / base) + log(F.col("c"), (1 - share) / (1 - base)))
    strong = counted.withColumn("ratio", ratio).where((F.col("ratio") >= EVIDENCE) & (share >= max(PURITY, base)))
    strong = stage(strong.select("term", "stem"), "strong")
    # A stem says what every longer term that begins with it says, so those go.
    begins = strong.select("term", "stem", F.explode(F.transform(F.sequence(*(F.lit(n) for n in (STEMS.start, STEMS.stop - 1))), lambda n: F.left("term", n))).alias("begin"))
    longer = begins.where((F.length("term") > F.length("begin")) | ~F.col("stem"))
    longer = longer.join(strong.where("stem").select(F.col("term").alias("begin")), "begin", "left_semi")
    # Each of these terms is in several labelled rows, of which there is a bounded number.
    terms = strong.join(longer, ["term", "stem"], "left_anti").orderBy("term", "stem").collect()
    model = ToxicityModel([(r["term"], r["stem"]) for r in terms], [0.0] * 7)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.concatenate([_features(part, model) for part in _slices(batch.column(0))])
        y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), pa.array(y)], [*(f"x{i}" for i in range(x.shape[1])), "y"])

    names = [f"x{i}" for i in range(7)]
    sample = np.array([tuple(r) for r in map_batches(rows, measure, ", ".join(f"{c} double" for c in [*names, "y"])).collect()])
    return ToxicityModel(model.terms, _fit(sample[:, :7], sample[:, 7]).tolist())


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", reject: float = 0.7) -> DataFrame:
    """(key, held_out, score, predicted) of every row, whole texts; nothing but the text is an input of a score.

    Words, by whitespace and without marks at their ends, pass a Levenshtein automaton of the lexicon's trie once for each
    different word of a worker. Hits in quotation marks or after a reporting word count apart from the others.
    Null and empty texts have the score of a text without hits; repeated rows and null keys are rows like others. Long texts are read
    whole. Other columns are ignored, whatever their names; an empty table gives no rows. Fitting runs jobs when called.
    """
    model = fit_toxicity(docs, labels, key, text, label)
    rows = docs.select(docs[f"`{key}`"].alias(key), held_out(docs[f"`{key}`"]).alias("held_out"), score_column(model, docs[f"`{text}`"]).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= reject).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", reject: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``reject``, with their columns as they are."""
    model = fit_toxicity(docs, labels, key, text, label)
    return docs.where(score_column(model, docs[f"`{text}`"]) < reject)
