"""Secrets in texts, told apart by who else has them: a value in many hands is an example, one in one owner's hands may be live."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.llm.common import map_batches, stage

KINDS = ("assign", "access", "hex", "token")
# The patterns of the first three kinds, and how long group 2 of the first and the matches of the others must be.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
LEAST = (12, 18, 16)
#: A bare value: a run of characters that may stand in one, of 12 or more.
TOKEN = r"[A-Za-z0-9+/_.=-]{12,}"
#: Owners from which on a value counts as copied; a live one has one owner and so many different characters.
COPIED, VARIED = 3, 8
#: A bare value looks like a secret by itself with so many characters, so many different ones, a digit and letters of both cases.
LONG, MIXED = 20, 10
#: Parts into which the rows of a value are dealt when its counts are looked up.
PARTS = 1024

_FLAT = "start bigint, end bigint, kind int, value bigint, base boolean, likely boolean, varied boolean"
_KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""


def _likely(value: str) -> bool:
    return (
        len(value) >= LONG and len(set(value)) >= MIXED and any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)
    )


def _patterns() -> list[re.Pattern]:
    # Runs that are too short match nothing longer, so the lengths of the others may be left to the pattern.
    return [re.compile(p, re.ASCII) for p in (ASSIGN, ACCESS, rf"[0-9a-f]{{{LEAST[2]},}}", TOKEN)]


def _found(text: str, may: tuple[bool, ...], patterns: list[re.Pattern]) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, value): matches long enough, and bare values with a letter and a digit outside these."""
    out = []
    for kind in range(3):
        if may[kind]:
            for match in patterns[kind].finditer(text):
                value = match.group(2 if kind == 0 else 0)
                if len(value) >= LEAST[kind]:
                    out.append((match.start(), match.end(), kind, value))
    if may[3]:
        taken = sorted((s, e) for s, e, _, _ in out)
        at, reach = 0, 0
        for match in patterns[3].finditer(text):
            value, start, end = match.group(), match.start(), match.end()
            while at < len(taken) and taken[at][0] < end:
                reach, at = max(reach, taken[at][1]), at + 1
            if reach <= start and any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
                out.append((start, end, 3, value))
    return out


def _batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("value")
    may = [
        pc.fill_null(pc.match_substring_regex(texts, p) if p else pc.match_substring(texts, "AKIA"), False).to_numpy(zero_copy_only=False)
        for p in (_KEYWORD, None, rf"[0-9a-f]{{{LEAST[2]}}}", r"[A-Za-z0-9+/_.=-]{12}")
    ]
    patterns, rows, sizes = _patterns(), [], np.zeros(batch.num_rows, np.int32)
    for i in np.flatnonzero(np.any(may, axis=0)).tolist():
        found = _found(texts[i].as_py(), tuple(bool(m[i]) for m in may), patterns)
        sizes[i] = len(found)
        rows += found
    start, end, kind, value = zip(*rows, strict=True) if rows else ((), (), (), ())
    columns = [
        pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(kind, pa.int32()),
        pa.array(np.array([xxhash.xxh3_64_intdigest(v) for v in value], np.uint64).view(np.int64)),
        pa.array([k < 3 for k in kind], pa.bool_()), pa.array([_likely(v) for v in value], pa.bool_()), pa.array([len(set(v)) >= VARIED for v in value], pa.bool_()),
    ]
    structs = pa.StructArray.from_arrays(columns, names=["start", "end", "kind", "value", "base", "likely", "varied"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), structs)
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("repository"), batch.column("owner"), lists], names=["id", "repository", "owner", "found"])


def candidates(docs: DataFrame, key: str, repository: str, owner: str, text: str) -> DataFrame:
    """(row, id, repository, owner, found) for each row of ``docs``, as a staged table: what may be a secret in its text.

    Texts are read once and not kept; a value is a 64-bit hash from here on.
    """
    rows = docs.select(
        docs[f"`{key}`"].alias("id"), docs[f"`{repository}`"].cast("string").alias("repository"), docs[f"`{owner}`"].cast("string").alias("owner"),
        docs[f"`{text}`"].cast("string").alias("value"),
    )
    schema = f"id {rows.schema['id'].dataType.simpleString()}, repository string, owner string, found array<struct<{_FLAT.replace(' ', ': ').replace(',:', ',')}>>"
    return stage(map_batches(rows, _batch, schema).withColumn("row", F.monotonically_increasing_id()), "candidates")


def ownership(each: DataFrame) -> DataFrame:
    """(value, repositories, owners, known) of rows (value, repository, owner, base): in how many hands a value is.

    A repository belongs to one owner; those of two owners are two. Rows without either count as one more. ``known`` says whether the value
    stands where a pattern finds it. Every step counts before it shuffles and narrows the key, so a value that all rows have is no hot key.
    """
    places = each.groupBy("value", "owner", "repository").agg(F.max("base").alias("known"))
    hands = places.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.max("known").alias("known"))
    return hands.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.max("known").alias("known"))


def _verdict(owners: Column, varied: Column) -> Column:
    return F.when(owners >= COPIED, "copied").when((owners == 1) & varied, "live").otherwise("unclear")


def find_secrets(docs: DataFrame, key: str = "doc_id", repository: str = "doc_id", owner: str = "source", text: str = "text") -> DataFrame:
    """(key, spans) for each row: (start, order, kind, end, base, repositories, owners, verdict) by start and kind, in code points.

    Base spans are what the three patterns match, leftmost and not overlapping per kind. The hashes of their values, and those of bare values
    (12 characters or more with a letter and a digit), are counted over all rows by distinct repositories and owners. A value of 3 or more
    owners is ``copied`` (an example), one of a single owner with 8 different characters is ``live``, others are ``unclear``. A bare value
    becomes a span of kind ``token`` where one owner alone has it and it stands in a pattern elsewhere, or is long and mixed.

    Null and empty texts have no spans; a null key, repository or owner is a value of its own; repeated rows get equal spans and count as
    one repository; an empty table gives none. Other columns of ``docs`` play no part. Memory of a task grows with its longest text.
    Runs its jobs when called.
    """
    rows = candidates(docs, key, repository, owner, text)
    each = rows.select("row", "repository", "owner", F.inline("found"))
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int")
    counts = stage(ownership(each), "ownership")
    # A value has at most PARTS rows here, and each of them meets a share of the value's rows below: none is hot.
    dealt = each.select("value", part.alias("part")).distinct().join(counts, "value")
    told = each.withColumn("part", part).join(dealt, ["value", "part"])
    told = told.where(F.col("base") | ((F.col("owners") == 1) & (F.col("known") | F.col("likely"))))
    name = F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("kind") + 1)
    span = F.struct(
        "start", F.col("kind").alias("order"), name.alias("kind"), "end", "base", "repositories", "owners", _verdict(F.col("owners"), F.col("varied")).alias("verdict")
    )
    # What stands in one text was one row's list before.
    spans = told.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    empty = rows.where(F.size("found") == 0).select("id", none.alias("spans"))
    held = rows.where(F.size("found") > 0).select("id", "row").join(spans, "row", "left").select("id", F.coalesce("spans", none).alias("spans"))
    return empty.unionByName(held).withColumnRenamed("id", key)
