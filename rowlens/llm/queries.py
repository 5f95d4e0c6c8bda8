"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlens.llm import audit, credentials, embeddings, hnsw, lines, minhash, mixing, packing, runs, sharding, substring, tokencount, toxicity
from rowlens.llm.common import WORD, prepare

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, folder, "documents"), window=20)


def minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_texts(_table(spark, folder, "documents"), shingle=4, percent=80)


def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return hnsw.neighbours(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.shard_rows(_table(spark, folder, "documents"), shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"), reject=0.7)


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokencount.token_prefixes(_table(spark, folder, "documents"))
    whole = tokencount.words_within(2048) == F.size("counts")
    return counted.select("doc_id", "n_bytes", "n_tokens", (~whole).alias("over_limit"))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows, plan = mixing.mixture(_table(spark, folder, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    taken = mixing.taken_words(rows, plan)
    return taken.select(mixing.given_key("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), capacity=1024)


def embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, folder, "embeddings"), least=0.95)


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by a hash of doc_id, the words from one place on repeat those at that place."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    # Formed once a row: a lambda would form it again for each of its words.
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.explode(F.array(words)).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.transform("words", source), " ")).otherwise(F.col("text")).alias("text"))


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_periodic_ends(_table(spark, folder, "documents").select("doc_id", "text")), shortest=12)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.select("doc_id", "runs", longest.alias("longest"), F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), "collapsed")
    length, period = F.col("longest.length"), -F.col("longest.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.find_secrets(_table(spark, folder, "documents"), repository="doc_id", owner="source")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    number = lambda field, value: F.size(F.filter(base, lambda s: s[field] == value)).cast("long").alias(f"n_{value}")
    counts = [number("kind", kind) for kind in credentials.KINDS[:3]]
    verdicts = [number("verdict", verdict) for verdict in ("copied", "live")]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"), *verdicts)


def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    masks = audit.failed_filters(_table(spark, folder, "documents"))
    return audit.interactions(masks, _table(spark, folder, "labels"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": substring_dedup,
    "op2_minhash_dedup": minhash_dedup,
    "op3_nearest_neighbours": nearest_neighbours,
    "op4_line_dedup": line_dedup,
    "op5_byte_shards": byte_shards,
    "op6_toxic_documents": toxic_documents,
    "op7_token_counts": token_counts,
    "op8_source_mix": source_mix,
    "op9_packed_sequences": packed_sequences,
    "op10_embedding_dedup": embedding_dedup,
    "op11_periodic_runs": periodic_runs,
    "op12_secret_scan": secret_scan,
    "op13_filter_audit": filter_audit,
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Components over links (a, b) in both directions, for the ids of ``nodes``.
_REACH = """reach(id, other) AS (
    SELECT id, id FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other)"""

#: crc32 of the decimal digits of doc_id, as h, beside the other columns of documents.
_HASHED = """steps AS (
    SELECT range AS b, range::BIGINT AS c, 0 AS k FROM range(256)
    UNION ALL SELECT b, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM steps WHERE k < 8),
    bytes AS (SELECT list(c ORDER BY b) AS byte FROM steps WHERE k = 8),
    hashed AS (
        SELECT documents.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda c, x: xor(c >> 8, byte[(xor(c, x) & 255) + 1]))) AS h FROM documents, bytes)"""

def _marked(kind: str, order: int, pattern: str, value: str, least: int) -> str:
    """Matches of a pattern in documents: each is put between two marks, and lengths of what lies between give its place."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, '{kind}' AS kind, {order} AS ord, before AS start, before + length(m) AS "end", {value.format(f"'{quoted}'")} AS v FROM (
            SELECT doc_id, source, part, split_part(part, chr(2), 1) AS m, sum(length(replace(part, chr(2), ''))) OVER w AS before
            FROM (SELECT doc_id, source, unnest(parts) AS part, unnest(range(len(parts))) AS i
                  FROM (SELECT doc_id, source, string_split(regexp_replace(coalesce(text, ''), '({quoted})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS parts FROM documents))
            WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE contains(part, chr(2)) AND length(v) >= {least}"""


_KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" for c in word) for word in ("password", "passwd", "secret", "token", "api")) + "_?[Kk][Ee][Yy]"
_ASSIGNED = rf"""(?:{_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

_BARE = "[A-Za-z0-9+/_.=-]{12,}"

ORACLES: dict[str, str] = {
    "op1_substring_dedup": f"""
        WITH texts AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)),
        later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM later),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS body
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts) ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)""",
    "op2_minhash_dedup": f"""
        WITH RECURSIVE texts AS (SELECT doc_id, coalesce({_WORDS.format(_LOWER)}, []) AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM texts),
        shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT p.doc_id AS a, q.doc_id AS b FROM shingles p JOIN shingles q USING (x) WHERE p.doc_id <> q.doc_id
            GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
        nodes AS (SELECT doc_id AS id FROM sets),
        {_REACH}
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) ON id = doc_id""",
    "op10_embedding_dedup": f"""
        WITH RECURSIVE good AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q
            ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.95),
        nodes AS (SELECT vec_id AS id FROM embeddings),
        {_REACH}
        SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
        FROM (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
        LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = id""",
    # Six consecutive pairs of equal words at one distance, at least, are in every run of twelve words or more.
    "op11_periodic_runs": f"""
        WITH RECURSIVE {_HASHED},
        plain AS (SELECT doc_id, h, h // 10 AS g, coalesce({_WORDS.format("text")}, []) AS w FROM hashed),
        placed AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM plain),
        texts AS (
            SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w
            FROM (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed)),
        grams AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, len(w) - 5)) AS i FROM texts)),
        pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS d FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
        islands AS (
            SELECT doc_id, d, min(i) AS start, max(i) - min(i) + 6 + d AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs) GROUP BY doc_id, d, island),
        runs AS (SELECT doc_id, start, length, min(d) AS period FROM islands WHERE length >= greatest(12, 2 * d) GROUP BY doc_id, start, length),
        digests AS (
            SELECT doc_id, count(*) AS n_runs, first({{'s': start, 'l': length, 'p': period}} ORDER BY length DESC, start, period) AS best,
                string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS place FROM runs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM texts) ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
            sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
        FROM texts LEFT JOIN digests USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_secret_scan": f"""
        WITH base AS (
            {_marked("assign", 0, _ASSIGNED, "regexp_extract(m, {}, 1)", 12)}
            UNION ALL {_marked("access", 1, "AKIA[A-Z0-9]+", "m", 18)}
            UNION ALL {_marked("hex", 2, "[0-9a-f]+", "m", 16)}),
        bare AS ({_marked("token", 3, _BARE, "m", 12)}),
        outside AS (
            SELECT * FROM bare WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
            AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = bare.doc_id AND base.start < bare."end" AND base."end" > bare.start)),
        found AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM outside),
        hands AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, bool_or(is_base) AS known FROM found GROUP BY v),
        told AS (
            SELECT found.*, owners, len(list_distinct(string_split(v, ''))) AS varied FROM found JOIN hands USING (v)
            WHERE is_base OR owners = 1 AND (known OR length(v) >= 20 AND len(list_distinct(string_split(v, ''))) >= 10
                AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]'))),
        spans AS (
            SELECT doc_id, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
                string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, ord) FILTER (is_base) AS base,
                string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, ord) AS spans,
                count_if(is_base AND owners >= 3) AS n_copied, count_if(is_base AND owners = 1 AND varied >= 8) AS n_live
            FROM told GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
            sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_copied, 0)::BIGINT AS n_copied, coalesce(n_live, 0)::BIGINT AS n_live
        FROM documents LEFT JOIN spans USING (doc_id)""",
    "op13_filter_audit": f"""
        WITH words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
        firsts AS (SELECT text, min(doc_id) AS first_id FROM words GROUP BY text),
        masks AS (
            SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
                + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
                + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask
            FROM words JOIN firsts USING (text)),
        marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
        counts AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad FROM masks LEFT JOIN marks USING (doc_id) GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
        orders AS (
            SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits FROM letters p, letters q, letters r, letters s, letters t
            WHERE p.b + q.b + r.b + s.b + t.b = 31 AND len(list_distinct([p.b, q.b, r.b, s.b, t.b])) = 5),
        steps AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        flags AS (SELECT *, mask & bit > 0 AS fails, mask & earlier > 0 AS gone FROM counts, steps)
        SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(bad) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost,
            coalesce(sum(n * 120 // nullif(bit_count(mask), 0)) FILTER (fails), 0)::BIGINT AS shapley
        FROM flags GROUP BY part, filter_order, step""",
}
