"""Queries for descriptive statistics and attribute ranking."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from rowlens.catalog.cleaning import FLAGS, LINE_STATUS, PRIORITY, STATUS, _case
from rowlens.catalog.registry import Tables, query
from rowlens.operators import features, infogain, pairs, profile, relate

NUMERIC = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
ORDERED = ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "o_totalprice", "l_shipdate")
NOMINAL = ("l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "large")

# A label that the columns do explain, unlike the flags of these random tables.
LARGE_SQL = "CASE WHEN l_extendedprice * (1 - l_discount) > 50000 THEN 1 ELSE 0 END"
WIDE_SQL = f"(SELECT *, {LARGE_SQL} AS large FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def with_large(lines):
    sale = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.withColumn("large", F.when(sale > 50000, 1).otherwise(0))


def lines_of_orders(t: Tables):
    """Lines with the columns of their order and the label ``large``."""
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return with_large(relate.join_children(t.orders, lines, "o_orderkey"))


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(
    "describe_numeric",
    _union(
        f"""SELECT '{c}' AS attribute, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
                   CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in NUMERIC
    ),
)
def describe_numeric(t: Tables):
    summary = profile.describe_numeric(t.lineitem, NUMERIC)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "covariance_pairs",
    _union(
        f"""SELECT '{a}' AS attribute_a, '{b}' AS attribute_b, round(covar_samp({a}, {b}), 4) AS covariance
            FROM lineitem"""
        for a, b in combinations(NUMERIC, 2)
    ),
)
def covariance_pairs(t: Tables):
    return profile.covariance_pairs(t.lineitem, NUMERIC).withColumn("covariance", F.round("covariance", 4))


@query(
    "correlation_matrix",
    f"WITH w AS (SELECT *, {LARGE_SQL} AS large FROM lineitem) "
    + _union(
        f"""SELECT '{a}' AS row_attr, '{b}' AS col_attr, round(corr({a}, {b}), 8) AS correlation FROM w"""
        for a in (*NUMERIC, "large")
        for b in (*NUMERIC, "large")
    ),
)
def correlation_matrix(t: Tables):
    matrix = profile.correlation_matrix(with_large(t.lineitem), [*NUMERIC, "large"])
    return matrix.withColumn("correlation", F.round("correlation", 8))


_INDEXED = ("l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority")
_MANY = (*NUMERIC, *_INDEXED, "o_totalprice", "l_partkey", "l_suppkey", "o_custkey", "large")


def _rank_sql(column: str, source: str) -> str:
    return f"""(SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS i
                FROM {source} GROUP BY {column})"""


@query(
    "correlation_matrix_wide",
    f"WITH w AS {WIDE_SQL}, x AS (SELECT w.* REPLACE ("
    + ", ".join(f"r{i}.i AS {c}" for i, c in enumerate(_INDEXED))
    + ") FROM w "
    + " ".join(f"JOIN {_rank_sql(c, 'w')} r{i} ON w.{c} = r{i}.v" for i, c in enumerate(_INDEXED))
    + ") "
    + _union(
        f"SELECT '{a}' AS row_attr, '{b}' AS col_attr, round(corr({a}, {b}), 8) AS correlation FROM x"
        for a in _MANY
        for b in _MANY
    ),
)
def correlation_matrix_wide(t: Tables):
    """More columns than one aggregate holds well, with categories as their frequency ranks."""
    rows = lines_of_orders(t).select(*_MANY)
    indexed = features.apply_index(rows, features.string_index_table(rows, _INDEXED), _INDEXED)
    return profile.correlation_matrix(indexed, _MANY).withColumn("correlation", F.round("correlation", 8))


@query(
    "category_counts",
    """SELECT 'event_type' AS attribute, event_type AS value, count(*) AS n FROM events GROUP BY ALL
       UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY ALL""",
)
def category_counts(t: Tables):
    return profile.category_counts(t.events, ["event_type", "user_id"])


_CODEBOOK = {
    "o_orderpriority": PRIORITY,
    "o_orderstatus": STATUS,
    "l_returnflag": FLAGS,
    "l_linestatus": LINE_STATUS,
}


@query(
    "category_counts_all",
    f"WITH w AS {WIDE_SQL} "
    + _union(
        f"SELECT '{c}' AS attribute, {_case(c, labels)} AS value, count(*) AS n FROM w GROUP BY ALL"
        for c, labels in _CODEBOOK.items()
    ),
)
def category_counts_all(t: Tables):
    return profile.decoded_counts(lines_of_orders(t), list(_CODEBOOK), _CODEBOOK)


@query(
    "crosstab",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "l_linestatus_F",
              count(*) FILTER (l_linestatus = 'O') AS "l_linestatus_O",
              count(*) FILTER (l_linestatus = 'X') AS "l_linestatus_X" FROM lineitem GROUP BY l_returnflag""",
)
def crosstab(t: Tables):
    return profile.crosstab(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O", "X"])


def _histogram_sql(table: str, value: str, group: str, where: str) -> str:
    return f"""WITH r AS (SELECT {group} AS g, CAST({value} AS DOUBLE) AS x FROM {table} WHERE {where}),
         b AS (SELECT min(x) AS low, max(x) AS high, (max(x) - min(x)) / 20.0::DOUBLE AS width FROM r),
         c AS (SELECT g, least(CAST(floor((x - low) / width) AS INTEGER), 19) AS bin, count(*) AS n FROM r, b GROUP BY ALL),
         grid AS (SELECT g, bin FROM (SELECT DISTINCT g FROM r), range(20) t(bin))
       SELECT grid.g AS "group", CAST(grid.bin AS INTEGER) AS bin, round(low + grid.bin * width, 6) AS lower,
              round(CASE WHEN grid.bin = 19 THEN high ELSE low + (grid.bin + 1) * width END, 6) AS upper,
              coalesce(n, 0) AS n
       FROM grid CROSS JOIN b LEFT JOIN c ON c.g = grid.g AND c.bin = grid.bin"""


def _rounded_bins(histogram):
    return histogram.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("histogram_by_group", _histogram_sql("customer", "c_acctbal", "c_mktsegment", "true"))
def histogram_by_group(t: Tables):
    return _rounded_bins(profile.histogram_by_group(t.customer, "c_acctbal", "c_mktsegment"))


@query(
    "histogram_listed_groups",
    _histogram_sql("lineitem", "l_extendedprice", "l_returnflag", "l_returnflag IN ('R', 'A')"),
)
def histogram_listed_groups(t: Tables):
    return _rounded_bins(profile.histogram_by_group(t.lineitem, "l_extendedprice", "l_returnflag", ["R", "A"]))


def _running_sql(column: str, whole: str, real: str) -> str:
    return f"""SELECT '{column}' AS attribute, {whole} AS whole, {real} AS real, n, t,
                      sum(n) OVER w::BIGINT AS cum_n, sum(t) OVER w::BIGINT AS cum_t,
                      sum(n) OVER ()::BIGINT AS all_n, sum(t) OVER ()::BIGINT AS all_t
               FROM (SELECT {column} AS v, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS t
                     FROM lineitem GROUP BY ALL) WINDOW w AS (ORDER BY v)"""


@query(
    "cumulative_counts",
    _union(
        [
            _running_sql("l_linenumber", "CAST(v AS BIGINT)", "CAST(NULL AS DOUBLE)"),
            _running_sql("l_extendedprice", "CAST(NULL AS BIGINT)", "v"),
        ]
    ),
)
def cumulative_counts(t: Tables):
    return infogain.cumulative_counts(t.lineitem, "l_returnflag", "R", ["l_linenumber", "l_extendedprice"])


@query(
    "topk_by_score",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS sale FROM lineitem
       ORDER BY sale DESC, l_orderkey, l_linenumber LIMIT 20""",
)
def topk_by_score(t: Tables):
    sale = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("sale")
    return profile.top_k(t.lineitem.select("l_orderkey", "l_linenumber", sale), "sale", 20, ["l_orderkey", "l_linenumber"])


@query(
    "label_counts_by_value",
    _union(
        f"""SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, count(*) AS n,
                   count(*) FILTER (l_returnflag = 'R') AS n_true, count(*) FILTER (l_returnflag <> 'R') AS n_false
            FROM lineitem GROUP BY ALL"""
        for c in ("l_linestatus", "l_linenumber", "l_suppkey")
    ),
)
def label_counts_by_value(t: Tables):
    return infogain.label_counts_by_value(t.lineitem, "l_returnflag", "R", ["l_linestatus", "l_linenumber", "l_suppkey"])


@query(
    "entropy",
    _union(
        f"""SELECT '{c}' AS attribute, CAST(sum(n) AS BIGINT) AS n, round(-sum(p * log2(p)), 9) AS entropy
            FROM (SELECT count(*) AS n, count(*) / sum(count(*)) OVER () AS p FROM lineitem GROUP BY {c})"""
        for c in ("l_returnflag", "l_linestatus", "l_linenumber", "l_partkey", "l_orderkey")
    ),
)
def entropy(t: Tables):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_partkey", "l_orderkey"]
    return infogain.entropy(t.lineitem, columns).withColumn("entropy", F.round("entropy", 9))


def _h(p: str) -> str:
    """Binary entropy of a share in SQL."""
    parts = (f"CASE WHEN {q} > 0 THEN -({q}) * log2({q}) ELSE 0 END" for q in (p, f"(1 - {p})"))
    return "(" + " + ".join(parts) + ")"


def _nominal_sql(column: str, label: str, positive: str, source: str) -> str:
    return f"""SELECT '{column}' AS attribute, max(h) AS label_entropy, sum(n / total * hv) AS conditional_entropy,
                      max(h) - sum(n / total * hv) AS information_gain, -sum(n / total * log2(n / total)) AS intrinsic_value
               FROM (SELECT *, {_h("(t / n)")} AS hv, {_h("(total_t / total)")} AS h
                     FROM (SELECT n, t, sum(n) OVER () AS total, sum(t) OVER () AS total_t
                           FROM (SELECT count(*)::DOUBLE AS n, (count(*) FILTER ({label} = {positive}))::DOUBLE AS t
                                 FROM {source} GROUP BY {column})))"""


_RATIOS = ("label_entropy", "conditional_entropy", "information_gain", "intrinsic_value", "gain_ratio")


@query(
    "gain_ratio_nominal",
    f"""SELECT attribute, {", ".join(f"round({c}, 10) AS {c}" for c in _RATIOS)}
        FROM (SELECT *, information_gain / intrinsic_value AS gain_ratio FROM (
        {_union(_nominal_sql(c, "l_returnflag", "'R'", "lineitem") for c in ("l_linestatus", "l_linenumber", "l_suppkey"))}))""",
)
def gain_ratio_nominal(t: Tables):
    table = infogain.gain_ratio_nominal(t.lineitem, "l_returnflag", "R", ["l_linestatus", "l_linenumber", "l_suppkey"])
    return table.withColumns({c: F.round(c, 10) for c in _RATIOS})


def _threshold_sql(column: str, label: str, positive: str, source: str) -> str:
    split = "(cn / n)"
    return f"""SELECT '{column}' AS attribute, max(({_h("(t / n)")} - {split} * {_h("(ct / cn)")}
                        - (1 - {split}) * {_h("((t - ct) / (n - cn))")}) / {_h(split)}) AS gain_ratio
               FROM (SELECT sum(a) OVER w AS cn, sum(b) OVER w AS ct, sum(a) OVER () AS n, sum(b) OVER () AS t
                     FROM (SELECT {column} AS v, count(*)::DOUBLE AS a,
                                  (count(*) FILTER ({label} = {positive}))::DOUBLE AS b FROM {source} GROUP BY ALL)
                     WINDOW w AS (ORDER BY v)) WHERE cn < n"""


@query(
    "gain_ratio_threshold",
    "SELECT attribute, round(gain_ratio, 10) AS gain_ratio FROM ("
    + _union(
        _threshold_sql(c, "l_returnflag", "'R'", "lineitem")
        for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    )
    + ")",
)
def gain_ratio_threshold(t: Tables):
    columns = ["l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    best = infogain.gain_ratio_threshold(t.lineitem, "l_returnflag", "R", columns)
    return best.withColumn("gain_ratio", F.round("gain_ratio", 10))


_RANKING = (
    f"WITH w AS {WIDE_SQL}, g AS (SELECT attribute, round(gain_ratio, 9) AS gain_ratio FROM ("
    + _union(_threshold_sql(c, "large", "1", "w") for c in ORDERED)
    + " UNION ALL SELECT attribute, information_gain / intrinsic_value FROM ("
    + _union(_nominal_sql(c, "large", "1", "w") for c in NOMINAL)
    + "))) "
)


def ranking(t: Tables):
    return infogain.gain_ratio_table(lines_of_orders(t), "large", 1, NOMINAL, ORDERED, digits=9)


@query("gain_ratio_table", _RANKING + "SELECT * FROM g ORDER BY gain_ratio DESC, attribute")
def gain_ratio_table(t: Tables):
    return ranking(t)


@query("select_by_gain_ratio", f"SELECT o_orderkey, l_extendedprice, large FROM {WIDE_SQL}")
def select_by_gain_ratio(t: Tables):
    """The lines with only those attributes that tell something about the label."""
    rows = lines_of_orders(t).select("o_orderkey", *NOMINAL, *ORDERED)
    return features.select_by_gain_ratio(rows, ranking(t), 0.5)


@query(
    "crosstab_all",
    "SELECT l_returnflag AS row_value, l_linestatus AS column_value, count(*) AS n FROM lineitem GROUP BY ALL",
)
def crosstab_all(t: Tables):
    return profile.crosstab_all(t.lineitem, "l_returnflag", "l_linestatus")


_GAPS = "(SELECT l_quantity AS a, CASE WHEN l_linenumber > 2 THEN l_discount END AS b, CASE WHEN l_linenumber < 0 THEN l_tax END AS c, l_extendedprice AS d FROM lineitem)"


@query(
    "correlation_with_gaps",
    _union(
        f"SELECT '{x}' AS row_attr, '{y}' AS col_attr, round(corr({x}::DOUBLE, {y}::DOUBLE), 8) AS correlation FROM {_GAPS}"
        for x in "abcd"
        for y in "abcd"
    ),
)
def correlation_with_gaps(t: Tables):
    """Correlations with one column that is null on some rows and one that is null on all."""
    line = F.col("l_linenumber")
    rows = t.lineitem.select(
        F.col("l_quantity").alias("a"),
        F.when(line > 2, F.col("l_discount")).alias("b"),
        F.when(line < 0, F.col("l_tax")).alias("c"),
        F.col("l_extendedprice").alias("d"),
    )
    return profile.correlation_matrix(rows, list("abcd")).withColumn("correlation", F.round("correlation", 8))


#: Orders with two children: the lines for their quantities and those for their prices, with gaps in one column of each.
_PAIRED = ("total", "l_quantity", "l_discount", "l_extendedprice", "l_tax")
_PAIRED_SQL = """WITH j AS (
    SELECT o_totalprice / 100000.0::DOUBLE AS total, a.l_quantity, CASE WHEN a.l_linenumber <> 2 THEN a.l_discount END AS l_discount,
        b.l_extendedprice / 10000.0::DOUBLE AS l_extendedprice, CASE WHEN b.l_linenumber < 5 THEN b.l_tax END AS l_tax
    FROM orders JOIN lineitem a ON o_orderkey = a.l_orderkey JOIN lineitem b ON o_orderkey = b.l_orderkey WHERE b.l_returnflag <> 'N') """


def _paired(t: Tables):
    parent = t.orders.select("o_orderkey", (F.col("o_totalprice") / 100000).alias("total"))
    lines, number = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), F.col("l_linenumber")
    first = lines.select("o_orderkey", "l_quantity", F.when(number != 2, F.col("l_discount")).alias("l_discount"))
    price, tax = (F.col("l_extendedprice") / 10000).alias("l_extendedprice"), F.when(number < 5, F.col("l_tax")).alias("l_tax")
    second = lines.where("l_returnflag <> 'N'").select("o_orderkey", price, tax)
    return parent, {"first": first, "second": second}, "o_orderkey", _PAIRED


@query(
    "describe_of_pairs",
    _PAIRED_SQL
    + _union(
        f"""SELECT '{c}' AS attribute, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM j"""
        for c in _PAIRED
    ),
)
def describe_of_pairs(t: Tables):
    """The summary of all pairs of two children's rows, without a pair."""
    return pairs.describe_of_pairs(*_paired(t)).withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "covariance_of_pairs",
    _PAIRED_SQL
    + _union(f"SELECT '{a}' AS attribute_a, '{b}' AS attribute_b, round(covar_samp({a}, {b}), 6) AS covariance FROM j" for a, b in combinations(_PAIRED, 2)),
)
def covariance_of_pairs(t: Tables):
    return pairs.covariance_of_pairs(*_paired(t)).withColumn("covariance", F.round("covariance", 6))


@query(
    "correlation_of_pairs",
    _PAIRED_SQL + _union(f"SELECT '{a}' AS row_attr, '{b}' AS col_attr, round(corr({a}, {b}), 8) AS correlation FROM j" for a in _PAIRED for b in _PAIRED),
)
def correlation_of_pairs(t: Tables):
    return pairs.correlation_of_pairs(*_paired(t)).withColumn("correlation", F.round("correlation", 8))


_CHOSEN = ("net", "gross", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
_CHOSEN_SQL = f"(SELECT *, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross, {LARGE_SQL} AS large FROM lineitem)"


@query(
    "choose_features",
    f"WITH RECURSIVE w AS {_CHOSEN_SQL}, g AS (SELECT attribute, round(gain_ratio, 9) AS gain_ratio FROM ("
    + _union(_threshold_sql(c, "large", "1", "w") for c in _CHOSEN)
    + ")), pairs AS ("
    + _union(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM w" for a in _CHOSEN for b in _CHOSEN if a != b)
    + """), ranked AS (
        SELECT g.*, row_number() OVER (ORDER BY gain_ratio DESC, attribute) AS place,
            coalesce((SELECT list(b) FROM pairs WHERE a = attribute AND abs(r) > 0.9), []) AS others FROM g),
    chosen AS (
        SELECT 0::BIGINT AS place, NULL::VARCHAR AS attribute, NULL::DOUBLE AS gain_ratio, NULL::BOOLEAN AS kept, NULL::VARCHAR AS reason, NULL::VARCHAR AS "like", []::VARCHAR[] AS sofar
        UNION ALL
        SELECT r.place, r.attribute, r.gain_ratio, r.gain_ratio >= 0.2 AND len(list_filter(sofar, lambda x: list_contains(r.others, x))) = 0,
            CASE WHEN r.gain_ratio < 0.2 THEN 'gain' WHEN len(list_filter(sofar, lambda x: list_contains(r.others, x))) > 0 THEN 'correlation' END,
            CASE WHEN r.gain_ratio >= 0.2 THEN list_filter(sofar, lambda x: list_contains(r.others, x))[1] END,
            CASE WHEN r.gain_ratio >= 0.2 AND len(list_filter(sofar, lambda x: list_contains(r.others, x))) = 0 THEN list_append(sofar, r.attribute) ELSE sofar END
        FROM chosen JOIN ranked r ON r.place = chosen.place + 1)
    SELECT place, attribute, gain_ratio, kept, reason, "like" FROM chosen WHERE place > 0""",
)
def choose_features(t: Tables):
    """Attributes to keep: those that tell something about the label and do not repeat a better one."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = with_large(t.lineitem).withColumns({"net": net, "gross": net * (1 + F.col("l_tax"))})
    ranked = infogain.gain_ratio_table(rows, "large", 1, ordered=_CHOSEN, digits=9)
    return features.choose_features(ranked, profile.correlation_matrix(rows, _CHOSEN), 0.2, 0.9)
