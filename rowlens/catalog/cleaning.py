"""Queries for sources, sinks, projection, missing values, recoding and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowlens.catalog.registry import Tables, query
from rowlens.functions.columns import AGE_BOUNDS
from rowlens.operators import clean, profile, relate
from rowlens.session import new_folder
from rowlens.sources.files import misfits, scan_csv, scan_parquet, type_counts, write_csv, write_parquet

PRIORITY = {
    "1-URGENT": "fast",
    "2-HIGH": "fast",
    "3-MEDIUM": "normal",
    "5-LOW": "slow",
}
STATUS = {"F": "finished", "O": "open"}
FLAGS = {"R": "returned", "A": "kept", "N": "kept"}
LINE_STATUS = {"F": "finished", "O": "open"}


def _case(column: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in labels.items())
    return f"CASE {column} {whens} ELSE {column} END"


def _band_sql(column: str, bounds) -> str:
    whens = " ".join(f"WHEN {column} < {bound} THEN {i}" for i, bound in enumerate(bounds, start=1))
    return f"CASE WHEN {column} IS NULL THEN NULL {whens} ELSE {len(bounds) + 1} END"


@query(
    "join_inner",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus, l_linenumber, l_quantity, l_returnflag
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_inner(t: Tables):
    parent = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    child = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_returnflag")
    return relate.join_children(parent, child, "o_orderkey")


@query(
    "join_fanout",
    """WITH pairs AS (
         SELECT o_orderpriority, a.l_returnflag, b.l_linestatus
         FROM orders JOIN lineitem a ON o_orderkey = a.l_orderkey JOIN lineitem b ON o_orderkey = b.l_orderkey)
       SELECT 'o_orderpriority' AS attribute, o_orderpriority AS value, count(*) AS n FROM pairs GROUP BY ALL
       UNION ALL SELECT 'l_returnflag', l_returnflag, count(*) FROM pairs GROUP BY ALL
       UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM pairs GROUP BY ALL""",
)
def join_fanout(t: Tables):
    """Frequency tables over all pairs of two children of a parent, without forming a pair."""
    children = {
        "first": t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag"),
        "second": t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus"),
    }
    weighted = relate.fanout_weights(t.orders.select("o_orderkey", "o_orderpriority"), children, "o_orderkey")
    return (
        profile.category_counts(weighted[""], ["o_orderpriority"], "weight")
        .unionByName(profile.category_counts(weighted["first"], ["l_returnflag"], "weight"))
        .unionByName(profile.category_counts(weighted["second"], ["l_linestatus"], "weight"))
    )


@query("csv_scan", "SELECT * FROM orders")
def csv_scan(t: Tables):
    path = new_folder(t.spark, "orders-csv")
    write_csv(t.orders, path)
    return scan_csv(t.spark, path, t.orders.schema)


_CHECKS = {
    "boolean": "lower({0}) IN ('true', 'false')",
    "integer": r"regexp_full_match({0}, '[+-]?[0-9]+') AND TRY_CAST({0} AS INTEGER) IS NOT NULL",
    "bigint": r"regexp_full_match({0}, '[+-]?[0-9]+') AND TRY_CAST({0} AS BIGINT) IS NOT NULL",
    "double": r"regexp_full_match({0}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')",
    "date": r"regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}') AND TRY_CAST({0} AS DATE) IS NOT NULL",
    "timestamp": r"regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}( \d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?)?') AND TRY_CAST({0} AS TIMESTAMP) IS NOT NULL",
}
_TEXTS = {
    "key": "CAST(o_orderkey AS VARCHAR)",
    "large_key": "CAST(o_orderkey + 3000000000 AS VARCHAR)",
    "price": "CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_totalprice AS VARCHAR) END",
    "code": "CASE WHEN o_orderkey % 50 = 1 THEN '17:42' ELSE CAST(o_custkey AS VARCHAR) END",
    "day": "strftime(o_orderdate, '%Y-%m-%d')",
    "moment": "strftime(o_orderdate, '%Y-%m-%d %H:%M')",
    "open": "CASE o_orderstatus WHEN 'O' THEN 'true' ELSE 'false' END",
    "priority": "o_orderpriority",
    "none": "CAST(NULL AS VARCHAR)",
}


def _texts(t: Tables):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return t.orders.select(
        key.cast("string").alias("key"),
        (key + 3_000_000_000).cast("string").alias("large_key"),
        F.when(key % 3 > 0, F.col("o_totalprice").cast("string")).alias("price"),
        F.when(key % 50 == 1, "17:42").otherwise(F.col("o_custkey").cast("string")).alias("code"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.date_format(day, "yyyy-MM-dd HH:mm").alias("moment"),
        F.when(F.col("o_orderstatus") == "O", "true").otherwise("false").alias("open"),
        F.col("o_orderpriority").alias("priority"),
        F.lit(None).cast("string").alias("none"),
    )


@query(
    "csv_infer_types",
    "SELECT *, CASE "
    + " ".join(f"WHEN n > n_null AND n_{kind} = n - n_null THEN '{kind}'" for kind in _CHECKS)
    + " ELSE 'string' END AS type FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{column}' AS "column", count(*) AS n, count(*) - count(v) AS n_null, {", ".join(f"coalesce(count_if({check.format("v")}), 0)::BIGINT AS n_{kind}" for kind, check in _CHECKS.items())}
            FROM (SELECT {text} AS v FROM orders)"""
        for column, text in _TEXTS.items()
    )
    + ")",
)
def csv_infer_types(t: Tables):
    """Orders written as text: how many values of each column fit each type, and the type that all fit."""
    path = new_folder(t.spark, "texts-csv")
    write_csv(_texts(t), path)
    return type_counts(t.spark, path)


@query(
    "csv_misfits",
    """SELECT 'code' AS "column", 'int' AS type, count(*) AS n, 0::BIGINT AS n_null, count_if(o_orderkey % 50 = 1)::BIGINT AS n_misfit FROM orders
       UNION ALL SELECT 'key', 'tinyint', count(*), 0, count_if(o_orderkey > 127) FROM orders
       UNION ALL SELECT 'price', 'double', count(*), count_if(o_orderkey % 3 = 0), 0 FROM orders
       UNION ALL SELECT 'day', 'date', count(*), 0, 0 FROM orders""",
)
def csv_misfits(t: Tables):
    """Values that a declared type turns null, apart from those that are missing."""
    path = new_folder(t.spark, "texts-csv")
    write_csv(_texts(t), path)
    return misfits(t.spark, path, StructType().add("code", "integer").add("key", "byte").add("price", "double").add("day", "date"))


@query("csv_scan_inferred", "SELECT * REPLACE (o_custkey::INTEGER AS o_custkey, o_orderkey::INTEGER AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d')::DATE AS o_orderdate) FROM orders")
def csv_scan_inferred(t: Tables):
    path = new_folder(t.spark, "orders-csv")
    write_csv(t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")), path)
    return scan_csv(t.spark, path)


@query(
    "csv_sink",
    """SELECT 'l_quantity' AS attribute, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean,
              round(stddev_samp(l_quantity), 6) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
       UNION ALL SELECT 'l_discount', count(l_discount), round(avg(l_discount), 6),
              round(stddev_samp(l_discount), 6), min(l_discount), max(l_discount) FROM lineitem""",
)
def csv_sink(t: Tables):
    summary = profile.describe_numeric(t.lineitem, ["l_quantity", "l_discount"])
    path = new_folder(t.spark, "summary-csv")
    write_csv(summary, path)
    back = scan_csv(t.spark, path, summary.schema)
    return back.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("parquet_roundtrip", "SELECT * FROM customer")
def parquet_roundtrip(t: Tables):
    path = new_folder(t.spark, "customer")
    write_parquet(t.customer, path)
    return scan_parquet(t.spark, path)


@query(
    "parse_datetime",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL
         ELSE CAST(epoch(strptime(strftime(ts, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M')) AS BIGINT) END AS moment
       FROM events""",
)
def parse_datetime(t: Tables):
    """Dates and times held as text, with an impossible date for one kind of event and no time for another."""
    kind = F.col("event_type")
    text = t.events.select(
        "event_id",
        F.when(kind == "error", "31/02/2005").otherwise(F.date_format("ts", "dd/MM/yyyy")).alias("day"),
        F.when(kind != "view", F.date_format("ts", "HH:mm")).alias("clock"),
    )
    return clean.add_epoch(text, "day", "clock", "moment")


@query(
    "sentinel_to_null",
    """SELECT l_orderkey, l_suppkey, nullif(l_linenumber, 7) AS l_linenumber,
              nullif(l_quantity, 7.0) AS l_quantity, l_returnflag, l_shipdate FROM lineitem""",
)
def sentinel_to_null(t: Tables):
    columns = ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]
    return clean.sentinel_to_null(
        t.lineitem.select(columns), ["l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"], "7"
    )


def _orders_with_gaps(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return clean.sentinel_to_null(orders, ["o_orderpriority"], "4-NOT SPECIFIED")


def _lines_with_gaps(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_linestatus")
    return clean.sentinel_to_null(lines, ["l_linenumber", "l_quantity"], "7")


_LINES_WITH_GAPS = """(SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, nullif(l_quantity, 7.0) AS l_quantity,
                              l_discount, l_linestatus FROM lineitem)"""


@query(
    "filter_not_null",
    f"""SELECT o_orderkey, o_orderpriority, o_totalprice, l_linenumber, l_quantity, l_discount, l_linestatus
        FROM orders JOIN {_LINES_WITH_GAPS} ON o_orderkey = l_orderkey
        WHERE o_orderpriority <> '4-NOT SPECIFIED' AND l_linenumber IS NOT NULL""",
)
def filter_not_null(t: Tables):
    lines = clean.project(_lines_with_gaps(t), rename={"l_orderkey": "o_orderkey"})
    joined = relate.join_children(_orders_with_gaps(t), lines, "o_orderkey")
    return clean.filter_not_null(joined, ["o_orderpriority", "l_linenumber"])


@query(
    "dropna_subset",
    f"SELECT * FROM {_LINES_WITH_GAPS} WHERE l_linenumber IS NOT NULL AND l_quantity IS NOT NULL",
)
def dropna_subset(t: Tables):
    return clean.filter_not_null(_lines_with_gaps(t), ["l_linenumber", "l_quantity"])


@query(
    "null_fraction",
    f"""WITH g AS {_LINES_WITH_GAPS}
        SELECT attribute, n_rows, n_null, round(n_null / n_rows, 9) AS null_fraction FROM (
          SELECT 'l_linenumber' AS attribute, count(*) AS n_rows, count(*) - count(l_linenumber) AS n_null FROM g
          UNION ALL SELECT 'l_quantity', count(*), count(*) - count(l_quantity) FROM g
          UNION ALL SELECT 'l_discount', count(*), count(*) - count(l_discount) FROM g)""",
)
def null_fraction(t: Tables):
    fractions = clean.null_fractions(_lines_with_gaps(t), ["l_linenumber", "l_quantity", "l_discount"])
    return fractions.withColumn("null_fraction", F.round("null_fraction", 9))


@query(
    "drop_sparse_columns",
    f"SELECT l_orderkey, l_quantity, l_discount, l_linestatus FROM {_LINES_WITH_GAPS}",
)
def drop_sparse_columns(t: Tables):
    """About a seventh of the line numbers and a fiftieth of the quantities are missing."""
    return clean.drop_sparse(_lines_with_gaps(t), 0.1)


@query(
    "conditional_fill",
    f"""SELECT l_orderkey, CASE WHEN l_linenumber IS NULL AND l_linestatus = 'O' THEN 0 ELSE l_linenumber END
                 AS l_linenumber, l_quantity, l_discount, l_linestatus FROM {_LINES_WITH_GAPS}""",
)
def conditional_fill(t: Tables):
    return clean.fill_when(_lines_with_gaps(t), "l_linenumber", F.col("l_linestatus") == "O", 0)


@query(
    "fill_constants",
    f"""SELECT l_orderkey, coalesce(l_linenumber, 9) AS l_linenumber, coalesce(l_quantity, 0.5) AS l_quantity,
               l_discount, l_linestatus FROM {_LINES_WITH_GAPS}""",
)
def fill_constants(t: Tables):
    return clean.fill_constants(_lines_with_gaps(t), {"l_linenumber": 9, "l_quantity": 0.5})


@query(
    "mean_impute",
    f"""WITH g AS {_LINES_WITH_GAPS}, m AS (SELECT avg(l_linenumber) AS a, avg(l_quantity) AS b FROM g)
        SELECT l_orderkey, coalesce(l_linenumber, CAST(trunc(a) AS INTEGER)) AS l_linenumber,
               round(coalesce(l_quantity, b), 6) AS l_quantity, l_discount, l_linestatus,
               coalesce({_band_sql("l_quantity", AGE_BOUNDS)}, {_band_sql("b", AGE_BOUNDS)}) AS band
        FROM g, m""",
)
def mean_impute(t: Tables):
    banded = clean.add_band(_lines_with_gaps(t), "l_quantity", AGE_BOUNDS, "band")
    filled = clean.fill_means(banded, ["l_linenumber", "l_quantity"], {"band": ("l_quantity", AGE_BOUNDS)})
    return filled.withColumn("l_quantity", F.round("l_quantity", 6))


@query("bucketize_bands", f"SELECT p_partkey, p_size, {_band_sql('p_size', AGE_BOUNDS)} AS band FROM part")
def bucketize_bands(t: Tables):
    return clean.add_band(t.part.select("p_partkey", "p_size"), "p_size", AGE_BOUNDS, "band")


@query(
    "cast_nominal",
    """SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_suppkey AS VARCHAR) AS l_suppkey
       FROM lineitem""",
)
def cast_nominal(t: Tables):
    return clean.to_nominal(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), ["l_linenumber", "l_suppkey"])


@query(
    "binarize_label",
    "SELECT l_orderkey, l_returnflag, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS label FROM lineitem",
)
def binarize_label(t: Tables):
    return clean.binarize(t.lineitem.select("l_orderkey", "l_returnflag"), "l_returnflag", "R", "label")


@query(
    "decode_values",
    f"""SELECT o_orderkey, {_case("o_orderpriority", PRIORITY)} AS o_orderpriority,
               {_case("o_orderstatus", STATUS)} AS o_orderstatus FROM orders""",
)
def decode_values(t: Tables):
    codes = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return clean.decode_values(codes, {"o_orderpriority": PRIORITY, "o_orderstatus": STATUS, "absent": {"1": "x"}})


@query(
    "decode_join",
    """SELECT c_custkey, n_name AS nation, coalesce(r_name, CAST(c_nationkey AS VARCHAR)) AS region_or_code
       FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON c_nationkey = r_regionkey""",
)
def decode_join(t: Tables):
    """Nation codes by their dictionary, and by one that lacks most codes, which then stay."""
    customers = t.customer.select("c_custkey", "c_nationkey")
    named = clean.decode_join(customers, "c_nationkey", t.nation, "n_nationkey", "n_name", "nation")
    both = clean.decode_join(named, "c_nationkey", t.region, "r_regionkey", "r_name", "region_or_code")
    return both.drop("c_nationkey")


@query("project_rename_drop", "SELECT c_custkey AS customer, c_acctbal AS balance FROM customer")
def project_rename_drop(t: Tables):
    return clean.project(
        t.customer,
        keep=["c_custkey", "c_acctbal", "c_mktsegment"],
        rename={"c_custkey": "customer", "c_acctbal": "balance"},
        drop=["c_mktsegment", "no_such_column"],
    )
