"""Profiling queries over the flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.common import rounded, spread_table, table
from tabloom.operators import gram, grouping, profile, sketches
from tabloom.session import cut_lineage

SKETCHED = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]
LINE_NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def profile_nonnull(spark, folder):
    return profile.non_null(table(spark, folder, "orders"))


def null_fraction(spark, folder):
    joined = table(spark, folder, "documents").select("doc_id", "lang").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    return profile.null_fraction(joined).select("column", rounded(F.col("null_fraction"), "null_fraction"))


def describe_numeric(spark, folder):
    found = profile.describe(spread_table(spark, folder, "lineitem", "l_orderkey"), LINE_NUMBERS)
    return found.select(
        "column", "count", *[rounded(F.col(c), c, 4) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    )


def column_range(spark, folder):
    return profile.column_range(table(spark, folder, "lineitem"), LINE_NUMBERS)


def table_shape(spark, folder):
    return profile.shape(table(spark, folder, "lineitem"))


def category_counts(spark, folder):
    return profile.category_counts(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])


def category_by_label(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(table(spark, folder, "labels"), "doc_id")
    return profile.category_by_label(labelled, ["lang", "source"], "quality")


def duplicate_rows(spark, folder):
    return profile.duplicate_rows(table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax"))


def drop_duplicates(spark, folder):
    return profile.drop_duplicates(table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax"))


def corr_matrix(spark, folder):
    found = profile.correlation_matrix(table(spark, folder, "lineitem"), LINE_NUMBERS)
    return found.select("left", "right", rounded(F.col("corr"), "corr"))


def sketch_profile(spark, folder):
    """Sketches of the line items per ship month, merged; whether the merged profile keeps its stated errors."""
    lines = table(spark, folder, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    parts = cut_lineage(sketches.sketch_parts(lines, "month", SKETCHED))
    profile = sketches.merged_profile(parts)
    kept = sketches.within_errors(lines, profile, SKETCHED)
    return kept.join(profile.select("column", "parts", "nulls"), "column").select("column", "parts", "n", "nulls", "distinct_within", "quantiles_within")


def wide_correlation(spark, folder):
    """All pairs of the 64 embedding columns, by blocks of columns."""
    found = gram.wide_correlations(table(spark, folder, "embeddings"), "embedding", 64)
    return found.select("left", "right", rounded(F.col("corr"), "corr"))


def histogram_density(spark, folder):
    found = profile.histogram(table(spark, folder, "orders"), "o_totalprice")
    return found.select("bin", rounded(F.col("low"), "low", 4), "count", rounded(F.col("density"), "density", 12))


def kde_grid(spark, folder):
    found = profile.kernel_density(table(spark, folder, "customer"), "c_acctbal", 50)
    return found.select("grid_no", rounded(F.col("x"), "x", 4), rounded(F.col("density"), "density", 10))


def top_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return grouping.top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


def group_collect_set(spark, folder):
    found = grouping.group_distinct_list(table(spark, folder, "events"), ["user_id"], "event_type", "types")
    return found.select("user_id", F.array_join("types", ",").alias("types"))


def log_sum_exp(spark, folder):
    found = grouping.log_sum_exp(table(spark, folder, "events"), ["event_type"], "value", "lse")
    return found.select("event_type", rounded(F.col("lse"), "lse"))


def arg_max(spark, folder):
    return grouping.arg_max(table(spark, folder, "events"), ["user_id"], "value", "event_id")


def best_row(spark, folder):
    return grouping.best_row(table(spark, folder, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey")


def softmax_group(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    found = grouping.softmax(items, ["l_orderkey"], "l_quantity", "share")
    return found.select("l_orderkey", "l_linenumber", rounded(F.col("share"), "share", 9))


def row_to_json(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return grouping.row_to_json(rows)


QUERIES = {
    "profile_nonnull": profile_nonnull,
    "null_fraction": null_fraction,
    "describe_numeric": describe_numeric,
    "column_range": column_range,
    "table_shape": table_shape,
    "category_counts": category_counts,
    "category_by_label": category_by_label,
    "duplicate_rows": duplicate_rows,
    "drop_duplicates": drop_duplicates,
    "corr_matrix": corr_matrix,
    "sketch_profile": sketch_profile,
    "wide_correlation": wide_correlation,
    "histogram_density": histogram_density,
    "kde_grid": kde_grid,
    "top_rows": top_rows,
    "best_row": best_row,
    "group_collect_set": group_collect_set,
    "log_sum_exp": log_sum_exp,
    "arg_max": arg_max,
    "softmax_group": softmax_group,
    "row_to_json": row_to_json,
}


def _union(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp",
    "o_orderpriority": "string",
}

SQL = {
    "profile_nonnull": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM orders" for c, t in _TYPES.items()
    ).replace("'timestamp'", "'timestamp_ntz'"),
    "null_fraction": _union(
        "SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 6) AS null_fraction "
        "FROM (SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))",
        ["doc_id", "lang", "quality", "toxic"],
    ),
    "describe_numeric": _union(
        "SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        "round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 4) AS q25, "
        "round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS q50, round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 4) AS q75, "
        "round(CAST(max({c}) AS DOUBLE), 4) AS max FROM lineitem",
        LINE_NUMBERS,
    ),
    "column_range": _union(
        "SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM lineitem",
        LINE_NUMBERS,
    ),
    "table_shape": "SELECT count(*) AS rows, 11 AS columns FROM lineitem",
    "category_counts": _union(
        "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM orders GROUP BY {c}",
        ["o_orderstatus", "o_orderpriority"],
    ),
    "category_by_label": _union(
        "SELECT '{c}' AS \"column\", {c} AS value, quality AS label, count(*) AS count "
        "FROM documents JOIN labels USING (doc_id) GROUP BY {c}, quality",
        ["lang", "source"],
    ),
    "duplicate_rows": """
        SELECT l_quantity, l_discount, l_tax FROM (
          SELECT *, row_number() OVER (PARTITION BY l_quantity, l_discount, l_tax) AS r FROM lineitem) WHERE r > 1""",
    "drop_duplicates": "SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem",
    "corr_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", "
        + ("1.0::DOUBLE AS corr" if a == b else f"round(corr({a}, {b}), 6) AS corr FROM lineitem")
        for a in LINE_NUMBERS
        for b in LINE_NUMBERS
    ),
    "sketch_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS parts, count({c}) AS n, count(*) - count({c}) AS nulls, "
        "true AS distinct_within, true AS quantiles_within FROM lineitem"
        for c in SKETCHED
    ),
    "wide_correlation": """
        WITH cells AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) r(i))
        SELECT CAST(a.i AS VARCHAR) AS "left", CAST(b.i AS VARCHAR) AS "right", round(corr(a.v, b.v), 6) AS corr
        FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""",
    "histogram_density": """
        WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(o_totalprice) AS n,
                          greatest(ceil(log2(count(o_totalprice))) + 1, 1) AS bins FROM orders),
        b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / bins)), bins - 1) AS INTEGER) AS bin, count(*) AS c
              FROM orders, s GROUP BY 1),
        g AS (SELECT lo, n, (hi - lo) / bins AS width, CAST(unnest(range(CAST(bins AS BIGINT))) AS INTEGER) AS bin FROM s)
        SELECT bin, round(lo + bin * width, 4) AS low, coalesce(c, 0) AS count, round(coalesce(c, 0) / (n * width), 12) AS density
        FROM g LEFT JOIN b USING (bin)""",
    "kde_grid": """
        WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(c_acctbal) AS n,
                          stddev_samp(c_acctbal) * pow(count(c_acctbal), -0.2) AS h FROM customer),
        g AS (SELECT CAST(i AS INTEGER) AS grid_no, lo + i * (hi - lo) / 49 AS x, n, h FROM s, range(50) t(i))
        SELECT grid_no, round(x, 4) AS x,
               round(sum(exp(-0.5 * pow((x - c_acctbal) / h, 2))) / (n * h * sqrt(2 * pi())), 10) AS density
        FROM g, customer GROUP BY grid_no, x, n, h""",
    "top_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "best_row": "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1",
    "group_collect_set": """
        SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS types
        FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""",
    "log_sum_exp": """
        SELECT event_type, round(m + ln(sum(exp(value - m))), 6) AS lse
        FROM (SELECT *, max(value) OVER (PARTITION BY event_type) AS m FROM events) GROUP BY event_type, m""",
    "arg_max": """
        SELECT user_id, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1""",
    "softmax_group": """
        SELECT l_orderkey, l_linenumber, round(e / sum(e) OVER (PARTITION BY l_orderkey), 9) AS share FROM (
          SELECT l_orderkey, l_linenumber, exp(l_quantity - max(l_quantity) OVER (PARTITION BY l_orderkey)) AS e
          FROM lineitem)""",
    "row_to_json": """
        SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"'
               || o_orderpriority || '"}' AS json FROM orders""",
}
