"""Every operator on the given tables, each with the SQL that must agree.

All queries read whole tables. Where an operator compares two versions of a
table, the second version (the "replica") is derived from the first by Spark:
some values changed, some rows lost, as a faulty load would do. Dates, decimals
and arrays are returned as text or one element per row, so that results of two
engines compare exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import movecheck as mc
from movecheck.operators.profile_store import DISTINCT_ERROR
from movecheck.sources.sinks import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """The frame with the named columns as text."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in names else c for c in df.columns])


def contract(*rows: tuple[str, str, str, str]) -> mc.Contract:
    names = ("src_column_name", "target_column_name", "source_datatype", "isnullable")
    return mc.Contract.from_rows([dict(zip(names, row)) for row in rows])


# --- profiles ---------------------------------------------------------------

# The tables' column types, as needed by the profile SQL.
PROFILED = {
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
        "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
        "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
        "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
        "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    },
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
        "c_acctbal": "double", "c_mktsegment": "string",
    },
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
        "p_size": "int", "p_retailprice": "double",
    },
    "supplier": {
        "s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double",
    },
    "events": {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
        "event_type": "string", "value": "double", "props": "string",
    },
    "documents": {
        "doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
        "n_chars": "bigint",
    },
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
}
WHOLE = ("int", "bigint")


def _plain_digits_sql(x: str) -> tuple[str, str, str]:
    t = f"CAST(ABS({x}) AS VARCHAR)"
    point = f"INSTR({t}, '.')"
    return (
        f"MAX(LENGTH({t}) - CASE WHEN {point} > 0 THEN 1 ELSE 0 END)",
        f"MAX(CASE WHEN {point} > 0 THEN {point} - 1 ELSE LENGTH({t}) END)",
        f"MAX(CASE WHEN {point} > 0 THEN LENGTH({t}) - {point} ELSE 0 END)",
    )


def profile_sql(name: str, distinct: bool) -> str:
    branches = []
    for x, dtype in PROFILED[name].items():
        numeric = dtype in (*WHOLE, "double")
        ranged = not dtype.startswith("array")
        digits = _plain_digits_sql(x) if numeric else ("CAST(NULL AS INT)",) * 3
        fields = {
            "column_name": f"'{x}'",
            "data_type": f"'{dtype}'",
            "n_rows": "COUNT(*)",
            "n_nulls": f"COUNT(*) - COUNT({x})",
            "min_value": f"CAST(MIN({x}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)",
            "max_value": f"CAST(MAX({x}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)",
            "n_distinct": f"COUNT(DISTINCT {x})",
            "max_length": f"MAX(LENGTH({x}))" if dtype == "string" else "CAST(NULL AS INT)",
            "max_precision": digits[0],
            "max_integer_digits": digits[1],
            "max_scale": digits[2],
            "n_unmeasured": "CAST(0 AS BIGINT)" if numeric else "CAST(NULL AS BIGINT)",
        }
        if not distinct:
            del fields["n_distinct"]
        columns = ", ".join(f"{sql} AS {alias}" for alias, sql in fields.items())
        branches.append(f"SELECT {columns} FROM {name}")
    return " UNION ALL ".join(branches)


def _register_profiles() -> None:
    for name in PROFILED:
        def exact(spark: SparkSession, sf_dir: str, name: str = name) -> DataFrame:
            return mc.profile_columns(table(spark, sf_dir, name), exact_distinct=True)

        QUERIES[f"profile_{name}"] = exact
        ORACLES[f"profile_{name}"] = profile_sql(name, distinct=True)


_register_profiles()


@query(profile_sql("lineitem", distinct=False))
def profile_lineitem_estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass profile; its estimated distinct counts have no exact SQL."""
    return mc.profile_columns(table(spark, sf_dir, "lineitem")).drop("n_distinct")


@query(
    "SELECT column_name, true AS within_error FROM (VALUES "
    + ", ".join(f"('{name}')" for name in PROFILED["lineitem"])
    + ") t(column_name) WHERE EXISTS (SELECT 1 FROM lineitem)"
)
def profile_lineitem_estimate_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated distinct counts against exact ones: within three standard deviations."""
    lineitem, error = table(spark, sf_dir, "lineitem"), 0.02
    estimated = mc.profile_columns(lineitem, distinct_error=error).select("column_name", "n_distinct")
    exact = mc.profile_columns(lineitem, exact_distinct=True).select("column_name", F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return estimated.join(exact, "column_name").select(
        "column_name", (off <= F.ceil(3 * error * F.col("exact"))).alias("within_error")
    )


def by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyyMM"))


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of orders by month: all months at first, then the last one anew."""
    orders, path = by_month(spark, sf_dir), scratch_path(spark, "profiles")
    mc.refresh_profile_store(orders, path, "month")
    last = orders.agg(F.max("month")).first()[0]
    mc.refresh_profile_store(orders, path, "month", parts=[last])
    return mc.read_profile_store(spark, path)


@query(profile_sql("orders", distinct=False))
def profile_store_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile merged from the states of all months."""
    return mc.merged_profile(stored_orders(spark, sf_dir)).drop("n_distinct")


@query(
    "SELECT column_name, n_exact, true AS within_error FROM ("
    + " UNION ALL ".join(f"SELECT '{x}' AS column_name, COUNT(DISTINCT {x}) AS n_exact FROM orders" for x in PROFILED["orders"])
    + ")"
)
def profile_store_orders_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts from merged sketches: within four standard deviations of the exact ones."""
    exact = mc.profile_columns(table(spark, sf_dir, "orders"), exact_distinct=True)
    found = mc.merged_profile(stored_orders(spark, sf_dir)).select("column_name", F.col("n_distinct").alias("found"))
    off = F.abs(F.col("found") - F.col("n_distinct"))
    return exact.join(found, "column_name").select(
        "column_name", F.col("n_distinct").alias("n_exact"),
        (off <= 1 + 4 * DISTINCT_ERROR * F.col("n_distinct")).alias("within_error"),
    )


def footer_sql(name: str) -> str:
    ends = {"int": "footer", "bigint": "footer"}
    branches = [
        f"SELECT '{x}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, COUNT(*) - COUNT({x}) AS n_nulls, "
        f"CAST(MIN({v}) AS VARCHAR) AS min_value, CAST(MAX({v}) AS VARCHAR) AS max_value, '{ends.get(t, 'scan')}' AS source FROM {name}"
        for x, t in PROFILED[name].items() for v in [f"{x} + CAST(0 AS DOUBLE)" if t == "double" else x]
    ]
    return " UNION ALL ".join(branches)


@query(footer_sql("lineitem"))
def footer_profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts from footers, ends from footers where they keep them."""
    return mc.footer_profile(spark, f"{sf_dir}/lineitem.parquet")


@query(footer_sql("orders"))
def footer_profile_orders_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of an ORC copy."""
    path = scratch_path(spark, "orders-orc")
    mc.write_table(table(spark, sf_dir, "orders"), path, "orc")
    return mc.footer_profile(spark, path, "orc")


def numeric_profile_sql(name: str, x: str) -> str:
    precision, _, scale = _plain_digits_sql(x)
    return (
        f"SELECT {precision} AS max_precision, {scale} AS max_scale, MIN({x}) AS min_value, "
        f"MAX({x}) AS max_value, COUNT(*) AS total_rows, COUNT(DISTINCT {x}) AS distinct_values, "
        f"CAST(0 AS BIGINT) AS n_unmeasured FROM {name} WHERE {x} IS NOT NULL"
    )


@query(numeric_profile_sql("lineitem", "l_extendedprice"))
def numeric_profile_extendedprice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.numeric_profile(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(numeric_profile_sql("customer", "c_acctbal"))
def numeric_profile_acctbal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.numeric_profile(table(spark, sf_dir, "customer"), "c_acctbal")


@query(numeric_profile_sql("part", "p_size"))
def numeric_profile_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.numeric_profile(table(spark, sf_dir, "part"), "p_size")


@query(numeric_profile_sql("orders", "o_totalprice").replace(", CAST(0 AS BIGINT) AS n_unmeasured", ""))
def numeric_profile_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report written as Spark SQL on a view of the table."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("profiled_orders")
    return spark.sql(
        """
        WITH sized AS (
            SELECT o_totalprice AS amount, CAST(ABS(o_totalprice) AS STRING) AS digits
            FROM profiled_orders
            WHERE o_totalprice IS NOT NULL
        )
        SELECT max(length(replace(digits, '.', ''))) AS max_precision,
               max(if(instr(digits, '.') > 0, length(digits) - instr(digits, '.'), 0)) AS max_scale,
               min(amount) AS min_value,
               max(amount) AS max_value,
               count(*) AS total_rows,
               count(DISTINCT amount) AS distinct_values
        FROM sized
        """
    )


def text_digits_sql(name: str) -> str:
    branches = []
    for x, dtype in PROFILED[name].items():
        before = after = length = "MAX(CAST(NULL AS INT))"
        t = f"CAST({x} AS VARCHAR)"
        if dtype in WHOLE:
            before, after = f"MAX(LENGTH(LTRIM({t}, '-')))", f"MAX(LENGTH({t}))"
        elif dtype == "double":
            before = f"MAX(INSTR(LTRIM({t}, '-'), '.') - 1)"
            after = f"MAX(LENGTH({t}) - INSTR({t}, '.'))"
        elif dtype == "string":
            length = f"MAX(LENGTH({x}))"
        branches.append(
            f"SELECT '{x}' AS column_name, '{dtype}' AS data_type, {before} AS max_precision, "
            f"{after} AS max_scale, {length} AS max_length FROM {name}"
        )
    return " UNION ALL ".join(branches)


@query(text_digits_sql("lineitem"))
def text_digit_profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.text_digit_profile(table(spark, sf_dir, "lineitem"))


@query(text_digits_sql("customer"))
def text_digit_profile_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.text_digit_profile(table(spark, sf_dir, "customer"))


@query(text_digits_sql("documents"))
def text_digit_profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.text_digit_profile(table(spark, sf_dir, "documents"))


# --- comparisons ------------------------------------------------------------


def lineitem_replica(lineitem: DataFrame) -> DataFrame:
    """A faulty copy: wrong tax on returned open lines, largest lines lost."""
    wrong = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return lineitem.filter("l_quantity < 50").withColumn(
        "l_tax", F.when(wrong, F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    )


LINEITEM_REPLICA_SQL = """
    SELECT * REPLACE (CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O'
                           THEN l_tax + 1 ELSE l_tax END AS l_tax)
    FROM lineitem WHERE l_quantity < 50
"""


def orders_replica(orders: DataFrame) -> DataFrame:
    """A faulty copy: low priorities renamed, pending orders repriced, cheap ones lost."""
    return orders.filter("o_totalprice >= 50000").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.regexp_replace("o_orderpriority", "^5-LOW$", "5-NONE").alias("o_orderpriority"),
    )


ORDERS_REPLICA_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate,
           CASE WHEN o_orderpriority = '5-LOW' THEN '5-NONE' ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_totalprice >= 50000
"""


@query(
    f"""
    WITH replica AS ({LINEITEM_REPLICA_SQL})
    SELECT 'only_left' AS side, * FROM (SELECT * FROM lineitem EXCEPT SELECT * FROM replica)
    UNION ALL
    SELECT 'only_right' AS side, * FROM (SELECT * FROM replica EXCEPT SELECT * FROM lineitem)
    """
)
def reconcile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return mc.reconcile(lineitem, lineitem_replica(lineitem)).rows


QUERIES["reconcile_tree_lineitem"] = lambda spark, sf_dir: mc.reconcile_tree(
    table(spark, sf_dir, "lineitem"), lineitem_replica(table(spark, sf_dir, "lineitem")), ["l_orderkey"]
).rows
ORACLES["reconcile_tree_lineitem"] = ORACLES["reconcile_lineitem"]


def events_replica(events: DataFrame) -> DataFrame:
    """A copy with one damaged run of ids: values shifted in the middle hundredth, copies of every tenth of it."""
    ends = events.agg(F.min("event_id").alias("low"), (F.max("event_id") - F.min("event_id") + 1).alias("width"))
    place = F.expr("(event_id - low) * 100 div width")
    placed = events.join(F.broadcast(ends), F.lit(True)).withColumn("place", place)
    damaged = placed.withColumn("value", F.when(F.col("place") == 50, F.col("value") + 0.25).otherwise(F.col("value")))
    copies = F.when((F.col("place") == 50) & (F.col("event_id") % 10 == 0), 2).otherwise(1)
    return damaged.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(*events.columns)


EVENTS_REPLICA_SQL = """
    SELECT event_id, ts, user_id, event_type, CASE WHEN place = 50 THEN value + 0.25 ELSE value END AS value, props
    FROM (SELECT *, ((event_id - MIN(event_id) OVER ()) * 100) // (MAX(event_id) OVER () - MIN(event_id) OVER () + 1) AS place FROM events),
      (VALUES (1), (2)) v(copy)
    WHERE copy = 1 OR (place = 50 AND event_id % 10 = 0)
"""


@query(
    f"""
    WITH replica AS ({EVENTS_REPLICA_SQL}), marks AS (
      SELECT *, 1 AS mark FROM events UNION ALL SELECT *, -1 FROM replica
    ), net AS (
      SELECT event_id, ts, user_id, event_type, value, props, SUM(mark) AS excess FROM marks GROUP BY ALL HAVING SUM(mark) <> 0
    )
    SELECT CASE WHEN excess > 0 THEN 'only_left' ELSE 'only_right' END AS side, * EXCLUDE (excess),
           CAST(ABS(excess) AS BIGINT) AS n_copies
    FROM net
    """
)
def reconcile_tree_events_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return mc.reconcile_tree(events, events_replica(events), ["event_id"], multiset=True, leaf_rows=100).rows


@query(
    f"""
    WITH replica AS ({LINEITEM_REPLICA_SQL})
    SELECT 'only_left' AS side, COUNT(*) AS n_rows
    FROM (SELECT * FROM lineitem EXCEPT SELECT * FROM replica)
    UNION ALL
    SELECT 'only_right', COUNT(*) FROM (SELECT * FROM replica EXCEPT SELECT * FROM lineitem)
    """
)
def reconcile_lineitem_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return mc.reconcile(lineitem, lineitem_replica(lineitem)).counts()


@query(
    f"""
    WITH replica AS ({ORDERS_REPLICA_SQL}),
    lost AS (SELECT * FROM orders EXCEPT SELECT * FROM replica),
    added AS (SELECT * FROM replica EXCEPT SELECT * FROM orders)
    SELECT 'count' AS entry, 'only_left' AS side, (SELECT COUNT(*) FROM lost) AS n_rows,
           CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS BIGINT) AS o_custkey,
           CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
           CAST(NULL AS VARCHAR) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
    UNION ALL
    SELECT 'count', 'only_right', (SELECT COUNT(*) FROM added), NULL, NULL, NULL, NULL, NULL, NULL
    UNION ALL
    SELECT 'sample', 'only_left', NULL, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR), o_orderpriority
    FROM (SELECT * FROM lost ORDER BY ALL ASC NULLS FIRST LIMIT 5)
    UNION ALL
    SELECT 'sample', 'only_right', NULL, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR), o_orderpriority
    FROM (SELECT * FROM added ORDER BY ALL ASC NULLS FIRST LIMIT 5)
    """
)
def reconcile_orders_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and five sample rows per side, from one shuffle."""
    orders = table(spark, sf_dir, "orders")
    report = mc.reconcile(orders, orders_replica(orders)).report(5)
    return as_text(report, "o_orderdate")


BAG_SQL = f"""
    WITH replica AS ({ORDERS_REPLICA_SQL}),
    l AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY ALL),
    r AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM replica GROUP BY ALL)
    SELECT CASE WHEN COALESCE(l.n, 0) > COALESCE(r.n, 0) THEN 'only_left' ELSE 'only_right' END AS side,
           COALESCE(l.o_orderstatus, r.o_orderstatus) AS o_orderstatus,
           COALESCE(l.o_orderpriority, r.o_orderpriority) AS o_orderpriority,
           ABS(COALESCE(l.n, 0) - COALESCE(r.n, 0)) AS n_copies
    FROM l FULL JOIN r ON l.o_orderstatus IS NOT DISTINCT FROM r.o_orderstatus
                      AND l.o_orderpriority IS NOT DISTINCT FROM r.o_orderpriority
    WHERE COALESCE(l.n, 0) <> COALESCE(r.n, 0)
"""


@query(BAG_SQL)
def reconcile_orders_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct rows with very many copies: the copies collapse map-side."""
    orders = table(spark, sf_dir, "orders")
    cols = ["o_orderstatus", "o_orderpriority"]
    return mc.reconcile(orders, orders_replica(orders), cols, multiset=True).rows


@query(
    f"""
    WITH replica AS ({ORDERS_REPLICA_SQL}),
    l AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders),
    r AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM replica)
    SELECT 'only_left' AS side, * FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
    UNION ALL
    SELECT 'only_right' AS side, * FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)
    """
)
def reconcile_orders_bag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cols = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    return mc.reconcile(orders, orders_replica(orders), cols, multiset=True).expanded()


@query(
    """
    SELECT 'only_left' AS side, * FROM
        (SELECT o_orderkey AS orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT 'only_right' AS side, * FROM
        (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)
    """
)
def reconcile_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of very different size, compared on the key they share."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return mc.reconcile(orders, lines).rows


@query(
    """
    WITH replica AS (SELECT * REPLACE (
        CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value + 0.0001 END AS value) FROM events),
    l AS (SELECT * REPLACE (ROUND(value, 2) AS value) FROM events),
    r AS (SELECT * REPLACE (ROUND(value, 2) AS value) FROM replica)
    SELECT 'only_left' AS side, COUNT(*) AS n_rows FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
    UNION ALL
    SELECT 'only_right', COUNT(*) FROM (SELECT * FROM r EXCEPT SELECT * FROM l)
    """
)
def reconcile_events_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    shift = F.when(F.col("event_type") == "purchase", F.lit(1.0)).otherwise(F.lit(0.0001))
    replica = events.withColumn("value", F.col("value") + shift)
    return mc.reconcile(events, replica, tolerance_scale=2).counts()


@query(
    """
    WITH replica AS (SELECT * REPLACE (REPLACE(text, chr(10), ' ') AS text) FROM documents)
    SELECT 'only_left' AS side, * FROM (SELECT * FROM documents EXCEPT SELECT * FROM replica)
    UNION ALL
    SELECT 'only_right' AS side, * FROM (SELECT * FROM replica EXCEPT SELECT * FROM documents)
    """
)
def reconcile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, against a replica whose writer lost the line ends."""
    docs = table(spark, sf_dir, "documents")
    replica = docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))
    return mc.reconcile(docs, replica).rows


ORDERS_BY_KEY_SQL = f"""
    WITH replica AS ({ORDERS_REPLICA_SQL}),
    l AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders),
    r AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM replica),
    lost AS (SELECT o_orderkey AS k, COUNT(*) AS n, MAX(o_custkey) AS o_custkey,
                    MAX(o_totalprice) AS o_totalprice, MAX(o_orderpriority) AS o_orderpriority
             FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) GROUP BY o_orderkey),
    added AS (SELECT o_orderkey AS k, COUNT(*) AS n, MAX(o_custkey) AS o_custkey,
                     MAX(o_totalprice) AS o_totalprice, MAX(o_orderpriority) AS o_orderpriority
              FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l) GROUP BY o_orderkey),
    joined AS (
        SELECT COALESCE(lost.k, added.k) AS o_orderkey,
               CASE WHEN added.n IS NULL THEN 'only_left' WHEN lost.n IS NULL THEN 'only_right'
                    WHEN lost.n = 1 AND added.n = 1 THEN 'changed' ELSE 'ambiguous' END AS status,
               lost.o_totalprice AS left_o_totalprice, added.o_totalprice AS right_o_totalprice,
               lost.o_orderpriority AS left_o_orderpriority, added.o_orderpriority AS right_o_orderpriority,
               lost.o_custkey AS left_o_custkey, added.o_custkey AS right_o_custkey
        FROM lost FULL JOIN added ON lost.k IS NOT DISTINCT FROM added.k
    )
"""
COMPARED = ["o_custkey", "o_totalprice", "o_orderpriority"]


@query(
    ORDERS_BY_KEY_SQL
    + "SELECT o_orderkey, status, "
    + ", ".join(
        f"CASE WHEN status <> 'ambiguous' THEN {x} END AS {x}"
        for x in ("left_o_totalprice", "right_o_totalprice", "left_o_orderpriority", "right_o_orderpriority")
    )
    + " FROM joined"
)
def reconcile_orders_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    found = mc.reconcile_by_key(orders, orders_replica(orders), ["o_orderkey"], COMPARED)
    return found.rows.select(
        "o_orderkey", "status", "left_o_totalprice", "right_o_totalprice",
        "left_o_orderpriority", "right_o_orderpriority",
    )


@query(
    ORDERS_BY_KEY_SQL
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT(*) AS n_changed, "
        f"COUNT(*) FILTER (left_{name} IS DISTINCT FROM right_{name}) AS n_mismatches "
        "FROM joined WHERE status = 'changed'"
        for name in COMPARED
    )
)
def reconcile_orders_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return mc.reconcile_by_key(
        orders, orders_replica(orders), ["o_orderkey"], COMPARED
    ).mismatches()


@query(
    f"""
    WITH replica AS ({LINEITEM_REPLICA_SQL}),
    l AS (SELECT * FROM lineitem),
    r AS (SELECT * FROM replica),
    excess AS (
        SELECT l_orderkey, 1 AS l, 0 AS r FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
        UNION ALL
        SELECT l_orderkey, 0, 1 FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)
    ),
    keys AS (SELECT l_orderkey, SUM(l) AS l, SUM(r) AS r FROM excess GROUP BY l_orderkey)
    SELECT CASE WHEN r = 0 THEN 'only_left' WHEN l = 0 THEN 'only_right'
                WHEN l = 1 AND r = 1 THEN 'changed' ELSE 'ambiguous' END AS status,
           COUNT(*) AS n_keys
    FROM keys GROUP BY ALL
    """
)
def reconcile_lineitem_key_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key with several rows per side."""
    lineitem = table(spark, sf_dir, "lineitem")
    return mc.reconcile_by_key(lineitem, lineitem_replica(lineitem), ["l_orderkey"]).statuses()


# --- contracts --------------------------------------------------------------

ORDERS_CONTRACT = contract(
    ("o_orderkey", "order_id", "bigint", "false"),
    ("o_custkey", "customer_id", "string", "false"),
    ("o_totalprice", "price", "decimal(15,2)", "true"),
    ("o_orderdate", "ordered_on", "date", "true"),
    ("o_orderpriority", "priority_code", "int", "true"),
    ("o_clerk", "clerk", "string", "true"),
)
ORDERS_CONFORMED_SQL = """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(TRY_CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered_on,
           TRY_CAST(o_orderpriority AS INT) AS priority_code, CAST(NULL AS VARCHAR) AS clerk
    FROM orders
"""


@query(ORDERS_CONFORMED_SQL)
def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(mc.conform(table(spark, sf_dir, "orders"), ORDERS_CONTRACT), "price", "ordered_on")


@query(
    """
    SELECT * REPLACE (CAST(TRY_CAST(l_quantity AS DECIMAL(38,9)) AS VARCHAR) AS l_quantity,
                      CAST(l_shipdate AS VARCHAR) AS l_shipdate)
    FROM lineitem
    """
)
def conform_by_contract_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract file made from the table's schema, read back and applied."""
    lineitem = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "contract")
    wanted = PROFILED["lineitem"] | {"l_quantity": "numeric(38,9)"}
    rows = [(f.name, wanted[f.name], "true") for f in lineitem.schema]
    spark.createDataFrame(rows, "src_column_name string, source_datatype string, isnullable string").coalesce(
        1
    ).write.csv(path, sep="|", header=True, encoding="ISO-8859-1")
    result = mc.conform(lineitem, mc.read_contract(spark, path))
    return as_text(result, "l_quantity", "l_shipdate")


@query(
    """
    SELECT 'order_id' AS column_name, 'bigint' AS from_type, 'bigint' AS to_type, COUNT(*) AS n_rows,
           COUNT(*) FILTER (o_orderkey IS NULL) AS n_nulls, CAST(0 AS BIGINT) AS n_lost,
           CAST(0 AS BIGINT) AS n_altered, COUNT(*) FILTER (o_orderkey IS NULL) AS n_violations FROM orders
    UNION ALL
    SELECT 'customer_id', 'bigint', 'string', COUNT(*), COUNT(*) FILTER (o_custkey IS NULL), 0, 0,
           COUNT(*) FILTER (o_custkey IS NULL) FROM orders
    UNION ALL
    SELECT 'price', 'double', 'decimal(15,1)', COUNT(*), COUNT(*) FILTER (o_totalprice IS NULL), 0,
           COUNT(*) FILTER (CAST(TRY_CAST(o_totalprice AS DECIMAL(15,1)) AS DOUBLE) <> o_totalprice), 0 FROM orders
    UNION ALL
    SELECT 'ordered_on', 'timestamp_ntz', 'date', COUNT(*), COUNT(*) FILTER (o_orderdate IS NULL), 0,
           COUNT(*) FILTER (CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) <> o_orderdate), 0 FROM orders
    UNION ALL
    SELECT 'priority_code', 'string', 'int', COUNT(*), COUNT(*) FILTER (o_orderpriority IS NULL),
           COUNT(*) FILTER (o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INT) IS NULL), 0, 0 FROM orders
    UNION ALL
    SELECT 'clerk', NULL, 'string', COUNT(*), COUNT(*), 0, 0, 0 FROM orders
    """
)
def contract_losses_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.contract_losses(table(spark, sf_dir, "orders"), ORDERS_CONTRACT, decimal=(15, 1))


LABELLED_CONTRACT = contract(
    ("doc_id", "doc_id", "bigint", "false"),
    ("text", "text", "string", "true"),
    ("quality", "quality", "int", "false"),
    ("toxic", "toxic", "int", "false"),
)


@query(
    """
    WITH labelled AS (SELECT d.doc_id, d.text, l.quality, l.toxic
                      FROM documents d LEFT JOIN (
                          SELECT doc_id, MAX(quality) AS quality, MAX(toxic) AS toxic FROM labels GROUP BY doc_id
                      ) l ON d.doc_id = l.doc_id)
    SELECT 'doc_id' AS column_name, COUNT(*) AS n_rows, COUNT(*) FILTER (doc_id IS NULL) AS n_nulls FROM labelled
    UNION ALL
    SELECT 'quality', COUNT(*), COUNT(*) FILTER (quality IS NULL) FROM labelled
    UNION ALL
    SELECT 'toxic', COUNT(*), COUNT(*) FILTER (toxic IS NULL) FROM labelled
    """
)
def null_violations_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One label row per document, so that the join cannot multiply rows.
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    labelled = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return mc.null_violations(labelled, LABELLED_CONTRACT)


# --- drift and casts --------------------------------------------------------


def orders_retyped(orders: DataFrame) -> DataFrame:
    """A later version of the table: narrower types, one column gone, one new."""
    return orders.select(
        "o_orderkey",
        F.col("o_custkey").try_cast("smallint").alias("o_custkey"),
        F.col("o_totalprice").try_cast("decimal(7,2)").alias("o_totalprice"),
        F.col("o_orderstatus"),
        F.col("o_orderpriority").try_cast("int").alias("o_orderpriority"),
        F.lit(None).cast("string").alias("o_clerk"),
    )


def _losses_sql(labels: str, x: str, wanted: str) -> str:
    return (
        f"SELECT {labels}, COUNT({x}) AS n_values, "
        f"COUNT(*) FILTER ({x} IS NOT NULL AND TRY_CAST({x} AS {wanted}) IS NULL) AS n_lost FROM orders"
    )


@query(
    _losses_sql("'o_totalprice' AS column_name, 'double' AS left_type, 'decimal(7,2)' AS right_type, "
                "'type_differs' AS status", "o_totalprice", "DECIMAL(7,2)")
    + " UNION ALL "
    + _losses_sql("'o_custkey', 'bigint', 'smallint', 'type_differs'", "o_custkey", "SMALLINT")
    + " UNION ALL "
    + _losses_sql("'o_orderpriority', 'string', 'int', 'type_differs'", "o_orderpriority", "INT")
    + """
    UNION ALL SELECT 'o_orderkey', 'bigint', 'bigint', 'same', NULL, NULL
    UNION ALL SELECT 'o_orderstatus', 'string', 'string', 'same', NULL, NULL
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', NULL, 'only_left', NULL, NULL
    UNION ALL SELECT 'o_clerk', NULL, 'string', 'only_right', NULL, NULL
    """
)
def drift_report_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return mc.drift_report(orders, orders_retyped(orders))


@query(
    """
    SELECT o_orderkey, TRY_CAST(o_custkey AS SMALLINT) AS o_custkey, o_orderstatus,
           CAST(TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS VARCHAR) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate,
           TRY_CAST(o_orderpriority AS INT) AS o_orderpriority
    FROM orders
    """
)
def align_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return as_text(mc.align_to(orders, orders_retyped(orders)), "o_totalprice", "o_orderdate")


@query(
    """
    SELECT TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS o_orderkey, o_custkey, o_totalprice,
           CAST(NULL AS VARCHAR) AS o_orderpriority, o_orderstatus FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, NULL FROM orders
    """
)
def union_aligned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old version with text keys under a new one; each has a column of its own."""
    orders = table(spark, sf_dir, "orders")
    old = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_custkey", "o_totalprice", "o_orderstatus"
    )
    new = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return mc.union_aligned(old, new)


@query(
    _losses_sql("'o_orderpriority' AS column_name, 'string' AS from_type, 'int' AS to_type, COUNT(*) AS n_rows",
                "o_orderpriority", "INT")
    + " UNION ALL "
    + _losses_sql("'o_totalprice', 'double', 'decimal(7,2)', COUNT(*)", "o_totalprice", "DECIMAL(7,2)")
    + " UNION ALL "
    + _losses_sql("'o_orderkey', 'bigint', 'tinyint', COUNT(*)", "o_orderkey", "TINYINT")
)
def cast_loss_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = T.StructType(
        [
            T.StructField("o_orderpriority", T.IntegerType()),
            T.StructField("o_totalprice", T.DecimalType(7, 2)),
            T.StructField("o_orderkey", T.ByteType()),
        ]
    )
    return mc.cast_loss(table(spark, sf_dir, "orders"), wanted)


@query(
    "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) "
    "* CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS amount FROM lineitem"
)
def keep_decimals_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a precision, decimals are recast to what they are."""
    lineitem = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    amounts = lineitem.select("l_orderkey", "l_linenumber", price.alias("amount"))
    return as_text(mc.fit_decimals(amounts), "amount")


def wide_prices(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    return lineitem.select("l_orderkey", "l_linenumber", (price * price).alias("amount"))


WIDE_PRICE_SQL = (
    "(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) "
    "* CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)))"
)


@query(
    "SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) "
    "* CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,3)) AS VARCHAR) AS amount FROM lineitem"
)
def fit_decimals_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with four decimals, rounded half up to three."""
    lineitem = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    amounts = lineitem.select("l_orderkey", "l_linenumber", price.alias("amount"))
    return as_text(mc.fit_decimals(amounts, 18, 3), "amount")


@query(
    f"""
    SELECT 'amount' AS column_name, 'decimal(38,8)' AS from_type, 'decimal(9,2)' AS to_type, COUNT(*) AS n_rows,
           COUNT({WIDE_PRICE_SQL}) AS n_values,
           COUNT(*) FILTER (TRY_CAST({WIDE_PRICE_SQL} AS DECIMAL(9,2)) IS NULL) AS n_lost FROM lineitem
    """
)
def decimal_overflow_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = wide_prices(table(spark, sf_dir, "lineitem"))
    amounts = mc.fit_decimals(amounts, 38, 8)
    return mc.decimal_overflow(amounts, 9, 2)


@query(
    """
    SELECT vec_id, u.pos - 1 AS pos, CAST(TRY_CAST(embedding[u.pos] AS DECIMAL(38,9)) AS VARCHAR) AS element
    FROM embeddings, LATERAL (SELECT UNNEST(RANGE(1, LEN(embedding) + 1)) AS pos) u
    """
)
def cast_elements_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = mc.cast_elements(table(spark, sf_dir, "embeddings"), "embedding", T.DecimalType(38, 9))
    exploded = cast.select("vec_id", F.posexplode("embedding").alias("pos", "element"))
    return as_text(exploded, "element")


# --- missing rows and months ------------------------------------------------


@query("SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id IS NOT DISTINCT FROM d.doc_id)")
def missing_rows_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.missing_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    """
    SELECT * FROM orders WHERE NOT EXISTS
        (SELECT 1 FROM lineitem WHERE l_orderkey IS NOT DISTINCT FROM o_orderkey)
    """
)
def missing_rows_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines: the other table repeats each key many times."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return mc.missing_rows(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query(
    f"""
    WITH replica AS ({LINEITEM_REPLICA_SQL})
    SELECT l.* REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM replica r
                      WHERE r.l_orderkey IS NOT DISTINCT FROM l.l_orderkey
                        AND r.l_linenumber IS NOT DISTINCT FROM l.l_linenumber)
    """
)
def missing_rows_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    found = mc.missing_rows(lineitem, lineitem_replica(lineitem), ["l_orderkey", "l_linenumber"])
    return as_text(found, "l_shipdate")


@query(
    """
    SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity >= 30 AND l_orderkey IS NOT DISTINCT FROM o_orderkey)
    """
)
def missing_rows_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a large line, in a table whose keys were stored as text."""
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity >= 30")
    texts = lines.select(F.col("l_orderkey").cast("string").alias("o_orderkey"))
    return as_text(mc.missing_rows(table(spark, sf_dir, "orders"), texts, ["o_orderkey"]), "o_orderdate")


@query("SELECT * FROM documents")
def copy_missing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the labelled documents, completed from the whole one."""
    docs = table(spark, sf_dir, "documents")
    target = scratch_path(spark, "documents")
    mc.write_table(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi"), target)
    mc.copy_missing(docs, mc.read_table(spark, target, "parquet"), ["doc_id"], target)
    return mc.read_table(spark, target, "parquet")


MONTHS_SQL = """
    WITH spine AS (SELECT strftime(m, '%Y%m') AS yyyymm FROM
        generate_series(TIMESTAMP '1994-07-01', TIMESTAMP '2002-07-01', INTERVAL 1 MONTH) AS t(m)),
    found AS (SELECT strftime(o_orderdate, '%Y%m') AS yyyymm, COUNT(*) AS n FROM orders GROUP BY ALL)
    SELECT spine.yyyymm, COALESCE(n, 0) AS n_rows FROM spine LEFT JOIN found ON spine.yyyymm = found.yyyymm
"""


@query(MONTHS_SQL)
def month_coverage_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.month_coverage(table(spark, sf_dir, "orders"), "o_orderdate", "199407", "200207")


@query(f"SELECT yyyymm FROM ({MONTHS_SQL}) WHERE n_rows = 0")
def missing_months_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.missing_months(table(spark, sf_dir, "orders"), "o_orderdate", "199407", "200207")


SCANNED_SQL = """
    SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate), strftime(o_orderdate, '%Y%m') AS o_orderdate_month
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-07-01' AND o_orderdate < TIMESTAMP '1998-08-01'
"""


@query(SCANNED_SQL)
def scan_months_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 months out of a table partitioned by month; other folders stay unread."""
    target = scratch_path(spark, "orders-by-month")
    mc.write_table(
        table(spark, sf_dir, "orders"), target, "orc", partition_by="o_orderdate", partition_grain="month"
    )
    kept = mc.scan_months(mc.read_table(spark, target, "orc"), "o_orderdate_month", "199607", "199807")
    return as_text(kept, "o_orderdate")


@query(SCANNED_SQL.replace(", strftime(o_orderdate, '%Y%m') AS o_orderdate_month", ""))
def scan_months_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = mc.scan_months(table(spark, sf_dir, "orders"), "o_orderdate", "199607", "199807")
    return as_text(kept, "o_orderdate")


# --- load reports -----------------------------------------------------------


@query(
    """
    SELECT user_id AS table_name, COUNT(*) AS n_failures FROM events
    WHERE event_type = 'error' AND user_id IS NOT NULL GROUP BY user_id
    """
)
def failure_summary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.failure_summary(table(spark, sf_dir, "events"), "user_id", "event_type", failed="error")


@query(
    """
    WITH failed AS (SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IS NOT NULL)
    SELECT 'The following tables failed to load: ' || p AS message FROM failed
    UNION ALL
    SELECT CASE WHEN count(*) > 0 THEN count(*) || ' tables failed to load.' ELSE 'All tables loaded successfully.' END
    FROM failed
    """
)
def failure_message_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of a load, with each order priority as a table and F as failed."""
    return mc.failure_message(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", failed="F")


# --- reading, writing, whole loads ------------------------------------------


@query("SELECT * FROM orders")
def orc_round_trip_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "orders-orc")
    mc.write_table(table(spark, sf_dir, "orders"), target, "orc", mode="errorifexists")
    return mc.read_table(spark, target)


@query(ORDERS_CONFORMED_SQL)
def read_under_contract_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "orders-physical")
    mc.write_table(table(spark, sf_dir, "orders"), target, "orc")
    return as_text(mc.read_table(spark, target, contract=ORDERS_CONTRACT), "price", "ordered_on")


@query("SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem")
def read_positional_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC files whose writer stored no names, only positions."""
    lineitem = table(spark, sf_dir, "lineitem")
    target = scratch_path(spark, "lineitem-positional")
    mc.write_table(lineitem.toDF(*[f"_col{i}" for i in range(len(lineitem.columns))]), target, "orc")
    types = PROFILED["lineitem"]
    wanted = contract(*[(name, name, types[name], "true") for name in lineitem.columns])
    return as_text(mc.read_table(spark, target, contract=wanted), "l_shipdate")


@query(
    "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate), "
    "lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS line FROM lineitem"
)
def read_text_folders_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders named 01 to 07, whose values are text under the contract."""
    lineitem = table(spark, sf_dir, "lineitem").withColumn("line", F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))
    target = scratch_path(spark, "lineitem-by-line")
    mc.write_table(lineitem, target, "orc", partition_by="line")
    types = PROFILED["lineitem"] | {"line": "string"}
    wanted = contract(*[(name, name, types[name], "true") for name in lineitem.columns])
    return as_text(mc.read_table(spark, target, contract=wanted), "l_shipdate")


@query(
    """
    SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate), strftime(l_shipdate, '%Y%m') AS l_shipdate_month
    FROM lineitem
    """
)
def write_partitioned_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "lineitem-by-month")
    mc.write_table(
        table(spark, sf_dir, "lineitem"), target, partition_by="l_shipdate", partition_grain="month",
        cluster_by=["l_suppkey"],
    )
    return as_text(mc.read_table(spark, target, "parquet"), "l_shipdate", "l_shipdate_month")


@query(
    """
    SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
                      CAST(o_orderdate AS VARCHAR) AS o_orderdate)
    FROM orders
    """
)
def write_dynamic_overwrite_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that replaces one partition and leaves the others alone."""
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "orders-refresh")
    mc.write_table(orders, target, partition_by="o_orderpriority")
    refreshed = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.lit(0.0))
    mc.write_table(refreshed, target, mode="overwrite", partition_by="o_orderpriority", dynamic=True)
    return as_text(mc.read_table(spark, target, "parquet"), "o_orderdate")


@query(
    """
    SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN -1.0 ELSE o_totalprice END AS o_totalprice,
                      CAST(o_orderdate AS VARCHAR) AS o_orderdate)
    FROM orders
    """
)
def refresh_catalog_table_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of which one partition is replaced."""
    orders, name = table(spark, sf_dir, "orders"), f"orders_{uuid.uuid4().hex}"
    mc.write_table(orders, name, partition_by="o_orderstatus", as_table=True)
    fresh = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(-1.0))
    mc.write_table(fresh, name, mode="overwrite", partition_by="o_orderstatus", dynamic=True, as_table=True)
    return as_text(mc.read_table(spark, name, "table"), "o_orderdate")


@query(ORDERS_REPLICA_SQL.replace("o_orderdate,", "CAST(o_orderdate AS VARCHAR) AS o_orderdate,"))
def write_full_refresh_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that replaces the whole table."""
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "orders-replaced")
    mc.write_table(orders, target, cluster_by=["o_custkey"])
    mc.write_table(orders_replica(orders), target, mode="overwrite", cluster_by=["o_custkey"])
    return as_text(mc.read_table(spark, target, "parquet"), "o_orderdate")


@query(
    """
    SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority) FROM orders
    UNION ALL
    SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders
    """
)
def read_drifted_paths_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of one table, whose types and columns changed between them."""
    orders = table(spark, sf_dir, "orders")
    paths = [scratch_path(spark, f"orders-{age}") for age in ("old", "new")]
    old = as_text(orders, "o_custkey").drop("o_orderpriority")
    mc.write_table(old, paths[0], "orc")
    mc.write_table(orders, paths[1], "orc")
    wanted = contract(*[(name, name, dtype, "true") for name, dtype in PROFILED["orders"].items()])
    return as_text(mc.read_table(spark, paths, contract=wanted), "o_orderdate")


@query(
    """
    SELECT * REPLACE (TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS o_orderkey,
                      CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS o_totalprice,
                      CAST(o_orderdate AS VARCHAR) AS o_orderdate)
    FROM orders
    """
)
def align_partitions_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old ORC partition in the types of a newer one."""
    orders = table(spark, sf_dir, "orders")
    old_path, new_path = (scratch_path(spark, f"orders-{age}-partition") for age in ("old", "new"))
    old = as_text(orders, "o_orderkey").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))
    mc.write_table(old, old_path, "orc")
    mc.write_table(orders.drop("o_orderstatus"), new_path, "orc")
    _, aligned, _ = mc.align_partitions(spark, old_path, new_path)
    return as_text(aligned, "o_orderdate")


@query(
    f"""
    WITH source AS ({ORDERS_CONFORMED_SQL}),
    loaded AS ({ORDERS_CONFORMED_SQL.replace("FROM orders", f"FROM ({ORDERS_REPLICA_SQL}) r")})
    SELECT 'only_left' AS side, * FROM (SELECT * FROM source EXCEPT ALL SELECT * FROM loaded)
    UNION ALL
    SELECT 'only_right' AS side, * FROM (SELECT * FROM loaded EXCEPT ALL SELECT * FROM source)
    """
)
def compare_orders_with_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC files read under a contract against a table that was loaded badly."""
    orders = table(spark, sf_dir, "orders")
    source, loaded = scratch_path(spark, "orders-files"), scratch_path(spark, "orders-loaded")
    mc.write_table(orders, source, "orc")
    mc.write_table(mc.conform(orders_replica(orders), ORDERS_CONTRACT), loaded)
    found = mc.compare_with_table(spark, source, ORDERS_CONTRACT, loaded, multiset=True)
    return as_text(found.expanded(), "price", "ordered_on")


def _migrate_orders(spark: SparkSession, sf_dir: str) -> mc.Migration:
    source, target = scratch_path(spark, "orders-source"), scratch_path(spark, "orders-target")
    mc.write_table(table(spark, sf_dir, "orders"), source, "orc")
    return mc.migrate(
        spark, source, ORDERS_CONTRACT, target, decimal=(38, 9), cluster_by=["customer_id"]
    )


@query(ORDERS_CONFORMED_SQL.replace("AS DECIMAL(15,2)) AS VARCHAR)", "AS DECIMAL(15,2))::DECIMAL(38,9) AS VARCHAR)"))
def migrate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_migrate_orders(spark, sf_dir).written, "price", "ordered_on")


@query(
    f"""
    WITH conformed AS ({ORDERS_CONFORMED_SQL}),
    before AS ({ORDERS_CONFORMED_SQL.replace("FROM orders", f"FROM ({ORDERS_REPLICA_SQL}) r")}),
    source AS (SELECT * REPLACE (CAST(price AS DECIMAL(16,2)) AS price) FROM conformed),
    target AS (SELECT * REPLACE (CAST(CAST(CAST(price AS DECIMAL(15,2)) AS DECIMAL(15,1)) AS DECIMAL(16,2)) AS price)
               FROM (SELECT * FROM conformed UNION ALL SELECT * FROM before))
    SELECT 'only_left' AS side, COUNT(*) AS n_rows FROM (SELECT * FROM source EXCEPT ALL SELECT * FROM target)
    UNION ALL
    SELECT 'only_right', COUNT(*) FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM source)
    """
)
def migrate_orders_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that rounds prices, into a table with wrong and extra rows from before."""
    orders = table(spark, sf_dir, "orders")
    source, target = scratch_path(spark, "orders-source"), scratch_path(spark, "orders-target")
    mc.write_table(orders, source, "orc")
    before = mc.fit_decimals(mc.conform(orders_replica(orders), ORDERS_CONTRACT), 15, 1)
    mc.write_table(before, target)
    done = mc.migrate(spark, source, ORDERS_CONTRACT, target, decimal=(15, 1), unfitted=True)
    return done.difference.counts()



@query(
    """
    SELECT side, COUNT(*) FILTER (WHERE price >= 100000) AS n_rows
    FROM (SELECT CAST(o_totalprice AS DECIMAL(15,2)) AS price FROM orders), (VALUES ('only_left'), ('only_right')) v(side)
    GROUP BY side
    """
)
def migrate_orders_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fits prices to too few places: nulls that the difference shows by default."""
    source, target = scratch_path(spark, "orders-source"), scratch_path(spark, "orders-target")
    mc.write_table(table(spark, sf_dir, "orders"), source, "orc")
    return mc.migrate(spark, source, ORDERS_CONTRACT, target, decimal=(7, 2)).difference.counts()


@query(
    f"""
    WITH replica AS ({LINEITEM_REPLICA_SQL}),
    l AS (SELECT l_orderkey, l_linenumber, CAST(l_tax AS DECIMAL(9,2)) AS tax, CAST(l_discount AS DECIMAL(9,2)) AS discount FROM lineitem),
    r AS (SELECT l_orderkey, l_linenumber, CAST(l_tax AS DECIMAL(9,2)) AS tax, CAST(l_discount AS DECIMAL(9,2)) AS discount FROM replica)
    SELECT 'only_left' AS side, COUNT(*) AS n_rows FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
    UNION ALL
    SELECT 'only_right', COUNT(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)
    """
)
def reconcile_lineitem_float_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32-bit floats against the decimals they were moved to: only real faults differ."""
    lineitem = table(spark, sf_dir, "lineitem")

    def rates(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select("l_orderkey", "l_linenumber", F.col("l_tax").cast(kind).alias("tax"), F.col("l_discount").cast(kind).alias("discount"))

    return mc.reconcile(rates(lineitem, "float"), rates(lineitem_replica(lineitem), "decimal(9,2)"), multiset=True).counts()


# --- contracts from data ------------------------------------------------------

INFERRED_TYPES = {"bigint": "bigint", "int": "int", "string": "string", "timestamp_ntz": "timestamp_ntz"}


def inferred_sql(name: str) -> str:
    """The least type that holds every value of the text copy."""
    branches = []
    for x, dtype in PROFILED[name].items():
        t = f"CAST({x} AS VARCHAR)"
        digits, scale = f"MAX(LENGTH(SPLIT_PART(LTRIM({t}, '-'), '.', 1)))", f"MAX(LENGTH(SPLIT_PART({t}, '.', 2)))"
        kind = f"'{INFERRED_TYPES.get(dtype)}'"
        if dtype == "double":
            kind = (
                f"CASE WHEN BOOL_OR({t} = '-0.0') THEN 'double' "
                f"ELSE 'decimal(' || CAST({digits} + {scale} AS VARCHAR) || ',' || CAST({scale} AS VARCHAR) || ')' END"
            )
        elif dtype in WHOLE:
            kind = f"CASE WHEN MAX({x}) < 2147483648 THEN 'int' ELSE 'bigint' END"
        branches.append(
            f"SELECT '{x}' AS src_column_name, '{x}' AS target_column_name, {kind} AS source_datatype, "
            f"CASE WHEN COUNT({x}) < COUNT(*) THEN 'true' ELSE 'false' END AS isnullable, "
            f"'true' AS iscolpresentindata, 'true' AS isrequired FROM {name}"
        )
    return " UNION ALL ".join(branches)


def text_copy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = table(spark, sf_dir, name)
    return as_text(rows, *rows.columns)


@query(inferred_sql("orders"))
def infer_contract_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.infer_contract(text_copy(spark, sf_dir, "orders"))


@query(inferred_sql("lineitem"))
def infer_contract_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.infer_contract(text_copy(spark, sf_dir, "lineitem"))


@query(
    " UNION ALL ".join(
        f"SELECT '{x}' AS column_name, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_altered, "
        f"CAST(0 AS BIGINT) AS n_violations FROM lineitem"
        for x in PROFILED["lineitem"]
    )
)
def inferred_contract_losses_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What conforming the text copy to its own inferred contract costs: nothing."""
    copy = text_copy(spark, sf_dir, "lineitem")
    losses = mc.contract_losses(copy, mc.infer_contract(copy))
    return losses.select("column_name", "n_rows", "n_lost", "n_altered", "n_violations")


# --- renames, nearness, rejects, digit tables -----------------------------------


def orders_renamed(orders: DataFrame) -> DataFrame:
    """A later version: three columns renamed, all reordered and one retyped, two look-alikes added."""
    return orders.select(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        (F.col("o_custkey") + 1000000).alias("clerk_id"),
        F.col("o_totalprice").alias("price"),
        "o_orderdate",
        # The statuses of orders, but of others.
        F.when(F.col("o_orderkey") % 4 == 0, "F").when(F.col("o_orderkey") % 4 == 1, "P").otherwise("O").alias("ship_state"),
    ).filter(F.col("o_totalprice") >= 10000)


def _renames_sql() -> str:
    """Every pair of one-sided columns, compared value by value."""
    lefts = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderpriority": "string"}
    rights = {"priority": "string", "order_id": "string", "clerk_id": "bigint", "price": "double", "ship_state": "string"}

    def values(columns: dict[str, str], source: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v, COUNT(*) / (SELECT COUNT(*) FROM {source}) AS share FROM {source} GROUP BY ALL"
            for c in columns
        )

    kinds = " UNION ALL ".join(f"SELECT '{c}' AS c, '{t}' AS t" for c, t in (lefts | rights).items())
    return f"""
    WITH later AS (
      SELECT o_orderpriority AS priority, CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey + 1000000 AS clerk_id,
             o_totalprice AS price, o_orderdate,
             CASE WHEN o_orderkey % 4 = 0 THEN 'F' WHEN o_orderkey % 4 = 1 THEN 'P' ELSE 'O' END AS ship_state
      FROM orders WHERE o_totalprice >= 10000),
    a AS ({values(lefts, "orders")}), b AS ({values(rights, "later")}), kinds AS ({kinds}),
    na AS (SELECT c, COUNT(*) AS n FROM a GROUP BY c), nb AS (SELECT c, COUNT(*) AS n FROM b GROUP BY c),
    met AS (SELECT a.c AS l, b.c AS r, COUNT(*) AS shared, SUM(LEAST(a.share, b.share)) AS overlap
            FROM a JOIN b ON a.v = b.v GROUP BY a.c, b.c),
    pairs AS (SELECT l, r, LEAST(shared / (na.n + nb.n - shared), overlap) AS s
              FROM met JOIN na ON na.c = l JOIN nb ON nb.c = r),
    -- The data give no column two partners above the limit.
    good AS (SELECT * FROM pairs WHERE s >= 0.75)
    SELECT l AS left_column, k.t AS left_type, r AS right_column, m.t AS right_type, 'renamed' AS status, ROUND(s, 6) AS similarity
    FROM good JOIN kinds k ON k.c = l JOIN kinds m ON m.c = r
    UNION ALL SELECT na.c, t, NULL, NULL, 'only_left', NULL FROM na JOIN kinds USING (c) WHERE na.c NOT IN (SELECT l FROM good)
    UNION ALL SELECT NULL, NULL, nb.c, t, 'only_right', NULL FROM nb JOIN kinds USING (c) WHERE nb.c NOT IN (SELECT r FROM good)
    """


@query(_renames_sql())
def renamed_columns_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns of a reordered, shortened version are which; look-alikes stay alone."""
    orders = table(spark, sf_dir, "orders")
    found = mc.renamed_columns(orders, orders_renamed(orders))
    return found.withColumn("similarity", F.round("similarity", 6))


@query(
    """
    WITH replica AS (
      SELECT event_type, value + CASE event_id % 4 WHEN 0 THEN 0.004 WHEN 1 THEN -0.003 WHEN 2 THEN 0.25 ELSE 0 END AS value
      FROM events WHERE event_id % 11 <> 3),
    l AS (SELECT event_type, value, COUNT(*) AS n_copies FROM events GROUP BY ALL),
    r AS (SELECT event_type, value, COUNT(*) AS n_copies FROM replica GROUP BY ALL),
    lm AS (SELECT DISTINCT l.event_type, l.value FROM l JOIN r ON l.event_type = r.event_type
           AND r.value BETWEEN l.value - 0.011 AND l.value + 0.011 AND ABS(l.value - r.value) <= 0.01),
    rm AS (SELECT DISTINCT r.event_type, r.value FROM l JOIN r ON l.event_type = r.event_type
           AND r.value BETWEEN l.value - 0.011 AND l.value + 0.011 AND ABS(l.value - r.value) <= 0.01)
    SELECT 'only_left' AS side, l.* FROM l ANTI JOIN lm USING (event_type, value)
    UNION ALL SELECT 'only_right', r.* FROM r ANTI JOIN rm USING (event_type, value)
    """
)
def reconcile_events_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values that no value of the type in the replica is within 0.01 of."""
    events = table(spark, sf_dir, "events")
    shift = (
        F.when(F.col("event_id") % 4 == 0, F.lit(0.004)).when(F.col("event_id") % 4 == 1, F.lit(-0.003))
        .when(F.col("event_id") % 4 == 2, F.lit(0.25)).otherwise(F.lit(0.0))
    )
    replica = events.filter("event_id % 11 <> 3").select("event_type", (F.col("value") + shift).alias("value"))
    return mc.reconcile_within(events.select("event_type", "value"), replica, "value", 0.01)


HARD_CONTRACT = contract(
    ("o_orderkey", "order_id", "bigint", "false"),
    ("o_totalprice", "price", "decimal(7,1)", "false"),
    ("o_orderdate", "ordered_on", "date", "true"),
    ("o_orderpriority", "priority_code", "int", "true"),
    ("o_orderstatus", "status", "string", "false"),
)
# Sources of the load: prices of whole tens fit, a priority code is there where the key is even.
HARD_ORDERS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN FLOOR(o_totalprice) ELSE o_totalprice * 10 END AS o_totalprice, o_orderdate,
           CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE LEFT(o_orderpriority, 1) END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders
"""
HARD_REASONS_SQL = f"""
    SELECT o_orderkey AS order_id, CONCAT_WS(' ',
             CASE WHEN o_totalprice >= 999999.95 THEN 'lost:price' END,
             CASE WHEN o_totalprice < 999999.95 AND CAST(CAST(o_totalprice AS DECIMAL(18,1)) AS DOUBLE) <> o_totalprice THEN 'altered:price' END,
             CASE WHEN o_totalprice >= 999999.95 THEN 'null:price' END,
             CASE WHEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) <> o_orderdate THEN 'altered:ordered_on' END,
             CASE WHEN TRY_CAST(o_orderpriority AS INT) IS NULL THEN 'lost:priority_code' END,
             CASE WHEN o_orderstatus IS NULL THEN 'null:status' END) AS reasons
    FROM ({HARD_ORDERS_SQL})
"""


def _hard_load(spark: SparkSession, sf_dir: str) -> mc.RoutedLoad:
    key = F.col("o_orderkey")
    source = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice") * 10).alias("o_totalprice"),
        "o_orderdate",
        F.when(key % 5 == 0, F.col("o_orderpriority")).otherwise(F.left("o_orderpriority", F.lit(1))).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return mc.load_with_rejects(source, HARD_CONTRACT, scratch_path(spark, "routed"), exact=True)


@query(
    f"""
    WITH told AS ({HARD_REASONS_SQL})
    SELECT order_id, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS route, reasons FROM told
    """
)
def load_routes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the load, read from where it went, with its reasons."""
    done = _hard_load(spark, sf_dir)
    accepted = done.accepted.select("order_id", F.lit("accepted").alias("route"), F.lit("").alias("reasons"))
    rejected = done.rejected.select("order_id", F.lit("rejected").alias("route"), F.concat_ws(" ", "reasons").alias("reasons"))
    return accepted.unionAll(rejected)


@query(
    f"""
    WITH told AS ({HARD_REASONS_SQL})
    SELECT reason, COUNT(*) AS n_rows FROM (SELECT UNNEST(STRING_SPLIT(reasons, ' ')) AS reason FROM told WHERE reasons <> '')
    GROUP BY reason
    """
)
def load_reasons_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hard_load(spark, sf_dir).reasons()


SCALED_EVENTS_SQL = """
    SELECT CASE CAST(event_id % 4 AS INT) WHEN 0 THEN CAST(value AS DECIMAL(30,6)) WHEN 1 THEN CAST(value AS DECIMAL(30,6)) * 10
           WHEN 2 THEN CAST(value AS DECIMAL(30,6)) * 1000 ELSE CAST(CAST(value AS DECIMAL(30,2)) AS DECIMAL(30,6)) END AS x FROM events
"""


def digit_table_sql(column_name: str, x: str, source: str) -> str:
    t = f"RTRIM(RTRIM(CAST(ABS(CAST({x} AS DECIMAL(30,6))) AS VARCHAR), '0'), '.')"
    whole, fraction = f"SPLIT_PART({t}, '.', 1)", f"SPLIT_PART({t}, '.', 2)"
    # A whole number that ends in zeros must keep them, so digits before the point are counted by value.
    return (
        f"SELECT '{column_name}' AS column_name, CASE WHEN ABS({x}) < 1 THEN 0 ELSE "
        f"LENGTH(CAST(CAST(FLOOR(ABS({x})) AS BIGINT) AS VARCHAR)) END AS integer_digits, LENGTH({fraction}) AS scale, "
        f"COUNT(*) AS n_values FROM {source} WHERE {x} IS NOT NULL GROUP BY ALL"
    )


LINEITEM_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM_DIGITS_SQL = " UNION ALL ".join(digit_table_sql(x, x, "lineitem") for x in LINEITEM_NUMBERS)


@query(LINEITEM_DIGITS_SQL)
def digit_table_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mc.digit_table(table(spark, sf_dir, "lineitem"))


def scaled_events(events: DataFrame) -> DataFrame:
    """Values times powers of ten, by id."""
    value = F.col("value").cast("decimal(30,6)")
    turn = F.col("event_id") % 4
    scaled = F.when(turn == 0, value).when(turn == 1, value * 10).when(turn == 2, value * 1000).otherwise(F.round(value, 2))
    return events.select(scaled.cast("decimal(38,6)").alias("x"))


def smallest_decimals_sql(digits: str, lost: str, rounded: str) -> str:
    """Every type with the digits that occur, counted by brute force."""
    return f"""
    WITH d AS ({digits}), total AS (SELECT column_name, SUM(n_values) AS n FROM d GROUP BY ALL),
    i AS (SELECT DISTINCT column_name, integer_digits AS i FROM d UNION SELECT column_name, 0 FROM total),
    s AS (SELECT DISTINCT column_name, scale AS s FROM d UNION SELECT column_name, 0 FROM total),
    types AS (
      SELECT column_name, GREATEST(i + s, 1) AS p, s,
             COALESCE(SUM(n_values) FILTER (integer_digits > i), 0) AS n_lost,
             COALESCE(SUM(n_values) FILTER (integer_digits <= i AND scale > s), 0) AS n_rounded
      FROM i JOIN s USING (column_name) JOIN d USING (column_name) GROUP BY column_name, i, s)
    SELECT column_name, CAST(p AS INT) AS precision, CAST(s AS INT) AS scale, CAST(n AS BIGINT) AS n_values,
           CAST(n_lost AS BIGINT) AS n_lost, CAST(n_rounded AS BIGINT) AS n_rounded
    FROM types JOIN total USING (column_name) WHERE n_lost <= {lost} AND n_rounded <= {rounded}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY p, n_lost, n_rounded, s DESC) = 1
    """


@query(smallest_decimals_sql(LINEITEM_DIGITS_SQL, "25", "100"))
def smallest_decimals_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least types that lose 25 values and round 100 of a column at most."""
    return mc.smallest_decimals(mc.digit_table(table(spark, sf_dir, "lineitem")), max_lost=25, max_rounded=100)


@query(smallest_decimals_sql(digit_table_sql("x", "x", f"({SCALED_EVENTS_SQL})"), "50", "2000"))
def smallest_decimals_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values scaled by powers of ten: few large and few long ones must not decide."""
    return mc.smallest_decimals(mc.digit_table(scaled_events(table(spark, sf_dir, "events"))), max_lost=50, max_rounded=2000)


KEYLESS = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


# Lines of the replica by the last digit of the order: 0 changes one column, 1 two, 2 three, 3 is lost.
@query(
    """
    WITH l AS (SELECT *, CAST(l_orderkey % 10 AS INT) AS turn FROM lineitem WHERE l_orderkey % 10 < 4)
    SELECT CASE WHEN turn < 2 THEN 'changed' ELSE 'only_left' END AS status,
           CASE turn WHEN 0 THEN 'l_quantity' WHEN 1 THEN 'l_discount,l_tax' ELSE '' END AS changed,
           l_partkey AS partkey, l_extendedprice AS price, l_quantity AS left_quantity,
           CASE turn WHEN 0 THEN l_quantity + 1 WHEN 1 THEN l_quantity END AS right_quantity,
           l_tax AS left_tax, CASE turn WHEN 0 THEN l_tax WHEN 1 THEN l_tax + 0.25 END AS right_tax
    FROM l
    UNION ALL
    SELECT 'only_right', '', l_partkey, l_extendedprice, NULL, l_quantity + 1, NULL, l_tax + 0.25 FROM l WHERE turn = 2
    """
)
def paired_lineitem_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed lines and their partners, found without a key; the SQL makes each line's other version itself."""
    lines = table(spark, sf_dir, "lineitem")
    turn = F.col("l_orderkey") % 10
    replica = lines.filter(turn != 3).select(
        *[c for c in KEYLESS if c not in ("l_quantity", "l_discount", "l_tax")],
        F.when(turn.isin(0, 2), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(turn.isin(1, 2), F.col("l_discount") + 0.5).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(turn.isin(1, 2), F.col("l_tax") + 0.25).otherwise(F.col("l_tax")).alias("l_tax"),
    )
    found = mc.pair_changed_rows(lines.select(*KEYLESS), replica)
    return found.select(
        "status", F.coalesce(F.concat_ws(",", "changed"), F.lit("")).alias("changed"),
        F.coalesce("left.l_partkey", "right.l_partkey").alias("partkey"),
        F.coalesce("left.l_extendedprice", "right.l_extendedprice").alias("price"),
        F.col("left.l_quantity").alias("left_quantity"), F.col("right.l_quantity").alias("right_quantity"),
        F.col("left.l_tax").alias("left_tax"), F.col("right.l_tax").alias("right_tax"),
    )


def unique_keys_sql(source: str, columns: tuple[str, ...], most: int) -> str:
    """Distinct values of every set counted, then sets without a smaller key in them."""
    counted = " UNION ALL ".join(
        f"SELECT [{', '.join(repr(c) for c in names)}] AS k, (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(names)} FROM {source})) AS n"
        for size in range(1, most + 1) for names in combinations(columns, size)
    )
    return f"""
    WITH counted AS ({counted}), keys AS (SELECT k FROM counted WHERE n = (SELECT COUNT(*) FROM {source}))
    SELECT ARRAY_TO_STRING(k, ',') AS key, CAST(LEN(k) AS INT) AS n_columns, CAST(0 AS BIGINT) AS n_null_rows FROM keys a
    WHERE NOT EXISTS (SELECT 1 FROM keys b WHERE LEN(b.k) < LEN(a.k) AND LIST_HAS_ALL(a.k, b.k))
    """


LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _keys(df: DataFrame, columns: tuple[str, ...], most: int) -> DataFrame:
    found = mc.unique_keys(df, columns, most)
    return found.select(F.concat_ws(",", "key").alias("key"), "n_columns", "n_null_rows")


@query(unique_keys_sql("lineitem", LINEITEM_COLUMNS, 2))
def unique_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS, 2)


@query(unique_keys_sql("orders", ORDERS_COLUMNS, 3))
def unique_keys_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(table(spark, sf_dir, "orders"), ORDERS_COLUMNS, 3)


@query(
    """
    WITH new AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderpriority FROM orders
                 WHERE o_orderpriority <> '1-URGENT' AND o_orderkey % 9 <> 4),
    kept AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders)
    SELECT 'halfway' AS seen, * FROM kept
    UNION ALL SELECT 'complete', * FROM new
    UNION ALL SELECT 'complete', * FROM kept WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM new)
    UNION ALL SELECT 'version 1', * FROM kept
    """
)
def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see while a second load is halfway, when it is complete, and of the first version."""
    names = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*names)
    changed = orders.filter("o_orderpriority <> '1-URGENT' and o_orderkey % 9 <> 4")
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    target = scratch_path(spark, "published")
    mc.publish(orders, target, "o_orderpriority", "first", per_batch=2)
    mc.publish(changed, target, "o_orderpriority", "second", per_batch=1, max_batches=2)
    halfway = mc.read_published(spark, target, orders.schema)
    mc.publish(changed, target, "o_orderpriority", "second", per_batch=1)
    views = {"halfway": halfway, "complete": mc.read_published(spark, target, orders.schema)}
    views["version 1"] = mc.read_published(spark, target, orders.schema, version=1)
    labelled = [rows.select(F.lit(label).alias("seen"), *names) for label, rows in views.items()]
    return labelled[0].unionAll(labelled[1]).unionAll(labelled[2])
