"""Queries over the test tables, each with the SQL that checks it.

Every query is registered with ``@query``; ``sql`` is what any SQL engine
should return for the same tables. Where a model is trained, the query returns
what has to hold for any of them.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import evenkeel as ek
from evenkeel.sources.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return register


def entry(spark: SparkSession) -> DataFrame:
    """Does the share of good documents depend on their language?"""
    return q_demographic_parity(spark, "/root/testdata/sf0.001")


def _register(module: str, needs: tuple[str, ...] = ()) -> None:
    """Add the queries of a module that may have been left out of an
    installation, or what it ``needs``. Other missing modules are errors."""
    try:
        found = import_module(module)
    except ModuleNotFoundError as e:
        absent = (module, *needs)
        if not any(m == e.name or m.startswith(f"{e.name}.") for m in absent):
            raise
    else:
        _QUERIES.update(found.QUERIES)
        _SQL.update(found.SQL)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- bindings: the test tables as tables with a target and sensitive columns


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ek.read_parquet(spark, f"{sf}/{name}.parquet")


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents; a document is predicted good when it is long."""
    docs = _table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = docs.join(_table(spark, sf, "labels"), "doc_id")
    return rows.withColumn("long_doc", (F.col("n_chars") > 500).cast("int"))


DOCS = """docs AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END AS long_doc
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines; the target is whether a line was returned."""
    lines = _table(spark, sf, "lineitem")
    return lines.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))


LINES = """lines AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned FROM lineitem)"""


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders; the target is whether an order is filled."""
    return _table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("filled")
    )


ORDERS = """ords AS (
  SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS filled
  FROM orders)"""


def _orders_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Orders where pending ones have no outcome yet and an unspecified
    priority is a missing one."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return _table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(priority != "4-NOT SPECIFIED", priority).alias("priority"),
        F.when(status != "P", (status == "F").cast("int")).alias("filled"),
    )


GAPS = """gaps AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority,
         CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus <> 'P' THEN 0 END AS filled
  FROM orders)"""


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose balance is unknown when it is negative."""
    balance = F.col("c_acctbal")
    return _table(spark, sf, "customer").select(
        "c_custkey",
        F.when(balance >= 0, balance).alias("balance"),
        "c_mktsegment",
        "c_nationkey",
        (F.col("c_nationkey") < 12).cast("int").alias("near"),
    )


CUSTOMERS = """custs AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, c_mktsegment,
         c_nationkey, CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END AS near
  FROM customer)"""


def _order_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of orders and of large orders per region and market segment.

    Counts add up, so orders are counted per customer before the join: a
    customer that placed a third of all orders is one row in it.
    """
    orders = _table(spark, sf, "orders").select(
        "o_custkey", (F.col("o_totalprice") > 250000).cast("int").alias("large")
    )
    per_customer = ek.contingency(orders, ["o_custkey"], "large")
    customers = _table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    regions = _table(spark, sf, "nation").join(
        _table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    placed = customers.join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = per_customer.join(placed, F.col("o_custkey") == F.col("c_custkey"))
    return ek.recount(joined, ["r_name", "c_mktsegment"])


# --- sources and sinks


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Write customers as CSV, read them back with inferred types."""
    path = scratch_path(spark, "customer-csv")
    ek.write_table(_table(spark, sf, "customer"), path, "csv")
    return ek.read_csv(spark, path)


@query(
    "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders"
)
def q_csv_latin1_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Semicolons, Latin-1 and an explicit schema."""
    path = scratch_path(spark, "orders-csv")
    rows = _table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    ek.write_table(rows, path, "csv", sep=";", encoding="latin1")
    return ek.read_csv(spark, path, sep=";", encoding="latin1", schema=rows.schema)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "part")
    ek.write_table(_table(spark, sf, "part"), path)
    return ek.read_parquet(spark, path)


@query(
    "SELECT 'value' AS kind, 6 AS n_cells, 6 AS n_expected, count(*) AS n_lines FROM part"
)
def q_malformed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Parts read under a schema that takes the brand for a number."""
    path = scratch_path(spark, "part-csv")
    part = _table(spark, sf, "part")
    ek.write_table(part, path, "csv")
    wrong = T.StructType([
        T.StructField(f.name, T.IntegerType() if f.name == "p_brand" else f.dataType)
        for f in part.schema.fields
    ])
    bad = ek.malformed_rows(spark, path, wrong)
    return bad.groupBy("kind", "n_cells", "n_expected").agg(F.count(F.lit(1)).alias("n_lines"))


_LANDED = """CASE p_partkey % 7 WHEN 1 THEN 'short' WHEN 2 THEN 'long' WHEN 3 THEN 'value' END"""


@query(f"""WITH p AS (SELECT *, {_LANDED} AS kind FROM part)
SELECT 'row' AS what, p_partkey::BIGINT AS p_partkey, p_size::BIGINT AS p_size, CASE WHEN kind IN ('short', 'value') THEN NULL
  ELSE p_retailprice END AS price, NULL::INTEGER AS n_cells FROM p
UNION ALL SELECT kind, p_partkey, NULL, NULL, CASE kind WHEN 'short' THEN 2 WHEN 'long' THEN 4 ELSE 3 END FROM p
  WHERE kind IS NOT NULL
UNION ALL SELECT 'count ' || coalesce(kind, 'rows'), count(*), NULL, NULL, NULL FROM p WHERE kind IS NOT NULL
  GROUP BY kind
UNION ALL SELECT 'count rows', count(*), NULL, NULL, NULL FROM p""")
def q_land_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as lines that are too short, too long, or have 1d for a price: one
    parse gives the typed rows, the bad lines and the counts."""
    path = scratch_path(spark, "part-lines")
    number, size, price = [F.col(c).cast("string") for c in ("p_partkey", "p_size", "p_retailprice")]
    kind = F.expr(_LANDED)
    cells = F.when(kind == "short", F.array(number, size)).when(kind == "long", F.array(number, size, price, F.lit("more")))
    cells = cells.when(kind == "value", F.array(number, size, F.lit("1d"))).otherwise(F.array(number, size, price))
    lines = _table(spark, sf, "part").select(F.concat_ws(",", cells).alias("p_partkey,p_size,p_retailprice"))
    ek.write_table(lines, path, "csv", sep="\x01")  # no cell is quoted: the separator stands in none
    schema = T.StructType.fromDDL("p_partkey bigint, p_size bigint, p_retailprice double")
    landed = ek.land_csv(spark, path, scratch_path(spark, "landed"), schema=schema)
    empty = F.lit(None).cast("bigint")
    rows = landed.rows.select(
        F.lit("row").alias("what"), "p_partkey", "p_size", F.col("p_retailprice").alias("price"), F.lit(None).cast("int").alias("n_cells"))
    bad = landed.bad.select(
        "kind", F.substring_index("line", ",", 1).cast("bigint"), empty, F.lit(None).cast("double"), "n_cells")
    names = {"n_rows": "rows", "bad:short": "short", "bad:long": "long", "bad:unreadable": "value"}
    counts = spark.createDataFrame(
        [(f"count {names[k]}", n, None, None, None) for k, n in landed.counts.items() if k in names], rows.schema)
    return rows.union(bad).union(counts)


@query("""SELECT 'text' AS "column", count(*) AS n_rows,
  count(*) FILTER (regexp_matches(text, '[\u00A0-\u00FF]')) AS n_suspect FROM documents""")
def q_wrong_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written in Latin-1 and read as UTF-8."""
    path = scratch_path(spark, "latin1-texts")
    text = F.regexp_replace("text", r"[\s\\\"]+", " ")
    ek.write_table(_table(spark, sf, "documents").select("doc_id", text.alias("text")), path, "csv", encoding="latin1")
    return ek.encoding_suspects(ek.read_csv(spark, path, schema=T.StructType.fromDDL("doc_id bigint, text string")))


# --- validation and profiling


@query(f"""WITH {GAPS} SELECT * FROM (
  SELECT 'n_rows' AS name, count(*) AS n FROM gaps
  UNION ALL SELECT 'null:priority', count(*) - count(priority) FROM gaps
  UNION ALL SELECT 'not_binary:filled', count(*) FILTER (filled IS NULL) FROM gaps
  UNION ALL SELECT 'not_binary:o_orderkey', count(*) FILTER (o_orderkey NOT IN (0, 1)) FROM gaps
  UNION ALL SELECT 'suspect:priority', 0 FROM (SELECT 1)
  UNION ALL SELECT 'dropped', count(*) FILTER (priority IS NULL OR filled IS NULL) FROM gaps
  UNION ALL SELECT 'copied', count(*) FROM gaps)""")
def q_observed_copy(spark: SparkSession, sf: str) -> DataFrame:
    """All checks of a table, counted while it is written."""
    copy, counts = ek.observed_copy(
        _orders_with_gaps(spark, sf), present_in=["priority"], binary=["filled", "o_orderkey"],
        essential=["priority", "filled"], texts=None)
    told = spark.createDataFrame(list(counts.items()), "name string, n long")
    return told.unionByName(copy.select(F.lit("copied").alias("name")).groupBy("name").agg(F.count("*").alias("n")))


@query(f"""WITH {GAPS}
SELECT 'filled' AS "column", count(*) AS n_rows, count(*) FILTER (filled IS NULL) AS n_null,
       (count(*) FILTER (filled IS NULL))::DOUBLE / count(*) AS null_ratio, 0.1::DOUBLE AS threshold,
       (count(*) FILTER (filled IS NULL))::DOUBLE / count(*) <= 0.1 AS passed FROM gaps
UNION ALL
SELECT 'priority', count(*), count(*) FILTER (priority IS NULL),
       (count(*) FILTER (priority IS NULL))::DOUBLE / count(*), 0.1,
       (count(*) FILTER (priority IS NULL))::DOUBLE / count(*) <= 0.1 FROM gaps
UNION ALL
SELECT 'o_orderkey', count(*), 0, 0.0, 0.1, true FROM gaps""")
def q_null_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return ek.null_ratio(_orders_with_gaps(spark, sf), ["filled", "priority", "o_orderkey"])


@query("""SELECT 'text' AS "column", count(*) AS n_rows,
       count(*) FILTER (contains(text, chr(65533))) AS n_suspect FROM documents
UNION ALL SELECT 'lang', count(*), count(*) FILTER (contains(lang, chr(65533))) FROM documents
UNION ALL SELECT 'source', count(*), count(*) FILTER (contains(source, chr(65533))) FROM documents""")
def q_encoding_suspects(spark: SparkSession, sf: str) -> DataFrame:
    return ek.encoding_suspects(_table(spark, sf, "documents"))


_PART_TYPES = [
    ("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
    ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double"),
]


@query(" UNION ALL ".join(
    f"""SELECT count(*) AS n_rows, {i} AS position, '{name}' AS "column", count({name}) AS n_present,
        6 AS n_columns, '{kind}' AS type FROM part"""
    for i, (name, kind) in enumerate(_PART_TYPES, 1)
))
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    return ek.profile(_table(spark, sf, "part"))


@query("""SELECT "column", value, position FROM (
  SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) AS position FROM (
    SELECT DISTINCT 'p_brand' AS "column", p_brand AS value FROM part
    UNION ALL SELECT DISTINCT 'p_type', p_type FROM part
    UNION ALL SELECT DISTINCT 'p_size', p_size::VARCHAR FROM part))
WHERE position <= 10""")
def q_distinct_preview(spark: SparkSession, sf: str) -> DataFrame:
    return ek.distinct_preview(_table(spark, sf, "part"), ["p_brand", "p_type", "p_size"])


@query(f"""WITH {DOCS}
SELECT long_doc AS value, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM docs) AS share
FROM docs GROUP BY long_doc""")
def q_value_shares(spark: SparkSession, sf: str) -> DataFrame:
    return ek.value_shares(_docs(spark, sf), "long_doc")


@query(f"""WITH {GAPS}
SELECT 'filled' AS "column", count(*) AS n_rows, count(*) FILTER (filled IS NULL) AS n_violations FROM gaps
UNION ALL
SELECT 'priority', count(*), count(*) FROM gaps
UNION ALL
SELECT 'o_orderkey', count(*), count(*) FILTER (o_orderkey NOT IN (0, 1)) FROM gaps""")
def q_binary_violations(spark: SparkSession, sf: str) -> DataFrame:
    return ek.binary_violations(_orders_with_gaps(spark, sf), ["filled", "priority", "o_orderkey"])


@query(f"""WITH {GAPS}
SELECT count(*) AS n_groups,
       CASE WHEN count(*) < 2 THEN 'too_few' WHEN count(*) = 2 THEN 'ok' ELSE 'many' END AS verdict
FROM (SELECT DISTINCT priority, filled FROM gaps WHERE priority IS NOT NULL AND filled IS NOT NULL)""")
def q_group_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return ek.group_cardinality(_orders_with_gaps(spark, sf), ["priority", "filled"])


@query("""SELECT 'p_partkey' AS "column", true AS found, 'ok' AS severity, count(p_partkey) AS filled FROM part
UNION ALL SELECT 'p_brand', true, 'ok', count(p_brand) FROM part
UNION ALL SELECT 'p_weight', false, 'warning', 0""")
def q_expected_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Which columns are there, and how many of their cells are filled?"""
    part = _table(spark, sf, "part")
    listed = ek.check_expected_columns(part, ["p_brand", "p_weight"], ["p_partkey"])
    filled = part.agg(F.count("p_partkey").alias("p_partkey"), F.count("p_brand").alias("p_brand"))
    counts = filled.unpivot([], ["p_partkey", "p_brand"], "column", "filled")
    return listed.join(counts, "column", "left").fillna(0, ["filled"])


@query(f"""WITH {ORDERS}
SELECT o_orderkey::VARCHAR AS grp, avg(filled)::DOUBLE AS rate, (SELECT count(*) FROM ords) AS n_groups
FROM ords GROUP BY o_orderkey""")
def q_parity_report_many_groups(spark: SparkSession, sf: str) -> DataFrame:
    """A report lists all groups, however many."""
    report = ek.demographic_parity_report(_orders(spark, sf), ["o_orderkey"], "filled", groups_per_row=10_000)
    return report.select(F.explode("selection_rate_by_group").alias("grp", "rate"), "n_groups")


# --- cleaning


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS o_orderstatus
FROM orders""")
def q_recode(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return ek.recode(orders, "o_orderstatus", {"F": 1, "O": 2})


@query(f"""WITH {GAPS}
SELECT o_orderkey, priority, filled FROM gaps WHERE priority IS NOT NULL AND filled IS NOT NULL""")
def q_drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    return ek.drop_missing(_orders_with_gaps(spark, sf), ["priority", "filled"])


@query("""SELECT count(*) AS n_rows, count(l.quality) AS n_kept, count(*) - count(l.quality) AS n_dropped
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_missing_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label, as rows that would be dropped."""
    docs = _table(spark, sf, "documents").select("doc_id", "lang")
    return ek.missing_counts(docs.join(_table(spark, sf, "labels"), "doc_id", "left"), ["lang", "quality"])


@query("""SELECT c_custkey,
  TRY_CAST(CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE split_part(c_name, '#', 2) END AS DOUBLE) AS code
FROM customer""")
def q_to_numeric(spark: SparkSession, sf: str) -> DataFrame:
    code = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(
        F.substring_index("c_name", "#", -1)
    )
    rows = _table(spark, sf, "customer").select("c_custkey", code.alias("code"))
    return ek.to_numeric(rows, ["code"])


@query("SELECT event_id, trunc(value)::BIGINT AS value FROM events")
def q_to_label(spark: SparkSession, sf: str) -> DataFrame:
    return ek.to_label(_table(spark, sf, "events").select("event_id", "value"), ["value"])


@query("""SELECT c_custkey, c_mktsegment, c_nationkey,
  '["' || c_mktsegment || '","' || c_nationkey || '"]' AS c_mktsegment_c_nationkey FROM customer""")
def q_group_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return ek.group_key(rows, ["c_mktsegment", "c_nationkey"])


@query("""SELECT l_linestatus, discounted, count(*) AS n FROM (
  SELECT l_linestatus, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS discounted FROM lineitem)
GROUP BY l_linestatus, discounted""")
def q_binarize(spark: SparkSession, sf: str) -> DataFrame:
    rows = ek.binarize(_table(spark, sf, "lineitem"), "l_discount", "discounted", 0.05)
    return rows.groupBy("l_linestatus", "discounted").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_acctbal, c_name, c_mktsegment, c_nationkey FROM customer")
def q_assign_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Drop the key, infer the roles, order the columns by role."""
    rows = ek.drop_if_present(_table(spark, sf, "customer"), ["c_custkey", "not_there"])
    return ek.assign_roles(rows, ek.infer_roles(rows, "c_nationkey", ["c_mktsegment"]))


# --- feature transforms


@query(f"""WITH {CUSTOMERS}
SELECT c_custkey, round(coalesce(balance, (SELECT median(balance) FROM custs)), 6) AS balance FROM custs""")
def q_impute_median(spark: SparkSession, sf: str) -> DataFrame:
    rows = ek.impute_median(_customers(spark, sf).select("c_custkey", "balance"), ["balance"])
    return rows.withColumn("balance", F.round("balance", 6))


_SHADES = {f"shade{i}": (i % 8, i // 8) for i in range(16)}


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT 'shade{i}' AS "column", median(CASE WHEN l_linenumber % 7 <> {a % 7} THEN l_extendedprice + {a} * l_quantity
    + {b} * l_tax END) AS value FROM lineitem""" for i, (a, b) in enumerate(_SHADES.values())) + ")")
def q_medians_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of sixteen columns with gaps, each looked through by one task."""
    value = "CASE WHEN l_linenumber % 7 <> {} THEN l_extendedprice + {} * l_quantity + {} * l_tax END AS {}"
    rows = _table(spark, sf, "lineitem").selectExpr(*[value.format(a % 7, a, b, n) for n, (a, b) in _SHADES.items()])
    medians, _ = ek.exact_medians(rows, list(_SHADES))
    return spark.createDataFrame(list(medians.items()), "`column` string, value double")


@query("""SELECT event_id, round((value - s.m) / s.d, 6) AS value
FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events) s""")
def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    rows = ek.standardize(_table(spark, sf, "events").select("event_id", "value"), ["value"])
    return rows.withColumn("value", F.round("value", 6))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


@query(f"WITH {GAPS} SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN priority = '{p}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"priority_{p}\"" for p in _PRIORITIES
) + ", CASE WHEN priority IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS priority_nan FROM gaps")
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    return ek.one_hot(_orders_with_gaps(spark, sf).select("o_orderkey", "priority"), ["priority"])


@query("""SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS customer,
  (SELECT count(DISTINCT o_custkey) FROM orders) AS n_customers, 1.0::DOUBLE AS value FROM orders""")
def q_one_hot_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer is a category: one sparse vector per order, read back as
    the place of its 1."""
    rows = ek.one_hot(_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], "vector")
    parts = rows.withColumn("parts", ek.vector_parts(F.col("o_custkey_onehot")))
    return parts.select(
        "o_orderkey", F.col("parts.indices")[0].cast("bigint").alias("customer"),
        F.col("parts.size").cast("bigint").alias("n_customers"), F.col("parts.values")[0].alias("value"))


@query("""SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS o_custkey_index,
  dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_index,
  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""")
def q_category_index(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of customers and priorities from one dictionary, and how many
    orders each customer has in it."""
    rows = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    dictionary = ek.category_dictionary(rows, ["o_custkey", "o_orderpriority"])
    sizes = dictionary.table(spark).where(F.col("column") == "o_custkey").select(F.col("index").alias("o_custkey_index"), "n")
    indexed = ek.with_category_index(rows, dictionary).drop("o_custkey", "o_orderpriority")
    return indexed.join(sizes, "o_custkey_index")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"WITH {CUSTOMERS}, med AS (SELECT median(balance) AS m FROM custs) SELECT "
       "round(coalesce(balance, m), 6) AS balance, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END::DOUBLE AS c_mktsegment_{s}" for s in _SEGMENTS
) + ", c_custkey, c_nationkey, near FROM custs, med")
def q_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    roles = ek.ColumnRoles("near", ("c_nationkey",), ("balance",), ("c_mktsegment",))
    rows = _customers(spark, sf)
    encoded = ek.fit_preprocessor(rows, roles).transform(rows)
    return encoded.withColumn("balance", F.round("balance", 6))


# --- bias metrics


@query(f"""WITH {DOCS}
SELECT lang, count(*) AS n, count(*) FILTER (quality = 1) AS positives,
  count(*) FILTER (long_doc = 1) AS selected,
  count(*) FILTER (quality = 1 AND long_doc = 1) AS tp,
  count(*) FILTER (quality = 0 AND long_doc = 1) AS fp,
  count(*) FILTER (quality = 1 AND long_doc = 0) AS fn,
  count(*) FILTER (quality = 0 AND long_doc = 0) AS tn
FROM docs GROUP BY lang""")
def q_contingency(spark: SparkSession, sf: str) -> DataFrame:
    return ek.contingency(_docs(spark, sf), ["lang"], "quality", "long_doc")


@query(f"""WITH {DOCS}
SELECT lang, count(*) AS n, count(*) FILTER (quality = 1) AS positives,
  (count(*) FILTER (quality = 1))::DOUBLE / count(*) AS selection_rate FROM docs GROUP BY lang""")
def q_selection_rate(spark: SparkSession, sf: str) -> DataFrame:
    return ek.selection_rate_by_group(_docs(spark, sf), ["lang"], "quality")


@query(f"""WITH {LINES}
SELECT l_linestatus, l_linenumber, count(*) AS n, count(*) FILTER (returned = 1) AS positives,
  (count(*) FILTER (returned = 1))::DOUBLE / count(*) AS selection_rate
FROM lines GROUP BY ROLLUP (l_linestatus, l_linenumber)""")
def q_selection_rate_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return ek.selection_rate_rollup(_lines(spark, sf), ["l_linestatus", "l_linenumber"], "returned")


@query(f"""WITH {GAPS}
SELECT count(*) AS n, count(*) FILTER (filled = 1) AS positives,
  (count(*) FILTER (filled = 1))::DOUBLE / count(*) AS overall_selection_rate
FROM gaps WHERE priority IS NOT NULL AND filled IS NOT NULL""")
def q_overall_selection_rate(spark: SparkSession, sf: str) -> DataFrame:
    return ek.overall_selection_rate(_orders_with_gaps(spark, sf), ["priority"], "filled")


def _parity_sql(with_: str, table: str, group: str, target: str) -> str:
    return f"""WITH {with_}, kept AS (
  SELECT * FROM {table} WHERE {group} IS NOT NULL AND {target} IS NOT NULL),
g AS (SELECT {group}, count(*) AS n, count(*) FILTER ({target} = 1) AS p,
        (count(*) FILTER ({target} = 1))::DOUBLE / count(*) AS rate FROM kept GROUP BY {group}),
s AS (SELECT min({target}) = max({target}) AS same, avg({target})::DOUBLE AS mean FROM kept)
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_groups, any_value(same) AS target_is_constant,
  CASE WHEN any_value(same) THEN any_value(mean) ELSE sum(p)::DOUBLE / sum(n) END AS overall_selection_rate,
  CASE WHEN any_value(same) THEN 0.0 ELSE max(rate) - min(rate) END::DOUBLE AS demographic_parity_difference,
  0.1::DOUBLE AS bias_threshold_used,
  CASE WHEN NOT any_value(same) AND max(rate) - min(rate) > 0.1 THEN 'Warning' ELSE 'Passed' END
    AS bias_check_status
FROM g, s"""


@query(_parity_sql(DOCS, "docs", "lang", "quality"))
def q_demographic_parity(spark: SparkSession, sf: str) -> DataFrame:
    return ek.demographic_parity(_docs(spark, sf), ["lang"], "quality")


@query(_parity_sql(GAPS, "gaps", "priority", "filled"))
def q_demographic_parity_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a target or a group do not count."""
    return ek.demographic_parity(_orders_with_gaps(spark, sf), ["priority"], "filled")


@query("""SELECT r_name, c_mktsegment, count(*) AS n, count(*) FILTER (o_totalprice > 250000) AS positives,
  (count(*) FILTER (o_totalprice > 250000))::DOUBLE / count(*) AS selection_rate
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, c_mktsegment""")
def q_dp_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Selection rates over the combination of two sensitive columns."""
    counts = _order_regions(spark, sf)
    return counts.withColumn("selection_rate", F.col("positives") / F.col("n"))


@query(f"""WITH {LINES}, g AS (
  SELECT l_linestatus, l_linenumber, (count(*) FILTER (returned = 1))::DOUBLE / count(*) AS rate
  FROM lines GROUP BY l_linestatus, l_linenumber)
SELECT '["' || l_linestatus || '","' || l_linenumber || '"]' AS grp, rate AS selection_rate,
  (SELECT count(*) FILTER (returned = 1)::DOUBLE / count(*) FROM lines) AS overall_selection_rate,
  (SELECT max(rate) - min(rate) FROM g) AS demographic_parity_difference,
  CASE WHEN (SELECT max(rate) - min(rate) FROM g) > 0.005 THEN 'Warning' ELSE 'Passed' END AS bias_check_status,
  'returned' AS target_column, 'Demographic Parity' AS check_type FROM g""")
def q_parity_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report document over two sensitive columns, one row per group."""
    report = ek.demographic_parity_report(
        _lines(spark, sf), ["l_linestatus", "l_linenumber"], "returned", threshold=0.005
    )
    return report.select(
        F.explode("selection_rate_by_group").alias("grp", "selection_rate"), "overall_selection_rate",
        "demographic_parity_difference", "bias_check_status", "target_column", "check_type",
    )


@query("""SELECT event_type, round(avg(value), 6) AS positive_rate, count(value) AS count
FROM events GROUP BY event_type""")
def q_positive_rate(spark: SparkSession, sf: str) -> DataFrame:
    rates = ek.positive_rate_by_group(_table(spark, sf, "events"), ["event_type"], "value")
    return rates.withColumn("positive_rate", F.round("positive_rate", 6))


def _impact_sql(with_: str, table: str, group: str, target: str) -> str:
    """Group keys must be there; targets may be missing."""
    return f"""WITH {with_}, g AS (
  SELECT {group}, sum({target})::DOUBLE / nullif(count({target}), 0) AS rate FROM {table}
  WHERE {group.replace(', ', ' IS NOT NULL AND ')} IS NOT NULL GROUP BY {group}),
s AS (SELECT count(*) AS n_groups, count(rate) AS n_valid, min(rate) AS lo, max(rate) AS hi FROM g)
SELECT n_groups, n_valid, lo AS min_positive_rate, hi AS max_positive_rate,
  CASE WHEN n_valid = 1 THEN 1.0 WHEN n_valid >= 2 AND hi > 0 THEN lo / hi
       WHEN n_valid >= 2 AND lo = 0 THEN 1.0 END::DOUBLE AS disparate_impact_min_max_ratio,
  CASE WHEN n_valid = 0 THEN 'Skipped (No valid rates)' WHEN n_valid = 1 THEN 'Skipped (Only one group)'
       WHEN hi > 0 AND lo / hi < 0.8 THEN 'Warning: Potential Adverse Impact Detected'
       WHEN hi > 0 THEN 'Passed' WHEN lo = 0 THEN 'Passed (All rates zero)'
       ELSE 'Error (Max rate zero, Min rate non-zero)' END AS bias_check_status,
  0.8::DOUBLE AS disparate_impact_threshold FROM s"""


@query(_impact_sql(LINES, "lines", "l_linestatus", "returned"))
def q_disparate_impact(spark: SparkSession, sf: str) -> DataFrame:
    return ek.disparate_impact(_lines(spark, sf), ["l_linestatus"], "returned")


@query(_impact_sql(GAPS, "gaps", "priority", "filled"))
def q_disparate_impact_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return ek.disparate_impact(_orders_with_gaps(spark, sf), ["priority"], "filled")


@query(f"""WITH {DOCS}, g AS (
  SELECT lang, source, sum(quality)::DOUBLE / count(quality) AS rate, count(quality) AS n
  FROM docs GROUP BY lang, source)
SELECT lang, source, rate AS positive_rate, n AS count,
  (SELECT min(rate) FROM g) AS min_positive_rate, (SELECT max(rate) FROM g) AS max_positive_rate,
  CASE WHEN (SELECT max(rate) FROM g) > 0 THEN (SELECT min(rate) / max(rate) FROM g) ELSE 1.0 END::DOUBLE
    AS disparate_impact_min_max_ratio FROM g""")
def q_impact_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report document, one row per listed group."""
    report = ek.disparate_impact_report(_docs(spark, sf), ["lang", "source"], "quality")
    return report.select(
        F.explode("group_statistics").alias("g"), "min_positive_rate", "max_positive_rate",
        "disparate_impact_min_max_ratio",
    ).select("g.*", "min_positive_rate", "max_positive_rate", "disparate_impact_min_max_ratio")


@query(f"""WITH {DOCS}, g AS (
  SELECT lang, sum(quality)::DOUBLE / count(quality) AS rate, count(quality) AS n FROM docs GROUP BY lang)
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_groups, max(rate) - min(rate) AS positive_rate_difference,
  CASE WHEN max(rate) - min(rate) > 0.1 THEN 'Warning' ELSE 'Passed' END AS bias_check_status FROM g""")
def q_positive_rate_difference(spark: SparkSession, sf: str) -> DataFrame:
    return ek.positive_rate_difference(_docs(spark, sf), ["lang"], "quality")


def _odds_rates(zero: str = "0.0") -> str:
    return f"""count(*)::DOUBLE AS count,
  (count(*) FILTER (p = 1))::DOUBLE / count(*) AS selection_rate,
  coalesce((count(*) FILTER (y = 1 AND p = 1))::DOUBLE / nullif(count(*) FILTER (y = 1), 0), {zero})
    AS true_positive_rate,
  coalesce((count(*) FILTER (y = 0 AND p = 1))::DOUBLE / nullif(count(*) FILTER (y = 0), 0), {zero})
    AS false_positive_rate"""


_SCORED = f"{DOCS}, scored AS (SELECT *, quality AS y, long_doc AS p FROM docs)"


@query(f"WITH {_SCORED} SELECT lang, {_odds_rates()} FROM scored GROUP BY lang")
def q_classification_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return ek.classification_by_group(_docs(spark, sf), ["lang"], "quality", "long_doc")


@query(f"WITH {_SCORED} SELECT {_odds_rates()} FROM scored")
def q_classification_overall(spark: SparkSession, sf: str) -> DataFrame:
    return ek.classification_overall(_docs(spark, sf), ["lang"], "quality", "long_doc")


@query(f"""WITH {_SCORED}, g AS (SELECT source, {_odds_rates()} FROM scored GROUP BY source)
SELECT max(count) - min(count) AS count, max(selection_rate) - min(selection_rate) AS selection_rate,
  max(true_positive_rate) - min(true_positive_rate) AS true_positive_rate,
  max(false_positive_rate) - min(false_positive_rate) AS false_positive_rate FROM g""")
def q_metric_differences(spark: SparkSession, sf: str) -> DataFrame:
    return ek.between_group_difference(_docs(spark, sf), ["source"], "quality", "long_doc")


@query(f"""WITH {_SCORED}, g AS (SELECT lang, {_odds_rates()} FROM scored GROUP BY lang),
o AS (SELECT {_odds_rates()} FROM scored),
d AS (SELECT count(*) AS n_groups, max(count) - min(count) AS dc,
  max(selection_rate) - min(selection_rate) AS ds,
  max(true_positive_rate) - min(true_positive_rate) AS dt,
  max(false_positive_rate) - min(false_positive_rate) AS df FROM g)
SELECT n_groups, count::BIGINT AS n_rows, NULL::VARCHAR AS error_message, count, selection_rate,
  true_positive_rate, false_positive_rate, dc AS count_difference, ds AS selection_rate_difference,
  dt AS true_positive_rate_difference, df AS false_positive_rate_difference,
  greatest(dt, df) AS equalized_odds_difference,
  CASE WHEN greatest(dt, df) > 0.05
    THEN printf('Warning: Equalized Odds Difference (%.4f) > threshold (0.05)', greatest(dt, df))
    ELSE 'Passed (Equalized Odds disparity within threshold)' END AS bias_check_status
FROM o, d""")
def q_equalized_odds(spark: SparkSession, sf: str) -> DataFrame:
    return ek.equalized_odds(_docs(spark, sf), ["lang"], "quality", "long_doc")


@query(f"""WITH {_SCORED}, g AS (SELECT lang, {_odds_rates()} FROM scored GROUP BY lang),
o AS (SELECT {_odds_rates()} FROM scored)
SELECT g.lang, g.count, g.selection_rate, g.true_positive_rate, g.false_positive_rate,
  (SELECT greatest(max(true_positive_rate) - min(true_positive_rate),
     max(false_positive_rate) - min(false_positive_rate)) FROM g) AS equalized_odds_difference,
  o.true_positive_rate AS overall_true_positive_rate, 'long_doc' AS prediction_column FROM g, o""")
def q_odds_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report document, one row per listed group."""
    report = ek.equalized_odds_report(_docs(spark, sf), ["lang"], "quality", "long_doc")
    return report.select(
        F.explode("metrics_by_group").alias("g"),
        F.col("overall_metrics.equalized_odds_difference").alias("equalized_odds_difference"),
        F.col("overall_metrics.true_positive_rate").alias("overall_true_positive_rate"),
        "prediction_column",
    ).select("g.*", "equalized_odds_difference", "overall_true_positive_rate", "prediction_column")


@query(f"""WITH {LINES}
SELECT l_linestatus, count(*) AS n, count(*) FILTER (returned = 1) AS positives,
  (count(*) FILTER (returned = 1))::DOUBLE / count(*) AS rate FROM lines GROUP BY l_linestatus""")
def q_group_rates(spark: SparkSession, sf: str) -> DataFrame:
    return ek.group_rates(_lines(spark, sf), ["l_linestatus"], "returned")


# --- mitigation and sampling


def _plan_sql(table: str, group: str, target: str) -> str:
    """CTEs: rates per group, and how many positives each one lacks."""
    return f"""rates AS (
  SELECT {group} AS grp, count(*) AS n, count(*) FILTER ({target} = 1) AS positives,
    (count(*) FILTER ({target} = 1))::DOUBLE / count(*) AS rate FROM {table} GROUP BY {group}),
best AS (SELECT max(rate) AS r FROM rates),
plan AS (
  SELECT grp, n, positives, rate, r AS target_rate, r - rate >= 1e-6 AS disadvantaged,
    CASE WHEN r - rate >= 1e-6 AND 1.0::DOUBLE - r >= 1e-9 AND r * n - positives > 0
      THEN round_even((r * n - positives) / (1.0::DOUBLE - r), 0) ELSE 0 END::BIGINT AS n_to_add
  FROM rates, best)"""


@query(f"""WITH {LINES}, {_plan_sql("lines", "l_linestatus", "returned")}
SELECT grp AS l_linestatus, n, positives, rate, target_rate, disadvantaged, n_to_add FROM plan""")
def q_oversample_plan(spark: SparkSession, sf: str) -> DataFrame:
    return ek.oversample_plan(_lines(spark, sf), ["l_linestatus"], "returned")


@query(f"""WITH {ORDERS}, {_plan_sql("ords", "o_orderpriority", "filled")}
SELECT grp AS o_orderpriority, n, positives, rate, target_rate, disadvantaged, n_to_add FROM plan""")
def q_oversample_plan_groups(spark: SparkSession, sf: str) -> DataFrame:
    """More than two groups: each is raised to the highest rate."""
    return ek.oversample_plan(_orders(spark, sf), ["o_orderpriority"], "filled")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rank
FROM orders""")
def q_exact_rank(spark: SparkSession, sf: str) -> DataFrame:
    return ek.exact_rank(_table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query("""SELECT o_orderpriority, o_orderkey,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:' || o_orderkey), o_orderkey) AS rank
FROM orders""")
def q_exact_rank_by_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return ek.exact_rank(rows, ["o_orderkey"], seed=7, by=["o_orderpriority"])


def _split_sql(table: str, key: str, hashed: str) -> str:
    """CTE: each row of ``table`` with its split."""
    return f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || {hashed}), {key}) AS rk FROM {table}),
held AS (SELECT count(*) AS n, ceil(count(*) * 0.3::DOUBLE)::BIGINT AS h FROM {table}),
sizes AS (SELECT n - h AS train, h - ceil(h * 0.5::DOUBLE)::BIGINT AS val FROM held),
parts AS (
  SELECT ranked.*, CASE WHEN rk <= train THEN 'train' WHEN rk <= train + val THEN 'val' ELSE 'test' END AS split
  FROM ranked, sizes)"""


@query(f"""WITH {_split_sql("orders", "o_orderkey", "o_orderkey")}
SELECT o_orderkey, o_custkey, split FROM parts""")
def q_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return ek.split_labels(rows, ["o_orderkey"])


_COPIED = """copied AS (
  SELECT l_linestatus, l_returnflag, l_linenumber,
    row_number() OVER (PARTITION BY l_linestatus, l_returnflag, l_linenumber) AS c FROM lineitem)"""


@query(f"""WITH {_COPIED}, {_split_sql(
    "copied", "c",
    "'1:' || l_linestatus || '1:' || l_returnflag || length(l_linenumber::VARCHAR) || ':' || l_linenumber"
    " || length(c::VARCHAR) || ':' || c")}
SELECT l_linestatus, l_returnflag, l_linenumber, split, count(*) AS n FROM parts
GROUP BY l_linestatus, l_returnflag, l_linenumber, split""")
def q_split_without_key(spark: SparkSession, sf: str) -> DataFrame:
    """Many equal rows and no key: copies are numbered, then split."""
    rows = _table(spark, sf, "lineitem").select("l_linestatus", "l_returnflag", "l_linenumber")
    return ek.split_labels(rows).groupBy("l_linestatus", "l_returnflag", "l_linenumber", "split").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""SELECT l_linestatus, l_returnflag, l_linenumber, copy_no, count(*) AS n FROM (
  SELECT l_linestatus, l_returnflag, l_linenumber,
    row_number() OVER (PARTITION BY l_linestatus, l_returnflag, l_linenumber) AS copy_no FROM lineitem)
GROUP BY ALL""")
def q_copy_numbers(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "lineitem").select("l_linestatus", "l_returnflag", "l_linenumber")
    return ek.with_copy_numbers(rows).groupBy("l_linestatus", "l_returnflag", "l_linenumber", "copy_no").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""SELECT l_orderkey, l_linenumber, l_quantity, copy_no FROM (
  SELECT *, row_number() OVER (PARTITION BY t) AS copy_no FROM (
    SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R') AS t)""")
def q_copy_numbers_whole_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All columns: most rows stay where they lie, returned ones come twice."""
    rows = _table(spark, sf, "lineitem")
    twice = rows.unionByName(rows.filter("l_returnflag = 'R'"))
    return ek.with_copy_numbers(twice).select("l_orderkey", "l_linenumber", "l_quantity", "copy_no")


@query("""SELECT o_orderkey, o_totalprice FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rk
  FROM orders) WHERE rk <= 5000""")
def q_cap_rows(spark: SparkSession, sf: str) -> DataFrame:
    """At most 5,000 random orders (the cap of the training split)."""
    rows = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ek.cap_rows(rows, 5000, ["o_orderkey"])


@query("SELECT o_orderkey, o_orderpriority, filled FROM (SELECT o_orderkey, o_orderpriority, "
       "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS filled FROM orders)")
def q_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """All orders in random order (the comparison ignores the order)."""
    return ek.shuffle(_orders(spark, sf), ["o_orderkey"])


@query("""WITH pool AS (
  SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY md5('42:' || c_custkey), c_custkey) AS rk
  FROM customer),
k AS (SELECT count(*) AS k FROM customer),
draws AS (
  SELECT 1 + ('0x' || substr(md5('42:' || i), 1, 15))::BIGINT % k AS rk
  FROM range(1, 2501) t(i), k)
SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_custkey) AS draw_no
FROM draws JOIN pool USING (rk)""")
def q_bootstrap_draw(spark: SparkSession, sf: str) -> DataFrame:
    """2,500 draws from all customers."""
    rows = _table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return ek.draw_with_replacement(rows, 2500, ["c_custkey"])


_OVERSAMPLED = f"""{ORDERS}, {_plan_sql("ords", "o_orderpriority", "filled")},
pool AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rk
  FROM ords WHERE filled = 1),
draws AS (
  SELECT grp, 1 + ('0x' || substr(md5('42:' || grp || ':' || i), 1, 15))::BIGINT % positives AS rk
  FROM (SELECT grp, positives, unnest(range(1, n_to_add + 1)) AS i FROM plan WHERE n_to_add > 0)),
sampled AS (
  SELECT o_orderkey, o_orderpriority, filled, 0::BIGINT AS draw_no FROM ords
  UNION ALL
  SELECT o_orderkey, o_orderpriority, filled, row_number() OVER (PARTITION BY o_orderkey) AS draw_no
  FROM draws d JOIN pool p ON d.grp = p.o_orderpriority AND d.rk = p.rk)"""


@query(f"WITH {_OVERSAMPLED} SELECT o_orderkey, o_orderpriority, filled, draw_no FROM sampled")
def q_oversample(spark: SparkSession, sf: str) -> DataFrame:
    return ek.oversample(_orders(spark, sf), ["o_orderpriority"], "filled", ["o_orderkey"])


# --- model


@query(f"""WITH {DOCS}, {_split_sql("docs", "doc_id", "doc_id")}
SELECT doc_id, quality, true AS label_follows_score, true AS score_in_range, true AS better_than_mean
FROM parts WHERE split = 'test'""")
def q_train_predict(spark: SparkSession, sf: str) -> DataFrame:
    """A forest trained on one part of the documents scores another.

    Scores of a forest are means of training targets, labels follow from them,
    and the forest is closer to its training rows than their mean is.
    """
    splits = ek.train_val_test_split(_docs(spark, sf), ["doc_id"])
    model = ek.train_regressor(splits.train, "quality", exclude=["doc_id", "long_doc"])
    scored, score = ek.predict(model, splits.test, "good"), F.col("good_regression")
    error = F.avg(F.pow(F.col("quality") - score, 2))
    seen = ek.predict(model, splits.train, "good").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high"), error.alias("error"),
        F.var_pop("quality").alias("variance")).first()
    return scored.select(
        "doc_id", "quality", (F.col("good") == (score > 0.5).cast("int")).alias("label_follows_score"),
        score.between(seen["low"] - 1e-9, seen["high"] + 1e-9).alias("score_in_range"),
        F.lit(seen["error"] < seen["variance"]).alias("better_than_mean"))


# --- whole audits

_DOCS_SPEC = ek.DatasetSpec(
    target="quality",
    sensitive=("lang",),
    roles=ek.ColumnRoles("quality", ("lang",), ("n_chars", "toxic"), ("source",)),
    drop=("long_doc",),
    key=("doc_id",),
)


@query(f"""WITH {DOCS}, {_split_sql("docs", "doc_id", "doc_id")},
g AS (SELECT lang, (count(*) FILTER (quality = 1))::DOUBLE / count(*) AS rate FROM docs GROUP BY lang)
SELECT split, count(*) AS n, count(*) FILTER (quality = 1) AS positives,
  (SELECT max(rate) - min(rate) FROM g) AS demographic_parity_difference,
  CASE WHEN (SELECT max(rate) - min(rate) FROM g) > 0.1 THEN 'Warning' ELSE 'Passed' END AS bias_check_status
FROM parts GROUP BY split""")
def q_parity_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Validate, encode, check and split the labelled documents."""
    result = ek.parity_flow(_docs(spark, sf), _DOCS_SPEC)
    parts = None
    for name, frame in result.splits.items():
        part = frame.select(F.lit(name).alias("split"), "quality")
        parts = part if parts is None else parts.unionByName(part)
    verdict = result.report.select("demographic_parity_difference", "bias_check_status").first()
    return parts.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("positives")
    ).select(
        "*", *[F.lit(verdict[c]).alias(c) for c in ("demographic_parity_difference", "bias_check_status")]
    )


@query(f"""WITH {_OVERSAMPLED}, after_ AS (
  SELECT o_orderpriority AS grp, (count(*) FILTER (filled = 1))::DOUBLE / count(*) AS rate
  FROM sampled GROUP BY o_orderpriority),
{_split_sql("sampled", "o_orderkey, draw_no",
            "length(o_orderkey::VARCHAR) || ':' || o_orderkey || length(draw_no::VARCHAR) || ':' || draw_no")},
in_parts AS (
  SELECT o_orderpriority AS grp, count(*) FILTER (split = 'train') AS n_train,
    count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split = 'test') AS n_test
  FROM parts GROUP BY o_orderpriority)
SELECT r.grp, r.rate AS rate_before, a.rate AS rate_after, n_train, n_val, n_test,
  CASE WHEN (SELECT max(rate) - min(rate) FROM rates) > 0.0001 THEN 'Warning' ELSE 'Passed' END AS status_before
FROM rates r JOIN after_ a ON r.grp = a.grp JOIN in_parts s ON r.grp = s.grp""")
def q_mitigation_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Check orders, rebalance them, check again, split."""
    spec = ek.DatasetSpec(
        target="filled", sensitive=("o_orderpriority",), key=("o_orderkey",), dp_threshold=0.0001
    )
    result = ek.mitigation_flow(_orders(spark, sf), spec)
    before = result.report.select(
        F.explode("selection_rate_by_group").alias("grp", "rate_before"),
        F.col("bias_check_status").alias("status_before"),
    )
    after = result.final_report.select(F.explode("selection_rate_by_group").alias("grp", "rate_after"))
    parts = None
    for name, frame in result.splits.items():
        part = frame.select(F.lit(name).alias("split"), F.col("o_orderpriority").alias("grp"))
        parts = part if parts is None else parts.unionByName(part)
    sizes = parts.groupBy("grp").agg(
        *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")]
    )
    return before.join(after, "grp").join(sizes, "grp")


@query(f"""WITH {DOCS}, {_split_sql("docs", "doc_id", "doc_id")}
SELECT lang, count(*) AS n, count(*) FILTER (quality = 1) AS positives, true AS rates_hold, true AS spread_holds
FROM parts WHERE split = 'test' GROUP BY lang""")
def q_odds_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Train on documents, score the test part, check equalized odds; what is
    reported has to hold for the predictions."""
    result = ek.odds_flow(_docs(spark, sf), _DOCS_SPEC)
    good, called = F.col("quality") == 1, F.col("pred_col") == 1

    def share(part, whole):
        return F.coalesce(F.count_if(part & whole) / F.nullif(F.count_if(whole), F.lit(0)), F.lit(0.0))

    names = ("selection_rate", "true_positive_rate", "false_positive_rate")
    shares = (F.count_if(called) / F.count(F.lit(1)), share(called, good), share(called, ~good))
    recount = result.predictions.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(good).alias("positives"),
        *[s.alias(n) for n, s in zip(names, shares, strict=True)])
    spread = recount.agg(F.greatest(*[F.max(n) - F.min(n) for n in names[1:]]).alias("spread")).scalar()
    report = result.report.select(
        F.explode("metrics_by_group").alias("g"),
        F.col("overall_metrics.equalized_odds_difference").alias("reported"))
    near = [F.abs(F.col(n) - F.col(f"g.{n}")) < 1e-12 for n in names]
    return recount.withColumn("spread", spread).join(report, F.col("lang") == F.col("g.lang")).select(
        "lang", "n", "positives", ((F.col("n") == F.col("g.count")) & near[0] & near[1] & near[2]).alias("rates_hold"),
        (F.abs(F.col("spread") - F.col("reported")) < 1e-12).alias("spread_holds"))


# --- sinks of reports and splits


@query(f"""WITH {DOCS}, g AS (SELECT lang AS grp, sum(quality)::DOUBLE / count(quality) AS rate FROM docs GROUP BY lang)
SELECT grp, rate, (SELECT max(rate) - min(rate) FROM g) AS demographic_parity_difference,
  CASE WHEN (SELECT max(rate) - min(rate) FROM g) > 0.1 THEN 'Warning' ELSE 'Passed' END AS bias_check_status
FROM g""")
def q_write_report(spark: SparkSession, sf: str) -> DataFrame:
    """A parity report written as JSON and read back."""
    path = scratch_path(spark, "report")
    report = ek.demographic_parity_report(_docs(spark, sf), ["lang"], "quality")
    ek.write_report(report, path)
    return spark.read.schema(report.schema).json(path).select(
        F.explode("selection_rate_by_group").alias("grp", "rate"), "demographic_parity_difference", "bias_check_status")


@query(f"""WITH {_split_sql("orders", "o_orderkey", "o_orderkey")}
SELECT o_orderkey, o_custkey, o_totalprice, split FROM parts""")
def q_write_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders split, each part written to a folder of its own and read back."""
    path = scratch_path(spark, "splits")
    rows = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    splits = ek.train_val_test_split(rows, ["o_orderkey"])
    names = ek.write_splits(dict(splits.items()), {n: f"{path}/{n}" for n, _ in splits.items()})
    parts = [ek.read_parquet(spark, f"{path}/{n}").withColumn("split", F.lit(n)) for n in names]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query(f"""WITH {_split_sql("orders", "o_orderkey", "o_orderkey")}
SELECT o_orderkey, o_custkey, o_totalprice, split, (SELECT count(DISTINCT split) FROM parts) AS n_written FROM parts""")
def q_write_splits_once(spark: SparkSession, sf: str) -> DataFrame:
    """All parts written in one pass over the orders."""
    path = scratch_path(spark, "splits")
    rows = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    names = ek.write_splits(ek.train_val_test_split(rows, ["o_orderkey"]), path)
    return ek.read_parquet(spark, path).withColumn("n_written", F.lit(len(names)).cast("bigint"))


@query("""WITH g AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS positives,
    (count(*) FILTER (o_orderstatus = 'F'))::DOUBLE / count(*) AS selection_rate FROM orders GROUP BY o_custkey)
SELECT *, row_number() OVER (ORDER BY o_custkey) AS place, (SELECT count(*) FROM g) AS n_groups,
  (SELECT max(selection_rate) - min(selection_rate) FROM g) AS demographic_parity_difference FROM g""")
def q_write_group_report(spark: SparkSession, sf: str) -> DataFrame:
    """A report on every customer, written as ordered lines and read back in
    the order of the files."""
    path = scratch_path(spark, "group-report")
    rows = _table(spark, sf, "orders").select("o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("filled"))
    report = ek.group_report(rows, "parity", ["o_custkey"], "filled")
    ek.write_report(report, path)
    groups = spark.read.schema(report.groups.schema).json(f"{path}/groups")
    order = Window.orderBy(F.input_file_name(), F.monotonically_increasing_id())
    summary = spark.read.schema(report.summary.schema).json(f"{path}/summary")
    placed = groups.withColumn("place", F.row_number().over(order).cast("bigint"))
    return placed.crossJoin(F.broadcast(summary.select("n_groups", "demographic_parity_difference")))


_register("evenkeel.llm.queries")
_register("corpus_pipeline", needs=("evenkeel.llm",))
