"""Record tables derived from the generated tables by integer arithmetic, so that any engine gets the same rows.

`SQL` holds the same definitions for an oracle, as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.operators.lineage import parts_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_EDGES = """
  SELECT concat('r', r_regionkey) AS child, 'root' AS parent, 'admin' AS relation FROM region
  UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), 'admin' FROM nation
  UNION ALL SELECT concat('s', s_suppkey), concat('n', s_nationkey), 'admin' FROM supplier
  UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey), 'admin' FROM customer
  UNION ALL SELECT concat('c', c_custkey), concat('seg-', lower(c_mktsegment)), 'feudal' FROM customer
  UNION ALL SELECT DISTINCT concat('seg-', lower(c_mktsegment)), concat('r', ascii(c_mktsegment) % 5), 'ressort' FROM customer
"""
_POINTS = """
  SELECT concat('s', s_suppkey) AS id, 47.8 + (s_suppkey * 7919 % 2200) / 1000.0 AS lat, 5.3 + (s_suppkey * 104729 % 2500) / 1000.0 AS lon, s_nationkey AS nation FROM supplier
  UNION ALL SELECT concat('c', c_custkey), 47.8 + (c_custkey * 7919 % 2200 + 1) / 1000.0, 5.3 + (c_custkey * 104729 % 2500 + 1) / 1000.0, c_nationkey FROM customer
"""
_ENTRIES = """
  SELECT o_orderkey AS no, concat('c', o_custkey) AS place, concat('n', c_nationkey) AS district,
    concat('seg-', lower(c_mktsegment)) AS realm,
    CASE o_orderstatus WHEN 'F' THEN 'domain' WHEN 'O' THEN 'fief' ELSE 'clergy' END AS section,
    o_orderpriority AS series, concat('text of order ', o_orderpriority, ' for ', c_name) AS text,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_name END AS name, o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey
"""
_HOLDINGS = """
  SELECT DISTINCT concat('c', o_custkey) AS place, CASE l_returnflag WHEN 'A' THEN 'domain' WHEN 'N' THEN 'fief' ELSE 'clergy' END AS tenure,
    concat('h', l_suppkey % 50) AS holder, 1 AS num, 2 + l_linenumber AS den, o_orderkey AS via
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
VIEWS = {"edges": _EDGES, "points": _POINTS, "entries": _ENTRIES, "holdings": _HOLDINGS}
SQL = "WITH RECURSIVE " + ", ".join(f"{k} AS ({v})" for k, v in VIEWS.items())


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table; base tables are named by path, so no session state is left behind."""
    import re

    if name == "holdings":
        return _holdings(spark, sf_dir)
    sql = VIEWS[name].replace("/ 1000.0", "/ 1000D")
    for t in ("region", "nation", "supplier", "customer", "orders", "lineitem"):
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    used = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def _holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`VIEWS["holdings"]`, whose rows are made distinct as numbers, in partitions by order that grow with the tables.

    Both sides are dealt out by the order, a part of the distinct key, so that one shuffle does for the join and the distinct rows.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 50).alias("h"), "l_linenumber", F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("t"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n = parts_of(lines, orders)
    both = lines.repartition(n, "l_orderkey").hint("merge").join(orders.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = both.select("o_orderkey", "o_custkey", "t", "h", "l_linenumber").distinct()
    tenure = F.when(F.col("t") == 0, "domain").when(F.col("t") == 1, "fief").otherwise("clergy")
    return rows.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("place"), tenure.alias("tenure"), F.concat(F.lit("h"), F.col("h").cast("string")).alias("holder"), F.lit(1).alias("num"), (2 + F.col("l_linenumber")).alias("den"), F.col("o_orderkey").alias("via"))
