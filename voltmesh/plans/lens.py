"""Grid-shaped rows from the star-schema test tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmesh.functions import geometry as G

SUBSTATIONS = """SELECT s_suppkey AS id,
 CASE s_nationkey % 4 WHEN 0 THEN 'BE' WHEN 1 THEN 'NL' WHEN 2 THEN 'US' ELSE 'BR' END AS country,
 CASE s_suppkey % 8 WHEN 0 THEN '380000;220000' WHEN 1 THEN '220 kV' WHEN 2 THEN '400/220/110/20_kV'
  WHEN 3 THEN 'medium' WHEN 4 THEN '220000' WHEN 5 THEN '380000>220000' WHEN 6 THEN '' ELSE 'Max Amperes 100' END AS voltage,
 CASE s_suppkey % 5 WHEN 0 THEN '50' WHEN 1 THEN '60 Hz' WHEN 2 THEN '50;0' WHEN 3 THEN '' ELSE '16,7' END AS frequency,
 CASE WHEN s_suppkey % 11 = 0 THEN 'construction' ELSE 'substation' END AS power,
 CASE WHEN s_suppkey % 11 = 0 THEN 'substation' ELSE '' END AS construction,
 4000000 + (s_suppkey % 20) * 50000 AS cx_u,
 50000000 + CAST(floor(s_suppkey / 20) AS BIGINT) * 50000 AS cy_u,
 10000 AS half_u
FROM supplier"""

LINES = """SELECT (l_orderkey * 10 + l_linenumber) * 20000000 + l_partkey * 1000 + l_suppkey AS id,
 l_orderkey * 10 + l_linenumber AS dup_id, l_orderkey AS relation_id,
 CASE l_partkey % 6 WHEN 0 THEN '380000' WHEN 1 THEN '380000;220000' WHEN 2 THEN '220 kV'
  WHEN 3 THEN '220000;220000' WHEN 4 THEN '110000' ELSE '400 kV' END AS voltage,
 CASE l_linenumber % 5 WHEN 0 THEN '' WHEN 1 THEN '3' WHEN 2 THEN '6' WHEN 3 THEN '6;3' ELSE '0' END AS cables,
 CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '2;1' ELSE '' END AS circuits,
 CASE l_suppkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN '60' ELSE '50' END AS frequency,
 CASE WHEN l_returnflag = 'R' THEN 'cable' ELSE 'line' END AS power,
 4000000 + (l_suppkey % 20) * 50000 AS x0_u,
 50000000 + CAST(floor(l_suppkey / 20) AS BIGINT) * 50000 AS y0_u,
 4000000 + ((l_suppkey + 1 + l_partkey % 3) % 20) * 50000 AS x1_u,
 50000000 + CAST(floor(l_suppkey / 20) AS BIGINT) * 50000 AS y1_u
FROM lineitem"""

DATES = """SELECT o_orderkey AS id, CASE o_orderkey % 6
 WHEN 0 THEN CAST(year(o_orderdate) AS STRING)
 WHEN 1 THEN concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'))
 WHEN 2 THEN concat('circa ', CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'),
                    '-', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'))
 WHEN 3 THEN concat('~', CAST(year(o_orderdate) AS STRING), '?')
 WHEN 4 THEN 'unknown'
 ELSE concat(CAST(year(o_orderdate) AS STRING), '-', CAST(year(o_orderdate) + 3 AS STRING)) END AS start_date
FROM orders"""

KV = "SELECT p_partkey AS id, p_name AS name, CAST(p_size AS INT) * 10 AS voltage_kv, CAST(p_size AS INT) % 4 AS circuits FROM part"

SITES = """SELECT c_custkey AS id, CAST(floor(c_custkey / 5) AS BIGINT) AS grp, CAST(floor(c_custkey / 5) AS BIGINT) % 3 AS grp_type,
 CASE c_custkey % 3 WHEN 0 THEN '380000;220000' WHEN 1 THEN '220 kV' ELSE '400 kV' END AS voltage,
 4000000 + CAST(floor(c_custkey / 70000) AS BIGINT) * 4500000 + (CAST(floor(c_custkey / 5) AS BIGINT) % 20) * 200000
  + (c_custkey % 5) * CASE CAST(floor(c_custkey / 5) AS BIGINT) % 3 WHEN 0 THEN 1500 WHEN 1 THEN 4500 ELSE 20000 END AS cx_u,
 50000000 + CAST(floor(c_custkey / 100) AS BIGINT) % 700 * 40000 AS cy_u,
 1000 AS half_u
FROM customer"""

SPURS = f"""SELECT id, grp, 220000 AS voltage,
 cx_u - 500 AS x0_u, cy_u + CASE id % 3 WHEN 2 THEN 3000 ELSE 0 END AS y0_u,
 cx_u + CASE id % 3 WHEN 0 THEN 500 WHEN 1 THEN 5000 ELSE 500 END AS x1_u,
 cy_u + CASE id % 3 WHEN 2 THEN 3000 ELSE 0 END AS y1_u
FROM ({SITES}) AS lens_sites"""

CHAIN = """SELECT o_orderkey AS id, CAST(floor(o_orderkey / 7) AS BIGINT) AS path,
 CASE CAST(floor(o_orderkey / 7) AS BIGINT) % 3 WHEN 0 THEN 380000 WHEN 1 THEN 220000 ELSE 400000 END AS voltage,
 CASE WHEN CAST(floor(o_orderkey / 7) AS BIGINT) % 2 = 1 AND o_orderkey % 7 >= 3 THEN 2 ELSE 1 END AS circuits,
 o_orderkey % 7 = 2 AS underground,
 4000000 + (o_orderkey % 7) * 3000 + (CAST(floor(o_orderkey / 7) AS BIGINT) % 50) * 30000 + CAST(floor(o_orderkey / 525000) AS BIGINT) * 1600000 AS x0_u,
 50000000 + CAST(floor(o_orderkey / 350) AS BIGINT) % 1500 * 20000 AS y0_u,
 4000000 + (o_orderkey % 7 + 1) * 3000 + (CAST(floor(o_orderkey / 7) AS BIGINT) % 50) * 30000 + CAST(floor(o_orderkey / 525000) AS BIGINT) * 1600000 AS x1_u,
 50000000 + CAST(floor(o_orderkey / 350) AS BIGINT) % 1500 * 20000 AS y1_u
FROM orders"""

ELEMENTS = """SELECT event_id AS id,
 CASE event_id % 7 WHEN 0 THEN 'line' WHEN 1 THEN 'cable' WHEN 2 THEN 'substation' WHEN 3 THEN 'construction' WHEN 4 THEN 'circuit' WHEN 5 THEN 'tower' END AS power,
 CASE event_id % 5 WHEN 0 THEN 'line' WHEN 1 THEN 'substation' WHEN 2 THEN 'cable' END AS construction,
 CASE event_id % 11 WHEN 0 THEN 'line' WHEN 1 THEN 'cable' WHEN 2 THEN 'substation' END AS construction_power,
 CASE event_id % 13 WHEN 0 THEN 'power' WHEN 1 THEN 'bus' END AS route
FROM events"""

_FROM = {SUBSTATIONS: "supplier", LINES: "lineitem", DATES: "orders", KV: "part", SITES: "customer", SPURS: "customer", CHAIN: "orders", ELEMENTS: "events"}


def rows(spark: SparkSession, sf_dir: str, lens: str) -> DataFrame:
    """The rows of a lens over the tables of a folder."""
    table = _FROM[lens]
    return spark.sql(lens.replace(f"FROM {table}", "FROM {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def at(x: str, y: str):
    """A point in degrees from columns in millionths of a degree."""
    return G.point(F.col(x) / 1e6, F.col(y) / 1e6)


def line():
    return F.array(at("x0_u", "y0_u"), at("x1_u", "y1_u"))


def square():
    """The ring of a square around cx_u, cy_u."""
    corner = lambda dx, dy: G.point((F.col("cx_u") + dx * F.col("half_u")) / 1e6, (F.col("cy_u") + dy * F.col("half_u")) / 1e6)
    return F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1), corner(-1, -1))
