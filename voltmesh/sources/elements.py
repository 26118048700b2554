"""Readers of raw features and the importers that shape them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmesh import rules, schemas
from voltmesh.functions import geometry as G
from voltmesh.functions import kernels, tags

LEAST_BYTES = 20
COLUMNS = ("id", "osm_id", "country", "tags", "geometry", "members", "_row")


def elements(spark: SparkSession, paths: list[str] | str, kind: str) -> DataFrame:
    """Elements of one type from payload files {"elements": [...]}, one file for each country and feature.

    id is the type and number; country is the file's name up to its first underscore; files
    under 20 bytes hold none. _row orders rows by file and position. A file is one JSON value, which
    one task reads whole; folders that store_elements() wrote are read by many.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    stored = [p for p in paths if p.endswith(STORED)]
    paths = [p for p in paths if not p.endswith(STORED)]
    if stored:
        rows = spark.read.schema(_stored()).parquet(*stored).where(F.col("type") == kind).drop("type")
        return rows.unionByName(elements(spark, paths, kind)) if paths else rows
    if not paths:
        return spark.createDataFrame([], _stored()).drop("type")
    return _read(spark, paths).where(F.col("type") == kind).drop("type")


#: Names of the folders of store_elements() end so.
STORED = ".elements"


def _stored() -> str:
    return f"type string, id string, osm_id bigint, country string, tags map<string,string>, geometry {G.LINE}, members {_members()}, _row string"


def store_elements(spark: SparkSession, paths: list[str], folder: str) -> str:
    """Payload files as Parquet in a folder, once, so that later reads are split and read only the columns they need; returns the folder."""
    if not folder.endswith(STORED):
        raise ValueError(f"the folder's name must end in {STORED}")
    _read(spark, paths).write.mode("overwrite").parquet(folder)
    return folder


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    raw = spark.read.schema(schemas.PAYLOAD).option("multiLine", True).json(paths)
    rows = raw.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_size").alias("_size")).where(F.col("_size") >= LEAST_BYTES)
    rows = rows.select("_file", F.posexplode("elements").alias("_at", "e"))
    points = F.when((F.col("e.type") == "node") & F.col("e.geometry").isNull() & F.col("e.lat").isNotNull(), F.array(G.point(F.col("e.lon"), F.col("e.lat")))).otherwise(F.col("e.geometry"))
    return rows.select(
        F.col("e.type").alias("type"), F.concat(F.col("e.type"), F.lit("/"), F.col("e.id").cast("string")).alias("id"), F.col("e.id").alias("osm_id"),
        F.element_at(F.split("_file", "_"), 1).alias("country"), F.col("e.tags").alias("tags"), points.alias("geometry"),
        F.col("e.members").alias("members"), F.concat("_file", F.lit(":"), F.lpad(F.col("_at").cast("string"), 12, "0")).alias("_row"),
    )


def _members() -> str:
    return f"array<struct<type:string,ref:bigint,role:string,geometry:{G.LINE}>>"


def flattened(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The named tags as string columns; a tag that is absent is null."""
    return df.select("*", *(F.try_element_at("tags", F.lit(n)).alias(n) for n in names)).drop("tags")


def _ordered(df: DataFrame, rank: str) -> DataFrame:
    """_row with the source's rank before it, so that sources keep their order when they are put together."""
    return df.withColumn("_row", F.concat(F.lit(rank), "_row"))


def lines_and_cables(spark: SparkSession, line_paths: list[str], cable_paths: list[str]) -> DataFrame:
    """Ways of lines, then of cables, with at least two points."""
    both = _ordered(elements(spark, line_paths, "way"), "b0:").unionByName(_ordered(elements(spark, cable_paths, "way"), "b1:"))
    return flattened(both.where(F.size("geometry") >= 2), rules.LINE_TAGS).drop("members")


def routes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Relations that group ways to circuits, with their members."""
    return flattened(_ordered(elements(spark, paths, "relation"), "a:"), rules.RELATION_TAGS).drop("geometry")


def as_array(points) -> np.ndarray:
    """Points of a row from Arrow as an (n, 2) array."""
    return np.array([(p["lon"], p["lat"]) for p in points], float).reshape(-1, 2)


def as_points(line: np.ndarray) -> list[dict]:
    return [{"lon": float(x), "lat": float(y)} for x, y in line]


def substation_hulls(relations: DataFrame) -> DataFrame:
    """(id, geometry): the convex hull of the merged outer ways of each relation that has any; nodes and inner ways don't count."""
    m = relations.select("id", F.explode("members").alias("m")).where((F.col("m.type") != "node") & F.col("m.geometry").isNotNull() & (F.size("m.geometry") > 1))
    m = m.where(~F.coalesce(F.col("m.role"), F.lit("")).isin(*rules.IGNORED_ROLES))

    def hull(pdf: pd.DataFrame) -> pd.DataFrame:
        pts = np.concatenate([as_array(x) for x in pdf["geometry"]])
        return pd.DataFrame({"id": [pdf["id"].iloc[0]], "geometry": [as_points(kernels.convex_hull(pts))]})

    return m.select("id", F.col("m.geometry").alias("geometry")).groupBy("id").applyInPandas(hull, f"id string, geometry {G.LINE}")


def substations(spark: SparkSession, ways: list[str], nodes: list[str], relations: list[str]) -> DataFrame:
    """Substations of all three kinds: way rings closed, node points, hulls of relations. is_node marks points."""
    way = _ordered(elements(spark, ways, "way").where(F.size("geometry") >= 3), "a:").withColumn("geometry", G.closed_ring(F.col("geometry")))
    node = _ordered(elements(spark, nodes, "node").where(F.size("geometry") >= 1), "c:")
    relation = _ordered(elements(spark, relations, "relation"), "b:")
    relation = relation.drop("geometry").join(substation_hulls(relation), "id").where(F.size("geometry") >= 4)
    whole = way.withColumn("is_node", F.lit(False)).unionByName(relation.withColumn("is_node", F.lit(False))).unionByName(node.withColumn("is_node", F.lit(True)))
    return flattened(whole, rules.SUBSTATION_TAGS).drop("members")


def resolved(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """Elements with geometry from raw nodes (id, lat, lon, tags), ways (id, refs, tags) and relations (id, members, tags).

    Ways get their nodes' places in order, without nodes that are missing or off the globe; way
    members get their ways' lines. Only ways that are features or members are resolved.
    """
    good = nodes.where("lat between -90 and 90 and lon between -180 and 180")
    routes_ = relations.where(tags.is_route(F.col("tags")["power"], F.col("tags")["route"], F.col("tags")["construction:power"]) | tags.is_substation_relation(F.col("tags")["power"], F.col("tags")["construction"], F.col("tags")["construction:power"]))
    kind = tags.feature_of(F.col("tags")["power"], F.col("tags")["construction"], F.col("tags")["construction:power"])
    wanted = routes_.select(F.explode("members").alias("m")).where("m.type = 'way'").select(F.col("m.ref").alias("id")).distinct()
    ways = ways.where(kind.isNotNull()).unionByName(ways.join(wanted, "id", "left_semi").where(kind.isNull()))
    spots = ways.select(F.col("id").alias("way"), F.posexplode("refs").alias("at", "id")).join(good.select("id", G.point(F.col("lon"), F.col("lat")).alias("p")), "id")
    paths = spots.groupBy("way").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "p"))), lambda x: x["p"]).alias("geometry"))
    way = ways.join(paths.withColumnRenamed("way", "id"), "id")
    member = routes_.select("id", "tags", F.posexplode("members").alias("at", "m"))
    lines = paths.select(F.col("way").alias("ref"), "geometry")
    member = member.join(lines.withColumn("type", F.lit("way")), (F.col("m.ref") == F.col("ref")) & (F.col("m.type") == F.col("type")), "left")
    full = F.struct(F.col("m.type").alias("type"), F.col("m.ref").alias("ref"), F.col("m.role").alias("role"), F.col("geometry").alias("geometry"))
    relation = member.groupBy("id").agg(F.first("tags").alias("tags"), F.transform(F.array_sort(F.collect_list(F.struct("at", full.alias("m")))), lambda x: x["m"]).alias("members"))
    none = F.lit(None)
    return (
        way.where(kind.isNotNull()).select(F.lit("way").alias("type"), "id", "tags", "geometry", none.cast(_members()).alias("members"))
        .unionByName(good.where(kind == "substation").select(F.lit("node").alias("type"), "id", "tags", F.array(G.point(F.col("lon"), F.col("lat"))).alias("geometry"), none.cast(_members()).alias("members")))
        .unionByName(relation.select(F.lit("relation").alias("type"), "id", "tags", none.cast(G.LINE).alias("geometry"), "members"))
    )


def payloads(resolved_elements: DataFrame) -> dict[str, DataFrame]:
    """The six feature tables of resolved elements, each there even if it is empty."""
    t = F.col("tags")
    kind = tags.feature_of(t["power"], t["construction"], t["construction:power"])
    of = lambda type_, test: resolved_elements.where((F.col("type") == type_) & F.coalesce(test, F.lit(False)))
    return {
        "lines_way": of("way", kind == "line"),
        "cables_way": of("way", kind == "cable"),
        "substations_way": of("way", kind == "substation"),
        "substations_node": of("node", kind == "substation"),
        "substations_relation": of("relation", kind == "substation"),
        "routes_relation": of("relation", tags.is_route(t["power"], t["route"], t["construction:power"])),
    }
