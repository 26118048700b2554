"""Writers: CSV with WKT geometry, GeoJSON features, raw payloads."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmesh.functions import geometry as G


def _kind(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType.simpleString()
    return {G.POINT: "Point", G.LINE: "LineString", G.POLYGON: "Polygon"}[kind]


def as_wkt(df: DataFrame, column: str = "geometry") -> DataFrame:
    """The geometry as WKT, last of the columns."""
    wkt = {"Point": G.wkt_point, "LineString": G.wkt_line, "Polygon": G.wkt_polygon}[_kind(df, column)](F.col(column))
    return df.select(*(c for c in df.columns if c != column), wkt.alias(column))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with a header and WKT geometry."""
    as_wkt(df).write.mode("overwrite").option("header", True).csv(path)


def geometry_json(df: DataFrame, column: str = "geometry") -> Column:
    kind, g = _kind(df, column), F.col(column)
    if kind == "Point":
        body = F.concat(F.lit('"Point","coordinates":['), g["lon"].cast("string"), F.lit(","), g["lat"].cast("string"), F.lit("]"))
    elif kind == "LineString":
        body = F.concat(F.lit('"LineString","coordinates":'), G.geojson_coordinates(g))
    else:
        rings = F.array_join(F.transform(g, lambda r: F.concat(F.lit("["), G.geojson_coordinates(r), F.lit("]"))), ",")
        body = F.concat(F.lit('"MultiPolygon","coordinates":['), rings, F.lit("]"))
    return F.concat(F.lit('{"type":'), body, F.lit("}"))


def features(df: DataFrame, column: str = "geometry") -> DataFrame:
    """(feature): each row as a GeoJSON feature."""
    rest = F.to_json(F.struct(*(F.col(c) for c in df.columns if c != column)), {"ignoreNullFields": "false"})
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), rest, F.lit(',"geometry":'), F.coalesce(geometry_json(df, column), F.lit("null")), F.lit("}")).alias("feature"))


def write_geojson_lines(df: DataFrame, path: str) -> None:
    """A folder of files with a feature on each line, written by the tasks: for tables of any size."""
    features(df).write.mode("overwrite").text(path)


#: Rows that one file, or a page, made on the driver may hold.
MOST_ROWS = 2_000_000


def held(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """df, if the driver may write it to one file; larger tables are refused."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: use write_geojson_lines(), whose files the tasks write")
    return df


def write_geojson(df: DataFrame, path: str, most: int = MOST_ROWS) -> None:
    """One FeatureCollection file of at most most rows, which stream through the driver, a partition at a time."""
    rows = features(held(df, most)).toLocalIterator()
    with Path(path).open("w", encoding="utf-8") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for i, row in enumerate(rows):
            out.write("," * (i > 0) + "\n" + row["feature"])
        out.write("\n]}\n")


def read_geojson(spark, path: str, properties: str) -> DataFrame:
    """The features of a FeatureCollection: the given properties, geometry's type and its raw coordinates as JSON."""
    schema = f"features array<struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.select(F.explode("features").alias("f")).select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def write_payloads(tables: dict[str, DataFrame], path: str, country: str) -> None:
    """Feature tables as JSON lines under path/country=../feature=.."""
    for feature, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/country={country}/feature={feature}")
