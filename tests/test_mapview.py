"""Layers of the map, the page that holds them, and circuits side by side."""

import base64
import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from voltmesh.functions import geometry as G
from voltmesh.operators import shapes
from voltmesh.plans import mapview, search


def network(spark):
    at = lambda *p: [{"lon": float(x), "lat": float(y)} for x, y in p]
    lines = spark.createDataFrame([("way/1-220", "b0", "b1", 220, 3, "way/1", at((1, 50), (1.5, 50), (2, 50))), ("way/2-400", "b1", "b2", 400, 1, None, at((2, 50), (2, 51)))], f"line_id string, bus0 string, bus1 string, voltage_kv int, circuits int, osm_ids string, geometry {G.LINE}")
    ring = at((1, 50), (1.1, 50), (1.1, 50.1), (1, 50.1), (1, 50))
    polygons = lambda name: spark.createDataFrame([("way/9", [ring, ring])], f"{name} string, geometry {G.POLYGON}")
    return {"lines": lines, "stations_polygon": polygons("station_id"), "buses_polygon": polygons("bus_id")}


def test_page_holds_all_layers(spark, tmp_path):
    assert mapview.write_map(network(spark), str(tmp_path / "map.html"), circuit_zoom=9) > 1000
    page = (tmp_path / "map.html").read_text()
    data = json.loads(gzip.decompress(base64.b64decode(re.search(r'type="text/plain">([^<]*)<', page)[1])))
    layers = data["layers"]
    assert {k: len(v) for k, v in layers.items()} == {"stations": 2, "buses": 2, "lines": 2, "circuits": 4} and data["circuit_zoom"] == 9
    assert layers["lines"][1]["osm_ids"] is None and layers["stations"][0]["polygon"][0] == {"lon": 1.0, "lat": 50.0}
    first = [r for r in layers["circuits"] if r["line_id"] == "way/1-220"]
    assert len({json.dumps(r["path"]) for r in first}) == 3 and {tuple(r["path"][0].values()) for r in first} == {(1.0, 50.0)}
    with pytest.raises(ValueError):
        mapview.write_map(network(spark), str(tmp_path / "map.html"), most=1)


def test_circuits_run_side_by_side(spark):
    df = search.circuit_rows(network(spark)["lines"])
    rows = {(r.line_id, r.circuit_index): r.offset_path for r in shapes.pathway_offsets(df).collect()}
    middle = [rows["way/1-220", i][2].lat for i in range(3)]  # past the first taper
    assert [round(x - 50, 7) for x in middle] == [-0.0003, 0.0, 0.0003]
    parts = shapes.pathway_offsets(df.withColumn("geometry", F.array("geometry", "geometry"))).collect()
    assert all(r.offset_path == [rows[r.line_id, r.circuit_index]] * 2 for r in parts)
