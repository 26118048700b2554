import json
import struct
import zlib

import pytest

from voltmesh.sources import elements, overpass, pbf, sinks
from voltmesh.streaming import features


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def field(n, value):
    if isinstance(value, int):
        return varint(n << 3) + varint(value)
    return varint(n << 3 | 2) + varint(len(value)) + value


def zig(n):
    return n << 1 if n >= 0 else (-n << 1) - 1


def deltas(values):
    return b"".join(varint(zig(b - a)) for a, b in zip([0, *values], values))


def extract(path):
    strings = [b"", b"power", b"line", b"substation", b"outer"]
    table = b"".join(field(1, s) for s in strings)
    dense = field(1, deltas([5, 7])) + field(8, deltas([500000000, 500010000])) + field(9, deltas([40000000, 40010000])) + field(10, b"".join(map(varint, [0, 1, 3, 0])))
    way = field(1, 3) + field(2, varint(1)) + field(3, varint(2)) + field(8, deltas([5, 7]))
    relation = field(1, 9) + field(2, varint(1)) + field(3, varint(3)) + field(8, varint(4)) + field(9, deltas([3])) + field(10, varint(1))
    block = field(1, table) + field(2, field(2, dense)) + field(2, field(3, way)) + field(2, field(4, relation))
    blob = field(2, len(block)) + field(3, zlib.compress(block))
    head = field(1, b"OSMData") + field(3, len(blob))
    path.write_bytes(struct.pack(">I", len(head)) + head + blob)


def test_pbf_source_and_resolver(spark, tmp_path):
    extract(tmp_path / "x.pbf")
    spark.dataSource.register(pbf.OsmPbf)
    raw = spark.read.format("osm_pbf").load(str(tmp_path / "x.pbf"))
    rows = {(r.type, r.id): r for r in raw.collect()}
    assert rows["node", 7].tags == {"power": "substation"} and abs(rows["node", 7].lat - 50.001) < 1e-9
    assert rows["way", 3].refs == [5, 7] and rows["relation", 9].members[0].ref == 3
    of = lambda kind: raw.where(f"type = '{kind}'")
    whole = elements.resolved(of("node").select("id", "lat", "lon", "tags"), of("way").select("id", "refs", "tags"), of("relation").select("id", "members", "tags"))
    tables = elements.payloads(whole)
    assert {k: v.count() for k, v in tables.items()} == {"lines_way": 1, "cables_way": 0, "substations_way": 0, "substations_node": 1, "substations_relation": 1, "routes_relation": 0}
    assert pbf.retrieved(spark, str(tmp_path / "x.pbf"), False)["substations_node"].count() == 1
    assert len(tables["lines_way"].first().geometry) == 2 and len(tables["substations_relation"].first().members[0].geometry) == 2


def test_tags_are_tested_before_rows_are_made(spark, tmp_path):
    extract(tmp_path / "x.pbf")
    spark.dataSource.register(pbf.OsmPbf)
    read = lambda **o: sorted((r.type, r.id) for r in spark.read.format("osm_pbf").options(**o).load(str(tmp_path / "x.pbf")).collect())
    assert read() == [("node", 5), ("node", 7), ("relation", 9), ("way", 3)]
    assert read(kind="node") == [("node", 5), ("node", 7)] and read(kind="node", features="true") == [("node", 7)]
    assert read(features="true") == [("node", 7), ("relation", 9), ("way", 3)]
    (block,) = (pbf.blob_bytes((tmp_path / "x.pbf").read_bytes()[at : at + size]) for _, at, size in pbf.blocks(str(tmp_path / "x.pbf")))
    assert list(pbf.block_rows(block, chosen=frozenset([("railway", "rail")]))) == []


def test_stored_elements_read_as_their_files(spark, tmp_path):
    rows = [{"type": "way", "id": i, "tags": {"power": "line"}, "geometry": [{"lon": 1.0 * i, "lat": 2.0}, {"lon": 3.0, "lat": 4.0}]} for i in range(20)]
    (tmp_path / "PT_lines_way.json").write_text(json.dumps({"elements": rows}))
    files = [str(tmp_path / "PT_lines_way.json")]
    folder = elements.store_elements(spark, files, str(tmp_path / "pt.elements"))
    plain, stored = (elements.lines_and_cables(spark, x, []).orderBy("_row").collect() for x in (files, [folder]))
    assert plain == stored and len(stored) == 20 and elements.elements(spark, [folder], "node").count() == 0
    both = elements.elements(spark, [folder, *files], "way")
    assert both.count() == 40
    with pytest.raises(ValueError):
        elements.store_elements(spark, files, str(tmp_path / "pt"))


def test_large_tables_are_refused_by_single_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from voltmesh.functions import geometry as G

    df = spark.range(5).select("id", G.point(F.lit(1.0), F.lit(2.0)).alias("geometry"))
    with pytest.raises(ValueError):
        sinks.write_geojson(df, str(tmp_path / "x.geojson"), most=4)
    sinks.write_geojson(df, str(tmp_path / "x.geojson"), most=5)
    assert len(json.loads((tmp_path / "x.geojson").read_text())["features"]) == 5


def test_overpass_queries_and_answers():
    assert len(overpass.FEATURES) == 6 and 'way["power"="cable"](area.searchArea);' in overpass.query("BE", "cables_way", 60)
    node = {"type": "node", "id": 1, "lat": 50.0, "lon": 4.0}
    assert overpass.with_points({"elements": [node]})["elements"][0]["geometry"] == [{"lon": 4.0, "lat": 50.0}]

    class Client:
        def post(self, url, data, timeout):
            return self

        def raise_for_status(self):
            pass

        def json(self):
            return {"elements": [node]}

    got = overpass.retrieved("BE", False, "http://localhost", client=Client())
    assert got["routes_relation"] == {"elements": []} and len(got["lines_way"]["elements"]) == 1


def test_elements_skip_small_files_and_take_the_country_from_the_name(spark, tmp_path):
    (tmp_path / "BE_lines_way.json").write_text(json.dumps({"elements": [{"type": "way", "id": 1, "tags": {"power": "line"}, "geometry": [{"lon": 1.0, "lat": 2.0}]}, {"type": "node", "id": 2}]}))
    (tmp_path / "NL_lines_way.json").write_text("{}")
    rows = elements.elements(spark, [str(tmp_path / f"{c}_lines_way.json") for c in ("BE", "NL")], "way").collect()
    assert [(r.id, r.country) for r in rows] == [("way/1", "BE")]
    assert elements.elements(spark, [], "way").count() == 0


def test_stream_counts_each_feature_once(spark, tmp_path):
    rows = [{"id": "way/1", "country": "BE", "voltage": "220 kV;380000", "power": "line", "ts": "2024-01-01T00:00:00"}] * 2 + [{"id": "way/2", "country": "BE", "voltage": "20000", "power": "line", "ts": "2024-01-01T00:00:00"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = features.levels_by_window(features.cleaned_stream(features.feature_stream(spark, str(tmp_path / "in")), 220000))
    q = stream.writeStream.outputMode("update").format("memory").queryName("levels").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.voltage, r.n) for r in spark.sql("SELECT * FROM levels").collect()} == {("220000", 1), ("380000", 1)}
