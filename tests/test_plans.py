"""Small inputs through the whole plans."""

import json

import pytest

from voltmesh import config as C
from voltmesh.plans import build, clean, mapview, search
from voltmesh.sources import sinks

def payload(folder, name, elements):
    path = folder / f"BE_{name}.json"
    path.write_text(json.dumps({"elements": elements}))
    return [str(path)]


def element(kind, number, points, **tags):
    return {"type": kind, "id": number, "tags": {k.replace("__", ":"): v for k, v in tags.items()}, "geometry": [{"lon": x, "lat": y} for x, y in points]}


def way(number, points, **more):
    return element("way", number, points, **({"power": "line", "voltage": "400 kV"} | more))


#: An L of two yards, its inner corner at (7.02, 48.02).
ELL = [(7.0, 48.0), (7.06, 48.0), (7.06, 48.02), (7.02, 48.02), (7.02, 48.05), (7.0, 48.05)]


def test_lines_inside_an_angled_substation_go(spark, tmp_path):
    yard = element("way", 70, ELL, power="substation", voltage="400000;220000")
    lines = {
        1: [(7.005, 48.04), (7.01, 48.01), (7.05, 48.005)],  # around the corner, inside throughout
        2: [(7.01, 48.04), (7.05, 48.01)],  # cuts across the inner corner
        3: [(7.01, 48.01), (7.01, 47.9)],  # leaves at the bottom
        4: [(7.2, 48.0), (7.3, 48.1)],  # elsewhere
        5: [(7.4, 48.0), (7.5, 48.0), (7.5, 48.1), (7.4, 48.0)],  # a ring
    }
    inputs = {"substations_way": payload(tmp_path, "substations_way", [yard]), "lines_way": payload(tmp_path, "lines_way", [way(i, p) for i, p in lines.items()])}
    buses, polygons, out = clean.cleaned(spark, inputs, C.Config())
    assert sorted((r.bus_id, r.voltage) for r in buses.collect()) == [("way/70-1", 400000), ("way/70-2", 220000)] and polygons.count() == 2
    got = {r.line_id: [(round(p.lon, 6), round(p.lat, 6)) for p in r.geometry] for r in out.collect()}
    assert set(got) == {"way/2", "way/3", "way/4"} and got["way/4"] == lines[4]
    pole = (got["way/3"][0], got["way/2"][0])
    assert pole[0] == pole[1] and got["way/3"][1:] == [(7.01, 48.0), (7.01, 47.9)]
    assert 7.0 < pole[0][0] < 7.06 and 48.0 < pole[0][1] < 48.05


def test_relations_of_one_line_take_the_place_of_their_ways(spark, tmp_path):
    bends = {31: [(-3.5, 40.0), (-3.4, 40.1)], 32: [(-3.2, 40.0), (-3.4, 40.1)], 33: [(-3.2, 40.0), (-3.1, 40.2), (-3.0, 40.2)], 34: [(-2.0, 41.0), (-1.9, 41.0)], 35: [(-1.5, 41.0), (-1.4, 41.0)], 36: [(-1.0, 41.0), (-0.9, 41.0)]}
    ways = [way(i, p, circuits="2") for i, p in bends.items()]
    of = {w["id"]: w for w in ways}

    def relation(number, members, **more):
        rows = [{"type": "way", "ref": i, "role": "", "geometry": of[i]["geometry"]} for i in members] + [{"type": "node", "ref": 1, "role": "", "geometry": None}]
        return {"type": "relation", "id": number, "tags": {"route": "power", "voltage": "400000", "frequency": "50"} | more, "members": rows}

    # One whole, one torn, one that shares a way with the torn one, and a DC one.
    relations = [relation(1, (32, 31, 33)), relation(2, (34, 35)), relation(3, (34,)), relation(4, (36,), frequency="0")]
    inputs = {"lines_way": payload(tmp_path, "lines_way", ways), "routes_relation": payload(tmp_path, "routes_relation", relations)}
    rows = {r.line_id: r for r in clean.cleaned(spark, inputs, C.Config())[2].collect()}
    assert set(rows) == {"relation/1", "way/34", "way/35", "way/36"}
    whole = rows["relation/1"]
    ends = [(p.lon, p.lat) for p in whole.geometry]
    assert sorted(whole.contains) == ["way/31", "way/32", "way/33"] and not whole.underground
    assert ends in ([(-3.5, 40.0), (-3.4, 40.1), (-3.2, 40.0), (-3.1, 40.2), (-3.0, 40.2)], [(-3.0, 40.2), (-3.1, 40.2), (-3.2, 40.0), (-3.4, 40.1), (-3.5, 40.0)])


def tables(spark, buses=(), rings=(), lines=()):
    """Clean tables of (bus, kV, point), (bus, kV, ring) and (way number, kV, circuits, points)."""
    from voltmesh import schemas

    at = lambda p: {"lon": float(p[0]), "lat": float(p[1])}
    return (
        spark.createDataFrame([(b, kv * 1000, "FR", False, None, b, at(p)) for b, kv, p in buses], schemas.SUBSTATIONS),
        spark.createDataFrame([(b, kv * 1000, [[at(p) for p in ring]]) for b, kv, ring in rings], schemas.SUBSTATION_POLYGONS),
        spark.createDataFrame([(f"way/{i}", c, kv * 1000, False, False, None, [f"way/{i}"], [at(p) for p in points]) for i, kv, c, points in lines], schemas.LINES),
    )


def test_a_fork_stays_and_a_chain_becomes_one_line(spark, tmp_path):
    hub = (12.0, 55.0)
    lines = [(5, 380, 2, [(11.5, 55.0), (11.7, 55.1)]), (6, 380, 2, [(11.8, 55.0), (11.7, 55.1)]), (7, 380, 2, [(11.8, 55.0), hub]), (8, 380, 2, [hub, (12.3, 55.2)]), (9, 380, 2, [hub, (12.3, 54.8)])]
    net = build.built(*tables(spark, lines=lines), C.Config(network=C.Network(station_merge_radius_m=25.0)))
    buses, got = {b.bus_id: b for b in net["buses"].collect()}, net["lines"].collect()
    assert len(buses) == 4 and net["transformers"].count() == 0 and net["stations_polygon"].count() == 4
    assert sorted(r.osm_ids for r in got) == ["way/5;way/6;way/7", "way/8", "way/9"] and {r.circuits for r in got} == {2} and {r.voltage_kv for r in got} == {380}
    (at_hub,) = set.intersection(*({r.bus0, r.bus1} for r in got))
    assert (round(buses[at_hub].geometry.lon, 4), round(buses[at_hub].geometry.lat, 4)) == hub
    assert net["lines"].columns == ["line_id", "bus0", "bus1", "voltage_kv", "circuits", "length_m", "underground", "osm_ids", "geometry"]
    sinks.write_csv(net["lines"], str(tmp_path / "csv"))
    sinks.write_geojson(net["lines"], str(tmp_path / "lines.geojson"))
    features = json.loads((tmp_path / "lines.geojson").read_text())["features"]
    assert [f["geometry"]["type"] for f in features] == ["LineString"] * 3 and features[0]["properties"]["voltage_kv"] == 380
    assert mapview.write_map(net, str(tmp_path / "map.html")) > 500


def test_stations_of_several_voltages_get_transformers(spark):
    ring = [(20.0, 60.0), (20.01, 60.0), (20.01, 60.005), (20.0, 60.005), (20.0, 60.0)]
    middle = (20.005, 60.0025)
    buses = [("way/1-1", 400, middle), ("way/1-2", 220, middle)]
    rings = [("way/1-1", 400, ring), ("way/1-2", 220, ring)]
    lines = [(2, 400, 1, [middle, (20.2, 60.0025)]), (3, 220, 3, [middle, (20.005, 60.2)])]
    net = build.built(*tables(spark, buses, rings, lines), C.Config(network=C.Network(station_merge_radius_m=50.0)))
    assert [(r.transformer_id, r.voltage_bus0_kv, r.voltage_bus1_kv) for r in net["transformers"].collect()] == [("way/1-400-220", 400, 220)]
    assert {"way/1-400", "way/1-220"} < {r.bus_id for r in net["buses"].collect()} and net["buses"].count() == 4


def test_nothing_to_build(spark):
    ring = [(20.0, 60.0), (20.01, 60.0), (20.01, 60.005), (20.0, 60.0)]
    for given in (tables(spark), tables(spark, [("way/1", 400, (20.005, 60.001))], [("way/1", 400, ring)])):
        net = build.built(*given, C.Config())
        assert all(df.count() == 0 for name, df in net.items() if name != "buses_polygon")
    assert net["buses_polygon"].count() == 1


@pytest.mark.parametrize(
    ("text", "rows"), [("", {1, 2, 3}), ("a & b | c", {1, 3}), ("a &", {1, 2}), ("a & (b | d)", {1, 2}), ("zzz", set()), (") a (", {1, 2}), ("NULL", {3})]
)
def test_search_language(spark, text, rows):
    df = spark.createDataFrame([(1, "A b"), (2, "a D"), (3, "c")], "id int, name string").selectExpr("id", "name", "if(id = 3, null, 'x') AS more")
    assert {r.id for r in search.searched(df, text).collect()} == rows


def test_chains_of_any_batch_are_joined_whole(spark):
    """A chain of seven, a fork, a ring of two and a line alone, in batches of two rows."""
    chain = [(f"way/{i}-380", 2, 380_000, False, [(5 + i, 50.0), (6 + i, 50.0 + 0.1 * (i == 3))][:: 1 if i % 2 else -1]) for i in range(10, 13)]
    chain += [(f"way/{i}-380", 2, 380_000, False, [(5 + i, 50.0 + 0.1 * (i == 4)), (6 + i, 50.0)]) for i in range(13, 17)]
    fork = [(f"way/{i}-380", 1, 380_000, False, [(1.0, 40.0), (1.0 + i / 100, 41.0)]) for i in (1, 2, 3)]
    ring = [("way/21-220", 1, 220_000, True, [(3.0, 45.0), (3.5, 46.0), (4.0, 45.0)]), ("way/22-220", 1, 220_000, True, [(4.0, 45.0), (3.0, 45.0)])]
    at = lambda p: {"lon": float(p[0]), "lat": float(p[1])}
    rows = [(*r[:4], [at(p) for p in r[4]]) for r in [*chain, *fork, *ring, ("way/30-220", 1, 220_000, False, [(9.0, 45.0), (9.5, 45.0)])]]
    point = "struct<lon:double,lat:double>"
    df = spark.createDataFrame(rows, f"line_id string, circuits int, voltage int, underground boolean, geometry array<{point}>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = {r.line_id: r for r in build.contracted(df, spark.createDataFrame([], f"bus_id string, geometry array<array<{point}>>")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    (name,) = [n for n in got if n.startswith("merged_")]
    assert set(got) - {name} == {"way/1-380", "way/2-380", "way/3-380", "way/21-220", "way/22-220", "way/30-220"}
    assert got[name].contains_lines == [f"way/{i}-380" for i in range(10, 17)] and got[name].circuits == 2 and name.endswith("-380+6")
    xs = [p.lon for p in got[name].geometry]
    assert xs == [float(x) for x in range(15, 23)] or xs == [float(x) for x in range(22, 14, -1)]


def test_links_of_one_task_need_no_rounds(spark, monkeypatch):
    from voltmesh.operators import graph

    links = spark.createDataFrame([("d", "c"), ("b", "c"), ("a", "b"), ("x", "y"), ("y", "y")], "a string, b string")
    want = {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    assert dict(graph.connected(links.repartition(5)).collect()) == want
    monkeypatch.setattr(graph, "_rounds", None)
    assert dict(graph.connected(links.coalesce(1)).collect()) == want


def test_a_line_twice_is_one_with_all_circuits_and_cut_where_another_ends(spark):
    lines = [(1, 380, 1, [(5.0, 50.0), (5.04, 50.0)]), (2, 380, 2, [(5.0, 50.0), (5.04, 50.0)]), (3, 380, 1, [(5.02, 50.0), (5.1, 50.1)]), (4, 110, 1, [(7.0, 50.0), (7.04, 50.0)]), (5, 110, 1, [(7.02, 50.0), (7.1, 50.1)])]
    net = build.built(*tables(spark, lines=lines), C.Config(network=C.Network(station_merge_radius_m=25.0)))
    got = sorted((r.osm_ids, r.circuits, round(r.length_m)) for r in net["lines"].collect())
    assert [x[:2] for x in got] == [("way/1:a", 3), ("way/1:b", 3), ("way/3", 1), ("way/4", 1), ("way/5", 1)] and net["buses"].count() == 8
    assert net["stations_polygon"].count() == 8 and all(len(r.geometry) == 1 for r in net["stations_polygon"].collect())
