"""Clean substations and lines to a connected network: buses, lines, transformers, and the polygons behind them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StringType, StructField, StructType

from voltmesh import config as C
from voltmesh.functions import geometry as G
from voltmesh.functions import ids
from voltmesh.functions import kernels as K
from voltmesh.operators import graph, lines, shapes, spatial

CELL_M = 2000.0
SPLIT_VOLTS = 220_000
SPLIT_M = 1.0
CELL_DEG, TILE_DEG = 0.02, 0.05
#: K.split_at() cuts at places that are so near in degrees; twice that leaves room for rounding.
ON_LINE_DEG = 2e-9
DECIMALS = 8


def _dealt(df: DataFrame, *key: str) -> DataFrame:
    """df dealt by a key to a number of partitions that adaptive execution keeps, as shapes cost far more than their bytes tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def _floored(df: DataFrame) -> DataFrame:
    return df.withColumn("voltage", (F.floor(F.col("voltage") / 1000) * 1000).cast("int"))


def split_overpassing(df: DataFrame, buses: DataFrame, volts: int = SPLIT_VOLTS, tolerance_m: float = SPLIT_M) -> DataFrame:
    """Lines of at least volts cut wherever a bus lies on them without being an end; parts get letters before their kV. df itself where nothing is cut."""
    cell = lambda v: F.floor(v / CELL_DEG).cast("long")
    cells = lambda low, high: F.explode(F.sequence(cell(low - ON_LINE_DEG), cell(high + ON_LINE_DEG)))
    key = lambda x, y: x * 1_000_000 + y
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = buses.select(F.col("geometry.lon").alias("px"), F.col("geometry.lat").alias("py")).withColumn("_cell", key(cell(F.col("px")), cell(F.col("py"))))
    spots = spots.repartition(partitions, "_cell").distinct()
    # Only places within K.split_at()'s distance cut: segments are tested for those in plain arithmetic, in degrees.
    high = df.where((F.col("voltage") >= volts) & (F.size("geometry") > 1))
    at = lambda i, name: F.element_at("geometry", i).alias(name)
    high = high.select("line_id", "geometry", F.explode(F.sequence(F.lit(1), F.size("geometry") - 1)).alias("_i"))
    high = high.select("line_id", at(1, "_s"), at(-1, "_e"), at(F.col("_i"), "_a"), at(F.col("_i") + 1, "_b"))
    high = high.select("line_id", *(F.col(f"_{n}.{c}").alias(f"{n}{x}") for n in "seab" for c, x in (("lon", "x"), ("lat", "y"))))
    high = high.withColumn("_x", cells(F.least("ax", "bx"), F.greatest("ax", "bx"))).withColumn("_y", cells(F.least("ay", "by"), F.greatest("ay", "by")))
    high = high.withColumn("_cell", key(F.col("_x"), F.col("_y"))).drop("_x", "_y").repartition(partitions, "_cell")
    t = F.expr("least(1D, greatest(0D, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / greatest((bx - ax) * (bx - ax) + (by - ay) * (by - ay), 1e-300D)))")
    far_x, far_y = F.col("ax") + t * F.expr("bx - ax") - F.col("px"), F.col("ay") + t * F.expr("by - ay") - F.col("py")
    box = F.expr(f"px >= least(ax, bx) - {ON_LINE_DEG}D and px <= greatest(ax, bx) + {ON_LINE_DEG}D and py >= least(ay, by) - {ON_LINE_DEG}D and py <= greatest(ay, by) + {ON_LINE_DEG}D")
    near = high.join(spots, "_cell").where(box & F.expr("not (px = sx and py = sy) and not (px = ex and py = ey)") & (far_x * far_x + far_y * far_y <= ON_LINE_DEG**2))
    near = graph.settled(near.select("line_id", G.point(F.col("px"), F.col("py")).alias("p")).distinct())
    if near.isEmpty():
        return df
    over = df.join(near, "line_id").where(shapes.point_to_line_m(F.col("p"), F.col("geometry")) <= tolerance_m).groupBy("line_id").agg(F.array_sort(F.collect_set("p")).alias("_points"))
    over = graph.settled(over)
    rows = df.join(over, "line_id").withColumn("_parts", shapes.split("geometry", "_points")).withColumn("_n", F.size("_parts"))
    rows = rows.select("*", F.posexplode("_parts").alias("_i", "_part"))
    name = F.when(F.col("_n") > 1, F.concat(ids.without_kv(F.col("line_id")), F.lit(":"), ids.letters(F.col("_i")), F.lit("-"), ids.kv_of(F.col("line_id")))).otherwise(F.col("line_id"))
    cut = rows.withColumn("line_id", name).withColumn("geometry", F.col("_part")).select(*df.columns)
    return df.join(over, "line_id", "left_anti").unionByName(cut)


def contracted(df: DataFrame, polygons: DataFrame) -> DataFrame:
    """Lines joined through places where two alone meet; adds contains_lines. Chains that close or fork stay as they are.

    A column _n, if there, numbers the rows of a stored table.
    """
    own = ["line_id", "circuits", "voltage", "underground", "geometry"]
    if "_n" not in df.columns:
        df = graph.stored(df.select(*own, F.monotonically_increasing_id().alias("_n")))
    # Places are dealt by tiles, so that most of a chain is known to one task.
    tile = lambda v: F.floor(v / TILE_DEG).cast("long")
    met = graph.pass_through(df, key="_n").select("a", "b", "point.lon", "point.lat").withColumn("_tile", tile(F.col("lon")) * 1_000_000 + tile(F.col("lat")))
    rings = polygons.select(F.explode("geometry").alias("ring")).withColumn("box", G.bounds(F.col("ring"))).select("ring", "box.*")
    span = lambda low, high: F.explode(F.sequence(tile(F.col(low)), tile(F.col(high))))
    rings = rings.withColumn("_x", span("west", "east")).withColumn("_y", span("south", "north")).withColumn("_tile", F.col("_x") * 1_000_000 + F.col("_y"))
    within = F.expr("lon >= west and lon <= east and lat >= south and lat <= north") & G.in_ring(F.struct("lon", "lat"), F.col("ring"))
    met, rings = _dealt(met, "_tile").alias("m"), _dealt(rings.select("_tile", "ring", "west", "south", "east", "north"), "_tile").alias("r")
    pairs = met.join(rings, (F.col("m._tile") == F.col("r._tile")) & within, "left_anti")
    comp = graph.connected(pairs.select("a", "b")).withColumnRenamed("id", "_n")
    rows = df.join(comp, "_n", "left").withColumn("component", F.coalesce("component", "_n"))
    rows = _dealt(rows.select("component", *own), "component").sortWithinPartitions("component", "line_id")
    return rows.mapInArrow(_chained, f"line_id string, circuits int, voltage int, underground boolean, geometry {G.LINE}, contains_lines array<string>")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of contracted() from rows (component, line_id, circuits, voltage, underground, geometry), sorted by component and line."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch["component"].to_numpy()
        # The last component may go on in the next batch.
        begin = int(np.searchsorted(groups, groups[-1]))
        if begin or (held and held[-1]["component"][-1].as_py() != groups[-1]):
            held.append(batch.slice(0, begin))
            yield from _fused(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(begin))
    if held:
        yield from _fused(pa.Table.from_batches(held))


def _fused(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The lines of whole components: a chain as one row, named after its longest line, others as they are."""
    (rows,) = table.combine_chunks().to_batches()
    kind = rows.schema.field("geometry").type
    groups, parts = rows["component"].to_numpy(), shapes._rows(rows["geometry"])
    begin = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])).tolist()
    points = shapes._points(rows["geometry"].flatten())
    size = np.array([len(p) for p in parts])
    last = np.cumsum(size) - 1
    metric = K.to_metric(points)
    steps = np.concatenate([[0.0], np.hypot(*np.diff(metric, axis=0).T)]) if len(points) else np.empty(0)
    firsts, lasts = ([tuple(x) for x in points[np.minimum(i, max(0, len(points) - 1))].tolist()] if len(points) else [()] * len(parts) for i in (last - size + 1, last))
    chosen, counts, lines_ = [], [], []
    for a, b in zip(begin, [*begin[1:], len(parts)], strict=True):
        if b - a > 1:
            if size[a:b].min() > 1:
                joined = K.merged_lines(parts[a:b], list(zip(firsts[a:b], lasts[a:b], strict=True)))
            else:
                joined = K.merged_lines(parts[a:b])
            if len(joined) == 1 and not K.is_closed(joined[0]):
                # Sums over all points differ by rounding from those of one line, so lengths are taken line by line.
                lengths = [float(steps[last[i] - size[i] + 2 : last[i] + 1].sum()) for i in range(a, b)]
                chosen.append(a + lengths.index(max(lengths)))
                counts.append(b - a)
                lines_ += joined
                continue
        chosen += range(a, b)
        counts += [1] * (b - a)
        lines_ += parts[a:b]
    n = np.array(counts)
    taken = rows.take(pa.array(chosen))
    fused = pc.binary_join_element_wise("merged_", taken["line_id"], "+", pa.array(n - 1).cast(pa.string()), "")
    name = pc.if_else(pa.array(n > 1), fused, taken["line_id"])
    contains = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), rows["line_id"])
    yield pa.RecordBatch.from_arrays([name, taken["circuits"], taken["voltage"], taken["underground"], shapes._column(lines_, kind), contains], ["line_id", "circuits", "voltage", "underground", "geometry", "contains_lines"])


def _member(name: Column) -> Column:
    """What a bus belongs to by itself: its own polygon if it is named after one, else the bus."""
    return F.when(name.startswith("way/") | name.startswith("relation/"), ids.base(name)).otherwise(name)


def station_members(buses: DataFrame, polygons: DataFrame) -> DataFrame:
    """(member, shapes, buses): the polygons, and the points of buses that have none, each with its buses."""
    bus = buses.select(_member(F.col("bus_id")).alias("member"), F.struct("voltage", "bus_id", "contains", "geometry").alias("bus"), F.lit(None).cast(G.POLYGON).alias("rings"))
    ring = polygons.select(F.col("bus_id").alias("member"), F.lit(None).cast(bus.schema["bus"].dataType).alias("bus"), F.col("geometry").alias("rings"))
    both = bus.unionByName(ring).groupBy("member").agg(F.collect_list("bus").alias("buses"), F.flatten(F.array_sort(F.collect_set("rings"))).alias("shapes"))
    point = F.array(F.array(F.array_min(F.transform("buses", lambda b: b["geometry"]))))
    named = F.col("member").startswith("way/") | F.col("member").startswith("relation/")
    return both.select("member", F.when(F.size("shapes") > 0, F.col("shapes")).when(~named, point).alias("shapes"), "buses").where("shapes is not null")


def clustered(members: DataFrame, radius_m: float) -> DataFrame:
    """Adds component: members whose shapes, each widened by radius_m, overlap, through others too."""
    parts = _dealt(members.select("member", F.explode("shapes").alias("shape")), "member")
    m = F.when(F.size("shape") == 1, F.array(G._metric_point(F.col("shape")[0]))).otherwise(F.transform("shape", G._metric_point))
    parts = parts.withColumn("shape", F.transform(m, lambda p: F.struct(p["x"].alias("lon"), p["y"].alias("lat"))))
    b, p = G.bounds(F.col("shape")), F.col("shape")[0]
    parts = parts.withColumn("box", F.when(F.size("shape") == 1, spatial.box_of_point(p["lon"], p["lat"], radius_m)).otherwise(F.struct((b["west"] - radius_m).alias("west"), (b["south"] - radius_m).alias("south"), (b["east"] + radius_m).alias("east"), (b["north"] + radius_m).alias("north"))))
    parts = graph.stored(parts)
    other = parts.select(F.col("member").alias("member2"), F.col("shape").alias("shape2"), F.col("box").alias("box2"))
    near = spatial.box_join(parts, other, "box", "box2", max(CELL_M, 4 * radius_m), F.col("member") < F.col("member2"))
    a, b = F.col("shape")[0], F.col("shape2")[0]
    ring, ring2 = F.size("shape") > 3, F.size("shape2") > 3
    points = (F.size("shape") == 1) & (F.size("shape2") == 1)
    # A corner of one inside the other tells that they meet; only what that leaves open needs the kernel.
    meet = F.when(points, F.hypot(a["lon"] - b["lon"], a["lat"] - b["lat"]) <= 2 * radius_m).otherwise((ring & G.in_ring(b, F.col("shape"))) | (ring2 & G.in_ring(a, F.col("shape2"))))
    near = graph.stored(near.select("member", "member2", "shape", "shape2", meet.alias("_meet"), (~points).alias("_open")).where("_meet or _open"))
    others = near.where("not _meet").where(shapes.apart("shape", "shape2") <= 2 * radius_m)
    pairs = near.where("_meet").select("member", "member2").unionByName(others.select("member", "member2")).toDF("a", "b")
    comp = graph.connected(pairs)
    return members.join(comp.withColumnRenamed("id", "member"), "member", "left").withColumn("component", F.coalesce("component", "member"))


def _outlines(members: list[list[np.ndarray]], radius_m: float) -> list[np.ndarray]:
    """The outlines of the union of members in metres, each widened."""
    wide = [K.united([ring for s in x for ring in K.dilated(s, radius_m)]) for x in members]
    return K.united([r for x in wide for r in x]) if len(wide) > 1 else wide[0]


def stations(members: DataFrame, radius_m: float) -> DataFrame:
    """(component, station_id, poi, members, buses) of clustered members.

    A station goes by its largest widened member, without suffix where no other station has
    the same base id; poi is the pole of that member, or of the whole station if the member is a
    point. members are the shapes of each.
    """

    def largest(parts: list[list[np.ndarray]]) -> int:
        # A widened point is smaller than any other widened shape.
        wide = [i for i, x in enumerate(parts) if len(x) > 1 or len(x[0]) > 1]
        if len(wide) < 2:
            return wide[0] if wide else 0
        return wide[int(np.argmax([sum(map(K.ring_area, _outlines([parts[i]], radius_m))) for i in wide]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = shapes._rows(batch["members"], K.to_metric)
            best = [largest(x) for x in of]
            poi, rings = [None] * len(of), {}
            for k, (x, i) in enumerate(zip(of, best, strict=True)):
                found = [s for s in x[i] if len(s) > 3]
                # The pole of a widened point is the point.
                if found or len(x[i]) > 1 or len(x[i][0]) > 1:
                    rings[k] = max(found or _outlines(x, radius_m), key=K.ring_area)
                else:
                    poi[k] = x[i][0][:1]
            for k, p in zip(rings, K.poles(list(rings.values()), radius_m / 2), strict=True):
                poi[k] = p[None]
            names = pa.array([x[i] for x, i in zip(batch["names"].to_pylist(), best, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([names, shapes._column(poi, to_arrow_type(line), K.to_degrees), *batch.select(rest).columns], ["name", "poi", *rest])

    every = _dealt(members.select("component", F.struct("member", "shapes", "buses").alias("row")), "component").groupBy("component").agg(F.array_sort(F.collect_list("row")).alias("_all"))
    every = every.select("component", *(F.col("_all")[c].alias(n) for c, n in (("member", "names"), ("shapes", "members"), ("buses", "buses"))))
    rest, line = ["component", "members", "buses"], DataType.fromDDL(G.LINE)
    found = every.mapInArrow(run, StructType([StructField("name", StringType()), StructField("poi", line), *(every.schema[c] for c in rest)]))
    found = found.withColumns({"poi": F.col("poi")[0], "buses": F.flatten("buses"), "_base": ids.base(F.col("name"))})
    found = graph.stored(found)
    counts = graph.settled(found.groupBy("_base").agg(F.count("*").alias("_n")).where("_n > 1").select("_base", F.lit(True).alias("_several")))
    station = F.when(F.col("_several"), F.col("name")).otherwise(F.col("_base"))
    return found.join(counts, "_base", "left").select("component", station.alias("station_id"), "poi", "members", "buses")


def station_polygons(places: DataFrame, radius_m: float) -> DataFrame:
    """(station_id, geometry): the outlines of the union of the widened members of each station, made when they are read."""
    outlines = shapes.metric_kernel(lambda every: [_outlines(x, radius_m) for x in every], G.POLYGON)
    return _dealt(places.select("station_id", "members"), "station_id").select("station_id", outlines("members").alias("geometry"))


def station_buses(places: DataFrame) -> DataFrame:
    """places with their buses: one for each voltage, set around the station's middle where it has several. Adds levels (bus_id, voltage, contains, geometry), the highest first."""
    virtual = lambda name: name.startswith("virtual_")
    volts = F.sort_array(F.array_distinct(F.filter(F.transform("buses", lambda b: b["voltage"]), lambda v: v.isNotNull())), asc=False)
    places = places.withColumn("_volts", volts)
    best = lambda v: F.array_min(F.transform(F.filter("buses", lambda b: b["voltage"] == v), lambda b: F.struct(virtual(b["bus_id"]).alias("virtual"), b["bus_id"].alias("bus_id"), b["contains"].alias("contains"))))
    levels = places.select("*", F.posexplode("_volts").alias("_i", "voltage")).withColumn("b", best(F.col("voltage"))).withColumn("_n", F.size("_volts"))
    dx, dy = G.ring_offset(F.col("_n"), F.col("_i"))
    # As lambdas each step is worked out once; as plain columns they would grow beyond what can be compiled.
    moved = F.transform(F.transform(F.array("poi"), G._metric_point), lambda m: F.struct((m["x"] + dx).alias("x"), (m["y"] + dy).alias("y")))
    moved = F.transform(moved, lambda m: G.point(*G.geographic(m["x"], m["y"])))[0]
    near = lambda p: G.point(G.rint(p["lon"], DECIMALS), G.rint(p["lat"], DECIMALS))
    levels = levels.withColumn("_p", F.when(F.col("_n") > 1, moved).otherwise(F.col("poi")))
    name = F.when(virtual(F.col("b.bus_id")), F.col("b.bus_id")).otherwise(ids.with_kv(F.col("station_id"), F.col("voltage")))
    return levels.select("station_id", name.alias("bus_id"), "voltage", F.col("b.contains").alias("contains"), near(F.col("_p")).alias("geometry"), "buses", F.flatten("members").alias("shapes"))


def connected_lines(df: DataFrame, levels: DataFrame, radius_m: float) -> DataFrame:
    """Lines between two buses: cut at the edges of their stations and led on to the buses. Lines that leave no single part, or lead back to one bus, go.

    levels: buses as station_buses() gives them, with what ends in their station.
    """
    own = F.filter("buses", lambda b: b["bus_id"].startswith("virtual_") & (b["voltage"] == F.col("voltage")))
    spot = levels.select("voltage", F.explode(own).alias("_b"), F.col("bus_id").alias("bus"), F.col("geometry").alias("p"), F.col("shapes").alias("s"))
    spot = spot.select("voltage", "_b.geometry", "bus", "p", "s")
    for i, end in ((0, 1), (1, -1)):
        side = spot.select("voltage", F.col("geometry.lon").alias("_lon"), F.col("geometry.lat").alias("_lat"), F.col("bus").alias(f"bus{i}"), F.col("p").alias(f"_p{i}"), F.col("s").alias(f"_s{i}"))
        tip = F.element_at("geometry", end)
        df = _dealt(df.withColumns({"_lon": tip["lon"], "_lat": tip["lat"]}), *(place := ["voltage", "_lon", "_lat"])).join(_dealt(side, *place), place).drop("_lon", "_lat")
    def cut(every, s0, s1):
        first = K.outside_each(every, s0, radius_m)
        of = [i for i, x in enumerate(first) for _ in x]
        done: list[list[np.ndarray]] = [[] for _ in every]
        for i, x in zip(of, K.outside_each([p for x in first for p in x], [s1[i] for i in of], radius_m), strict=True):
            done[i] += x
        return [parts if len(parts) < 2 else single(parts, (a, b)) for parts, a, b in zip(done, s0, s1, strict=True)]

    def single(parts, regions):
        parts = K.without_loops(parts)
        both = [p for p in parts if all(K.intersects(p, (rings, radius_m + 1e-2)) for rings in regions)]
        return both[:1] if both else parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shapes._rows(batch[c], K.to_metric) for c in ("geometry", "_s0", "_s1")]
            parts = [y for i in range(0, batch.num_rows, 1024) for y in cut(*(x[i : i + 1024] for x in rows))]
            kept = [i for i, x in enumerate(parts) if len(x) == 1]
            part = shapes._column([parts[i][0] for i in kept], batch.schema.field("geometry").type, K.to_degrees)
            yield pa.RecordBatch.from_arrays([*batch.select(rest).take(pa.array(kept, pa.int64())).columns, part], [*rest, "geometry"])

    df = df.where("bus0 <> bus1")
    rest = [c for c in df.columns if c not in ("geometry", "_s0", "_s1")]
    df = df.mapInArrow(run, StructType([*(df.schema[c] for c in rest), df.schema["geometry"]]))
    return df.withColumn("geometry", G.extended(G.extended(F.col("geometry"), F.col("_p0")), F.col("_p1"))).drop("_p0", "_p1")


def transformers(buses: DataFrame) -> DataFrame:
    """One for each pair of voltages of a station, the higher first."""
    side = lambda i: buses.select("station_id", F.col("bus_id").alias(f"bus{i}"), F.col("voltage").alias(f"_v{i}"), F.col("geometry").alias(f"_g{i}"))
    both = side(0).join(side(1), "station_id").where("_v0 > _v1")
    kv = lambda i: (F.col(f"_v{i}") / 1000).cast("int")
    name = F.concat("station_id", F.lit("-"), kv(0).cast("string"), F.lit("-"), kv(1).cast("string"))
    return both.select(name.alias("transformer_id"), "station_id", "bus0", "bus1", kv(0).alias("voltage_bus0_kv"), kv(1).alias("voltage_bus1_kv"), F.array("_g0", "_g1").alias("geometry"))


def line_buses(df: DataFrame) -> DataFrame:
    return df.select(F.col("bus0").alias("bus_id")).union(df.select("bus1")).distinct()


def merged_once(df: DataFrame) -> DataFrame:
    """lines.merged_identical() of a stored table with a column _n: only lines whose voltage and geometry hash as another's are gathered."""
    df = df.withColumns({"_key": F.xxhash64("voltage", "geometry"), "_row": F.col("line_id")})
    twice = graph.settled(df.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key"))
    named = lambda rows: rows.withColumn("line_id", ids.with_kv(F.col("line_id"), F.col("voltage"))).drop("_key", "_row")
    if twice.isEmpty():
        return named(df)
    alone, same = named(df.join(twice, "_key", "left_anti")), lines.merged_identical(df.join(twice, "_key", "left_semi")).drop("_key", "_row")
    return graph.stored(alone.withColumn("circuits", F.col("circuits").cast("int")).unionByName(same))


def built(substations: DataFrame, polygons: DataFrame, df: DataFrame, config: C.Config) -> dict[str, DataFrame]:
    """buses, lines, transformers, stations_polygon and buses_polygon; all but the last are typed and empty where there are no lines."""
    net = config.network
    after = None if net.remove_after is None else str(net.remove_after)
    radius = net.station_merge_radius_m
    buses = lines.in_service(substations, net.remove_under_construction, after)
    polygons = polygons.join(buses.select("bus_id").distinct(), "bus_id", "left_semi").select(ids.base(F.col("bus_id")).alias("bus_id"), "geometry").distinct()
    buses, polygons = graph.settled(_floored(buses).select("bus_id", "voltage", "geometry", F.array("contains").alias("contains"))), graph.settled(polygons)
    nothing = df.isEmpty()
    df = lines.in_service(df, net.remove_under_construction, after)
    df = graph.stored(df.select("line_id", "circuits", "voltage", "underground", "geometry", F.monotonically_increasing_id().alias("_n")))
    df = _floored(merged_once(df))
    whole = df
    ends = lambda rows: F.explode(F.array(F.element_at(rows, 1), F.element_at(rows, -1))).alias("geometry")
    df = split_overpassing(df, buses.select("geometry").unionByName(df.select(ends("geometry"))))
    # Parts of a line have its number, so they are numbered anew.
    df = graph.stored(contracted(df if df is whole else df.drop("_n"), polygons))
    ends = graph.virtual_buses(df.select(F.regexp_replace("line_id", "^merged_", "").alias("line_id"), "voltage", "geometry"))
    every = buses.unionByName(ends.select("bus_id", "voltage", "geometry", "contains"))
    members = clustered(graph.stored(station_members(every, polygons)), radius)
    places = stations(members, radius)
    places = places.limit(0) if nothing else places
    levels = graph.stored(station_buses(places))
    merged = levels.select("bus_id", "station_id", "voltage", "contains", "geometry")
    joined = graph.stored(connected_lines(df, levels, radius))
    live = merged.join(line_buses(joined), "bus_id", "left_semi")
    kv: Column = (F.col("voltage") / 1000).cast("int").alias("voltage_kv")
    return {
        "buses": live.select("bus_id", "station_id", kv, ids.osm_ids(F.col("contains")).alias("osm_ids"), "geometry"),
        "lines": joined.select("line_id", "bus0", "bus1", kv, "circuits", G.rint(G.length_m(F.col("geometry")), 2).alias("length_m"), "underground", ids.osm_ids(F.col("contains_lines")).alias("osm_ids"), "geometry"),
        "transformers": transformers(live),
        "stations_polygon": station_polygons(places, radius),
        "buses_polygon": polygons,
    }


def united(tables: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Networks of several regions as one."""
    return {name: reduce(DataFrame.unionByName, (t[name] for t in tables)) for name in tables[0]}
