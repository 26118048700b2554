"""Raw features to clean substations, their polygons, and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmesh import config as C
from voltmesh import schemas
from voltmesh.functions import geometry as G
from voltmesh.functions import ids, tags
from voltmesh.operators import graph, lines, shapes, spatial
from voltmesh.sources import elements

CELL = 0.05
POLE_TOLERANCE = 1e-5


def _ac(config: C.Config) -> Column:
    general, own = C.ac_hz(config)
    return tags.by_region(F.col("country"), {k: tags.hz(v) for k, v in own.items()}, tags.hz(general))


def _least_volts(config: C.Config) -> Column:
    general, own = C.minimum_volts(config)
    return tags.by_region(F.col("country"), own, float(general))


def _volts_int(df: DataFrame) -> DataFrame:
    return df.withColumn("voltage", F.col("voltage").try_cast("int"))


def merged_polygons(ways: DataFrame) -> DataFrame:
    """Adds pole, that of each row's own polygon, and rings: the outlines of the union of all valid polygons that touch or overlap it, through others too. Invalid ones go.

    ways: a row for each part, geometry being the ring.
    """
    # Dealt by a number of partitions, as shapes cost far more than their bytes tell, and settled, as they are read four times.
    n = int(ways.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = ways.repartition(n, "id").where(shapes.valid("geometry"))
    ways = graph.settled(ways.withColumn("pole", shapes.pole("geometry", F.lit(POLE_TOLERANCE))))
    rings = ways.select(ids.base(F.col("id")).alias("way"), "geometry").dropDuplicates(["way"]).withColumn("box", G.bounds(F.col("geometry")))
    other = rings.select(F.col("way").alias("way2"), F.col("geometry").alias("geometry2"), F.col("box").alias("box2"))
    near = spatial.box_join(rings, other, "box", "box2", CELL, F.col("way") < F.col("way2"))
    touching = near.where(shapes.apart_m("geometry", "geometry2") == 0).select(F.col("way").alias("a"), F.col("way2").alias("b"))
    comp = graph.connected(touching)
    named = rings.join(comp.withColumnRenamed("id", "way"), "way", "left").select("way", "geometry", F.coalesce("component", "way").alias("component"))
    whole = named.repartition(n, "component").groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct("way", "geometry"))), lambda x: x["geometry"]).alias("rings"))
    whole = whole.withColumn("rings", F.when(F.size("rings") > 1, shapes.dissolved("rings")).otherwise(F.col("rings")))
    return ways.withColumn("way", ids.base(F.col("id"))).join(named.select("way", "component").join(whole, "component"), "way").drop("way", "component")


def clean_substations(raw: DataFrame, config: C.Config) -> tuple[DataFrame, DataFrame]:
    """Substations with one row for each voltage and country, and the polygons of those that are no nodes."""
    general, _ = C.minimum_volts(config)
    dc = tags.hz(config.network.frequency_hz.DC)
    df = raw.withColumn("voltage", tags.clean_voltage(F.col("voltage"))).withColumn(
        "under_construction", tags.under_construction(F.col("power"), F.col("construction"), F.col("construction:power"), ("substation",))
    )
    df = df.withColumn("start_date", tags.clean_date(F.col("start_date"))).withColumn("frequency", tags.clean_frequency(F.col("frequency")))
    df = df.where(tags.voltage_at_least(F.col("voltage"), general))
    df = lines.exploded_voltages(df)
    df = lines.substation_frequencies(df.where(lines.is_volts(general)), dc, _ac(config))
    df = _volts_int(df).where(F.col("voltage") >= _least_volts(config))
    keep = ["id", "voltage", "country", "under_construction", "start_date", "_row"]
    way = merged_polygons(df.where(~F.col("is_node")).select(*keep, "geometry"))
    way = way.select(*keep, F.col("pole").alias("geometry"), "rings")
    node = df.where("is_node").select(*keep, F.col("geometry")[0].alias("geometry"), F.lit(None).cast(G.POLYGON).alias("rings"))
    whole = lines.aggregated_substations(way.unionByName(node))
    out = whole.select(F.col("id").alias("bus_id"), "voltage", "country", "under_construction", "start_date", F.col("base_id").alias("contains"), "geometry", "rings")
    return out.drop("rings"), out.where("rings is not null").select("bus_id", "voltage", F.col("rings").alias("geometry"))


def _dressed(df: DataFrame) -> DataFrame:
    return lines.cleaned_tags(graph.settled(df)).withColumns({
        "under_construction": tags.under_construction(F.col("power"), F.col("construction"), F.col("construction:power"), ("line", "cable")),
        "start_date": tags.clean_date(F.col("start_date")),
    })


def _cascade(df: DataFrame, config: C.Config) -> DataFrame:
    general, _ = C.minimum_volts(config)
    parts = lines.exploded_voltages(df).where(lines.is_volts(general))
    return lines.inferred_circuits(parts, tags.hz(config.network.frequency_hz.DC), _ac(config))


def _final(df: DataFrame, config: C.Config) -> DataFrame:
    df = _volts_int(df).where(F.col("voltage") >= _least_volts(config))
    return df.withColumn("circuits", F.coalesce(F.col("circuits").try_cast("int"), F.lit(1)))


_OUT = ["line_id", "circuits", "voltage", "underground", "under_construction", "start_date", "contains", "geometry", "_row"]


def route_lines(raw: DataFrame, config: C.Config) -> DataFrame:
    """Lines of relations whose member ways make one line, and share none with a relation whose ways don't."""
    general, _ = C.minimum_volts(config)
    df = _dressed(lines.without_duplicates(raw))
    df = df.where(tags.voltage_at_least(F.col("voltage"), general) & (F.col("frequency") != tags.hz(config.network.frequency_hz.DC)))
    df = _final(_cascade(df.withColumn("frequency", _ac(config)), config), config)
    member = F.filter("members", lambda m: m["geometry"].isNotNull() & (F.size(m["geometry"]) > 1) & ~G.is_closed(m["geometry"]))
    df = df.withColumn("_m", member).withColumn("contains", F.transform("_m", lambda m: F.concat(F.lit("way/"), m["ref"].cast("string"))))
    df = df.withColumn("_parts", shapes.merged(F.transform("_m", lambda m: m["geometry"])))
    torn = df.where(F.size("_parts") > 1).select(F.explode("contains").alias("way")).distinct()
    bad = df.select(F.col("id"), F.explode("contains").alias("way")).join(torn, "way", "left_semi").select("id").distinct()
    good = df.where(F.size("_parts") == 1).join(bad, "id", "left_anti")
    return good.withColumns({"line_id": F.col("id"), "underground": F.lit(False), "geometry": F.col("_parts")[0]}).select(*_OUT)


def way_lines(raw: DataFrame, covered: DataFrame | None, config: C.Config) -> DataFrame:
    """Lines of ways that no relation covers, without DC lines and closed rings."""
    general, _ = C.minimum_volts(config)
    df = lines.without_duplicates(raw)
    if covered is not None:
        df = df.join(covered, "id", "left_anti")
    df = _dressed(df).where(tags.voltage_at_least(F.col("voltage"), general))
    df = _cascade(df, config).where(F.col("frequency") != tags.hz(config.network.frequency_hz.DC))
    df = _final(df, config).where(~G.is_closed(F.col("geometry")))
    return df.withColumns({"line_id": F.col("id"), "underground": tags.as_text(F.col("power")) == "cable", "contains": F.array(ids.base(F.col("id")))}).select(*_OUT)


def without_internal(df: DataFrame, polygons: DataFrame) -> DataFrame:
    """Lines that do not run wholly within one polygon."""
    boxes = polygons.select(F.col("geometry").alias("rings"), G.bounds(F.flatten("geometry")).alias("box2")).distinct()
    near = spatial.box_join(df.select("line_id", "geometry").withColumn("box", G.bounds(F.col("geometry"))), boxes, "box", "box2", CELL)
    a, b = F.col("box"), F.col("box2")
    held = near.where((a["west"] >= b["west"]) & (a["east"] <= b["east"]) & (a["south"] >= b["south"]) & (a["north"] <= b["north"]))
    return df.join(held.where(shapes.inside("geometry", "rings")).select("line_id").distinct(), "line_id", "left_anti")


def extended_to_substations(df: DataFrame, polygons: DataFrame) -> DataFrame:
    """Lines that end in polygons, cut at their edges and led on to the pole of each; others as they are."""
    rings = polygons.groupBy(F.col("geometry").alias("rings")).agg(F.min("bus_id").alias("bus_id"))
    rings = rings.withColumn("box2", G.bounds(F.flatten("rings"))).withColumn("pole", shapes.pole(F.col("rings")[0], F.lit(POLE_TOLERANCE)))
    near = spatial.box_join(df.select("line_id", "voltage", "geometry").withColumn("box", G.bounds(F.col("geometry"))), rings, "box", "box2", CELL)
    holds = lambda p: F.exists("rings", lambda r: G.in_ring(p, r))
    ends = near.where(holds(F.element_at("geometry", 1)) | holds(F.element_at("geometry", -1)))
    met = ends.groupBy("line_id", "voltage").agg(F.array_sort(F.collect_list(F.struct("bus_id", "pole", "rings"))).alias("met"))
    joined = df.join(met, ["line_id", "voltage"], "left")
    parts = shapes.clipped("geometry", F.flatten(F.transform("met", lambda m: m["rings"])))
    cut = joined.withColumn("_parts", F.when(F.col("met").isNotNull(), parts))
    far = lambda line: F.aggregate(G._edges(line, lambda a, b: F.hypot(b["lon"] - a["lon"], b["lat"] - a["lat"])), F.lit(0.0), lambda s, x: s + x)
    longest = F.aggregate("_parts", F.col("geometry"), lambda best, p: F.when(far(p) > F.when(best == F.col("geometry"), F.lit(-1.0)).otherwise(far(best)), p).otherwise(best))
    led = F.aggregate("met", F.when(F.size("_parts") > 0, longest).otherwise(F.col("geometry")), lambda line, m: F.when(F.size("_parts") > 0, G.extended(line, m["pole"])).otherwise(line))
    return cut.withColumn("geometry", F.when(F.col("met").isNotNull(), led).otherwise(F.col("geometry"))).select(*df.columns)


def cleaned(spark: SparkSession, inputs: dict[str, list[str]], config: C.Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Substations, their polygons and lines from payload files by feature; absent features count as empty."""
    of = lambda f: inputs.get(f, [])
    substations, polygons = clean_substations(elements.substations(spark, of("substations_way"), of("substations_node"), of("substations_relation")), config)
    substations, polygons = graph.settled(substations), graph.settled(polygons)
    routes = None
    if config.network.include_relations and of("routes_relation"):
        routes = graph.settled(route_lines(elements.routes(spark, of("routes_relation")), config))
    covered = None if routes is None else routes.select(F.explode("contains").alias("id")).distinct()
    whole = way_lines(elements.lines_and_cables(spark, of("lines_way"), of("cables_way")), covered, config)
    if routes is not None:
        whole = routes.unionByName(whole)
    whole = graph.settled(lines.aggregated_lines(whole))
    whole = extended_to_substations(without_internal(whole, polygons), polygons)
    shape = [x.split(" ")[0] for x in schemas.LINES.replace(",lat", ";lat").split(", ")]
    return substations, polygons, whole.select(*shape)
