"""Components and contraction of the network's graph."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmesh.functions import kernels as K

#: Links of one task that are joined at once.
LINKS = 1_000_000


def _shared(df: DataFrame) -> None:
    """Sets the checkpoint folder that all executors share; a local one only where the master is local."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        given = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not given and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(given or "file://" + tempfile.mkdtemp(prefix="voltmesh-"))


def settled(df: DataFrame) -> DataFrame:
    """df without its lineage, through the checkpoint folder."""
    _shared(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As settled(), as a Parquet table: for large tables, of which later steps read some columns only."""
    _shared(df)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/voltmesh/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> DataFrame:
    """(id, root) for the ids of edges (a, b): the smallest id that links of the same task reach. An id has a row for each run of links that it is in."""
    kind = edges.schema["a"].dataType.simpleString()

    def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = sum(b.num_rows for b in batches)
        every = pa.chunked_array([b.column(i) for i in (0, 1) for b in batches]).combine_chunks()
        every = (every if isinstance(every, pa.Array) else every.chunk(0)).dictionary_encode()
        names = every.dictionary.take(order := pc.array_sort_indices(every.dictionary))
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        of = rank[every.indices.to_numpy()]
        return pa.RecordBatch.from_arrays([names, names.take(pa.array(K.joined_groups(of[:rows], of[rows:], len(names))))], ["id", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= LINKS:
                yield joined(held)
                held = []
        if sum(x.num_rows for x in held):
            yield joined(held)

    return edges.select("a", "b").where("a is not null and b is not null").mapInArrow(run, f"id {kind}, root {kind}")


def connected(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached, for each id in edges (a, b).

    Each task joins its own links first, so it helps if ids that lie together are dealt together;
    only ids that several tasks know link what is left, which is joined in rounds.
    """
    stars = stored(_stars(edges))
    found = stored(stars.groupBy("id").agg(F.min("root").alias("root"), F.max("root").alias("last")))
    several = found.where("root <> last").select("id", F.col("root").alias("a"))
    links = stars.join(several, "id").select("a", F.col("root").alias("b")).where("a <> b").distinct()
    links = settled(links)
    if links.isEmpty():
        return found.select("id", F.col("root").alias("component"))
    roots = _rounds(links).select(F.col("id").alias("root"), "component")
    return found.select("id", "root").join(roots, "root", "left").select("id", F.coalesce("component", "root").alias("component"))


def _rounds(edges: DataFrame) -> DataFrame:
    """connected() by rounds of drawing all neighbours together at the smallest one, first among smaller and then
    among larger neighbours, which end after about log of the number of ids.
    """
    now = settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    nodes = now.select(F.col("u").alias("id")).union(now.select("v")).distinct()
    digest = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = digest(now)
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Larger neighbours hang on to the smallest of the neighbourhood.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        small = settled(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        after, now = digest(small), small
        if after == before:
            break
        before = after
    return nodes.join(now.select(F.col("u").alias("id"), F.col("v").alias("component")), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def endpoints(lines: DataFrame, key: str = "line_id") -> DataFrame:
    """(key, endpoint 0 or 1, point, voltage) for both ends of each line."""
    ends = F.array(F.element_at("geometry", 1), F.element_at("geometry", -1))
    return lines.select(key, "voltage", F.posexplode(ends).alias("endpoint", "point"))


def virtual_buses(lines: DataFrame) -> DataFrame:
    """One bus for each place and voltage where lines end: (bus_id, voltage, geometry, contains).

    Named by the end with the smallest number, then the smallest name; contains are the OSM ids that end there.
    """
    from voltmesh.functions import ids

    ends = endpoints(lines).select("voltage", "point", ids.base(F.col("line_id")).alias("line"), "endpoint")
    name = F.concat("line", F.lit(":"), F.col("endpoint").cast("string"))
    grouped = ends.groupBy("voltage", "point").agg(
        F.min(F.struct(ids.number(F.col("line")).alias("n"), name.alias("name"))).alias("first"),
        F.array_sort(F.collect_set(ids.osm_id(F.col("line")))).alias("contains"),
    )
    bus = ids.with_kv(F.concat(F.lit("virtual_"), F.col("first.name")), F.col("voltage"))
    return grouped.select(bus.alias("bus_id"), "voltage", F.col("point").alias("geometry"), "contains")


def pass_through(lines: DataFrame, inside: DataFrame | None = None, key: str = "line_id") -> DataFrame:
    """(a, b, point): pairs of lines, by their key, that meet alone where nothing else does, at one voltage and with equal circuits.

    inside: points (lon, lat) within substations, which never count.
    """
    ends = F.array(F.element_at("geometry", 1), F.element_at("geometry", -1))
    own = lines.where(F.element_at("geometry", 1) != F.element_at("geometry", -1)).select(F.col(key).alias("id"), "voltage", "circuits", F.explode(ends).alias("point"))
    met = own.groupBy("point", "voltage").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"), F.min("circuits").alias("c0"), F.max("circuits").alias("c1"))
    met = met.where("n = 2 and a <> b and c0 = c1").select("a", "b", "point")
    if inside is not None:
        met = met.join(inside.select(F.struct("lon", "lat").alias("point")).distinct(), "point", "left_anti")
    return met
