"""OpenStreetMap PBF extracts as a Spark data source: spark.read.format("osm_pbf").load(path).

Each compressed block is read and decoded by the task that owns it; the driver only skips
from header to header. Rows are nodes (lat, lon), ways (refs) and relations (members).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from voltmesh import rules

SCHEMA = "type string, id bigint, tags map<string,string>, lat double, lon double, refs array<bigint>, members array<struct<type:string,ref:bigint,role:string>>"


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        c = b[i]
        i += 1
        out |= (c & 127) << shift
        if c < 128:
            return out, i
        shift += 7


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message: varints as ints, the rest as bytes."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        wire = key & 7
        if wire == 0:
            value, i = _varint(b, i)
        elif wire == 2:
            n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        else:
            n = 8 if wire == 1 else 4
            value, i = b[i : i + n], i + n
        yield key >> 3, value


def packed(b: bytes) -> list[int]:
    out, i = [], 0
    while i < len(b):
        v, i = _varint(b, i)
        out.append(v)
    return out


def signed(v: int) -> int:
    """Zigzag: 0, -1, 1, -2 as 0, 1, 2, 3."""
    return (v >> 1) ^ -(v & 1)


def sums(values: list[int]) -> list[int]:
    """Numbers from their zigzag differences."""
    out, at = [], 0
    for v in values:
        at += signed(v)
        out.append(at)
    return out


def _tags(keys: list[int], values: list[int], strings: list[str]) -> dict[str, str]:
    return {strings[k]: strings[v] for k, v in zip(keys, values, strict=True)}


#: Tags of which an element has one if it is a feature or groups features.
FEATURE_TAGS = frozenset(
    [(key, value) for key in ("power", "construction:power") for value in rules.FEATURES] + [("power", "construction"), ("power", "circuit"), ("route", "power")]
)
GROUPS = {"node": (1, 2), "way": (3,), "relation": (4,)}


def block_rows(block: bytes, kind: str | None = None, chosen: frozenset[tuple[str, str]] | None = None) -> Iterator[tuple]:
    """Rows of one decompressed PrimitiveBlock, in SCHEMA's order.

    kind: only elements of this type; groups of others are not decoded. chosen: only elements
    with one of these tags; a block whose strings hold none of them is not decoded.
    """
    rows = _block_rows(block, GROUPS[kind] if kind else (1, 2, 3, 4), chosen)
    return rows if chosen is None else (r for r in rows if not chosen.isdisjoint(r[2].items()))


def _block_rows(block: bytes, groups_of: tuple[int, ...], chosen: frozenset[tuple[str, str]] | None) -> Iterator[tuple]:
    strings: list[str] = []
    groups, granularity, lat0, lon0 = [], 100, 0, 0
    for n, v in fields(block):
        if n == 1:
            strings = [s.decode("utf-8", "replace") for k, s in fields(v) if k == 1]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            granularity = v
        elif n == 19:
            lat0 = v - (1 << 64) if v >> 63 else v
        elif n == 20:
            lon0 = v - (1 << 64) if v >> 63 else v
    place = lambda lat, lon: ((lat0 + granularity * lat) * 1e-9, (lon0 + granularity * lon) * 1e-9)
    known = set(strings)
    if chosen is not None and not any(k in known and v in known for k, v in chosen):
        return
    for group in groups:
        for n, v in fields(group):
            if n not in groups_of:
                continue
            got: dict[int, list] = {}
            for k, x in fields(v):
                got.setdefault(k, []).append(x)
            whole = lambda k, got=got: [y for x in got.get(k, []) for y in (packed(x) if isinstance(x, bytes) else [x])]
            if n == 1:
                lat, lon = place(signed(got[8][0]), signed(got[9][0]))
                yield "node", signed(got[1][0]), _tags(whole(2), whole(3), strings), lat, lon, None, None
            elif n == 2:
                pairs, all_tags = iter(whole(10)), []
                ids = sums(whole(1))
                for _ in ids:
                    mine = {}
                    for k in pairs:
                        if k == 0:
                            break
                        mine[strings[k]] = strings[next(pairs)]
                    all_tags.append(mine)
                for i, la, lo, t in zip(ids, sums(whole(8)), sums(whole(9)), all_tags, strict=True):
                    lat, lon = place(la, lo)
                    yield "node", i, t, lat, lon, None, None
            elif n == 3:
                yield "way", got[1][0], _tags(whole(2), whole(3), strings), None, None, sums(whole(8)), None
            elif n == 4:
                kinds = ("node", "way", "relation")
                members = [(kinds[t], r, strings[s]) for s, r, t in zip(whole(8), sums(whole(9)), whole(10), strict=True)]
                yield "relation", got[1][0], _tags(whole(2), whole(3), strings), None, None, None, members


def blob_bytes(blob: bytes) -> bytes:
    """The content of a Blob message, decompressed."""
    got = dict(fields(blob))
    return got[1] if 1 in got else zlib.decompress(got[3])


def blocks(path: str) -> Iterator[tuple[str, int, int]]:
    """(type, offset, size) of each blob of a file."""
    with open(path, "rb") as f:
        while head := f.read(4):
            header = dict(fields(f.read(struct.unpack(">I", head)[0])))
            size, at = header[3], f.tell()
            yield header[1].decode(), at, size
            f.seek(size, 1)


class _Block(InputPartition):
    def __init__(self, path: str, spans: list[tuple[int, int]]):
        self.path, self.spans = path, spans


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.per_task = options["path"], int(options.get("blocks_per_task", "16"))
        self.kind, self.chosen = options.get("kind"), FEATURE_TAGS if options.get("features", "false") == "true" else None

    def partitions(self) -> list[InputPartition]:
        spans = [(at, size) for kind, at, size in blocks(self.path) if kind == "OSMData"]
        return [_Block(self.path, spans[i : i + self.per_task]) for i in range(0, len(spans), self.per_task)] or [_Block(self.path, [])]

    def read(self, partition: _Block) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            for at, size in partition.spans:
                f.seek(at)
                yield from block_rows(blob_bytes(f.read(size)), self.kind, self.chosen)


class OsmPbf(DataSource):
    """Register with spark.dataSource.register(OsmPbf). Options: blocks_per_task, blocks that one task decodes, 16;
    kind, the one type of element to decode; features, true for elements with a tag of power features only.

    The file must be on a path that all executors can open.
    """

    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def retrieved(spark, path: str, include_relations: bool = True):
    """The six feature tables of an extract; routes are empty where relations are not included."""
    from voltmesh.sources import elements

    spark.dataSource.register(OsmPbf)
    scan = lambda kind, columns, only: spark.read.format("osm_pbf").option("kind", kind).option("features", str(only).lower()).load(path).select("id", *columns)
    # Tags are tested before rows are made; what features refer to is joined by id from scans of one type each.
    relations = scan("relation", ("members", "tags"), True)
    member = relations.select(F.explode("members").alias("m")).where("m.type = 'way'").select(F.col("m.ref").alias("id")).distinct()
    featured = scan("way", ("refs", "tags"), True)
    ways = featured.unionByName(scan("way", ("refs", "tags"), False).join(member, "id", "left_semi").join(featured.select("id"), "id", "left_anti"))
    stations = scan("node", ("lat", "lon", "tags"), True)
    nodes = stations.unionByName(scan("node", ("lat", "lon", "tags"), False).join(ways.select(F.explode("refs").alias("id")).distinct(), "id", "left_semi").join(stations.select("id"), "id", "left_anti"))
    tables = elements.payloads(elements.resolved(nodes, ways, relations))
    if not include_relations:
        tables["routes_relation"] = tables["routes_relation"].limit(0)
    return tables
