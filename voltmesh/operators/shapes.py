"""The geometry kernels as operators on DataFrames, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from voltmesh.functions import geometry as G
from voltmesh.functions import kernels as K

LINES = f"array<{G.LINE}>"


def _points(values: pa.Array) -> np.ndarray:
    """An Arrow array of points as an (n, 2) array."""
    return np.stack([values.field(i).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for i in range(2)], 1)


def _rows(values: pa.Array, f: Callable = lambda p: p) -> list:
    """The rows of an Arrow array: lines as (n, 2) arrays, lists of lines as lists of such, cut from one flat array of points, to which f is applied; nulls as None."""
    kind, depth = values.type, 0
    while pa.types.is_list(kind) or pa.types.is_large_list(kind):
        kind, depth = kind.value_type, depth + 1
    if not depth or not pa.types.is_struct(kind) or [f.name for f in kind] != ["lon", "lat"]:
        return values.to_pylist()
    ends, valid = values.offsets.to_numpy(), values.is_valid().to_numpy(zero_copy_only=False)
    inner = values.values
    cut = f(_points(inner)) if depth == 1 else _rows(inner, f)
    return [cut[a:b] if ok else None for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), valid.tolist(), strict=True)]


def _column(rows: list, kind: pa.DataType, f: Callable = lambda p: p) -> pa.Array:
    """Rows as _rows() gives them as an Arrow array of a type; f is applied to all points at once."""
    if not pa.types.is_list(kind):
        return pa.array(rows, kind)
    sizes = [0 if r is None else len(r) for r in rows]
    missing = pa.array([r is None for r in rows], pa.bool_())
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    if pa.types.is_list(kind.value_type):
        values = _column([x for r in rows if r is not None for x in r], kind.value_type, f)
    else:
        flat = f(np.concatenate([np.empty((0, 2)), *(r for r in rows if r is not None and len(r))]))
        values = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(kind.value_type))
    return pa.ListArray.from_arrays(offsets, values, type=kind, mask=missing)


def kernel(f: Callable, returns: str):
    """An Arrow UDF that applies f to the values of its columns; rows with a null argument give null.

    Shapes reach f, and leave it, as numpy arrays that are cut from and put into whole columns of coordinates; no point becomes an object.
    """
    n = f.__code__.co_argcount

    def apply(*columns: Column | str) -> Column:
        # The UDF is made when it is applied: Python workers import this module too, and have no session.
        kind = to_arrow_type(DataType.fromDDL(returns))

        def run(*arrays: pa.Array) -> pa.Array:
            rows = zip(*map(_rows, arrays), strict=True)
            return _column([None if any(x is None for x in row) else f(*row) for row in rows], kind)

        chosen = {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}[n]
        chosen.__annotations__ = dict.fromkeys("abc"[:n], pa.Array) | {"return": pa.Array}
        return F.arrow_udf(chosen, returns)(*columns)

    return apply


def metric_kernel(f: Callable, returns: str):
    """An Arrow UDF that applies f to lists of whole batches of shapes in metres, and gives lists of shapes back in degrees; no shape may be null.

    At most 1024 rows are handed to f at once.
    """
    n = f.__code__.co_argcount

    def apply(*columns: Column | str) -> Column:
        kind = to_arrow_type(DataType.fromDDL(returns))

        def run(*arrays: pa.Array) -> pa.Array:
            rows = [_rows(x, K.to_metric) for x in arrays]
            done = [y for i in range(0, len(arrays[0]), 1024) for y in f(*(x[i : i + 1024] for x in rows))]
            return _column(done, kind, K.to_degrees)

        chosen = {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}[n]
        chosen.__annotations__ = dict.fromkeys("abc"[:n], pa.Array) | {"return": pa.Array}
        return F.arrow_udf(chosen, returns)(*columns)

    return apply


merged = kernel(lambda parts: K.merged_lines(parts), LINES)
hull = kernel(lambda line: K.convex_hull(line), G.LINE)
dissolved = kernel(lambda rings: K.united(rings), G.POLYGON)
valid = kernel(lambda ring: bool(K.is_valid(ring)), "boolean")
_pole = kernel(lambda ring, tol: K.pole(ring, tol)[None], G.LINE)
split = kernel(lambda line, points: K.split_at(line, list(points)), LINES)
clipped = kernel(lambda line, rings: K.outside(line, (rings, 0.0)), LINES)
inside = kernel(lambda line, rings: bool(K.within(line, (rings, 0.0))), "boolean")
meets = kernel(lambda line, rings: bool(K.intersects(line, (rings, 0.0))), "boolean")
apart = kernel(lambda a, b: float(K.gap(a, b)), "double")
apart_m = kernel(lambda a, b: float(K.gap(K.to_metric(a), K.to_metric(b))), "double")
simplified_m = kernel(lambda line, tol: K.to_degrees(K.simplified(K.to_metric(line), tol)), G.LINE)


def pole(ring: Column | str, tolerance: Column) -> Column:
    """The pole of a ring, a point."""
    return _pole(ring, tolerance)[0]


def point_to_line_m(p: Column, line: Column) -> Column:
    """Least distance in metres from a point to a line, without leaving the JVM."""
    x, y = G.metric(p["lon"], p["lat"])

    def far(a: Column, b: Column) -> Column:
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        t = ((x - a["x"]) * dx + (y - a["y"]) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-300))
        t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))
        return F.hypot(a["x"] + t * dx - x, a["y"] + t * dy - y)

    return F.array_min(G._edges(F.transform(line, G._metric_point), far))


def pathway_offsets(df: DataFrame, column: str = "geometry", shift: float = 0.0003, taper: float = 0.00025) -> DataFrame:
    """Lines of circuit_rows() side by side: each moved by its place among the circuits, fading out towards both ends.

    shift and taper are in degrees; the taper is at most 0.45 of the line's length, and corners
    are mitred by at most four times the shift. A column of several parts gives each part's offset.
    """

    def moved(line, index, count):
        p = line
        by = (index - (count - 1) / 2) * shift
        if by == 0 or len(p) < 2:
            return p
        total = K.length(p)
        t = min(taper, 0.45 * total)
        at = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(p, axis=0).T))])
        for x in (t, total - t):
            i = int(np.searchsorted(at, x))
            if 0 < i < len(at) and at[i] != x:
                p = np.insert(p, i, p[i - 1] + (p[i] - p[i - 1]) * (x - at[i - 1]) / (at[i] - at[i - 1]), axis=0)
                at = np.insert(at, i, x)
        scale = np.array([math_cos(p[0, 1]), 1.0])
        q = p * scale
        d = np.diff(q, axis=0)
        d /= np.maximum(np.hypot(*d.T), 1e-300)[:, None]
        n = np.stack([-d[:, 1], d[:, 0]], 1)
        before, after = np.vstack([n[:1], n]), np.vstack([n, n[-1:]])
        m = before + after
        size = np.hypot(*m.T)
        m = np.where(size[:, None] > 1e-12, m / np.maximum(size, 1e-300)[:, None], before)
        far = np.minimum(4.0, 1 / np.maximum(np.abs((m * after).sum(1)), 1e-9))
        fade = np.clip(np.minimum(at, total - at) / t, 0, 1)
        return (q + m * (by * far * fade)[:, None]) / scale

    if df.schema[column].dataType == DataType.fromDDL(LINES):
        parts = lambda lines, index, count: [moved(x, index, count) for x in lines]
        return df.withColumn("offset_path", kernel(parts, LINES)(column, "circuit_index", "circuit_count"))
    return df.withColumn("offset_path", kernel(moved, G.LINE)(column, "circuit_index", "circuit_count"))


def math_cos(degrees: float) -> float:
    return float(np.cos(np.radians(degrees)))
