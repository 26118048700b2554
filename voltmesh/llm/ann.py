"""Approximate nearest neighbours by adaptive dimension scan.

Vectors are put into lists around centroids. Each query first scans its nearest lists; the
bound found there decides which other lists it probes: from a list's centroid and spread
follows how many of its vectors should exceed the bound, and the lists of least promise are
left out while few hits in all are expected to go with them. Within a list, vectors are rotated
at random and read in blocks of columns. After each block a hypothesis test on the partial
distance abandons the candidates that cannot come near enough. Survivors are scored exactly,
in double precision, on the original vectors.

The largest inner product becomes the smallest distance by one more coordinate that gives all
candidates the same length, so that vectors of any length are searched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmesh.llm.shared import settle


@dataclass(frozen=True)
class AnnParams:
    """sample: bound on the vectors that the centroids are fitted to, chosen by a hash of the id.

    max_lists bounds the centroids that are broadcast. per_list: vectors in a list on average
    as long as max_lists allows. first: lists that each query scans to find its bound.
    loss: share of the k neighbours that may be expected in the lists that a query leaves out.
    epsilon: the test's level; larger abandons fewer candidates by mistake. tile: bound on the
    vectors, and on the queries, that meet in one task at a time.
    """

    k: int = 20
    sample: int = 20_000
    per_list: int = 2500
    max_lists: int = 4096
    first: int = 2
    loss: float = 0.03
    block: int = 16
    epsilon: float = 2.1
    tile: int = 8192
    seed: int = 11


#: Queries that are scanned together against a tile.
_GROUP = 256
#: Below this share of living pairs the scan goes on pair by pair.
_SPARSE = 0.08
#: Rounding of single precision, as a share of the squared lengths.
_ROUND = 1e-5


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of equally long lists as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: not null, not zero, no null or non-finite component."""
    v = F.col("embedding")
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def fit_centroids(sample: np.ndarray, n: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centroids of a sample by k-means; fewer than n if the sample has fewer distinct vectors."""
    sample = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    if len(sample) <= n:
        return sample
    centre = sample[rng.choice(len(sample), n, replace=False)]
    for _ in range(rounds):
        near = _nearest(sample, centre, 1)[:, 0]
        total, count = np.zeros_like(centre), np.bincount(near, minlength=n)
        np.add.at(total, near, sample)
        full = count > 0
        centre[full] = total[full] / count[full, None]
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest centroids of each row, nearest first; ties to the lower index."""
    out = np.empty((len(x), k), np.int32)
    half = (centre**2).sum(1) / 2
    for at in range(0, len(x), 1024):
        apart = half - x[at : at + 1024] @ centre.T
        out[at : at + 1024] = np.argsort(apart, axis=1, kind="stable")[:, :k] if k > 1 else apart.argmin(1)[:, None]
    return out


def _beyond(z: np.ndarray) -> np.ndarray:
    """The share of a normal distribution above z, by a fixed rational approximation of the error function."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-x * x) / 2
    return np.where(z >= 0, tail, 1 - tail)


def promising(queries: np.ndarray, bound: np.ndarray, centre: np.ndarray, count: np.ndarray, spread: np.ndarray, loss: float) -> np.ndarray:
    """Which lists (queries by lists) to probe so that no more than loss vectors above the bound are expected elsewhere.

    spread: a list's standard deviation along one direction. A bound of -inf asks for all lists.
    """
    size = np.sqrt((queries**2).sum(1))[:, None]
    z = (bound[:, None] - queries @ centre.T) / np.maximum(size * spread, 1e-300)
    hits = count * _beyond(z)
    order = np.argsort(hits, axis=1, kind="stable")
    left = np.cumsum(np.take_along_axis(hits, order, 1), axis=1) <= loss
    out = np.empty(hits.shape, bool)
    np.put_along_axis(out, order, ~left, 1)
    return out


def _apart(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows, queries by candidates."""
    return (q * q).sum(1)[:, None] + (c * c).sum(1) - 2 * (q @ c.T)


def scan(queries: np.ndarray, candidates: np.ndarray, bound: np.ndarray, k: int, block: int, epsilon: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that may be among the k nearest of the query, by partial distances over blocks of columns.

    Both are rotated. A candidate goes when its partial distance, scaled to all dimensions,
    exceeds the query's bound by more than chance allows. Where the bound is infinite it becomes the k-th
    exact distance among those that lead after the first block. slack: rounding that must part no pair.
    """
    m, dims = queries.shape
    if len(candidates) <= 2 * k:
        return np.repeat(np.arange(m), len(candidates)), np.tile(np.arange(len(candidates)), m)
    at, done, bound = np.arange(len(candidates)), min(block, dims), bound.copy()
    part = _apart(queries[:, :done], candidates[:, :done])
    for i in np.flatnonzero(np.isinf(bound)):
        lead = np.argpartition(part[i], 2 * k - 1)[: 2 * k]
        bound[i] = np.partition(((candidates[lead] - queries[i]) ** 2).sum(1), k - 1)[k - 1]
    pairs = None
    while True:
        limit = bound * ((1 + epsilon / np.sqrt(done)) ** 2 * done / dims if done < dims else 1.0) + slack
        if pairs is None:
            alive = part <= limit[:, None]
            if done == dims or np.count_nonzero(alive) < _SPARSE * alive.size:
                q, c = np.nonzero(alive)
                pairs, part = (q, at[c]), part[q, c]
            else:
                part[~alive] = np.inf
                wanted = alive.any(0)
                if np.count_nonzero(wanted) < 0.75 * len(at):
                    at, part = at[wanted], part[:, wanted]
        else:
            alive = part <= limit[pairs[0]]
            pairs, part = (pairs[0][alive], pairs[1][alive]), part[alive]
        if done == dims:
            return pairs
        to = min(done + block, dims)
        if pairs is None:
            part += _apart(queries[:, done:to], candidates[at, done:to])
        else:
            part = part + ((candidates[pairs[1], done:to] - queries[pairs[0], done:to]) ** 2).sum(1)
        done = to


def nearest_neighbours(vectors: DataFrame, every: int = 20, params: AnnParams = AnnParams()) -> DataFrame:
    """query_id, rank, vec_id and score: the params.k vectors of largest inner product found for
    each vector whose vec_id is divisible by every, itself excluded.

    Vectors that are null, zero or hold null or non-finite components take no part. Vectors have an inner
    product only with those of their own length, so each length is searched by itself. Ties go to the smaller vec_id; if a
    vec_id repeats, each of its rows is a candidate, of the others too, and a query with ranks of its own. Fewer
    candidates than k are all given. An empty table gives no rows; other columns are ignored. A score
    that exceeds doubles is infinite.
    """
    # A key of each row, as a vec_id can repeat; settled, so that it stays.
    all_ = settle(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    top = F.max(F.array_max(F.transform("embedding", F.abs)))
    kinds = all_.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n"), top.alias("top"), F.sum((F.pmod("vec_id", F.lit(every)) == 0).cast("long")).alias("asked")).orderBy("dims").collect()
    found = [_searched(all_.where(F.size("embedding") == r["dims"]), r["dims"], r["n"], r["asked"], r["top"], every, params) for r in kinds if r["asked"]]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    met = reduce(DataFrame.unionByName, found)
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k).select("query_id", "rank", "vec_id", "score")


_FOUND = "query_row long, query_id long, vec_id long, score double"


def _searched(all_: DataFrame, dims: int, n: int, queries_n: int, top: float, every: int, p: AnnParams) -> DataFrame:
    """Rows _FOUND with the best of each query in each tile that it met; all vectors have dims components of at most top."""
    spark = all_.sparkSession
    # Powers of two are exact, and keep squares of very large or small components within doubles.
    scale = float(2.0 ** -min(1000, max(-1000, np.ceil(np.log2(top)))))
    longest = float(all_.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x * scale) * (x * scale)))).first()[0])

    def lifted(x: np.ndarray) -> np.ndarray:
        """Candidates, scaled already, with the coordinate that gives all the same length."""
        return np.hstack([x, np.sqrt(np.maximum(0.0, longest - (x**2).sum(1)))[:, None]])

    share = min(1.0, p.sample / n)
    chosen = all_.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("row").select("embedding").limit(2 * p.sample).toArrow()
    fitted = lifted(_matrix(chosen.column(0).combine_chunks()) * scale) if chosen.num_rows else np.zeros((1, dims + 1))
    centre = fit_centroids(fitted, int(min(p.max_lists, max(1, round(n / p.per_list)), len(fitted))), p.seed)
    n_lists, turn = len(centre), np.linalg.qr(np.random.default_rng(p.seed).standard_normal((dims + 1, dims + 1)))[0]
    shared = spark.sparkContext.broadcast((centre, turn))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, _ = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = lifted(_matrix(part.column(1)) * scale)
                near = _nearest(x, centre, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(((x - centre[near]) ** 2).sum(1)), *part.columns], names=["list", "apart", *part.schema.names])

    rows = ["vec_id", "embedding", "row"]
    placed = settle(all_.select(*rows).mapInArrow(place, "list int, apart double, vec_id long, embedding array<double>, row long"), "ann-lists")
    sizes = placed.groupBy("list").agg(F.count("*").alias("n"), F.avg("apart").alias("apart")).toPandas().set_index("list").reindex(range(n_lists), fill_value=0)
    count, spread = sizes["n"].to_numpy(np.int64), np.sqrt(sizes["apart"].to_numpy(np.float64) / dims)
    # Long lists and long queues of queries are cut into tiles; each query meets each tile of the lists that it probes.
    wide = F.element_at(F.lit([max(1, int(-(-x // p.tile))) for x in count]), F.col("list") + 1)
    tall = max(1, -(-queries_n // p.tile))
    spot = F.xxhash64("row")
    columns = ["list", "x", "y", *rows, "bound"]
    held = placed.withColumn("x", F.pmod(spot, wide)).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(tall - 1)))).withColumn("bound", F.lit(None).cast("double")).select(*columns, F.lit(False).alias("asks"))

    def probes(which: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        """A task that repeats each query for each list that which(queries, bounds) marks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    bound = part.column(3).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                    i, near = np.nonzero(which(_matrix(part.column(1)) * scale, bound))
                    yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), *(c.take(pa.array(i)) for c in part.columns)], names=["list", *part.schema.names])

        return run

    def first(x: np.ndarray, _: np.ndarray) -> np.ndarray:
        near = _nearest(np.hstack([x, np.zeros((len(x), 1))]), shared.value[0], min(p.first, n_lists))
        out = np.zeros((len(x), n_lists), bool)
        np.put_along_axis(out, near.astype(np.int64), True, 1)
        return out

    def others(x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return promising(x, bound, shared.value[0][:, :dims], count, spread, p.loss * p.k) & (count > 0) & ~first(x, bound)

    def tile(table: pa.Table) -> pa.Table:
        _, turn = shared.value
        table = table.combine_chunks()
        asks = table.column("asks").to_numpy()
        mine, here = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        out = []
        if mine.num_rows and here.num_rows:
            plain, asked = (_matrix(t.column("embedding").combine_chunks()) for t in (here, mine))
            ids, keys = here.column("vec_id").to_numpy(), here.column("row").to_numpy()
            asked_ids, asked_keys = mine.column("vec_id").to_numpy(), mine.column("row").to_numpy()
            turned = (lifted(plain * scale) @ turn).astype(np.float32)
            size = ((asked * scale) ** 2).sum(1)
            asked_turned = (np.hstack([asked * scale, np.zeros((len(asked), 1))]) @ turn).astype(np.float32)
            least = mine.column("bound").fill_null(-np.inf).combine_chunks().to_numpy(zero_copy_only=False)
            bound = (size + longest - 2 * least).astype(np.float32)
            slack = np.float32(_ROUND * (longest + size.max()))
            for at in range(0, len(asked), _GROUP):
                q, c = scan(asked_turned[at : at + _GROUP], turned, bound[at : at + _GROUP], p.k + 1, p.block, p.epsilon, slack)
                q = q + at
                other = keys[c] != asked_keys[q]
                q, c = q[other], c[other]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (plain[c] * asked[q]).sum(1)
                order = np.lexsort((ids[c], -score, q))
                q, c, score = q[order], c[order], score[order]
                best = np.arange(len(q)) - np.searchsorted(q, q) < p.k
                out.append((asked_keys[q[best]], asked_ids[q[best]], ids[c[best]], score[best]))
        merged = [np.concatenate([o[i] for o in out]) if out else np.empty(0, np.float64 if i == 3 else np.int64) for i in range(4)]
        return pa.table(merged, names=["query_row", "query_id", "vec_id", "score"])

    def scanned(asks: DataFrame) -> DataFrame:
        asks = asks.withColumn("y", F.pmod(spot, F.lit(tall)).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), wide.cast("long") - 1))).select(*columns, F.lit(True).alias("asks"))
        return held.unionByName(asks).groupBy("list", "x", "y").applyInArrow(tile, _FOUND)

    schema = "list int, vec_id long, embedding array<double>, row long, bound double"
    asked = all_.where(F.pmod("vec_id", F.lit(every)) == 0).select(*rows)
    near = settle(scanned(asked.withColumn("bound", F.lit(None).cast("double")).mapInArrow(probes(first), schema)), "ann-first")
    if n_lists <= p.first:
        return near
    # The k-th best so far, on the scaled vectors; a query with fewer finds has no bound and probes every list.
    top_k = F.sort_array(F.collect_list("score"), asc=False)
    bounds = near.groupBy(F.col("query_row").alias("row")).agg(F.get(top_k, F.lit(p.k - 1)).alias("bound"))
    scaled = F.when(F.abs("bound") != float("inf"), F.col("bound") * F.lit(scale) * F.lit(scale))
    far = asked.join(bounds, "row", "left").select(*rows, scaled.alias("bound"))
    return near.unionByName(scanned(far.mapInArrow(probes(others), schema)))
