"""Sharding by longest-processing-time scheduling.

Groups that must stay together are sorted by size and each goes to the least-loaded shard
through a heap. Groups of one size are exchangeable, so the heap is worked by classes: the
driver gets a row for each distinct size with the number of its groups, and finds at once how
many of them each shard takes. Different sizes add up to the whole, so there are at most
sqrt(2 * all bytes) of them, 14 million for 100 TB.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmesh.llm.shared import settle

#: Rows, or groups of one size, are numbered in parts of about 1/CELLS of all; fewer than 2 * CELLS counts reach the driver.
CELLS = 2048
#: Classes of fewer groups than this go through the heap one by one.
_FEW = 4


def shares(load: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of count equal groups each shard takes, one after the other to the least load, then the lowest shard.

    Shard s takes its groups at loads load[s], load[s] + size, ...; the count least of all these, by load and shard, are taken.
    """
    size = max(size, 1)
    low, high = int(load.min()), int(load.min()) + size * count
    while low < high:  # the least load up to which count groups are taken
        level = (low + high) // 2
        if int(np.maximum(0, (level - load) // size + 1).sum()) >= count:
            high = level
        else:
            low = level + 1
    taken = np.maximum(0, (low - 1 - load) // size + 1)
    at_level = np.flatnonzero((load <= low) & ((low - load) % size == 0))
    taken[at_level[: count - int(taken.sum())]] += 1
    return taken


def scheduled(sizes: np.ndarray, counts: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Loads of the shards after all classes, largest size first, and (classes, shards) ends: class i's groups from ends[i, s - 1] on, and before ends[i, s], go to shard s."""
    load, out = np.zeros(n_shards, np.int64), np.zeros((len(sizes), n_shards), np.int64)
    heap: list[tuple[int, int]] = [(0, s) for s in range(n_shards)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, count = int(sizes[i]), int(counts[i])
        if count < _FEW:
            for _ in range(count):
                now, shard = heap[0]
                heapq.heapreplace(heap, (now + size, shard))
                out[i, shard] += 1
        else:
            for now, shard in heap:
                load[shard] = now
            out[i] = shares(load, size, count)
            heap = [(int(now), s) for s, now in enumerate(load + out[i] * size)]
            heapq.heapify(heap)
    for now, shard in heap:
        load[shard] = now
    return load, np.cumsum(out, axis=1)


def _numbered(df: DataFrame, by: str, spot: Column, order: list[str], total: int) -> DataFrame:
    """Adds nth, gapless from 0 in each group of by, by part and order. Large groups are numbered in parts that spot deals out, so that no task gets a whole one."""
    parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.count("*") * F.lit(CELLS / max(1, total))))
    large = df.groupBy(by).agg(F.count("*").alias("n"), parts.alias("parts")).where("parts > 1").select(by, "parts")
    known = large.toPandas()
    if known.empty:
        part = df.withColumn("part", F.lit(0).cast("long")).withColumn("start", F.lit(0).cast("long"))
    else:  # fewer than CELLS groups have several parts
        spark = df.sparkSession
        kind = df.schema[by].dataType.simpleString()
        known = spark.createDataFrame(known, f"{by} {kind}, parts long")
        part = settle(df.join(F.broadcast(known), by, "left").withColumn("part", F.pmod(spot, F.coalesce("parts", F.lit(1)))).drop("parts"), "shard-parts")
        sizes = part.join(F.broadcast(known), by, "left_semi").groupBy(by, "part").agg(F.count("*").alias("n")).toPandas().sort_values([by, "part"], ignore_index=True)
        sizes["start"] = sizes.groupby(by)["n"].cumsum() - sizes["n"]
        starts = spark.createDataFrame(sizes[[by, "part", "start"]], f"{by} {kind}, part long, start long")
        part = part.join(F.broadcast(starts), [by, "part"], "left")
    row = F.row_number().over(Window.partitionBy(by, "part").orderBy(*order))
    return part.withColumn("nth", F.coalesce("start", F.lit(0).cast("long")) + row - 1).drop("start", "part")


def assign_shards(docs: DataFrame, n_shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for each row of docs.

    size: UTF-8 bytes of the text plus overhead; a null text counts as an empty one and shares
    its group. Rows with equal texts share a shard, which also holds for repeated rows; each
    row has a slot of its own, without gaps from 0 in each shard, ties in order of doc_id. law is
    ``bytes`` (sizes near equal), so grown_shard is null: shards differ by no more than the largest group. Very long texts
    are only hashed. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("key"),
    )
    rows = settle(rows, "shard-rows")
    groups = settle(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    classes = groups.groupBy("bytes").agg(F.count("*").alias("n")).toPandas().astype("int64").sort_values("bytes", ignore_index=True)
    _, ends = scheduled(classes["bytes"].to_numpy(), classes["n"].to_numpy(), n_shards)

    # A class of one group has one shard; the groups of the others are numbered, and a class's ends tell their shards.
    single = (classes["n"] == 1).to_numpy()
    alone = pd.DataFrame({"bytes": classes["bytes"][single], "only": (ends[single] > 0).argmax(1)})
    several = [(int(b), e.tolist()) for b, e in zip(classes["bytes"][~single], ends[~single], strict=True)]
    alone = settle(spark.createDataFrame(alone, "bytes long, only int"), "shard-alone")
    several = settle(spark.createDataFrame(several, "bytes long, ends array<long>"), "shard-classes")
    first = groups.join(alone, "bytes").select("key", F.col("only").alias("shard"))
    numbered = _numbered(groups.join(several, "bytes", "left_semi"), "bytes", F.xxhash64("key"), ["key"], int(classes["n"].sum()))
    rest = numbered.join(several, "bytes").select("key", F.size(F.filter("ends", lambda e: e <= F.col("nth"))).alias("shard"))
    placed = settle(rows.join(first.unionByName(rest), "key").select("doc_id", "size", "text_crc32", "shard"), "shard-placed")
    out = _numbered(placed, "shard", F.xxhash64("doc_id", "text_crc32"), ["doc_id", "text_crc32"], placed.count())
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("nth").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
