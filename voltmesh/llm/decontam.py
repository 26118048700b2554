"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts are hashed as runs of SHORT words; of each stretch of WINDOW - SHORT + 1 such hashes only
the least is kept, so any span of WINDOW words that a document shares with an item also
shares a kept hash at the same place. Kept hashes of documents and items are joined, and matches
are extended: around the places of the hashes that match, merged where they are near, the
document's windows are joined with those of the items, word by word. Items of fewer words than
WINDOW are matched by hashes of their whole length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmesh.llm.shared import gathered, settle

WINDOW = 10
SHORT = 4
#: Fingerprints of the items are broadcast if they are no more, and so are their windows, about 100 bytes each.
BROADCAST_ROWS = 200_000
#: Ids of documents with matches are broadcast, with the hashes that match, if there are no more documents and no more hashes, at most 100 MB; beyond, texts are shuffled to them.
BROADCAST_DOCS, BROADCAST_HASHES = 500_000, 4_000_000
_MARK = -1


def words_of(text: Column) -> Column:
    """The words of a text: A-Z in lower case, runs of digits, letters and characters beyond ASCII."""
    text = F.coalesce(text, F.lit(""))
    between = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    # lower() also changes capitals beyond ASCII, and translate() is slow on whole texts, so texts with such capitals go word by word.
    ascii_only = F.octet_length(text) == F.char_length(text)
    split = F.when(
        ascii_only | ~text.rlike(r"[\p{javaUpperCase}\p{Lt}&&[^A-Z]]"), F.split(F.lower(text), between)
    ).otherwise(
        F.transform(F.split(text, between), lambda x: F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    )
    return F.array_remove(split, "")


def _tail(a: Column, by: int) -> Column:
    """a without its first elements."""
    return F.slice(a, F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0)))


def _head(a: Column, by: int) -> Column:
    """a without its last elements."""
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - by, F.lit(0)))


def _pairs(a: Column, b_by: int, f) -> Column:
    """f of each element and the one b_by later."""
    return F.zip_with(_head(a, b_by), _tail(a, b_by), f)


def _doubled(df: DataFrame, first: str, n: int, out: str, f) -> tuple[DataFrame, str]:
    """Adds a column with f over each n neighbours in column first, by doubling, and names it."""
    done, now = 1, first
    while done < n:
        step = min(done, n - done)
        df = df.withColumn(f"{out}{done + step}", _pairs(F.col(now), step, f))
        now, done = f"{out}{done + step}", done + step
    return df, now


def fingerprints(df: DataFrame, lengths: list[int]) -> tuple[DataFrame, dict[int, tuple[str, str]]]:
    """Adds, for the array of words w, columns with the hashes of all runs and the kept ones; names them by length.

    Length WINDOW stands for runs of SHORT words, winnowed; each shorter length in lengths for
    runs of that length, all of them kept.
    """
    df, names = df.withColumn("_h", F.transform("w", lambda x: F.xxhash64(x))), {}
    for n in sorted(lengths):
        df, runs = _doubled(df, "_h", SHORT if n == WINDOW else n, f"_r{n}x", lambda a, b: F.xxhash64(a, b))
        kept = runs
        if n == WINDOW:
            df, kept = _doubled(df, runs, WINDOW - SHORT + 1, "_m", lambda a, b: F.least(a, b))
        names[n] = (runs, kept)
    return df, names


def _flagged(runs: Column, fps: Column) -> Column:
    """Which runs are among some fingerprints."""
    return F.transform(runs, lambda x: F.array_contains(fps, x))


def _item_tables(item: DataFrame, lengths: list[int]) -> tuple[DataFrame, DataFrame]:
    """(fp) of the kept hashes of all items, and (len, window, item_id) of their windows, each once."""
    df, names = fingerprints(item, lengths)
    size = F.least(F.size("w"), F.lit(WINDOW))
    kept = F.lit(None).cast("array<bigint>")
    for n, (_, column) in names.items():
        kept = F.when(size == n, F.col(column)).otherwise(kept)
    cut = lambda i: F.array_join(F.slice("w", i + 1, size), " ")
    windows = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("w") - size), cut))
    windows = item.select("item_id", size.alias("len"), F.explode(windows).alias("window")).distinct()
    return df.select(F.explode(kept).alias("fp")).distinct(), windows


def _spot(n: int):
    """(len, at, window) of the n words at a place that is flagged, else null."""
    return lambda flag, i: F.when(flag, F.struct(F.lit(n).alias("len"), i.alias("at"), F.array_join(F.slice("w", i + 1, F.lit(n)), " ").alias("window")))


def _few(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def find_leaks(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """For each document: doc_id, n_words, hits (sorted places of the words hit, from 0) and items (ids, sorted as strings).

    A window is WINDOW consecutive words of an item, or all words of a shorter one; a document's
    word inside any occurrence of a window is hit. Null and empty texts have no words and no
    hits, items without words match nothing. Rows of docs that share a doc_id, null among them, count as one
    document: n_words of the longest, hits and items of all. Repeated items count once; other
    columns are ignored. Work follows the number of words also where a text or an item repeats itself.
    """
    key = docs.schema["doc_id"].dataType
    item = settle(gathered(items.select(F.col("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0).distinct(), items.count()), "leak-items")
    words = {r["n"]: r["words"] for r in item.groupBy(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).agg(F.sum(F.size("w")).alias("words")).collect()}
    lengths = sorted(words)
    known, windows = (settle(gathered(x, sum(words.values())), f"leak-{name}") for x, name in zip(_item_tables(item, lengths), ("prints", "windows"), strict=True))

    # The documents' kept hashes against the items'. A mark that every document has carries n_words along. explode_outer, since for explode Spark
    # would add a filter on the array's size and compute all of the above twice.
    found, names = fingerprints(docs.select("doc_id", words_of(F.col("text")).alias("w")), lengths)
    kept = F.array_distinct(F.concat(F.array(F.lit(_MARK)).cast("array<bigint>"), *(F.col(kept) for _, kept in names.values())))
    found = found.select("doc_id", F.size("w").alias("n_words"), F.explode_outer(kept).alias("fp"))
    marked = known.unionByName(docs.sparkSession.range(1).select(F.lit(_MARK).cast("long").alias("fp"))).distinct()
    if _few(known, broadcast_rows):
        hit = found.join(F.broadcast(marked), "fp")
    else:  # A hash that very many documents share makes a skewed partition, which adaptive execution splits; the mark is no row of the join.
        hit = found.where(F.col("fp") != _MARK).join(known, "fp").unionByName(found.where(F.col("fp") == _MARK), allowMissingColumns=True)
    prints = F.collect_set(F.when(F.col("fp") != _MARK, F.col("fp")))
    marks = settle(gathered(hit.groupBy("doc_id").agg(F.max("n_words").cast("long").alias("n_words"), prints.alias("fps"))), "leak-marks")

    # Matches are extended: around each, the windows of the document that hold it are compared word by word with those of the items.
    met = marks.where(F.size("fps") > 0).select(F.col("doc_id").alias("_id"), "fps")
    size = met.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("fps")), F.lit(0)).alias("hashes")).first()
    if size["docs"] <= BROADCAST_DOCS and size["hashes"] <= BROADCAST_HASHES:
        met = F.broadcast(met)
    near, names = fingerprints(docs.select("doc_id", "text").join(met, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "fps", words_of(F.col("text")).alias("w")), lengths)
    spots = [F.array().cast("array<struct<len:int,at:int,window:string>>")]
    for n, (runs, _) in names.items():
        near, flags = _doubled(near.withColumn(f"_f{n}", _flagged(F.col(runs), F.col("fps"))), f"_f{n}", WINDOW - SHORT + 1 if n == WINDOW else 1, f"_f{n}x", lambda a, b: a | b)
        spots.append(F.filter(F.transform(F.col(flags), _spot(n)), lambda x: x.isNotNull()))
    near = near.select("doc_id", F.explode(F.concat(*spots)).alias("s")).groupBy("doc_id", "s.len", "s.window").agg(F.collect_set("s.at").alias("at"))
    every = windows.select("len", "window").distinct()
    same = settle(gathered(near.join(F.broadcast(every) if _few(every, broadcast_rows) else every, ["len", "window"])), "leak-hits")
    # Places of one document, and ids of the items that one document meets: as long as its row of the result.
    places = F.flatten(F.collect_list(F.transform("at", lambda i: F.struct(i.alias("at"), F.col("len").alias("len")))))
    words = F.array_sort(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["at"], p["at"] + p["len"] - 1)))))
    hits = same.groupBy(F.col("doc_id").alias("_id")).agg(places.alias("places")).select("_id", words.alias("hits"))
    of = same.select(F.col("doc_id").alias("_id"), "len", "window").join(windows, ["len", "window"]).groupBy("_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    out = marks.select("doc_id", "n_words")
    for part in (hits, of):
        part = part.withColumn("_id", F.col("_id").cast(key))
        out = out.join(part, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return gathered(out).select("doc_id", "n_words", F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def leak_report(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """find_leaks() with its lists as counts and a digest."""
    return find_leaks(docs, items, broadcast_rows).select(
        "doc_id", "n_words",
        F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )
