"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams, one to three letters with word edges, by
rank. A text goes to the language whose profile has the smallest out-of-place distance to
the text's own list of most frequent n-grams.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmesh.llm.shared import lean


@dataclass(frozen=True)
class LangParams:
    """max_docs: bound, for each language, on the documents whose n-grams are counted for its profile.

    top: length of the profiles and of a text's list.
    """

    max_docs: int = 1500
    top: int = 400


_PIECE = 1 << 20


@functools.cache
def _classes() -> np.ndarray:
    """Code point to itself in lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as 63-bit codes, and their counts; runs of other characters are one word edge.

    Very long texts are counted in pieces of about a million characters that end at word edges, so that counts
    are those of the whole text and memory follows the number of distinct n-grams; a single word is never cut.
    """
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    at = 0
    while at < len(text):
        to = min(len(text), at + _PIECE)
        while to < len(text) and text[to].isalpha():
            to += 1
        k, c = _piece_counts(text[at:to])
        if len(keys) and len(k):
            # The edge between two pieces with letters is one of the whole text: no n-gram spans it but the word's own.
            both = np.concatenate([keys, k])
            keys, where = np.unique(both, return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, c])).astype(np.int64)
        elif len(k):
            keys, counts = k, c
        at = to
    return keys, counts


def _piece_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    code = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    if not code.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.concatenate([[0], code, [0]])
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    c = code[keep]
    two = (c[:-1] << 21) | c[1:]
    three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[c[1:-1] != 0]
    one = c[c != 0]
    return np.unique(np.concatenate([one, two | (1 << 20), three]), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The top most frequent n-grams, most frequent first; ties to the smaller code."""
    if len(keys) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        near = counts >= least
        keys, counts = keys[near], counts[near]
    return keys[np.lexsort((keys, -counts))][:top]


class Profiles:
    """The learned profiles as one sorted table of n-grams with their rank in each language."""

    def __init__(self, ranks: dict[str, np.ndarray], top: int):
        self.langs, self.top = sorted(ranks), top
        self.grams = np.unique(np.concatenate([ranks[x] for x in self.langs])) if self.langs else np.empty(0, np.int64)
        self.rank = np.full((len(self.grams), len(self.langs)), -1, np.int32)
        for j, x in enumerate(self.langs):
            self.rank[np.searchsorted(self.grams, ranks[x]), j] = np.arange(len(ranks[x]))

    def closest(self, text: str) -> tuple[str, float]:
        """The nearest language and the lead, relative to the next, as a score from 0 to 1."""
        mine = ranked(*gram_counts(text), self.top)
        if not len(mine) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.grams, mine)
        at[at == len(self.grams)] = 0
        found = self.grams[at] == mine
        rank = self.rank[at]
        apart = np.abs(rank - np.arange(len(mine))[:, None])
        apart[(rank < 0) | ~found[:, None]] = self.top
        total = apart.sum(0, dtype=np.int64)
        order = np.lexsort((np.arange(len(total)), total))
        best = int(order[0])
        near = 1.0 - total[best] / (self.top * len(mine))
        if len(total) == 1:
            return self.langs[best], float(near)
        lead = 1.0 - total[best] / max(1, total[order[1]])
        return self.langs[best], float(min(1.0, max(0.0, lead)))


def fit_profiles(docs: DataFrame, params: LangParams = LangParams()) -> Profiles:
    """Profiles from the text and lang of rows whose crc32(doc_id as text) mod 4 is not 2.

    For each language about max_docs rows at most, chosen by a hash of the id, are counted;
    the counts of n-grams are summed by Spark and only the top of each language's list reaches
    the driver. Rows with null lang or text teach nothing.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Profiles({}, params.top)
    share = F.lit(0)
    for lang, n in sorted(sizes.items()):
        share = F.when(F.col("lang") == lang, F.lit(int(min(1.0, params.max_docs / n) * (1 << 20)))).otherwise(share)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for at in range(0, len(langs), 256):
                texts = batch.column(1).slice(at, 256)
                for lang in sorted(set(langs[at : at + 256])):
                    mine = np.flatnonzero(langs[at : at + 256] == lang)
                    keys, counts = gram_counts("\n".join(texts[int(i)].as_py() for i in mine))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"])

    total = chosen.mapInArrow(lean(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranks = {}
    for lang in sorted(sizes):
        best = total.where(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(params.top) if len(sizes) == 1 else None
        if best is not None:
            ranks[lang] = best.toPandas()["gram"].to_numpy(np.int64)
    if len(sizes) > 1:
        from pyspark.sql import Window

        first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        got: pd.DataFrame = total.withColumn("r", first).where(F.col("r") <= params.top).toPandas()
        ranks = {lang: part.sort_values("r")["gram"].to_numpy(np.int64) for lang, part in got.groupby("lang")}
    return Profiles(ranks, params.top)


def predict_language(docs: DataFrame, profiles: Profiles, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row of docs to doc_id, held_out, lang_pred, score and the columns named in keep.

    One row for each input row, repeats included. lang_pred is ``und`` with score 0 for null
    texts and texts without a letter, and where nothing was learned. Ties go to the language
    that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    rest = [x for x in keep if x != "doc_id"]
    given = docs.select("doc_id", "text", *[x for x in rest if x != "text"])
    names = ["doc_id", *rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.closest(x.as_py() or "") for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in names] + [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"`{x}` {docs.schema[x].dataType.simpleString()}" for x in names) + ", lang_pred string, score double"
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return given.mapInArrow(lean(run), schema).select("doc_id", *rest, F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
