"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader updates and applied as sparse dot products.

Words are what white space separates. Features are the distinct runs of one to three words,
hashed to ``bits`` bits, and once more those that occur twice, four and eight times at least in the
text; a text's feature vector has unit length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmesh.llm.shared import lean
from voltmesh.llm.words import SPACES, hashed_words, mix


@dataclass(frozen=True)
class QualityParams:
    """bits: log2 of the number of weights, so a model has at most 2^bits numbers.

    max_rows: bound on the labelled rows that are fitted, chosen by a hash of the id.
    """

    bits: int = 18
    max_rows: int = 6000
    epochs: int = 3
    alpha: float = 5.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    threshold: float = 0.3


#: Words in a run at most, and numbers of occurrences from which a run is a feature of its own.
LONGEST, OFTEN = 3, (2, 4, 8)


def features(words: np.ndarray, bits: int) -> np.ndarray:
    """Distinct hashed features of one text's words, sorted. An empty text has one of its own."""
    if not len(words):
        return np.array([(1 << bits) - 1], np.int64)
    runs = [words]
    for k in range(1, min(LONGEST, len(words))):
        runs.append(mix(runs[-1][:-1] * np.uint64(0xD6E8FEB86659FD93) + words[k:]))
    found, n = np.unique(np.concatenate(runs), return_counts=True)
    every = [found, *(mix(found[n >= least] + np.uint64(least)) for least in OFTEN)]
    return np.unique(np.concatenate(every) >> np.uint64(64 - bits)).astype(np.int64)


def text_features(column: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """features() of each text of a column, in order; null counts as empty."""
    for _, words, offsets in hashed_words(column, SPACES):
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            yield features(words[a:b], bits)


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray, params: QualityParams) -> tuple[np.ndarray, float]:
    """Weights and bias after FTRL-proximal passes over the rows in a fixed shuffled order."""
    size = 1 << params.bits
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    bias_z = bias_n = bias = 0.0
    rng = np.random.default_rng(7)
    for _ in range(params.epochs):
        for i in rng.permutation(len(rows)):
            f = rows[i]
            x = 1.0 / np.sqrt(len(f))
            p = 1.0 / (1.0 + np.exp(-np.clip(w[f].sum() * x + bias, -35, 35)))
            g = (p - labels[i]) * x
            old = n[f]
            new = old + g * g
            z[f] += g - (np.sqrt(new) - np.sqrt(old)) / params.alpha * w[f]
            n[f] = new
            zf = z[f]
            w[f] = np.where(np.abs(zf) <= params.l1, 0.0, -(zf - np.sign(zf) * params.l1) / ((params.beta + np.sqrt(new)) / params.alpha + params.l2))
            gb = p - labels[i]
            grown = bias_n + gb * gb
            bias_z += gb - (np.sqrt(grown) - np.sqrt(bias_n)) / params.alpha * bias
            bias_n = grown
            bias = -bias_z / ((params.beta + np.sqrt(bias_n)) / params.alpha)
    return w, bias


def _fitted_rows(docs: DataFrame, labels: DataFrame, params: QualityParams) -> DataFrame:
    """Labelled documents for fitting, max_rows of them at most in expectation, by a hash of the id."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_y")).where("_y is not null and _id is not null")
    known = known.where(F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(5)) != 0)
    share = min(1.0, params.max_rows / max(1, known.count()))
    kept = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select(F.col("doc_id").alias("_d"), F.col("text").alias("_t")).join(kept, F.col("_d") == F.col("_id"))


def fit_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> tuple[np.ndarray, float]:
    """Fits on the text and label of rows whose crc32(doc_id as text) mod 5 is not 0.

    All hashed features of a text are fitted; those of about max_rows texts reach the driver, at most
    2^bits numbers each, whatever the size of the corpus. Without any labelled row all weights are 0. A doc_id with
    several labels counts once for each; other columns are ignored.
    """
    bits = params.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                packed = [f.astype("<u4").tobytes() for f in text_features(part.column(1), bits)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary()), part.column(2)], names=["_d", "f", "y"])

    got = _fitted_rows(docs, labels, params).select("_d", "_t", "_y").mapInArrow(lean(run), "_d long, f binary, y double").orderBy("_d", "y", "f").toArrow()
    rows = [np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in got.column("f")]
    return fit_ftrl(rows, got.column("y").to_numpy(), params)


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], params: QualityParams = QualityParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row of docs to doc_id, held_out, score, predicted and the columns named in keep.

    One row for each input row, repeats included. Null and empty texts get the score of the
    empty text's own feature. Score is the estimated probability of label 1; predicted is 1
    from params.threshold on.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model[0].astype(np.float32), float(model[1])))
    bits, threshold = params.bits, params.threshold
    rest = [x for x in keep if x != "doc_id"]
    given = docs.select("doc_id", "text", *[x for x in rest if x != "text"])
    names = ["doc_id", *rest, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = shared.value
        for batch in batches:
            scores = [1.0 / (1.0 + np.exp(-np.clip(w[f].sum(dtype=np.float64) / np.sqrt(len(f)) + bias, -35, 35))) for f in text_features(batch.column(1), bits)]
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in names[:-1]] + [pa.array(scores, pa.float64())], names=names)

    schema = ", ".join(f"`{x}` {docs.schema[x].dataType.simpleString()}" for x in names[:-1]) + ", score double"
    out = given.mapInArrow(lean(run), schema)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return out.select("doc_id", *rest, F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
