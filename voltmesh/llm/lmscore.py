"""Language-model scoring by masked pseudo-likelihood.

A bidirectional window network predicts each token from the tokens on both its sides; the
sum of the conditional log-probabilities scores a document. Word counts over all documents
give the vocabulary and the network's starting biases. Tasks train it with numpy: first on a
share of the documents, then on all; each time from the same weights, and their changes are averaged.
A part of the tokens, drawn anew in each run, is masked for training; all others stand around them. The
output is factored into classes of words and words within a class, so that a token costs two
short softmaxes. Words beyond the network's ids share its id 0, and each has its share of it
by its count over all documents; the rarest, beyond a table that tasks hold, by their mean count.

What the corpus repeats corrects the network: texts are cut into segments of a few words at
places that the words themselves choose, segments are counted, with the words on both their
sides, over all documents, and a segment's probability is a mixture of the network's and of the share of
its other occurrences.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmesh.llm.shared import settle
from voltmesh.llm.words import LONG_RUN_BYTES, NOT_ALNUM, hashed_words, mix, ranges_hashed


@dataclass(frozen=True)
class LmParams:
    """side * side ids: the most frequent words of the corpus, and id 0 for all others.

    early: one in so many texts, by their hash, gives the starting weights; all texts train them then.
    masked: share of the tokens of a text that training predicts in one run, at least least of them.
    step: tokens to a step, or fewer where a run of texts has few. table bounds the words whose counts each task
    holds, hot the segments, the most frequent ones; all others are joined.
    cut: words to a segment on average, a power of two. repeats: the mixture's weight of repeated segments.
    """

    side: int = 64
    reach: int = 2
    dim: int = 24
    early: int = 8
    masked: float = 0.3
    step: int = 8192
    least: int = 256
    table: int = 500_000
    hot: int = 20_000
    cut: int = 16
    repeats: float = 0.1
    rate: float = 0.15
    seed: int = 5

    @property
    def size(self) -> int:
        return self.side * self.side


_ONE = 1 << 40


def segments(words: np.ndarray, offsets: np.ndarray, p: LmParams) -> tuple[np.ndarray, np.ndarray]:
    """First position of each segment and its 63-bit hash, that of up to reach words around it included.

    A segment ends after a word whose hash says so, or with its text.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins = np.zeros(n + 1, bool)
    begins[1:] = (mix(words) & np.uint64(p.cut - 1)) == 0
    begins[offsets] = True
    starts = np.flatnonzero(begins[:n])
    ends = np.append(starts[1:], n)
    text = np.searchsorted(offsets, starts, "right") - 1
    first, last = np.maximum(starts - p.reach, offsets[text]), np.minimum(ends + p.reach, offsets[text + 1])
    shape = ((ends - starts) * 64 + (starts - first) * 8 + (last - ends)).astype(np.uint64)
    return starts, (mix(ranges_hashed(words, first, last) + mix(shape)) >> np.uint64(1)).astype(np.int64)


def corpus_counts(docs: DataFrame, p: LmParams = LmParams()) -> DataFrame:
    """(segment, word, n): hash and number of each word, and of each segment that occurs more than once, over all texts. Runs are summed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, offsets in hashed_words(batch.column(0), NOT_ALNUM, LONG_RUN_BYTES):
                for segment, found in ((False, words.view(np.int64)), (True, segments(words, offsets, p)[1])):
                    keys, n = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), segment)), pa.array(keys), pa.array(n)], names=["segment", "word", "n"])

    return docs.select("text").mapInArrow(run, "segment boolean, word long, n long").groupBy("segment", "word").agg(F.sum("n").alias("n")).where("not segment or n > 1")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hash and number of each word over all texts."""
    return corpus_counts(docs).where("not segment").select("word", "n")


class Held:
    """Counts by key, to be looked up in a task."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 where it is not held."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.n[at], 0)


class Vocabulary:
    """Ids of the most frequent words by rank from 1; 0 stands for every other word, which has its count's share of it.

    words and counts go by rank, and those beyond size - 1 are held only for their counts; total and
    distinct are the numbers of words and of different ones in the corpus. Words that are not held, and one more for
    all that the corpus lacks, share alike what is left.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int, size: int):
        self.more = Held(words[size - 1 :], counts[size - 1 :])
        left, kinds = total - counts.sum(), distinct - len(words)
        words, counts = words[: size - 1], counts[: size - 1]
        self.whole = np.log(total - counts.sum() + distinct - len(words) + 1.0)
        self.rest = np.log((left + kinds + 1.0) / (kinds + 1.0))
        self.known = Held(words, np.arange(1, len(words) + 1))
        self.counts = np.ones(size)
        self.counts[1 : len(counts) + 1] += counts
        self.counts[0] += total - counts.sum()

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.known.of(hashes.view(np.int64)).astype(np.int32)

    def shares(self, hashes: np.ndarray) -> np.ndarray:
        """Log of the share of id 0 of each word beyond the ids."""
        n = self.more.of(hashes.view(np.int64))
        return np.where(n > 0, np.log1p(n), self.rest) - self.whole


#: The network's weights, and for each the sums of squared gradients that its steps are scaled by.
WEIGHTS = ("embed", "to_class", "class_bias", "to_word", "word_bias")


class WindowNetwork:
    """Predicts a token from reach tokens on each side: tanh of summed embeddings, then class and word."""

    def __init__(self, vocabulary: Vocabulary, p: LmParams):
        self.p, self.vocabulary = p, vocabulary
        rng = np.random.default_rng(p.seed)
        side, dim = p.side, p.dim
        share = vocabulary.counts.reshape(side, side)
        f = np.float32
        self.weights = {
            "embed": (rng.standard_normal((2 * p.reach, p.size + 1, dim)) * 0.1).astype(f),
            "to_class": (rng.standard_normal((dim, side)) * 0.05).astype(f),
            "class_bias": np.log(share.sum(1) / share.sum()).astype(f),
            "to_word": (rng.standard_normal((side, dim, side)) * 0.05).astype(f),
            "word_bias": np.log(share / share.sum(1, keepdims=True)).astype(f),
        }
        self.squares = {x: np.full_like(w, 1e-3) for x, w in self.weights.items()}
        #: Places of a token's neighbours.
        self.around = [*range(-p.reach, 0), *range(1, p.reach + 1)]
        self.hot = Held(np.empty(0, np.int64), np.empty(0, np.int64))
        #: (word, n) of the repeated segments that are not held.
        self.repeated: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"repeated": None}

    def rows(self, values: dict[str, np.ndarray], name: str) -> np.ndarray:
        """Weights or squares as rows that are averaged by themselves: one for each context word, class, or all of them."""
        return values[name].reshape({"embed": (-1, self.p.dim), "to_word": (self.p.side, -1), "word_bias": (self.p.side, -1)}.get(name, (1, -1)))

    def laid(self, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a run of texts with the id after the vocabulary between texts, and the places of the tokens in that."""
        at = np.arange(len(tokens)) + self.p.reach * (1 + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)))
        padded = np.full(len(tokens) + self.p.reach * len(offsets), self.p.size, np.uint16 if self.p.size < 1 << 16 else np.int32)
        padded[at] = tokens
        return padded, at

    def _hidden(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        embed = self.weights["embed"]
        out = embed[0][padded[at + self.around[0]]]
        for j, by in enumerate(self.around[1:], 1):
            out += embed[j][padded[at + by]]
        return np.tanh(out, out=out)

    def _by_class(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Order of tokens by id, their classes and words in that order, and (class, from, to) of the classes among them."""
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order].astype(np.int64)
        bounds = np.searchsorted(ranked, np.arange(self.p.side + 1) * self.p.side)
        return order, ranked // self.p.side, ranked % self.p.side, [(c, a, b) for c, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if a < b]

    def _word_scores(self, h: np.ndarray, kind: np.ndarray, classes: list[tuple[int, int, int]]) -> np.ndarray:
        out = self.weights["word_bias"][kind]
        for c, a, b in classes:
            out[a:b] += h[a:b] @ self.weights["to_word"][c]
        return out

    def log_probability(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the token at each of the places, given those around it."""
        order, kind, word, classes = self._by_class(padded[at])
        h, rows = self._hidden(padded, at)[order], np.arange(len(at))
        total = np.zeros(len(at))
        for x, chosen in ((h @ self.weights["to_class"] + self.weights["class_bias"], kind), (self._word_scores(h, kind, classes), word)):
            np.clip(x, -30, 30, out=x)
            total += x[rows, chosen]
            total -= np.log(np.exp(x, out=x).sum(1, dtype=np.float64))
        out = np.empty(len(at))
        out[order] = total
        return out

    def _step(self, name: str, gradient: np.ndarray, where=slice(None)) -> None:
        square, value = self.squares[name], self.weights[name]
        new = square[where] + gradient * gradient
        square[where] = new
        value[where] -= self.p.rate * gradient / np.sqrt(new)

    def learn(self, padded: np.ndarray, at: np.ndarray) -> None:
        """One Adagrad step on the tokens at some places."""
        n, rows, weights = len(at), np.arange(len(at)), self.weights
        order, kind, word, classes = self._by_class(padded[at])
        h = self._hidden(padded, at)[order]

        def blame(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
            """The gradient of the mean loss by the scores x."""
            np.exp(np.clip(x, -30, 30, out=x), out=x)
            x /= x.sum(1, keepdims=True)
            x[rows, chosen] -= 1
            x /= n
            return x

        g = blame(h @ weights["to_class"] + weights["class_bias"], kind)
        back = g @ weights["to_class"].T
        self._step("to_class", h.T @ g)
        self._step("class_bias", g.sum(0))
        g = blame(self._word_scores(h, kind, classes), word)
        by_word, by_bias = np.zeros_like(weights["to_word"]), np.zeros_like(weights["word_bias"])
        for c, a, b in classes:
            back[a:b] += g[a:b] @ weights["to_word"][c].T
            by_word[c], by_bias[c] = h[a:b].T @ g[a:b], g[a:b].sum(0)
        self._step("to_word", by_word)
        self._step("word_bias", by_bias)
        back *= 1 - h * h
        h[order] = back
        for j, by in enumerate(self.around):
            near = padded[at + by]
            by_id = np.argsort(near, kind="stable")
            near = near[by_id]
            first = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
            self._step("embed", np.add.reduceat(h[by_id], first, axis=0), (j, near[first]))


#: Rows of weights, and tasks, that are summed together.
_SLICE, _GROUP = 128, 64


def _train(docs: DataFrame, network: WindowNetwork, turn: int) -> None:
    """Trains the network on docs: each task from the same weights on its own texts, then the mean change of each row of weights by how often the tasks used it."""
    p = network.p
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, rng = copy.deepcopy(shared.value), np.random.default_rng([p.seed, turn])
        used = {"embed": np.zeros((2 * p.reach, p.size + 1)), "to_word": np.zeros(p.side)}
        for batch in batches:
            for _, words, offsets in hashed_words(batch.column(0), NOT_ALNUM, LONG_RUN_BYTES):
                padded, at = net.laid(net.vocabulary.of(words), offsets)
                chosen = at[rng.random(len(at)) < max(p.masked, min(1.0, p.least / max(1, len(at))))]
                parts = max(1, round(len(chosen) / min(p.step, max(p.least, len(chosen) // 32))))
                for mine in np.array_split(rng.permutation(chosen), parts):
                    if len(mine):
                        net.learn(padded, np.sort(mine))
                used["to_word"] += np.bincount(padded[chosen].astype(np.int64) // p.side, minlength=p.side)
                for j, by in enumerate(net.around):
                    used["embed"][j] += np.bincount(padded[chosen + by], minlength=p.size + 1)
        used["embed"], used["word_bias"] = used["embed"].ravel(), used["to_word"]
        used["to_class"] = used["class_bias"] = used["to_word"].sum(keepdims=True)
        group = TaskContext.get().partitionId() // _GROUP
        for what in ("weights", "squares"):
            for name in WEIGHTS:
                n = used[name]
                change = (net.rows(getattr(net, what), name) - shared.value.rows(getattr(shared.value, what), name)) * n[:, None]
                at = [i for i in range(0, len(n), _SLICE) if n[i : i + _SLICE].any()]
                columns = [pa.array([what] * len(at), pa.string()), pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array([group] * len(at), pa.int32()), pa.array([n[i : i + _SLICE].tobytes() for i in at], pa.binary()), pa.array([change[i : i + _SLICE].astype(np.float32).tobytes() for i in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["what", "name", "at", "group", "n", "change"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            for *key, n, change in zip(*(batch.column(i) for i in range(6)), strict=True):
                here = np.frombuffer(n.as_buffer(), np.float64), np.frombuffer(change.as_buffer(), np.float32)
                have = sums.get(key := tuple(x.as_py() for x in key))
                sums[key] = [x + y for x, y in zip(have, here, strict=True)] if have else list(here)
        for (what, name, at, _), (n, change) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([what]), pa.array([name]), pa.array([at], pa.int32()), pa.array([0], pa.int32()), pa.array([n.tobytes()]), pa.array([change.tobytes()])], names=["what", "name", "at", "group", "n", "change"])

    # Sums of neighbouring tasks first, then of all, so that no task reads a row of each task of the corpus.
    schema, key = "what string, name string, at int, group int, n binary, change binary", ("what", "name", "at", "group")
    parts = docs.select("text").mapInArrow(run, schema).repartition(*key).mapInArrow(add, schema)
    parts = parts.withColumn("group", F.lit(0)).repartition(*key).mapInArrow(add, schema)
    for what, name, at, _, n, change in zip(*parts.toArrow().columns, strict=True):
        rows, n = network.rows(getattr(network, what.as_py()), name.as_py())[at.as_py() : at.as_py() + _SLICE], np.frombuffer(n.as_buffer(), np.float64)
        rows += (np.frombuffer(change.as_buffer(), np.float32).reshape(len(n), -1) / np.maximum(n, 1)[:, None]).astype(np.float32)


def _frequent(counts: DataFrame, most: int) -> tuple[int, int, int]:
    """The least count that leaves no more than most keys at or above it; the sum of all counts, and the number of keys."""
    by_n = counts.groupBy("n").agg(F.count("*").alias("keys")).orderBy(F.desc("n")).toPandas().astype(np.int64)
    n, keys = by_n["n"].to_numpy(), by_n["keys"].to_numpy()
    fit = int((np.cumsum(keys) <= most).sum())
    return int(n[fit - 1]) if fit else int(n.max(initial=0)) + 1, int((n * keys).sum()), int(keys.sum())


def fit_network(docs: DataFrame, params: LmParams = LmParams()) -> WindowNetwork:
    """Counts the words and segments of all documents, then trains on all of them."""
    p = params
    counts = settle(corpus_counts(docs, p), "lm-counts")
    words, repeated = counts.where("not segment").select("word", "n"), counts.where("segment").select("word", "n")
    least, total, distinct = _frequent(words, p.table)
    best = words.where(F.col("n") >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    network = WindowNetwork(Vocabulary(best["word"].to_numpy(np.int64), best["n"].to_numpy(np.int64), total, distinct, p.size), p)
    # Frequent segments stay out of the join, so that none of its keys is hot.
    least, _, _ = _frequent(repeated, p.hot)
    hot = repeated.where(F.col("n") >= least).toPandas()
    network.hot = Held(hot["word"].to_numpy(np.int64), hot["n"].to_numpy(np.int64))
    network.repeated = repeated.where(F.col("n") < least)
    _train(docs.where(F.pmod(F.xxhash64("text"), F.lit(p.early)) == 0), network, 0)
    _train(docs, network, 1)
    return network


def score_documents(docs: DataFrame, network: WindowNetwork) -> DataFrame:
    """doc_id, n_tokens, n_unknown, log_likelihood (the sum over all tokens) and mean_log_likelihood for each row of docs.

    docs are taken to be among the documents that the network counted, so that one occurrence of a
    segment is a document's own. n_unknown counts the words beyond the network's ids; each is scored by its own count. One row for each input row, whole texts. Texts without words, null ones among them, have no
    tokens, sum 0 and a null mean. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    alone, odds = np.log1p(-network.p.repeats), np.log(network.p.repeats / (1 - network.p.repeats))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            n, unknown, total, cut = (np.zeros(batch.num_rows, t) for t in (np.int64, np.int64, np.float64, np.int64))
            keys, fits, lengths = ([np.empty(0, t)] for t in (np.int64, np.float32, np.int32))
            for row, words, offsets in hashed_words(batch.column(1), NOT_ALNUM, LONG_RUN_BYTES):
                tokens = net.vocabulary.of(words)
                rows = slice(row, row + len(offsets) - 1)
                n[rows] = np.diff(offsets)
                padded, places = net.laid(tokens, offsets)
                gains = np.concatenate([np.empty(0), *(net.log_probability(padded, places[at : at + (1 << 14)]) for at in range(0, len(places), 1 << 14))])
                where = np.flatnonzero(tokens == 0)
                gains[where] += net.vocabulary.shares(words[where])
                starts, found = segments(words, offsets, net.p)
                size = np.diff(np.append(starts, len(words)))
                fit = np.add.reduceat(gains, starts) if len(starts) else np.empty(0)
                seen = net.hot.of(found)
                # The mixture of a segment that occurs once is the network's part alone.
                own = fit + alone + np.where(seen > 1, np.logaddexp(0.0, odds + size * np.log(np.maximum(seen - 1, 0.5) / np.maximum(seen, 1)) - fit), 0.0)
                sums, unk = np.concatenate([[0.0], np.cumsum(own)]), np.concatenate([[0], np.cumsum(tokens == 0)])
                at = np.searchsorted(starts, offsets)
                total[rows] = sums[at[1:]] - sums[at[:-1]]
                unknown[rows] = unk[offsets[1:]] - unk[offsets[:-1]]
                left = np.flatnonzero(seen == 0)
                cut[rows] = np.diff(np.searchsorted(starts[left], offsets))
                keys.append(found[left])
                fits.append(fit[left].astype(np.float32))
                lengths.append(size[left].astype(np.int32))
            parts = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in (keys, fits, lengths)], names=["key", "fit", "size"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cut)]).astype(np.int32)), parts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(unknown), pa.array(total), lists], names=["doc_id", "n_tokens", "n_unknown", "log_likelihood", "segments"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_unknown long, log_likelihood double, segments array<struct<key:long,fit:float,size:int>>")
    out = settle(out.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    parts = out.select("row", F.explode("segments").alias("s")).select("row", F.col("s.key").alias("word"), F.col("s.fit").cast("double").alias("fit"), F.col("s.size").alias("size"))
    x = F.lit(float(odds)) + F.col("size") * F.log((F.col("n") - 1) / F.col("n")) - F.col("fit")
    gain = F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
    # Whole numbers, so that the sum does not depend on the order of rows.
    more = parts.join(network.repeated, "word").groupBy("row").agg(F.sum(F.round(gain * F.lit(float(_ONE))).cast("long")).alias("more"))
    out = out.drop("segments").join(more, "row", "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce(F.col("more") / F.lit(float(_ONE)), F.lit(0.0)))
    out = out.select("doc_id", "n_tokens", "n_unknown", "log_likelihood")
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
