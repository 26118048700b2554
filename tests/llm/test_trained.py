"""Trained operators on odd rows: nulls, empty and very long texts, repeats, clashing columns, empty tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from voltmesh.llm.langid import Profiles, fit_profiles, gram_counts, predict_language, ranked
from voltmesh.llm.lmscore import fit_network, score_documents
from voltmesh.llm.quality import features, fit_quality, score_quality
from voltmesh.llm.words import NOT_ALNUM, RUN_BYTES, SPACES, hashed_words, mix

ROWS = [(1, None, "en"), (2, "", "en"), (3, " \n", None), (4, "123 !!", "en"), (None, "the cat sat on the mat", "en"), (6, "der Hund und die Katze " * 60_000, "de"), (7, "the cat sat on the mat", "en"), (7, "the cat sat on the mat", "en"), (8, "der Hund und die Katze", "de")]
ROWS += [(100 + i, f"the dog and the cat number {i} " * 5, "en") for i in range(20)] + [(200 + i, f"der Hund und die Katze Nummer {i} " * 5, "de") for i in range(20)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, la, 0.5, True) for i, t, la in ROWS], "doc_id long, text string, lang string, score double, held_out boolean")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_language(docs, empty):
    profiles = fit_profiles(docs)
    rows = predict_language(docs, profiles).collect()
    assert len(rows) == len(ROWS)
    for r, (i, t, la) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        letters = any(c.isalpha() for c in t or "")
        assert r.doc_id == i and r.lang_pred == (la if letters else "und") and 0 <= r.score <= 1
    assert predict_language(empty, fit_profiles(empty)).collect() == []
    assert {r.lang_pred for r in predict_language(docs, Profiles({}, 400)).collect()} == {"und"}


def test_profiles_follow_a_plain_count():
    from collections import Counter

    text = "Ab ab, aB! über"
    want: Counter = Counter()
    for w in ("ab", "ab", "ab", "über"):
        want.update(w)
    padded = "_ab_ab_ab_über_"
    want.update(padded[i : i + 2] for i in range(len(padded) - 1))
    want.update(padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != "_")
    keys, counts = gram_counts(text)
    assert sorted(counts.tolist()) == sorted(want.values())
    assert len(ranked(keys, counts, 5)) == 5 and counts[keys.tolist().index(ranked(keys, counts, 5)[0])] == max(want.values())


def test_long_texts_are_counted_as_a_whole(monkeypatch):
    from voltmesh.llm import langid

    text = "Der Hund, die Katze -- und 123 der Vogel\n" * 50 + "langeswort" * 30 + " ende"
    whole = [x.tolist() for x in langid._piece_counts(text)]
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(langid, "_PIECE", size)
        assert [x.tolist() for x in gram_counts(text)] == whole


def test_language_against_plain_distances(spark):
    """Profiles and predictions from plain counters over strings."""
    from collections import Counter

    texts = {"en": "the cat and the dog sat on the mat", "de": "der Hund und die Katze lagen auf der Matte", "fr": "le chien et le chat sur le tapis"}
    rows = [(i, f"{t} {i} {t[: i % 17]}", la) for i, (la, t) in enumerate((la, t) for _ in range(30) for la, t in texts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def grams(text):
        low = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        padded, out = "".join("_" + w for w in low) + "_", Counter()
        for w in low:
            out.update(w)
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != "_")
        return out

    code = lambda g: sum((0 if c == "_" else ord(c)) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g)) | (1 << 20 if len(g) == 2 else 0)
    ranks = lambda counts: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:400]]
    learned = {la: ranks(sum((grams(t) for i, t, x in rows if x == la and zlib.crc32(str(i).encode()) % 4 != 2), Counter())) for la in texts}
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(docs, fit_profiles(docs)).collect()}
    for i, t, _ in rows:
        mine = ranks(grams(t))
        far = {la: sum(abs(p.index(g) - k) if g in p else 400 for k, g in enumerate(mine)) for la, p in learned.items()}
        best, second = sorted((d, la) for la, d in far.items())[:2]
        assert got[i][0] == best[1] and got[i][1] == pytest.approx(1 - best[0] / max(1, second[0]))


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _, _ in ROWS if i] + [(9999, 1, 0), (7, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = fit_quality(docs, labels)
    rows = score_quality(docs, model, keep=("lang",)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in rows if r.doc_id == 7}) == 1
    again = score_quality(docs, fit_quality(docs, labels)).collect()
    assert sorted((r.doc_id or 0, r.score) for r in rows) == sorted((r.doc_id or 0, r.score) for r in again)
    assert score_quality(empty, fit_quality(empty, labels)).collect() == [] and len(score_quality(docs, fit_quality(docs, labels.limit(0))).collect()) == len(ROWS)


def test_language_model(docs, empty):
    network = fit_network(docs)
    rows = score_documents(docs, network).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.mean_log_likelihood is None) == (r.n_tokens == 0) and r.log_likelihood <= 0
    assert next(r for r in rows if r.doc_id == 6).n_tokens == 300_000
    assert score_documents(empty, fit_network(empty)).collect() == []


def test_language_model_gathers_from_the_whole_corpus(spark):
    import math
    import random

    from voltmesh.llm.lmscore import LmParams

    # No text of one word is among the documents, so what the mixture keeps for repeated segments is left over.
    # More different words than ids, of which the table holds some; words of one doc occur once, of the other thrice.
    rows = [(i, " ".join(f"w{j}" for j in range(20 * i, 20 * i + 20))) for i in range(300)] + [(1000 + k, " ".join(f"w{j}" for j in range(5000))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = [f"w{i}" for i in range(6000)] + ["never"]
    alone = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    for p in (LmParams(), LmParams(table=5500)):
        network = fit_network(docs, p)
        got = {words[r.doc_id]: r.log_likelihood for r in score_documents(alone, network).collect()}
        assert len(got) == 6001 and abs(sum(map(math.exp, got.values())) - (1 - p.repeats)) < 1e-3
        rare = sorted(set(got[f"w{i}"] for i in range(5000, 6000)))
        assert rare[-1] - rare[0] < 1e-6 and (got["never"] < rare[0] - 0.6 if p.table > 6000 else got["never"] < got["w0"] - 0.6)

    # Starting weights from hardly any document: what the others show is learned all the same.
    rng = random.Random(1)
    pairs = [(i, " ".join(f"a{k} b{k}" for k in (rng.randrange(30) for _ in range(60)))) for i in range(2000)]
    network = fit_network(spark.createDataFrame(pairs, "doc_id long, text string"), LmParams(early=10**9))
    right, wrong = "a1 b1 a2 b2 a3 b3 a4 b4", "a1 b2 a3 b4 a2 b1 a4 b3"
    got = {r.doc_id: r.log_likelihood for r in score_documents(spark.createDataFrame([(0, right), (1, wrong)], "doc_id long, text string"), network).collect()}
    assert got[0] > got[1] + 4


def brute_likelihood(texts, text, network):
    """Sum of log-probabilities of a text, token by token, from the network's weights and plain counts of the texts."""
    import math
    from collections import Counter

    import pyarrow as pa

    p, voc, w = network.p, network.vocabulary, network.weights
    hashed = lambda t: next(iter(hashed_words(pa.array([t]), NOT_ALNUM)))[1]
    every = [hashed(t) for t in texts]
    counts = Counter(x for t in every for x in t.tolist())

    def cut(words):
        out, at = [], 0
        for i in range(len(words)):
            if i + 1 == len(words) or int(mix(words[i : i + 1])[0]) % p.cut == 0:
                out.append((at, i + 1))
                at = i + 1
        return out

    around = lambda words, a, b: (tuple(words[max(0, a - p.reach) : a].tolist()), tuple(words[a:b].tolist()), tuple(words[b : b + p.reach].tolist()))
    seen = Counter(around(t, a, b) for t in every for a, b in cut(t))
    words = hashed(text)
    ids = [int(voc.of(words[i : i + 1])[0]) for i in range(len(words))]
    others = sum(n for x, n in counts.items() if voc.of(np.array([x], np.uint64))[0] == 0)
    kinds = sum(1 for x in counts if voc.of(np.array([x], np.uint64))[0] == 0)
    gains = []
    for i, t in enumerate(ids):
        near = [ids[i + by] if 0 <= i + by < len(ids) else p.size for by in network.around]
        h = np.tanh(sum(w["embed"][j][x].astype(float) for j, x in enumerate(near)))
        total = 0.0
        for x, k in ((h @ w["to_class"] + w["class_bias"], t // p.side), (h @ w["to_word"][t // p.side] + w["word_bias"][t // p.side], t % p.side)):
            total += x[k] - math.log(np.exp(x).sum())
        gains.append(total + (math.log((counts[int(words[i])] + 1) / (others + kinds + 1)) if t == 0 else 0.0))
    out = 0.0
    for a, b in cut(words):
        c, part = seen[around(words, a, b)], sum(gains[a:b])
        out += math.log((1 - p.repeats) * math.exp(part) + (p.repeats * ((c - 1) / c) ** (b - a) if c > 1 else 0.0))
    return out


def test_likelihood_against_brute_force(spark):
    import random

    from voltmesh.llm.lmscore import LmParams

    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts = base + base[:20] + [base[0]] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for p in (LmParams(side=8, masked=0.5), LmParams(side=8, cut=4, hot=2)):
        network = fit_network(docs, p)
        assert network.repeated.isEmpty() == (p.hot > 2)
        got = {r.doc_id: r.log_likelihood for r in score_documents(docs, network).collect()}
        for i in (0, 1, 25, 40, 62, 84):
            assert got[i] == pytest.approx(brute_likelihood(texts, texts[i], network), abs=2e-3, rel=1e-4)
        assert got[62] == pytest.approx(got[2], abs=1e-6) and got[84] == pytest.approx(got[0], abs=1e-6)


def test_real_text_scores_above_shuffled_and_invented(spark):
    import random

    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = fit_network(table)
    texts = [r.text for r in table.where("length(text) > 300").orderBy("doc_id").limit(60).collect()]
    rng = random.Random(1)
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    invented = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(100)) for _ in texts]
    rows = spark.createDataFrame(list(enumerate(texts + shuffled + invented)), "doc_id long, text string")
    got = [r.mean_log_likelihood for r in score_documents(rows, network).orderBy("doc_id").collect()]
    real, mixed, odd = got[:60], got[60:120], got[120:]
    assert sum(a > b for a, b in zip(real, mixed, strict=True)) >= 48 and np.mean(real) > np.mean(mixed) + 0.5
    assert max(odd) < np.quantile(real, 0.1) and np.mean(odd) < np.mean(mixed) - 1


def test_copies_score_above_documents_of_their_kind(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in score_documents(table, fit_network(table)).collect()}
    by_text = {}
    for r in table.collect():
        by_text.setdefault(r.text, []).append(r.doc_id)
    score = lambda n: [rows[i].mean_log_likelihood for x in by_text.values() if len(x) == n for i in x if rows[i].n_tokens > 30]
    assert np.mean([a > b for a in score(2) for b in score(1)]) > 0.95


def test_words_are_the_same_in_any_run():
    import pyarrow as pa

    texts = ["Aa bB", None, "", "x" * 10, "aa BB cc " * (RUN_BYTES // 5), "é-Ü 1", "no_space" * (RUN_BYTES // 4)]
    for sep in (SPACES, NOT_ALNUM):
        whole = [w.tolist() for _, words, offsets in hashed_words(pa.array(texts), sep) for a, b in zip(offsets[:-1], offsets[1:]) for w in [words[a:b]]]
        alone = [next(iter(hashed_words(pa.array([t], pa.string()), sep)))[1].tolist() for t in texts]
        assert whole == alone and len(whole) == len(texts)
        assert whole[0] == whole[4][:2] and len(whole[4]) == 3 * (RUN_BYTES // 5)


def test_features_are_runs_and_those_that_repeat():
    import pyarrow as pa

    one = lambda t, bits=40: set(features(next(iter(hashed_words(pa.array([t]), SPACES)))[1], bits).tolist())
    assert len(one("a b c d")) == 4 + 3 + 2 and len(one("a a a a")) == 3 + 1 + 1 + 1 + 1
    assert one("a b") < one("a b c") and one("") == {(1 << 40) - 1}
    long = " ".join(f"w{i}" for i in range(20_000))
    assert len(one(long)) == 3 * 20_000 - 3


def test_quality_against_plain_updates(spark):
    """Weights in dicts, one feature after the other, over all features of texts of any length."""
    import math
    import random

    import pyarrow as pa

    from voltmesh.llm.quality import QualityParams, fit_ftrl

    rng, p = random.Random(4), QualityParams(bits=16)
    texts = [(i, " ".join(rng.choice("abcdefgh" if i % 3 else "efghijkl") + rng.choice("xyz") for _ in range(rng.choice([1, 5, 40, 6000 if i < 6 else 60])))) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in texts], "doc_id long, quality int")
    rows = {i: features(next(iter(hashed_words(pa.array([t]), SPACES)))[1], p.bits).tolist() for i, t in texts}
    known = sorted(i for i in rows if zlib.crc32(str(i).encode()) % 5)
    z, n, w, bias = {}, {}, {}, [0.0, 0.0, 0.0]
    order = np.random.default_rng(7)
    for _ in range(p.epochs):
        for at in order.permutation(len(known)):
            f, y = rows[known[at]], float(known[at] % 3 > 0)
            x = 1 / math.sqrt(len(f))
            error = 1 / (1 + math.exp(-(sum(w.get(k, 0.0) for k in f) * x + bias[2]))) - y
            g = error * x
            for k in f:
                new = n.get(k, 0.0) + g * g
                z[k] = z.get(k, 0.0) + g - (math.sqrt(new) - math.sqrt(n.get(k, 0.0))) / p.alpha * w.get(k, 0.0)
                n[k] = new
                w[k] = 0.0 if abs(z[k]) <= p.l1 else -(z[k] - math.copysign(p.l1, z[k])) / ((p.beta + math.sqrt(new)) / p.alpha + p.l2)
            new = bias[1] + error * error
            bias[0] += error - (math.sqrt(new) - math.sqrt(bias[1])) / p.alpha * bias[2]
            bias[1] = new
            bias[2] = -bias[0] / ((p.beta + math.sqrt(new)) / p.alpha)
    model = fit_quality(docs, labels, p)
    got = {r.doc_id: r for r in score_quality(docs, model, p).collect()}
    for i, f in rows.items():
        want = 1 / (1 + math.exp(-(sum(w.get(k, 0.0) for k in f) / math.sqrt(len(f)) + bias[2])))
        assert got[i].score == pytest.approx(want, abs=1e-5) and got[i].predicted == int(got[i].score >= 0.3) and got[i].held_out == (i not in known)
    assert fit_ftrl([], np.empty(0), p)[1] == 0.0


def test_hashing_memory_does_not_follow_the_batch():
    import tracemalloc

    from voltmesh.llm import words

    column = pa.array([f"w{i} some words " * 4000 for i in range(40)])  # 2.4 MB
    words._powers.clear()
    tracemalloc.start()
    n = sum(len(h) for _, h, _ in hashed_words(column, SPACES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 40 * 4000 * 3 and peak < 24e6


def test_tasks_give_freed_memory_back(spark, monkeypatch):
    from voltmesh.llm import langid, neardup, quality, shared

    called = []
    monkeypatch.setattr(shared, "returned", lambda: called.append(1))
    assert list(shared.lean(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3] and called == [1]
    begun = shared.lean(iter)(iter([1, 2]))
    next(begun)
    begun.close()
    assert called == [1, 1]
    wrapped = []
    for module in (langid, neardup, quality):
        monkeypatch.setattr(module, "lean", lambda run, m=module: (wrapped.append(m), run)[1])
    docs = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    langid.predict_language(docs, langid.Profiles({}, 1))
    quality.score_quality(docs, (np.zeros(1 << 18), 0.0))
    neardup._signatures(docs, neardup.NearDupParams())
    assert wrapped == [langid, quality, neardup]


def test_words_do_not_depend_on_the_runs_that_they_are_hashed_in():
    """Steps that sum up or learn by run ask for runs of their own length."""
    from voltmesh.llm.words import LONG_RUN_BYTES

    column = pa.array([f"w{i} " * 30_000 for i in range(20)] + [None, "a" * (2 * RUN_BYTES)])
    runs = {n: list(hashed_words(column, SPACES, n)) for n in (RUN_BYTES, LONG_RUN_BYTES)}
    assert len(runs[LONG_RUN_BYTES]) < 3 and len(runs[RUN_BYTES]) > 5
    one, two = (np.concatenate([h for _, h, _ in x]) for x in runs.values())
    assert (one == two).all()
    assert [int(k) for x in runs[RUN_BYTES] for k in np.diff(x[2])] == [int(k) for x in runs[LONG_RUN_BYTES] for k in np.diff(x[2])]
