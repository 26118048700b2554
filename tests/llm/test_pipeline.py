"""The registered queries and the pipeline over the smallest tables."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
from tests.llm.test_decontam import brute as brute_leaks
from tests.llm.test_neardup import brute as brute_copies

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert {n for n in range(1, 11) if any(x.startswith(f"op{n}_") for x in names)} == set(range(1, 11)) and "pipeline" in names


def test_stages_against_brute_force(spark, docs):
    import corpus_pipeline as P

    table, last = spark.read.parquet(f"{SMALL}/documents.parquet"), None
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in P.STAGES[:-1]:
        out = P.settle(stage(spark, table, SMALL), f"test-{name}")
        assert out.columns == table.columns
        before, after = ({r.doc_id: r.text for r in x.collect()} for x in (table, out))
        assert all(before[k] == v for k, v in after.items()) and len(after) == out.count()
        if name == "near_dedup":
            assert set(after) == {i for i, x in brute_copies(list(before.items()), 5).items() if x[2]}
        if name == "decontaminate":
            assert set(after) == {i for i, x in brute_leaks(list(before.items()), items).items() if not x[-1]}
        table, last = out, after
    end = {r.doc_id: r for r in P.STAGES[-1][1](spark, table, SMALL).collect()}
    assert set(end) == set(last) == {r.doc_id for r in P.run(spark, SMALL).collect()}
    assert all(len(r.ids) == r.n_tokens for r in end.values())


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null ids, texts and languages, repeated rows, shared ids, a clashing column, copies and leaks; then no rows at all."""
    import random

    import corpus_pipeline as P

    rng = random.Random(3)
    prose = [" ".join(rng.choice("the cat and dog sat on mats near tall trees while seven birds sang old songs about rivers".split()) for _ in range(60)) for _ in range(40)]
    item = " ".join(f"question{i}" for i in range(12))
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(prose)]
    rows += [rows[0], (100, prose[1], "en", "web", 1), (1, prose[2] + " " + prose[3], "en", "web", 1), (None, prose[4], "en", "web", 1), (None, prose[5] + prose[6], None, None, None)]
    rows += [(200, None, None, None, None), (201, "", "en", "web", 0), (202, "12 34", "en", "web", 5), (203, f"{prose[7]} {prose[8]} {item}", "en", "web", 1), (None, item, "en", "web", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens int"
    spark.createDataFrame([(*r, 7) for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(5, item), (6, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = P.language(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert sorted(r.doc_id for r in docs.collect() if r.doc_id is not None) == sorted(r[0] for r in rows if r[0] is not None and r[0] not in (200, 201, 202))
    docs = P.settle(P.near_dedup(spark, docs, str(tmp_path)), "odd")
    left = sorted((str(r.doc_id), r.text) for r in docs.collect())
    # One row of document 0, both texts of 1, no copy under 100 or without an id.
    assert left == sorted({(str(i), t) for i, t, *_ in rows if t and i not in (100, 201, 202) and not (i is None and t == prose[4])})
    got = P.decontaminate(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {i for i in range(40)} and len(got) == 41  # rows without an id are one document, which leaks
    assert P.run(spark, str(tmp_path)).count() <= len(got)
    none = tmp_path / "none"
    for name, kind in (("documents", schema), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(str(none / f"{name}.parquet"))
    assert P.run(spark, str(none)).collect() == []


def test_documents_are_shuffled_to_many_ids(spark, monkeypatch):
    """The way beyond the bound of the broadcast."""
    import corpus_pipeline as P

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    gone = table.where("doc_id % 3 = 0").selectExpr("doc_id AS _id", "xxhash64(text) AS _mark")
    want = sorted(r.doc_id for r in P._without(table, gone).collect())
    monkeypatch.setattr(P, "BROADCAST_IDS", 2)
    assert sorted(r.doc_id for r in P._without(table, gone).collect()) == want == sorted(r.doc_id for r in table.collect() if r.doc_id % 3)


def test_language_of_held_out_documents(spark):
    rows = __spark_entry__.queries()["op8_language"](spark, SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in __spark_entry__.queries()["op1_quality"](spark, sf).collect()}
    held = [(rows[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = ([r.score for r, q in held if q == x] for x in (1, 0))
    assert all(r.held_out for r, _ in held) and np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([r.predicted for r, q in held if q == 1]) > 0.95


def test_language_model_counts_all_words(spark, docs):
    from voltmesh.llm.lmscore import fit_network, score_documents, word_counts

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = Counter(w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for t in docs.values() for w in word.findall(t))
    assert sorted(r.n for r in word_counts(table).collect()) == sorted(counts.values())
    network = fit_network(table)
    rows = {r.doc_id: r for r in score_documents(table, network).collect()}
    assert set(rows) == set(docs) and all(rows[i].n_tokens == len(word.findall(t)) for i, t in docs.items())
    real = docs[max(docs, key=lambda i: len(docs[i]) * (rows[i].n_unknown < 0.5 * rows[i].n_tokens))]
    words = real.split()
    shuffled = " ".join(np.random.default_rng(0).permutation(words))
    odd = spark.createDataFrame([(0, real), (1, shuffled), (2, None), (3, ""), (4, "..")], "doc_id long, text string")
    got = {r.doc_id: r for r in score_documents(odd, network).collect()}
    assert got[2].n_tokens == got[3].n_tokens == got[4].n_tokens == 0 and got[2].mean_log_likelihood is None and got[2].log_likelihood == 0
    assert got[0].mean_log_likelihood < 0 and got[0].n_tokens == got[1].n_tokens
