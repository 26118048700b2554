import hashlib
import random
import re

import pytest

from voltmesh.llm.decontam import find_leaks, leak_report

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if k := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= k
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def made():
    rng = random.Random(1)
    voc = "a b c d e".split()
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 14, 30])))) for i in range(12)] + [(100, None), (101, "!!")]
    docs = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([0, 1, 5, 12, 60])))) for i in range(80)]
    for i in range(40):
        s = rng.choice(items[:12])[1].split()[: rng.randint(3, 30)]
        docs.append((200 + i, " ".join(["x"] * rng.randint(0, 3) + s + ["Y-z"] + s[::-1] + ["q"] + s)))
    return docs + [(900, None), (901, ""), (902, "Ä É ß İ Σ A-B ǅ")], items


@pytest.mark.parametrize("most", [200_000, 3])
def test_equals_brute_force_on_both_paths(spark, most):
    docs, items = made()
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    got = {r[0]: tuple(r)[1:] for r in leak_report(d, spark.createDataFrame(items, "item_id long, text string"), most).collect()}
    assert got == brute(docs, items)


def test_case_of_letters_beyond_ascii_matters(spark):
    item = "über allen gipfeln ist ruh in allen wipfeln spürest du"
    d = spark.createDataFrame([(1, item.upper().replace("Ü", "ü")), (2, item.upper())], "doc_id long, text string")
    got = {r.doc_id: r.hits for r in find_leaks(d, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert got[1] == list(range(10)) and got[2] == []


def test_repetition_and_long_texts(spark):
    """Texts and items that repeat themselves, of a length at which work that grows with its square would not end."""
    import time

    items = [(1, "a b " * 20), (2, "c " * 300), (3, " ".join(f"w{i}" for i in range(500)))]
    docs = [(1, "a b " * 10_000), (2, "c " * 20_000 + "a b " * 6), (3, "x " * 30_000 + items[2][1]), (4, items[2][1] * 40)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    began = time.perf_counter()
    got = {r[0]: tuple(r)[1:] for r in leak_report(d, i).collect()}
    assert time.perf_counter() - began < 60 and got == brute(docs, items)


@pytest.mark.parametrize("most", [200_000, 3])
def test_rows_that_share_an_id_count_as_one(spark, most):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(7, item), (7, "z " * 30 + item), (7, None), (None, item), (None, "q"), (8, "short"), (9, item + " " + item)]
    got = {r.doc_id: (r.n_words, r.hits, r.items) for r in find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(3, item), (3, item), (20, item), (None, "short")], "item_id long, text string"), most).collect()}
    assert got == {7: (42, [*range(12), *range(30, 42)], ["20", "3"]), None: (12, list(range(12)), ["20", "3"]), 8: (1, [0], []), 9: (24, list(range(24)), ["20", "3"])}


def test_empty_tables(spark):
    d, i = (spark.createDataFrame([], f"{x} long, text string") for x in ("doc_id", "item_id"))
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert leak_report(d, i).collect() == []
    assert [tuple(r)[:4] for r in leak_report(one, i).collect()] == [(1, 2, 0, 0)]


def test_tables_between_steps_are_few_files(spark, monkeypatch):
    """However many partitions a shuffle has, small tables are one file and others a few for each core."""
    from voltmesh.llm import decontam, shared

    docs, items = made()
    seen, real = {}, shared.settle
    monkeypatch.setattr(decontam, "settle", lambda df, name: (seen.update({name: df.rdd.getNumPartitions()}), real(df, name))[1])
    conf = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = leak_report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        most = 8 * spark.sparkContext.defaultParallelism
        assert out.rdd.getNumPartitions() <= most
        assert {r[0]: tuple(r)[1:] for r in out.collect()} == brute(docs, items)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [seen[f"leak-{x}"] for x in ("items", "prints", "windows")] == [1, 1, 1] and max(seen.values()) <= most
