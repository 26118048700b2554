"""BPE, licence scans and sharding on fixtures with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from voltmesh.llm.bpe import Words, _dealt, _gathered, _meanings, decoded, encode_documents, pieces
from voltmesh.llm.licenses import TEMPLATES, LicenseParams, Scanner, find_licenses, license_report, read_templates
from voltmesh.llm.queries import vocabulary
from voltmesh.llm.shards import assign_shards, scheduled

ODD = ["", "a<|endoftext|>b C'S don't", "İSTANBUL Σας ΣΑΣ", "é café ﬁ ½ ² x²³ 123", "日本語 テスト 🙂🙂 x", "\x1c a\x1f b\x85c\xa0d", "<|startoftext|><|endoftext|>", "à̖", "—dash’s €5"]


@pytest.mark.parametrize(("block_chars", "held"), [(8_000_000, 1000), (200, 60), (300, 0)])
def test_words_encode_as_the_library_does(spark, block_chars, held):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary())
    rng = random.Random(0)
    pool = "aZ '́İſtsRE9½<|>\n\x1cé ñ中🙂’" + "".join(map(chr, range(0x80, 0x180)))
    texts = ODD + ["".join(rng.choice(pool) for _ in range(30)) for _ in range(300)] + ["word " * 50_000, None]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, "", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = encode_documents(df, vocabulary(), with_ids=True, block_chars=block_chars, held=held)
    back = {r.doc_id: r.text for r in decoded(got.dropDuplicates(["doc_id"]), vocabulary(), "doc_id").collect()}
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        ids = whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert back[r.doc_id] == whole.decode(ids, skip_special_tokens=False)


def test_empty_tables_and_other_vocabularies(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert encode_documents(none, vocabulary()).collect() == []
    with pytest.raises(ValueError):
        encode_documents(none, vocabulary("byte_bpe_50k.json"))
    with pytest.raises(ValueError):
        Words(vocabulary("byte_bpe_50k.json"))


def test_blocks_of_words_lie_where_they_are_joined(spark):
    df = spark.createDataFrame([(i, f"alpha beta{i} {t or ''}") for i, t in enumerate(ODD * 20)], "doc_id long, text string")
    plan = encode_documents(df, vocabulary(), block_chars=300)._jdf.queryExecution().executedPlan().toString()
    # Only what words mean is dealt by block, and the pieces of a word are not gathered by a shuffle.
    assert plan.count("Exchange hashpartitioning(block") == 1 and plan.count("Exchange hashpartitioning(word") == 1


def test_ids_of_words_are_gathered_alike_with_and_without_broadcast(spark):
    listed = [(f"word{i}", [(i % 3, i), (5, i + 1)], [i + 10, 7, i]) for i in range(40)] + [("none", [(5, 99)], [])]
    words = spark.createDataFrame(listed, "word string, where array<struct<block:long,at:int>>, ids array<int>")
    piece = {r.id: r.piece for r in pieces(spark, vocabulary()).collect()}
    want = {(block, at): (np.array(ids, "<u4").tobytes(), " ".join(piece[i] for i in ids).encode()) for _, where, ids in listed for block, at in where}
    for held, most in ((1, 1_000_000), (50_000, 1_000_000), (5, 0)):
        rows = _dealt(words, vocabulary(), held, broadcast_pieces=most).toArrow().to_pylist()
        got = {}
        for block in {r["block"] for r in rows}:
            ids, texts = _meanings(pa.array([r for r in rows if r["block"] == block]), 200)
            got |= {(block, at): (ids[at], texts[at]) for b, at in want if b == block}
        assert got == want
    torn = pa.RecordBatch.from_pydict({"where": [[{"block": 0, "at": 0}], None], "size": [2, 2], "nth": pa.array([0, 2], pa.int32()), "id": [1, 2], "piece": ["a", "b"]})
    with pytest.raises(RuntimeError):
        list(_gathered(iter([torn]), 10))


def test_pieces_start_no_python_workers(spark):
    rdd = pieces(spark, vocabulary())._jdf.queryExecution().toRdd().toDebugString()
    assert "PythonRDD" not in rdd
    listed = spark.createDataFrame([(1, "a")], "id int, piece string")._jdf.queryExecution().toRdd().toDebugString()
    assert "PythonRDD" in listed


def test_licences_and_changed_wordings(spark):
    mit = TEMPLATES["MIT notice"]
    rows = [(1, "Some text.\n" + TEMPLATES["Apache-2.0"] + " More text."), (2, "x. " + mit.replace("free of charge", "at no charge") + " y."), (3, "A license is a permission."), (4, None), (5, ""), (6, "no hint " * 1000), (7, TEMPLATES["CC-BY-NC-4.0"] + "\n\n" + "plain words. " * 9 + TEMPLATES["GPL-3.0"])]
    rows += [(8, rows[0][1])] * 2
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, found int")
    got = {r.doc_id: r for r in license_report(find_licenses(df)).collect()}
    assert {i: r.licenses for i, r in got.items()} == {1: "Apache-2.0", 2: "MIT notice", 3: "", 4: "", 5: "", 6: "", 7: "CC-BY-NC-4.0,GPL-3.0", 8: "Apache-2.0"}
    assert got[1].words_apart == 0 and got[2].words_apart > 0 and got[4].n_found == 0


def test_all_licences_of_a_block_are_found():
    scanner = Scanner(TEMPLATES, LicenseParams())
    found = lambda text: {x[1]: x[3:] for x in scanner.scan(text)}
    names = ["CC-BY-4.0", "MIT", "Apache-2.0", "GPL-3.0"]
    assert found("\n".join(TEMPLATES[n] for n in names)) == dict.fromkeys(names, (0, 0))
    assert found("\n".join(TEMPLATES.values())) == dict.fromkeys(TEMPLATES, (0, 0))
    # One sentence within a long run without sentence ends, and words of it that stand before.
    long = " ".join(f"word{i}" for i in range(400))
    assert found(f"{long} licensed under the law {TEMPLATES['MIT']} {long}") == {"MIT": (0, 0)}
    assert found(f"Permission {long} {TEMPLATES['ISC']} {long} Permission to use") == {"ISC": (0, 0)}
    changed = TEMPLATES["MIT notice"].replace("free of charge", "at no charge").removeprefix("Permission is ")
    assert sum(found(f"{long} {changed} {long}")["MIT notice"]) > 0


def test_variants_are_told_apart():
    scanner = Scanner(TEMPLATES, LicenseParams())
    found = lambda text: {x[1] for x in scanner.scan(text)}
    assert found("Copyright 2020 Someone\n\n" + TEMPLATES["BSD-3-Clause text"]) == {"BSD", "BSD-3-Clause text"}
    assert found(TEMPLATES["BSD-2-Clause text"]) == {"BSD", "BSD-2-Clause text"}
    assert found(TEMPLATES["MIT text"]) == {"MIT notice", "MIT text"} and "MIT text" not in found(TEMPLATES["MIT-0 text"])
    assert "ISC text" in found(TEMPLATES["ISC text"]) and "ISC" not in found(TEMPLATES["0BSD text"])
    assert found(TEMPLATES["CC-BY-NC-SA-4.0 deed"]) == {"CC-BY-NC-SA-4.0 deed"}


def plain_matches(text, templates, missing=0.1):
    """Templates whose words stand in the text one after the other, by comparing every stretch of the text of their length."""
    import re

    words = lambda t: [w.lower() for w in re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", t)]
    mine = words(text)
    return {n for n, t in templates.items() for w in [words(t)] if any(mine[a : a + len(w)] == w for a in range(len(mine) - len(w) + 1))}


def test_documents_against_plain_matches(spark):
    """Every exact wording in the documents is found; what else is found differs from its template in some words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.found for r in find_licenses(docs).collect()}
    n = 0
    for r in docs.collect():
        exact = {x.license for x in got[r.doc_id] if x.missing + x.added == 0}
        assert plain_matches(r.text or "", TEMPLATES) == exact
        n += len(exact)
    assert n > 5


def test_licences_in_odd_rows(spark, tmp_path):
    (tmp_path / "Own").write_text("You may license this text to all who can read it and to nobody else at all.")
    own = read_templates(tmp_path)
    long = "plain words and nothing more. " * 40_000
    rows = [(1, long + TEMPLATES["Apache-2.0 notice"] + long), (2, f"{TEMPLATES['MIT']} {TEMPLATES['MIT']}"), (3, own["Own"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [x.license for x in r.found] for r in find_licenses(df, TEMPLATES | own).collect()}
    assert got == {1: ["Apache-2.0 notice", "Apache-2.0"], 2: ["MIT"], 3: ["Own"]}
    assert find_licenses(df.limit(0)).collect() == []


def test_shards_keep_groups_and_balance(spark):
    rng = random.Random(3)
    rows = [(i, "z" * rng.randint(1, 400)) for i in range(1500)] + [(2000 + i, "hot" * 20) for i in range(700)] + [(5000, None), (5001, ""), (5002, "é"), (5002, "é")]
    out = assign_shards(spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, shard int"), 8).collect()
    assert len(out) == len(rows)
    text = dict(rows)
    by_text, slots, load = {}, {}, {}
    for r in out:
        t = text[r.doc_id] or ""
        assert r.size == len(t.encode()) + 16 and r.text_crc32 == zlib.crc32(t.encode()) and r.law == "bytes" and r.grown_shard is None
        assert by_text.setdefault(t, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    rest = [v for s, v in load.items() if s != by_text["hot" * 20]]
    assert max(rest) - min(rest) < 1000
    assert assign_shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def plain_schedule(sizes, n_shards):
    """Longest first, each to the least load, then the lowest shard."""
    load = [0] * n_shards
    for x in sorted(sizes, reverse=True):
        s = load.index(min(load))
        load[s] += x
    return load


@pytest.mark.parametrize("n_shards", [1, 3, 7])
def test_classes_are_scheduled_as_their_groups_would_be(n_shards):
    rng = random.Random(n_shards)
    for _ in range(60):
        sizes = [rng.choice([1, 2, 3, 5, 16, 17, 40, 400]) for _ in range(rng.randint(0, 90))]
        kinds, counts = np.unique(np.array(sizes, np.int64), return_counts=True)
        load, ends = scheduled(kinds, counts, n_shards)
        assert load.tolist() == plain_schedule(sizes, n_shards)
        assert all(ends[:, -1] == counts) and (np.diff(ends, axis=1, prepend=0).T @ kinds).tolist() == load.tolist()


def test_loads_of_documents_are_those_of_plain_scheduling(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = assign_shards(docs, 40).collect()
    group, load = {}, {}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in out:
        group[text[r.doc_id]] = group.get(text[r.doc_id], 0) + r.size
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert sorted(load.values()) == sorted(plain_schedule(group.values(), 40)) and len(out) == len(text)


def test_gains_tell_which_templates_are_confirmed():
    scanner = Scanner(TEMPLATES, LicenseParams())
    short = {n for n, w in scanner.words.items() if len(w) < 12}
    plain = [str(i * 7919 % 100_003) for i in range(300)]
    assert short <= set(scanner.gaining(plain)) and "MIT text" not in scanner.gaining(plain)
    assert "MIT text" in scanner.gaining([*plain, *scanner.words["MIT text"], *plain * 9])
    text = TEMPLATES["MIT text"] + " " + TEMPLATES["ISC"]
    assert {"MIT text", "ISC"} <= {x[1] for x in scanner.scan(text)}
    scanner.worded["MIT text"] = scanner.alone
    assert "MIT text" not in {x[1] for x in scanner.scan(text)}
