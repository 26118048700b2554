from collections import Counter

import numpy as np

from voltmesh.llm.ann import AnnParams, nearest_neighbours, scan


def brute(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            found = sorted(((-float((x * y).sum()), i) for i, y in ok if i != q))[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


def collected(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, rank int")


def test_small_table_is_exact_with_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(1, 90)]
    rows += [(i, rows[3][1]) for i in range(200, 230)] + [(300, None), (320, [0.0] * 8), (340, [1.0, None] + [0.0] * 6), (360, [float("nan")] * 8), (380, [float("inf")] * 8), (400, [])]
    got, want = collected(nearest_neighbours(table(spark, rows), every=20)), brute(rows, 20, 20)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_rows_that_share_an_id_are_queries_of_their_own(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(1, 90)]
    rows += [rows[19]] * 2 + [(40, rng.standard_normal(8).astype(np.float32).tolist())]
    got = Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest_neighbours(table(spark, rows), every=20).collect())
    want = Counter()
    for a, (q, v) in enumerate(rows):
        if q % 20 == 0:
            found = sorted((-float(np.dot(np.array(v, float), np.array(w, float))), i) for b, (i, w) in enumerate(rows) if a != b)[:20]
            want.update((q, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(found))
    assert got == want and sum(got.values()) == 20 * 7


def test_fewer_candidates_than_asked_and_empty(spark):
    rows = [(20, [1.0, 2.0]), (21, [3.0, 1.0]), (40, [0.5, 0.5])]
    assert [i for i, _ in collected(nearest_neighbours(table(spark, rows), every=20))[20]] == [21, 40]
    assert nearest_neighbours(table(spark, [(1, None)])).collect() == []


def recall(got, want):
    assert set(got) == set(want)
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(len(x) for x in want.values())


def test_recall_on_many_lists(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((10, 32))
    rows = [(i, (centre[i % 10] + 0.7 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(6000)]
    got = collected(nearest_neighbours(table(spark, rows), every=60, params=AnnParams(per_list=100, tile=64)))
    assert recall(got, brute(rows, 20, 60)) >= 0.9


def test_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, 20, 20)
    assert recall(collected(nearest_neighbours(df)), want) >= 0.95
    assert recall(collected(nearest_neighbours(df, params=AnnParams(per_list=50))), want) >= 0.9


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(6)
    rows = [(0, [5.0])] + [(i, rng.standard_normal(2 + i % 2).astype(np.float32).tolist()) for i in range(1, 80)]
    got = collected(nearest_neighbours(table(spark, rows), every=20))
    want = {}
    for n in (1, 2, 3):
        want |= brute([x for x in rows if len(x[1]) == n], 20, 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items() if x}


def test_very_large_and_small_components(spark):
    rng = np.random.default_rng(7)
    for size in (1e200, 1e-200, 1e150):
        rows = [(i, (rng.standard_normal(6) * size).tolist()) for i in range(1, 300)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {(r.query_id, r["rank"]): r.vec_id for r in nearest_neighbours(df, every=50, params=AnnParams(per_list=20)).collect()}
        assert len(got) == 5 * 20
        if size == 1e150:
            want = brute(rows, 20, 50)
            assert [got[q, 1] for q in want] == [want[q][0][0] for q in want]


def test_scan_keeps_what_is_near():
    rng = np.random.default_rng(3)
    q, c = rng.standard_normal((30, 64)).astype(np.float32), rng.standard_normal((3000, 64)).astype(np.float32)
    apart = ((q[:, None, :] - c[None]) ** 2).sum(2)
    near = np.argsort(apart, axis=1)[:, :20]
    for bound in (np.full(30, np.inf), np.partition(apart, 19, axis=1)[:, 19]):
        found = set(zip(*(x.tolist() for x in scan(q, c, bound, 20, 16, 2.1, 1e-4)), strict=True))
        kept = np.mean([(i, int(j)) in found for i in range(30) for j in near[i]])
        assert kept >= 0.97 and len(found) < 0.2 * apart.size
