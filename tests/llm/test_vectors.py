import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lineflow.llm import neighbours, topk, vectors
from lineflow.llm.queries import ORACLES, QUERIES


def loaded(sf_dir):
    table = duckdb.sql(f"select vec_id, embedding from read_parquet('{sf_dir}/embeddings.parquet')").fetchall()
    return np.array([r[0] for r in table]), np.array([r[1] for r in table], np.float32).astype(float)


def plain(ids, matrix, step, k):
    """query -> [(id, score)] by brute force"""
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        scores = np.array([float(np.dot(matrix[i], v)) for v in matrix])
        order = [j for j in np.lexsort([ids, -scores]) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def gathered(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_top_k_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    ids, matrix = loaded(sf_dir)
    assert gathered(QUERIES["op3_exact_top_k"](spark, sf_dir)) == plain(ids, np.floor(256 * matrix), 50, 5)
    duckdb.sql(f"create or replace view embeddings as select * from read_parquet('{sf_dir}/embeddings.parquet')")
    found = duckdb.sql(ORACLES["op3_exact_top_k"]).fetchall()
    assert sorted(found) == sorted((r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op3_exact_top_k"](spark, sf_dir).collect())


def test_lists_give_exact_results_with_ties_and_many_copies():
    rng = np.random.default_rng(4)
    for spread in (2, 100, 1 << 30):
        rows = rng.integers(-spread, spread, (500, 16))
        rows[100:300] = rows[100]
        ids = rng.permutation(500)
        for a in topk.block_top(rows[:40], ids[:40], np.full(40, -np.inf), rows, ids, 7):
            own = rows @ rows[list(ids).index(a[0][0])]
            order = [j for j in np.lexsort([ids, -own]) if ids[j] != a[0][0]][:7]
            assert list(zip(a[1], a[2])) == [(ids[j], own[j]) for j in order]


def test_neighbour_query_recall(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 1000)
    sf_dir = "/root/testdata/sf0.1"
    ids, matrix = loaded(sf_dir)
    want = plain(ids, matrix, 20, 20)
    got = gathered(QUERIES["op8_neighbours"](spark, sf_dir))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(dict(got[q]).keys() & dict(want[q]).keys()) / 20 for q in want]) >= 0.9
    at = {int(v): i for i, v in enumerate(ids)}
    assert all(abs(s - matrix[at[q]] @ matrix[at[v]]) < 1e-12 for q, found in got.items() for v, s in found)


def test_neighbours_of_uneven_lengths():
    """Inner product, not distance: long vectors win."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(3000, 24)) * rng.lognormal(sigma=0.5, size=(3000, 1))
    ids = np.arange(3000)
    got = {a[0][0]: set(a[1]) for a in neighbours.block_nearest(rows[:50], ids[:50], np.full(50, -np.inf), rows, ids, 10, 1.0)}
    want = {q: set([j for j in np.argsort(-(rows @ rows[q])) if j != q][:10]) for q in range(50)}
    assert np.mean([len(got[q] & want[q]) / 10 for q in want]) >= 0.9


def test_neighbours_at_shipped_settings(spark):
    """Several blocks, of which one gives the radius for the others; random directions are the hardest case."""
    rng = np.random.default_rng(10)
    matrix = rng.normal(size=(12_000, 64)).astype(np.float32).astype(float)
    ids = np.arange(12_000)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(matrix.tolist())], "vec_id long, embedding array<float>")
    got = gathered(neighbours.nearest(table, F.expr("pmod(id, 60) = 0"), 20))
    scores = matrix @ matrix[::60].T
    recall = []
    for j, q in enumerate(range(0, 12_000, 60)):
        scores[q, j] = -np.inf
        recall.append(len(dict(got[q]).keys() & set(np.argsort(-scores[:, j])[:20].tolist())) / 20)
    assert len(got) == 200 and np.mean(recall) >= 0.99 and min(recall) >= 0.9


def test_neighbours_verify_few_vectors_and_each_once(monkeypatch):
    """Random directions in a first block and in one with floors; with floors under a third of it is verified."""
    rng = np.random.default_rng(12)
    matrix = rng.normal(size=(8192, 64))
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    ids, seen, scores = np.arange(8192), [], neighbours._scores
    monkeypatch.setattr(neighbours, "_scores", lambda q, left, *rest: seen.append((q, left)) or scores(q, left, *rest))

    def verified(floors, part):
        seen.clear()
        found = neighbours.block_nearest(matrix[:4096:40], ids[:4096:40], floors, matrix[part], ids[part], 20, 0.25)
        for q in range(len(floors)):
            mine = np.concatenate([left for at, left in seen if at == q])
            assert len(mine) == len(set(mine.tolist()))
        return found, sum(len(left) for _, left in seen) / (len(floors) * 4096)

    found, share = verified(np.full(103, -np.inf), slice(0, 4096))
    assert share < 0.9
    floors = np.array([np.sort(scores)[-20] for _, _, scores in found])
    _, share = verified(floors, slice(4096, 8192))
    assert share < 1 / 3


def test_neighbours_plan_follows_distances():
    """The nearer the wanted vectors, the fewer projections; a whole block is verified where no number of them tells near from far."""
    wide, narrow = neighbours.planned(0.3, 1.4), neighbours.planned(1.1, 1.4)
    assert wide[0] == neighbours.LEAST < narrow[0] <= neighbours.MOST and all(0 < threshold < m for m, threshold in (wide, narrow))
    assert neighbours.planned(1.35, 1.4) is None and neighbours.planned(1.0, 0.0) is None
    rng = np.random.default_rng(13)
    rows, ids = np.abs(rng.normal(size=(400, 3))) + 50, np.arange(400)
    for a in neighbours.block_nearest(rows[:5], ids[:5], np.full(5, -np.inf), rows, ids, 90, 1.0):
        scores = rows @ rows[a[0][0]]
        assert a[1].tolist() == [i for i in np.lexsort([ids, -scores]) if i != a[0][0]][:90]


def test_floors_of_early_blocks_keep_top_k_exact(spark, monkeypatch):
    """Many small blocks, equal scores, one id for two vectors, and copies of a vector."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(11)
    matrix = rng.integers(-3, 4, (700, 6))
    matrix[200:300] = matrix[200]
    ids = np.arange(700)
    rows = [(i, v) for i, v in enumerate(matrix.tolist())]
    df = spark.createDataFrame(rows + rows[:30], "vec_id long, embedding array<long>")
    assert gathered(topk.top_k(df, F.expr("pmod(id, 7) = 0"), 5)) == plain(ids, matrix.astype(float), 7, 5)
    twice = spark.createDataFrame([*rows, (7, [9, 9, 9, 9, 9, 9])], "vec_id long, embedding array<long>")
    got = gathered(topk.top_k(twice, F.expr("id = 7"), 5))[7]
    both = sorted(((-int(matrix[i] @ q), i) for q in (matrix[7], np.full(6, 9)) for i in range(700) if i != 7))[:5]
    assert [(i, -s) for s, i in both] == got


@pytest.mark.parametrize("n", [3, 40])
def test_odd_vectors(spark, n):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, -float(i)]) for i in range(n)]
    odd = [(100, None), (200, []), (300, [None, 1.0, 2.0]), (400, [nan, 1.0, 2.0]), (500, [inf, 0.0, 0.0]), (None, [1.0, 2.0, 3.0]), (0, rows[0][1]), (600, [1.0, 2.0])]
    zero = [(700, [0.0, 0.0, 0.0])]
    table = lambda r: spark.createDataFrame([(*x, 1) for x in r], "vec_id long, embedding array<float>, rank int")
    query = F.expr("pmod(id, 2) = 0")
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert gathered(neighbours.nearest(table(rows + odd + zero), query, 5)) == plain(ids, matrix, 2, 5)
    ids, matrix = np.append(ids, 700), np.vstack([matrix, [[0, 0, 0]]])
    assert gathered(topk.top_k(topk.quantized(table(rows + odd + zero)), query, 5)) == plain(ids, np.floor(256 * matrix), 2, 5)
    assert neighbours.nearest(table([]), query, 5).count() == 0 and topk.top_k(table([]), query, 5).count() == 0
