"""Nearest neighbours and near-duplicates of vectors against brute force."""

import numpy as np

from cartpulse.llm import nn_descent, pivots
from cartpulse.llm.queries import ORACLES, QUERIES
from oracle_check import connect, differences

BAD = [None, [], [0.0] * 8, [1.0] * 7 + [None], [1.0] * 7 + [float("nan")],
       [1.0] * 7 + [float("inf")]]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2) for i, v, label in rows],
                                 "vec_id long, embedding array<float>, label int, node int, "
                                 "key int")


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, 8))
    near = centres[rng.integers(0, len(centres), n)] + 0.05 * rng.standard_normal((n, 8))
    return near.astype(np.float32)


def test_neighbours_against_brute_force(spark):
    vectors = clustered(1500, 1)
    vectors[10] = vectors[11] = vectors[50]          # ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(5000 + 50 * i, v, 0) for i, v in enumerate(BAD)] + [(0, rows[0][1], 0)]
    found = nn_descent.nearest(frame(spark, rows), lambda key: key % 50 == 0,
                               neighbours=12, leaf=100).collect()
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == set(range(0, 1500, 50))
    hits = 0
    for q, held in by_query.items():
        score = units @ units[q]
        score[q] = -9
        best = np.lexsort((np.arange(len(units)), -score))[:5]
        hits += len(set(best) & {r.vec_id for r in held})
        assert [r["rank"] for r in held] == [1, 2, 3, 4, 5]
        assert all(abs(score[r.vec_id] - r.score) < 1e-12 for r in held)
    assert hits / (5 * len(by_query)) >= 0.9
    assert [r.vec_id for r in by_query[50]][:2] == [10, 11]


def recall(found, vectors, k=5):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    held = {}
    for r in found:
        held.setdefault(r.query_id, set()).add(r.vec_id)
    hits = {}
    for q in range(0, len(vectors), 50):
        score = units @ units[q]
        score[q] = -9
        hits[q] = len(set(np.argsort(-score)[:k].tolist()) & held[q]) / k
    return hits


def test_recall_inside_a_tight_third(spark):
    """A third of the rows has pairwise cosines of 0.9999; they stay apart."""
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((3000, 64))
    vectors[::3] = vectors[0] + 0.01 * np.linalg.norm(vectors[0]) / 8 * rng.standard_normal(
        (1000, 64))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<double>")
    hits = recall(nn_descent.nearest(rows, lambda key: key % 50 == 0).collect(), vectors)
    assert np.mean(list(hits.values())) >= 0.9
    assert np.mean([h for q, h in hits.items() if q % 3 == 0]) >= 0.9


def test_rounds_improve_the_graph(spark):
    rng = np.random.default_rng(10)
    vectors = rng.standard_normal((2000, 24))
    centres = {24: vectors[:30] / np.linalg.norm(vectors[:30], axis=1, keepdims=True)}
    codes = nn_descent.coded(vectors, centres[24])
    nodes = spark.createDataFrame([(i, bytearray(u.tobytes())) for i, u in enumerate(codes)],
                                  "node long, code binary")
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = units @ units.T
    np.fill_diagonal(near, -2)
    best = np.argsort(-near, axis=1)[:, :10]
    shares = []
    for rounds in (0, None):
        graph = nn_descent.neighbour_graph(nodes, centres, neighbours=20, trees=3, leaf=60, rounds=rounds)
        held = {r.node: set(r.ids) for r in graph.collect()}
        shares.append(np.mean([len(held[i] & set(best[i].tolist())) / 10 for i in range(2000)]))
    assert shares[0] < 0.5 and shares[1] > 0.9


def test_few_and_equal_vectors(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [1.0], 0),
            (50, [1.0, 0.0], 1)]
    found = nn_descent.nearest(frame(spark, rows), lambda key: key % 50 == 0).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in found)
    assert got == [(0, 1, 1), (0, 2, 50), (0, 3, 2), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    nothing = frame(spark, rows).limit(0)
    assert nn_descent.nearest(nothing, lambda key: key % 50 == 0).count() == 0


def by_hand(rows, threshold=0.98):
    valid = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float)), label)
             for i, v, label in rows if v and label is not None
             and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = {i: set() for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, (i, v, a) in enumerate(valid):
        for j, w, b in valid[:n]:
            if a == b and len(v) == len(w) and v @ w >= threshold:
                links[i].add(j)
                links[j].add(i)
                one, two = sorted((find(i), find(j)))
                parent[two] = one
    return {i: (len(links[i]), find(i)) for i, _, _ in rows}


def test_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    vectors = clustered(600, 3)
    vectors[100:160] = vectors[100] + 0.02 * rng.standard_normal((60, 8))
    vectors[300] = vectors[301] = vectors[302]
    rows = [(i, v.tolist(), int(rng.integers(0, 3)) if i % 50 else None)
            for i, v in enumerate(vectors)]
    rows += [(1000 + i, v, 1) for i, v in enumerate(BAD)] + [(2000, [1.0, 0.0], 1),
                                                            (2001, [2.0, 0.0], 1)]
    for part in (16, 1024):
        found = pivots.near_duplicates(frame(spark, rows), part=part).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in found} == by_hand(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_duplicates_in_a_hot_noisy_group(spark):
    rng = np.random.default_rng(11)
    n, size = 24_000, 64
    vectors = rng.standard_normal((n, size))
    centre = vectors[0] / np.linalg.norm(vectors[0])
    vectors[:n // 3] = centre + 0.132 / np.sqrt(size) * rng.standard_normal((n // 3, size))
    vectors = vectors.astype(np.float32)
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    wanted = np.concatenate([(units[a:a + 1000] @ units.T >= 0.98).sum(axis=1) - 1
                             for a in range(0, n, 1000)])
    assert 0.2 < wanted[:n // 3].mean() / (n // 3) < 0.99
    found = pivots.near_duplicates(
        frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)])).collect()
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate(wanted.tolist()))


def test_lists_give_the_candidates():
    """Of one label's thousands of vectors, few pairs are candidates, and all links are."""
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((6000, 64))
    rows[3000:] = rows[:3000] + 0.19 / 8 * np.linalg.norm(
        rows[:3000], axis=1, keepdims=True) * rng.standard_normal((3000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    sample = rows[rng.permutation(6000)[:256]]
    _, bits = pivots.described(rows, sample)
    bits = bits.view("<u8").reshape(len(rows), -1)
    nearest = pivots.described(rows, sample)[0]
    lists = {p: np.flatnonzero((nearest == p).any(axis=1)) for p in range(256)}
    candidates = set()
    for p, held in lists.items():
        a, b = np.nonzero(pivots._sharing(bits[held], bits[held], p))
        pairs = [(i, j) for i, j in zip(held[a].tolist(), held[b].tolist()) if i < j]
        assert not candidates & set(pairs)      # each pair in one list only
        candidates |= set(pairs)
    near = rows @ rows.T >= 0.98
    links = {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near))) if i < j}
    assert len(links) > 1000 and len(links - candidates) <= len(links) / 1000
    assert len(candidates) < 0.05 * 6000 * 5999 / 2


def test_pivots_lie_apart(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((900, 16))
    vectors[:300] = vectors[0] + 0.02 * rng.standard_normal((300, 16))
    rows = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)]).selectExpr(
        "vec_id as key", "cast(embedding as array<double>) as embedding")
    found = pivots._pivots(rows, 0.98)[16]
    near = found @ found.T - 2 * np.eye(len(found))
    assert pivots.LEAST_PIVOTS <= len(found) <= pivots.PIVOTS and near.max() < 0.92


def test_duplicate_edge_tables(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    found = pivots.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.n_links or 0, r.component_id or 0) for r in found) == [
        (0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert pivots.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_duplicates_equal_their_sql(spark, tmp_path):
    con = connect("/root/testdata/sf0.01")
    assert differences(QUERIES["op7_pivot_duplicates"](spark, "/root/testdata/sf0.01"), con,
                       ORACLES["op7_pivot_duplicates"]) == []
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(clustered(200, 6))]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con.execute("DROP VIEW embeddings")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = QUERIES["op7_pivot_duplicates"](spark, str(tmp_path))
    assert differences(found, con, ORACLES["op7_pivot_duplicates"]) == []
    assert found.where("n_links > 0").count() > 50
