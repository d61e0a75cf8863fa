"""The permutation index and whitening, against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from shopstream.llm import permutation_index as pi
from shopstream.llm import vectors
from shopstream.llm import whitening as wh

EMBEDDINGS = "/root/testdata/sf0.01/embeddings.parquet"


@pytest.fixture
def make_vectors(spark):
    """Rows (vec_id, vector) with extra columns whose names the operators use inside."""
    def make(rows, kind="double"):
        df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows],
                                   f"vec_id long, embedding array<{kind}>")
        for name in ("class", "packed", "band", "shard", "n", "dim", "rank", "score", "place"):
            df = df.withColumn(name, df["vec_id"])
        return df.repartition(3)
    return make


NAN, INF = float("nan"), float("inf")
ODD = [(900, None), (920, []), (940, [1, None, 2]), (960, [1, NAN, 2]), (980, [1, INF, 2]), (1000, [-INF, 0, 0]), (1020, [1, 2])]


def test_packed_rows_are_canonical():
    x = np.array([[1, -2], [300, 0], [1 << 40, 5], [-(1 << 20), 1]], np.int64)
    assert (vectors.unpack_rows(vectors.pack_rows(x)) == x).all()
    assert [len(p) for p in vectors.pack_rows(x)] == [3, 5, 17, 9]
    f = np.array([[0.5, 1e300], [0.1, 2.0], [0.25, -3.0]])
    assert (vectors.unpack_rows(vectors.pack_rows(f)) == f).all()
    assert [len(p) for p in vectors.pack_rows(f)] == [17, 17, 9]


# ---------------------------------------------------------------- neighbours

def _plain_neighbours(rows, k):
    """Counts of (query_id, rank, vec_id) and scores, over all pairs of rows."""
    x = np.array([v for _, v in rows], float)
    out = []
    for i, (query, _) in enumerate(rows):
        if query % 20 == 0:
            score = (x * x[i]).sum(axis=1)
            order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-score[j], rows[j][0]))[:k]
            out += [(query, n + 1, rows[j][0], score[j]) for n, j in enumerate(order)]
    return Counter(out)


def _found(df):
    return Counter(tuple(r) for r in df.collect())


def test_neighbours_small_tables_are_exact(make_vectors):
    rng = np.random.default_rng(1)
    for n in (2, 5, 60):  # fewer rows than k, and fewer than a shard reranks
        rows = [(i, rng.integers(-4, 5, 6)) for i in range(n)]
        rows = [(i, v if np.any(v) else v + 1) for i, v in rows]
        assert _found(pi.nearest_neighbours(make_vectors(rows))) == _plain_neighbours(rows, 20)
    assert _found(pi.nearest_neighbours(make_vectors([(0, [1, 2])]))) == Counter()
    assert _found(pi.nearest_neighbours(make_vectors([]))) == Counter()


def test_neighbours_repeated_rows_ties_and_odd_vectors(make_vectors):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(0, [1.0, 2.0, 3.0]), (20, [5.0, 0.0, -1.0]), (60, [3.0, 2.0, 1.0]),
                                                        (60, [1.0, 2.0, 3.0]), (61, [-0.0, 1.0, 0.0]), (62, [0.0, 1.0, 0.0])]
    odd = ODD + [(None, [1.0, 2.0, 3.0]), (1040, [0.0, 0.0, 0.0]), (1060, [0.0, -0.0, 0.0])]
    assert _found(pi.nearest_neighbours(make_vectors(rows + odd))) == _plain_neighbours(rows, 20)


def test_neighbours_of_vectors_with_very_different_norms(make_vectors):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8) * 10.0 ** rng.integers(-3, 4)) for i in range(400)]
    got, want = _found(pi.nearest_neighbours(make_vectors(rows), rerank=3)), _plain_neighbours(rows, 20)
    assert len(got) == len(want)
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) >= 0.9 * sum(want.values())


def test_closeness_is_the_footrule_of_prefixes():
    rng = np.random.default_rng(3)
    x, pivots = rng.standard_normal((50, 7)), rng.standard_normal((20, 7))
    shard = pi.Shard(x, pivots, prefix=8)
    order = pi.first_pivots(pi._lifted(x, pi.norms(x), float(pi.norms(x).max())), shard.pivots, 8)
    place = np.full((50, 20), 8)
    np.put_along_axis(place, order, np.arange(8)[None, :], 1)
    for i in range(10):
        footrule = np.abs(place - place[i]).sum(axis=1)
        assert (8 * 9 - 2 * shard.closeness(order[i]) == footrule).all()


def test_shards_hold_every_band_once():
    for bands in ({0: 100}, {0: 5, 1: 5, 2: 5}, {i: i * 7 + 1 for i in range(-20, 20)}, {0: 1000, 5: 1}):
        dealt = pi.deal_shards(bands, 50)
        assert dealt.keys() == bands.keys()
        load = Counter()
        for band, (first, parts) in dealt.items():
            for s in range(first, first + parts):
                load[s] += bands[band] / parts
        assert max(load.values()) <= 100 and set(load) == set(range(max(load) + 1))


@pytest.mark.parametrize("cluster", [0, 700])
def test_recall(make_vectors, spark, cluster):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(4)
    if cluster:  # near copies of one vector, a third of the table
        near = np.array(rows[0][1]) + rng.standard_normal((cluster, len(rows[0][1]))) * 0.015
        rows = rows[:1400] + [(10_000 + i, v) for i, v in enumerate(near)]
    got, want = _found(pi.nearest_neighbours(make_vectors(rows), rerank=8)), _plain_neighbours(rows, 20)
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) >= 0.9 * sum(want.values())
    exact = {(q, v): s for q, _, v, s in want}
    assert all(abs(exact[q, v] - s) < 1e-12 for q, _, v, s in got if (q, v) in exact)


def test_results_do_not_depend_on_the_order_of_rows(spark):
    df = spark.read.parquet(EMBEDDINGS)
    assert _found(pi.nearest_neighbours(df, rerank=2)) == _found(pi.nearest_neighbours(df.repartition(7), rerank=2))


# ---------------------------------------------------------------- whitening

def _covariance(x):
    c = x - x.mean(axis=0)
    return c.T @ c / len(x)


@pytest.mark.parametrize("seed", range(8))
def test_decomposition_against_numpy(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 30))
    x = rng.standard_normal((int(rng.integers(2, 60)), d)) @ rng.standard_normal((d, d))
    v = _covariance(x)
    order, factor = wh.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[np.ix_(order, order)], atol=1e-12 * np.abs(v).max())
    assert np.allclose(np.triu(factor, 1), 0)
    values, parts = wh.components_of(v)
    want = np.linalg.eigvalsh(v)[::-1]
    assert len(values) == np.linalg.matrix_rank(v, hermitian=True)
    assert np.allclose(values, want[:len(values)], rtol=1e-9, atol=1e-13 * want[0])
    assert np.allclose(parts @ parts.T, np.eye(len(parts)), atol=1e-10)
    assert np.allclose(v @ parts.T, parts.T * values, atol=1e-11 * want[0])


def test_small_eigenvalues_of_badly_scaled_data():
    rng = np.random.default_rng(9)
    scale = 10.0 ** np.array([8, 0, -6])
    v = _covariance(rng.standard_normal((500, 3))) * np.outer(scale, scale)
    values, _ = wh.components_of(v)
    from fractions import Fraction

    det = Fraction(0)  # product of the eigenvalues, exactly
    f = [[Fraction(float(x)) for x in row] for row in v]
    for i, j, k, s in ((0, 1, 2, 1), (1, 2, 0, 1), (2, 0, 1, 1), (2, 1, 0, -1), (1, 0, 2, -1), (0, 2, 1, -1)):
        det += s * f[0][i] * f[1][j] * f[2][k]
    assert abs(np.prod(values) / float(det) - 1) < 1e-9


def _plain_whitening(rows, most=4):
    x = np.floor(256 * np.array([v for _, v in rows], float))
    fit = np.unique(x, axis=0)
    values, parts = np.linalg.eigh(_covariance(fit))
    values, parts = values[::-1][:most], parts.T[::-1][:most]
    n, s = len(fit), fit.sum(axis=0)
    return fit, values, (x - s / n) @ parts.T / np.sqrt(values), ((n * x - s) ** 2).sum(axis=1), n


def test_whitening_against_numpy(spark, make_vectors):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(EMBEDDINGS).collect()]
    rows += rows[:150] * 2 + [(None, rows[3][1])]  # copies do not weigh
    got = wh.whiten(make_vectors(rows + ODD, "float")).collect()
    fit, values, white, deviation, n = _plain_whitening(rows)
    assert len(got) == 4 * len(rows)
    trace = np.trace(_covariance(fit))
    at = {}
    for i, (vec_id, _) in enumerate(rows):
        at.setdefault(vec_id, i)
    sign = {}
    for r in got:
        i, c = at[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviation[i])
        assert abs(r.explained / (values[c] / trace) - 1) < 1e-9 and r.identity_error < 1e-9
        if abs(white[i, c]) > 1e-3:
            s = sign.setdefault(c, np.sign(r.whitened * white[i, c]))
            assert abs(s * r.whitened - white[i, c]) < 1e-6
    assert set(sign) == {0, 1, 2, 3}


def test_whitening_of_few_directions(make_vectors):
    line = [(i, [i, 2 * i, -i]) for i in range(10)] + [(20, [0, 0, 0])]
    got = wh.whiten(make_vectors(line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 11 and {r.n for r in got} == {10}
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in got)
    plane = [(i, [i, i * i, 7]) for i in range(10)]
    assert {r.component for r in wh.whiten(make_vectors(plane)).collect()} == {1, 2}
    for rows in ([], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])], ODD[:6]):
        assert wh.whiten(make_vectors(rows)).collect() == []


def test_whitening_of_huge_values(make_vectors):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.5]), (3, [0.0, 0.25]), (4, [1e17, 1.0])]
    got = wh.whiten(make_vectors(rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4} and all(r.deviation is None for r in got)
    assert all(np.isfinite(r.whitened) for r in got)


def test_equal_vectors_have_equal_values(make_vectors):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(16)) for i in range(300)]
    got = wh.whiten(make_vectors(rows + [(i + 1000, v) for i, v in rows])).collect()
    value = {(r.vec_id, r.component): r.whitened for r in got}
    assert all(value[i, c] == value[i + 1000, c] for i in range(300) for c in range(1, 5))
