"""The pivot index finds as many pairs at the threshold among few reference points as among many."""

import numpy as np
import pytest

from plumbline.llm import pivots


@pytest.mark.parametrize("n", [10**3, 10**5, 10**7, 10**9])
def test_recall_does_not_fall_with_the_table(n):
    rng = np.random.default_rng(n % 97)
    points, x, z = (pivots.unit(rng.standard_normal((k, 64))) for k in (round(pivots.PIVOTS * n ** (1 / 3)), 1000, 1000))
    z = pivots.unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.9**2) * z
    pairs = zip(pivots.nearest(x, points).tolist(), pivots.nearest(y, points).tolist())
    assert np.mean([len(set(a) & set(b)) >= pivots.SHARED for a, b in pairs]) >= 0.975


def planted(n, seed):
    """Random vectors, half of them with a partner at a cosine of 0.90 to 0.93, and all linked pairs by brute force."""
    rng = np.random.default_rng(seed)
    x = pivots.unit(rng.standard_normal((n // 2, 64)))
    z = pivots.unit(rng.standard_normal((n // 2, 64)))
    z = pivots.unit(z - (z * x).sum(1, keepdims=True) * x)
    cosine = rng.uniform(0.9, 0.93, (n // 2, 1))
    rows = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * z])
    close = np.triu(rows @ rows.T >= 0.9, 1)
    return rows, close + close.T


def query_recall(spark, n, seed=1):
    """Of the links of all vectors the share that the whole query finds; it must find no other."""
    rows, links = planted(n, seed)
    frame = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, n int, near string")
    got = {r.vec_id: r.n_links for r in pivots.near_vectors(frame.repartition(8)).collect()}
    assert len(got) == n and all(got[i] <= k for i, k in enumerate(links.sum(1).tolist()))
    return sum(got.values()) / links.sum()


@pytest.mark.parametrize("n", [600, 3000])
def test_the_query_finds_planted_pairs(spark, n):
    assert query_recall(spark, n) >= 0.95


def test_sparse_and_dense_verification_agree(monkeypatch):
    rows, _ = planted(400, 3)
    near = pivots.nearest(rows, pivots.unit(np.random.default_rng(4).standard_normal((40, 64))))
    found = []
    for dense in (0, 10**9):
        monkeypatch.setattr(pivots, "DENSE", dense)
        found.append([pivots.linked_pairs(rows, near, rows, near, here, 0.9) for here in range(40)])
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(*found)) and sum(len(a) for a, _ in found[0]) > 200


def test_nearest_points_in_order():
    rng = np.random.default_rng(5)
    rows, points = pivots.unit(rng.standard_normal((50, 8))), pivots.unit(rng.standard_normal((300, 8)))
    want = np.argsort(-(rows @ points.T), axis=1, kind="stable")[:, : pivots.depth(300)]
    assert (pivots.nearest(rows, points) == want).all() and pivots.nearest(rows, points[:5]).shape == (50, 5)


def test_reference_points_are_apart_and_as_many_as_asked():
    rng = np.random.default_rng(6)
    vectors = [*rng.standard_normal((200, 16)), *rng.standard_normal((50, 4))]
    chosen = pivots.choose_pivots(vectors, 60)
    assert sum(map(len, chosen.values())) == 60 and chosen[16].shape == (60, 16)
    gram = chosen[16] @ chosen[16].T - np.eye(60)
    assert gram.max() < pivots.APART and pivots.choose_pivots([], 5) == {}
