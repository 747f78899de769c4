"""Temporal patterns against plain agglomeration."""

import numpy as np
import pytest

from plotloom.growth import patterns as P


def plain_clusters(vectors, k):
    clusters = [[i] for i in range(len(vectors))]
    distance = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(axis=2))
    while len(clusters) > k:
        pairs = [(distance[np.ix_(a, b)].max(), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j]
        _, i, j = min(pairs)
        clusters[i] += clusters.pop(j)
    return {frozenset(c) for c in clusters}


def labelled(labels):
    return {frozenset(np.flatnonzero(labels == v).tolist()) for v in set(labels.tolist())}


@pytest.mark.parametrize("seed, k", [(1, 4), (2, 4), (3, 2), (4, 7), (5, 1)])
def test_chains_give_the_clusters_of_plain_agglomeration(seed, k):
    draw = np.random.default_rng(seed)
    vectors = draw.normal(0, 1, (60, 5)) + draw.integers(0, 4, 60)[:, None] * 2
    labels = P.cut(P.merges(vectors), 60, k)
    assert labelled(labels) == plain_clusters(vectors, k)
    assert labels[0] == 0 and len(set(labels.tolist())) == k


def test_heights_are_the_distances_of_the_merged():
    draw = np.random.default_rng(8)
    vectors = draw.normal(0, 1, (40, 3))
    heights = sorted(m[0] for m in P.merges(vectors))
    whole = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(axis=2)).max()
    assert len(heights) == 39 and heights[-1] == pytest.approx(whole)


def matrix_of(spark, vectors):
    rows = [(i, *map(float, v)) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double").repartition(4)


def test_few_series_are_clustered_as_they_are(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(0, 1, (50, 3))
    vectors = np.concatenate([vectors, vectors[:10]])  # repeated series
    found = sorted(P.trajectory_groups(matrix_of(spark, vectors), "id", list("abc"), 4).collect())
    labels = np.array([r["pattern"] for r in found])
    assert labelled(labels) == plain_clusters(vectors, 4)
    assert all(r["radius"] < 1e-6 for r in found)


def test_many_series_go_with_centres(spark, monkeypatch):
    monkeypatch.setattr(P, "MICRO", 40)
    draw = np.random.default_rng(6)
    middle = draw.integers(0, 4, 400)
    vectors = draw.normal(0, 0.2, (400, 3)) + middle[:, None] * np.array([10.0, 0, 5])
    found = sorted(P.trajectory_groups(matrix_of(spark, vectors), "id", list("abc"), 4).collect())
    assert labelled(np.array([r["pattern"] for r in found])) == labelled(middle)
    assert 0 < max(r["radius"] for r in found) < 2


def test_empty_cells_and_tables(spark):
    frame = spark.createDataFrame([(1, 1.0, None, None), (2, 2.0, None, 4.0), (None, None, None, 4.0)], "id int, a double, b double, c double")
    found = P.trajectory_groups(frame, "id", list("abc"), 4).collect()
    assert len(found) == 3 and {r["id"] for r in found} == {1, 2, None}
    assert P.trajectory_groups(frame.limit(0), "id", list("abc"), 4).count() == 0
