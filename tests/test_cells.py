"""Cells give the rows of a scan, whatever the vectors look like."""

from __future__ import annotations

import numpy as np
import pytest

from scholarmill.operators import cells, search
from tests.fixtures import tuples

VECTORS, QUERIES = "vec_id bigint, embedding array<float>", "qid bigint, vector array<double>"


def frames(spark, vectors, queries):
    one = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in vectors], VECTORS)
    two = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in queries], QUERIES)
    return one.repartition(4), two


def clustered(seed, n, groups=12, spread=0.05):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(groups, 6))
    return [(i, centres[pick.integers(groups)] + pick.normal(size=6) * spread) for i in range(n)]


def same(spark, path, vectors, queries, k, **how):
    points, asked = frames(spark, vectors, queries)
    cells.build_cells(points, path, **how)
    index = cells.VectorCells(spark, path)
    found = index.search(asked, k)
    assert sorted(tuples(found.select("qid", "vec_id", "sim", "rk"))) == sorted(
        tuples(search.vector_topk(points, asked, k).select("qid", "vec_id", "sim", "rk")))
    return index


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_same_as_a_scan(spark, tmp_path, spread):
    queries = clustered(2, 25, spread=spread)
    same(spark, str(tmp_path / "c"), clustered(1, 900, spread=spread), queries, 5, cells=16)


def test_equal_vectors_and_parts(spark, tmp_path, monkeypatch):
    """A third of equal vectors and equal queries: ties by id over many parts of one cell."""
    monkeypatch.setattr(cells, "QUERIES_PER_PART", 7)
    vectors = clustered(3, 200) + [(1000 + i, [1, 2, 3, 4, 5, 6]) for i in range(100)]
    queries = clustered(4, 10) + [(100 + i, [1, 2, 3, 4, 5, 6]) for i in range(20)]
    same(spark, str(tmp_path / "c"), vectors, queries, 4, cells=8, per_part=30)


def test_odd_rows(spark, tmp_path):
    vectors = [(1, [0, 0]), (2, None), (3, []), (4, [1, 0]), (5, [-1, 0]), (6, [2, 0])]
    queries = [(1, [1, 0]), (2, [0, 0]), (3, None), (4, [0, 5])]
    same(spark, str(tmp_path / "c"), vectors, queries, 10, cells=4)
    same(spark, str(tmp_path / "d"), vectors[:3], queries, 3)
    same(spark, str(tmp_path / "e"), vectors, [], 3)


def test_far_cells_are_not_opened(spark, tmp_path):
    points, asked = frames(spark, clustered(5, 600, 10, 0.01), clustered(5, 8, 10, 0.01))
    cells.build_cells(points, str(tmp_path / "c"), cells=10)
    index, opened = cells.VectorCells(spark, str(tmp_path / "c")), []
    best = index._best

    def counted(wanted, k):
        opened.append(wanted.count())
        return best(wanted, k)

    index._best = counted
    index.search(asked, 3).collect()
    assert opened[0] == 8 and opened[1] < 8  # of 80 pairs of query and cell


def test_the_sample_is_bounded(spark):
    points, _ = frames(spark, clustered(6, 300), [])
    assert len(cells.fit_centres(points, 12, sample=5)) <= 5
    assert cells.fit_centres(points, 12).shape == (12, 6)
    assert (cells.fit_centres(points, 12) == cells.fit_centres(points.repartition(2), 12)).all()
