from pathlib import Path

import numpy as np
import pytest
from creditlake.llm.cells import Cells, near_copies, spherical_kmeans, unit
from creditlake.llm.queries import op12_spherical_cells

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, key int, cell int, copies int, first string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], SCHEMA).repartition(3)


def plain(rows, cosine=0.98):
    """All pairs of rows with one label."""
    ok = []
    for _, v, l in rows:
        good = l is not None and v and None not in v and np.isfinite(np.array(v, np.float32)).all() and any(v)
        ok.append(np.array(v, np.float32).astype(float) if good else None)
    n = len(rows)
    links, low = [0] * n, list(range(n))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    a, b = root(i), root(j)
                    low[max(a, b)] = min(a, b)
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], links[i], least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=str)


def result(found):
    return sorted((tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def corpus(seed, n=400, dim=24):
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(12, dim))
    for i in range(n):
        kind = rng.random()
        if kind < 0.5:
            v = rng.normal(size=dim)
        elif kind < 0.9:
            c = centres[int(rng.integers(12)) if rng.random() < 0.6 else 0]
            v = c + rng.normal(size=dim) * np.linalg.norm(c) / np.sqrt(dim) * rng.choice([0.05, 0.12, 0.14])
        else:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) * rng.choice([1, 1, 3]) if rows else rng.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("seed, how", [(0, Cells()), (1, Cells(per_cell=20, block=16)), (2, Cells(per_cell=50, block=64, reach=1.0))])
def test_links_match_all_pairs(spark, seed, how):
    rows = corpus(seed)
    assert result(near_copies(frame(spark, rows), how=how)) == plain(rows)


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
        (9, [1.0, None, 3.0], 1), (10, [1.0, float("nan"), 3.0], 1), (11, [1.0, float("inf"), 3.0], 1), (12, [1.0, 2.0], 1),
        (13, [2.0, 4.0], 1), (None, v, 1), (None, [9.0, -1.0, 0.0], 1), (2, v, 1), (14, [-0.0, 1.0, 0.0], 3), (15, [0.0, 1.0, 0.0], 3), (16, v, 4),
        (17, [3e38, 3e38, 3e38], 5), (18, [1e-38, 1e-38, 1e-38], 5),
    ]
    assert result(near_copies(frame(spark, rows))) == plain(rows)


def test_empty_table(spark):
    found = near_copies(frame(spark, []))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"] and found.count() == 0


def test_kmeans_returns_unit_centroids():
    vectors = unit(np.random.default_rng(0).normal(size=500 * 8), 8)
    centroids = spherical_kmeans(vectors, 20, 5)
    assert np.allclose(np.linalg.norm(centroids, axis=1), 1)
    before = (vectors @ vectors[np.linspace(0, 499, 20).astype(int)].T).max(1).mean()
    assert (vectors @ centroids.T).max(1).mean() > before


@pytest.mark.parametrize("folder, least", [("/root/testdata/sf0.1", 0), ("/root/testdata/check_s", 20000)])
def test_recall_on_given_tables(spark, folder, least):
    """Every link that comparing all rows of a label finds, and no other."""
    if not Path(folder).exists():
        pytest.skip("no such tables here")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    vectors = unit(np.array([r[1] for r in rows], np.float32).astype(float).ravel(), len(rows[0][1]))
    labels, ids = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
    links = np.zeros(len(rows), int)
    for label in set(labels):
        at = np.flatnonzero(labels == label)
        links[at] = (vectors[at] @ vectors[at].T >= 0.98).sum(1) - 1
    found = {r["vec_id"]: r["n_links"] for r in op12_spherical_cells(spark, folder).collect()}
    assert sum(found.values()) == links.sum() >= least
    assert found == dict(zip(ids.tolist(), links.tolist(), strict=True))
