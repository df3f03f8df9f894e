"""Left components by block Lanczos: against numpy, with nothing of the matrix's size on the driver."""

import numpy as np
import pytest
from pyspark import RDD

from pluvia.functions import text as tx


def components(spark, a, k, name=str):
    rows = [(name(i), f"t{j}", float(a[i, j])) for i, j in zip(*np.nonzero(a), strict=True)]
    df = tx.truncated_svd(spark.createDataFrame(rows, f"id {'string' if name is str else 'long'}, term string, w double"), "id", "term", "w", k)
    got = df.collect()
    out = np.zeros((len(a), 1 + max((r["component"] for r in got), default=-1)))
    for r in got:
        out[int(r["id"]), r["component"]] = r["value"]
    assert len(got) == out.size
    return out


@pytest.fixture
def collected(monkeypatch):
    """Numbers that each collect of an RDD brings to the driver."""
    seen, real = [], RDD.collect

    def count(x):
        return x.size if isinstance(x, np.ndarray) else sum(map(count, x)) if isinstance(x, (list, tuple)) else 1

    def watched(self):
        out = real(self)
        seen.append(count(out))
        return out

    monkeypatch.setattr(RDD, "collect", watched)
    return seen


def test_many_blocks_of_a_sparse_matrix(spark, monkeypatch, collected):
    from pyspark.mllib.linalg.distributed import IndexedRowMatrix

    from pluvia.operators import lanczos

    monkeypatch.setattr(IndexedRowMatrix, "computeSVD", lambda *_, **__: pytest.fail("the solver's driver side holds k numbers a term"))
    monkeypatch.setattr(lanczos, "BLOCK", 4)
    rng = np.random.default_rng(1)
    a = rng.uniform(0, 1, (150, 4000)) * (rng.uniform(0, 1, (150, 4000)) < 0.03) + 0.2 * np.outer(rng.uniform(0, 1, 150), rng.uniform(0, 1, 4000) < 0.01)
    a[40:50] = a[30:40]  # copies
    got = components(spark, a, 6)
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    want = u[:, :6] * s[:6]
    want *= np.where(want.max(axis=0) >= -want.min(axis=0), 1, -1)
    assert np.allclose(got, want, atol=1e-7)
    assert max(collected) < 4000


def test_components_beyond_the_rank_are_left_out(spark):
    rng = np.random.default_rng(2)
    a = rng.uniform(0, 1, (90, 3)) @ rng.uniform(0, 1, (3, 40))
    got = components(spark, a, 20, int)
    assert got.shape == (90, 3) and np.allclose(got @ got.T, a @ a.T)


def test_equal_values_more_than_a_block_holds(spark):
    got = components(spark, np.eye(70), 40)
    assert got.shape == (70, 40) and np.allclose(got.T @ got, np.eye(40))
