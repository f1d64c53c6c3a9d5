"""Whitening against a dense eigendecomposition in exact whole numbers."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeproof.llm import whitening
from lakeproof.llm.whitening import Spectrum, op11_incremental_whitening, rank_one


def scatter(e, q):
    return (q * e) @ q.T


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 12), st.integers(0, 3), st.integers(0, 10 ** 6))
def test_rank_one_updates_give_the_spectrum(d, rows, kind, seed):
    """Random, equal, zero and unit vectors, so that every kind of deflation occurs."""
    rng = np.random.default_rng(seed)
    e, q, want = np.zeros(d), np.eye(d), np.zeros((d, d))
    for i in range(rows):
        v = (rng.normal(size=d), np.ones(d), np.zeros(d) if i % 2 else rng.integers(-2, 3, d).astype(float),
             np.eye(d)[rng.integers(d)] * 1e3)[kind]
        e, q = rank_one(e, q, v)
        want += np.outer(v, v)
    size = max(1.0, np.abs(want).max())
    assert np.allclose(scatter(e, q) / size, want / size, atol=1e-12)
    assert np.allclose(q.T @ q, np.eye(d), atol=1e-12) and (np.diff(e) >= 0).all()


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 8), st.lists(st.integers(1, 40), min_size=1, max_size=5), st.integers(0, 10 ** 6))
def test_merged_spectra_are_those_of_all_vectors(d, sizes, seed):
    rng = np.random.default_rng(seed)
    blocks = [rng.normal(rng.normal(size=d) * 5, 1, (n, d)) for n in sizes]
    whole = Spectrum.empty(d)
    for block in blocks:
        part = Spectrum.empty(d)
        part.add(block)
        whole.merge(part)
    x = np.concatenate(blocks)
    assert whole.n == len(x) and np.allclose(whole.mean, x.mean(axis=0))
    assert np.allclose(scatter(whole.e, whole.q), (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), atol=1e-9 * len(x))


def brute(rows, k=4):
    """rows: (vec_id, list); (vec_id, component) -> list of (n, deviation, |whitened|, explained)."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in ok if v]
    d = max(sizes, key=lambda s: (sizes.count(s), s))
    xs = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in ok if len(v) == d]
    fit = sorted(set(x for _, x in xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    scaled = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    e, q = np.linalg.eigh(scaled.T @ scaled / n)
    out = {}
    for i, x in xs:
        gap = [n * a - s for a, s in zip(x, sums)]
        for c in range(k):
            if e[-1 - c] > 1e-12 * e.sum():
                w = np.array(gap, float) / n @ q[:, -1 - c] / math.sqrt(e[-1 - c])
                out.setdefault((i, c + 1), []).append((n, sum(g * g for g in gap), abs(w), e[-1 - c] / e.sum()))
    return out


def check(spark, folder, rows):
    want, got = brute(rows), {}
    for r in op11_incremental_whitening(spark, str(folder)).collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(
            (r["n"], r["deviation"], abs(r["whitened"]), r["explained"], r["identity_error"]))
    assert got.keys() == want.keys()
    for key, some in want.items():
        assert len(some) == len(got[key])
        for a, b in zip(sorted(some), sorted(got[key])):
            assert a[:2] == b[:2] and b[4] < 1e-10
            assert b[2] == pytest.approx(a[2], abs=1e-9) and b[3] == pytest.approx(a[3], rel=1e-9)
    return got


def test_awkward_table(spark, tables):
    t = pq.read_table(f"{tables}/embeddings.parquet").to_pydict()
    check(spark, tables, list(zip(t["vec_id"], t["embedding"])))


def write(folder, rows):
    pq.write_table(pa.table({"vec_id": pa.array([i for i, _ in rows], pa.int64()),
                             "embedding": pa.array([v for _, v in rows], pa.list_(pa.float64())),
                             "n": pa.array(["clash"] * len(rows)), "x": pa.array([0] * len(rows))}),
                   folder / "embeddings.parquet")


def test_hot_vector_nulls_and_huge_ids(spark, tmp_path, monkeypatch):
    """A third of all rows is one vector; ids beside 2**63 among nulls; a
    deviation over many blocks and partitions."""
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1 << 10)
    rng = np.random.default_rng(5)
    rows = [(None if i % 9 == 0 else (1 << 63) - 1 - i, (rng.normal(size=6) * [9, 5, 3, 1, .5, .1]).tolist())
            for i in range(300)]
    rows += [((1 << 62) + i, rows[3][1]) for i in range(150)] + [(7, []), (8, [math.inf] * 6), (9, [None] * 6), (10, None)]
    write(tmp_path, rows)
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("vectors,components", [([[1.0, 2.0]] * 3, 0), ([[1.0, 2.0], [2.0, 4.0], [3.0, 6.0]], 1), ([[]], 0)])
def test_components_without_variance_are_left_out(spark, tmp_path, vectors, components):
    write(tmp_path, list(enumerate(vectors)))
    got = op11_incremental_whitening(spark, str(tmp_path)).collect()
    assert len(got) == components * len(vectors)
