"""Whitening against numpy in one place, and on the rows that have no covariance."""

import numpy as np
import pytest

from contentrisk.llm import whitening


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, 1.0) for i, v in rows], "vec_id long, embedding array<double>, n int, whitened double")


def check(rows, out, components=32):
    """``rows``: sound ones of one length; ``out``: collected results."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    assert len(out) == n * k and {r.component for r in out} == set(range(1, k + 1)) and {r.n for r in out} == {n}
    w = c @ v[:, :k] / np.sqrt(e[:k])
    want, have = {}, {}
    for (i, _), row, d in zip(rows, w, deviation):
        want.setdefault((i, d), []).append(row)
    for r in out:
        have.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    assert set(want) == set(have)
    for j in range(k):
        a = np.concatenate([np.sort([row[j] for row in want[key]]) for key in sorted(want, key=str)])
        b = np.concatenate([np.sort(have[key][j + 1]) for key in sorted(want, key=str)])
        c = np.concatenate([np.sort([-row[j] for row in want[key]]) for key in sorted(want, key=str)])
        assert min(np.abs(a - b).max(), np.abs(c - b).max()) < 1e-8
    assert max(abs(r.explained / (e[r.component - 1] / e.sum()) - 1) for r in out) < 1e-9
    assert max(r.identity_error for r in out) < 1e-9


def vectors(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=dim) * np.linspace(3, 0.5, dim) + 5).tolist()) for i in range(n)]


def test_equals_numpy(spark, monkeypatch):
    rows = vectors(230, 7)
    rows += [(3, rows[3][1]), (None, rows[5][1])]
    odd = [(900, None), (901, []), (902, [1.0, None] + [0.0] * 5), (903, [float("nan")] * 7), (904, [float("inf")] + [0.0] * 6), (905, [-float("inf")] * 7)]
    df = frame(spark, rows + odd).repartition(6)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, out.collect())
    check(rows, whitening.whiten(df, 3).collect(), 3)
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 12)      # many blocks both ways, many groups of them
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 4)
    check(rows, whitening.whiten(df).collect())


def test_lengths_are_whitened_apart(spark):
    a, b = vectors(40, 4), [(i + 1000, v) for i, v in vectors(60, 6, 1)]
    out = whitening.whiten(frame(spark, a + b).repartition(3)).collect()
    check(a, [r for r in out if r.vec_id < 1000])
    check(b, [r for r in out if r.vec_id >= 1000])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_no_rows(spark, rows):
    assert whitening.whiten(frame(spark, rows)).count() == 0


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [*v, v[0] + 1]) for i, v in vectors(50, 3)]      # the last is the first, moved
    rows = [(i, [x, y, z, x]) for i, (x, y, z, _) in rows]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in out} == {1, 2, 3}
    check(rows, out)


def test_numbers_have_no_gaps(spark):
    df = spark.range(1000, numPartitions=7).filter("id % 3 = 0 AND (id < 150 OR id > 700)")
    got = whitening.numbered(whitening.placed(df, "numbers")).collect()
    assert sorted(r.row for r in got) == list(range(len(got)))


def test_too_long(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_DIMENSIONS", 3)
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, vectors(4, 4)))
