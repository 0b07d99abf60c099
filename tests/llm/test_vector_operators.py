"""Nearest neighbours and whitening against brute force."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest

from spanfan.llm import neighbours, whitening

DDL = "vec_id long, embedding array<float>, label int, v string, n string, cell string, block string, query string, whitened string"
PLAIN = (None,) * 7


def table(vectors) -> list[tuple]:
    return [(i, v, *PLAIN) for i, v in vectors]


BAD = [(7001, None), (7002, [1.0, None, 0.0]), (7003, [float("nan")] * 3), (7100, [float("inf"), 0.0]), (7004, [0.0] * 6), (None, [1.0] * 6)]


def brute(rows: list[tuple], every: int, k: int) -> dict:
    """query id -> [(score, vec_id)], over rows with usable vectors."""
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            ok.setdefault(i, v)
    d = max(len(v) for v in ok.values())
    ids = np.array(list(ok))
    x = np.zeros((len(ids), d))
    for at, v in enumerate(ok.values()):
        x[at, : len(v)] = np.asarray(v, dtype=np.float32)
    out = {}
    for q in ids[ids % every == 0].tolist():
        score = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, score)) if ids[j] != q][:k]
        out[q] = [(score[j], ids[j]) for j in order]
    return out


def clusters(n: int, d: int, seed: int) -> list:
    rnd = np.random.default_rng(seed)
    middle = rnd.standard_normal((max(2, n // 60), d)) * 3
    return (middle[rnd.integers(0, len(middle), n)] + rnd.standard_normal((n, d))).astype(np.float32).tolist()


def answers(spark, rows, **kw) -> dict:
    df = neighbours.usable(spark.createDataFrame(rows, DDL))
    got = {}
    for q, rank, i, score in neighbours.nearest(df, df.filter("vec_id % 100 = 0"), **kw).collect():
        got.setdefault(q, []).append((rank, score, i))
    for q, found in got.items():
        assert sorted(r for r, _, _ in found) == list(range(1, len(found) + 1))
        assert sorted(found) == sorted(found, key=lambda r: (r[1], r[2]))
    return {q: [(s, i) for _, s, i in sorted(found)] for q, found in got.items()}


def test_chi_square_law():
    assert abs(neighbours.chi_square_cdf(neighbours.chi_square_quantile(0.95)) - 0.95) < 1e-9
    assert abs(neighbours.chi_square_quantile(0.95, 8) - 15.507) < 1e-3  # table of the chi-square law


@pytest.mark.parametrize("block_bytes", [neighbours.BLOCK_BYTES, 64 * 8 * 24])
def test_recall_and_scores(spark, block_bytes):
    """One block, and 32 cells with several chunks of queries."""
    rows = table(enumerate(clusters(4000, 24, 3)))
    want = brute(rows, 100, 10)
    got = answers(spark, rows, block_bytes=block_bytes, per_block=15)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    exact = {q: dict((i, s) for s, i in brute(rows, 100, 4000)[q]) for q in list(want)[:5]}
    assert all(abs(exact[q][i] - s) < 1e-12 for q in exact for s, i in got[q])


def test_ties_copies_and_bad_rows(spark):
    """A vector that a third of the rows share, repeated rows, and vectors that take no part."""
    vectors = clusters(300, 6, 5)
    rows = table([(i, vectors[i] if i % 3 else vectors[0]) for i in range(300)])
    rows += [rows[0], rows[5], rows[5]] + table(BAD) + table([(900, [0.5, 0.25]), (901, [0.5, 0.25, 0.0])])
    want = brute(rows, 100, 10)
    got = answers(spark, rows, confidence=1 - 1e-12)
    assert {q: [i for _, i in f] for q, f in got.items()} == {q: [i for _, i in f] for q, f in want.items()}
    assert got[900][0] == (0.0, 901)


def test_few_or_no_candidates(spark):
    rows = table([(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])
    assert answers(spark, rows) == {100: [(1.0, 2), (np.sqrt(2.0), 1)]}
    assert answers(spark, table(BAD)) == {} == answers(spark, [])
    assert answers(spark, table([(1, [1.0])])) == {} == answers(spark, table([(100, [1.0])]))


def exact_statistics(x: list[list[int]]):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    p = [[sum(r[i] * r[j] for r in x) for j in range(d)] for i in range(d)]
    return n, s, p


@pytest.mark.parametrize("spread", [1, 60_000, 1 << 50, 1 << 61])
def test_bit_slices_give_exact_cross_products(spread):
    rnd = random.Random(spread)
    x = [[rnd.randrange(-spread, spread + 1) for _ in range(5)] + [3] for _ in range(333)]
    n, s, p = exact_statistics(x)
    block = np.array(x, dtype=np.int64)
    got = whitening.cross_products(block)
    assert all(got[i, j] == p[i][j] for i in range(6) for j in range(i, 6)) and list(whitening._sums(block)) == s


def whitened(spark, rows, tmp_path):
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/embeddings.parquet")
    return whitening.op12_whitening(spark, str(tmp_path))


def test_whitening_equals_numpy(spark, tmp_path):
    vectors = clusters(700, 12, 9)
    rows = table(enumerate(vectors)) + table(BAD[:4]) + [(None, vectors[0], *PLAIN), (5, vectors[5], *PLAIN), (8000, [0.5], *PLAIN)]
    used = [(i, np.pad(v, (0, 12 - len(v)))) for i, v, *_ in rows if v is not None and None not in v and np.isfinite(v).all()]
    x = np.floor(1024 * np.array([np.float32(v) for _, v in used], dtype=np.float64)).astype(np.int64) + 100_000
    n, s, _ = exact_statistics(x.tolist())
    cov = np.cov(x.T.astype(float), bias=True)
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1][:8], axes[:, ::-1][:, :8]
    z = (x - np.array(s) / n) @ axes / np.sqrt(e)
    got = whitened(spark, rows, tmp_path).collect()
    assert len(got) == 8 * len(used) and {r["n"] for r in got} == {n}
    by_component = {}
    for r in got:
        by_component.setdefault(r["component"], []).append(r)
    deviation = sorted(sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x.tolist())
    for c in range(1, 9):
        own = by_component[c]
        assert sorted(r["deviation"] for r in own) == deviation == sorted(int(r["deviation_exact"]) for r in own)
        assert abs(own[0]["explained"] - e[c - 1] / np.trace(cov)) < 1e-12 and own[0]["identity_error"] < 1e-9
        there = sorted((str(r["vec_id"]), abs(r["whitened"])) for r in own)
        here = sorted((str(i), abs(v)) for (i, _), v in zip(used, z[:, c - 1]))
        assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-8 for a, b in zip(there, here))


def test_whitening_without_variance_or_rows(spark, tmp_path):
    got = whitened(spark, table([(1, [1.0, 2.0, 0.0]), (2, [2.0, 2.0, 0.0]), (3, [2.0, 2.0])]), tmp_path / "a").collect()
    assert len(got) == 9 and {r["component"] for r in got if r["whitened"] is not None} == {1}
    assert got[0]["identity_error"] < 1e-12 and abs(got[0]["explained"] - 1) < 1e-12
    same = whitened(spark, table([(1, [0.5, 0.5]), (2, [0.5, 0.5])]), tmp_path / "b").collect()
    assert [(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in same] == [(None, None, 0, None)] * 4
    for name, rows in (("c", []), ("d", table(BAD[:4])), ("e", table([(1, [])]))):
        assert whitened(spark, rows, tmp_path / name).count() == 0


def test_deviation_beyond_a_long(spark, tmp_path):
    rows = table([(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [1e300, 0.0])])  # the last has no place in a long
    got = whitened(spark, rows, tmp_path).collect()
    x = [[int(1024 * float(np.float32(1e12))) + 100_000, 100_000], [int(-1024 * float(np.float32(1e12))) + 100_000, 101_024]]
    want = {i + 1: sum((2 * a - b - c) ** 2 for a, b, c in zip(row, *x)) for i, row in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation_exact"]) for r in got} == want and {r["deviation"] for r in got} == {None}
    assert Fraction(want[1]) > 2**63
