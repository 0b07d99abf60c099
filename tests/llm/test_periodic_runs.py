"""Periodic runs against a brute-force version over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus import DDL, corpus, words

from spanfan.llm import periodic_runs


def brute(w: list) -> list[tuple]:
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(6, 4 * q) and not any(w[i : i + n - p] == w[i + p : i + n] for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts: list[list]) -> list[list[tuple]]:
    names = {x: i for i, x in enumerate({x for t in texts for x in t})}
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    rows = periodic_runs.find_runs(np.array([names[x] for t in texts for x in t], dtype=np.int64), offsets)
    return [[tuple(r[1:]) for r in rows.tolist() if r[0] == k] for k in range(len(texts))]


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(60):
        texts = []
        for _ in range(rnd.randrange(1, 6)):
            w, n = [], rnd.randrange(0, 300)
            while len(w) < n:
                few = rnd.choice([2, 3, 50])
                base = [rnd.randrange(few) for _ in range(rnd.randrange(1, 40))]
                w += (base * rnd.randrange(1, 9))[: rnd.randrange(1, 200)]
                if rnd.random() < 0.3:
                    w[rnd.randrange(len(w))] = 99
            texts.append(w)
        assert found(texts) == [brute(w) for w in texts]


@pytest.mark.parametrize("rule", ["fibonacci", "thue-morse", "nested", "one letter"])
def test_words_with_many_periods(rule):
    if rule == "fibonacci":
        a, b = "a", "ab"
        while len(b) < 600:
            a, b = b, b + a
        w = list(b)
    elif rule == "thue-morse":
        w = [bin(i).count("1") % 2 for i in range(600)]
    elif rule == "nested":
        one = ("a" * 9 + "b") * 5 + "c"
        w = list("xy" + (one * 5 + "d") * 4 + "z")
    else:
        w = ["a"] * 500
    assert found([w, w[3:]]) == [brute(w), brute(w[3:])]


def planted(doc_id, w: list) -> list:
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not w:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def test_query_columns_and_edge_cases(spark, tmp_path):
    """The registered query over nulls, empty, long and repeated texts, and clashing columns."""
    rows = [r for r in corpus() if len(words(r[1])) < 2000]
    rows += [(1000 + i, " ".join(words(rows[i % 24][1]) * 3), *rows[0][2:]) for i in range(40)]
    df = spark.createDataFrame(rows, DDL).withColumnRenamed("tid", "runs").withColumnRenamed("kept", "collapsed")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc_id, text, *_ in rows:
        w = planted(doc_id, words(text))
        runs = brute(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{p}\n" for s, n, p in runs), " ".join(kept))]
        want.append((doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], *sha))
    got = periodic_runs.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(r[1] > 0 for r in want) > 3
    assert periodic_runs.collapse(spark.createDataFrame([], DDL)).count() == 0


def test_long_text_of_one_word(spark):
    """300,000 equal words and as many different ones in one text."""
    text = "a " * 300_000 + " ".join(map(str, range(300_000)))
    row = periodic_runs.collapse(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 300_000, 1)] and row["n_words"] == 600_000
    assert row["collapsed"] == "a " + " ".join(map(str, range(300_000)))


def test_best_run_is_not_the_first(spark, tmp_path):
    """The greatest exponent in the first, a middle and the last run; ties go to the smallest start."""
    texts = ["x " + "a b " * 4 + "c " + "d " * 9 + "e " + "f g h " * 5, "p q r s " * 4 + "z " + "k " * 7,
             "m " * 8 + "n o " * 5 + "p", "q r " * 5 + "s " + "t u " * 5]
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 10][: len(texts)]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.op13_periodic_runs(spark, str(tmp_path)).orderBy("doc_id")
    assert [tuple(r) for r in got.select("n_runs", "start", "length", "period", "exponent_milli").collect()] == [
        (3, 10, 9, 1, 9000), (2, 17, 7, 1, 7000), (2, 0, 8, 1, 8000), (2, 0, 10, 2, 5000)]
