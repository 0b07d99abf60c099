"""Registered queries of the text operators, and the pipeline, on the smallest tables."""

from __future__ import annotations

import collections
import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import duckdb

    if not os.path.exists(SF):
        pytest.skip("no test data")
    c = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_registered():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(cols, res.fetchall())


def test_pipeline_stages_one_by_one(spark, con):
    """Each stage against its definition on its own input; the last covers every kept id."""
    from corpus import components, shingles

    import corpus_pipeline as P
    from spanfan.llm import decontaminate, quality_rules
    from spanfan.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    read = lambda df: {r["doc_id"]: r for r in df.collect()}
    out = [read(docs)]
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test-pipeline")
        assert docs.columns == columns, name
        out.append(read(docs))
    start, good, lines, near, clean = out
    kept = quality_rules.apply_policy(quality_rules.ledger(spark.read.parquet(f"{SF}/documents.parquet")), quality_rules.V2)
    assert set(good) == {r["doc_id"] for r in kept.filter("kept").collect()}
    assert set(lines) <= set(good) and all(r["n_chars"] == len(r["text"]) for r in lines.values())
    # long lines are unique afterwards
    seen = collections.Counter(x.lower() for r in lines.values() for x in r["text"].split("\n") if len(x) >= 40)
    assert max(seen.values()) == 1
    ids = sorted(lines)
    sets = [shingles(lines[i]["text"]) for i in ids]
    root = components(sets, 75)
    assert set(near) == {i for k, i in enumerate(ids) if root[k] == k or not sets[k]}
    items = [decontaminate.normalise(t) for (t,) in con.execute("select text from benchmark").fetchall()]
    for i, r in near.items():
        if any(x in decontaminate.normalise(r["text"]) for x in items):
            assert i not in clean
    assert len(near) - len(clean) <= 0.1 * len(near)
    pieces = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {p["doc_id"] for p in pieces} == set(clean)
    total = collections.Counter()
    for p in pieces:
        total[p["doc_id"]] += p["length"]
    assert all(total[p["doc_id"]] == p["doc_tokens"] for p in pieces)
