"""Extra columns named like the operators' own: the result is that without them, and they stay as they were."""

from __future__ import annotations

import pytest
from corpus import corpus, multiset
from pyspark.sql import functions as F

import corpus_pipeline
from spanfan.llm import decontaminate, line_dedup, minhash_near, pii_surrogates, quality_rules

# every name that these operators use beside the columns of a row
NAMES = (
    "row lost tid pos node bands bucket comp first found kind replacement idx r n who winner key rid won x y c a b l m d _d _t _r _tid _n_lost _n_lines "
    "_n_replaced one at text_ label n_shingles component_id role value surrogate cuts none `a.b`"
).replace("`", "").split()


def keep_clean(df):
    return decontaminate.clean(df, df.sparkSession.createDataFrame([(1, corpus()[4][1])], "item_id long, text string"))


OPERATORS = {
    "lines": line_dedup.dedup_lines,
    "lines stage": lambda df: corpus_pipeline.lines(df.sparkSession, df, ""),
    "near": minhash_near.keep_one,
    "surrogates": pii_surrogates.pseudonymise,
    "quality": quality_rules.keep,
    "clean": keep_clean,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names(spark, name):
    rows = [(r[0], r[1] + "\nMr. John Smith of one@two.org" if r[1] and r[0] and r[0] % 5 == 0 else r[1]) for r in corpus() if not r[1] or len(r[1]) < 3000]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    wide = plain.select("doc_id", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES], "text")
    want, got = OPERATORS[name](plain), OPERATORS[name](wide)
    assert got.columns[: len(wide.columns)] == wide.columns and len(set(got.columns)) == len(got.columns)
    assert len(got.columns) - len(wide.columns) == len(want.columns) - 2
    out = got.collect()
    more = len(want.columns) - 2
    assert multiset((r[0], r[len(NAMES) + 1], *r[len(wide.columns) :]) for r in out) == multiset(want.collect())
    assert all(r[1 + i] == (None if r[0] is None else f"{n}:{r[0]}") for r in out for i, n in enumerate(NAMES)) and more in (0, 1, 2)
