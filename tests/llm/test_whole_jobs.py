"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from corpus import components, corpus

from spanfan.llm import decontaminate, line_dedup, pii_surrogates, secret_scan


def grams(line: str) -> frozenset:
    return frozenset(line[i : i + 12] for i in range(len(line) - 11))


def kept_lines(spark, lines: list[str]) -> set[str]:
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {r["text"] for r in line_dedup.dedup_lines(df).collect()}


def test_line_sets_hold_the_shingles_of_long_words(spark):
    """URLs and lines without blanks: the set is that of all shingles."""
    urls = [f"https://shop.example.com/item/{n}/specifications.html" for n in (1001, 7394)]
    han = "".join(chr(0x4E00 + 37 * i) for i in range(84))
    near = "香" + han[1:]
    apart = [han[:12] + "".join(chr(0x6000 + 41 * i + k) for i in range(19)) + han[-12:] for k in (0, 7)]
    lines = [*urls, han, near, *apart]
    root = components([grams(x) for x in lines], line_dedup.PERCENT)
    assert root == [0, 1, 2, 2, 4, 5]
    assert kept_lines(spark, lines) == {lines[i] for i in set(root)}
    read = line_dedup.Lines().read(pa.array(lines, pa.large_string()))
    assert [len(read.set_of(i)) for i in range(len(lines))] == [len(grams(x)) for x in lines]


def test_short_lines_take_part(spark):
    import corpus_pipeline

    texts = ["all rights reserved.\none", "ALL  rights reserved.\ntwo\n", "three\nAll rights reserved.\nthe.", "the.", None, "  \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, df, "").collect()}
    assert got == {0: "all rights reserved.\none", 1: "two\n", 2: "three\nthe.", 4: None, 5: "  \n"}


def test_bands_of_small_sets_are_independent():
    """Sets of four and five shingles (Jaccard 0.8) miss each other as often as independent bands do."""
    rnd = np.random.default_rng(0)
    base, more = (rnd.integers(0, 1 << 64, size=(40_000, k), dtype=np.uint64) for k in (4, 1))
    keys = []
    for sets in (base, np.concatenate([base, more], axis=1)):
        lines = line_dedup.Lines()
        lines.x, lines.start = np.sort(sets, axis=1).ravel(), np.arange(0, sets.size + 1, sets.shape[1])
        keys.append(lines.bands())
    assert 1 - (keys[0] == keys[1]).any(axis=1).mean() < 2 * (1 - 0.8**3) ** line_dedup.BANDS


def test_secret_samples_come_from_distinct_texts(spark):
    """50 texts of ordinary words in 2,000 copies each."""
    F = secret_scan.F
    docs = spark.range(100_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("plain words of text number word"), F.translate((F.col("id") % 50).cast("string"), "0123456789", "abcdefghij")).alias("text"),
    )
    samples = secret_scan.labelled(secret_scan.found_spans(docs.limit(10)), docs).filter("secret = 0")
    assert samples.count() == 4 + 50  # words of three letters or more
    assert secret_scan.smallest(spark.range(100), F.lit(1).cast("long"), 5).count() == 5


def test_random_runs_without_a_digit_are_found(spark):
    texts = ["key QXZTVRKWpYHLSNDB end", "order_number_of_the_window and ---------------- 20240101123000123"]
    texts += [r[1] for r in corpus()[:24]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r[0]: r[1] for r in secret_scan.scan(df).select("doc_id", secret_scan.listed(secret_scan.F.col("spans"))).collect()}
    assert spans.pop(0) == "markov:4:20" and not any(spans.values())


def test_short_mailboxes_and_domains_do_not_run_out(spark):
    """1,000 two-letter mailboxes of one domain, the one-letter ones of many domains, and all one-letter domains."""
    F = pii_surrogates.F
    rows = [("mailbox", f"{a}{b}@one.org") for a in "abcdefghijklmnopqrstuvwxyz0123456789" for b in "abcdefghijklmnopqrstuvwxyz01"]
    rows += [("mailbox", f"h@d{i}.org") for i in range(100)] + [("domain", f"{c}.org") for c in "abcdefghijklmnopqrstuvwxyz"]
    got = pii_surrogates.mapping(spark.createDataFrame(rows, "role string, value string")).collect()
    new = [(r["role"], r["value"].split("@")[-1] if r["role"] == "mailbox" else "", r["surrogate"]) for r in got]
    assert len(got) == len(rows) == len(set(new))
    assert not {x[2] for x in new if x[1] == "one.org"} & {v.split("@")[0] for _, v in rows if v.endswith("@one.org")}


def test_names_of_any_length(spark):
    texts = [
        "Mr. John Ronald Smith met Mr. Smith and Mr. J. R. Smith. Then", "Dr. Anna-Maria Vance saw Mrs. Anna-Maria Vance.",
        "Herr Dr. Vance and Prof. Vance left with Mr. K.", "Mr. JOHN SMITH",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii_surrogates.pseudonymise(df).collect()}
    w = r"([A-Z][\w-]*)"
    one = re.fullmatch(rf"Mr\. {w} {w} {w} met Mr\. {w} and Mr\. {w} {w} {w}\. Then", got[0])
    two = re.fullmatch(rf"Dr\. {w} {w} saw Mrs\. {w} {w}\.", got[1])
    three = re.fullmatch(rf"Herr Dr\. {w} and Prof\. {w} left with Mr\. {w}\.", got[2])
    assert one and one[3] == one[4] == one[7] and two.group(1, 2) == two.group(3, 4) and three[1] == three[2] == two[2]
    assert got[3] == f"Mr. {one[1].upper()} {one[3].upper()}"
    assert not re.search("John|Ronald|Smith|J\\.|R\\.|Anna|Vance|K\\.", " ".join(got.values()))


def test_short_items_match_whole_words():
    find = decontaminate.Matcher([(1, "Yes"), (2, "a test")])
    assert find("eyes of a testing day") == [] and find("eyesyes yes") == [(1, 0, 11)]
    assert sorted(find("yes a test")) == [(1, 0, 3), (2, 0, 10)]


def test_blocks_of_items_give_what_one_block_gives(spark, monkeypatch):
    docs = spark.createDataFrame([(i, r[1]) for i, r in enumerate(corpus()[:30])], "doc_id long, text string")
    items = [(i, " ".join((t or "").split()[:12])) for i, t in [(0, corpus()[0][1]), (1, corpus()[7][1]), (2, corpus()[12][1]), (3, None)]]
    benchmark = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    whole = sorted(decontaminate.matches(docs, benchmark).collect()), sorted(decontaminate.clean(docs, benchmark).collect())
    assert len({r["item_id"] for r in whole[0]}) == 3 and len(whole[1]) < 30
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", 40))
    assert len(list(decontaminate.blocks(benchmark))) >= 3
    assert (sorted(decontaminate.matches(docs, benchmark).collect()), sorted(decontaminate.clean(docs, benchmark).collect())) == whole


def test_bit_map_bound_never_excludes_a_link(spark):
    """Pairs of near lines: whatever is alike passes the bound, and most of what is not does not."""
    rnd = np.random.default_rng(7)
    lines = []
    for _ in range(30):
        base = "".join(rnd.choice(list("abcdefghij klmno"), int(rnd.integers(40, 400)))).strip()
        for _ in range(5):
            x = list(base)
            for _ in range(int(rnd.integers(0, 4))):
                x[int(rnd.integers(0, len(x)))] = "Z"
            lines.append(" ".join("".join(x).lower().split()))
    df = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    known = line_dedup.line_profiles(df).cache()
    sets = [grams(x) for x in lines]
    assert {r["node"]: r["n"] for r in known.collect()} == {i: len(s) for i, s in enumerate(sets)}
    passed = known.alias("l").join(known.alias("r"), line_dedup.F.col("l.node") < line_dedup.F.col("r.node")).filter(line_dedup.may_be_alike("l", "r"))
    passed = {(r[0], r[1]) for r in passed.select("l.node", "r.node").collect()}
    alike = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))
             if 100 * len(sets[i] & sets[j]) >= line_dedup.PERCENT * len(sets[i] | sets[j])}
    assert alike <= passed and len(passed) < 3 * len(alike)
    pairs = spark.createDataFrame([(i, j) for i, j in passed], "a long, b long")
    assert {tuple(r) for r in line_dedup.confirmed(pairs, df).collect()} == alike
