"""Operators that look at one document at a time, against plain Python."""

from __future__ import annotations

import hashlib
import re

import pytest
from corpus import DDL, corpus, multiset, words

from spanfan.llm import decontaminate, pii_surrogates, quality_rules, secret_scan


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DDL).cache()


def measured(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    hit = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(5)} if len(wins) < 3000 else None
    if hit is None:
        seen = {}
        for i, x in enumerate(wins):
            seen.setdefault(x, []).append(i)
        hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_ledger_measures(docs):
    got = quality_rules.ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert multiset(got.collect()) == multiset((r[0], *measured(r[1])) for r in corpus())


def test_policies_and_ablation(docs):
    rows = quality_rules.ledger(docs).cache()
    bits = [r["fail_bits"] for r in rows.collect()]
    v2 = quality_rules.V2
    whole = v2.mask(v2.hard)
    got = {r["rule"]: r for r in quality_rules.ablation(rows, v2).collect()}
    for rule, (bit, _) in quality_rules.RULES.items():
        b = 1 << bit
        assert got[rule]["n_failed"] == sum(bool(x & b) for x in bits)
        assert got[rule]["n_only"] == sum(x & whole == b for x in bits)
        assert got[rule]["kept_without"] == sum(not x & whole & ~b for x in bits)
    soft = quality_rules.Policy("soft", ("few_words",), ("symbols", "repeated_lines"), allowed=1)
    kept = quality_rules.apply_policy(rows, soft).filter("kept").count()
    assert kept == sum(not x & 1 and bin(x & soft.mask(soft.soft)).count("1") <= 1 for x in bits)


def test_keep_returns_the_rows_themselves(docs):
    out = quality_rules.keep(docs, quality_rules.BASE)
    assert out.columns == docs.columns
    want = [r for r in corpus() if (m := measured(r[1]))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    assert multiset(out.collect()) == multiset(want)


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
SECRETS = [
    "token = abc", 'Secret="abcdef" token: xyz123456', "secret=token: abcdefgh", "é password : hunter22 é",
    "AKIA" + "B7" * 8 + " AKIA12", "x " + "0123456789abcdef" * 2 + " deadbeef", "api_key=apikey=zzzzzz",
    "id Zk93hQpX77vLm2Rt8WqY1 end", "plain words only", "ſecret=abcdefgh tokeN=1234567",
]


def test_secret_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(None, "token=abcdefg"), (50, None), (51, ""), (0, SECRETS[0])]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r[0], r[1]) for r in got.select("doc_id", secret_scan.listed(secret_scan.F.col("base"))).collect()}
    for i, t in rows:
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert (i, ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))) in got


def test_markov_models_on_held_out_strings(spark):
    import random

    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    plain = ["value", "counter", "index", "result", "parser", "handler", "buffer", "request", "session", "manager", "order", "window"]

    def secret():
        return "".join(rnd.choice(letters) for _ in range(28))

    def ordinary():
        return "_".join(rnd.choice(plain) for _ in range(4)) + str(rnd.randrange(10))

    train = [(secret(), 1) for _ in range(400)] + [(ordinary(), 0) for _ in range(400)]
    table = secret_scan.train(spark.createDataFrame(train, "token string, secret int"))
    test = spark.createDataFrame([(secret(), 1) for _ in range(200)] + [(ordinary(), 0) for _ in range(200)], "t string, y int")
    F = secret_scan.F
    hit = secret_scan.score(F.col("t"), table) >= secret_scan.THRESHOLD * (F.length("t") - 1)
    right = test.filter(hit == (F.col("y") == 1)).count()
    assert right >= 390


def test_markov_adds_a_span(spark):
    """A random string among documents of ordinary words (the second sample)."""
    rows = [(1, "id Zk93hQpX77vLm2Rt8WqY1 end"), (2, "order_number_of_the_window_12")]
    rows += [(100 + i, r[1]) for i, r in enumerate(corpus()[:24])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r[0]: r[1] for r in secret_scan.scan(df).select("doc_id", secret_scan.listed(secret_scan.F.col("spans"))).collect()}
    assert spans[1] == "markov:3:24" and all(v == "" for k, v in spans.items() if k >= 100)


PII = [
    (1, "Call Mr. John Smith or Mrs. Anna Smith at +1 (017) 555-7713, also +1 017 555-7713. Mr. Smith is here."),
    (2, "Mail Joe.b@Mail.example.com, JOE.B@MAIL.EXAMPLE.COM, ann@mail.example.com; card 4111 1111 1111 1111 or 4111111111111111."),
    (3, "Server 10.1.2.3 and 10.1.2.4; Госпожа Анна Петрова wrote. 1.2.3.4.5 is a version."),
    (4, "nothing here, 2024 and 12345"), (5, None), (6, ""), (None, "again 10.1.2.3"), (3, "again 10.1.2.3"), (3, "again 10.1.2.3"),
]


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_surrogates(spark):
    df = spark.createDataFrame([(*r, "z") for r in PII], "doc_id long, text string, found string")
    out = pii_surrogates.pseudonymise(df).collect()
    again = pii_surrogates.pseudonymise(df).collect()
    other = pii_surrogates.pseudonymise(df, key="another").collect()
    assert multiset(out) == multiset(again) != multiset(other)
    assert len(out) == len(PII)
    text = {r["doc_id"]: r["text"] for r in out if r["doc_id"] in (1, 2, 4, 5, 6)}
    assert (text[4], text[5], text[6]) == (PII[3][1], None, "")
    one = re.fullmatch(r"Call Mr\. (\w+) ([\w-]+) or Mrs\. (\w+) ([\w-]+) at \+(\d) \((\d{3})\) (\d{3})-(\d{4}), also "
                       r"\+(\d) (\d{3}) (\d{3})-(\d{4})\. Mr\. ([\w-]+) is here\.", text[1])
    assert one and one[2] == one[4] == one[13] and one[2] != "Smith"  # one surname, three times
    assert one[1] in pii_surrogates.FIRST["m", "latin"] and one[3] in pii_surrogates.FIRST["f", "latin"]
    assert one.group(5, 6, 7, 8) == one.group(9, 10, 11, 12) != ("1", "017", "555", "7713")
    two = re.fullmatch(r"Mail (\S+), (\S+), (\S+); card ([\d ]{19}) or (\d{16})\.", text[2])
    assert two[1].upper() == two[2] and two[1].split("@")[1] == two[3].split("@")[1] and two[1] != two[3]
    assert two[4].replace(" ", "") == two[5] != "4111111111111111" and luhn(two[5])
    ips = {r["text"] for r in out if r["text"] and r["text"].startswith("again")}
    three = next(r["text"] for r in out if r["text"] and r["text"].startswith("Server"))
    a, b = re.search(r"Server (\S+) and (\S+);", three).groups()
    assert ips == {f"again {a}"} and a != b and "1.2.3.4.5 is" in three
    assert re.search("Госпожа [А-Я][а-я]+ [А-Я][а-я]+ wrote", three) and "Петрова" not in three
    for r in out:
        for secret in ("10.1.2.3", "Smith", "4111", "example@", "Joe.b", "7713"):
            assert secret not in (r["text"] or "")


def test_surrogates_stay_distinct_in_a_small_space(spark):
    """200 surnames on a list of 20: collisions are drawn again."""
    names = spark.range(200).selectExpr("'last-latin' as role", "concat('name', cast(id as string)) as value")
    got = pii_surrogates.mapping(names).collect()
    assert len(got) == len({r["surrogate"] for r in got}) == 200
    assert not {r["surrogate"] for r in got} & {r["value"] for r in got}


def test_myers_equals_dynamic_programming():
    import random

    rnd = random.Random(5)
    for _ in range(200):
        p = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(1, 90)))
        t = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(0, 120)))
        row = list(range(len(p) + 1))
        best = len(p)
        for c in t:
            new = [0]
            for i, x in enumerate(p):
                new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
            row = new
            best = min(best, row[-1])
        peq: dict[str, int] = {}
        for i, c in enumerate(p):
            peq[c] = peq.get(c, 0) | 1 << i
        assert decontaminate.myers(peq, len(p), t)[0] == best


def test_decontamination(spark):
    import random

    rnd = random.Random(11)
    items = [(i, t) for i, (_, t) in enumerate((r[0], r[1]) for r in corpus()[:12])] + [(99, None), (98, "..."), (0, corpus()[0][1])]
    base = decontaminate.normalise(corpus()[2][1])
    k = len(base) * decontaminate.PERCENT // 100

    def edited(n):
        s = list(base)
        for at in sorted(rnd.sample(range(0, len(s), 3), n), reverse=True):
            s[at : at + 1] = rnd.choice(["", "q", s[at] + "q"])
        return "".join(s)

    docs = [(1, "before " + corpus()[0][1].upper() + " after"), (2, "x " + edited(k) + " y"), (3, "x " + edited(4 * k + 12) + " y"),
            (4, None), (5, ""), (None, corpus()[1][1]), (1, "before " + corpus()[0][1].upper() + " after"), (7, "clean text")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id long")
    b = spark.createDataFrame(items, "item_id long, text string")

    def distance(item, text):
        peq: dict[str, int] = {}
        for i, c in enumerate(item):
            peq[c] = peq.get(c, 0) | 1 << i
        return decontaminate.myers(peq, len(item), text)[0]

    want = []
    for doc, t in docs:
        for item, x in items:
            n, t_ = decontaminate.normalise(x), decontaminate.normalise(t)
            if n and t_ and (e := distance(n, t_)) <= len(n) * decontaminate.PERCENT // 100:
                want.append((doc, item, e))
    got = decontaminate.matches(d, b).select("doc_id", "item_id", "n_edits").collect()
    assert multiset(got) == multiset(want) and (2, 2) in {w[:2] for w in want}
    hit = {w[0] for w in want}
    assert multiset(decontaminate.clean(d, b).collect()) == multiset((*r, 1) for r in docs if r[0] not in hit)
    assert decontaminate.clean(d, b.limit(0)).count() == len(docs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DDL)
    assert quality_rules.ledger(none).count() == 0
    assert secret_scan.scan(none).count() == 0
    assert pii_surrogates.pseudonymise(none).count() == 0
    assert decontaminate.matches(none, spark.createDataFrame([(1, "abc")], "item_id long, text string")).count() == 0


def test_long_text_of_one_word(spark):
    df = spark.createDataFrame([(1, "a" * 200_000), (2, "a@" * 50_000)], "doc_id long, text string")
    assert [r["n_words"] for r in quality_rules.ledger(df).orderBy("doc_id").collect()] == [1, 1]
    assert pii_surrogates.pseudonymise(df).count() == 2
    assert hashlib.sha256(b"").hexdigest() in {r[0] for r in secret_scan.scan(df).select(secret_scan.F.sha2(secret_scan.listed(secret_scan.F.col("base")), 256)).collect()}
