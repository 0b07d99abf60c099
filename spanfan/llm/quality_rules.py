"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the raw
measurements and one long whose bit *i* says that rule *i* failed. A policy
is a versioned mask over these bits, so applying another policy, or asking
what a rule contributes, never reads a text again: ``ablation`` works on the
counts of the distinct bit patterns.

All expressions are built in; the measurements of a document are array
functions over its own words, so nothing is shuffled.

Cases: a null or empty text has no words, all measurements 0, and fails
``few_words``; a null ``doc_id`` or repeated rows are kept as rows; columns
of the input that clash with output names are not read (``ledger`` takes
only the id and the text column).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import SPACE, read_table

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"

# rule -> (bit, condition of failure over the measurements)
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 10"),
    "repeated_windows": (1, "100 * n_repeat_words > 20 * n_words"),
    "symbols": (2, "10 * n_symbols > n_words"),
    "repeated_lines": (3, "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    "short_words": (4, "word_chars < 2 * n_words"),
    "long_words": (5, "word_chars > 20 * n_words"),
    "capitals": (6, "all_capitals"),
    "exclamations": (7, "5 * n_exclamations > n_words"),
}


@dataclass(frozen=True)
class Policy:
    """A named version of the rules that count. ``allowed`` failures are forgiven
    among ``soft`` rules; one failure of a ``hard`` rule rejects."""

    version: str
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0

    @staticmethod
    def mask(rules: tuple[str, ...]) -> int:
        return sum(1 << RULES[r][0] for r in rules)

    def passes(self, bits: Column) -> Column:
        soft = F.bit_count(bits.bitwiseAND(F.lit(self.mask(self.soft)).cast("long")))
        return (bits.bitwiseAND(F.lit(self.mask(self.hard)).cast("long")) == 0) & (soft <= self.allowed)


BASE = Policy("base", ("few_words", "repeated_windows"))
V1 = Policy("v1", ("few_words", "repeated_windows", "symbols", "repeated_lines"))
V2 = Policy("v2", V1.hard + ("capitals", "exclamations", "short_words", "long_words"))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and bind it to a lambda variable."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: int = 5) -> Column:
    """Words covered by an ``n``-word window that occurs twice or more."""

    def covered(wins: Column) -> Column:
        # positions of windows by content: sorted, equal neighbours repeat
        order = F.array_sort(F.transform(wins, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def spread(o: Column) -> Column:
            hit = F.filter(
                o,
                lambda x, i: ((i > 0) & (F.get(o, i - 1)["w"] == x["w"])) | F.coalesce(F.get(o, i + 1)["w"] == x["w"], F.lit(False)),
            )
            at = F.array_sort(F.transform(hit, lambda x: x["i"]))
            return _let(
                at,
                lambda p: F.aggregate(
                    F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))),
                    F.lit(0),
                    lambda s, x: s + x,
                ),
            )

        return _let(order, spread)

    # 64-bit hashes decide only that all windows differ; contents decide repeats
    hashes = _let(
        words,
        lambda ws: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(ws) - n, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(n)]),
        ),
    )
    windows = _let(
        words,
        lambda ws: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(ws, i, n), " ")
        ),
    )
    differ = _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(F.size(words) < n + 1, F.lit(0)).when(differ, F.lit(0)).otherwise(_let(windows, covered))


def _count(text: str, chars: str) -> Column:
    """Occurrences of the characters; a replace without a hit is one byte scan."""
    rest = F.col(text)
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return (F.length(text) - F.length(rest)).cast("long")


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: the id, the measurements and ``fail_bits``."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = docs.select(
        F.col(doc_id).alias("doc_id"),
        t.alias("text"),
        F.array_remove(F.split(t, SPACE), "").alias("words"),
        F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0).alias("lines"),
    )
    measured = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count("text", SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        _count("text", "!").alias("n_exclamations"),
        ((F.upper("text") == F.col("text")) & (F.lower("text") != F.col("text"))).alias("all_capitals"),
    )
    bits = " + ".join(f"if({cond}, {1 << bit}L, 0L)" for bit, cond in RULES.values())
    return measured.withColumn("fail_bits", F.expr(bits))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's verdict in ``kept``."""
    return rows.withColumn("kept", policy.passes(F.col("fail_bits")))


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else of
    the policy, and that are kept with the whole policy and without the rule.

    The ledger is reduced to its distinct bit patterns first (at most
    2 ^ rules rows), so the explode over rules is small.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = policy.hard + policy.soft
    rules = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("long").alias("bit")) for r in names])
    )
    whole = F.lit(policy.mask(names)).cast("long")
    x = patterns.select("fail_bits", "n", rules.alias("r")).select("fail_bits", "n", "r.*")
    return (
        x.groupBy("rule")
        .agg(
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("fail_bits").bitwiseAND(whole) == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(policy.passes(F.col("fail_bits")), F.col("n")).otherwise(0)).alias("kept_with"),
            F.sum(
                F.when(policy.passes(F.col("fail_bits").bitwiseAND(F.bitwise_not("bit"))), F.col("n")).otherwise(0)
            ).alias("kept_without"),
        )
    )


def keep(docs: DataFrame, policy: Policy = V2, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    # the row travels as one struct beside the ledger: no join back, no clash of names
    rows = ledger(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col(text).alias("text")))
    return apply_policy(rows, policy).filter("kept").select("doc_id.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all documents with the base verdict and that of policy v2."""
    rows = apply_policy(ledger(read_table(spark, sf_dir, "documents")), V2)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~BASE.passes(F.col("fail_bits"))).alias("base_failed"), "kept",
        "fail_bits", "n_lines", "n_exclamations", "all_capitals",
    )


OP1_SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (
  select rid, unnest(ws) as w, generate_subscripts(ws, 1) as i
  from (select rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from d)
),
win as (
  select rid, i, concat_ws(' ', w, lead(w, 1) over p, lead(w, 2) over p, lead(w, 3) over p, lead(w, 4) over p) as g,
         lead(w, 4) over p is not null as whole
  from w window p as (partition by rid order by i)
),
hit as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from win where whole) where c > 1),
cover as (
  select rid, sum(least(5, coalesce(nxt - i, 5))) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as nxt from hit) group by rid
),
l as (
  select rid, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from (select rid, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid
),
n as (select rid, count(*) as n_words, sum(length(w)) as word_chars from w group by rid),
m as (
  select doc_id, coalesce(n_words, 0) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup, 0) as n_dup_lines, cast(coalesce(cover.n, 0) as bigint) as n_repeat_words,
    coalesce(n_lines, 0) as n_lines,
    length(text) - length(replace(text, '!', '')) as n_exclamations,
    upper(text) = text and lower(text) <> text as all_capitals
  from d left join n using (rid) left join l using (rid) left join cover using (rid)
),
f as (
  select *, cast(
      (case when n_words < 10 then 1 else 0 end) + (case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end)
    + (case when 10 * n_symbols > n_words then 4 else 0 end)
    + (case when n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines then 8 else 0 end)
    + (case when word_chars < 2 * n_words then 16 else 0 end) + (case when word_chars > 20 * n_words then 32 else 0 end)
    + (case when all_capitals then 64 else 0 end)
    + (case when 5 * n_exclamations > n_words then 128 else 0 end) as bigint) as fail_bits
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, fail_bits = 0 as kept,
  fail_bits, n_lines, n_exclamations, all_capitals
from f
"""
