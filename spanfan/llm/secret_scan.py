r"""Secret scan: fixed patterns plus character Markov models, with built-in functions only.

Three base patterns give spans (``assign``, ``access``, ``hex``). Further spans
(``markov``) are long runs of ``[A-Za-z0-9+/_=-]`` with a letter that look
random: two first-order character models, one of random strings and one of
ordinary identifiers, are compared by the mean log-likelihood ratio per
transition. The models are counts of character pairs over labelled samples;
the ratio is kept as whole thousandths, so sums do not depend on their order.
Runs without a digit must also exceed what all but one in a thousand of the labelled
words of ``WORD_CHARS`` to 15 characters have, and those all in capitals are scored in
lower case. Runs without a letter are not scored (of
random base62 keys of 16 characters 2e-13 have none): the samples of words hold no digits,
so every long number would pass.

Labelled samples of the query: random strings are the values the base patterns
find in all documents, and ``N_RANDOM`` strings that are random by construction (encoded
digests); identifiers are distinct words of ``TRAIN_DOCS`` distinct texts, taken by
smallest hash, without runs of 16 letters or more. At most ``MAX_SAMPLES`` of either kind are used, again by smallest hash.

A span's place comes from the lengths of what ``split`` leaves between matches.

Cases: a null or empty text has no spans; a null ``doc_id`` and repeated rows are
rows like others; an empty table gives no rows (the models then rest on the
constructed strings and the smoothing); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import WORD, read_table, stored

# fixed values: the base patterns and their least lengths
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
KINDS = ("assign", "access", "hex", "markov")


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = "(" + "|".join(map(_either, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
LONG_HEX = r"[0-9a-f]{24,}"  # a run is maximal, so the least length may stand in the pattern
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
LEAST = {"assign": 6, "access": 20, "hex": 24}

TRAIN_DOCS = 500
N_RANDOM = 2_000
MAX_SAMPLES = 20_000
THRESHOLD = 500  # thousandths of a nat per transition
WORD_CHARS = 8


def spans(text: Column, kind: int, pattern: str, value: int, least: int, hint: Column) -> Column:
    """``array<struct<start, kind, end, value>>`` (code points, end exclusive) of the leftmost
    non-overlapping matches whose group ``value`` has ``least`` characters. Texts
    without ``hint`` are not searched."""
    empty = F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")
    gaps = F.split(text, pattern)
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    values = F.regexp_extract_all(text, F.lit(pattern), value) if value else whole
    rows = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        span = F.struct(
            start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"), x["value"].alias("value")
        )
        found = F.when(F.length(x["value"]) >= least, F.array_append(acc["found"], span)).otherwise(acc["found"])
        return F.struct(F.coalesce(end, acc["at"]).cast("long").alias("at"), found.alias("found"))

    first = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found"))
    return F.when(hint, F.aggregate(rows, first, step)["found"]).otherwise(empty)


def found_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, assign, access, hex, candidates`` (arrays of spans) of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = F.col("t")
    return rows.select(
        "doc_id",
        spans(t, 0, ASSIGN, 2, LEAST["assign"], t.rlike(ASSIGN)).alias("assign"),
        spans(t, 1, ACCESS, 0, LEAST["access"], F.contains(t, F.lit("AKIA"))).alias("access"),
        spans(t, 2, LONG_HEX, 0, LEAST["hex"], t.rlike(LONG_HEX)).alias("hex"),
        spans(t, 3, CANDIDATE, 0, 16, t.rlike(CANDIDATE)).alias("candidates"),
    )


def pair_index(token: Column, i: Column) -> Column:
    """Index of the transition from character ``i`` (1-based) in a 128 x 128 table."""
    return F.ascii(F.substr(token, i, F.lit(1))) * 128 + F.ascii(F.substr(token, i + 1, F.lit(1)))


def train(samples: DataFrame, alphabet: int = 66, smooth: float = 0.5, weight: float = 5.0) -> list[int]:
    """128 x 128 log-likelihood ratios in thousandths from ``samples(token, secret)``.

    A transition's probability is its relative count, drawn towards the
    probability of the second character alone by ``weight`` counts (which has
    ``smooth`` counts for every character). Only counts of character pairs (at
    most 2 x 128 x 128 rows) reach the driver.
    """
    import math

    ascii_only = samples.filter(r"token rlike '^[\x00-\x7F]{2,}$'")
    pairs = ascii_only.select(
        "secret", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: pair_index(F.col("token"), i))).alias("p")
    )
    counts = [[0.0] * (128 * 128) for _ in range(2)]
    for r in pairs.groupBy("secret", "p").agg(F.count("*").alias("n")).collect():
        counts[int(r["secret"])][r["p"]] = float(r["n"])
    from_ = [[sum(c[a * 128 : a * 128 + 128]) for a in range(128)] for c in counts]
    single = []
    for c in counts:
        to = [sum(c[b::128]) for b in range(128)]
        single.append([(n + smooth) / (sum(to) + smooth * alphabet) for n in to])

    def log_p(k: int, a: int, b: int) -> float:
        return math.log((counts[k][a * 128 + b] + weight * single[k][b]) / (from_[k][a] + weight))

    return [round(1000 * (log_p(1, a, b) - log_p(0, a, b))) for a in range(128) for b in range(128)]


def score(token: Column, table: list[int]) -> Column:
    """Sum of the ratios over the transitions of an ASCII token."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")  # folded to one literal
    return F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1),
        F.lit(0).cast("long"),
        lambda s, i: s + F.get(ratios, pair_index(token, i)).cast("long"),
    )


def smallest(rows: DataFrame, key: Column, k: int) -> DataFrame:
    """The ``k`` rows of distinct ``rows`` with the smallest ``key`` (a 64-bit hash). Of many
    rows only those below twice the expected bound are gathered, so what one task
    reads does not grow with the number of tasks; all are ordered if the bound
    leaves fewer than ``k``."""
    n = rows.count()
    rows = rows.withColumn("_h", key)
    if n > 4 * k:
        below = rows.filter(F.col("_h") < -(1 << 63) + (1 << 64) * 2 * k // n)
        rows = below if below.count() >= k else rows
    return rows.orderBy("_h", *[c for c in rows.columns if c != "_h"]).limit(k).drop("_h")


def labelled(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``token, secret``: the bounded labelled samples described above."""
    spark = found.sparkSession

    def bounded(tokens: DataFrame) -> DataFrame:
        return smallest(tokens.distinct(), F.xxhash64("token"), MAX_SAMPLES)

    values = found.select(F.explode(F.concat("assign", "access", "hex")).alias("s")).select(F.col("s.value").alias("token"))
    digest = F.sha2(F.concat(F.lit("random-"), F.col("id").cast("string")), 256)
    made = spark.range(N_RANDOM).select(
        F.explode(F.array(F.left(digest, F.lit(40)), F.left(F.base64(F.unhex(digest)), F.lit(40)))).alias("token")
    )
    secret = bounded(values.filter("length(token) >= 16")).unionByName(made).withColumn("secret", F.lit(1))
    texts = docs.select(F.col(text).alias("t")).filter("t is not null").withColumn("tid", F.unhex(F.md5("t")))
    tids = smallest(texts.select("tid", F.xxhash64("t").alias("h")).distinct(), F.col("h"), TRAIN_DOCS)
    sample = texts.join(F.broadcast(tids.select("tid")), "tid", "left_semi").groupBy("tid").agg(F.first("t").alias("t"))
    words = sample.select(F.explode(F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(WORD), 0)).alias("token"))
    words = words.filter("token rlike '^[A-Za-z_-]{3,}$' and not token rlike '^[A-Za-z]{16,}$'")  # these are judged
    ordinary = bounded(words).withColumn("secret", F.lit(0))
    return secret.unionByName(ordinary)


def word_bound(samples: DataFrame, table: list[int]) -> int:
    """The mean ratio that one in a thousand of the labelled words reaches (0 without such words)."""
    token = F.col("token")
    words = samples.filter((F.col("secret") == 0) & F.length(token).between(WORD_CHARS, 15))  # longer ones are candidates
    bound = words.agg(F.percentile(score(token, table) / (F.length(token) - 1), F.lit(0.999))).first()[0]
    return 0 if bound is None else int(bound) + 1


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, base, spans``: the base spans and all spans, each sorted by start and kind."""
    found = stored(found_spans(docs, text, doc_id), "secret-found")
    samples = stored(labelled(found, docs, text), "secret-samples")
    table = train(samples)
    plain = max(threshold, word_bound(samples, table))
    base = F.concat("assign", "access", "hex")
    rows = found.select("doc_id", "assign", "access", "hex", "candidates", F.array_sort(base).alias("base"))

    def random_looking(s: Column) -> Column:
        v = s["value"]
        least = F.when(v.rlike("[0-9]"), threshold).otherwise(plain)
        spelled = F.when(v.rlike("[0-9a-z]"), v).otherwise(F.lower(v))  # words in capitals are rare in the samples
        return v.rlike("[A-Za-z]") & (score(spelled, table) >= least * (F.length(v) - 1)) & ~F.exists(
            F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
        )

    added = F.when(F.size("candidates") > 0, F.filter("candidates", random_looking)).otherwise(F.col("candidates"))
    return rows.withColumn("spans", F.array_sort(F.concat("base", added)))


def listed(spans_: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents."""
    out = scan(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
