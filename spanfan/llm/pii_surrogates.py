r"""Surrogates for personal data, with built-in functions only.

One alternation finds e-mail addresses, IPv4 addresses, card and phone
numbers, and names after a title; ``split`` by the same pattern gives the text
between. Every detected string is broken into entities (the parts that must
stay distinct): a mailbox, a mail domain, an address, a digit string, a first
name or a last name. A name is any number of words or initials after one or more
titles; all but the last are first names, and an initial gets a whole name. An entity's surrogate is a keyed function of it (SHA-256
over key, kind, value and attempt) of the same type: digits stay digits in the
same places and separators, a card that passes the Luhn test keeps passing it,
letters keep their script and case, a first name keeps the gender of its title
(after Dr and Prof that of the same name after another title, if there is one).

Surrogates are checked against each other and against all real entities of
the kind; those that collide are drawn again with the next attempt, the
smallest value of a colliding group excepted; a mailbox (compared with those of
its domain) or a domain gets a letter more with each attempt after the second, so
that short ones do not run out. So different entities get
different surrogates, and an entity gets the same one in every document and
in every form it is written in (coreference: ``Mr. John Smith`` and ``Mr. Smith``).

Only strings and entities are shuffled, and texts that hold any; other texts
pass through the scan.

Cases: a null text stays null, an empty one empty; texts are joined by digest,
so a null ``doc_id``, repeated rows and equal texts are handled alike; an empty
table gives no rows; the input's other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import read_table, stored

TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),  # either
}
# first names by gender and script, last names by script
FIRST = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Nils Oscar Paul Robert Simon Thomas Victor".split(),
    ("f", "latin"): "Alma Berta Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("f", "cyrillic"): "Алла Вера Галина Дарья Елена Жанна Ирина Лариса Мария Нина".split(),
    ("m", "greek"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λεωνίδας Μιχάλης Νίκος".split(),
    ("f", "greek"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη".split(),
}
FIRST |= {("n", script): FIRST["m", script] + FIRST["f", script] for script in ("latin", "cyrillic", "greek")}
LAST = {
    "latin": "Abel Becker Conti Duval Engel Fischer Garner Holt Iversen Jansen Keller Lang Moreau Novak Olsen Porter Quint Rossi Stern Weber".split(),
    "cyrillic": "Белов Волков Громов Дроздов Зимин Котов Лебедев Морозов Носов Орлов".split(),
    "greek": "Αγγέλου Βλάχος Γεωργίου Δήμου Ζήσης Καραγιάννης Λάμπρου Μακρής Νικολάου Παππάς".split(),
}

NAME = r"\p{Lu}(?:[\p{L}'’-]+|\.(?:-?\p{Lu}\.)*)"  # a word, or initials
TITLE = "|".join(t for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True))
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}@[\p{L}0-9-]{1,63}(?:\.[\p{L}0-9-]{1,63}){0,8}\.\p{L}{2,24}"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9])"
PHONE = r"(?<![0-9])(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{2,4}\)[ -]?|[0-9]{2,4}[ -])[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])"
TITLED = rf"(?:(?:{TITLE})\.?\x20)+"
PERSON = rf"(?<!\p{{L}}){TITLED}{NAME}(?:\x20{NAME})*"
ANY = "|".join((EMAIL, IPV4, CARD, PHONE, PERSON))

KINDS = (("email", EMAIL), ("ipv4", IPV4), ("card", CARD), ("phone", PHONE))
DEFAULT_KEY = "surrogates-v1"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def script_of(s: Column) -> Column:
    return F.when(s.rlike(r"\p{IsCyrillic}"), "cyrillic").when(s.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """``tid, idx, found, kind`` of every match of every distinct text with one."""
    t = F.col(text)
    hits = docs.filter(t.rlike(ANY)).select(F.unhex(F.md5(t)).alias("tid"), t.alias("t"))
    rows = hits.select("tid", F.posexplode(F.regexp_extract_all("t", F.lit(ANY), 0)).alias("idx", "found")).distinct()
    kind = F.lit("person")
    for name, pattern in reversed(KINDS):
        kind = F.when(F.col("found").rlike(rf"\A(?:{pattern})\z"), name).otherwise(kind)
    return rows.withColumn("kind", kind)


def _titles(person: Column) -> Column:
    """The titles before a name, with the blank after them."""
    return F.regexp_extract(person, rf"\A{TITLED}(?=\p{{Lu}})", 0)


def _names(person: Column) -> Column:
    """The words of a name after its titles."""
    return F.split(F.substr(person, F.length(_titles(person)) + 1), " ")


def parts(found: DataFrame) -> DataFrame:
    """Adds ``parts``: ``array<struct<role, value>>``, the entities of a match in order."""
    f = F.col("found")

    def part(role: Column | str, value: Column) -> Column:
        return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), value.alias("value"))

    words = _names(f)
    titles = F.transform(F.split(F.trim(_titles(f)), " "), lambda t: F.regexp_replace(t, r"\.$", ""))
    has = {g: F.arrays_overlap(titles, F.array(*[F.lit(t) for t in TITLES[g]])) for g in "mf"}
    gender = F.when(has["f"], "f").when(has["m"], "m").otherwise("n")
    person = F.transform(
        words,
        lambda w, i: part(
            F.when(i == F.size(words) - 1, F.concat(F.lit("last-"), script_of(w))).otherwise(
                F.concat(F.lit("first-"), gender, F.lit("-"), script_of(w))
            ),
            F.lower(w),
        ),
    )
    mail = F.split(F.lower(f), "@")
    luhn = F.when(luhn_ok(_digits(f)), "card-luhn").otherwise("card")
    return found.withColumn(
        "parts",
        F.when(F.col("kind") == "email", F.array(part("mailbox", F.lower(f)), part("domain", mail[1])))
        .when(F.col("kind") == "ipv4", F.array(part("ipv4", f)))
        .when(F.col("kind") == "card", F.array(part(luhn, _digits(f))))
        .when(F.col("kind") == "phone", F.array(part("phone", _digits(f))))
        .otherwise(person),
    )


def _luhn_sum(digits: Column, skip_last: bool) -> Column:
    """Luhn sum; with ``skip_last`` that of the digits before the check digit."""
    n = F.length(digits)
    last = n - (1 if skip_last else 0)

    def term(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), F.lit(0), lambda s, i: s + term(i))


def luhn_ok(digits: Column) -> Column:
    return F.when(F.length(digits) >= 2, _luhn_sum(digits, False) % 10 == 0).otherwise(F.lit(False))


def surrogate(role: Column, value: Column, attempt: Column, key: str) -> Column:
    """Keyed surrogate of an entity, in lower case."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), role, value, attempt.cast("string")), 256)

    def draw(i: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")

    def chars(s: Column) -> Column:
        """Same length; digits to digits, letters to letters of the script, others kept."""

        def one(c: Column, i: Column) -> Column:
            return (
                F.when(c.rlike("[0-9]"), draw(i, 10).cast("string"))
                .when(c.rlike(r"\p{IsCyrillic}"), F.substr(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), draw(i, 27) + 1, F.lit(1)))
                .when(c.rlike(r"\p{IsGreek}"), F.substr(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), draw(i, 24) + 1, F.lit(1)))
                .when(c.rlike(r"\p{L}"), F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), draw(i, 26) + 1, F.lit(1)))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(s, ""), one), "")

    # mailboxes and domains: every attempt after the second adds a letter, so that there are always more
    extra = F.array_join(
        F.transform(
            F.filter(F.sequence(F.lit(0), attempt.cast("int")), lambda i: i > 1),
            lambda i: F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), draw(i + 1000, 26) + 1, F.lit(1)),
        ),
        "",
    )

    def digits(s: Column) -> Column:
        """Same length; a leading zero stays, another first digit stays non-zero."""

        def one(c: Column, i: Column) -> Column:
            first = F.when(c == "0", F.lit("0")).otherwise((draw(i, 9) + 1).cast("string"))
            return F.when(i == 0, first).otherwise(draw(i, 10).cast("string"))

        return F.array_join(F.transform(F.split(s, ""), one), "")

    def luhn(s: Column) -> Column:
        body = F.concat(F.substr(digits(s), F.lit(1), F.length(s) - 1), F.lit("0"))
        return F.transform(
            F.array(body),
            lambda b: F.concat(F.substr(b, F.lit(1), F.length(b) - 1), ((10 - _luhn_sum(b, True) % 10) % 10).cast("string")),
        )[0]

    def pick(names: list[str]) -> Column:
        """A name; every further attempt adds one, so that there are always more."""
        listed = F.array(*[F.lit(n.lower()) for n in names])
        return F.array_join(
            F.transform(F.sequence(F.lit(0), attempt.cast("int")), lambda i: F.get(listed, draw(i, len(names)))), "-"
        )

    out = chars(value)
    for (gender, script), names in FIRST.items():
        out = F.when(role == f"first-{gender}-{script}", pick(names)).otherwise(out)
    for script, names in LAST.items():
        out = F.when(role == f"last-{script}", pick(names)).otherwise(out)
    octets = F.array_join(F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: (draw(i, 254) + 1).cast("string")), ".")
    top = F.regexp_extract(value, r"(\.[^.]+)$", 1)
    return (
        F.when(role == "ipv4", octets)
        .when(role == "card-luhn", luhn(value))
        .when(role.isin("card", "phone"), digits(value))
        .when(role == "domain", F.concat(chars(F.regexp_replace(value, r"\.[^.]+$", "")), extra, top))
        .when(role == "mailbox", F.concat(chars(F.split(value, "@")[0]), extra))
        .otherwise(out)
    )


def _space(role: Column, value: Column) -> Column:
    """Entities whose surrogates must differ from each other. Domains differ after the
    mapping as before it, and from all real ones, so that a mailbox is only
    compared with others of its domain."""
    mailbox = F.concat(role, F.lit("@"), F.element_at(F.split(value, "@"), -1))
    return F.when(role == "mailbox", mailbox).otherwise(F.regexp_replace(F.regexp_replace(role, "-luhn$", ""), "^first-[mfn]-", "first-"))


def mapping(entities: DataFrame, key: str = DEFAULT_KEY, max_attempts: int = 64) -> DataFrame:
    """``role, value, surrogate`` for distinct ``entities(role, value)``, collision-free."""
    open_ = stored(entities.distinct().withColumn("space", _space(F.col("role"), F.col("value"))), "pii-entities")
    # a mailbox surrogate has no domain
    real = F.when(F.col("role") == "mailbox", F.split("value", "@")[0]).otherwise(F.col("value"))
    taken = open_.select("space", real.alias("surrogate")).distinct()
    done = None
    for attempt in range(max_attempts):
        drawn = stored(open_.withColumn("surrogate", surrogate(F.col("role"), F.col("value"), F.lit(attempt), key)), f"pii-draw{attempt}")
        first = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("role", "value")).alias("first"))
        free = first.join(taken, ["space", "surrogate"], "left_anti")
        won = stored(free.select("first.role", "first.value", "space", "surrogate"), f"pii-won{attempt}")
        done = won if done is None else done.unionByName(won)
        open_ = stored(open_.join(won.select("role", "value"), ["role", "value"], "left_anti"), f"pii-open{attempt}")
        if open_.isEmpty():
            return done.select("role", "value", "surrogate")
        taken = taken.unionByName(won.select("space", "surrogate"))
    raise RuntimeError(f"entities without a free surrogate after {max_attempts} attempts")


def _refilled(original: Column, digits: Column) -> Column:
    """``original`` with its digits replaced in order."""

    def one(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substr(original, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substr(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(original, ""), one), "")


def replacements(found: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``found, kind, replacement`` for every distinct detected string."""
    strings = stored(parts(found.select("found", "kind").distinct()), "pii-strings")
    each = strings.select("found", "kind", F.posexplode("parts").alias("nth", "p")).select("found", "kind", "nth", "p.*")
    # after a title of either gender: the entity of the gendered title, where there is one
    plain = F.regexp_replace("role", "^first-[mf]-", "first-n-")
    known = each.filter("role rlike '^first-[mf]-'").groupBy(plain.alias("role"), "value").agg(F.max("role").alias("known"))
    each = each.join(known, ["role", "value"], "left").withColumn("role", F.coalesce("known", "role")).drop("known")
    names = mapping(each.select("role", "value"), key)
    back = each.join(names, ["role", "value"]).groupBy("found", "kind").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("nth", "surrogate"))), lambda x: x["surrogate"]).alias("s")
    )  # the parts of one string
    f, s = F.col("found"), F.col("s")
    person = F.concat(_titles(f), F.array_join(F.zip_with(_names(f), s, _name), " "), F.when(f.endswith("."), ".").otherwise(""))
    mail = F.concat(s[0], F.lit("@"), F.element_at(s, -1))
    new = (
        F.when(F.col("kind") == "email", F.when(F.upper(f) == f, F.upper(mail)).otherwise(mail))
        .when(F.col("kind") == "ipv4", s[0])
        .when(F.col("kind").isin("card", "phone"), _refilled(f, s[0]))
        .otherwise(person)
    )
    return back.select("found", "kind", new.alias("replacement"))


def _name(original: Column, new: Column) -> Column:
    spelled = F.array_join(F.transform(F.split(new, "-"), lambda x: F.initcap(x)), "-")
    return F.when((F.upper(original) == original) & (F.length(original) > 1) & ~original.contains("."), F.upper(new)).otherwise(spelled)


def pseudonymise(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with every detected string replaced; ``_n_replaced`` (with more underscores if ``docs`` has it) is
    added as last column."""
    found = stored(detected(docs, text), "pii-found")
    new = replacements(found, key)
    by_text = (
        found.join(new, ["found", "kind"])
        .groupBy("tid")
        .agg(F.array_sort(F.collect_list(F.struct("idx", "replacement"))).alias("r"))
        .select("tid", F.transform("r", lambda x: x["replacement"]).alias("r"))
    )  # one text's matches
    own = lambda c: F.col(f"row.`{c}`")  # noqa: E731  a row travels as one struct beside our columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    has = F.coalesce(own(text).rlike(ANY), F.lit(False))
    rebuilt = F.array_join(
        F.zip_with(F.split(own(text), ANY), "r", lambda gap, r: F.concat(gap, F.coalesce(r, F.lit("")))), ""
    )
    n_replaced = "_n_replaced"
    while n_replaced in docs.columns:
        n_replaced = f"_{n_replaced}"
    hit = rows.filter(has).withColumn("tid", F.unhex(F.md5(own(text)))).join(by_text, "tid")
    hit = hit.select("row", rebuilt.alias("new"), F.size("r").alias("n"))
    out = rows.filter(~has).select("row", own(text).alias("new"), F.lit(0).alias("n")).unionByName(hit)
    return out.select(*[(F.col("new") if c == text else own(c)).alias(c) for c in docs.columns], F.col("n").alias(n_replaced))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    out = pseudonymise(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_replaced").alias("n_replaced"), "text")
