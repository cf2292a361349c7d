"""Personal data: patterns, checksums and context words, in built-in functions alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Possessive quantifiers and a start at the edge of a run (or at the end of the
# match before, \G) keep matching linear and free of recursion on long texts;
# they find what the plain patterns find.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
    r"(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
#: A run that may be a key or token; what parts words ends it.
SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"
IP_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
IP_VALID = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
#: Code points before and after a span in which context words count.
CONTEXT = 60
BLOCK = 256


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether 16 to 19 digits pass Luhn's check."""
    plain = digits(match)

    def doubled(place: Column) -> Column:
        digit = F.substring(F.reverse(plain), place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(place % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(plain)), doubled), F.lit(0), lambda a, b: a + b)
    return F.length(plain).between(16, 19) & (total % 10 == 0)


def mod_97(match: Column) -> Column:
    """Whether an account number of 15 to 34 characters leaves 1 mod 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(turned, place, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    rest = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)
    return F.length(plain).between(15, 34) & (rest == 1)


def short_parts(match: Column) -> Column:
    return match.rlike(IP_VALID)


def phone_length(match: Column) -> Column:
    return F.length(digits(match)).between(8, 15)


def mixed_enough(match: Column) -> Column:
    """Whether letters, digits and many different characters make a run a likely secret."""
    digits_in = F.length(F.regexp_replace(match, "[^0-9]", ""))
    letters_in = F.length(F.regexp_replace(match, "[^A-Za-z]", ""))
    different = F.size(F.array_distinct(F.split(match, "")))
    return (F.length(match) <= 512) & (digits_in >= 4) & (letters_in >= 4) & (different >= 10)


def always(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``needs`` is a fragment or pattern without which a text has no match. A span
    scores ``score`` if its checksum holds, plus ``raised`` with a word of
    ``context`` near it, minus ``lowered`` with a word of ``against``.
    """

    name: str
    pattern: str
    needs: str
    valid: Callable[[Column], Column]
    base: bool
    score: float
    context: str
    against: str = "example|sample|test|dummy"
    raised: float = 0.2
    lowered: float = 0.2


KINDS = (
    Kind("email", EMAIL, "@", always, True, 0.7, "e-?mail|contact|write|reach|mailto"),
    Kind("ip", IP, r"[0-9]\.[0-9]", short_parts, True, 0.5, r"\bip\b|address|host|server|login|logged", "version|release|section"),
    Kind("card", CARD, "[0-9]", luhn, True, 0.7, "card|visa|mastercard|credit|debit|payment|paid"),
    Kind("phone", PHONE, r"\+[0-9]", phone_length, True, 0.5, r"phone|tel\b|call|mobile|fax|whatsapp|number"),
    Kind("iban", IBAN, "[A-Z]{2}[0-9]{2}", mod_97, False, 0.7, "iban|account|bank|transfer|bic|swift"),
    # Such runs are also names of files and commits: only a word beside one makes it a secret.
    Kind("secret", SECRET, "[A-Za-z0-9_-]{20}", mixed_enough, False, 0.3, r"token|secret|api[ _-]?key|access[ _-]?key|passw|bearer|credential", raised=0.3),
)
SPAN = "array<struct<kind:int,start:int,end:int,score:double,text:string>>"


def running(lengths: Column) -> Column:
    """Running sums of an array, in blocks so that a long one stays cheap."""

    def summed(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0)), lambda done, x: F.array_append(done, F.element_at(done, -1) + x))

    def ended(values: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
            lambda b: summed(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))),
        )
        joined = F.transform(F.array(blocks), lambda inner: _offset(inner, summed(F.transform(inner, lambda w: F.element_at(w, -1)))))
        return F.flatten(joined)

    def _offset(inner: Column, before: Column) -> Column:
        moved = F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)), lambda w, o: F.transform(F.slice(w, F.lit(2), F.size(w) - 1), lambda e: e + o))
        return F.flatten(moved)

    return F.flatten(F.transform(F.array(lengths), ended))


def kind_spans(text: Column, number: int, kind: Kind, least_score: float) -> Column:
    """Valid spans of a kind: code points from 0, end exclusive.

    Matches and the gaps between them, laid end to end, give the places, and the
    gaps next to a match its context. A base span stays whatever its score;
    another kind's must reach ``least_score``.
    """
    has = F.contains(text, F.lit(kind.needs)) if kind.needs == "@" else text.rlike(kind.needs)
    matches = F.when(has, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)))
    # One-element arrays bind what is used more than once, so that it is computed once.
    some = F.transform(F.array(matches), lambda m: F.when(F.size(m) > 0, F.struct(m.alias("m"), F.split(text, kind.pattern, -1).alias("g"))))

    def placed(p: Column) -> Column:
        before, after = F.slice(p.g, F.lit(1), F.size(p.m)), F.slice(p.g, F.lit(2), F.size(p.m))
        ends = running(F.zip_with(before, p.m, lambda g, m: F.length(g) + F.length(m)))
        near = F.zip_with(before, after, lambda b, a: F.lower(F.concat(F.right(b, F.lit(CONTEXT)), F.lit(" "), F.left(a, F.lit(CONTEXT)))))
        own = F.zip_with(p.m, ends, lambda m, end: F.struct(m.alias("text"), end.alias("end")))
        found = F.zip_with(own, near, lambda o, n: F.struct(o.text.alias("text"), o.end.alias("end"), n.alias("near")))
        scored = F.transform(F.filter(found, lambda x: kind.valid(x.text)), lambda x: _scored(number, kind, x))
        return scored if kind.base else F.filter(scored, lambda x: x.score >= least_score)

    found = F.flatten(F.transform(F.filter(some, lambda p: p.isNotNull()), placed))
    return F.coalesce(found.cast(SPAN), F.array().cast(SPAN))


def _scored(number: int, kind: Kind, x: Column) -> Column:
    score = F.lit(kind.score) + F.when(x.near.rlike(kind.context), kind.raised).otherwise(0.0)
    score = F.round(score - F.when(x.near.rlike(kind.against), kind.lowered).otherwise(0.0), 6)
    start = x.end - F.length(x.text)
    return F.struct(F.lit(number).alias("kind"), start.alias("start"), x.end.alias("end"), score.alias("score"), x.text.alias("text"))


def found_in(text: Column, least_score: float = 0.5, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All spans of a text by kind as listed, then start; a null is empty."""
    return F.concat(*(kind_spans(text, i, kind, least_score) for i, kind in enumerate(kinds)))


def _listed(spans: Column, kinds: tuple[Kind, ...]) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.kind), x.start.cast("string"), x.end.cast("string"))), ","
    )


def find(docs: DataFrame, least_score: float = 0.5, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Personal data in every row of ``docs`` (``doc_id, text``).

    Returns ``doc_id``, ``n_<kind>`` of the base kinds, ``base_sha256`` over the
    base spans, ``spans`` over all spans, both as ``kind:start:end`` joined by
    commas, and ``found`` with score and text of each span. Spans of one kind
    don't overlap, those of two kinds may. A null or empty text has none. Other
    columns are not read; repeated rows give repeated rows.
    """
    base = [i for i, k in enumerate(kinds) if k.base]
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", found_in(F.col("text"), least_score, kinds).alias("found"))
    first = F.filter("found", lambda x: x.kind.isin(base))

    def many(number: int) -> Column:
        return F.size(F.filter("found", lambda x: x.kind == number)).cast("bigint")

    return rows.select(
        "doc_id",
        *(many(i).alias(f"n_{kinds[i].name}") for i in base),
        F.sha2(_listed(first, kinds), 256).alias("base_sha256"),
        _listed(F.col("found"), kinds).alias("spans"),
        "found",
    )


def redacted(text: Column, least_score: float = 0.5, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """The text with each span replaced by its kind in angle brackets.

    Of overlapping spans the earlier one (the longer one of two that start
    together) is named; what the later ones cover beyond it goes with it.
    """
    names = F.array(*(F.lit(f"<{k.name}>") for k in kinds))

    def ordered(spans: Column) -> Column:
        return F.array_sort(F.transform(spans, lambda x: F.struct(x.start.alias("start"), (-x.end).alias("back"), x.kind.alias("kind"))))

    def step(done: Column, x: Column) -> Column:
        piece = F.concat(F.substring(text, done.at + 1, x.start - done.at), F.get(names, x.kind))
        inside = x.start < done.at
        return F.struct(
            F.greatest(done.at, -x.back).alias("at"),
            F.when(inside, done.out).otherwise(F.array_append(done.out, piece)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = F.aggregate(
        ordered(found_in(text, least_score, kinds)),
        start,
        step,
        lambda done: F.concat(F.array_join(done.out, ""), F.substring(text, done.at + 1, F.length(text))),
    )
    return F.when(text.isNotNull(), rest)


def redact(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """``docs`` with its columns, personal data in ``text`` replaced, ``n_chars`` renewed."""
    text = F.col("text")
    rows = docs.withColumn("text", redacted(text, least_score))
    return rows.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else rows
