"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

Everything is a column expression. Places of matches come from the two halves that an expression makes of a text: its
matches, and the pieces between them; adding up their lengths gives the starts. Quantifiers are possessive and a match
may begin only where a run of its characters does or where the last match ended (``\\G``), which leaves the matches as
they are and keeps the work in proportion to the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before a span in which a context word counts.
CONTEXT = 40


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    padded = F.lpad(F.when(F.length(number) <= 20, number).otherwise(""), 20, "0")
    pairs = [F.substring(padded, i, 1).cast("int") for i in range(1, 21)]
    doubled = [F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d) if i % 2 == 0 else d for i, d in enumerate(pairs)]
    return reduce(lambda a, b: a + b, doubled) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without blanks passes ISO 7064 mod 97-10."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.ascii(c)
        return F.when(value < 58, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c))) == 1


@dataclass(frozen=True)
class Kind:
    """``may``: cheap test of a text; ``holds``: test of a match; ``context``: words that raise ``score``."""

    name: str
    form: str
    may: Callable[[Column], Column]
    holds: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


def part(match: Column) -> Column:
    byte = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return match.rlike(rf"^{byte}(?:\.{byte}){{3}}$")


def between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.length(digits(match)).between(low, high)


# Forms and context words.
KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: t.contains("@"), lambda m: F.lit(True), 0.8, "mail|contact|write to|courriel|correo"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), part, 0.5, "ip|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), lambda m: between(16, 19)(m) & luhn(digits(m)), 0.7, "card|visa|credit|debit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda t: t.rlike(r"\+[0-9]"), between(8, 15), 0.6, "phone|tel|call|fax|mobile|sms"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), lambda m: mod97(F.translate(m, " ", "")), 0.8, "iban|bank|account|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"), lambda m: F.lit(True), 0.3, "ssn|social security", base=False),
]
#: Score from which a span that only the method proposes is reported.
REPORTED = 0.5
BOOST = 0.2
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def kind_spans(kind: Kind, text: Column) -> Column:
    """Spans of one kind whose test holds, in order.

    The matches are taken in about as many chunks as a chunk has matches. A chunk begins where the lengths of those
    before it end, and only within a chunk does a list grow entry by entry.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(kind.form), F.lit(0)), F.split(text, kind.form)
    none = F.array().cast(SPANS)

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        near = F.lower(F.right(x["g"], F.lit(CONTEXT)))
        score = F.lit(kind.score) + F.when(near.rlike(rf"\b(?:{kind.context})"), BOOST).otherwise(0.0)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        keep = kind.holds(x["m"]) if kind.base else kind.holds(x["m"]) & (score >= REPORTED)
        return F.struct(end.alias("at"), F.when(keep, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    def chunked(both: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(both).cast("double"))).cast("int")
        starts = F.when(size > 0, F.sequence(F.lit(1), F.size(both), size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: chunk(F.slice(both, i, size)))

    def chunk(pieces: Column) -> Column:
        length = F.aggregate(pieces, F.lit(0).cast("long"), lambda n, x: n + F.length(x["g"]) + F.length(x["m"]))
        return F.struct(pieces.alias("pieces"), length.alias("length"))

    def spans_of(chunks: Column) -> Column:
        def of(c: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(chunks, F.lit(1), i), F.lit(0).cast("long"), lambda n, x: n + x["length"])
            return F.aggregate(c["pieces"], F.struct(before.alias("at"), none.alias("spans")), add, lambda s: s["spans"])

        return F.flatten(F.transform(chunks, of))

    # arrays of one element, so that what the inner expressions share is evaluated once
    both = F.array(F.filter(F.arrays_zip(found.alias("m"), gaps.alias("g")), lambda x: x["m"].isNotNull()))
    spans = F.transform(F.transform(both, chunked), spans_of)[0]
    return F.when(kind.may(text), spans).otherwise(none)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, spans)``: spans with score by kind as in ``KINDS``, then start; code points, end exclusive.

    Base kinds keep every span whose test holds; the added ones also need ``REPORTED``. One row per input row, repeated
    rows and null ids included; a null or empty text has no spans. Other columns are not read. No shuffle.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(id_col, F.concat(*(kind_spans(k, text) for k in KINDS)).alias("spans"))
