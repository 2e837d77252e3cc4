"""Personal data by regular expressions, checksum validators and context words.

Only built-in column functions. Per kind, a regular expression proposes spans
(leftmost, non-overlapping), a validator confirms or drops them (Luhn for card
numbers, mod 97 for IBANs, ranges and digit counts for the others), and words just
before the span raise or lower its score. Offsets are code points, the end exclusive.

The patterns are possessive and start only at the start of a run (or where the last
match ended), so matching stays linear on long runs; the matches are the same. The IBAN
pattern must give characters back and has bounded counts instead. An IBAN ends at its
country's length; one of another country or length ends at the last group with which
the checksum holds.

Null text counts as empty (no spans). Repeated rows are scanned one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import setup, text_or_empty

# Code points before a span that are searched for context words.
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
# Matches whose places are summed up together.
SUM_BLOCK = 512
SEEN = "struct<kind:string,start:bigint,end:bigint,score:double>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _chars(text: Column) -> Column:
    """Characters of an ASCII string; none of an empty one."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a string of digits."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        double = F.when(d < 5, d * 2).otherwise(d * 2 - 9)
        return F.when(i % 2 == 1, double).otherwise(d)

    return F.aggregate(F.transform(_chars(F.reverse(digits)), weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """IBAN checksum: country and check digits last, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(moved), F.lit(0), add) == 1


def _octets(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"))


@dataclass(frozen=True)
class Kind:
    """One kind of personal data; ``hint`` is a cheap test that a text can hold it at all."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column] | None
    score: float
    context: tuple[str, ...]
    part: Callable[[Column], Column] | None = None  # the start of a match that is the span, null if none is


# Length of an IBAN by country (ISO 13616 registry).
IBAN_COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _of_length(n: int) -> str:
    """IBANs of one length, compact or in groups of four."""
    groups, rest = divmod(n - 4, 4)
    tail = f" [A-Z0-9]{{{rest}}}" if rest else ""
    countries = IBAN_COUNTRIES[n].replace(" ", "|")
    return f"(?:{countries})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{tail})"


_LISTED = "(?:" + "|".join(map(_of_length, IBAN_COUNTRIES)) + ")"
_LISTED_START = "(?:" + "|".join(IBAN_COUNTRIES.values()).replace(" ", "|") + ")[0-9]{2}"
# Any other country or length; a group that starts a listed country's IBAN is not part of it.
_UNLISTED = (
    r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}"
    rf"|(?: (?!{_LISTED_START} )[A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}}(?![A-Za-z0-9]))?)"
)


def iban_part(match: Column) -> Column:
    """The IBAN at the start of a match: all of it, or for unlisted lengths as many groups as pass mod 97."""
    groups = F.split(match, " ")
    n = F.size(groups)
    sizes = F.when((n < 3) | match.rlike(f"^{_LISTED}$"), F.array(n)).otherwise(F.sequence(n, F.lit(3), F.lit(-1)))
    starts = F.transform(sizes, lambda k: F.array_join(F.slice(groups, F.lit(1), k), " "))
    return F.get(F.filter(starts, mod97), F.lit(0))


BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        None,
        0.6,
        ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
        lambda t: F.contains(t, F.lit(".")),
        _octets,
        0.5,
        ("ip", "address", "host", "server", "adresse"),
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9])++",
        lambda t: t.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}"),
        lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)),
        0.7,
        ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        lambda m: F.length(_digits(m)).between(8, 15),
        0.6,
        ("phone", "call", "tel", "mobile", "fax"),
    ),
)
IBAN = Kind(
    "iban",
    rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}}[\x20A-Z0-9])(?:{_LISTED}|{_UNLISTED})(?![A-Za-z0-9])",
    lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
    None,
    0.8,
    ("iban", "account", "bank", "konto", "cuenta", "compte"),
    iban_part,
)
KINDS = (*BASE, IBAN)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside nested lambdas an expression is computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(numbers: Column) -> Column:
    """Sums up to and with every element. Appending copies the array, so the sums are built in
    blocks of ``SUM_BLOCK`` from the blocks' totals: no copy is longer than a block or the list of blocks."""

    def appended(block: Column, before: Column) -> Column:
        first = F.array(before)
        return F.slice(
            F.aggregate(block, first, lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)), 2, SUM_BLOCK
        )

    def in_blocks(n: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / SUM_BLOCK).cast("int"))
        return F.transform(places, lambda i: F.slice(n, i * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))

    def joined(blocks: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: a + x))
        before = F.aggregate(totals, F.array(zero), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
        return F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), appended))

    none = F.expr("cast(array() as array<bigint>)")
    return _bound(numbers, lambda n: F.when(F.size(n) > 0, _bound(in_blocks(n), joined)).otherwise(none))


def findings(text: Column, kind: Kind) -> Column:
    """``array<struct<kind, start, end, score>>`` of one kind, by start."""
    match = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)  # the text before, between and after the matches
    steps = F.arrays_zip(F.slice(between, 1, F.size(match)).alias("gap"), match.alias("match"))
    words = "(?i)(?:" + "|".join(kind.context) + r")[^\n]{0,12}$"

    def span(s: Column, end: Column) -> Column:
        """The span of one match, null if the validator drops it."""
        start = end - F.char_length(s["match"])
        part = kind.part(s["match"]) if kind.part else s["match"]
        near = F.right(s["gap"], F.lit(CONTEXT_CHARS)).rlike(words)
        made = F.struct(
            F.lit(kind.name).alias("kind"),
            start.cast("bigint").alias("start"),
            (start + F.char_length(part)).cast("bigint").alias("end"),
            (F.lit(kind.score) + F.when(near, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))).alias("score"),
        )
        return F.when(kind.valid(s["match"]) if kind.valid else part.isNotNull(), made)

    def spans(found: Column) -> Column:
        ends = running_sums(F.transform(found, lambda s: (F.char_length(s["gap"]) + F.char_length(s["match"])).cast("bigint")))
        return F.filter(F.zip_with(found, ends, span), lambda s: s.isNotNull())

    none = F.expr(f"cast(array() as array<{SEEN}>)")
    return F.when(kind.hint(text), _bound(steps, spans)).otherwise(none)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and one array of findings per kind (``email, ip, card, phone, iban``), for every row."""
    setup(docs.sparkSession)
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return rows.select("id", *(findings(F.col("text"), k).alias(k.name) for k in KINDS)).withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the base digest, the span list and the highest score."""

    def joined(names: list[str]) -> Column:
        everything = F.concat(*(F.col(n) for n in names))
        return F.array_join(
            F.transform(everything, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    base, names = [k.name for k in BASE], [k.name for k in KINDS]
    return found.select(
        id_col,
        *(F.size(n).cast("long").alias(f"n_{n}") for n in base),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(names).alias("spans"),
        F.size("iban").cast("long").alias("n_iban"),
        F.array_max(F.transform(F.concat(*names), lambda s: s["score"])).alias("top_score"),
    )
