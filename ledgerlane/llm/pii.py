"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

All of it is one projection of built-in functions; texts are not shuffled. Positions come from
cutting a text at the matches of a pattern: the lengths of the pieces and of the matches add up to
the offsets, in code points, end exclusive. Matches are leftmost and do not overlap within a kind.

The patterns use possessive quantifiers and a look-behind instead of retries, so their work grows
in proportion to the text, also on endless runs of one character. The length of an account number follows
from its country code, so words behind it do not matter. NULL and empty texts have no
spans. Spans of different kinds may overlap; ``redact`` replaces a stretch of overlapping spans
once, by the tag of the span that begins first (of equal starts, the kind listed first).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .columns import as_rows, blocks, let, running


class Kind(NamedTuple):
    """``probe``: cheap pattern a text must contain. ``base``: spans stay whatever their score."""

    name: str
    probe: str
    pattern: str
    score: float
    context: str
    base: bool


_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
# Length of an account number by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU MN", 21: "HR LV LI CH", 22: "BH BG CR GE DE IE ME RS GB VA",
    23: "TL GI IQ IL OM SO AE", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO SV GT HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
KINDS = [
    Kind("email", "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", 0.8, r"e-?mail|contact|write to|courriel|correo", True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\bip\b|host|server|address|adresse|login", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){15}", r"[0-9](?:[\x20-]?[0-9])++", 0.6, r"card|visa|master|credit|karte|carte|tarjeta", True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, r"phone|tel|call|mobile|fax|anruf|appel|llam", True),
    Kind("iban", r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", 0.8, r"iban|account|konto|compte|cuenta", False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, r"ssn|social security", False),
    Kind("secret", r"[0-9A-Fa-f]{16}", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])", 0.2, r"(?:token|secret|passw(?:or)?d|api[ _-]?key)\W{0,6}$", False),
]
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.35
ACCEPT = 0.5


def luhn(digits: Column) -> Column:
    """True for a string of digits with a valid Luhn checksum."""

    def step(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(k % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def mod97(number: Column) -> Column:
    """True for an account number whose rearranged digits leave 1 when divided by 97."""
    turned = F.concat(F.substr(number, F.lit(5)), F.substring(number, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _confirmed(kind: str, value: Column) -> Column:
    """The checksum or range test of a kind."""
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        digits = F.regexp_replace(value, r"[\x20-]", "")
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(value, " ", ""))
    if kind == "ssn":
        return ~value.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _located(text: Column, kind: Kind) -> Column:
    """Matches with start and end: the running sum over pieces and matches."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    pairs = F.filter(
        F.zip_with(gaps, hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("len"), hit.alias("value"))),
        lambda x: x["value"].isNotNull())

    def placed(p: Column) -> Column:
        before = running(F.transform(p, lambda x: x["gap"] + x["len"]))
        return F.zip_with(before, p, lambda at, x: F.struct(
            (at + x["gap"]).alias("start"), (at + x["gap"] + x["len"]).alias("end"), x["value"].alias("value")))

    return let(pairs, placed)


def _scored(text: Column, kind: Kind, order: int) -> Column:
    """Confirmed spans of one kind as (order, start, end, score)."""
    empty = F.array().cast("array<struct<order:int,start:int,end:int,score:double>>")

    def rated(x: Column) -> Column:
        begin = F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0))
        near = F.lower(F.substring(text, begin + 1, x["start"] - begin)).rlike(kind.context)
        # A context that ends at the span is only looked for before it.
        if not kind.context.endswith("$"):
            near = near | F.lower(F.substring(text, x["end"] + 1, F.lit(CONTEXT_CHARS))).rlike(kind.context)
        score = F.lit(kind.score) + F.when(near, CONTEXT_GAIN).otherwise(0.0)
        return F.struct(F.lit(order).alias("order"), x["start"].alias("start"), x["end"].alias("end"), score.alias("score"))

    found = F.transform(F.filter(_located(text, kind), lambda x: _confirmed(kind.name, x["value"])), rated)
    if not kind.base:
        found = F.filter(found, lambda x: x["score"] >= ACCEPT)
    return F.when(text.rlike(kind.probe), found).otherwise(empty)


def find_spans(docs: DataFrame, keep: list[str], text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """``keep`` and ``spans``: array of (order, start, end, score), by kind as listed, then start."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*keep, F.concat(*[_scored(body, kind, k) for k, kind in enumerate(kinds)]).alias("spans"))


def joined(spans: Column, kinds: list[Kind] = KINDS) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["order"]), x["start"], x["end"])), ",")


def _replaced(text: Column, spans: Column, kinds: list[Kind]) -> Column:
    """The text with a tag in place of every stretch of spans."""
    tags = F.array(*[F.lit(f"<{k.name.upper()}>") for k in kinds])
    in_order = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["order"].alias("order"), x["end"].alias("end"))))
    none = F.array().cast("array<string>")

    def step(state: Column, x: Column) -> Column:
        piece = F.substring(text, state["at"] + 1, x["start"] - state["at"])
        fresh = x["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(piece, F.get(tags, x["order"])))).otherwise(state["out"]).alias("out"))

    def block_step(state: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(state["at"].alias("at"), none.alias("out")), step)
        return let(inner, lambda s: F.struct(s["at"].alias("at"), F.array_append(state["out"], F.array_join(s["out"], "")).alias("out")))

    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    cut = F.aggregate(let(in_order, blocks), start, block_step)
    return let(cut, lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, s["at"] + 1)))


def redact(docs: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """``docs`` with every span replaced by its tag; rows without spans are handed through, NULL too."""
    found = find_spans(docs.select(as_rows(docs), F.col(f"`{text}`").alias("__text")), ["__row", "__text"], "__text", kinds)
    clean = F.when(F.size("spans") == 0, F.col("__text")).otherwise(
        let(F.col("spans"), lambda s: _replaced(F.coalesce(F.col("__text"), F.lit("")), s, kinds)))
    return found.select("__row", clean.alias("__clean")).select(
        *[F.col("__clean").alias(text) if c == text else F.col("__row")[c].alias(c) for c in docs.columns])
