"""Personal data: regular expressions propose spans, checksums confirm them,
context words nearby adjust the score.

Kinds email, ip, card and phone are the base: a match is a span when its
validator holds (parts up to 255; Luhn over 14 to 19 digits; 10 to 15
digits).  The method adds kinds iban (mod 97) and ssn, which need a score:
a base score by kind, more when a context word stands within ``NEARBY``
characters before the span.  Matches are leftmost and non-overlapping by
kind; spans of different kinds may overlap.  Offsets count code points.

Patterns are written so that every text takes time in proportion to its
length, and spans in proportion to their number: runs are possessive and begin only where a run begins, and
separators that may stand inside a match are first replaced, one for one,
by a private-use character, so that no group repeats without bound.

A null text is empty and has no span.  Repeated rows get equal rows; columns
with an output's name are replaced.  DataFrame functions only; map-only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let, part, pieces, running, same_shape

INNER = "\ue000"  # stands for a separator inside a match
NEARBY = 40
LEAST_SCORE = 0.5

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = f"[A-Za-z0-9._%+{INNER}-]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes: from the right, every second digit is
    doubled and its digits added."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(c.cast("int") * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0)))
    return F.aggregate(figures, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN without spaces leaves 1: the first four characters go
    to the end, letters count from 10."""
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    may_have: Callable[[Column], Column]  # cheap test of a text
    valid: Callable[[Column], Column]
    base: bool
    score: float
    words: str  # context words, alternatives of a pattern
    inner: str | None = None  # pattern of separators that may stand inside


# The base kinds and their patterns, in the order of output.
KINDS = (
    Kind("email", f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++{INNER}[A-Za-z0-9{INNER}-]++", lambda t: t.contains("@"), lambda m: F.lit(True), True, 0.9, "mail|contact|write to", "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])"),
    Kind("ip", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++", lambda t: t.rlike("[0-9]\\.[0-9]"), lambda m: m.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$"), True, 0.6, "address|host|server|login"),
    Kind("card", f"(?<![0-9{INNER}])[0-9](?:{INNER}?[0-9]){{13,18}}+(?![0-9{INNER}])", lambda t: t.rlike("[0-9][ -]?[0-9]"), lambda m: luhn(_digits(m)), True, 0.8, "card|visa|credit|payment", "(?<=[0-9])[ -](?=[0-9])"),
    Kind("phone", "\\+[0-9][ ().0-9-]+[0-9]", lambda t: t.contains("+"), lambda m: F.length(_digits(m)).between(10, 15), True, 0.7, "phone|tel|call|mobile"),
    Kind("iban", "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])", lambda t: t.rlike("[A-Z]{2}[0-9]{2}[A-Z0-9]{11}"), mod97, False, 0.6, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), lambda m: ~m.rlike("^(000|666|9..)|-00-|-0000$"), False, 0.2, "ssn|social security"),
)
_NO_SPANS = "array<struct<start:int,kind:int,end:int,score:double>>"


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (start, end, match): the gaps between matches come from
    splitting by the same pattern, positions from running sums of lengths."""

    def placed(z: Column) -> Column:
        lengths = F.transform(z, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["value"]), F.lit(0)))
        matches = F.filter(z, lambda p: p["value"].isNotNull())

        def one(p: Column, start: Column) -> Column:
            return F.struct(start.alias("start"), (start + F.length(p["value"])).alias("end"), p["value"].alias("value"))

        return running(
            lengths, lambda x, y: x + y, lambda before: F.transform(matches, lambda p, i: let(before(i) + F.length(p["gap"]), lambda start: one(p, start)))
        )

    def found(t: Column) -> Column:
        gaps = F.split(t, kind.pattern, -1)
        return let(F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0)).alias("value")), placed)

    if kind.inner:
        text = F.regexp_replace(F.regexp_replace(text, INNER, "\ue001"), kind.inner, INNER)
    return let(text, found)


def _spans(text: Column, cut: Column, kind: Kind, order: int) -> Column:
    valid = F.filter(_matches(text, kind), lambda m: kind.valid(m["value"]))

    def scored(m: Column) -> Column:
        from_ = F.greatest(m["start"] - NEARBY, F.lit(0))
        near = F.lower(part(cut, from_, m["start"] - from_))
        score = kind.score + F.when(near.rlike(f"(?:{kind.words})"), 0.4).otherwise(0.0)
        return F.struct(m["start"].alias("start"), F.lit(order).alias("kind"), m["end"].alias("end"), F.least(score, F.lit(1.0)).alias("score"))

    spans = F.transform(valid, scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)
    return F.when(kind.may_have(text), spans).otherwise(F.array()).cast(_NO_SPANS)


def find_spans(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``df`` with ``spans``: array of (start, kind, end, score) by start and
    kind; ``kind`` is a place in ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = let(text, lambda t: let(pieces(t), lambda cut: F.sort_array(F.concat(*[_spans(t, cut, k, i) for i, k in enumerate(KINDS)]))))
    return same_shape(df, {"spans": found})


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans, their digest, and all spans written out."""
    rows = find_spans(df.select(id_col, text_col), text_col=text_col)
    n_base = sum(k.base for k in KINDS)
    base = F.filter("spans", lambda s: s["kind"] < n_base)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base]
    return rows.select(id_col, *counts, F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redact(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``df`` with every span replaced by its kind in angle brackets; spans
    that overlap become one, named by the first.  A null text stays null."""
    names = F.array(*[F.lit(f"<{k.name.upper()}>") for k in KINDS])
    text, n = F.col(text_col), F.size("spans")

    def written(cut: Column, before: Callable[[Column], Column]) -> Column:
        """Each span that begins behind all earlier ones takes the text from
        their end on with it; the rest of the text comes last."""
        placed = F.transform("spans", lambda s, i: F.struct(before(i).alias("from"), s["start"].alias("start"), s["kind"].alias("kind")))
        firsts = F.filter(placed, lambda s: s["start"] >= s["from"])
        cuts = F.transform(firsts, lambda s: F.concat(part(cut, s["from"], s["start"] - s["from"]), F.get(names, s["kind"])))
        return F.concat(F.array_join(cuts, ""), part(cut, before(n), F.length(text)))

    ends = F.transform("spans", lambda s: s["end"])
    cut = let(pieces(text), lambda c: running(ends, lambda x, y: F.greatest(x, y), lambda before: written(c, before)))
    rows = find_spans(df.select("*"), text_col=text_col)
    columns = [F.when(text.isNull() | (F.size("spans") == 0), text).otherwise(cut).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c != "spans"]
    return rows.select(*columns)
