"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each whole text; the ledger stores the
measurements and one bit for each failed rule.  A policy is a version with
a mask of rules: applying it is one ``&``, so policies can be compared, and
rules ablated, without reading a text again.

Words are ``[^\\x20\\x09-\\x0D]+``.  A null text has no word and is handled
like an empty one: it fails ``few_words``.  Repeated rows get equal rows;
other columns are carried along, except those with a ledger column's name.
DataFrame functions only; map-only up to the ablation, which adds up bits
with map-side combining.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD
from .native import head, let, same_shape, tail

NON_WORD = "[\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"

MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Fails where the condition (SQL over the measurements) holds."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
)


def mask_of(*names: str) -> int:
    known = {r.name: 1 << i for i, r in enumerate(RULES)}
    return reduce(or_, (known[n] for n in names), 0)


BASE = mask_of("few_words", "repeated_windows")
# versions are added, never changed
POLICIES = {
    "base": BASE,
    "v1": BASE | mask_of("many_symbols"),
    "v2": BASE | mask_of("many_symbols", "repeated_lines", "short_words", "long_words"),
}
CURRENT = "v2"


def repeated_window_words(words: Column, k: int = 3) -> Column:
    """Words that lie in a ``k``-word window found twice or more.

    Windows are sorted with their places; equal neighbours mark both
    places, and each marked place covers the words up to the next one, k
    at most."""

    def places(keys: Column) -> Column:
        entries = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            entries,
            lambda e: F.sort_array(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(F.arrays_zip(e.alias("a"), tail(e, 1).alias("b")), lambda z: z["a"]["h"] == z["b"]["h"]),
                            lambda z: F.array(z["a"]["i"], z["b"]["i"]),
                        )
                    )
                )
            ),
        )

    def keys(hashes: Column) -> Column:
        shifted = [tail(hashes, j).alias(f"w{j}") for j in range(k)]
        return head(F.transform(F.arrays_zip(*shifted), lambda z: F.xxhash64(*[z[f"w{j}"] for j in range(k)])), k - 1)

    marked = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: places(keys(h)))
    return let(
        marked,
        lambda m: F.aggregate(
            F.arrays_zip(m.alias("a"), tail(m, 1).alias("b")),
            F.lit(0).cast("long"),
            lambda total, z: total + F.least(F.lit(k), F.coalesce(z["b"] - z["a"], F.lit(k))),
        ),
    )


def measure(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``df`` with the measurements of each text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    from_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_window_words(w).alias("n_repeat_words"),
        ),
    )
    from_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    out = same_shape(df, {"__w": from_words, "__l": from_lines, "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")})
    return same_shape(
        out,
        {
            "n_words": F.col("__w.n_words"),
            "word_chars": F.col("__w.word_chars"),
            "n_symbols": F.col("n_symbols"),
            "n_lines": F.col("__l.n"),
            "n_dup_lines": F.col("__l.dup"),
            "n_repeat_words": F.col("__w.n_repeat_words"),
        },
    ).drop("__w", "__l")


def ledger(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``df`` without its text, with measurements and ``failures``, one bit
    for each failed rule."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)]
    return same_shape(measure(df, text_col=text_col).drop(text_col), {"failures": reduce(add, bits)})


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """``kept``: no rule of the policy failed."""
    return same_shape(entries, {"kept": F.col("failures").bitwiseAND(F.lit(POLICIES[policy])) == 0})


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: texts that fail it, and texts that only
    this rule rejects, so that dropping it would bring them back."""
    mask = POLICIES[policy]
    failed = F.col("failures").bitwiseAND(F.lit(mask))
    # one pass; a text's row is combined into one row of counts per task
    own = [(r.name, 1 << i) for i, r in enumerate(RULES) if mask >> i & 1]
    counts = [F.count(F.when(failed.bitwiseAND(F.lit(b)) != 0, 1)).alias(f"f_{n}") for n, b in own]
    alone = [F.count(F.when(failed == b, 1)).alias(f"a_{n}") for n, b in own]
    totals = entries.agg(F.count(F.lit(1)).alias("n_texts"), F.count(F.when(failed != 0, 1)).alias("n_rejected"), *counts, *alone)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("n_failed"), F.col(f"a_{n}").alias("n_only")) for n, _ in own])
    return totals.select("n_texts", "n_rejected", F.inline(rows))


def failed_anywhere(entries: DataFrame, group_col: str, policy: str = CURRENT) -> DataFrame:
    """By group: rules failed by any text (``bit_or``) and by all (``bit_and``)."""
    failed = F.col("failures").bitwiseAND(F.lit(POLICIES[policy]))
    return entries.groupBy(group_col).agg(F.bit_or(failed).alias("any_failed"), F.bit_and(failed).alias("all_failed"), F.count(F.lit(1)).alias("n_texts"))
