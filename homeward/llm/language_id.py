"""Language identification: multinomial naive Bayes over hashed character
n-grams.

A text is lower-cased character by character, every run of characters that
are no letters becomes one space, and a space is put at both ends.  Its
1- to 3-grams are hashed into ``2**bits`` buckets.  Training counts them by
language over all labelled rows: each task adds up its own counts and one
aggregation joins them, so a language that holds most rows costs no more
than a rare one.  The model is the matrix of log probabilities (buckets x
languages), broadcast to the tasks that score, in blocks of at most
``BLOCK_LANGUAGES`` languages; any number of languages is scored exactly.

Rows with null text or null language teach nothing.  A text that is null or
has no letter is ``und`` with score 0.  Equal scores go to the language
first by name.  Without any labelled row all texts are ``und``.  Texts are
read whole: a long one in pieces whose n-gram counts add up, n-grams across
a cut included.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_text, map_arrow, stage_table, text_slices

UNDETERMINED = "und"
SLICE_BYTES = 1 << 20  # of a long text
BATCH_BYTES = 1 << 18  # of several texts; their arrays take many times as much
BLOCK_LANGUAGES = 64  # columns of a broadcast matrix (16 MB)


@dataclass(frozen=True)
class NgramSpec:
    bits: int = 15
    orders: tuple[int, ...] = (1, 2, 3)
    smoothing: float = 0.5


@dataclass
class Model:
    spec: NgramSpec
    languages: list[str]
    log_prior: np.ndarray  # by language
    log_prob: np.ndarray  # bucket x language


@dataclass
class Counts:
    """N-gram counts of all languages, a written table (lang, bucket, n);
    bucket ``2**bits`` has a language's rows."""

    spec: NgramSpec
    table: DataFrame
    languages: list[str]
    rows: int

    def models(self):
        """Models of at most ``BLOCK_LANGUAGES`` languages each, whose counts
        alone reach the driver (a row for each language and bucket).  Priors
        are those among all languages."""
        size = 1 << self.spec.bits
        for i in range(0, max(len(self.languages), 1), BLOCK_LANGUAGES):
            block = self.languages[i : i + BLOCK_LANGUAGES]
            found = self.table.where(F.col("lang").between(block[0], block[-1])).toPandas() if block else None
            matrix = np.zeros((size + 1, len(block)))
            if block:
                matrix[found["bucket"].to_numpy(np.int64), found["lang"].map({x: k for k, x in enumerate(block)}).to_numpy(np.int64)] = found["n"].to_numpy()
            grams = matrix[:size] + self.spec.smoothing
            yield Model(self.spec, block, np.log(matrix[size] / max(self.rows, 1)), np.log(grams / grams.sum(axis=0, keepdims=True)))


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _folded(data: np.ndarray, offsets: np.ndarray):
    """(letters and single spaces of all texts, text of each, letters by
    text); each text has a space before and behind."""
    n = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(heads)])[offsets]  # first code point of each text
    own = np.repeat(np.arange(n), np.diff(at))
    # a space before and one behind each text
    ends = np.stack([at[:-1], at[1:]], axis=1).ravel()
    letters = np.insert(_folding()[points], ends, 32)
    doc = np.insert(own, ends, np.repeat(np.arange(n), 2))
    blank = letters == 32
    keep = ~blank
    keep[0] = True
    keep[1:] |= blank[1:] & ~blank[:-1]
    # the first space of a text stays apart from the last one of the text before
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    keep[first] = True
    letters, doc = letters[keep], doc[keep]
    return letters, doc, np.bincount(doc[letters != 32], minlength=n)


def _buckets(letters: np.ndarray, doc: np.ndarray, spec: NgramSpec, known: int = 0):
    """(bucket, text) of every n-gram that lies in one text, holds a letter
    and ends behind the first ``known`` places."""
    mask = np.uint32((1 << spec.bits) - 1)
    code = letters * np.uint32(0x9E3779B1)
    out_b, out_d = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for k in spec.orders:
        m = len(letters) - k + 1
        if m <= 0:
            continue
        h = np.full(m, np.uint32(k * 0x85EBCA6B & 0xFFFFFFFF))
        for j in range(k):
            h = (h ^ code[j : j + m]) * np.uint32(0xC2B2AE35)
            h ^= h >> np.uint32(15)
        ok = doc[:m] == doc[k - 1 :]
        if k == 1:
            ok &= letters != 32
        ok[: max(known - k + 1, 0)] = False
        out_b.append((h & mask)[ok])
        out_d.append(doc[:m][ok])
    return np.concatenate(out_b), np.concatenate(out_d)


def _pieces(batch: pa.RecordBatch, column: int):
    """(first row, row after the last, bytes, offsets) of slices of a batch.
    A text over twice the slice size comes in pieces."""
    data, offsets = flat_text(batch.column(column))
    for a, b in text_slices(offsets, min(BATCH_BYTES, SLICE_BYTES)):
        if offsets[b] - offsets[a] <= 2 * SLICE_BYTES:
            yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            continue
        start, end = int(offsets[a]), int(offsets[b])
        while start < end:
            stop = min(end, start + SLICE_BYTES)
            while stop < end and data[stop] & 0xC0 == 0x80:
                stop += 1
            yield a, b, data[start:stop], np.array([0, stop - start])
            start = stop


def _ngrams(batch: pa.RecordBatch, column: int, spec: NgramSpec):
    """(first row, row after the last, n-gram buckets, their row, letters by
    row) of slices of a batch.  Each piece of a long text continues the one
    before: it has the n-grams that end in it."""
    pieces = list(_pieces(batch, column))
    carry = None
    for i, (a, b, data, offsets) in enumerate(pieces):
        more = i + 1 < len(pieces) and pieces[i + 1][0] == a
        if carry is None and not more:
            letters, doc, counted = _folded(data, offsets)
            yield a, b, *_buckets(letters, doc, spec), counted
            continue
        if carry is None:
            carry = np.array([32], np.uint32)
        folded = _folding()[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
        letters = np.concatenate([carry, folded, np.full(0 if more else 1, 32, np.uint32)])
        keep = letters != 32
        keep[1:] |= keep[:-1].copy()
        keep[: len(carry)] = True
        letters = letters[keep]
        yield a, b, *_buckets(letters, np.zeros(len(letters), np.int64), spec, len(carry)), np.array([np.count_nonzero(folded != 32)])
        carry = letters[max(len(letters) - max(spec.orders) + 1, 0) :] if more else None


def learn(df: DataFrame, spec: NgramSpec = NgramSpec(), *, text_col: str = "text", lang_col: str = "lang") -> Counts:
    """Count n-grams by language over all labelled rows."""
    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    size = 1 << spec.bits

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for name in set(langs):
                counts.setdefault(name, np.zeros(size + 1, np.int64))[size] += int((langs == name).sum())
            for a, b, bucket, of, _ in _ngrams(batch, 0, spec):
                names = langs[a:b]
                for name in set(names):
                    counts[name][:size] += np.bincount(bucket[(names == name)[of]], minlength=size)
        for name, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], ["lang", "bucket", "n"])

    totals = map_arrow(rows, count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    totals = stage_table(totals, "ngrams")
    found = totals.where(F.col("bucket") == size).select("lang", "n").collect()  # one row for each language
    # in the order of Spark's strings, that of their bytes
    return Counts(spec, totals, sorted((r["lang"] for r in found), key=str.encode), sum(r["n"] for r in found))


def _log_likelihood(batch: pa.RecordBatch, at: int, m: Model):
    """(log posterior but for a constant by row and language, letters)."""
    n, width = batch.num_rows, len(m.languages)
    total, letters = np.zeros((n, width)), np.zeros(n, np.int64)
    for a, b, bucket, of, counted in _ngrams(batch, at, m.spec):
        letters[a:b] += counted
        # sparse rows: (text, bucket) entries against the dense matrix
        for j in range(width):
            total[a:b, j] += np.bincount(of, m.log_prob[bucket, j], minlength=b - a)
    return total + m.log_prior, letters


def predict(df: DataFrame, counts: Counts, *, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred and score, the posterior probability of the
    predicted language (of equal ones the first by name).  The text is the
    only input.  Map-only where one block holds all languages; else each
    block scores the texts in turn and the blocks' best languages and sums
    are joined, under a key of two hashes of the text."""
    others = [c for c in df.columns if c not in ("lang_pred", "score")]
    rows = df.select(*[F.col(f"`{c}`") for c in others])
    if len(counts.languages) > BLOCK_LANGUAGES:
        return _predict_by_blocks(rows, counts, text_col)
    (model,) = counts.models()
    sent = df.sparkSession.sparkContext.broadcast(model)
    at = others.index(text_col)

    def score(batches):
        m = sent.value
        width = len(m.languages)
        names = np.array([*m.languages, UNDETERMINED], object)
        for batch in batches:
            n = batch.num_rows
            best, score = np.full(n, width), np.zeros(n)
            if width:
                total, letters = _log_likelihood(batch, at, m)
                rest = np.exp(total - total.max(axis=1, keepdims=True))
                top = total.argmax(axis=1)
                seen = letters > 0
                best = np.where(seen, top, width)
                score = np.where(seen, rest[np.arange(n), top] / rest.sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(score, pa.float64())], [*others, "lang_pred", "score"]
            )

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(rows, score, schema)


KEYS = ("__t1", "__t2")


def _predict_by_blocks(rows: DataFrame, counts: Counts, text_col: str) -> DataFrame:
    spark = rows.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keys = dict(zip(KEYS, (F.xxhash64(text), F.xxhash64(F.lit("second"), text))))
    texts = rows.select(*[k.alias(n) for n, k in keys.items()], text.alias("text"))
    names = [*KEYS, "lang", "top", "total"]
    parts = []
    for model in counts.models():
        sent = spark.sparkContext.broadcast(model)

        def score(batches, sent=sent):
            m = sent.value
            languages = np.array(m.languages, object)
            for batch in batches:
                total, letters = _log_likelihood(batch, 2, m)
                best = total.argmax(axis=1)
                top = total[np.arange(len(best)), best]
                whole = pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(languages[best], pa.string()), pa.array(top), pa.array(np.exp(total - top[:, None]).sum(axis=1))], names
                )
                yield whole.filter(pa.array(letters > 0))

        # written, so that one block's matrix at a time is in memory; equal
        # texts have equal rows
        part = map_arrow(texts, score, "__t1 bigint, __t2 bigint, lang string, top double, total double")
        parts.append(stage_table(part.groupBy(*KEYS).agg(*[F.first(c).alias(c) for c in names[2:]]), "language-block"))
        sent.destroy()
    found = reduce(DataFrame.union, parts).groupBy(*KEYS).agg(F.min(F.struct((-F.col("top")).alias("cost"), "lang")).alias("best"), F.collect_list(F.struct("top", "total")).alias("all"))
    share = F.aggregate("all", F.lit(0.0), lambda acc, x: acc + x["total"] * F.exp(x["top"] + F.col("best.cost")))
    found = stage_table(found.select(*KEYS, F.col("best.lang").alias("__lang"), (1 / share).alias("__score")), "languages")
    joined = rows.withColumns(keys).join(found, list(KEYS), "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce("__lang", F.lit(UNDETERMINED)).alias("lang_pred"), F.coalesce("__score", F.lit(0.0)).alias("score"))


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id as text falls into fold 0.  A null id is
    in no fold and so not held out."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def identify(df: DataFrame, spec: NgramSpec = NgramSpec(), *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn on the rows that are not held out and predict every row:
    ``df`` with held_out, lang_pred and score."""
    counts = learn(df.where(~held_out(F.col(id_col))), spec, text_col=text_col, lang_col=lang_col)
    return predict(df.drop("held_out").withColumn("held_out", held_out(F.col(id_col))), counts, text_col=text_col)
