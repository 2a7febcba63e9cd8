"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For merge-rank BPE each byte prefix of a piece has exactly one encoding, so
it has exactly one possible last token.  ``PrefixTable`` stores that token
for each prefix: a token that ends the prefix is the right one when merging
it together with the token before it gives just these two.  The table grows
by appending bytes, and after an edit only the prefixes near it change.

Texts are split by the tokenizer's pattern and each match is encoded by
itself.  A text that is null is empty; an empty text has no token.  Texts
are read whole, of any length; repeated rows get equal rows.

A task has a codec of its own, which it drops with all that was remembered
when it ends: a Python worker goes on to other operators' tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

KNOWN = 400_000  # entries in one generation of a task's memory
KNOWN_PAIRS = 1_000_000
BLANKS = re.compile(r"^ |\s ").search


class Vocabulary:
    """Merge ranks of a byte-level BPE; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.tokens[i] = b
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}  # by (first id << 20 | second id)
        self._edges: dict[bytes, tuple] = {}

    def merged(self, data: bytes, stop: int = 1) -> list[bytes]:
        """Lowest-rank-first, then leftmost merging of a short byte string,
        until ``stop`` parts are left or nothing merges."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop:
            best, at = min((self.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: bytes) -> tuple:
        """What stands at the left and at the right end of a token while it
        is merged together: (part, rank of the merge that takes it up), the
        last entry being the token itself; None if merging never makes it."""
        known = self._edges.get(token)
        if known is None:
            left, right, whole = [], [], token
            for side, out in ((0, left), (1, right)):
                part, taken = whole, 1 << 40
                while part is not None:
                    out.append((part, taken))
                    halves = self.merged(part, 2) if len(part) > 1 else None
                    if halves is not None and len(halves) > 2:
                        left = right = None
                        break
                    part, taken = (halves[side], self.ranks[part]) if halves else (None, 0)
                if left is None:
                    break
            known = self._edges[token] = (left[::-1], right[::-1]) if left else (None, None)
        return known

    def adjacent(self, a: int, b: int) -> bool:
        """Whether BPE leaves these two tokens side by side (a < 0: whether
        merging makes the second at all).  Ranks only rise while merging, so
        it is enough to walk up both ends in the order of their merges: no
        merge across the border may come before the next one at either end."""
        known = self.pairs.get(a << 20 | b)
        if known is None:
            left = self._edge(self.tokens[a])[1] if a >= 0 else [(b"", 1 << 40)]
            right = self._edge(self.tokens[b])[0]
            known = left is not None and right is not None
            i = j = 0
            while known and a >= 0:
                (x, x_taken), (y, y_taken) = left[i], right[j]
                across = self.ranks.get(x + y, 1 << 41)
                # of equal ranks, the leftmost merges first
                if across < x_taken and across <= y_taken:
                    known = False
                elif x_taken == y_taken == 1 << 40:
                    break
                elif x_taken <= y_taken:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            self.pairs[a << 20 | b] = known
        return known


class PrefixTable:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _entries(self, start: int):
        """(end, last token) of the prefixes longer than ``start``, which
        read the entries before them.  The automaton gives the tokens that
        end at a byte, the longest first."""
        v, last = self.vocabulary, self.last
        pairs, found = v.pairs, start
        base = max(0, start - v.longest + 1)
        for at, (t, n) in v.automaton.iter(self.data[base:].decode("latin-1")):
            end = base + at + 1
            if end > found:
                if end > found + 1:
                    break
                if end - n < base:
                    continue
                before = last[end - n]
                fits = pairs.get(before << 20 | t)
                if fits if fits is not None else v.adjacent(before, t):
                    found = end
                    yield end, t
        if found < len(self.data):
            raise ValueError("the vocabulary lacks a single byte")

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        add = self.last.append
        if start:
            for _, t in self._entries(start):
                add(t)
            return
        last, end, v = self.last, 1, self.vocabulary
        known, adjacent = v.pairs.get, v.adjacent
        for at, (t, n) in v.automaton.iter(more.decode("latin-1")):
            if at < end:
                if at + 1 == end:
                    fits = known(last[end - n] << 20 | t)
                    if fits or fits is None and adjacent(last[end - n], t):
                        add(t)
                        end += 1
            else:
                break
        if end <= len(more):
            raise ValueError("the vocabulary lacks a single byte")

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for data[start:end].  Prefixes before the edit stay;
        behind it the table is rebuilt until as many entries as the longest
        token has bytes agree with the old ones.  Returns how many entries
        were computed."""
        old_last = self.last
        shift = len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old_last[: start + 1]
        agree = done = 0
        entries = self._entries(start)
        for at, t in entries:
            done += 1
            self.last.append(t)
            agree = agree + 1 if at - shift > end and t == old_last[at - shift] else 0
            if agree >= self.vocabulary.longest:
                self.last.extend(old_last[at - shift + 1 :])
                entries.close()
                break
        return done

    def tokens(self) -> list[int]:
        out, end, last, tokens = [], len(self.data), self.last, self.vocabulary.tokens
        while end:
            t = last[end]
            out.append(t)
            end -= len(tokens[t])
        return out[::-1]


class Memory(dict):
    """Remembers a function's values for short strings.  When full, what was
    asked for since the last time stays and the rest goes."""

    def __init__(self, function):
        super().__init__()
        self.function, self.old = function, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= 64:
            if len(self) >= KNOWN:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def _packed(vocabulary: Vocabulary, piece: str) -> bytes:
    data = piece.encode()
    whole = vocabulary.ranks.get(data)
    ids = [whole] if whole is not None else PrefixTable(vocabulary, data).tokens()
    return struct.pack(f"<{len(ids)}I", *ids)


def _packed_word(vocabulary: Vocabulary, split, pieces: Memory, word: str) -> bytes:
    """A word with the space before it; one of a single piece is remembered
    as a word only."""
    parts = split(" " + word)
    return _packed(vocabulary, parts[0]) if len(parts) == 1 else b"".join(map(pieces.__getitem__, parts))


class Codec:
    """Ids are packed as little-endian 32-bit integers while encoding.  No
    part refers back to the codec, so that it goes as soon as it is dropped."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.pieces = Memory(partial(_packed, self.vocabulary))
        self.words = Memory(partial(_packed_word, self.vocabulary, self.split, self.pieces))

    def _text(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; ``numpy.uint32``.  No match of the pattern goes on
        from other characters into a space, so a text without space behind
        white space can be taken word by word, each with the space before."""
        if BLANKS(text):
            return np.frombuffer(self._text(text), "<u4")
        first, *words = text.split(" ")
        return np.frombuffer(self._text(first) + b"".join(map(self.words.__getitem__, words)), "<u4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.asarray(ids).tolist()))

    def append(self, pieces: list[str], more: str) -> list[str]:
        """Pieces of a text with ``more`` behind it.  Only the last pieces
        can change: a match looks at most one character past its end."""
        keep = max(0, len(pieces) - 3)
        return pieces[:keep] + self.split("".join(pieces[keep:]) + more)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def codec(path: str, pattern: str) -> Codec:
    """A new codec; the vocabulary file is installed on each machine."""
    return Codec(read_ranks(path), pattern)


def encode_documents(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, ids): the token ids of each whole text.  Map-only."""

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = [c.encode(t or "") for t in texts]
            ends = np.cumsum([0] + [len(i) for i in ids])
            flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
            column = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), column.cast(pa.list_(pa.int64()))], ["row_id", "text", "ids"])

    rows = df.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))
    kind = rows.schema["row_id"].dataType.simpleString()
    return map_arrow(rows, run, f"row_id {kind}, text string, ids array<bigint>").withColumnRenamed("row_id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text and decode its ids again: (doc_id, n_tokens,
    ids_sha256, decoded_sha256).  Only digests leave a task.  Map-only."""

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            n, a, d = [], [], []
            for i in range(b.num_rows):
                ids = c.encode(b.column(1)[i].as_py() or "")
                n.append(len(ids))
                a.append(hashlib.sha256(ids.tobytes()).hexdigest())
                d.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], ["row_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = df.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))
    kind = rows.schema["row_id"].dataType.simpleString()
    return map_arrow(rows, run, f"row_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("row_id", id_col)
