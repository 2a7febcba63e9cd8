"""Language id, BPE codec and WARC archives."""

import base64
import gzip
import hashlib
import random

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from homeward.llm import byte_bpe, language_id, queries, warc

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODEC = byte_bpe.codec(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})
TEXT = st.text(alphabet=st.one_of(st.sampled_from("ab'srte \t\n\r\x1c\x85\xa0é中😀01½!\u2028\ufeff"), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_encoding_is_the_librarys(text):
    ids = CODEC.encode(text)
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(TEXT, TEXT)
def test_append_to_pieces(text, more):
    assert CODEC.append(CODEC.split(text), more) == CODEC.split(text + more)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=20), st.integers(0, 60), st.integers(0, 60))
def test_prefix_table_edits(data, new, a, b):
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    table = byte_bpe.PrefixTable(CODEC.vocabulary, data[:a])
    table.append(data[a:])
    assert table.last == byte_bpe.PrefixTable(CODEC.vocabulary, data).last
    table.replace(a, b, new)
    edited = data[:a] + new + data[b:]
    assert table.data == edited and table.last == byte_bpe.PrefixTable(CODEC.vocabulary, edited).last
    if edited:
        assert [CODEC.vocabulary.tokens[t] for t in table.tokens()] == CODEC.vocabulary.merged(edited)


def test_edits_stay_local():
    table = byte_bpe.PrefixTable(CODEC.vocabulary, b"the quick brown fox " * 200)
    assert table.replace(1000, 1003, b"cat") < 400


def test_memory_keeps_values(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 50)
    small = byte_bpe.Codec(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = " ".join(cases.words(3, 3000, 500))
    assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_documents_round_trip(spark):
    df = cases.clashing(cases.table(spark))
    got = byte_bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for i, text, _ in cases.documents():
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    lists = byte_bpe.encode_documents(df, PATH, public_tokenizers.PATTERN).where("doc_id = 5").first()
    assert lists.ids == LIBRARY.encode_ordinary("one two three four")
    assert byte_bpe.round_trip(cases.empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_a_dropped_codec_goes_at_once():
    """Without the collector of cycles, which a busy worker rarely runs."""
    import gc
    import weakref

    gc.collect()
    gc.disable()
    try:
        own = byte_bpe.codec(PATH, public_tokenizers.PATTERN)
        text = " ".join(cases.words(4, 3000, 500)) + " it's, (one) 12:30"
        assert own.encode(text).tolist() == LIBRARY.encode_ordinary(text)
        left = [weakref.ref(x) for x in (own, own.vocabulary)]
        del own
        assert [x() for x in left] == [None, None]
    finally:
        gc.enable()


def test_workers_keep_no_codec(spark):
    import pyarrow as pa

    assert byte_bpe.round_trip(cases.table(spark), PATH, public_tokenizers.PATTERN).count()

    def kept(batches):
        import gc
        import sys

        for _ in batches:
            pass
        module = sys.modules.get("homeward.llm.byte_bpe")
        n = sum(type(x).__name__ == "Codec" and type(x).__module__ == module.__name__ for x in gc.get_objects()) if module else 0
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    rows = spark.range(0, 64, 1, 16).mapInArrow(kept, "n bigint").collect()
    assert len(rows) == 16 and not any(r.n for r in rows)


def test_language_of_held_out_texts(spark, sf_dir):
    rows = queries.op1_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert rows.count() == rows.select("doc_id").distinct().count() == 200
    held = rows.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_language_edges(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["the", "and", "house"] if i % 2 else ["der", "und", "haus"]) for _ in range(30)), "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 !?", "en"), (103, "THE House", None), (104, "the house. " * 120_000, None), (None, "und der", None), (103, "THE House", None)]
    df = cases.clashing(cases.table(spark, rows)).withColumn("held_out", F.lit("x"))
    got = language_id.identify(df).collect()
    by = {x.doc_id: (x.lang_pred, x.held_out) for x in got}
    assert len(got) == len(rows)
    assert by[100][0] == by[101][0] == by[102][0] == "und" and by[103][0] == by[104][0] == "en" and by[None] == ("de", False)
    import zlib

    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got if x.doc_id is not None)
    assert all(0 <= x.score <= 1 for x in got)
    none = language_id.identify(cases.table(spark, [(1, "text", None)])).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)
    assert language_id.identify(cases.empty(spark)).count() == 0


def test_more_languages_than_a_block_holds(spark, monkeypatch):
    r = random.Random(8)
    vocabulary = {f"l{k}": ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(4)] for k in range(7)}
    rows = [(i, " ".join(r.choices(vocabulary[f"l{i % 7}"], k=5)), f"l{i % 7}") for i in range(70)]
    # equal scores in two blocks, texts without letters, equal texts
    rows += [(200, "zzz yyy", "l8"), (201, "zzz yyy", "l9"), (202, "zzz yyy", None), (203, "1 2", None), (204, None, None), (202, "zzz yyy", None), (None, "", None)]
    df = cases.clashing(cases.table(spark, rows))
    counts = language_id.learn(df)

    def answers():
        found = language_id.predict(df, counts)
        assert found.columns == [*[c for c in df.columns if c not in ("lang_pred", "score")], "lang_pred", "score"]
        return sorted(((str(x.doc_id), x.lang_pred, round(x.score, 9)) for x in found.collect()))

    whole = answers()
    assert len(whole) == len(rows)
    # two languages share the text, the first by name is taken; the others
    # have what smoothing leaves
    assert {(b, 0 < c <= 0.5) for a, b, c in whole if a in ("200", "201", "202")} == {("l8", True)}
    for block in (1, 4):
        monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", block)
        assert all(len(m.languages) <= block for m in counts.models())
        assert answers() == whole


def test_pieces_of_long_texts_count_the_same(spark, monkeypatch):
    import pyarrow as pa

    text = "The café und so weiter, ñandú! " * 400
    spec = language_id.NgramSpec()
    whole = np.zeros(1 << spec.bits, int)
    parts = np.zeros(1 << spec.bits, int)
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
    for size, out in ((1 << 20, whole), (1000, parts)):
        monkeypatch.setattr(language_id, "SLICE_BYTES", size)
        for _, _, data, offsets in language_id._pieces(batch, 0):
            bucket, _ = language_id._buckets(*language_id._folded(data, offsets)[:2], spec)
            out += np.bincount(bucket, minlength=len(out))
    assert abs(whole - parts).sum() < 0.01 * whole.sum()


def test_ngrams_do_not_depend_on_the_texts_beside():
    import pyarrow as pa

    spec = language_id.NgramSpec()
    texts = ["abc de", "", "zzz yyy", " zzz  yyy. ", "1 2", "q", "", "é"]

    def counts(values):
        out = [[] for _ in values]
        for a, _, bucket, of, _ in language_id._ngrams(pa.RecordBatch.from_arrays([pa.array(values)], ["text"]), 0, spec):
            for b, t in zip(bucket.tolist(), of.tolist()):
                out[a + t].append(b)
        return [sorted(x) for x in out]

    together = counts(texts)
    assert together == [counts([t])[0] for t in texts] and together[2] == together[3]
    assert [len(x) for x in together] == [18, 0, 21, 21, 0, 4, 0, 4]


def test_slices_of_many_texts_are_small():
    """A worker's memory follows the slice, of which a batch may have many."""
    import pyarrow as pa

    spec = language_id.NgramSpec()
    texts = [" ".join(cases.words(i, 1500, 300)) for i in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    assert batch.nbytes > 3 * (1 << 18)
    assert max(int(offsets[-1]) for _, _, _, offsets in language_id._pieces(batch, 0)) <= 1 << 18
    got = sum(np.bincount(x[2], minlength=1 << spec.bits) for x in language_id._ngrams(batch, 0, spec))
    want = sum(np.bincount(x[2], minlength=1 << spec.bits) for t in texts for x in language_id._ngrams(pa.RecordBatch.from_arrays([pa.array([t])], ["text"]), 0, spec))
    assert (got == want).all()


def test_ngrams_across_cuts(spark):
    # cuts inside words, in a run of spaces, and between letters of two bytes
    cut = language_id.SLICE_BYTES
    text = "é" * (cut // 2 + 3) + "xyz" * (cut // 3 - 7) + " , " * 9 + "abc" * (cut // 3) + " end"
    spec = language_id.NgramSpec()
    data = np.frombuffer(text.encode(), np.uint8)
    assert len(data) > 2 * cut
    bucket, _ = language_id._buckets(*language_id._folded(data, np.array([0, len(data)]))[:2], spec)
    want = np.bincount(bucket, minlength=1 << spec.bits) + spec.smoothing
    model = next(language_id.learn(cases.table(spark, [(1, text, "x")]), spec).models())
    assert (np.rint(np.exp(model.log_prob[:, 0]) * want.sum() - spec.smoothing) == want - spec.smoothing).all()


@pytest.mark.parametrize("size", [1, 2, 7, 50])
def test_ngrams_of_any_pieces(monkeypatch, size):
    import pyarrow as pa

    texts = ["The café  und so weiter, ñandú! " * 9, "", "  ", "one", "a  b , c 中文 " * 20, None]
    for spec in (language_id.NgramSpec(), language_id.NgramSpec(orders=(1,)), language_id.NgramSpec(orders=(2, 5))):
        for text in texts:
            batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
            counts = []
            for most in (1 << 20, size):
                monkeypatch.setattr(language_id, "SLICE_BYTES", most)
                found = list(language_id._ngrams(batch, 0, spec))
                counts.append((sum(np.bincount(x[2], minlength=1 << spec.bits) for x in found).tolist(), sum(int(x[4].sum()) for x in found)))
            assert counts[0] == counts[1]


PAGES = [
    (1, "http://b.example.com/x", "<p>one</p>"),
    (2, "http://a.example.com/x", "<p>one</p>"),
    (3, None, None),
    (4, "http://a.example.com/y\r\nX: y", ""),
    (5, "no scheme", "line\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "http://a.example.com/x", "é" * 100_000),
    (6, "http://a.example.com/x", "é" * 100_000),
    (7, "http://a.example.com/z", "é" * 100_000),
    (None, "http://a.example.com/q", "<p>one</p>"),
    (None, "http://a.example.com/q", "alone"),
]


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x", "x") for p in PAGES], "page_id long, url string, html string, record string, sha1 string").repartition(3)
    folder = str(tmp_path / "archives")
    got = warc.archive_and_index(pages, folder)
    rows = got.collect()
    last = {}
    for i, _, html in PAGES:
        last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        main = last[html or ""] if last[html or ""] >= 0 else None
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == main else "revisit", None if i == main else main))
    assert sorted((tuple(r[2:7]) for r in rows), key=str) == sorted(want, key=str)
    # the global order, and records found again by their place
    keys = [warc._order(tuple(r)) for r in rows]
    assert keys == sorted(keys)
    for r in rows:
        data = gzip.open(f"{folder}/{r.run}").read()
        headers, block, place, size = next(warc.parse_archive(data[r.place : r.place + r["size"]]))
        assert headers["WARC-Type"] == r.record_type and headers["WARC-Payload-Digest"] == f"sha1:{r.payload_digest}"
    assert warc.archive_and_index(pages.limit(0)).count() == 0
    small = warc.archive_and_index(pages, least_bytes=1000)
    assert small.where("record_type = 'revisit'").count() == 2


def test_archives_are_read_as_streams(spark, tmp_path, monkeypatch):
    # line ends at the end and in the middle of payloads, over buffers and batches
    texts = ["\r\n" * 70_000, "\n" * 30_000, "a\r\n\r\n", "\r", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "x" * 3_000_000, "", "é\n" * 20_000, "".join(random.Random(3).choices("abcdefgh", k=50_000))]
    pages = spark.createDataFrame([(i, f"http://a.example.com/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    folder = str(tmp_path / "archives")
    warc.write_archives(pages.coalesce(2), folder)
    whole = warc.map_arrow
    sent = []
    monkeypatch.setattr(warc, "map_arrow", lambda df, *rest: sent.append(df) or whole(df, *rest))
    rows = warc.capture_runs(spark, folder).collect()
    # no archive, page or long line is a value of one row
    assert max(sent[0].agg(*[F.max(F.octet_length(c)) for c in sent[0].columns]).first()) <= 4096
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in rows) == [(i, len(t.encode()), base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()) for i, t in enumerate(texts)]
    for r in rows:
        headers, block, _, size = next(warc.parse_archive(gzip.open(f"{folder}/{r.run}").read()[r.place : r.place + r["size"]]))
        assert size == r["size"] and block.endswith(texts[r.page_id].encode())


@given(st.lists(st.lists(st.integers(0, 30), max_size=12), max_size=7))
def test_loser_tree(runs):
    merged = list(warc.LoserTree([[(x,) for x in sorted(r)] for r in runs], lambda row: row))
    assert merged == sorted((x,) for r in runs for x in r)


@pytest.mark.parametrize("value", [b"", b"a", b"WARC" * 99])
def test_base32(spark, value):
    got = spark.createDataFrame([(bytearray(value),)], "x binary").select(warc.base32(F.sha1("x"))).first()[0]
    assert got == base64.b32encode(hashlib.sha1(value).digest()).decode()
