"""Vector operators against brute force; main text of hand-made pages."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from homeward.llm import hard_negatives, html_text, queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"
SF = "/root/testdata/sf0.001"


def _vectors(n=260, width=8, seed=3):
    """Rows with ties, copies, repeated rows and every kind of bad row."""
    r = random.Random(seed)
    rows = [(i, [round(r.uniform(-1, 1), 2) for _ in range(width)], r.randrange(3)) for i in range(n)]
    hot = [0.5] * width
    rows += [(i, hot, i % 3) for i in range(n, n + 60)]  # one very common vector
    rows += [rows[50], rows[51], (None, rows[7][1], 1), (None, rows[7][1], None)]
    bad = [None, [], [None] + hot[1:], [float("nan")] + hot[1:], [float("inf")] + hot[1:], hot[:3]]
    rows += [(9000 + i, b, 1) for i, b in enumerate(bad)] + [(9100, hot, None)]
    return rows


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def _whole(rows, width=8):
    return [r for r in rows if r[1] is not None and len(r[1]) == width and all(x is not None and np.isfinite(x) for x in r[1])]


def _scaled(rows, scale):
    return np.floor(np.array([r[1] for r in rows], np.float32).astype(np.float64) * scale).astype(np.int64)


def _negatives(rows, every=50, positives=5, negatives=3, window=(50, 95)):
    rows = [r for r in _whole(rows) if r[2] is not None]
    v, ids, labels = _scaled(rows, 256), [r[0] for r in rows], np.array([r[2] for r in rows])
    known = np.array([2**63 - 1 if i is None else i for i in ids])
    out, done = [], set()
    for a in range(len(rows)):
        if ids[a] is None or ids[a] % every or (ids[a], labels[a], v[a].tobytes()) in done:
            continue
        done.add((ids[a], labels[a], v[a].tobytes()))
        s = v @ v[a]
        order = [j for j in np.lexsort((known, -s)) if ids[j] != ids[a]]
        for p in [j for j in order if labels[j] == labels[a]][:positives]:
            fit = [j for j in order if labels[j] != labels[a] and window[0] * s[p] <= 100 * s[j] <= window[1] * s[p]]
            out += [(ids[a], ids[p], k + 1, ids[j], int(s[p]), int(s[j])) for k, j in enumerate(fit[:negatives])]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"block": 16, "group": 2}], ids=["one_block", "small_blocks"])
def test_hard_negatives_equal_brute_force(spark, sizes):
    rows = _vectors()
    got = hard_negatives.mine(_table(spark, rows), every=10, **sizes).collect()
    assert sorted(map(tuple, got), key=str) == _negatives(rows, every=10)


def test_hard_negatives_query(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = [r[0] for r in rows]
    assert len(want) == 500
    v, labels = _scaled(rows, 256), np.array([r[2] for r in rows])
    got = defaultdict(list)
    for r in queries.op11_hard_negatives(spark, SF).collect():
        got[r.anchor_id, r.positive_id].append((r["rank"], r.negative_id, r.positive_score, r.negative_score))
    ids = np.array(want)
    for a in np.flatnonzero(ids % 50 == 0):
        s = v @ v[a]
        order = np.lexsort((ids, -s))
        for p in [j for j in order if labels[j] == labels[a] and j != a][:5]:
            fit = [j for j in order if labels[j] != labels[a] and 50 * s[p] <= 100 * s[j] <= 95 * s[p]][:3]
            assert sorted(got.pop((ids[a], ids[p]), [])) == [(k + 1, ids[j], s[p], s[j]) for k, j in enumerate(fit)]
    assert not got


def test_blocks_are_chosen_by_their_zone_maps(spark):
    """Two far clusters: an anchor of one reads no block of the other."""
    r = random.Random(1)
    rows = [(i, [r.uniform(0.9, 1), 0.0, 0.0, 0.0] if i % 2 else [0.0, 0.0, r.uniform(0.9, 1), 0.0], i % 2) for i in range(400)]
    whole = hard_negatives.whole_vectors(_table(spark, rows), "vec_id", "embedding", "label")
    blocks = hard_negatives.blocks_of(whole, size=32)
    assert blocks.agg(F.sum("size")).first()[0] == 400
    members = hard_negatives.groups_of(hard_negatives.anchors_of(blocks, 50, 5))
    none = F.lit(np.array([-(2**61), 2**62], "<i8").tobytes())
    seeded = F.transform("members", lambda m: F.struct(m["anchor_id"].alias("anchor_id"), m["label"].alias("label"), m["v"].alias("v"), m["bound"].alias("lowest"), F.lit(2**62).alias("highest"), none.alias("windows")))
    zones = blocks.groupBy(F.lit(0).alias("stripe")).agg(F.collect_list(F.struct("block", "low", "high")).alias("zones"))
    chosen = hard_negatives._choose(members.select("g", seeded.alias("members"), F.lit(0).alias("stripe")), zones)
    assert 0 < chosen.agg(F.sum("size")).first()[0] < 0.8 * 8 * blocks.count()


def test_hilbert_curve_visits_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    place = hard_negatives.hilbert(cells, 3)
    assert sorted(place) == list(range(side**3))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def _codes(rows):
    rows = _whole(rows)
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, list(np.float32(r[1])), r[2] is not None, r[2] or 0))
    v = _scaled(rows, 1024)
    width, out, books, error = v.shape[1] // 4, [[] for _ in rows], [], np.zeros(len(rows), np.int64)
    for p in range(4):
        part = v[:, p * width : (p + 1) * width]
        book = part[:256].copy()

        def assign():
            d = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
            return d.argmin(axis=1), d.min(axis=1)

        for _ in range(4):
            near, _far = assign()
            for e in set(near.tolist()):
                mine = part[near == e]
                book[e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
        near, far = assign()
        error += far
        books.append(book)
        for o, e in zip(out, near):
            o.append(f"{e:02x}")
    by_label = defaultdict(int)
    for r, e in zip(rows, error):
        by_label[r[2]] += int(e)
    sha = hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()
    return sorted([(r[0], "".join(o), int(e), by_label[r[2]], sha) for r, o, e in zip(rows, out, error)], key=str)


@pytest.mark.parametrize("n", [40, 420])
def test_vector_codes_equal_brute_force(spark, n):
    rows = _vectors(n)
    got = vector_codes.compress(_table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == _codes(rows)


def test_trie_distances():
    r = np.random.default_rng(5)
    points = r.integers(-3, 4, (20_000, 5))  # few values: long common prefixes
    points[:50] = points[0]
    leaves, weights, leaf = vector_codes.leaves(points)
    assert weights.sum() == len(points) and (leaves[leaf] == points).all()
    book = r.integers(-3, 4, (17, 5))
    entry, distance = vector_codes.nearest(leaves, book)
    all_pairs = ((leaves[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == all_pairs.argmin(axis=1)).all() and (distance == all_pairs.min(axis=1)).all()
    assert vector_codes.cuts(10, 4) == [(0, 3), (3, 6), (6, 8), (8, 10)]


@pytest.mark.parametrize("operator", [hard_negatives.mine, vector_codes.compress])
def test_empty_tables_and_clashing_columns(spark, operator):
    schema = operator(_table(spark, _vectors(30))).schema
    for rows in ([], [(1, None, 2), (2, [None], 1)]):
        empty = operator(spark.createDataFrame(rows, SCHEMA))
        assert empty.count() == 0 and empty.schema.names == schema.names
    plain = _table(spark, _vectors(120))
    names = ("vector", "v", "block", "place", "g", "stripe", "size", "code", "error", "label_error", "rank", "_salt", "id", "score")
    extra = plain.select("*", *[F.lit("x").alias(c) for c in names])
    assert sorted(map(str, operator(extra).collect())) == sorted(map(str, operator(plain).collect()))


# ---- main text -------------------------------------------------------------

LONG_A = "The river that runs through the old town was for a long time the only road that the traders had, and it is still the heart of the place where most of the people of the valley live and work today."
LONG_B = "It was in the spring of that year that the council decided to build a second bridge, which would be wide enough for carts and for the cattle that came down from the hills with the first snow."


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head><body>
    <header><p>{LONG_B}</p></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">{LONG_A}</div>
    <article><header><h1>Old &amp; new</h1></header><p><b>{LONG_A}<br><p>Short.</p><!-- x --><p>a&nbsp;b
    &lt;c&gt; &#233;</p><div class="ad">{LONG_B}</div><form><p>{LONG_A}</p></form><p>{LONG_B}</p><p>Ends here</p>
    <section id="comments"><p>{LONG_A}</p></section></article><aside><p>{LONG_B}</p></aside><footer>&copy; {LONG_A}</footer>"""
    assert html_text.main_text(page).split("\n") == ["Old & new", LONG_A, "Short.", "a b <c> é", LONG_B, "Ends here"]


def test_blocks_without_an_article_element():
    links = "".join(f'<a href="/{i}">Section number {i} of the site</a> | ' for i in range(9))
    page = f"""<body><div>{links}</div><h2>A heading</h2><div>{LONG_A} {LONG_B}</div><p>Yes.</p><div>{LONG_B} {LONG_A}</div>
    <p>Last words of it.</p><div>{links}</div><p>Imprint</p><ul class="share-buttons"><li>Send</li></ul></body>"""
    got = html_text.main_text(page).split("\n")
    assert got == ["A heading", f"{LONG_A} {LONG_B}", "Yes.", f"{LONG_B} {LONG_A}", "Last words of it."]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("no markup", "no markup"),
        ("a < b and c > d", "a < b and c > d"),
        ("<p>one<p>two", "one\ntwo"),
        ("<p>x<br>y<br><br>z", "x y\nz"),
        ("<p title='a>b'>q</p>", "q"),
        ("<p title=\"open>q</p><p>r</p>", "q\nr"),
        ("<script>never closed <p>x</p>", ""),
        ("<!-- never closed <p>x</p>", ""),
        ("<p>a</b></i></div>b</p>", "a\nb"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("<main>&amp;amp; &copy &#x1F600; &bogus;", "&amp; © 😀 &bogus;"),
        ("<P CLASS=x>Up</P><BR/><SCRIPT>no</SCRIPT >", "Up"),
        ("<textarea><p>no</p></textarea><p>yes", "yes"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_pages_take_linear_time():
    import time

    for piece in ("<div>", "<a ", '<a "', "<", "</p>", "<p>x", "<!--", "&amp;", "<br>", "<b><p>"):
        start = time.perf_counter()
        html_text.main_text(piece * 200_000)
        assert time.perf_counter() - start < 20, piece


def test_pages_table(spark):
    rows = [(1, "u", "<article><h1>T</h1><p>x</p></article>"), (1, "u", "<article><h1>T</h1><p>x</p></article>"), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit("z").alias(c) for c in ("text", "n_chars", "label")])
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "T\nx", 3), (1, "u", "T\nx", 3), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_whole_articles_of_the_table(spark):
    """Every page's article element, block by block."""
    import re
    from html import unescape

    got = {r.page_id: r for r in queries.op13_html_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page.html, re.S).group(1)
        cut = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert got[page.page_id].text == "\n".join(b for b in cut if b) and got[page.page_id].n_chars == len(got[page.page_id].text)
