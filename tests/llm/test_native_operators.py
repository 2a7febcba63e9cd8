"""URL filter, quality rules and personal data against plain Python."""

import hashlib

import brute
import cases
import pytest
from pyspark.sql import functions as F

from homeward.llm import personal_data, quality_rules, queries, url_filter


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.fixture(scope="module")
def docs(spark):
    return cases.table(spark).cache()


def test_quality_measurements(docs):
    entries = quality_rules.ledger(cases.clashing(docs)).select("doc_id", *quality_rules.MEASUREMENTS, "failures")
    assert no_python(entries)
    got = sorted((tuple(r) for r in entries.collect()), key=str)
    want = []
    for i, text, _ in cases.documents():
        b = brute.quality(text)
        lines = sum(bool(brute.WORD.search(x)) for x in (text or "").split("\n"))
        row = (b["n_words"], b["word_chars"], b["n_symbols"], lines, b["n_dup_lines"], b["n_repeat_words"])
        names = dict(zip(quality_rules.MEASUREMENTS, row))
        failures = sum(1 << k for k, r in enumerate(quality_rules.RULES) if eval(r.fails, {}, names))
        want.append((i, *row, failures))
    assert got == sorted(want, key=str)


def test_policies_and_ablation(spark):
    rows = [(0, 0), (1, 1), (2, 3), (3, 8), (4, 8)]
    entries = spark.createDataFrame(rows, "doc_id long, failures long")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_policy(entries, "base").collect()}
    assert kept == {0: True, 1: False, 2: False, 3: True, 4: True}
    found = {r["rule"]: (r.n_failed, r.n_only) for r in quality_rules.ablation(entries, "v2").collect()}
    assert found["few_words"] == (2, 1) and found["repeated_windows"] == (1, 0) and found["repeated_lines"] == (2, 2)
    both = quality_rules.failed_anywhere(entries.withColumn("g", F.lit(1)), "g", "v2").first()
    assert (both.any_failed, both.all_failed, both.n_texts) == (11, 0, 5)


def test_quality_of_empty_table(spark):
    assert quality_rules.apply_policy(quality_rules.ledger(cases.empty(spark))).count() == 0
    assert quality_rules.ablation(quality_rules.ledger(cases.empty(spark))).count() == len(quality_rules.RULES)


def test_personal_data_spans(docs):
    found = personal_data.report(cases.clashing(docs))
    assert no_python(found)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in found.collect())
    want = []
    for i, text, _ in cases.documents():
        spans = brute.base_spans(text)
        want.append((i is None, i or 0, hashlib.sha256(",".join(spans).encode()).hexdigest(), len(spans)))
    assert got == sorted(want)
    spans = {r.doc_id: r.spans for r in found.collect()}
    assert spans[1] == spans[2] == "" and "iban:5:27" in spans[18] and spans[18].count("iban") == 1 and "ssn" in spans[18]


@pytest.mark.parametrize("seed", range(4))
def test_personal_data_on_random_text(spark, seed):
    import random

    r = random.Random(seed)
    rows = [(i, "".join(r.choice("a@.+-1 2(9)_b%4\ue000\n") for _ in range(r.randrange(120))), None) for i in range(600)]
    rows += [(1000 + i, "".join(r.choice("4 -") if r.random() < 0.3 else str(r.randrange(10)) for _ in range(60)), None) for i in range(400)]
    got = {x.doc_id: x.base_sha256 for x in personal_data.report(cases.table(spark, rows)).collect()}
    for i, text, _ in rows:
        assert got[i] == hashlib.sha256(",".join(brute.base_spans(text)).encode()).hexdigest(), text


def test_redaction(docs, spark):
    got = {r.doc_id: r.text for r in personal_data.redact(cases.clashing(docs)).collect()}
    assert got[16] == "mail <EMAIL>, or x@<EMAIL>; call <PHONE> now"
    assert got[17].startswith("card <CARD> and 4111-1111-1111-1112 at <IP> 10.0.0.256 <IP>.<IP>")
    assert got[1] is None and got[2] == "" and got[6] == " ".join(cases.words(1, 300))
    assert personal_data.redact(cases.empty(spark)).count() == 0
    assert personal_data.redact(cases.clashing(docs)).columns == [c for c in cases.clashing(docs).columns if c != "spans"]


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.EXAMPLE.ORG/en/1", "x://example.org/es/", "x://example.org/en/12?q=/es/", "x://sub.example.org/es/a#b",
    "x://notexample.org/es/a", "x://org/", "x://org", "x://com/fr/a", "x://a.com/de/", "x://a.com/de", "a://b://c/d", "x://É.COM/fr/", "x://h?://y/z", "x://" + "a" * 50_000 + ".com/de/" + "b" * 50_000,
]


def test_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(4, URLS[4], "x"), (None, URLS[5], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.judge(pages, queries.URL_RULES, ([0.0] * 4096, -1.0))
    assert no_python(got)
    rules = [(r.host, r.path, r.verdict) for r in queries.URL_RULES]
    for r in got.collect():
        host, path = brute.split_url(r.url)
        rule, verdict = brute.url_rule(host, path, rules)
        assert (r.host, r.path, r["rule"], r.verdict) == (host, path, rule, verdict or "allow")


def test_url_model(spark):
    labelled = url_filter.labelled_urls(spark)
    assert no_python(labelled)
    model = url_filter.train(labelled)
    assert no_python(url_filter.judge(labelled, [], model))
    right = url_filter.judge(labelled, [], model).where((F.col("verdict") == "block") == (F.col("label") == 1)).count()
    assert right >= 0.97 * labelled.count()
    new = spark.createDataFrame([(u,) for u in ("http://cdn.spam-farm.example.net/x", "http://www.ads-track.example.com/fr/9", "http://quietpond.example.org/en/5")], "url string")
    assert [r.verdict for r in url_filter.judge(new, [], model).collect()] == ["block", "block", "allow"]
    weights, bias = url_filter.train(labelled.limit(0))
    assert not any(weights) and bias == 0.0


# labelled by hand, with words that the label table does not have
OTHER_UNWANTED = (
    "texas-holdem", "baccarat-live", "scratchcards", "wager-king", "penny-auctions", "tramadol-rx", "xanax-overnight", "hair-loss-cure", "anabolic-shop", "kamagra",
    "milf-tube", "erotic-chat", "stripper-jobs", "swingers", "fetish-zone", "instant-loan", "bitcoin-giveaway", "pyramid-scheme", "binary-options", "ponzi-profits",
    "pop-up-adverts", "clickfraud", "adsense-hack", "pixel-beacon", "spyware", "trojan-setup", "ransom-locker", "scam-alerts", "bank-login-confirm", "nigerian-prince",
    "pirated-dvds", "nulled-scripts", "game-cheats", "fake-passports", "counterfeit-bags", "term-paper-mill", "buy-followers", "mass-mailer", "cheap-cigarettes", "free-ringtones",
)
OTHER_WANTED = (
    "kindergarten", "academy", "botany-society", "cathedral", "village-hall", "lighthouse", "symphony", "sculpture", "ceramics", "ballet",
    "observatory", "zoology", "economics", "linguistics", "grammar", "translation", "newspaper", "broadcasting", "chronicle", "letters",
    "fire-brigade", "mayor", "tax-office", "post-office", "veterinary", "nursing", "pharmacology", "physiotherapy", "airport", "ferry",
    "camping", "hiking-trails", "swimming", "tennis", "beekeeping", "vineyard", "orchard", "pottery", "robotics", "open-source",
)


def other_urls(spark):
    rows = [(f"http://{('', 'www.', 'm.', 'blog.')[i % 4]}{h}.{('com', 'net', 'org')[i % 3]}/{('', 'en/7', 'about.html')[i % 3]}", y) for y, hosts in ((1, OTHER_UNWANTED), (0, OTHER_WANTED)) for i, h in enumerate(hosts)]
    return spark.createDataFrame(rows, "url string, label int")


def test_url_model_on_other_words(spark):
    assert not {*OTHER_UNWANTED, *OTHER_WANTED} & {*url_filter.UNWANTED, *url_filter.WANTED}
    got = url_filter.judge(other_urls(spark), [], url_filter.train(url_filter.labelled_urls(spark)))
    blocked = {r.label: r.n for r in got.where("verdict = 'block'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    # 19 and 7 when this was written
    assert blocked[1] >= 18 and blocked.get(0, 0) <= 8


def test_label_table_is_not_of_the_pages(spark, sf_dir):
    pages = {h for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("url").collect() for h in brute.split_url(r.url)[0].split(".")}
    assert not pages & {*url_filter.UNWANTED, *url_filter.WANTED}


def test_many_spans_of_one_text(spark):
    """Positions past several levels of running sums and many pieces of the
    text, with gaps shorter than the context and longer than a piece."""
    import random

    r = random.Random(5)
    parts = []
    for i in range(6000):
        parts.append(r.choice([f"mail x{i}@host{i % 7}.org", f"+49 30 {1000000 + i}", "4111 1111 1111 1111", f"10.{i % 256}.0.{i % 300}", "ä\U0001f600 " * r.choice([0, 1, 200]), "a.b@c.d x@y.z"]))
    text = r.choice([" ", ", "]).join(parts)
    rows = [(1, text, None), (2, "x@y.z " * 40000, None), (3, "", None)]
    found = {x.doc_id: x for x in personal_data.report(cases.table(spark, rows)).collect()}
    for i, t, _ in rows:
        spans = brute.base_spans(t)
        assert found[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert found[2].n_email == 40000
    redacted = {x.doc_id: x.text for x in personal_data.redact(cases.table(spark, rows)).collect()}
    assert redacted[2] == "<EMAIL> " * 40000 and redacted[3] == ""
    spans = [s.split(":") for s in found[1].spans.split(",")]
    at, want = 0, []
    for kind, start, end in ((k, int(a), int(b)) for k, a, b in spans):
        if start >= at:
            want += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    assert redacted[1] == "".join(want) + text[at:]
