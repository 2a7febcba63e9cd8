"""URL filter: host and path rules, and logistic regression on hashed
character n-grams of host and path for the URLs that no rule fits.

The model is trained from a small labelled table by gradient descent whose
steps are DataFrame aggregations; its weights (``2**bits`` numbers, a fixed
size) then stand as a literal in the scoring expression.  DataFrame
functions only, map-only over the pages.

A null URL, or one without ``://``, has an empty host and path, fits no
rule and is allowed (score 0).  Repeated rows get equal rows.  Of rules that
fit, the longest wins, and of equally long ones a block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import let, same_shape, tail

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_RULES = 2000  # rules stand in the expression


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The labelled table, from general knowledge of what block lists and link
# directories hold; none of it is read from a pages table.  Both kinds have
# hyphens, common suffixes and neutral paths, so that none of these decides.
UNWANTED = (
    # gambling
    "casino", "poker-room", "online-roulette", "blackjack21", "jackpot-city", "lottery-results", "sportsbetting", "bookmaker", "slot-machines", "bingo-bonus",
    # medicines and cures
    "buy-viagra", "cialis-online", "discountpharmacy", "diet-pills", "weightloss-miracle", "steroids4u", "no-prescription-meds", "male-enhancement",
    # sex
    "porn", "freeporn-videos", "xxx-movies", "sexcams", "adult-dating", "escort-girls", "nude-pics", "hookup-tonight", "hot-singles", "webcam-girls",
    # money
    "payday-loans", "quick-cash", "easymoney", "earn-from-home", "get-rich-fast", "crypto-doubler", "forex-signals", "debt-relief-now", "free-giftcards", "claim-your-prize",
    # advertisements and tracking
    "adserver", "adclick", "banner-ads", "popunder", "ads-network", "tracker", "tracking-pixel", "doubleclicks", "affiliate-offers", "traffic-exchange",
    # spam and fraud
    "spam", "spammers", "bulk-email", "link-farm", "cheap-backlinks", "clickbait", "phishing", "verify-account", "login-secure-update", "malware-download", "fake-id", "survey-rewards",
    # copies without right
    "warez", "keygen", "serial-crack", "cracked-games", "torrent-download", "free-movie-stream", "replica-watches", "knockoff-handbags", "cheap-rolex", "essay-writers",
)
WANTED = (
    # learning
    "library", "city-library", "university", "state-university", "school", "primary-school", "college", "mathematics", "physics-notes", "encyclopedia", "dictionary", "open-courses", "chemistry", "biology", "philosophy",
    # news and writing
    "times", "daily-news", "gazette", "journal", "magazine", "evening-post", "tribune", "herald", "bookreview", "poetry", "publisher", "press", "radio", "editorial",
    # state and society
    "government", "parliament", "city-council", "ministry", "court", "embassy", "police", "red-cross", "charity", "foundation", "institute", "weather-service", "statistics", "national-parks",
    # culture
    "museum", "art-gallery", "theatre", "orchestra", "opera-house", "cinema", "heritage", "archive", "history", "archaeology", "folk-music", "choir",
    # daily life
    "recipes", "home-cooking", "bakery", "garden", "plants", "hospital", "family-doctor", "dentist", "travel", "railway", "bus-timetable", "hotel", "mountain-huts", "football-club", "cycling", "chess", "knitting", "woodwork", "birdwatching", "fishing", "sailing",
    # work and technology
    "software", "developers", "linux-users", "database", "programming", "engineering", "electronics", "architect", "insurance", "bank", "farmers-market", "bookshop", "furniture", "carpenter", "nature", "river-trust", "astronomy", "geology", "green-energy", "climate",
)
SUFFIXES = ("com", "net", "org", "info", "co.uk", "de", "example.com", "example.net", "example.org")
PREFIXES = ("", "www.", "m.", "blog.", "shop.", "en.")
NEUTRAL_PATHS = ("", "/", "/index.html", "/page/2", "/en/1", "/fr/20.html", "/de/300/", "/2021/05/17/post.html", "/about", "/item?id=7")
UNWANTED_PATHS = ("/buy-now/cheap", "/win/free-bonus", "/click/offer/99", "/xxx/videos/1", "/download/crack.exe")
WANTED_PATHS = ("/articles/history-of-science", "/wiki/Main_Page", "/docs/guide/install.html", "/events/opening-hours", "/research/papers/2019.pdf")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): four URLs of each host above, three of them with a
    neutral path; 1 is unwanted."""
    rows = []
    for label, hosts, paths in ((1, UNWANTED, UNWANTED_PATHS), (0, WANTED, WANTED_PATHS)):
        for i, host in enumerate(hosts):
            for j in range(4):
                path = paths[i % len(paths)] if j == 3 else NEUTRAL_PATHS[(3 * i + j) % len(NEUTRAL_PATHS)]
                rows.append((f"http://{PREFIXES[(i + j) % len(PREFIXES)]}{host}.{SUFFIXES[(i + 2 * j) % len(SUFFIXES)]}{path}", label))
    # one partition, so that the steps of training need no shuffle
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])))


@dataclass(frozen=True)
class LinearSpec:
    bits: int = 12
    orders: tuple[int, ...] = (3, 4)
    steps: int = 24
    rate: float = 0.5
    decay: float = 0.0005


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host with A-Z lower-cased."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _grams(value: Column, spec: LinearSpec, salt: int) -> Column:
    """Buckets of the character n-grams of one part, both ends marked."""

    def buckets(chars: Column) -> Column:
        def of_order(k: int) -> Column:
            shifted = F.arrays_zip(*[tail(chars, j).alias(f"c{j}") for j in range(k)])
            whole = F.filter(shifted, lambda z: z[f"c{k - 1}"].isNotNull())
            return F.transform(whole, lambda z: F.pmod(F.xxhash64(F.lit(salt), *[z[f"c{j}"] for j in range(k)]), F.lit(1 << spec.bits)).cast("int"))

        return F.concat(*map(of_order, spec.orders))

    marked = F.concat(F.lit("^"), value, F.lit("$"))
    return F.when(value == "", F.array().cast("array<int>")).otherwise(let(F.split(marked, ""), buckets))


def features(host: Column, path: Column, spec: LinearSpec) -> Column:
    return F.concat(_grams(host, spec, 1), _grams(path, spec, 2))


def probability(grams: Column, weights: list[float], bias: float) -> Column:
    """Of class 1; the features are bucket frequencies of length 1."""
    # one string literal that constant folding turns into an array; 4096
    # literals would be analysed one by one
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = let(grams, lambda g: F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.get(table, b)) / F.sqrt(F.size(g)))
    return F.when(F.size(grams) == 0, F.lit(0.0)).otherwise(1 / (1 + F.exp(-(total + F.lit(bias)))))


def train(labelled: DataFrame, spec: LinearSpec = LinearSpec(), *, url_col: str = "url", label_col: str = "label") -> tuple[list[float], float]:
    """Logistic regression by full gradient steps, each weight's step divided
    by the root of its summed squared gradients (Adagrad), so that a bucket
    of nearly all rows does not swing; each step is one aggregation by
    bucket (at most ``2**bits`` rows reach the driver).  Rows
    with a null url or label are left out; a table without rows gives zeros."""
    host, path = split_url(F.col(url_col))
    rows = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(label_col).cast("double").alias("y"), features(host, path, spec).alias("g"))
    rows = rows.where(F.size("g") > 0).persist()
    n = rows.count()
    weights, bias = [0.0] * (1 << spec.bits), 0.0
    if not n:
        rows.unpersist()
        return weights, bias
    squares = [0.0] * (len(weights) + 1)  # the last one is the bias's
    for _ in range(spec.steps):
        error = (probability(F.col("g"), weights, bias) - F.col("y")) / F.lit(float(n))
        # bucket -1 is the bias
        terms = F.concat(F.array(F.struct(F.lit(-1).alias("b"), F.lit(1.0).alias("v"))), F.transform("g", lambda b: F.struct(b.alias("b"), (1 / F.sqrt(F.size("g"))).alias("v"))))
        step = rows.select(error.alias("e"), F.inline(terms)).groupBy("b").agg(F.sum(F.col("e") * F.col("v")).alias("d"))
        weights = [w * (1 - spec.decay) for w in weights]
        for b, d in step.collect():
            squares[b] += d * d
            by = spec.rate * d / math.sqrt(squares[b]) if d else 0.0
            if b < 0:
                bias -= by
            else:
                weights[b] -= by
    rows.unpersist()
    return weights, bias


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)

    def value(r: Rule) -> Column:
        return F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))

    if not order:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    first, *rest = order
    return reduce(lambda when, r: when.when(fits(r), value(r)), rest, F.when(fits(first), value(first)))


def judge(df: DataFrame, rules: list[Rule], model: tuple[list[float], float], spec: LinearSpec = LinearSpec(), *, url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``df`` with host, path, rule, score and verdict; columns of these
    names are replaced."""
    host, path = split_url(F.col(url_col))
    rows = df.select("*", F.struct(host.alias("host"), path.alias("path")).alias("__p"))
    host, path = F.col("__p.host"), F.col("__p.path")
    rows = rows.select("*", fitting_rule(host, path, rules).alias("__r"), features(host, path, spec).alias("__g"))
    rows = rows.select("*", probability(F.col("__g"), *model).alias("__s"))
    by_model = F.when(F.col("__s") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    out = same_shape(rows, {"host": host, "path": path, "rule": F.col("__r.rule"), "score": F.col("__s"), "verdict": F.coalesce(F.col("__r.verdict"), by_model)})
    return out.drop("__p", "__r", "__g", "__s")
