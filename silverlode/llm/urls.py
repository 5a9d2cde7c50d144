"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams.

Host and path are cut into n-grams with marks at their ends, each hashed to one of BUCKETS weights.
The weights are fitted to a small labelled table: its features are computed by the same column
expressions and brought to the driver (one row for each labelled URL, a few hundred), where
gradient descent runs. Scoring is a column expression with the weights as a literal.

Defined results: a null URL, or one without "://", has an empty host and path, fits no rule and is
judged by the intercept; hosts and paths of any length are read whole; every row gives one row;
extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 13
GRAMS = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Log odds from which a page is blocked, as a probability: in five folds by name, at most two in a hundred wanted
#: names that the model had not seen were blocked from here on. Of unwanted names it hadn't seen few are: it knows
#: parts of words.
THRESHOLD = 0.8

#: (verdict, host, path); the longest that fits wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: The labelled table, by topic: words that common blocklists are about, and words of everyday subjects in
#: four languages. They were written down without a look at any table of pages.
UNWANTED = (
    "casino roulette blackjack poker betting bookmaker jackpot lottery gambling bingo wager baccarat "
    "viagra cialis pharmacy steroids tramadol xanax pills dietpills painkillers "
    "porn xxx sex escort webcam nude erotic fetish hentai adult hookup camgirls "
    "payday loans quickcash creditrepair getrich forex bitcoindoubler ponzi "
    "warez keygen crack torrent cheats hacktool malware phishing botnet ransom "
    "replica counterfeit fakerolex knockoff backlinks linkfarm buyfollowers cheaptraffic spam spamlist "
    "adserver popunder clickbait tracker adclick affiliate prize giveaway freegift sweepstakes"
).split()
WANTED = (
    "news library garden recipes museum university physics history weather football music travel biology "
    "council village school letters painting bookshop radio journal archive science health cycling chess "
    "mountain river theatre orchestra bakery railway harbour bridge forest farming astronomy geology law "
    "carpentry pottery knitting birds flowers climate economics philosophy poetry novels cinema "
    "grammar dictionary encyclopedia maps hiking sailing swimming athletics tennis rugby volunteers charity "
    "zeitung schule garten kirche stadt bahnhof rathaus wetter wissenschaft bibliothek verein kochen wandern "
    "maison jardin ecole musee cuisine journal mairie meteo voyage histoire lecture montagne "
    "ciudad escuela jardin cocina museo biblioteca noticias deporte viaje iglesia ayuntamiento ciencia "
    "software tutorial manual developer database network hardware compiler statistics algebra "
    "family kitchen furniture architecture photography design fashion children teachers students parliament"
).split()
_PREFIXES = ("www.", "blog.", "m.", "")
_ENDS = (".example.com", ".example.net", ".example.org", ".com")
_PATHS = ("/en/12", "/de/345.html", "/fr/67/", "/es/890", "/", "")


def labelled() -> list[tuple[str, int]]:
    """The labelled table (url, unwanted): two URLs for each name, with prefix, end and path in turn."""
    rows = []
    for label, names in ((1, UNWANTED), (0, WANTED)):
        for i, name in enumerate(names):
            for k in (i, i + 1 + len(names) // 2):
                host = f"{_PREFIXES[k % 4]}{name}{_ENDS[(k // 2) % 4]}"
                rows.append((f"http{'s' * (k % 2)}://{host}{_PATHS[k % 6]}", label))
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _gram(marked: Column, mark: str, n: int) -> Callable[[Column], Column]:
    return lambda i: F.concat(F.lit(mark), F.substr(marked, i, F.lit(n)))


def _grams(text: Column, part: str) -> Column:
    """Buckets of the n-grams of a text between marks, none for an empty text."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    found = []
    for n in GRAMS:
        last = F.length(marked) - n + 1
        places = F.when((F.length(text) > 0) & (last > 0), F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
        places = F.coalesce(places, F.array().cast("array<int>"))
        found.append(F.transform(places, _gram(marked, f"{part}{n}", n)))
    return F.transform(F.concat(*found), lambda g: (F.crc32(g) % BUCKETS).cast("int"))


def features(host: Column, path: Column) -> Column:
    return F.concat(_grams(host, "h"), _grams(path, "p"))


def fit(spark: SparkSession, rows: Sequence[tuple[str, int]], steps: int = 400, rate: float = 0.3, decay: float = 1e-3) -> list[float]:
    """Weights of the buckets, and the intercept last, fitted to labelled URLs."""
    told = spark.createDataFrame([(u, y) for u, y in rows], "url string, label int")
    host, path = host_and_path(F.col("url"))
    found = told.select("url", "label", features(host, path).alias("grams")).orderBy("url", "label").collect()
    x, y = np.zeros((len(found), BUCKETS + 1)), np.array([r.label for r in found], float)
    for i, r in enumerate(found):
        np.add.at(x[i], np.array(r.grams, int), 1.0)
        x[i, -1] = 1.0
    used = np.flatnonzero(x.any(axis=0))
    x, w = x[:, used], np.zeros(len(used))
    balance = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= rate * (x.T @ (balance * (p - y)) / len(y) + decay * w)
    weights = np.zeros(BUCKETS + 1)
    weights[used] = w
    return [round(float(v), 6) for v in weights]


def log_odds(host: Column, path: Column, weights: Sequence[float]) -> Column:
    """The model's log odds that a URL is unwanted."""
    literal = F.split(F.lit(",".join(map(str, weights[:-1]))), ",").cast("array<double>")
    return F.aggregate(features(host, path), F.lit(float(weights[-1])), lambda s, g: s + F.element_at(literal, g + 1))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, name, start = rule
    return ((host == name) | host.endswith("." + name)) & path.startswith(start)


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    labels: Sequence[tuple[str, int]] | None = None,
    threshold: float = THRESHOLD,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one per page."""
    weights = fit(pages.sparkSession, labels or labelled())
    host, path = host_and_path(pages[url_column])
    rows = pages.select(pages[id_column].alias("page_id"), host.alias("host"), path.alias("path"))
    host, path = F.col("host"), F.col("path")
    limit = math.log(threshold / (1 - threshold))
    rule = F.lit(None).cast("string")
    verdict = F.when(log_odds(host, path, weights) >= limit, "block").otherwise("allow")
    for r in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        rule = F.when(_fits(host, path, r), r[1] + r[2]).otherwise(rule)
        verdict = F.when(_fits(host, path, r), r[0]).otherwise(verdict)
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
