"""URL filters: host and path rules, and a logistic regression on character n-grams (operator 3). No Python at run time."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import let, table

#: (rule, verdict): a rule is a host, then the path that a url's must start with. A list of bounded length.
RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)

#: Words that mark a host to block, words that stand beside them as well as beside ordinary ones, and ordinary words.
MARKED = """
    casino poker roulette jackpot slots bets betting gambling viagra cialis pills meds porn xxx adult escorts cams hentai sexy
    warez crack keygen torrents payday replica spam seo backlinks clicks ads adserver banners popups tracker track lottery
    prizes spins
""".split()
NEUTRAL = """
    win free cheap best online bonus club live hot fast zone hub farm mail royal lucky games offers deals shop link links live
    media server store today top world
""".split()
ORDINARY = """
    history garden morning weather museum library science travel recipes journal theatre station northern village teacher
    railway brothers nation weekend letters reader writers harbour mountain collection children kitchen street school bread
    winter summer council county parish market bakery cinema concert orchestra painting sculpture physics chemistry biology
    mathematics astronomy philosophy economics language grammar dictionary newspaper magazine breakfast furniture electric
    computer software hardware network engineer building bridge airport ferry bicycle football tennis swimming hiking camping
    forest river valley island coast lighthouse castle cathedral heritage archive research university college student nursery
    hospital clinic doctor dentist pharmacy insurance theory earth health wealth youth father mother weaver thunder strasse
    bahnhof rathaus zeitung garten schule kirche wissenschaft gesundheit mairie musique cuisine jardin quartier lecture
    biblioteca ciudad escuela cocina noticias deportes track-and-field address advice credits badge heading reading
""".split()
PREFIXES = ("", "www.", "m.", "blog.", "en.", "news.", "docs.")
TLDS = ("com", "net", "org", "info", "io", "de", "fr", "es", "eu", "co.uk", "gov", "edu", "xyz", "top", "biz", "shop", "click")
PATHS = ("", "/", "/en/1042", "/de/77", "/fr/5310.html", "/es/268/", "/articles/history", "/wiki/Geography", "/docs/guide/install", "/products/42", "/2019/04/report.pdf", "/about/contact", "/search/results", "/user/profile")
MARKED_PATHS = ("/play/free-spins", "/buy/viagra", "/xxx/watch", "/win/jackpot", "/download/keygen.zip", "/ads/click.php", "/casino/bonus", "/porn/hd", "/poker/online", "/cheap/pills-online")


def _address(name: str, i: int, path: str | None = None) -> str:
    """A url of a name: prefix, TLD and path by number, the same ones for hosts to block and to allow."""
    return f"{PREFIXES[i % 7]}{name}.{TLDS[(5 * i + i // 17) % 17]}{PATHS[(3 * i + i // 14) % 14] if path is None else path}"


def labelled_urls() -> tuple[tuple[str, int], ...]:
    """The labelled table, (url, 1 to block and 0 to allow): pairs of words by rule, no two hosts with the same name."""
    rows: dict[str, tuple[str, int]] = {}

    def put(name: str, label: int, path: str | None = None) -> None:
        rows.setdefault(f"{name}{path or ''}", (_address(name, len(rows), path), label))

    n, k = len(NEUTRAL), len(ORDINARY)
    for i, word in enumerate(MARKED):
        for j in range(6):
            other = NEUTRAL[(7 * i + 5 * j) % n]
            put((f"{word}-{other}", f"{other}-{word}", f"{word}{other}", f"{other}{word}", f"{word}-{MARKED[(i + j) % len(MARKED)]}", word)[j], 1)
    for i, word in enumerate(ORDINARY):
        for name in (word, f"{word}-{NEUTRAL[i % n]}", f"{NEUTRAL[(3 * i + 1) % n]}-{word}", f"{word}{ORDINARY[(i + 37) % k]}", f"the-{word}-{ORDINARY[(i + 61) % k]}"):
            put(name, 0)
    for i, path in enumerate(MARKED_PATHS * 4):
        put(f"{ORDINARY[(11 * i) % k]}{NEUTRAL[i % n]}", 1, path)
    return tuple(rows.values())


#: What the weights are trained from.
LABELLED = labelled_urls()
GRAM = 4
#: Buckets of the n-grams of hosts, and behind them those of paths.
HOST_BUCKETS, PATH_BUCKETS = 16384, 2048
#: N-grams of fewer hosts of the table than this have no weight.
LEAST_HOSTS = 3
#: What must speak against a url beyond even odds: it blocks too much rather than too little that costs.
CAUTION = 1.5
#: What the urls to block count for in the fit, all together.
BLOCK_SHARE = 0.3
#: Weights are whole numbers of this size, so that sums are exact in any order.
UNIT = 1_000_000


def _buckets(host: str, path: str) -> list[int]:
    """Those of the n-grams of the host without its last label, and of the path."""
    out = []
    for part, first, size in ((host.rpartition(".")[0] or host.removeprefix("."), 0, HOST_BUCKETS), (path, HOST_BUCKETS, PATH_BUCKETS)):
        codes = [ord(c) for c in f"^{part}$"]
        out += [first + (((codes[i] * 31 + codes[i + 1]) * 31 + codes[i + 2]) * 31 + codes[i + 3]) % size for i in range(len(codes) - GRAM + 1)]
    return out


@cache
def trained(labelled: tuple = LABELLED, steps: int = 80, rate: float = 0.4, decay: float = 0.1) -> tuple[tuple[int, ...], int]:
    """Weights of the n-gram buckets, and the intercept less CAUTION: a url's log-odds are their sum over its n-grams.

    Logistic regression by AdaGrad over the labelled table. N-grams of few hosts are left out. The intercept is below zero,
    and weights of n-grams that tell nothing are near it, so that a url of which the table knows nothing is ordinary.
    """
    parts = [url.partition("/") for url, _ in labelled]
    found = [_buckets(host, slash + path) for host, slash, path in parts]
    hosts: dict[int, set[str]] = {}
    for (host, _, _), row in zip(parts, found, strict=True):
        for b in row:
            hosts.setdefault(b, set()).add(host)
    active = sorted(b for b, held in hosts.items() if len(held) >= LEAST_HOSTS)
    place = {b: i for i, b in enumerate(active)}
    x = np.zeros((len(labelled), len(active)))
    for row, buckets in enumerate(found):
        for b in buckets:
            if b in place:
                x[row, place[b]] = 1
    y = np.array([label for _, label in labelled], dtype=float)
    share = np.where(y == 1, BLOCK_SHARE / max(y.sum(), 1), (1 - BLOCK_SHARE) / max((1 - y).sum(), 1))
    # The last column is the intercept, which does not decay.
    x = np.hstack([x, np.ones((len(x), 1))])
    kept = np.append(np.full(len(active), decay / max(len(active), 1)), 0.0)
    w, seen = np.zeros(len(active) + 1), np.full(len(active) + 1, 1e-8)
    for _ in range(steps):
        slope = x.T @ (share * (1 / (1 + np.exp(-(x @ w))) - y)) + kept * w
        seen += slope**2
        w -= rate * slope / np.sqrt(seen)
    out = [0] * (HOST_BUCKETS + PATH_BUCKETS)
    for b, value in zip(active, w[:-1], strict=True):
        out[b] = int(round(value * UNIT))
    return tuple(out), int(round((min(w[-1], 0.0) - CAUTION) * UNIT))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty where url is null or has no ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    part = lambda i: F.when(has, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i)).otherwise(F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def _fitting_rule(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule with its verdict, null if none fits; of equals, the greater text."""
    found = []
    for rule, verdict in rules:
        cut = rule.index("/")
        of, start = rule[:cut], rule[cut:]
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*found))


def _margin(host: Column, path: Column, weights: tuple[int, ...], prior: int) -> Column:
    """The prior and the weights of all n-grams of host and path: above zero where the model blocks."""
    # One literal, which Spark takes apart once; a literal for each weight would make a plan of thousands of nodes.
    held = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")

    def of(first: int, size: int):
        def summed(codes: Column) -> Column:
            def step(total: Column, i: Column) -> Column:
                at = ((F.get(codes, i) * 31 + F.get(codes, i + 1)) * 31 + F.get(codes, i + 2)) * 31 + F.get(codes, i + 3)
                return total + F.get(held, (at % size).cast("int") + first)

            last = F.size(codes) - GRAM
            return F.when(last >= 0, F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("bigint"), step)).otherwise(F.lit(0).cast("bigint"))

        return summed

    codes = lambda part: F.transform(F.filter(F.split(F.concat(F.lit("^"), part, F.lit("$")), ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))
    named = F.when(F.contains(host, F.lit(".")), F.regexp_replace(host, r"(?s)\.[^.]*$", "")).otherwise(host)
    named = F.when(named == "", F.regexp_replace(host, r"^\.", "")).otherwise(named)
    return F.lit(prior).cast("bigint") + let(codes(named), of(0, HOST_BUCKETS)) + let(codes(path), of(HOST_BUCKETS, PATH_BUCKETS))


def judged(pages: DataFrame, rules=RULES, labelled=LABELLED) -> DataFrame:
    """One row for each page: ``page_id, host, path, rule, verdict``.

    The longest rule that fits decides; else the model blocks where the weights of the n-grams of host and path, with the
    prior, sum up to more than zero. A null url, or one without ``://``, has empty host and path, and the model allows it.
    Rows that repeat are judged each. Extra columns are ignored.
    """
    weights, prior = trained(labelled)
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", _fitting_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("_model", F.when(F.col("_rule").isNull(), _margin(F.col("host"), F.col("path"), weights, prior)))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_model") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def sql(rules=RULES, labelled=LABELLED) -> str:
    weights, prior = trained(labelled)
    cases = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    when = lambda pick: " ".join(f"WHEN (host = '{r[: r.index('/')]}' OR ends_with(host, '.{r[: r.index('/')]}')) AND starts_with(path, '{r[r.index('/') :]}') THEN '{r if pick else v}'" for r, v in cases)
    held = ", ".join(f"({b}, {w})" for b, w in enumerate(weights) if w)
    gram = lambda k, first, size: f"list_transform(range(1, greatest(len({k}) - 2, 1)), lambda i: {first} + ((({k}[i] * 31 + {k}[i + 1]) * 31 + {k}[i + 2]) * 31 + {k}[i + 3]) % {size})"
    return f"""
WITH weights(bucket, weight) AS (VALUES {held}), u AS (
  SELECT row_number() OVER () AS row, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT row, page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u
), c AS (
  SELECT *, list_transform(string_split('^' || coalesce(nullif(regexp_replace(host, '(?s)\\.[^.]*$', ''), ''), regexp_replace(host, '^\\.', '')) || '$', ''), lambda x: unicode(x)::BIGINT) AS a, list_transform(string_split('^' || path || '$', ''), lambda x: unicode(x)::BIGINT) AS b FROM h
), g AS (
  SELECT row, unnest(list_concat({gram('a', 0, HOST_BUCKETS)}, {gram('b', HOST_BUCKETS, PATH_BUCKETS)})) AS bucket FROM c
), s AS (
  SELECT row, sum(weight) AS total FROM g JOIN weights USING (bucket) GROUP BY row
), m AS (
  SELECT page_id, host, path, {prior} + coalesce(total, 0) AS margin FROM h LEFT JOIN s USING (row)
)
SELECT page_id, host, path, CASE {when(True)} END AS rule,
       coalesce(CASE {when(False)} END, CASE WHEN margin > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM m
"""


OP3_SQL = sql()
