"""URL filter: host rules, and a logistic regression on hashed character n-grams.

DataFrame functions only. Host and path are cut into runs of ``GRAM`` characters, each
hashed by its code points to one of ``BUCKETS``; a url's value in a bucket is its
count there over the root of its number of runs. The model is fitted on a small table of
labelled urls (at most ``LABELLED_ROWS``) by gradient descent in its dual form: one
coefficient per labelled url and the table of their inner products, in a single
``aggregate`` expression. The weights, one per bucket, become an array literal.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no
rule and is judged by the bias; rules with a path need the url's path to begin with it,
so ``net/`` needs at least ``/``; repeated rows are judged alike; an empty table gives
an empty result; columns other than page_id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
BUCKETS = 2048
STEPS = 300
RATE, DECAY = 4.0, 0.0005
LABELLED_ROWS = 200

# Rules (host and path, verdict) and the labelled urls.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BLOCKED = (
    "http://cheap-pills.example.com/en/450", "https://www.cheap-meds.example.org/en/12?utm_source=feed", "http://spam-farm.example.org/fr/9.html",
    "https://link-farm.example.com/es/31/", "http://casino-bonus.example.com/de/448?page=2&ref=x", "https://www.online-casino.example.org/en/77#top",
    "http://free-money.example.com/en/450", "https://m.get-rich-fast.example.org/en/12?utm_source=feed", "http://hot-singles.example.com/fr/9.html",
    "https://blog.xxx-videos.example.org/es/31/", "http://replica-watches.example.com/de/448?page=2&ref=x", "https://payday-loans.example.org/en/77#top",
    "http://www.pills-discount.example.com/en/450", "https://spam-links.example.com/en/12?utm_source=feed", "http://adult-cams.example.org/fr/9.html",
    "https://lottery-winner.example.com/es/31/", "http://m.weight-loss-pills.example.org/de/448?page=2&ref=x", "https://bet-poker.example.com/en/77#top",
    "http://click-farm.example.org/en/450", "https://fake-pharmacy.example.com/en/12?utm_source=feed", "http://www.buy-followers.example.org/fr/9.html",
    "https://spamdexing.example.com/es/31/", "http://viagra-store.example.org/de/448?page=2&ref=x", "https://torrent-crack.example.com/en/77#top",
)
ALLOWED = (
    "https://blog.example.com/en/12", "https://www.example.org/de/448?page=2", "http://m.example.com/fr/9.html", "https://news.example.org/es/31/",
    "https://docs.example.com/en/guide", "http://library.example.org/catalogue/7", "https://therand.example.com/en/820", "https://blog.theron.example.org/en/64.html",
    "http://www.thether.example.com/de/5#top", "https://m.ththin.example.org/fr/77/", "http://weather.example.com/en/today", "https://museum.example.org/es/rooms",
    "https://university.example.com/research/paper", "http://garden.example.org/de/plants", "https://blog.tionble.example.com/es/290?utm_source=feed",
    "http://ththon.example.com/en/310?page=2&ref=x", "https://theratre.example.org/en/17", "http://m.therly.example.com/fr/1204", "https://recipes.example.org/de/soup",
    "http://history.example.com/en/archive/1", "https://www.ththes.example.org/es/18.html", "https://maps.example.com/en/city", "http://blog.thernt.example.org/de/532",
    "https://science.example.com/fr/article/3",
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: str, host: Column, path: Column) -> Column:
    """The rule's host or a subdomain of it, with a path that begins with the rule's."""
    domain, _, rest = rule.partition("/")
    return ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")


def buckets(host: Column, path: Column, size: int = BUCKETS) -> Column:
    """Buckets of the runs of ``^host$path$``."""
    codes = F.transform(F.split(F.concat(F.lit("^"), host, F.lit("$"), path, F.lit("$")), ""), F.ascii)
    runs = [F.slice(codes, k + 1, F.size(codes) - (GRAM - 1)) for k in range(GRAM)]  # each evaluated once for a url
    mixed = runs[0]
    for following in runs[1:]:
        mixed = F.zip_with(mixed, following, lambda a, b: a * 31 + b)
    return F.transform(mixed, lambda x: F.pmod(x, F.lit(size)).cast("int"))


def labelled(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(u).alias("url"), F.lit(y).alias("blocked")) for y, urls in ((1, BLOCKED), (0, ALLOWED)) for u in urls]
    return spark.range(1).select(F.inline(F.array(*rows)))


def train(table: DataFrame, steps: int = STEPS) -> tuple[list[float], float]:
    """Weights per bucket and bias, from a table (url, blocked) of at most ``LABELLED_ROWS`` rows."""
    if table.count() > LABELLED_ROWS:
        raise ValueError(f"the labelled table may have {LABELLED_ROWS} rows at most")
    example = F.struct(F.coalesce("url", F.lit("")).alias("url"), F.col("blocked").cast("double").alias("y"))
    rows = table.filter("blocked is not null").agg(F.array_sort(F.collect_list(example)).alias("all")).select(F.posexplode("all").alias("i", "e"))
    rows = rows.select("i", "e.y", buckets(host_of(F.col("e.url")), path_of(F.col("e.url"))).alias("grams"))
    values = rows.select("i", "y", F.size("grams").alias("n"), F.explode("grams").alias("bucket"))
    values = values.groupBy("i", "y", "n", "bucket").agg((F.count("*") / F.sqrt("n")).alias("x"))
    other = values.select(F.col("i").alias("j"), "bucket", F.col("x").alias("x2"))
    inner = values.join(other, "bucket").groupBy("i", "y", "j").agg(F.sum(F.col("x") * F.col("x2")).alias("k"))
    near = inner.groupBy("i", "y").agg(F.array_sort(F.collect_list(F.struct("j", "k"))).alias("near"))
    one = near.agg(F.array_sort(F.collect_list(F.struct("i", "y", "near"))).alias("rows"))

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)

    def step(a: Column, _: Column) -> Column:
        def update(r: Column) -> Column:
            score = total(F.transform(r["near"], lambda e: e["k"] * F.get(a, e["j"]))) + total(a)
            return F.get(a, r["i"]) * (1 - RATE * DECAY) - RATE * (1 / (1 + F.exp(-score)) - r["y"]) / F.size("rows")

        return F.transform(F.col("rows"), update)

    start = F.transform(F.col("rows"), lambda r: F.lit(0.0))
    dual = one.select(F.posexplode(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)).alias("i", "a"))
    weights = values.join(dual, "i").groupBy("bucket").agg(F.sum(F.col("a") * F.col("x")).alias("w")).collect()  # at most BUCKETS rows
    out = [0.0] * BUCKETS
    for bucket, w in weights:
        out[bucket] = w
    return out, dual.agg(F.sum("a")).first()[0] or 0.0


def judge(pages: DataFrame, table: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict (the rule's, else the model's) and score."""
    weights, bias = train(labelled(pages.sparkSession) if table is None else table)
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    out = out.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule = F.lit(None).cast("string")
    for name, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        rule = F.when(fits(name, F.col("host"), F.col("path")), name).otherwise(rule)
    w = F.array(*(F.lit(float(x)) for x in weights))
    grams = buckets(F.col("host"), F.col("path"))
    linear = F.aggregate(F.transform(grams, lambda b: F.get(w, b)), F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.size(grams)) + F.lit(bias)
    out = out.withColumn("rule", rule).withColumn("score", 1 / (1 + F.exp(-linear)))
    verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    for name, says in rules:
        verdict = F.when(F.col("rule") == name, says).otherwise(verdict)
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
