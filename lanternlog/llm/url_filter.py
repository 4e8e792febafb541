"""URL verdicts: rules by host and path first, else logistic regression on hashed character n-grams.

Host and path give n-grams of 3 to 5 characters, hashed to a vector; a small table of labelled URLs
trains the regression, whose threshold decides wherever no rule fits. Everything runs in
DataFrame functions and Spark's own feature hashing and regression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch

SIZES, FEATURES, THRESHOLD, MAX_RULES = (3, 4, 5), 1 << 18, 0.5, 1000


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"


RULES = (Rule("allow", "com"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

# A small labelled table; what a blocked site is called, and ordinary places.
BLOCKED = """
http://casino-royal.test/en/12 https://www.casino-online.test/de/7.html http://m.bigcasino.test/fr/88/ https://win-casino.test/es/5 https://slots-win.test/en/901
https://casino-win-now.test/en/33?page=2 http://www.jackpot-win.test/de/4 https://poker-win.test/en/61 http://blog.poker-stars.test/fr/2 https://roulette.test/en/8
https://free-bets.test/en/14 http://www.bets-online.test/de/5 https://sport-bets.test/fr/71.html http://m.betting-tips.test/en/9 https://blog.free-bets-today.test/es/3/
https://adult-video.test/en/77 http://www.adult-chat.test/de/61 https://m.adult-x-tube.test/fr/5 http://xxx-tube.test/en/9.html https://blog.adult-cams.test/es/8
http://porn-tube.test/en/5 https://www.porn-hd.test/de/3 http://m.sex-cams.test/fr/1 https://escort-x.test/en/2
http://cheap-pills.test/en/4 https://www.cheap-viagra.test/de/65 http://m.pills-online.test/fr/7 https://blog.diet-pills.test/en/12.html http://pharma-cheap.test/es/9/ https://cheap-watches.test/en/6
https://ads-track.test/en/3 http://www.ads-server.test/de/6 https://m.click-track.test/fr/55 http://track-ads.test/en/8.html https://ad-tracker.test/es/41 http://blog.popup-ads.test/en/2
https://spam-farm.test/en/8 http://www.link-farm.test/de/72 https://m.content-farm.test/fr/6 http://seo-spam.test/en/11/ https://blog.spam-links.test/es/1 https://comment-spam.test/en/31
"""
ALLOWED = """
https://library.test/en/12 http://www.museum.test/de/7.html https://m.university.test/fr/88/ https://weather.test/es/5 https://history.test/en/901 http://blog.gardening.test/en/33?page=2
http://www.science.test/de/4 https://newspaper.test/en/61 http://blog.cooking.test/fr/2 https://mathematics.test/en/8 https://theatre.test/en/14 http://www.railway.test/de/5
https://sports.test/fr/71.html http://m.football.test/en/9 https://blog.travel.test/es/3/ https://geography.test/en/77 http://www.citizens.test/de/61 https://m.school.test/fr/5
http://encyclopedia.test/en/9.html https://blog.painting.test/es/8 http://hospital.test/en/5 https://www.parliament.test/de/3 http://m.orchestra.test/fr/1 https://the-other-nation.test/en/2
http://garden.test/en/4 https://www.northern-lights.test/de/65 http://m.bakery.test/fr/7 https://blog.physics.test/en/12.html http://chemistry.test/es/9/ https://archive.test/en/6
https://mountains.test/en/3 http://www.harbour.test/de/6 https://m.station.test/fr/55 http://astronomy.test/en/8.html https://literature.test/es/41 http://blog.thinking.test/en/2
https://farming.test/en/8 http://www.windmill.test/de/72 https://m.traction.test/fr/6 http://adventure.test/en/11/ https://blog.betterment.test/es/1 https://address-book.test/en/31
http://thesis.test/fr/204 https://www.heritage.test/es/77 https://ontology.test/de/1190.html http://m.interest.test/en/45?page=3 https://blog.another.test/fr/19 http://rivers.test/de/23
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table that comes with the operator: url, blocked."""
    one = spark.range(1)
    rows = [one.select(F.explode(F.split(F.trim(F.lit(urls)), r"\s+")).alias("url"), F.lit(blocked).alias("blocked")) for urls, blocked in ((BLOCKED, 1), (ALLOWED, 0))]
    return rows[0].unionByName(rows[1])


def with_parts(urls: DataFrame) -> DataFrame:
    """``urls`` with host (A-Z lower-cased) and path of the column url; both empty without ``://``."""
    rest = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, told apart: the last label of a host and digits of a path say nothing and are left out."""
    named = F.concat(F.lit("^"), F.regexp_replace(host, r"(^|\.)[^.]*$", "$1"))
    worded = F.concat(F.lit(":"), F.regexp_replace(path, "[0-9]+", "0"))

    def of(text: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - n + 1)
        return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(t, n) for t in (named, worded) for n in SIZES])


def vectors(urls: DataFrame, features: int) -> DataFrame:
    return HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="features").transform(urls.withColumn("grams", grams(F.col("host"), F.col("path"))))


def fitted(labelled: DataFrame, features: int = FEATURES) -> LogisticRegressionModel:
    """The regression on a small labelled table (url, blocked); rows with a null are left out."""
    rows = vectors(with_parts(labelled.where("url is not null and blocked is not null").select("url", F.col("blocked").cast("double").alias("label"))), features)
    return LogisticRegression(maxIter=60, regParam=0.02, elasticNetParam=0.0, standardization=False, tol=1e-7).fit(rows)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); of equal length the first given. Null without one."""
    ranked = sorted(rules, key=lambda r: -len(r.host + r.path))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ranked]
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, fit in reversed(list(zip(ranked, fits, strict=True))):
        found = F.when(fit, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None, threshold: float = THRESHOLD, features: int = FEATURES) -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's score (of block) for each row of ``pages``.

    ``rules`` are at most ``MAX_RULES`` and part of the plan; ``labelled`` (url, blocked 0/1; default: a
    table of this module) is small by contract. A url that is null or has no ``://`` has an empty host
    and path and no rule; it is judged by the regression's intercept. Labels of one kind only give
    the score of that kind, an empty labelled table 0. Equal urls are judged alike and rows that repeat
    are judged each; urls are read whole; an empty table gives an empty result; other columns are ignored.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are asked for")
    spark = pages.sparkSession
    urls = with_parts(pages.select("page_id", F.col("url").cast("string")))
    with scratch(spark):
        known = materialize((labelled_urls(spark) if labelled is None else labelled).select("url", "blocked").coalesce(1), "labelled")
        kinds = {r[0] for r in known.where("url is not null and blocked is not null").select(F.col("blocked").cast("int")).distinct().collect()}  # 0 and 1
        model = fitted(known, features) if kinds == {0, 1} else None
    if model is None:
        scored = urls.withColumn("score", F.lit(1.0 if kinds == {1} else 0.0))
    else:
        scored = model.transform(vectors(urls, features)).withColumn("score", vector_to_array("probability")[1])
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.withColumn("hit", hit).select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", judged).alias("verdict"), "score")


def without_blocked(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` without the rows whose url is blocked; columns of clashing names pass through."""
    verdicts = judge(pages.select(F.col("url").alias("page_id"), "url").distinct(), rules)
    return pages.join(verdicts.where("verdict = 'block'").select(F.col("page_id").alias("_blocked")), F.col("url").eqNullSafe(F.col("_blocked")), "left_anti")
