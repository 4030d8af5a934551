"""URL verdicts by rules and a logistic regression on hashed character n-grams of host and path.

The model is trained on a small labelled table of URLs by Spark's logistic regression; all of it, features,
training and scoring, is DataFrame work inside the JVM.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.scratch import own

#: Orders of the n-grams, width of the hashed features, penalty, probability from which a URL is blocked.
ORDERS, WIDTH, PENALTY, BLOCK_AT = (3, 4, 5), 1 << 14, 0.01, 0.5

#: Rules as (verdict, host and path). A rule fits its host and all subdomains if the URL's path starts with the rule's.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: The labelled URLs, 1 for block.
LABELLED = (
    (0, "https://www.therin.example.net/en/770"),
    (0, "http://blog.ththan.example.net/en/960"),
    (0, "https://m.ththth.example.net/en/25"),
    (0, "https://ththtion.example.net/es/384"),
    (0, "http://therha.example.com/en/676"),
    (0, "https://blog.tiontion.example.com/en/853/"),
    (0, "https://m.therou.example.com/en/474.html"),
    (0, "http://thther.example.org/fr/414"),
    (0, "https://www.therti.example.org/en/618/"),
    (0, "https://blog.thertion.example.org/es/978"),
    (0, "https://tionsh.example.net/de/12"),
    (0, "http://news.example.net/politics/2021/article.html"),
    (0, "https://docs.example.com/guide/install"),
    (0, "https://library.example.org/catalog/item/881"),
    (0, "http://university.example.net/physics/lecture-3.html"),
    (0, "https://www.example.net/about/contact"),
    (0, "https://wiki.example.com/history-of-printing"),
    (0, "http://museum.example.org/exhibits/12"),
    (0, "https://recipes.example.net/bread/sourdough.html"),
    (0, "https://weather.example.com/forecast/monday"),
    (0, "https://www.ththes.example.net/en/728"),
    (0, "http://ththing.example.com/en/11"),
    (0, "https://m.ththst.example.com/fr/901/"),
    (0, "http://m.therat.example.net/de/45.html"),
    (0, "http://www.theron.example.com/en/450"),
    (0, "https://ththnd.example.net/es/7"),
    (0, "https://blog.therhe.example.net/en/176/"),
    (0, "http://www.therer.example.com/es/533"),
    (0, "https://blog.ththor.example.com/en/369"),
    (0, "https://ththly.example.net/fr/65.html"),
    (0, "http://m.ththin.example.com/en/455"),
    (0, "https://blog.tionble.example.com/en/1"),
    (0, "https://farm.example.net/tractors/harvest.html"),
    (0, "http://pharmacy.example.com/opening-hours"),
    (1, "https://spam-farm.example.org/en/728"),
    (1, "http://spam-farm.example.net/en/11"),
    (1, "https://www.spam-farm.example.com/fr/901/"),
    (1, "http://m.spam-farm.example.net/de/45.html"),
    (1, "http://www.cheap-pills.example.com/en/450"),
    (1, "https://cheap-pills.example.net/es/7"),
    (1, "https://blog.cheap-pills.example.net/en/176/"),
    (1, "http://buy-pills-online.example.net/order"),
    (1, "https://casino-bonus.example.com/free-spins"),
    (1, "http://online-casino.example.net/jackpot/play.html"),
    (1, "https://adult-cams.example.com/live/xxx"),
    (1, "http://xxx-videos.example.net/free/adult"),
    (1, "https://free-money.example.net/win-prize/click"),
    (1, "http://cheap-loans.example.com/payday/apply-now"),
    (1, "https://replica-watches.example.net/cheap/sale"),
    (1, "http://click-farm.example.net/traffic/buy"),
    (1, "https://link-farm.example.com/seo/backlinks"),
    (1, "http://weight-loss-pills.example.net/buy-now"),
    (1, "https://spam-links.example.com/buy/cheap"),
    (1, "http://torrent-crack.example.net/keygen/free-download"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHAPE = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """From the first :// to / ? # or the end, A-Z lower-cased; empty for null and for URLs without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _SHAPE, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """After the host up to ? # or the end; empty for null and for URLs without ://."""
    return F.coalesce(F.regexp_extract(url, _SHAPE, 2), F.lit(""))


def rule_of(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits columns host and path, and its verdict; null where none fits. The rules are a short list of the caller's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def grams(*texts: Column) -> Column:
    """Character n-grams of all ORDERS of the texts, each between ^ and $ and marked with its number."""
    return F.concat(*(_grams(text, str(k), n) for k, text in enumerate(texts) for n in ORDERS))


def _grams(text: Column, mark: str, n: int) -> Column:
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), *(chars[i + j] for j in range(n))))


def labelled(spark: SparkSession, rows: tuple[tuple[int, str], ...] = LABELLED) -> DataFrame:
    """The labelled table: url and label."""
    return spark.createDataFrame([(u, float(y)) for y, u in rows], "url string, label double")


def fit(table: DataFrame) -> PipelineModel:
    """The classifier of host and path, trained on (url, label); it needs rows of both labels."""
    rows = table.select("label", grams(host_of("url"), path_of("url")).alias("grams"))
    hashing = HashingTF(numFeatures=WIDTH, binary=True, inputCol="grams", outputCol="features")
    regression = LogisticRegression(regParam=PENALTY, maxIter=50, aggregationDepth=2)
    return PipelineModel([hashing, regression.fit(hashing.transform(rows))])


def judge(pages: DataFrame, model: PipelineModel, url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """pages with host, path, rule, probability (of block by the model) and verdict: the longest fitting rule's, else the model's.

    A row for each row of pages, repeated or not. Null URLs and those without :// have an empty host and path,
    fit no rule and are judged as such by the model. Columns of pages named like these five are replaced, all
    others stay whatever their names. An empty table gives an empty result.
    """
    rule, verdict = rule_of(rules)
    kept = pages.drop("host", "path", "rule", "probability", "verdict")
    rows = pages.select(F.struct(*own(kept)).alias("page"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    rows = rows.withColumns({"rule": rule, "says": verdict, "grams": grams(F.col("host"), F.col("path"))})
    rows = model.transform(rows).withColumn("blocked", F.element_at(vector_to_array("probability"), 2))
    return rows.select("page.*", "host", "path", "rule", F.col("blocked").alias("probability"), F.coalesce("says", F.when(F.col("blocked") >= BLOCK_AT, "block").otherwise("allow")).alias("verdict"))
