"""URL verdicts: host and path rules first, else a logistic model on hashed character n-grams.

The model is trained from a small labelled table with Spark ML and applied as a DataFrame
transformation; nothing runs in Python on the executors.

Contract: a null url or one without ``://`` has an empty host and path, fits no rule and gets
the model's verdict on empty text; the longest fitting rule wins; repeated rows are judged
separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.words import UPPER

#: Verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Hosts of the small labelled table. Each is seen with every path below.
GOOD_HOSTS = """www.therti.example.org blog.therti.example.com thening.example.net m.ththe.example.com
library.example.org news.example.net docs.example.com blog.garden.example.net www.museum.example.com
m.school.example.org forum.example.net wiki.example.com""".split()
BAD_HOSTS = """spam-farm.example.org www.spam-farm.example.com blog.spam-farm.example.net
m.spam-farm.example.com cheap-pills.example.org www.cheap-pills.example.com cheap-pills.example.net
m.cheap-pills.example.net free-casino.example.com www.win-prizes.example.net cheap-loans.example.com
click-farm.example.net""".split()
PATHS = ["/", "/en/12", "/fr/345/", "/de/678.html", "/es/90"]

GRAM = 3
WIDTH = 1 << 14


def parsed(df: DataFrame, url: str) -> DataFrame:
    """Add ``host`` and ``path``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower())
    return df.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def best_rule(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, top, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == top) | host.endswith("." + top)) & path.startswith(start)
        name = F.when(fits, F.lit(top + start)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def letters(df: DataFrame) -> DataFrame:
    """Add ``_letters``: the characters of host and path."""
    return df.withColumn("_letters", F.filter(F.split(F.concat("host", "path"), ""), lambda c: c != ""))


def train(labelled: DataFrame) -> PipelineModel:
    """Logistic model on hashed n-grams; ``labelled`` has host, path and label (1: block)."""
    steps = [
        NGram(n=GRAM, inputCol="_letters", outputCol="_grams"),
        HashingTF(numFeatures=WIDTH, inputCol="_grams", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="label", predictionCol="_blocked", probabilityCol="_p", rawPredictionCol="_raw", regParam=0.01, maxIter=60),
    ]
    return Pipeline(stages=steps).fit(letters(labelled).coalesce(1))


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [(h, p, float(bad)) for bad, hosts in ((0, GOOD_HOSTS), (1, BAD_HOSTS)) for h in hosts for p in PATHS]
    return spark.createDataFrame(rows, "host string, path string, label double")


def judge(pages: DataFrame, model: PipelineModel, rules=RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict."""
    rule, verdict = best_rule(rules, F.col("host"), F.col("path"))
    scored = model.transform(letters(parsed(pages, url)))
    by_model = F.when(F.col("_blocked") == 1.0, "block").otherwise("allow")
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(verdict, by_model)}).drop(
        "_letters", "_grams", "_features", "_blocked", "_p", "_raw"
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url of ``pages``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, train(labelled_urls(spark))).select("page_id", "host", "path", "rule", "verdict")
