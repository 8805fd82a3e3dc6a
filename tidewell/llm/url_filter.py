"""URL filter: allow and block rules by host and path prefix, else logistic regression on hashed character n-grams."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of unwanted hosts by kind, and words of ordinary ones; the labelled URL table is made of them by a rule.
BAD = {
    "gambling": "casino casinos poker slots betting bets jackpot roulette lottery bookmaker wager",
    "pharmacy": "viagra pills cialis meds pharma-deals steroids weightloss diet-pills",
    "adult": "xxx porn adult sex-cams escorts nude hotgirls cams",
    "spam": "spam spammer free-money win-prize click-bait get-rich earn-cash mlm giveaway",
    "ads": "ads adserver adclicks ad-tracker popunder doubleads trackads banner-ads",
    "fraud": "phish phishing verify-login replica payday-loan fake-id crack keygen warez torrents",
}
GOOD = """
library weather garden kitchen museum school history physics music travel forest river mountain village harbour bridge
market bakery recipe cinema theatre gallery concert orchestra festival marathon football tennis chess cycling swimming
hospital clinic dentist nurse science biology chemistry geology astronomy planet ocean climate energy railway airport
station ferry hotel camping island coast valley castle cathedral archive newspaper journal radio weekly council parliament
ministry court police firebrigade teacher student college university lecture thesis grammar dictionary encyclopedia atlas
map photo camera painting pottery knitting woodwork bicycle garage tractor farmer orchard vineyard cheese coffee tea bread
software compiler database network manual tutorial forum wiki notes letters stories poems children family parents
neighbours theory winter summer morning evening friends letter house bank insurance office factory engine printer
a b c d e f g h i j k l m n o p q r s t u v w x y z
""".split()
#: Words that stand beside those of unwanted and of ordinary hosts.
BESIDE = ("best cheap free buy online now win vip".split(), "my old new city local open green north".split())
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? , # or the end, A-Z in lower case; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def seed(spark: SparkSession) -> DataFrame:
    """The labelled URL table (1: unwanted), some 1,400 rows: each word in hosts and paths of a few forms, which are dealt
    alike to both classes, so that only the words and those beside them tell them apart. It is fixed text and knows nothing of any table to judge."""
    hosts = ("{w}.test", "www.{w}.test", "blog.{w}.test", "m.{w}.test", "{w}-site.test", "{w}{k}.test", "{m}-{w}.test", "www.{w}-{m}.test", "{m}{w}.test", "m.{m}-{w}.test")
    paths = ("/", "/en/1", "/de/2.html", "/fr/3?page=2&ref=x", "/es/4/", "/index.html", "/en/5#top", "/news/6?utm_source=feed", "")
    bad = [w for words in BAD.values() for w in words.split()]
    rows = []
    for label, words, beside, each in ((1.0, bad, BESIDE[0], 10), (0.0, GOOD, BESIDE[1], 5)):
        for i, w in enumerate(words):
            for j in range(each):
                k = i * each + j
                host = hosts[(k if each < len(hosts) else j) % len(hosts)].format(w=w, k=k % 10, m=beside[k // 3 % len(beside)])
                rows.append((f"http{'s' if k % 3 else ''}://{host}{paths[k % len(paths)]}", label))
    return spark.createDataFrame(rows, "url string, label double")


def _grams(df: DataFrame) -> DataFrame:
    """Characters of host and of path (digits as 0), as arrays under names of their own."""
    host = F.concat(F.lit("^"), F.col("host"), F.lit("$"))
    path = F.concat(F.lit("^"), F.regexp_replace("path", "[0-9]+", "0"), F.lit("$"))
    mark = lambda tag: lambda c: F.concat(F.lit(tag), c)  # noqa: E731  the same n-gram of host and path differ
    return df.withColumns({"__h": F.transform(F.split(host, ""), mark("h")), "__p": F.transform(F.split(path, ""), mark("p"))})


def fit(labelled: DataFrame, features: int = 1 << 12, orders: tuple[int, ...] = (2, 3, 4), l2: float = 0.001) -> PipelineModel:
    """labelled: url, label (0 or 1): a small table, read whole. Rows with a null label or url take no part."""
    rows = labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull())
    rows = _grams(rows.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double").alias("label")))
    steps, names = [], []
    for side in ("__h", "__p"):
        for n in orders:
            steps += [NGram(n=n, inputCol=side, outputCol=f"{side}{n}"), HashingTF(numFeatures=features, binary=True, inputCol=f"{side}{n}", outputCol=f"{side}{n}v")]
            names.append(f"{side}{n}v")
    steps += [VectorAssembler(inputCols=names, outputCol="__x"), LogisticRegression(featuresCol="__x", regParam=l2, maxIter=20, rawPredictionCol="__r", probabilityCol="__q", predictionCol="__y")]
    return Pipeline(stages=steps).fit(rows.coalesce(1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, else null. rules: (verdict, host/path), a short list."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        at, _, start = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{start}")
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def judge(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url", threshold: float = 0.5) -> DataFrame:
    """key, host, path, rule, verdict, score for each row; a score of threshold or more blocks where no rule fits.

    Null and malformed urls have an empty host and path, fit no rule and are judged by the model. Repeated rows stay.
    """
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    scored = model.transform(_grams(rows)).withColumn("score", vector_to_array("__q")[1])
    hit = rule_of(F.col("host"), F.col("path"), rules)
    return scored.withColumn("__hit", hit).select(key, "host", "path", F.col("__hit.rule").alias("rule"), F.coalesce(F.col("__hit.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")


def keep(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str]] = RULES, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """The rows of pages whose url is allowed, judged row by row: null and repeated keys play no part, columns stay."""
    rows = pages.select(F.struct(*pages.columns).alias("__row"), F.col(url).alias("__url"))
    allowed = judge(rows, model, rules, "__row", "__url", threshold).where(F.col("verdict") == "allow")
    return allowed.select(*[F.col(f"__row.`{c}`").alias(c) for c in pages.columns])
