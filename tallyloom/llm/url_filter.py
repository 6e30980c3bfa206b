"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams.

Built from DataFrame functions and Spark ML's own (JVM) feature hashing and regression; no
Python runs on an executor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import col

ALLOW, BLOCK = "allow", "block"
FEATURES = 1 << 14
SIZES = (3, 4)
# Largest number of labelled URLs that a model is fitted on.
SAMPLE = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    A rule ``host/path`` fits its host and every subdomain, where the path starts with its own.
    Two rules for one host and path: the first of the list.
    """
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits.append((((host == name) | host.endswith("." + name)) & path.startswith(slash + rest),
                     F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    if not fits:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    first, *rest = fits
    return reduce(lambda c, f: c.when(*f), rest, F.when(*first))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path; each kind is marked, so that ``/en`` in a path and
    in a host are different features."""
    def of(text: Column, mark: str) -> Column:
        padded = F.concat(F.lit("^"), text, F.lit("$"))

        def cut(n: int):
            return lambda i: F.concat(F.lit(mark), F.substring(padded, i, F.lit(n)))

        return F.concat(*[F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))), cut(n))
            for n in SIZES])
    return F.concat(of(host, "h"), of(path, "p"))


def _vectors(rows: DataFrame) -> DataFrame:
    with_grams = rows.withColumn("_grams", grams(F.col("host"), F.col("path")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams",
                     outputCol="_features").transform(with_grams).drop("_grams")


def fit(labelled: DataFrame, sample: int = SAMPLE) -> LogisticRegressionModel | float:
    """Fit on the ``sample`` labelled rows (host, path, verdict) with the smallest hashes.

    Equal urls count once, so the answer depends neither on repeats nor on the order of rows.
    With one verdict only, or with no rows, the answer is a constant probability of ``block``
    (0 without rows).
    """
    small = (labelled.select("host", "path", (F.col("verdict") == BLOCK).cast("double")
                             .alias("label")).distinct()
             .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(sample))
    rows = small.collect()  # bounded by ``sample``
    labels = {r["label"] for r in rows}
    if len(labels) < 2:
        return labels.pop() if labels else 0.0
    spark = labelled.sparkSession
    training = _vectors(spark.createDataFrame(rows, small.schema).coalesce(1))
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.01,
                              maxIter=50).fit(training)


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame, *,
          page_id: str = "page_id", url: str = "url", threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block of every row of ``pages``.

    The rule's verdict, or else the model's: block from ``threshold`` on. A null url, or one
    without ``://``, has an empty host and path, which no rule fits; the model judges it.
    Repeated rows are judged one by one. ``labelled`` has host, path, verdict.
    """
    model = fit(labelled)
    parsed = pages.select(col(page_id).alias("page_id"), host_of(col(url)).alias("host"),
                          path_of(col(url)).alias("path"))
    if isinstance(model, float):
        scored = parsed.withColumn("p_block", F.lit(model))
    else:
        scored = model.transform(_vectors(parsed)).withColumn(
            "p_block", vector_to_array("probability").getItem(1))
    own = F.when(F.col("p_block") >= threshold, BLOCK).otherwise(ALLOW)
    fit_rule = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", fit_rule["rule"].alias("rule"),
                         F.coalesce(fit_rule["verdict"], own).alias("verdict"), "p_block")


def labelled_by_rules(pages: DataFrame, rules: list[tuple[str, str]],
                      url: str = "url") -> DataFrame:
    """The urls that a rule decides, as a labelled table (host, path, verdict)."""
    parsed = pages.select(host_of(col(url)).alias("host"), path_of(col(url)).alias("path"))
    return parsed.withColumn("verdict", rule_of(F.col("host"), F.col("path"), rules)["verdict"]
                             ).filter(F.col("verdict").isNotNull())
