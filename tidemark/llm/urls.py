"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

DataFrame functions and Spark's own boosted trees only; no Python runs on the
executors. A rule is a host and a path prefix; it fits the host and all its
subdomains, and the longest rule wins. Where no rule fits, the trees decide.
They are trained on the URLs that a rule decides: those are the labelled ones
(``block`` is 1). Features are lexical: lengths, path depth, digit ratio,
character entropy, parameter counts and the share of blocked URLs among the
labelled ones of the same host suffix (smoothed).

Scale: rules are a short parameter and compile into the expression. The statistics of a
suffix are one aggregate with partial sums; they are joined back by suffix, where
Spark broadcasts them only if their measured size is small and else splits a hot
suffix. The trees are fitted on at most about ``max_training_rows`` labelled URLs,
chosen by hash (the documented bound of the classifier); statistics count all.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by the trees with the features of an empty text; if the
labelled URLs hold one class only (or none), that class (or ``allow``) is the verdict;
repeated rows are judged one by one; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_TRAINING_ROWS = 200_000
FEATURES = ("url_chars", "host_chars", "path_chars", "query_chars", "depth", "labels", "digit_ratio", "entropy",
            "parameters", "hyphens", "has_fragment", "is_https", "suffix_blocked", "suffix_log_n")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def with_parts(urls: DataFrame) -> DataFrame:
    """Adds rest (after the first ``://``), host and path."""
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return urls.withColumn("rest", rest).withColumns({
        "host": F.translate(F.regexp_extract("rest", r"\A([^/?#]*)", 1), UPPER, LOWER),
        "path": F.regexp_extract("rest", r"\A[^/?#]*([^?#]*)", 1)})


def best_rule(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits (null if none; on a tie, block)."""
    text = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        text = F.when(fits, r.text) if text is None else text.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    if text is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, verdict


def with_features(urls: DataFrame) -> DataFrame:
    """Adds the lexical features that need no statistics, and ``suffix``."""
    url, n = F.coalesce("url", F.lit("")), F.length(F.coalesce("url", F.lit("")))
    count = lambda c, x: (F.length(c) - F.length(F.replace(c, F.lit(x)))).cast("double")
    ratio = lambda c: F.coalesce(F.try_divide(c.cast("double"), n.cast("double")), F.lit(0.0))
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.expr(
        "substring(coalesce(url, ''), instr(coalesce(url, ''), '?') + 1)"), "#", 1)).otherwise("")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c))) / F.length(url)
    entropy = F.aggregate(F.filter(F.array_distinct(F.split(url, "")), lambda c: F.length(c) > 0), F.lit(0.0),
                          lambda a, c: a - share(c) * F.log2(share(c)))
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    return urls.withColumn("query", query).withColumns({
        "url_chars": n.cast("double"), "host_chars": F.length("host").cast("double"),
        "path_chars": F.length("path").cast("double"), "query_chars": F.length("query").cast("double"),
        "depth": count(F.col("path"), "/"), "labels": count(F.col("host"), "."),
        "digit_ratio": ratio(digits), "entropy": entropy,
        "parameters": F.when(F.length("query") > 0, count(F.col("query"), "&") + 1).otherwise(0.0),
        "hyphens": count(url, "-"), "has_fragment": (F.instr(url, "#") > 0).cast("double"),
        "is_https": url.startswith("https:").cast("double"),
        "suffix": F.substring_index("host", ".", -1)})


def with_suffix_statistics(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds the smoothed share of blocked URLs and the log count of the suffix among all labelled URLs."""
    stats = labelled.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).select(
        "suffix", ((F.col("blocked") + 1) / (F.col("n") + 2)).alias("suffix_blocked"),
        F.log1p("n").alias("suffix_log_n"))
    return rows.join(stats, "suffix", "left").fillna({"suffix_blocked": 0.5, "suffix_log_n": 0.0})


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def train(labelled: DataFrame, max_training_rows: int = MAX_TRAINING_ROWS) -> GBTClassificationModel | str:
    """Boosted trees from rows with the features and ``label``, or the only verdict the labels hold."""
    n, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not blocked or blocked == n:
        return "block" if blocked else "allow"
    if n > max_training_rows:
        labelled = labelled.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < F.lit(max_training_rows * (1 << 20) // n))
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=12, maxDepth=4, maxBins=32, stepSize=0.3,
                         seed=7).fit(_vectors(labelled).select("features", "label"))


def judge(urls: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict and the trees' probability of ``block`` where they decided."""
    text, verdict = best_rule(rules)
    rows = with_features(with_parts(urls.select(F.col(id_column).alias("id"), "url"))) \
        .withColumns({"rule": text, "ruled": verdict})
    labelled = rows.filter(F.col("ruled").isNotNull()).withColumn("label", (F.col("ruled") == "block").cast("double"))
    rows = with_suffix_statistics(rows, labelled)
    model = train(with_suffix_statistics(labelled, labelled))
    if isinstance(model, str):
        rows = rows.withColumns({"learned": F.lit(model), "p_block": F.lit(None).cast("double")})
    else:
        from pyspark.ml.functions import vector_to_array
        rows = model.transform(_vectors(rows)).withColumns({
            "learned": F.when(F.col("prediction") == 1.0, "block").otherwise("allow"),
            "p_block": vector_to_array("probability")[1]})
    return rows.select(F.col("id").alias(id_column), "host", "path", "rule",
                       F.coalesce("ruled", "learned").alias("verdict"),
                       F.when(F.col("ruled").isNull(), F.col("p_block")).alias("p_block"))


def q_urls(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))
