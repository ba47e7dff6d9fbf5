"""URL filter: rules first, a logistic regression for the rest.

A rule is ``host/path-prefix``; it fits its host and every subdomain if the
path starts with its prefix, and the longest rule that fits decides. URLs
that no rule fits are judged by a logistic regression on hashed character
n-grams of host and path. It learns from a small labelled table: the URLs
that a rule decides, at most about ``MAX_TRAIN`` of them, taken by a hash.

Everything runs on DataFrames: n-grams are array expressions, hashing,
training (distributed gradient sums) and scoring are Spark ML.

Cases: a null URL or one without ``://`` has an empty host and path and no
rule; the regression judges it like any other. Repeated rows are judged one
by one. If the labelled table is empty every such URL is allowed; if it holds
one class, that class is the verdict. An empty table gives no rows. Other
columns are ignored. The cost is linear in the length of a URL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 20_000
FEATURES = 1 << 16
NGRAMS = (3, 4)
ITERATIONS = 25
REGULARISATION = 1e-3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str          # host, then the path prefix from its first "/"

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self) -> Column:
        own = F.col("host") == self.host
        return (own | F.col("host").endswith("." + self.host)) & F.col("path").startswith(self.path)


# Fixed values.
DEFAULT_RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substr(url, mark + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def apply_rules(rows: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """``rows`` with host and path, the longest fitting ``rule`` and its
    ``rule_verdict`` (null where none fits)."""
    best = F.lit(None).cast("struct<rule:string,rule_verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):      # the longest comes to stand outermost
        best = F.when(rule.fits(), F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("rule_verdict"))).otherwise(best)
    return rows.withColumn("best", best).select(*rows.columns, "best.rule", "best.rule_verdict")


def ngrams(text: Column, tag: str, sizes=NGRAMS) -> Column:
    """Character n-grams of a text with its ends marked, each with a tag."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    chars = F.filter(chars, lambda c: c != "")

    def of_size(n: int) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(tag), F.array_join(F.slice(chars, i, n), "")))

    return F.concat(*map(of_size, sizes))


def judge(pages: DataFrame, rules=DEFAULT_RULES, id_col: str = "page_id", url_col: str = "url",
          max_train: int = MAX_TRAIN) -> DataFrame:
    """page_id, host, path, rule, verdict and block_probability (of the
    regression; null where a rule decided) of every page."""
    host, path = host_and_path(F.col(url_col))
    rows = apply_rules(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), rules)
    labelled = rows.where(F.col("rule").isNotNull())
    n, blocked = labelled.agg(F.count("*"), F.count_if(F.col("rule_verdict") == "block")).first()
    if blocked in (0, n):
        only = "block" if n and blocked else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(only)).alias("verdict"),
                           F.lit(None).cast("double").alias("block_probability"))

    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")

    def featurised(part: DataFrame) -> DataFrame:
        return hashing.transform(part.withColumn("grams", F.concat(ngrams(F.col("host"), "h"), ngrams(F.col("path"), "p"))))

    share = min(1.0, max_train / n)
    train = (labelled.where(F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(1 << 20)) < int(share * (1 << 20)))
             .withColumn("label", (F.col("rule_verdict") == "block").cast("double")))
    if train.select("label").distinct().count() < 2:           # the sample of a nearly pure table
        train = labelled.withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    model = LogisticRegression(maxIter=ITERATIONS, regParam=REGULARISATION).fit(featurised(train).select("label", "features"))
    scored = model.transform(featurised(rows))
    p = F.when(F.col("rule").isNull(), F.element_at(vector_to_array("probability"), 2))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", F.when(p > 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                         p.alias("block_probability"))
