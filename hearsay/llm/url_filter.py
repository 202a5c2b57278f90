"""URL filter: curated rules first, gradient-boosted trees for the rest.

Rules name a host and a path prefix; the longest fitting rule decides. Other
URLs are judged by boosted trees on lexical features: length, depth, digit
ratio, character entropy, parameter counts, and statistics of the host's suffix
(how common it is, and its smoothed block rate among labelled URLs). Trees are
trained from labelled URLs and become one column expression, so scoring is a
narrow pass over the url column.

Training reads a bounded sample: the `max_labelled` labelled URLs with the
smallest hash. Suffix statistics cover all rows.

Defined results: a null URL, or one without `://`, has empty host and path, fits
no rule and goes to the model as an empty string; with no label, or only one
class, the model allows (or blocks) everything by that class; repeated rows are
judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.functions.lookup import let
from hearsay.llm.common import ascii_lower, join_small, stage

MAX_LABELLED = 10_000
MAX_RULES = 1_000
FEATURES = (
    "length", "host_length", "depth", "host_labels", "digit_ratio", "entropy",
    "n_params", "query_length", "n_marks", "suffix_share", "suffix_rate",
)


@dataclass(frozen=True)
class Rule:
    """`host/path-prefix`; fits the host and all its subdomains."""

    verdict: str
    rule: str

    def fits(self, host: Column, path: Column) -> Column:
        at = self.rule.index("/")
        ends = F.concat(F.lit("."), host).endswith("." + self.rule[:at])
        return ends & path.startswith(self.rule[at:])


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null. First given wins a tie."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules exceed the limit of {MAX_RULES}")
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        hit = F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chain = F.when(r.fits(host, path), hit).otherwise(chain)
    return chain


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)

    def term(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), term)


def lexical(rows: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host, path, suffix and the lexical features (all but the suffix statistics)."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    named = rows.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return named.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "depth": count(F.col("path"), "/[^/]"),
        "host_labels": F.size(F.split("host", r"\.")).cast("double"),
        "digit_ratio": count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "entropy": F.when(url == "", 0.0).otherwise(let(url, entropy)),
        "n_params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "n_marks": count(url, r"[-_.~%@#=]"),
    })


def suffix_statistics(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """(suffix, suffix_share, suffix_rate): share of all rows; block rate shrunk to the mean."""
    seen = rows.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"))
    known = labelled.groupBy(F.col("suffix").alias("s")).agg(
        F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("m")
    )
    total, (blocked, m) = rows.count(), labelled.agg(F.sum("label"), F.count(F.lit(1))).first()
    mean = (blocked or 0) / m if m else 0.0
    joined = seen.join(known, seen["suffix"] == known["s"], "left").fillna(0, ["blocked", "m"])
    return joined.select(
        "suffix",
        (F.col("n") / max(total, 1)).alias("suffix_share"),
        ((F.col("blocked") + 20 * mean) / (F.col("m") + 20)).alias("suffix_rate"),
    )


def tree_column(node) -> Column:
    """A trained tree as nested CASE expressions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(
        F.col(FEATURES[split.featureIndex()]) <= float(split.threshold()), tree_column(node.leftChild())
    ).otherwise(tree_column(node.rightChild()))


def train(sample: DataFrame, rounds: int = 15, depth: int = 3) -> Column:
    """The margin (above 0: block) as a column over FEATURES. `sample` holds FEATURES and label 0/1."""
    counts = dict(sample.groupBy("label").count().collect())
    if len(counts) < 2:
        return F.lit(1.0 if counts and 1 in counts else -1.0)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    model = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7
    ).fit(data)
    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        margin = margin + F.lit(float(weight)) * tree_column(tree._java_obj.rootNode())
    return margin


def url_filter(
    urls: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id",
    url_col: str = "url", max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """page id, host, path, rule, verdict (allow or block) and the model's score (its margin).

    `labelled` has the columns url and label (1: to be blocked).
    """
    rows = stage(lexical(urls.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))), "urls")
    known = stage(lexical(labelled.select("url", F.col("label").cast("int").alias("label"))), "labelled")
    suffixes = stage(suffix_statistics(rows, known), "suffixes")
    sample = known.orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled)
    margin = train(stage(join_small(sample, suffixes, ["suffix"]).fillna(0.0), "sample"))
    scored = join_small(rows, suffixes, ["suffix"]).withColumn("score", margin)
    found = scored.withColumn("__rule", matching_rule(rules, F.col("host"), F.col("path")))
    learnt = F.when(F.col("score") > 0, "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", learnt).alias("verdict"), "score",
    )
