"""URL filters: listed rules first, gradient-boosted trees for the rest.

A rule (host, path) fits its host and all subdomains where the url's path starts
with the rule's; the longest fitting rule decides.  Urls that rules decide are
the labels from which the trees learn to judge the others.

The features are lexical and computed by column expressions: lengths, depth,
digit ratio, entropy of the characters, parameter counts, and statistics of the
host's suffix (how many labelled urls have it, and which share of them is
blocked, drawn towards the overall share), counted over all labelled urls and
joined on.  The trees are fitted on a sample of the labelled urls whose expected
size is the parameter `fit_rows`; the sample is chosen by a hash, so reruns
agree.  Scoring is one pass over all urls.

Defined cases: a null url, or one without `://`, has an empty host and path and
fits no rule; where no rule fits any url there is nothing to learn from and the
verdict is `allow`; where all labels agree, theirs is the verdict; repeated rows
are judged alike; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)
FIT_ROWS = 20_000
TREES, DEPTH, BINS, STEP, SEED = 10, 4, 32, 0.3, 17
#: A suffix counts as much as this many urls of the overall share more than it has.
DRAWN = 20.0

FEATURES = [
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio",
    "entropy", "host_entropy", "parameters", "query_length", "hyphens", "longest_label", "suffix_rows", "suffix_share",
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _SPLIT, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def deciding_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest fitting rule; null where none fits."""
    # The longest comes first; among equals the longer host, then a block.
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block"))
    fitting = [
        F.when(((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
               F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in ordered
    ]
    return F.coalesce(*fitting, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def entropy(text: Column) -> Column:
    """Bits a character."""
    characters = F.split(text, "")
    n = F.length(text)
    logs = F.aggregate(
        F.array_distinct(characters), F.lit(0.0),
        lambda total, c: total + _plogp(F.try_divide(
            (F.length(text) - F.length(F.replace(text, c))).cast("double"), n)))
    return F.when(n > 0, -logs).otherwise(0.0)


def _plogp(p: Column) -> Column:
    return F.when(p > 0, p * F.log2(p)).otherwise(0.0)


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", ""))


def lexical(rows: DataFrame) -> DataFrame:
    """rows (url, host, path) with the features of the text itself."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.coalesce(F.regexp_extract(F.col("url"), r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    labels = F.split(host, r"\.")
    parameters = F.size(F.filter(F.split(query, "[&;]"), lambda p: p != ""))
    lengths = F.transform(labels, F.length)
    return rows.withColumns({
        "suffix": F.element_at(labels, -1),
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "host_depth": F.size(labels), "path_depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")),
        "digit_ratio": _share(_digits(url), F.length(url)), "host_digit_ratio": _share(_digits(host), F.length(host)),
        "entropy": entropy(url), "host_entropy": entropy(host), "parameters": parameters,
        "query_length": F.length(query), "hyphens": F.length(url) - F.length(F.replace(url, F.lit("-"))),
        "longest_label": F.array_max(lengths),
    })


@dataclass
class UrlModel:
    """Trees and suffix statistics; or, where the labels agree, one verdict for all."""

    only: str | None
    share: float = 0.0
    suffixes: DataFrame | None = None
    trees: GBTClassificationModel | None = None

    def with_suffixes(self, rows: DataFrame) -> DataFrame:
        known = self.suffixes.withColumnRenamed("suffix", "known")
        return rows.join(known, rows["suffix"] == known["known"], "left").drop("known").withColumns({
            "suffix_rows": F.coalesce("suffix_rows", F.lit(0)), "suffix_share": F.coalesce("suffix_share", F.lit(self.share))})

    def judge(self, rows: DataFrame) -> DataFrame:
        """rows with features (see lexical) and the verdict of the model."""
        if self.trees is None:
            return rows.withColumn("judged", F.lit(self.only))
        scored = self.trees.transform(assembled(self.with_suffixes(rows)))
        return scored.withColumn("judged", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def train(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> UrlModel:
    """A model from rows (url, host, path, verdict) with their lexical features."""
    blocked = (F.col("verdict") == "block").cast("double")
    n, n_blocked = labelled.agg(F.count("*"), F.sum(blocked)).first()
    if not n or n_blocked in (0.0, float(n)):
        return UrlModel("block" if n and n_blocked else "allow")
    share = n_blocked / n
    suffixes = staging.stage(labelled.groupBy("suffix").agg(
        F.count("*").alias("suffix_rows"),
        ((F.sum(blocked) + DRAWN * share) / (F.count("*") + DRAWN)).alias("suffix_share")), "suffixes")
    model = UrlModel(None, share, suffixes)
    chance = F.pmod(F.xxhash64(F.lit("fit"), "url"), F.lit(1 << 40)) / float(1 << 40)
    sample = assembled(model.with_suffixes(labelled.filter(chance < fit_rows / n))) \
        .select("features", blocked.alias("label"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, stepSize=STEP, seed=SEED)
    model.trees = trees.fit(staging.stage(sample, "urls").coalesce(8))
    return model


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url",
          fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of pages: page_id, host, path, rule, verdict, by_rule."""
    text = F.col("url")
    rows = pages.select(staging.quoted(key).alias("page_id"), staging.quoted(url).cast("string").alias("url")) \
        .withColumns({"host": host_of(text), "path": path_of(text)}) \
        .withColumn("decided", deciding_rule(F.col("host"), F.col("path"), rules))
    rows = lexical(rows).select("*", "decided.rule", "decided.verdict").drop("decided")
    model = train(rows.filter("verdict IS NOT NULL"), fit_rows)
    return model.judge(rows).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "judged").alias("verdict"),
        F.col("rule").isNotNull().alias("by_rule"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every page of the table."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
