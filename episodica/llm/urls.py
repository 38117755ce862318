"""URL filter: rules first, gradient-boosted trees over lexical features for the rest.

Everything is column expressions, joins, aggregates and Spark's own
gradient-boosted trees; no Python runs on the executors.

Null urls count as empty: host and path are empty, no rule fits, the model
gives the verdict. Repeated rows are judged each. Without labelled rows, or with
one class only, the verdict is that class, or allow. Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import written

# Labelled rows that the trees are fitted on, about; counts and suffix statistics take all of them.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
# Rows of the overall rate that every suffix's rate is smoothed with.
PRIOR_ROWS = 20.0
BLOCK_AT = 0.5


@dataclass(frozen=True)
class Rule:
    """Verdict for a host with all its subdomains, where the path starts as given."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[Rule], value: str) -> Column:
    """``value`` (text or verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, value))).otherwise(out)
    return out


def _count(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in a class of a regular expression."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]", ""))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    sums = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda acc, c: acc + (n - F.length(F.replace(text, c))) * F.log2(n - F.length(F.replace(text, c))),
    )
    return F.when(n > 0, F.log2(n) - sums / n).otherwise(0.0)


LEXICAL = [
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "host_digit_ratio",
    "hyphens", "entropy", "parameters", "has_fragment", "has_extension", "encrypted",
]
SUFFIXES = ["top_suffix", "domain_suffix"]
FEATURES = LEXICAL + [f"{s}_{kind}" for s in SUFFIXES for kind in ("rate", "weight")]


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, url (not null), host and path."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))


def with_lexical(df: DataFrame) -> DataFrame:
    """Add the lexical features and the suffixes of ``with_parts``."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = _count(url, "0-9")
    labels = F.split(host, r"\.")
    return df.withColumns({
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "query_length": F.length(query).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "labels": F.size(labels).cast("double"),
        "digit_ratio": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(0.0),
        "host_digit_ratio": F.when(F.length(host) > 0, _count(host, "0-9") / F.length(host)).otherwise(0.0),
        "hyphens": _count(url, "-").cast("double"),
        "entropy": _entropy(url).cast("double"),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "has_fragment": url.contains("#").cast("double"),
        "has_extension": F.regexp_extract(path, r"\.(\w{2,5})$", 1).startswith("htm").cast("double"),
        "encrypted": url.startswith("https://").cast("double"),
        "top_suffix": F.element_at(labels, -1),
        "domain_suffix": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
    })


@dataclass(frozen=True)
class UrlModel:
    """Fitted trees (or one probability for all) with the statistics of every suffix."""

    trees: GBTClassificationModel | None
    constant: float
    suffixes: dict[str, DataFrame]
    prior: float

    def features(self, df: DataFrame) -> DataFrame:
        for s, stats in self.suffixes.items():
            df = df.join(stats, s, "left").fillna({f"{s}_rate": self.prior, f"{s}_weight": 0.0})
        return df

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``block_score`` to a table ``with_lexical``."""
        if self.trees is None:
            return df.withColumn("block_score", F.lit(self.constant))
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(self.features(df))
        return self.trees.transform(vectors).withColumn("block_score", vector_to_array("probability")[1])


def fit(labelled: DataFrame) -> UrlModel:
    """Fit on labelled urls: a table ``with_lexical`` and the column ``label`` (1: block, 0: allow)."""
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if blocked in (0, n):
        return UrlModel(None, 1.0 if blocked else 0.0, {}, 0.0)
    prior = blocked / n
    rate = (F.sum("label") + PRIOR_ROWS * prior) / (F.count("*") + PRIOR_ROWS)
    suffixes = {
        s: written(labelled.groupBy(s).agg(rate.alias(f"{s}_rate"), F.log1p(F.count("*")).alias(f"{s}_weight")), s)
        for s in SUFFIXES
    }
    model = UrlModel(None, prior, suffixes, prior)
    share = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, TRAIN_ROWS / n))
    sample = written(model.features(labelled.where(share)).select("label", *FEATURES), "url_sample")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    trees = GBTClassifier(
        labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False, checkpointInterval=-1
    ).fit(vectors.select(F.col("label").cast("double"), "features"))
    return UrlModel(trees, prior, suffixes, prior)


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (null where a rule decides) of every url.

    The urls that a rule decides are the labelled ones that the trees learn from.
    """
    host, path = F.col("host"), F.col("path")
    urls = with_lexical(
        with_parts(pages)
        .withColumn("rule", matched_rule(host, path, rules, "text"))
        .withColumn("ruled", matched_rule(host, path, rules, "verdict"))
    )
    ruled = F.col("ruled").isNotNull()
    model = fit(urls.where(ruled).withColumn("label", (F.col("ruled") == "block").cast("int")))
    by_model = F.when(F.col("block_score") >= BLOCK_AT, "block").otherwise("allow")
    return model.score(urls).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", by_model).alias("verdict"),
        F.when(~ruled, F.col("block_score")).alias("block_score"),
    )
