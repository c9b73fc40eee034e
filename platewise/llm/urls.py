"""URL filter: explicit rules on host and path, and a logistic regression on hashed character n-grams for the rest.

Features are the n-grams (``GRAMS`` characters long) of host and path, each with a mark for where it is from, hashed to
``FEATURES`` buckets; every bucket counts how often it occurs, scaled to unit length. The model is Spark's logistic regression
with an L2 penalty, trained from a labelled table whose size is bounded by ``MAX_LABELLED`` rows (more is an error). Its
coefficients are one array of ``FEATURES`` numbers, so scoring is an expression over the url: no join, no shuffle.

Rules fit their host and all its subdomains, if the path starts with the rule's path; the longest rule wins. They are a
short list given by the caller, at most ``MAX_RULES``, looked up per suffix of the host in one constant map.

Nulls and urls without ``://`` have an empty host and path; nothing speaks against them, their score is 0. Repeated
rows get the same verdict, an empty table stays empty, input columns are kept and never overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm.common import let

FEATURES = 1024
GRAMS = (3, 4)
MAX_LABELLED = 10_000
MAX_RULES = 1_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A to Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def _grams(text: Column, mark: str) -> Column:
    """Character n-grams of the text between two marks; none of an empty text."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of_length(n: int) -> Column:
        return let(marked, lambda t: F.when(
            (F.length(text) > 0) & (F.length(t) >= n),
            F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.xxhash64(F.lit(mark), F.substr(t, i, F.lit(n)))),
        ).otherwise(F.array().cast("array<bigint>")))

    return F.concat(*(of_length(n) for n in GRAMS))


def buckets(url_host: Column, url_path: Column, features: int = FEATURES) -> Column:
    """Feature buckets of a url, one per n-gram, repeats kept."""
    return F.transform(F.concat(_grams(url_host, "h"), _grams(url_path, "p")), lambda h: F.pmod(h, F.lit(features)).cast("int"))


def _norm(found: Column) -> Column:
    """Length of the vector of bucket counts."""
    ordered = F.sort_array(found)
    counts = let(ordered, lambda b: F.transform(F.array_distinct(b), lambda x: F.size(F.filter(b, lambda y: y == x))))
    return F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, n: a + n * n))


@dataclass(frozen=True)
class UrlModel:
    weights: tuple[float, ...]
    intercept: float

    def score(self, url_host: Column, url_path: Column) -> Column:
        """Probability that a url is unwanted."""
        table = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        found = buckets(url_host, url_path, len(self.weights))
        margin = let(found, lambda b: F.when(F.size(b) > 0, F.aggregate(b, F.lit(0.0), lambda a, k: a + F.get(table, k)) / _norm(b)).otherwise(F.lit(0.0)))
        return F.when(F.size(found) > 0, 1 / (1 + F.exp(-(margin + self.intercept)))).otherwise(F.lit(0.0))


def train(labelled: DataFrame, features: int = FEATURES, penalty: float = 0.0002) -> UrlModel:
    """Fit the model on a small table (url, label 0 or 1)."""
    rows = labelled.filter(F.col("label").isNotNull())
    if rows.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"the labelled table may have {MAX_LABELLED} rows at most")
    found = buckets(host(F.col("url")), path(F.col("url")), features)

    def vector(b: Column) -> Column:
        count = F.transform(F.sequence(F.lit(0), F.lit(features - 1)), lambda k: F.size(F.filter(b, lambda x: x == k)).cast("double"))
        return let(count, lambda c: let(F.greatest(F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, n: a + n * n)), F.lit(1.0)), lambda norm: F.transform(c, lambda n: n / norm)))

    points = rows.select(array_to_vector(let(found, vector)).alias("features"), F.col("label").cast("double").alias("label")).coalesce(1)
    fitted = LogisticRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=100).fit(points)
    return UrlModel(tuple(float(x) for x in fitted.coefficients), float(fitted.intercept))


def labelled_table(spark: SparkSession) -> DataFrame:
    """The library's own labelled urls."""
    from platewise.llm.url_labels import LABELLED_URLS

    rows = ", ".join(f"('{url}', {label})" for url, label in LABELLED_URLS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, label)")


def matching_rule(url_host: Column, url_path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits, null if none does."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    entries = [
        x for name, own in by_host.items()
        for x in (F.lit(name), F.array(*(F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path")) for r in own)))
    ]
    known = F.create_map(*entries)
    labels = F.split(url_host, r"\.")
    suffixes = let(labels, lambda parts: F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), ".")))
    found = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(known, s), F.array().cast("array<struct<size:int,rule:string,verdict:string,path:string>>"))))
    fitting = F.filter(found, lambda r: F.startswith(url_path, r["path"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def judge(pages: DataFrame, model: UrlModel, rules: tuple[Rule, ...], url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``pages`` with a struct ``judged`` (host, path, rule, score, verdict); a rule's verdict goes before the model's."""
    from platewise.llm.common import free_name

    name = free_name(pages.columns, "judged")
    parts = F.struct(host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))

    def verdict(p: Column) -> Column:
        return let(matching_rule(p["host"], p["path"], rules), lambda r: let(model.score(p["host"], p["path"]), lambda s: F.struct(
            p["host"].alias("host"), p["path"].alias("path"), r["rule"].alias("rule"), s.alias("score"),
            F.coalesce(r["verdict"], F.when(s >= threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        )))

    return pages.withColumn(name, let(parts, verdict))
