"""URL filter: rules by host and path, gradient-boosted trees on lexical features for all other URLs.

``lexical`` computes host, path and features with built-in expressions only. ``matched`` finds the longest rule
that fits the host or a parent domain and the start of the path. ``train`` fits boosted trees to URLs
that carry a label already (those a rule fits, or any labelled table); ``judge`` gives each URL its rule's verdict, or
else that of the trees.

A URL without ``://`` and a null URL have an empty host and path and no rule; the trees judge them like any other. If the
labelled URLs know one verdict only, it is given to all others, and ``allow`` if there are none. Repeated rows are judged
alike; very long URLs are read whole, and an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from watchlytics.llm.common import stored

ALLOW, BLOCK = "allow", "block"
#: Verdict, host and path of the rules.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
#: At most about so many distinct rows of features and verdict are fitted, each with its weight; see ``train``.
MOST_LABELLED = 200_000
TREES, DEPTH, SEED = 20, 4, 42
#: Parts of the sample that is fitted.
PARTS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "host_depth",
    "path_depth",
    "digit_ratio",
    "mark_ratio",
    "entropy",
    "parameters",
    "query_length",
    "has_fragment",
    "first_segment_length",
    "suffix_length",
    "suffix_log_count",
    "domain_log_count",
    "block_rate",
)
#: Weight of the overall share of blocked URLs in the share of a suffix and first path segment.
PRIOR_WEIGHT = 4.0


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(after, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)

    def part(c: Column) -> Column:
        share = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return -share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda x, c: x + F.when(c == "", 0.0).otherwise(part(c)))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def lexical(urls: DataFrame, url: str, prefix: str) -> DataFrame:
    """``urls`` with host, path and all features but the suffix counts, in columns that begin with ``prefix``."""
    u, host, path = F.coalesce(F.col(f"`{url}`"), F.lit("")), F.col(prefix + "host"), F.col(prefix + "path")
    size = F.length(u)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    made = {
        "url_length": size,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "host_depth": size - F.length(F.replace(u, F.lit("."), F.lit(""))),
        "path_depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "digit_ratio": (size - _without(u, "[0-9]")) / F.greatest(size, F.lit(1)),
        "mark_ratio": _without(u, "[A-Za-z0-9]") / F.greatest(size, F.lit(1)),
        "entropy": _entropy(u),
        "parameters": F.size(F.expr(f"filter(split({prefix}query, '&'), x -> x != '')")),
        "query_length": F.length(prefix + "query"),
        "has_fragment": u.contains("#").cast("int"),
        "first_segment_length": F.length(prefix + "segment"),
        "suffix_length": F.length(prefix + "suffix"),
    }
    parsed = urls.withColumns({prefix + "host": host_of(F.col(f"`{url}`")), prefix + "path": path_of(F.col(f"`{url}`"))})
    parsed = parsed.withColumns(
        {
            prefix + "query": query,
            prefix + "segment": F.regexp_extract(path, "^/([^/]*)", 1),
            prefix + "suffix": F.substring_index(host, ".", -1),
            prefix + "domain": F.substring_index(host, ".", -2),
        }
    )
    return parsed.withColumns({prefix + k: v.cast("double") for k, v in made.items()})


def suffix_statistics(parsed: DataFrame, prefix: str) -> DataFrame:
    """How many URLs each registered domain has: one row per suffix and domain, counted over all rows."""
    return parsed.groupBy(F.col(prefix + "suffix").alias("suffix"), F.col(prefix + "domain").alias("domain")).agg(F.count("*").alias("n"))


def block_rates(labelled: DataFrame, prefix: str, verdict: str) -> tuple[DataFrame, float]:
    """Share of blocked URLs per suffix and first path segment among all labelled ones, drawn towards the overall share."""
    blocked = (F.col(verdict) == BLOCK).cast("double")
    known = labelled.where(F.col(verdict).isin(ALLOW, BLOCK))
    overall = known.agg(F.coalesce(F.avg(blocked), F.lit(0.5))).first()[0]
    rate = (F.sum(blocked) + PRIOR_WEIGHT * overall) / (F.count("*") + PRIOR_WEIGHT)
    keys = (prefix + "suffix", prefix + "segment")
    found = known.groupBy(*keys).agg(rate.alias(prefix + "block_rate"))
    return stored(found, "url-rates"), overall


def with_rates(rows: DataFrame, rates: DataFrame, overall: float, prefix: str) -> DataFrame:
    """``rows`` with the block rate of their suffix and segment, the overall one where it is not known."""
    joined = rows.join(rates, [prefix + "suffix", prefix + "segment"], "left")
    return joined.withColumn(prefix + "block_rate", F.coalesce(prefix + "block_rate", F.lit(float(overall))))


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule as text and verdict of the longest fitting rule; nulls if none fits."""
    rule = verdict = None
    for kind, domain, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        rule = F.when(fits, domain + start) if rule is None else rule.when(fits, domain + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


@dataclass
class Filter:
    """Boosted trees, or the one verdict there is."""

    trees: GBTClassificationModel | None
    only: str = ALLOW


def _vectors(parsed: DataFrame, prefix: str, out: str) -> DataFrame:
    return VectorAssembler(inputCols=[prefix + f for f in FEATURES], outputCol=out).transform(parsed)


def weighted(rows: DataFrame, n: int, prefix: str, verdict: str, most: int) -> DataFrame:
    """The picked ones of ``n`` labelled rows: distinct features and label, with their weight."""
    label = (F.col(verdict) == BLOCK).cast("double").alias("label")
    made = rows.groupBy(*(F.col(prefix + f) for f in FEATURES), label).agg(F.count("*").cast("double").alias("weight"))
    if n <= most:
        return made
    least, parts = n / most, 1 << 30
    hashed = F.pmod(F.xxhash64(*(prefix + f for f in FEATURES), "label"), F.lit(parts)) / parts
    return made.where(hashed < F.col("weight") / least).withColumn("weight", F.greatest("weight", F.lit(least)))


def train(labelled: DataFrame, prefix: str, verdict: str, most: int = MOST_LABELLED) -> Filter:
    """Fit to rows with all features and a verdict (rows with a null verdict do not count).

    Equal rows are fitted once, with their number as weight. ``most`` bounds the rows fitted: of n labelled ones, a row that
    occurs n / most times or more is always fitted; rarer ones are picked by a hash, as likely as they are frequent, and weigh
    n / most. So a hot URL neither fills the bound nor goes missing, and all weights are right on average.
    """
    rows = labelled.where(F.col(verdict).isin(ALLOW, BLOCK))
    n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum((F.col(verdict) == BLOCK).cast("int")), F.lit(0))).first()
    if blocked in (0, n):
        return Filter(None, BLOCK if blocked else ALLOW)
    rows = weighted(rows, n, prefix, verdict, most)
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED)
    sample = stored(rows.repartition(PARTS), "url-training")  # bounded, so a few parts do; each tree reads them anew
    return Filter(trees.fit(_vectors(sample, prefix, "features")))


def with_features(urls: DataFrame, url: str = "url", prefix: str = "u_") -> DataFrame:
    """``urls`` with host, path and all features but the block rate, in columns that begin with ``prefix``."""
    parsed = lexical(urls, url, prefix)
    counts = stored(suffix_statistics(parsed, prefix), "url-suffixes")
    # One row per domain and one per suffix, both written: the joins shuffle both sides, so hot ones can be split, or
    # rows never move if the counts are small.
    domains = counts.select(F.col("domain").alias(prefix + "domain"), F.log1p("n").alias(prefix + "domain_log_count"))
    suffixes = counts.groupBy(F.col("suffix").alias(prefix + "suffix")).agg(F.log1p(F.sum("n")).alias(prefix + "suffix_log_count"))
    suffixes = stored(suffixes, "url-suffixes")
    return parsed.join(domains, prefix + "domain").join(suffixes, prefix + "suffix")


def judge(urls: DataFrame, url: str = "url", rules=RULES, most: int = MOST_LABELLED) -> DataFrame:
    """``urls`` with host, path, rule and verdict; columns of these names are replaced.

    The trees are trained on the URLs that a rule fits.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in urls.columns if c.lower() not in added or c == url]
    prefix = "u_"
    while any(c.lower().startswith(prefix) for c in urls.columns):
        prefix = "u" + prefix
    rows = with_features(urls.select(*(F.col(f"`{c}`") for c in kept)), url, prefix)
    rule, verdict = matched(F.col(prefix + "host"), F.col(prefix + "path"), rules)
    rows = rows.withColumns({prefix + "rule": rule, prefix + "verdict": verdict})
    rows = with_rates(rows, *block_rates(rows, prefix, prefix + "verdict"), prefix)
    model = train(rows, prefix, prefix + "verdict", most)
    if model.trees is None:
        other = F.lit(model.only)
    else:
        vectors, predicted = prefix + "vector", prefix + "predicted"
        model.trees.setFeaturesCol(vectors).setPredictionCol(predicted)
        model.trees.setRawPredictionCol(prefix + "raw").setProbabilityCol(prefix + "probability")
        rows = model.trees.transform(_vectors(rows, prefix, vectors))
        other = F.when(F.col(predicted) == 1.0, BLOCK).otherwise(ALLOW)
    return rows.select(
        *(F.col(f"`{c}`") for c in kept),
        F.col(prefix + "host").alias("host"),
        F.col(prefix + "path").alias("path"),
        F.col(prefix + "rule").alias("rule"),
        F.coalesce(F.col(prefix + "verdict"), other).alias("verdict"),
    )
