"""URL filters: rules by host and path, and boosted trees for the rest (DataFrame functions only).

A rule fits its host and all subdomains where the path starts with the rule's
path; the longest one wins.  URLs that no rule decides are judged by
gradient-boosted trees on lexical features: length, depth, digit ratio,
entropy, parameter counts and suffix statistics.  The statistics of a suffix
(its share of blocked URLs and how many there are) are counted over all
labelled URLs and joined to the pages; those of a training URL leave its fold
out, so that its own label is not among them.  The trees are trained from about
``MAX_ROWS`` distinct labelled URLs at most, half of them of either label,
drawn by a hash of the URL; each weighs as many rows as it stands for.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from lotline.session import cut_lineage

#: Distinct labelled URLs that the trees are trained from.
MAX_ROWS = 20_000
#: Suffixes up to which their statistics are broadcast; beyond, Spark chooses the join.
BROADCAST_SUFFIXES = 100_000
TREES, DEPTH = 12, 4
#: Folds of the training URLs; a URL's suffix statistics come from the other folds, so none sees its own label.
FOLDS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; null or without ``://``: both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule as host and path, its verdict) of the longest of ``rules`` (host, path, verdict) that fits, or nulls.

    Rules are a list given with the query, not a table; equally long ones go by code point.
    """
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # the last one that fits is outermost
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


# ------------------------------------------------------------------- features
def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    chars = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))
    bits = F.transform(F.array_distinct(chars), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(F.length(text) > 0, F.aggregate(bits, F.lit(0.0), lambda t, p: t - p * F.log2(p))).otherwise(0.0)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a URL (null: of an empty one)."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = lambda x: F.length(x).cast("double")
    return {
        "length": size(url), "host_length": size(host), "path_length": size(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"), "labels": F.when(host == "", 0.0).otherwise(_count(host, r"\.") + 1),
        "digit_ratio": F.when(size(url) > 0, _count(url, "[0-9]") / size(url)).otherwise(0.0), "host_digits": _count(host, "[0-9]"),
        "hyphens": _count(host, "-"), "entropy": _entropy(url), "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1), "fragment": F.when(url.contains("#"), 1.0).otherwise(0.0),
        "secure": F.when(url.startswith("https"), 1.0).otherwise(0.0),
    }


SUFFIX_FEATURES = ("suffix_share", "suffix_count")


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


class Model:
    """Trees, and the suffix statistics they were trained with (a written table: _s, _share, _n); with one kind of label only, that label."""

    def __init__(self, trees: PipelineModel | None, suffixes: DataFrame | None, base: float):
        self.trees, self.suffixes, self.base = trees, suffixes, base
        self.small = suffixes is not None and suffixes.count() <= BROADCAST_SUFFIXES

    def with_features(self, urls: DataFrame, url_col: str = "_url", others: DataFrame | None = None) -> DataFrame:
        """``urls`` with host, path and all features; the suffix statistics from ``others`` (by _s and the URL's _fold) if given."""
        host, path = host_and_path(F.col(url_col))
        rows = urls.withColumns({"_host": host, "_path": path})
        rows = rows.withColumns({f"_f_{k}": c for k, c in features(F.col(url_col), F.col("_host"), F.col("_path")).items()})
        if self.suffixes is None:
            return rows.withColumns({f"_f_{name}": F.lit((self.base, 0.0)[i]) for i, name in enumerate(SUFFIX_FEATURES)})
        if others is not None:
            rows = rows.withColumn("_s", suffix(F.col("_host"))).join(others, ["_s", "_fold"], "left")
        else:
            known = F.broadcast(self.suffixes) if self.small else self.suffixes
            rows = rows.join(known, suffix(F.col("_host")) == F.col("_s"), "left")
        share, n = SUFFIX_FEATURES
        return rows.withColumns({f"_f_{share}": F.coalesce("_share", F.lit(self.base)), f"_f_{n}": F.coalesce("_n", F.lit(0.0))}).drop("_s", "_share", "_n")

    def score(self, urls: DataFrame, url_col: str = "_url") -> DataFrame:
        """``urls`` with _host, _path and _score, the probability that the URL is to be blocked."""
        rows = self.with_features(urls, url_col)
        made = [c for c in rows.columns if c.startswith("_f_")]
        if self.trees is None:
            return rows.withColumn("_score", F.lit(self.base)).drop(*made)
        out = self.trees.transform(rows)
        return out.withColumn("_score", vector_to_array("probability")[1]).drop(*made, "_vector", "rawPrediction", "probability", "prediction")


def train(labelled: DataFrame, url_col: str = "url", block_col: str = "block", max_rows: int = MAX_ROWS, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> Model:
    """Trees from labelled URLs (``block_col`` boolean; rows with a null in either column are left out)."""
    rows = labelled.select(F.col(f"`{url_col}`").alias("_url"), F.col(f"`{block_col}`").alias("_block")).filter("_url is not null and _block is not null")
    blocked = F.col("_block").cast("double")
    host, _ = host_and_path(F.col("_url"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "_url", F.lit(seed)), F.lit(FOLDS))
    folds = cut_lineage(rows.groupBy(suffix(host).alias("_s"), fold.alias("_fold")).agg(F.count(F.lit(1)).alias("_n"), F.sum(blocked).alias("_b")))
    seen = cut_lineage(folds.groupBy("_s").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b")))
    total = seen.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum("_b"), F.lit(0.0)).alias("b")).first()
    if not total["n"] or total["b"] in (0, total["n"]):
        return Model(None, None, float(bool(total["n"] and total["b"])))
    base = total["b"] / total["n"]
    statistics = lambda n, b: (((b + 10 * base) / (n + 10)).alias("_share"), n.cast("double").alias("_n"))
    model = Model(None, seen.select("_s", *statistics(F.col("_n"), F.col("_b"))), base)
    # each label has its own draw, so that a rare one is met; a URL is drawn with all its rows or not at all
    if total["n"] > max_rows:
        of = {r["_block"]: r["n"] for r in rows.groupBy("_block").agg(F.approx_count_distinct("_url", 0.02).alias("n")).collect()}
        part = {label: 1.0 if sum(of.values()) <= max_rows else min(1.0, max_rows / 2 / max(1, n)) for label, n in of.items()}
        draw = F.pmod(F.xxhash64("_url", F.lit(seed)), F.lit(1 << 31))
        share = F.when(F.col("_block"), part[True]).otherwise(part[False])
        rows = rows.filter(draw < share * (1 << 31)).withColumn("_part", share)
    else:
        rows = rows.withColumn("_part", F.lit(1.0))
    sample = cut_lineage(rows.groupBy("_url", "_block").agg((F.count(F.lit(1)) / F.first("_part")).alias("_weight")))
    # a suffix that no other fold has is as unknown as a new one
    others = seen.toDF("_s", "_all", "_all_b").join(folds, "_s")
    n, b = (F.col("_all") - F.col("_n")) * (FOLDS / (FOLDS - 1)), (F.col("_all_b") - F.col("_b")) * (FOLDS / (FOLDS - 1))
    others = cut_lineage(others.select("_s", "_fold", *statistics(n, b)))
    rows = model.with_features(sample.withColumn("_fold", fold), others=others)
    rows = cut_lineage(rows.withColumn("_label", blocked).drop("_host", "_path", "_fold"))
    inputs = [c for c in rows.columns if c.startswith("_f_")]
    assemble = VectorAssembler(inputCols=inputs, outputCol="_vector")
    boost = GBTClassifier(featuresCol="_vector", labelCol="_label", weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, cacheNodeIds=False, checkpointInterval=-1)
    model.trees = PipelineModel([assemble, boost.fit(assemble.transform(rows))])
    return model


def filter_urls(pages: DataFrame, rules, model: Model, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict (``allow`` or ``block``), score.

    Null URLs and URLs without ``://`` have an empty host and path, fit no
    rule and are judged by the model like any other.  Only the two named
    columns are read; an empty table gives no rows.
    """
    rows = model.score(pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url")))
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    judged = F.when(F.col("_score") >= threshold, "block").otherwise("allow")
    return rows.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"),
                       F.coalesce(verdict, judged).alias("verdict"), F.col("_score").alias("score"))


def labelled_by_rules(pages: DataFrame, rules, url_col: str = "url") -> DataFrame:
    """(url, block) of the URLs that a rule decides: the labelled URLs that the rules give."""
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(F.col(f"`{url_col}`").cast("string").alias("url"), host.alias("_host"), path.alias("_path"))
    _, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    return rows.select("url", (verdict == "block").alias("block")).filter("block is not null")
