"""URL filter: host and path rules first, then gradient-boosted trees.

Rules are a bounded list (a parameter, a literal in the plan); URLs that a rule
fits are the labelled ones. Trees are trained on lexical features of a bounded
sample of distinct ones: lengths, depth, digit ratio, entropy, parameter counts, and the
share of blocked URLs among all labelled ones with the same suffix. All
features are SQL expressions, so the pass over the table stays in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.joins import broadcast_if_small
from adlens.llm.common import read, save

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``pattern``: host, then path from the first slash on."""
    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


RULES = (
    UrlRule("org/", "allow"),
    UrlRule("example.org/es/", "block"),
    UrlRule("example.org/en/1", "block"),
    UrlRule("com/fr/", "allow"),
    UrlRule("com/de/", "block"),
)
# Bound of the sample that the trees are fitted to, and the trees grown on it.
# The suffix statistics count every labelled URL.
TRAIN_URLS = 20_000
TREES = 20
DEPTH = 4
SUFFIX_PRIOR = 20.0      # labelled URLs of mean rate added to each suffix


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.split(url, "://", 2)[1], "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    known = F.instr(url, "://") > 0
    return F.when(known, F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    tail = F.regexp_extract(F.split(url, "://", 2)[1], r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, tail).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest fitting rule as struct(length, pattern, verdict), or null.

    Of equally long ones (they then are one pattern with two verdicts) block wins.
    """
    if not rules:
        return F.lit(None).cast("struct<length:int,pattern:string,verdict:string>")
    listed = F.array(*[F.struct(
        F.lit(len(r.pattern)).alias("length"), F.lit(r.pattern).alias("pattern"),
        F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"),
        F.lit(r.path).alias("path")) for r in rules])
    fitting = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(
        host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(
        r["length"].alias("length"), r["pattern"].alias("pattern"),
        r["verdict"].alias("verdict"))))


def _count(text: Column, what: str) -> Column:
    return F.regexp_count(text, F.lit(what))


def _entropy(text: Column) -> Column:
    """Bits a character, of the distribution of the characters."""
    n = F.length(text)
    chars = F.split(text, "")
    each = F.transform(F.array_distinct(chars), lambda c: F.size(
        F.filter(chars, lambda x: x == c)) / n)
    bits = F.aggregate(each, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    values = {
        "url_length": F.length(url), "host_length": F.length(host),
        "path_length": F.length(path), "labels": _count(host, r"[^.]+"),
        "depth": _count(path, r"[^/]+"), "digit_ratio": _count(url, "[0-9]") / n,
        "host_digits": _count(host, "[0-9]"), "hyphens": _count(host, "-"),
        "letter_ratio": _count(url, "[A-Za-z]") / n,
        "parameters": _count(query, r"[^&]+"), "query_length": F.length(query),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": F.startswith(F.lower(url), F.lit("https://")).cast("int"),
        "longest_part": F.coalesce(F.array_max(F.transform(
            F.split(F.concat(host, path), "[./-]"), lambda x: F.length(x))), F.lit(0)),
        "host_entropy": _entropy(host), "path_entropy": _entropy(path),
    }
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()}


# Suffix statistics: the host's last label and last two labels, the first part
# of the path, and the file extension.
SUFFIXES = ("tld", "domain", "first_part", "extension")


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    return {
        "tld": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2),
        "first_part": F.regexp_extract(path, r"^/([^/]*)/", 1),
        "extension": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
    }


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, url_col: str = "url",
               id_col: str = "page_id", train_urls: int = TRAIN_URLS,
               learn_from: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row.

    ``score``: the trees' probability of block, for every row; the verdict is
    the rule's where one fits, else block from a score of 0.5. Null urls and
    urls without ``://`` have empty host and path and are judged by the trees;
    repeated rows are judged alike; null ids keep their rows; long urls count
    whole. If the labelled URLs do not hold both verdicts, the score is the
    only verdict's, or 0 without any (allow). An empty table gives no rows.

    The trees are fitted to at most ``train_urls`` distinct URLs, half of them of
    each verdict as far as there are any; a URL weighs as often as it occurs, and
    each verdict as often as it does among all labelled rows. ``learn_from``: a
    condition on ``url``; others are judged but not learnt from.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    url = F.col("url")
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    base = base.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    base = base.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    found = lexical(url, F.col("host"), F.col("path"))
    ends = suffixes(F.col("host"), F.col("path"))
    taught = base if learn_from is None else base.where(learn_from)
    labelled = taught.where(F.col("fit").isNotNull()).withColumn(
        "label", (F.col("fit.verdict") == "block").cast("double"))
    counts = save(suffix_counts(labelled.select("label", *[
        c.alias(k) for k, c in ends.items()])), "url_suffixes")
    # every labelled row has one suffix of each kind
    rows, blocked = counts.where(F.col("kind") == SUFFIXES[0]).agg(
        F.sum("n"), F.sum("blocked")).first()
    mean = blocked / rows if rows else 0.0
    result = base.select("id", "host", "path", "fit", *[c.alias(k) for k, c in found.items()],
                         *[c.alias(k) for k, c in ends.items()])
    if not rows or blocked in (0, rows):
        scored = result.withColumn("score", F.lit(float(mean)))
    else:
        # the sample: distinct labelled urls of smallest hash, of either verdict
        distinct = labelled.groupBy("url").agg(F.first("label").alias("label"),
                                               F.count(F.lit(1)).alias("times"))
        halves = [distinct.where(F.col("label") == v).orderBy(F.xxhash64("url"), "url").limit(
            max(1, train_urls // 2)) for v in (0, 1)]
        names = [F.col("label"), F.col("times"), *[c.alias(k) for k, c in found.items()],
                 *[c.alias(k) for k, c in ends.items()]]
        sample = save(halves[0].unionAll(halves[1]).withColumn(
            "host", host_of(url)).withColumn("path", path_of(url)).select(*names), "url_sample")
        have = {r["label"]: r["n"] for r in sample.groupBy("label").agg(
            F.sum("times").alias("n")).collect()}
        sample = sample.withColumn("weight", F.col("times") * F.when(
            F.col("label") == 1, blocked / have[1.0]).otherwise((rows - blocked) / have[0.0]))
        names = list(found)
        for k in SUFFIXES:
            rates = counts.where(F.col("kind") == k).select(
                F.col("suffix").alias(f"{k}_key"),
                ((F.col("blocked") + SUFFIX_PRIOR * mean)
                 / (F.col("n") + SUFFIX_PRIOR)).alias(f"{k}_rate"))
            rates = broadcast_if_small(rates)
            sample = _with_rate(sample, rates, k, mean)
            result = _with_rate(result, rates, k, mean)
            names.append(f"{k}_rate")
        assembler = VectorAssembler(inputCols=names, outputCol="features")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, labelCol="label",
                              featuresCol="features", weightCol="weight", cacheNodeIds=False)
        model = trees.fit(assembler.transform(sample).select("label", "weight", "features"))
        scored = model.transform(assembler.transform(result)).withColumn(
            "score", vector_to_array("probability")[1])
    verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path",
                         F.col("fit.pattern").alias("rule"),
                         F.coalesce(F.col("fit.verdict"), verdict).alias("verdict"), "score")


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(kind, suffix, n, blocked): all labelled rows of each suffix, and how many
    of them are blocked. One shuffle of counts that are combined before it."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("suffix"))
                               for k in SUFFIXES]))
    return labelled.select("label", each.alias("s")).groupBy("s.kind", "s.suffix").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("blocked"))


def _with_rate(df: DataFrame, rates: DataFrame, key: str, mean: float) -> DataFrame:
    return df.join(rates, F.col(key) == F.col(f"{key}_key"), "left").drop(
        f"{key}_key").withColumn(f"{key}_rate", F.coalesce(f"{key}_rate", F.lit(mean)))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts on all ``pages``, by ``judge_urls``."""
    return judge_urls(read(spark, sf_dir, "pages"))
