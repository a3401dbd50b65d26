r"""URL filters: given rules first, then gradient-boosted trees on lexical features.

Rules are a short list of (verdict, host/path).  A rule fits its host and all
subdomains if the path starts with the rule's; the longest fitting rule decides.

URLs that no rule fits are judged by gradient-boosted trees.  They are trained
on labelled URLs (here those that a rule labels): at most ``TRAIN_ROWS`` distinct
ones, chosen by hash, the same at every size.  Features: length of url, host and
path, depth, labels, parameters, digit ratio, entropy of the characters,
hyphens, ``www``, scheme, file suffix, and statistics of the host's last one
and two labels.  Suffix statistics count all labelled URLs, not the sample, for
each suffix by itself.  Those of the ``SUFFIX_SLOTS`` suffixes with most
labelled URLs have a table of a fixed size, which may be broadcast; only URLs whose
suffix is not in it are joined with the others by suffix, and suffixes that hold
many of these URLs stay out of the shuffle's keys (``join_hot``).  A labelled URL's own label is left out of its statistics.

Defined cases: a null URL has empty host and path; repeated rows are judged alike,
each by itself; URLs of any length are read whole; no rows give no rows; other
columns are not read; without labelled URLs of both
verdicts the method answers with the only verdict there is, or ``allow``.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm.common import lower_ascii, read_table, written
from conewise.operators.hot_keys import hot_keys, join_hot

#: The rules of the query, as (verdict, rule).
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
#: Labelled URLs that the trees are trained on at most.
TRAIN_ROWS = 20_000
#: Suffixes, of one label and of two each, whose statistics are broadcast; the others' are joined.
SUFFIX_SLOTS = 4096
TREES = 12
DEPTH = 4
#: A URL is blocked from this probability on.
BLOCK_FROM = 0.5

FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_parameters", "f_digits", "f_entropy",
            "f_host_entropy", "f_hyphens", "f_www", "f_https", "f_fragment", "f_extension", "f_rate_1", "f_count_1", "f_rate_2", "f_count_2"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.substring(text, F.instr(text, "://") + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for answer, text in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(answer)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits a character, from the counts of the distinct characters."""
    n = F.length(text)

    def bits(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    chars = F.array_distinct(F.split(text, ""))
    return F.when(n > 0, F.round(F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a + bits(c)), 6)).otherwise(0.0)


def _suffix(host: Column, labels: int) -> Column:
    """The host's last labels."""
    return F.substring_index(host, ".", -labels)


def featured(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path and the features that need the URL alone."""
    host, path = host_and_path(F.col(url))
    u = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    per = lambda n, of: F.when(F.length(of) > 0, n / F.length(of)).otherwise(0.0)
    return (
        pages.withColumns({"host": host, "path": path})
        .withColumns({
            "f_length": F.length(u), "f_host_length": F.length("host"), "f_path_length": F.length("path"),
            "f_depth": F.regexp_count("path", F.lit("/[^/]")), "f_labels": F.regexp_count("host", F.lit(r"[^.]+")),
            "f_parameters": F.regexp_count(query, F.lit(r"[^&;]+")), "f_digits": per(F.regexp_count(u, F.lit("[0-9]")), u),
            "f_entropy": entropy(u), "f_host_entropy": entropy(F.col("host")), "f_hyphens": F.regexp_count("host", F.lit("-")),
            "f_www": F.startswith("host", F.lit("www.")).cast("int"), "f_https": F.startswith(u, F.lit("https:")).cast("int"),
            "f_fragment": F.contains(u, F.lit("#")).cast("int"),
            "f_extension": F.length(F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1)),
            "suffix_1": _suffix(F.col("host"), 1), "suffix_2": _suffix(F.col("host"), 2)})
    )


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(labels, suffix, n, blocked): labelled URLs of each suffix."""
    each = labelled.select("blocked", F.inline(F.array(*[
        F.struct(F.lit(k).alias("labels"), F.col(f"suffix_{k}").alias("suffix")) for k in (1, 2)])))
    return each.groupBy("labels", "suffix").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked"))


def commonest(counts: DataFrame) -> DataFrame:
    """The rows of ``counts`` with most labelled URLs; at most 2 * SUFFIX_SLOTS rows."""
    one, two = (counts.filter(F.col("labels") == k).orderBy(F.desc("n"), "suffix").limit(SUFFIX_SLOTS) for k in (1, 2))
    return one.unionByName(two)


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """``suffix_counts`` of the commonest suffixes."""
    return commonest(suffix_counts(labelled))


def with_statistics(rows: DataFrame, statistics: DataFrame, own: bool, others: DataFrame | None = None) -> DataFrame:
    """Smoothed block rate and log count of each suffix; ``own`` takes the row's label out of them.

    ``statistics`` are those of the commonest suffixes, ``others`` those of all other suffixes, if there are any.
    """
    for k in (1, 2):
        of = lambda table, mark: table.filter(F.col("labels") == k).select(  # noqa: B023, E731
            F.col("suffix").alias(f"suffix_{k}"), F.col("n").alias(f"n{mark}"), F.col("blocked").alias(f"b{mark}"))  # noqa: B023
        # at most SUFFIX_SLOTS rows, whatever the input
        rows = rows.join(F.broadcast(of(statistics, "_hot")), f"suffix_{k}", "left")
        rest = others is not None and of(others, "_rest")
        if rest and not rest.isEmpty():
            met = rows.filter("n_hot is not null").withColumns({"n_rest": F.lit(None).cast("long"), "b_rest": F.lit(None).cast("long")})
            rows = rows.filter("n_hot is null")
            rows = join_hot(rows, rest, [f"suffix_{k}"], hot_keys(rows, [f"suffix_{k}"]), "left").unionByName(met)
        else:
            rows = rows.withColumns({"n_rest": F.lit(None).cast("long"), "b_rest": F.lit(None).cast("long")})
        n, b = F.coalesce("n_hot", "n_rest", F.lit(0)), F.coalesce("b_hot", "b_rest", F.lit(0))
        if own:
            n, b = n - 1, b - F.col("blocked")
        rows = rows.withColumns({
            f"f_rate_{k}": (b + 1) / (n + 2), f"f_count_{k}": F.floor(F.log2(n + 1.0))}).drop("n_hot", "b_hot", "n_rest", "b_rest")
    return rows


def train(labelled: DataFrame, statistics: DataFrame, rows: int = TRAIN_ROWS, others: DataFrame | None = None) -> GBTClassificationModel | None:
    """Trees from a sample of distinct labelled URLs by hash, or None if there are not both verdicts."""
    distinct = labelled.groupBy("url").agg(F.min("blocked").alias("blocked"))
    sample = written(distinct.orderBy(F.xxhash64("url"), "url").limit(rows).coalesce(1), "url-sample")
    if len(sample.select("blocked").distinct().take(2)) < 2:
        return None
    ready = with_statistics(featured(sample), statistics, own=True, others=others)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(ready).select(
        "features", F.col("blocked").cast("double").alias("label"))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=7).fit(vectors)


def judged(pages: DataFrame, rules: list[tuple[str, str]], rows: int = TRAIN_ROWS) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict and the trees' block probability (null where a rule decides)."""
    base = featured(pages.select("page_id", "url"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "by_rule": verdict})
    labelled = base.filter(F.col("rule").isNotNull()).select(
        "url", "suffix_1", "suffix_2", (F.col("by_rule") == "block").cast("int").alias("blocked"))
    counts = written(suffix_counts(labelled), "suffix-counts")
    statistics = written(commonest(counts), "suffix-statistics")
    others = written(counts.join(F.broadcast(statistics), ["labels", "suffix"], "left_anti"), "other-suffixes")
    others = None if others.isEmpty() else others
    model = train(labelled, statistics, rows, others)
    out = ["page_id", "host", "path", "rule"]
    if model is None:
        seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
        only = "block" if seen[0] and seen[0] == seen[1] else "allow"
        return base.select(*out, F.coalesce("by_rule", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    ruled = base.filter(F.col("rule").isNotNull()).select(*out, F.col("by_rule").alias("verdict"), F.lit(None).cast("double").alias("score"))
    free = with_statistics(base.filter(F.col("rule").isNull()), statistics, own=False, others=others)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(free)).withColumn(
        "score", vector_to_array("probability")[1])
    return ruled.unionByName(scored.select(
        *out, F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow").alias("verdict"), "score"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "pages"), RULES)
