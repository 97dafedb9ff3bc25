"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the urls no rule decides.

The trees learn from labelled urls -- by default those that the rules decide -- and see only what the url looks like:
its length, depth, share of digits, entropy, parameters, and statistics of its host's suffix. Everything is DataFrame
expressions and Spark's own tree learner; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, sized

#: (verdict, rule): a rule is a host and a path prefix.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Labelled urls that the trees are fitted on, about: those whose ids' hash falls into a share of so many.
SAMPLE = 100_000
TREES, DEPTH = 10, 3
FEATURES = ("length", "depth", "digits", "entropy", "parameters", "path_length", "host_labels", "longest_label", "hyphens", "suffix_log_count", "suffix_blocked")


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): empty if the url is null or has no '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does. A rule fits its host and all subdomains when
    the path starts with the rule's path."""
    rule = verdict = F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    """Features of the url's text; characters beyond ASCII count as one kind in the entropy."""
    size = F.greatest(F.length(url), F.lit(1))
    ascii_only = F.regexp_replace(url, r"[^\x00-\x7F]", "\u0080")
    kinds = F.array_distinct(F.split(ascii_only, ""))
    shares = F.transform(F.filter(kinds, lambda c: c != ""), lambda c: (F.length(ascii_only) - F.length(F.replace(ascii_only, c, F.lit("")))) / size)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return [
        F.length(url).cast("double").alias("length"), (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double").alias("depth"),
        (F.length(F.regexp_replace(url, r"[^0-9]", "")) / size).alias("digits"), F.aggregate(shares, F.lit(0.0), lambda s, x: s - x * F.log2(x)).alias("entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "[&;]")).cast("double")).alias("parameters"), F.length(path).cast("double").alias("path_length"),
        F.size(F.split(host, r"\.")).cast("double").alias("host_labels"), F.array_max(F.transform(F.split(host, r"\."), lambda x: F.length(x))).cast("double").alias("longest_label"),
        (F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit("")))).cast("double").alias("hyphens")]


def url_verdicts(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", sample: int = SAMPLE) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``labelled`` (url, verdict allow or block; others ignored) teaches the trees; without it the urls that a rule
    decides do. If they are all of one verdict, that one is given; if there are none, allow. Null and empty urls have
    empty host and path. Repeated rows and null ids are kept; other columns are ignored; an empty table gives no rows.
    """
    def described(df: DataFrame, *more: Column) -> DataFrame:
        host, path = parts(F.col("url"))
        return df.withColumns({"host": host, "path": path}).select(*more, "host", "path", *lexical(F.coalesce("url", F.lit("")), F.col("host"), F.col("path")),
                                                                   F.regexp_extract("host", r"[^.]*$", 0).alias("suffix"))

    own = described(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")), F.col("page_id"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = save(own.withColumns({"rule": rule, "by_rule": verdict}), "urls")
    if labelled is None:
        known = own.where("by_rule is not null").withColumn("label", (F.col("by_rule") == "block").cast("double")).withColumn("key", F.xxhash64("page_id"))
    else:
        known = described(labelled.where("verdict in ('allow', 'block')").select(F.col("url").cast("string").alias("url"), "verdict"), F.col("verdict"), F.xxhash64("url").alias("key"))
        known = known.withColumn("label", (F.col("verdict") == "block").cast("double"))
    n, blocked = known.agg(F.count("*"), F.sum("label")).first()
    out = ["page_id", "host", "path", "rule"]
    if not n or blocked in (0, n):
        other = F.lit("block" if n and blocked else "allow")
        return own.select(*out, F.coalesce("by_rule", other).alias("verdict"))
    marks = known.groupBy("suffix").agg(F.count("*").alias("seen"), F.sum("label").alias("blocked"))
    suffixes = own.groupBy("suffix").agg(F.count("*").alias("urls")).join(marks, "suffix", "full").select(
        "suffix", F.log1p(F.coalesce("urls", F.lit(0))).alias("suffix_log_count"),
        ((F.coalesce("blocked", F.lit(0.0)) + blocked / n) / (F.coalesce("seen", F.lit(0)) + 1)).alias("suffix_blocked"))
    suffixes = sized(save(suffixes, "suffixes"), 64, "suffix")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = known.where(F.pmod("key", F.lit(max(1, -(-n // sample)))) == 0).join(suffixes, "suffix")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(vectors.transform(train.select("label", *FEATURES)))
    judged = model.transform(vectors.transform(own.join(suffixes, "suffix", "left")))
    return judged.select(*out, F.coalesce("by_rule", F.when(F.col("prediction") == 1, "block").otherwise("allow")).alias("verdict"))
