"""URL filter: host and path rules first, a character language-model ratio for the rest.

Two variable-order Markov models over characters, one of accepted and one of
rejected URLs (those the rules decide), give each character a probability after its
last three characters, smoothed by Witten-Bell interpolation down to the uniform
distribution. A URL's score is the difference of its two log-likelihoods divided by
its length. The threshold is calibrated on the fifth of the decided URLs that the
models have not seen, as the one with the least balanced error.

Everything is DataFrame functions: n-grams by ``explode``, counts by a grouped
aggregate with map-side sums, the recursion by one small join an order, scoring by
a join with the table of 4-grams. Characters are folded to ``SYMBOLS`` symbols, so
that table has at most ``SYMBOLS ** ORDER`` (about a million) rows whatever the
input; this is the bound under which it is broadcast.

Edge cases: a null url or one without ``://`` has empty host and path and is scored
as the empty string; repeated rows are returned as often as they come; very long
urls are scored whole; extra columns are ignored; if the rules accept none or reject
none, nothing can be learnt and what they leave open is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.session import materialize

# (verdict, host/path) rules of the query; the longest that fits wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 4
# a-z, 0 for any digit, . / - and ~ for any other, ^ at the start and $ at the end.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 33
# Every so many decided URLs, by hash, one calibrates and does not train.
CALIBRATE = 5
BIN = 0.01


def lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, LETTERS.upper(), LETTERS)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased) and path; both empty for a null url or one without ``://``."""
    parts = r"://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, parts, k), F.lit(""))
    return lower(part(1)), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for answer, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, answer).otherwise(verdict)
    return rule, verdict


def symbols(host: Column, path: Column) -> Column:
    """Folded characters between the start mark and the end mark."""
    folded = F.regexp_replace(lower(F.concat(host, path)), "[0-9]", "0")
    return F.concat(F.lit("^"), F.regexp_replace(folded, "[^a-z0./-]", "~"), F.lit("$"))


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _grams(marks: Column) -> Column:
    """For each symbol but the start mark: the n-gram that ends there, as long as ORDER allows."""
    return F.transform(F.sequence(F.lit(2), F.length(marks)),
                       lambda i: F.substring(marks, F.greatest(i - ORDER + 1, F.lit(1)), F.least(i, F.lit(ORDER))))


def gram_scores(urls: DataFrame) -> DataFrame:
    """(gram, accepted, rejected): log-probability of each full-length n-gram's last symbol in both models.

    ``urls`` has ``marks`` and ``learn`` ('allow', 'block' or null); n-grams of URLs
    that teach nothing are in the table too, so every n-gram has a row.
    """
    ends = urls.select("learn", F.explode(_grams(F.col("marks"))).alias("full"))
    full = ends.groupBy("full").agg(F.sum(F.when(F.col("learn") == "allow", 1).otherwise(0)).alias("a"),
                                    F.sum(F.when(F.col("learn") == "block", 1).otherwise(0)).alias("r"))
    full = materialize(full, "url_grams")
    suffixes = F.transform(F.sequence(F.lit(1), F.length("full")),
                           lambda k: F.substring(F.col("full"), F.length("full") - k + 1, k))
    grams = (full.select("a", "r", F.explode(suffixes).alias("gram")).groupBy("gram")
             .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
             .withColumn("k", F.length("gram")).withColumn("context", F.expr("left(gram, k - 1)")))
    beside = Window.partitionBy("context")
    sums = [F.sum(c).over(beside).alias(f"n_{c}") for c in "ar"] + \
           [F.sum(F.signum(F.col(c).cast("double"))).over(beside).alias(f"t_{c}") for c in "ar"]
    grams = materialize(grams.select("gram", "k", "a", "r", *sums), "url_counts")
    mixed = lambda c, base: (F.col(c) + F.col(f"t_{c}") * base) / F.greatest(F.col(f"n_{c}") + F.col(f"t_{c}"), F.lit(1.0))
    seen = lambda c, base: F.when(F.col(f"n_{c}") > 0, mixed(c, base)).otherwise(base)
    uniform = F.lit(1.0 / SYMBOLS)
    level = grams.where("k = 1").select("gram", seen("a", uniform).alias("p_a"), seen("r", uniform).alias("p_r"))
    tables = [level]
    for k in range(2, ORDER + 1):
        shorter = level.withColumnsRenamed({"gram": "shorter"})
        level = (grams.where(F.col("k") == k).withColumn("shorter", F.expr(f"right(gram, {k - 1})")).join(shorter, "shorter")
                 .select("gram", seen("a", F.col("p_a")).alias("p_a"), seen("r", F.col("p_r")).alias("p_r")))
        tables.append(level)
    every = reduce(DataFrame.unionAll, tables)
    return every.select("gram", F.log("p_a").alias("accepted"), F.log("p_r").alias("rejected"))


def score_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict of the rule, marks, score, calibrates, copies) of each distinct (page_id, url)."""
    host, path = split_url(F.col("url"))
    urls = (pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("copies"))
            .withColumn("host", host).withColumn("path", path))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = (urls.withColumn("rule", rule).withColumn("decided", verdict).withColumn("marks", symbols(F.col("host"), F.col("path")))
            .withColumn("calibrates", F.col("decided").isNotNull() & (_hash(F.col("marks")) % CALIBRATE == 0)))
    urls = materialize(urls.drop("url").withColumn("row", F.monotonically_increasing_id()), "urls")
    learn = F.when(~F.col("calibrates"), F.col("decided"))
    table = gram_scores(urls.select("marks", learn.alias("learn")))
    # At most SYMBOLS ** ORDER rows of a short string and two numbers.
    ends = urls.select("row", F.explode(_grams(F.col("marks"))).alias("gram")).join(F.broadcast(table), "gram")
    scores = ends.groupBy("row").agg((F.sum(F.col("accepted") - F.col("rejected")) / F.count("*")).alias("score"))
    return urls.join(scores, "row").drop("row")


def threshold_of(scored: DataFrame) -> float | None:
    """Score with the least balanced error on the calibrating URLs; None if a class is missing.

    Scores are counted in bins, so a bounded number of rows is compared.
    """
    bins = (scored.where("calibrates").withColumn("bin", F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") / BIN))))
            .groupBy("bin").agg(F.sum(F.when(F.col("decided") == "allow", F.col("copies")).otherwise(0)).alias("a"),
                                F.sum(F.when(F.col("decided") == "block", F.col("copies")).otherwise(0)).alias("r")))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    error = (F.coalesce(F.sum("a").over(below), F.lit(0)) / F.sum("a").over(everything)
             + 1 - F.coalesce(F.sum("r").over(below), F.lit(0)) / F.sum("r").over(everything))
    usable = (F.sum("a").over(everything) > 0) & (F.sum("r").over(everything) > 0)
    best = bins.select((F.col("bin") * BIN).alias("at"), F.when(usable, error).alias("error")).agg(
        F.min_by("at", F.struct("error", F.abs("at"))).alias("at"), F.min("error").alias("error")).first()
    return None if best["error"] is None else float(best["at"])


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else the models'."""
    scored = materialize(score_urls(pages, rules), "url_scores")
    threshold = threshold_of(scored)
    guess = F.when(F.col("score") >= (F.lit(threshold) if threshold is not None else F.lit(float("-inf"))), "allow").otherwise("block")
    once = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return (scored.withColumn("verdict", F.coalesce("decided", guess)).withColumn("_copy", once)
            .select("page_id", "host", "path", "rule", "verdict", "score"))
