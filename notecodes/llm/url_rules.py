"""URL filtering by association rules (operator 4). Built-in functions and Spark's FP-growth only.

* Stated rules (host and path beginnings, allow or block) judge the urls that they fit;
  the longest one wins. Their verdicts label those urls.
* Tokens (host labels, domain, path segments, file type, query names) that occur in the same labelled urls are one
  class: any of them says as much as all of them, so combinations inside a class are not mined.
* FP-growth mines combinations of token classes with the labels over all labelled urls. Rules
  ``tokens -> allow`` or ``tokens -> block`` of at least ``LEAST_CONFIDENCE`` and
  ``LEAST_SUPPORT`` are kept, without those that a rule on fewer of their tokens
  already makes with the same confidence.
* Urls without a stated rule are matched by an inverted index, class -> rules: a
  rule fits when a token of each of its classes is in the url. The most confident one gives the
  verdict (then more support, more tokens, first by name); without one it is the
  more frequent label.

Urls of equal class sets are matched once. Frequent items and rules are bounded by the
support threshold (a share of the labelled urls), not by the table.

Defined cases: a null url and one without ``://`` have an empty host and path and no
tokens. Repeated rows are judged each. An empty table gives an empty result; without labelled urls
nothing is mined and the verdict is allow. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notecodes.llm.common import staged

#: (verdict, host and path beginning); a rule holds for its host and all subdomains.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.005, 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path`` of the url column."""
    return df.withColumn("host", F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)).withColumn(
        "path", F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))
    )


def stated_rule(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) columns over ``host`` and ``path``: the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The url's sorted distinct tokens. Numbers count by their number of digits."""
    named = lambda kind, part: F.transform(part, lambda x: F.concat(F.lit(kind), x))
    labels = F.filter(F.split(host, "\\."), lambda x: x != "")
    stem = F.regexp_replace(path, "\\.[A-Za-z0-9]{1,5}$", "")
    segments = F.transform(
        F.filter(F.split(stem, "/"), lambda x: x != ""),
        lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(x).cast("string"))).otherwise(x),
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)\\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    kind = F.regexp_extract(path, "\\.([A-Za-z0-9]{1,5})$", 1)
    return F.array_sort(F.array_distinct(F.concat(
        named("h=", labels), named("p=", segments), named("q=", names),
        F.when(F.size(labels) > 1, F.array(F.concat(F.lit("d="), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>")),
        F.when(kind != "", F.array(F.concat(F.lit("x="), kind))).otherwise(F.array().cast("array<string>")),
    )))


def token_classes(labelled: DataFrame, support: float = LEAST_SUPPORT) -> DataFrame:
    """(token, class) of the tokens with enough support in (tokens, label); at most tokens a url / support rows.

    Tokens of equal sets of urls (told apart by two 64-bit hashes of the sets) are one class, named by all of them.
    """
    total = labelled.count()
    each = labelled.groupBy("tokens").agg(F.count("*").alias("c")).select(
        "c", F.xxhash64("tokens").alias("x"), F.xxhash64(F.lit(1), "tokens").alias("y"), F.explode("tokens").alias("token"))
    frequent = each.groupBy("token").agg(F.sum("c").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).where(F.col("n") >= F.lit(support * total))
    classes = frequent.groupBy("n", "x", "y").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return classes.select(F.explode("members").alias("token"), F.array_join("members", "|").alias("class"))


def classed(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(tokens, classes) of the distinct token sets ``sets`` (tokens): the classes that a token of theirs is in."""
    met = sets.select("tokens", F.explode("tokens").alias("token")).join(F.broadcast(classes), "token")
    return met.groupBy("tokens").agg(F.sort_array(F.collect_set("class")).alias("classes"))


def mine(labelled: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """(rule_tokens, label, confidence, support) mined from (tokens, label); ``rule_tokens`` are what ``tokens`` hold: classes."""
    spark = labelled.sparkSession
    schema = "rule_tokens array<string>, label string, confidence double, support double"
    if labelled.isEmpty():
        return spark.createDataFrame([], schema)
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("label="), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = (
        model.associationRules.where(F.element_at("consequent", 1).startswith("label=") & ~F.exists("antecedent", lambda x: x.startswith("label=")))
        .select(F.array_sort("antecedent").alias("rule_tokens"), F.expr("substring(consequent[0], 7)").alias("label"), "confidence", "support")
    )
    found = staged(found, "mined")
    # a rule is redundant when one on a part of its tokens is as confident: parts are found by leaving out one token at a time
    parts = found.where(F.size("rule_tokens") > 1).select(
        "rule_tokens", "label", "confidence",
        F.explode(F.transform("rule_tokens", lambda x: F.array_remove("rule_tokens", x))).alias("part"),
    )
    shorter = found.select(F.col("rule_tokens").alias("part"), "label", F.col("confidence").alias("part_confidence"))
    redundant = parts.join(shorter, ["part", "label"]).where("part_confidence >= confidence").select("rule_tokens", "label").distinct()
    return found.join(redundant, ["rule_tokens", "label"], "left_anti").select("rule_tokens", "label", "confidence", "support")


def best_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined_rule, mined_verdict, confidence) of the sets (tokens) that a mined rule fits."""
    named = rules.withColumn("name", F.array_join("rule_tokens", " "))
    index = named.select("name", "label", "confidence", "support", F.size("rule_tokens").alias("size"), F.explode("rule_tokens").alias("token"))
    met = (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .groupBy("tokens", "name", "label").agg(F.count("*").alias("met"), F.first("size").alias("size"), F.first("confidence").alias("confidence"), F.first("support").alias("support"))
        .where("met = size")
    )
    order = F.struct(F.col("confidence"), F.col("support"), F.col("size"), F.col("name"), F.col("label"))
    return met.groupBy("tokens").agg(F.max(order).alias("best")).select(
        "tokens", F.col("best.name").alias("mined_rule"), F.col("best.label").alias("mined_verdict"), F.col("best.confidence").alias("confidence")
    )


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence of every row of ``pages`` (page_id, url)."""
    rule, verdict = stated_rule(rules)
    base = with_host_and_path(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")))
    base = staged(base.select("page_id", "host", "path", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), rule.alias("rule"), verdict.alias("stated")), "urls")
    labelled = base.where("stated IS NOT NULL").select("tokens", F.col("stated").alias("label"))
    said = {r["label"]: r["c"] for r in labelled.groupBy("label").agg(F.count("*").alias("c")).collect()}  # two rows
    default = max(("allow", "block"), key=lambda x: (said.get(x, 0), x == "allow"))
    classes = staged(token_classes(labelled, support), "classes")
    sets = staged(classed(base.select("tokens").distinct(), classes), "sets")
    baskets = labelled.join(sets, "tokens", "left").select(F.coalesce("classes", F.array().cast("array<string>")).alias("tokens"), "label")
    mined = staged(mine(baskets, support, confidence), "rules")
    of_classes = best_rules(sets.select(F.col("classes").alias("tokens")).distinct(), mined).withColumnRenamed("tokens", "classes")
    best = sets.join(of_classes, "classes").drop("classes")
    return base.join(best, (base["tokens"] == best["tokens"]) & base["stated"].isNull(), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("stated", "mined_verdict", F.lit(default)).alias("verdict"), "mined_rule", "confidence"
    )
