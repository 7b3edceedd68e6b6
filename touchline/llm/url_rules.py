"""URL filters: given rules by host and path, and association rules mined from labelled URLs.

FP-growth finds token combinations (host labels, path parts, query names) that are frequent among
labelled URLs. Tokens that stand in exactly the same labelled URLs (the labels of one host, the fixed parts of a path) are
first drawn together into one class: mined apart, n of them alone would give 2^n combinations that say the same.
Rare tokens are left out before. Combinations that lead to the label "bad" often enough are kept as rules; one with
a shorter rule inside it of the same or higher confidence is pruned. A rule names a class by its smallest token, and any token
of the class fulfils it. A URL is matched through an inverted index: its tokens are replaced by their classes, every rule
stands under its rarest class, a URL's classes are looked up there, and the rule's others are checked.

Defined results: a missing url, or one without "://", has empty host and path and no tokens, so
no rule fits and it is allowed; ids may be missing or repeat, each row is judged on its own; a
page labelled several times counts as bad if any label says so; extra columns are ignored; an
empty table gives no rows, no labels give no mined rules.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage

SUPPORT_ROWS, SUPPORT, CONFIDENCE = 20, 0.001, 0.6
BAD = "=bad"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first "://" up to / ? # or the end, A-Z in lower case; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def longest_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest given rule (verdict, rule) that fits, and its verdict; missing if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, name in sorted(rules, key=lambda r: len(r[1])):
        fit = fits(name, host, path)
        rule, verdict = F.when(fit, F.lit(name)).otherwise(rule), F.when(fit, F.lit(said)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens: labels of the host, parts of the path, names in the query, each with its place."""
    part = lambda text, by, mark: F.transform(F.filter(F.split(text, by), lambda t: t != ""), lambda t: F.concat(F.lit(mark), t))
    asked = F.regexp_extract_all(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), 1)
    names = F.transform(asked, lambda t: F.concat(F.lit("q:"), t))
    path = F.translate(path_of(url), CAPITALS, SMALL)
    every = F.array_distinct(F.concat(part(host_of(url), r"\.", "h:"), part(path, r"[/._-]", "p:"), names))
    return F.coalesce(every, F.array().cast("array<string>"))


def classes(labelled: DataFrame, tokens: str, least: int) -> DataFrame:
    """(token, class) of the tokens in ``least`` labelled rows or more: tokens of exactly the same rows have the same class,
    the smallest of them. Rows are compared by their number and two sums of hashes of 60 bits of their row numbers."""
    rows = cut_lineage(labelled.select(F.monotonically_increasing_id().alias("row"), F.array_distinct(tokens).alias("own")))
    # sums of 60-bit numbers, as decimals, don't overflow
    marks = [F.sum(F.xxhash64("row", F.lit(i)).bitwiseAND(F.lit((1 << 60) - 1)).cast("decimal(20,0)")).alias(f"mark{i}") for i in range(2)]
    each = rows.select("row", F.explode("own").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"), *marks)
    each = cut_lineage(each.where(F.col("n") >= least))
    same = ["n", "mark0", "mark1"]
    return each.join(each.groupBy(*same).agg(F.min("token").alias("class")), same).select("token", "class")


def in_classes(rows: DataFrame, row: str, tokens: str, known: DataFrame) -> DataFrame:
    """(row, classes): the distinct classes of each row's tokens; rows without any are left out."""
    each = rows.select(row, F.explode(F.array_distinct(tokens)).alias("token")).join(known, "token")
    return each.groupBy(row).agg(F.collect_set("class").alias("classes"))


def mined(labelled: DataFrame, tokens: str, bad: str, support: float = SUPPORT, support_rows: int = SUPPORT_ROWS, confidence: float = CONFIDENCE) -> DataFrame:
    """(tokens, key, confidence, n) of the rules that lead to "bad"; ``key`` is a rule's rarest token.

    Labelled rows have a token array and a boolean. A combination must occur in ``support`` of all
    labelled rows and in ``support_rows`` rows. Tokens are taken as they are: draw together with ``classes`` first.
    """
    from pyspark.ml.fpm import FPGrowth

    spark = labelled.sparkSession
    rows = cut_lineage(labelled.select(
        F.when(F.col(bad), F.array_append(F.col(tokens), F.lit(BAD))).otherwise(F.col(tokens)).alias("items")))
    total = rows.count()
    least = max(support, support_rows / max(1, total))
    kind = "tokens array<string>, key string, confidence double, n long"
    if not total or least > 1:
        return spark.createDataFrame([], kind)
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=1.0).fit(rows)
    sets = cut_lineage(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")))
    whole = sets.where(F.array_contains("items", BAD)).select(F.array_remove("items", BAD).alias("items"), F.col("n").alias("n_bad"))
    rules = cut_lineage(whole.where(F.size("items") > 0).join(sets, "items").select(
        "items", (F.col("n_bad") / F.col("n")).alias("confidence"), "n").where(F.col("confidence") >= confidence))
    # the one-token-shorter combinations that a rule holds; a chain of them leads to every subset
    smaller = rules.select(F.col("items").alias("of"), F.col("confidence").alias("own"), F.explode("items").alias("t")).select(
        "of", "own", F.array_remove("of", F.col("t")).alias("items"))
    pruned = smaller.join(rules, "items").where(F.col("confidence") >= F.col("own")).select(F.col("of").alias("items")).distinct()
    kept = rules.join(pruned, "items", "left_anti")
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("n").alias("often"))
    rarest = kept.select("items", F.explode("items").alias("token")).join(single, "token").groupBy("items").agg(
        F.min(F.struct("often", "token")).alias("least"))
    return kept.join(rarest, "items").select(F.col("items").alias("tokens"), F.col("least.token").alias("key"), "confidence", "n")


def learned(
    labelled: DataFrame, support: float = SUPPORT, support_rows: int = SUPPORT_ROWS, confidence: float = CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """Classes of tokens, and the rules on them, of labelled rows (row, tokens, bad)."""
    total = labelled.count()
    known = cut_lineage(classes(labelled, "tokens", max(1, support_rows, math.ceil(support * total))))
    some = labelled.join(in_classes(labelled, "row", "tokens", known), "row", "left")
    # rows without frequent tokens stay: they count for the support
    some = some.select(F.coalesce("classes", F.array().cast("array<string>")).alias("classes"), "bad")
    return known, mined(some, "classes", "bad", support, support_rows, confidence)


def matched(rows: DataFrame, row: str, tokens: str, rules: DataFrame) -> DataFrame:
    """The distinct ``row`` values whose tokens hold all tokens of some rule."""
    looked = rows.select(row, F.col(tokens).alias("own"), F.explode(tokens).alias("key"))
    index = rules.select("key", F.col("tokens").alias("needed"))
    return looked.join(index, "key").where(F.size(F.array_except("needed", "own")) == 0).select(row).distinct()


def judged(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], id_column: str = "page_id", url: str = "url",
    label_id: str = "doc_id", quality: str = "quality", **settings,
) -> DataFrame:
    """id, host, path, rule and verdict of every row: the longest given rule's, else "block" if a mined rule matches, else "allow"."""
    address = F.col(url)
    rule, said = longest_rule(rules, F.col("host"), F.col("path"))
    rows = pages.select(F.col(id_column).alias("page"), host_of(address).alias("host"), path_of(address).alias("path"), tokens_of(address).alias("tokens"))
    rows = cut_lineage(rows.withColumns({"rule": rule, "said": said}).withColumn("row", F.monotonically_increasing_id()))
    marks = labels.where(F.col(quality).isNotNull()).groupBy(F.col(label_id).alias("page")).agg((F.min(quality) == 0).alias("bad"))
    labelled = cut_lineage(rows.join(marks, "page").select("row", "tokens", "bad"))
    known, learnt = learned(labelled, **settings)
    asked = known.join(learnt.select(F.explode("tokens").alias("class")).distinct(), "class")
    found = matched(in_classes(rows, "row", "tokens", asked), "row", "classes", learnt).withColumn("found", F.lit(True))
    verdict = F.coalesce("said", F.when(F.col("found"), F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(found, "row", "left").select(F.col("page").alias(id_column), "host", "path", "rule", verdict.alias("verdict"))
