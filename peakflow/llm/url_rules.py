"""URL filtering: listed rules first, then association rules mined from labelled URLs.

Labelled URLs become transactions of typed tokens (host parts, path words, query names) and their label. Spark's
FP-growth finds token combinations; those that imply `block` with enough support (a share and a number of URLs) and a
confidence well above the labels' base rate, and above that of any combination within them, are kept. Each rule
stands in an inverted index under its rarest token; a URL looks its tokens up there and is blocked if it has all
tokens of a rule.

Input: pages (page_id, url) and labels (doc_id, quality, toxic; doc_id is the page's id). A null url or one
without :// has an empty host and path and matches no rule; others are read whole. A label counts if it has a quality or a toxic value; those
without a page are not used. Without any label nothing is mined and what no rule lists is allowed. Of several rules that match, the one of
highest confidence, then support, then name is told. Repeated rows get equal results, extra columns are ignored, an empty
table gives an empty result."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakflow.sources.staging import stage

# fixed values: the listed rules (verdict, host, path)
LISTED = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT, CONFIDENCE = 0.002, 0.5
LEAST = 20  # labelled URLs a rule rests on at least, whatever the size of the table
GAIN = 1 / 3  # share of the way from the labels' base rate to certainty that a rule's confidence must go beyond it
BROADCAST_ROWS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCK, _ALLOW = "label=block", "label=allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER), F.regexp_extract(url, parts, 2)


def listed(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """Rule (host and path) and verdict of the longest listed rule that fits, else null."""
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"),) * 2


def tokens(url: Column) -> Column:
    """Typed, distinct tokens; numbers are one token."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A[^?#]*\?([^#]*)", 1)

    def typed(kind: str, parts: Column) -> Column:
        plain = F.filter(parts, lambda x: x != "")
        return F.transform(plain, lambda x: F.concat(F.lit(kind), F.when(x.rlike(r"^\d+$"), F.lit("#")).otherwise(F.translate(x, _UPPER, _LOWER))))

    names = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"^([^=]*)", 1))
    return F.array_distinct(F.concat(typed("h:", F.split(host, r"[.\-:@]")), typed("p:", F.split(path, r"[^0-9A-Za-z\x80-\x{10FFFF}]+")), typed("q:", names)))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, gain: float = GAIN, least: int = LEAST) -> DataFrame | None:
    """Rules for `block`: rule_id, tokens, confidence, support and key (the rarest token).

    `labelled` has url and blocked (boolean). None if there is nothing to learn from."""
    rows = stage(labelled.where("url is not null and blocked is not null").select(
        F.concat(tokens(F.col("url")), F.array(F.when(F.col("blocked"), _BLOCK).otherwise(_ALLOW))).alias("items")), "transactions")
    if not rows.take(1):
        return None
    # a token of nearly every URL tells nothing and doubles the combinations
    total, base = rows.agg(F.count("*"), F.avg(F.array_contains("items", _BLOCK).cast("double"))).first()
    support = max(support, (least - 0.5) / total)
    if support > 1:
        return None
    counts = stage(rows.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n")), "tokens")
    useful = counts.where((F.col("n") >= support * total) & ((F.col("n") <= 0.9 * total) | F.col("token").startswith("label=")))
    allowed = [r.token for r in useful.select("token").collect()]  # at most items per URL / support
    kept = rows.select(F.array_intersect("items", F.array(*map(F.lit, allowed)) if allowed else F.array().cast("array<string>")).alias("items")).where("size(items) > 1")
    # the share that FP-growth asks for is one of the rows it gets
    share = support * total / max(1, kept.count())
    if share > 1:
        return None
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(kept)
    found = model.associationRules.where((F.col("consequent") == F.array(F.lit(_BLOCK))) & (F.col("confidence") > base + gain * (1 - base))) \
        .where(~F.array_contains("antecedent", _ALLOW))
    rules = stage(found.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "rules").withColumn("rule_id", F.array_join("tokens", " "))
    # drop a rule if one within it is as good: rules are looked up by one of their own tokens and compared
    inner = rules.select(F.col("rule_id").alias("o_id"), F.col("tokens").alias("o_tokens"), F.col("confidence").alias("o_conf"), F.get("tokens", F.lit(0)).alias("t"))
    within = rules.select("*", F.explode("tokens").alias("t")).join(inner, "t").where(
        (F.col("o_id") != F.col("rule_id")) & (F.size(F.array_except("o_tokens", "tokens")) == 0) & (F.col("o_conf") >= F.col("confidence")))
    best = rules.join(within.select("rule_id").distinct(), "rule_id", "left_anti")
    each = best.select("*", F.explode("tokens").alias("token")).join(counts, "token")
    key = each.groupBy("rule_id").agg(F.min_by("token", F.struct("n", "token")).alias("key"))
    return stage(best.join(key, "rule_id"), "index")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, mined_rule and confidence of every different url that has all tokens of a rule (the best one)."""
    index = F.broadcast(rules) if rules.count() <= BROADCAST_ROWS else rules
    each = urls.where("url is not null").select("url").distinct().select("url", tokens(F.col("url")).alias("own")).select("url", "own", F.explode("own").alias("key"))
    hit = each.join(index, "key").where(F.size(F.array_except("tokens", "own")) == 0)
    best = F.max(F.struct("confidence", "support", F.col("rule_id").alias("mined_rule"))).alias("b")
    return hit.groupBy("url").agg(best).select("url", "b.mined_rule", "b.confidence")


def judge(pages: DataFrame, labels: DataFrame, rules=LISTED) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule and confidence of every row of `pages`."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(F.max(bad).alias("blocked"))
    mined = mine(pages.join(known, pages["page_id"] == known["doc_id"]).select("url", "blocked"))
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    if mined is None:
        rows = rows.withColumns({"mined_rule": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    else:
        rows = rows.join(matches(pages, mined), "url", "left")
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "mined_rule", "confidence")


def op7_association_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return judge(pages, labels)
