"""URL filtering by given rules and by mined association rules.

A given rule names a host, with all its subdomains, and the start of a path;
the longest one that fits decides. Where none fits, rules mined from labelled
pages decide: Spark's FP-growth finds combinations of URL tokens that go with a
label, and those with enough support and confidence are kept. Tokens that always
occur together are mined as one item. Rules of both
kinds are found by an inverted index, from a host or a rule's rarest token to
the rules, so no URL is compared with all rules. Everything is DataFrame, SQL and
MLlib code of the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import written

ALLOW, BLOCK = "allow", "block"
LABEL = "label="
# Mined rules: least share of the labelled pages, and least confidence.
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The given rules.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for NULL."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def domains_of(host: str) -> Column:
    """The host and all domains above it."""
    labels = f"split({host}, '[.]')"
    return F.expr(f"transform({labels}, (x, i) -> array_join(slice({labels}, i + 1, size({labels})), '.'))")


def tokens_of(url: Column, host: str, path: str) -> Column:
    """Distinct tokens in order: scheme, domains, path pieces, their shapes, query names, fragment."""
    scheme = F.when(F.instr(url, "://") > 0, F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))
    domains = F.transform(domains_of(host), lambda d: F.concat(F.lit("host="), d))
    pieces = F.transform(
        F.filter(F.split(F.lower(F.col(path)), "/"), lambda p: p != ""),
        lambda p: F.concat(F.lit("path="), F.regexp_replace(p, "[0-9]+", "0")),
    )
    query = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: p != "")
    names = F.transform(query, lambda p: F.concat(F.lit("query="), F.substring_index(p, "=", 1)))
    fragment = F.when(F.instr(url, "#") > 0, F.lit("fragment"))
    found = F.concat(F.array(scheme, fragment), domains, pieces, names)
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: t.isNotNull() & (t != "host="))))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """``rule_host, rule_path, rule, rule_verdict``; a list the caller wrote down."""
    rows = [
        F.struct(
            F.lit(r.host).alias("rule_host"), F.lit(r.path).alias("rule_path"),
            F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("rule_verdict"),
        )
        for r in rules
    ]
    empty = F.array().cast(
        "array<struct<rule_host:string,rule_path:string,rule:string,rule_verdict:string>>"
    )
    return spark.range(1).select(F.inline(F.array(*rows) if rows else empty))


def given_verdicts(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``url, rule, rule_verdict`` of the longest fitting rule, for urls that have one.

    ``urls`` holds distinct ``url, host, path``. Of equally long rules the first
    in text order counts, blocking before allowing.
    """
    domains = urls.select("url", "path", F.explode(domains_of("host")).alias("rule_host"))
    fits = domains.join(rule_table(urls.sparkSession, rules), "rule_host").filter(
        F.col("path").startswith(F.col("rule_path"))
    )
    rank = F.struct(
        (-F.length("rule")).alias("n"), "rule", (F.col("rule_verdict") == ALLOW).alias("allows"), "rule_verdict"
    )
    return fits.groupBy("url").agg(F.min(rank).alias("best")).select("url", "best.rule", "best.rule_verdict")


def token_groups(baskets: DataFrame, least: float) -> DataFrame:
    """``token, item``: the tokens in at least ``least`` baskets ``id, tokens``.

    Tokens that are in the same baskets are one item, named after the first of
    them. What baskets a token is in is told by its count and two independent
    64-bit sums over them.
    """
    held = baskets.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    known = held.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(20,0)")).alias(f"sum{k}") for k in (1, 2)],
    )
    together = ["n", "sum1", "sum2"]
    frequent = written(known.filter(F.col("n") >= least))
    items = frequent.groupBy(*together).agg(F.min("token").alias("item"))
    return written(frequent.join(items, together).select("token", "item"))


def in_items(sets: DataFrame, keys: list[str], groups: DataFrame) -> DataFrame:
    """``keys, items`` for the rows of ``keys, tokens`` that hold a grouped token."""
    tokens = sets.select(*keys, F.explode("tokens").alias("token"))
    return tokens.join(groups, "token").groupBy(*keys).agg(F.collect_set("item").alias("items"))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """Rules ``rule_id, tokens, size, mined_verdict, confidence, support`` and groups ``token, item``.

    FP-growth over the items and the label of every labelled url, ``tokens,
    blocked``; rules whose consequent is a label. Tokens that always occur
    together would give a rule for each of their subsets, all equally sure; they
    are one item, and any of them in a url stands for it. Tables without rows
    give no rules.
    """
    label = F.concat(F.lit(LABEL), F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
    baskets = written(
        labelled.select(F.monotonically_increasing_id().alias("id"), "tokens", label.alias("label"))
    )
    groups = token_groups(baskets, min_support * baskets.count())
    found = in_items(baskets, ["id"], groups).withColumnRenamed("id", "item_id")
    found = baskets.select("id", "label").join(found, F.col("id") == F.col("item_id"), "left")
    none = F.array().cast("array<string>")
    found = written(found.select(F.concat(F.coalesce("items", none), F.array("label")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(found)
    rules = model.associationRules.filter(
        (F.size("consequent") == 1) & F.get("consequent", 0).startswith(LABEL)
    )
    # A label among the conditions would ask for what is to be found.
    rules = rules.filter(~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    tokens = F.array_sort("antecedent")
    rules = rules.select(
        F.xxhash64(tokens).alias("rule_id"),
        tokens.alias("tokens"),
        F.size("antecedent").alias("size"),
        F.substr(F.get("consequent", 0), F.lit(len(LABEL) + 1)).alias("mined_verdict"),
        "confidence",
        "support",
    )
    return written(rules), groups


def without_redundant(rules: DataFrame) -> DataFrame:
    """The rules without those that a shorter one makes needless.

    If a rule less one token has the same verdict and is as sure, it fits
    wherever the longer one fits and has at least its support, so the longer
    one never decides alone.
    """
    shorter = rules.select(
        F.col("tokens").alias("kept_tokens"), F.col("mined_verdict").alias("same_verdict"),
        F.col("confidence").alias("as_sure"),
    )
    parts = rules.filter(F.col("size") > 1).select(
        "rule_id", "mined_verdict", "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("part"),
    )
    needless = parts.join(
        shorter,
        (F.col("part") == F.col("kept_tokens"))
        & (F.col("mined_verdict") == F.col("same_verdict"))
        & (F.col("as_sure") >= F.col("confidence")),
    ).select("rule_id", "mined_verdict")
    return rules.join(needless, ["rule_id", "mined_verdict"], "left_anti")


def mined_verdicts(urls: DataFrame, rules: DataFrame, groups: DataFrame) -> DataFrame:
    """``url, mined_verdict, confidence`` of the surest mined rule, for urls that have one.

    ``urls`` holds ``url, tokens``. A rule fits if the url has a token of each
    of its items.
    Among equally sure rules that with more support counts, then that which
    blocks. Each rule stands in the index under its rarest token alone, and is
    compared with the distinct token sets that hold this token.
    """
    sets = written(in_items(urls.select("tokens").distinct(), ["tokens"], groups))
    held = sets.select("tokens", "items", F.explode("items").alias("token"))
    frequency = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rules = written(without_redundant(rules)).withColumnRenamed("tokens", "rule_tokens")
    index = written(
        rules.withColumn("token", F.explode("rule_tokens"))
        .join(frequency, "token")
        .groupBy("rule_tokens", "mined_verdict", "confidence", "support")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    )
    rank = F.struct("confidence", "support", (F.col("mined_verdict") == BLOCK).alias("blocks"), "mined_verdict")
    best = written(
        held.join(index, "token")
        .filter(F.forall("rule_tokens", lambda t: F.array_contains("items", t)))
        .groupBy("tokens")
        .agg(F.max(rank).alias("best"))
    )
    return urls.select("url", "tokens").join(best, "tokens").select("url", "best.mined_verdict", "best.confidence")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``id_col, host, path, rule, verdict, mined_confidence``: one row per page row.

    ``labels`` holds ``id_col, blocked``; pages with a label that is not NULL
    train the mined rules. The verdict is the longest given rule's, else the
    surest mined rule's, else ``allow``. A NULL url, and one without ``://``, has
    empty host and path. Repeated rows give equal rows. Empty pages give an
    empty result, empty labels no mined rules.
    """
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = named.select("url").distinct().filter(F.col("url").isNotNull())
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    urls = written(urls.withColumn("tokens", tokens_of(F.col("url"), "host", "path")))
    known = labels.select(F.col(id_col).alias("id"), "blocked").filter(F.col("blocked").isNotNull())
    url = F.col("url")
    parsed = named.filter(url.isNotNull()).join(known, "id").select(
        "url", host_of(url).alias("host"), path_of(url).alias("path"), "blocked"
    )
    training = parsed.select(tokens_of(url, "host", "path").alias("tokens"), "blocked")
    mined, groups = mine(training, min_support, min_confidence)
    judged = (
        urls.select("url", "host", "path")
        .join(given_verdicts(urls.select("url", "host", "path"), rules), "url", "left")
        .join(mined_verdicts(urls.select("url", "tokens"), mined, groups), "url", "left")
    )
    # Written, so that the join below can split a url that very many pages have.
    judged = written(
        judged.select(
            F.col("url").alias("judged_url"), "host", "path", "rule",
            F.coalesce("rule_verdict", "mined_verdict", F.lit(ALLOW)).alias("verdict"),
            F.col("confidence").alias("mined_confidence"),
        )
    )
    return named.join(judged, F.col("url") == F.col("judged_url"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
        "mined_confidence",
    )
