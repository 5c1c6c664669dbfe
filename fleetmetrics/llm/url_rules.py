"""URL filtering by listed rules and by association rules mined from labels.

A URL's tokens are the words of its host, the parts of its path without digits,
its file ending, and the names of its parameters. FP-growth over the labelled
URLs finds token combinations; those that imply the block label with at least
`confidence`, and occur with it in at least the share `support` and the number
`least` of the labelled URLs, become rules. An inverted index from token to rules matches them: a rule
fits a URL that holds all its tokens. A listed rule goes before a mined one.

Everything is built-in functions and Spark's own FP-growth: no Python runs on
the executors. A URL is judged once, however many rows have it; what was found is
written before the join back to the rows, so that both of its sides are shuffled
and Spark can split the rows of a very frequent URL.

Null URLs and those without '://' have an empty host and path and no tokens,
and are allowed. Labels are by URL; where rows disagree one block is enough.
Without labelled URLs there are no mined rules.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmetrics.llm.common import free_name, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)\??([^#]*)"
BLOCK_ITEM = "=block"
SUPPORT = 0.002
CONFIDENCE = 0.6
LEAST = 20
BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class Listed:
    """A rule for a host with all its subdomains and the paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values.
LISTED = (
    Listed("block", "net", "/"),
    Listed("allow", "example.net", "/en/"),
    Listed("block", "example.com", "/de/"),
    Listed("allow", "org", "/fr/"),
)


def _part(url: Column, number: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, number), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return _part(url, 2)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL; none for null."""

    def named(kind: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(kind), w))

    query = F.transform(F.split(_part(url, 3), "&"), lambda p: F.split_part(p, F.lit("="), F.lit(1)))
    ending = F.array(F.regexp_extract(path(url), r"\.([A-Za-z]+)$", 1))
    whole = F.concat(
        named("host ", F.split(host(url), "[.-]")),
        named("path ", F.filter(F.split(path(url), "/"), lambda w: ~w.rlike("[0-9]"))),
        named("ending ", ending),
        named("parameter ", query),
    )
    return F.array_distinct(whole)


def mine(
    labelled: DataFrame,
    url: str = "url",
    blocked: str = "blocked",
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    least: int = LEAST,
) -> DataFrame:
    """rule, tokens, confidence, support: combinations that imply a block.

    Mined from every labelled URL; `blocked` is boolean.
    """
    items = F.concat(tokens(F.col(url)), F.when(F.col(blocked), F.array(F.lit(BLOCK_ITEM))).otherwise(F.array()))
    marked = labelled.filter(F.col(url).isNotNull() & F.col(blocked).isNotNull())
    marked = marked.groupBy(url).agg(F.max(blocked).alias(blocked))
    baskets = marked.select(items.alias("items")).filter(F.size("items") > 0)
    known = baskets.count()
    if known < least:
        none = "CAST(NULL AS array<string>) tokens, CAST(NULL AS double) confidence, CAST(NULL AS double) support"
        return baskets.sparkSession.sql(f"SELECT CAST(NULL AS string) rule, {none} LIMIT 0")
    model = FPGrowth(itemsCol="items", minSupport=max(support, least / known), minConfidence=confidence).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCK_ITEM)))
    return rules.select(
        F.array_join(F.array_sort("antecedent"), " & ").alias("rule"), F.col("antecedent").alias("tokens"), "confidence", "support"
    )


def match(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """url and mined, the fitting rule of most confidence, for each distinct URL that one fits."""
    index = rules.select(
        F.explode("tokens").alias("token"), "rule", F.size("tokens").alias("needed"), "confidence", "support"
    )
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    single = urls.select(F.col(url).alias("url")).filter("url IS NOT NULL").distinct()
    held = single.select("url", F.explode(tokens(F.col("url"))).alias("token")).join(index, "token")
    met = held.groupBy("url", "rule").agg(
        F.count("*").alias("found"), F.first("needed").alias("needed"), F.max("confidence").alias("c"), F.max("support").alias("s")
    )
    best = F.max(F.struct("c", "s", "rule"))["rule"]
    return met.filter("found = needed").groupBy("url").agg(best.alias("mined"))


def listed_rule(url: Column, rules: Sequence[Listed] = LISTED) -> Column:
    """(length, rule, verdict) of the longest listed rule that fits, or null."""
    own_host, own_path = host(url), path(url)
    fits = [
        F.when(
            ((own_host == r.host) | own_host.endswith("." + r.host)) & own_path.startswith(r.path),
            F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


def judge(
    pages: DataFrame,
    mined: DataFrame,
    keep: Sequence[str] = ("page_id",),
    url: str = "url",
    listed: Sequence[Listed] = LISTED,
) -> DataFrame:
    """`keep`, host, path, rule (listed, or null), mined (a mined rule, or null) and verdict; a row per page."""
    same, rule = free_name(pages, "__url"), free_name(pages, "__mined")
    address = F.col(f"`{url}`")
    found = stored(match(pages, mined, url).toDF(same, rule), "matched")
    joined = pages.join(found, address == F.col(same), "left")
    fitting = listed_rule(address, listed)
    by_method = F.when(F.col(rule).isNotNull(), "block").otherwise("allow")
    return joined.select(
        *[F.col(f"`{c}`") for c in keep],
        host(address).alias("host"),
        path(address).alias("path"),
        fitting["rule"].alias("rule"),
        F.col(rule).alias("mined"),
        F.coalesce(fitting["verdict"], by_method).alias("verdict"),
    )
