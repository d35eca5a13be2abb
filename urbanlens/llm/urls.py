"""URL filter by association rules.

A list of (host, path) rules judges the urls it fits; those judgements are the
labels. Each url is a set of tokens (scheme, host labels, path words, query keys,
extension). All tokens with ``MIN_SUPPORT`` form the mining vocabulary. Rules need ``MIN_SUPPORT``
and ``MIN_CONFIDENCE``, and a longer rule stays only if it is more confident than every shorter rule
inside it. So what cannot be in such a longer rule does not enter mining:

* tokens that occur in exactly the same labelled urls (the words of a shared path) are one item, any of
  them in its place: rules hold groups of tokens, and stand for one rule per choice of a token from each;
* items of one label alone (confidence 1) and items of all labelled urls are rules, or none, by
  themselves: nothing longer is more confident than what it says without them or they without it.

Spark's FP-growth mines the combinations of the other items with a label. Urls that no listed rule
fits are judged by the mined rules: rules are found through an inverted index from their rarest
item, a rule matches when a token of each of its groups is found, and the matching rules, every choice of
tokens for itself, vote with confidence times support (ties and no match: allow).

Edge cases: NULL urls and urls without ``://`` have empty host and path and get the
method's verdict on no tokens; an empty table gives no rows; without labelled urls
every verdict is allow; repeated rows are judged alike. A long path that many labelled urls share
is one item; items that occur in nearly but not quite the same urls stay apart, and their
combinations grow with the power of their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm.common import materialize, read

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8


@dataclass(frozen=True)
class Rule:
    host: str
    path: str  # without the leading slash
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}/{self.path}"


# The listed rules.
RULES = [
    Rule("net", "", "block"),
    Rule("example.net", "en/", "allow"),
    Rule("example.com", "de/", "block"),
    Rule("org", "fr/", "allow"),
]


def with_parts(pages: DataFrame) -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path`` of ``url``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(url.contains("://"), F.expr("substring(coalesce(url, ''), locate('://', coalesce(url, '')) + 3)")).otherwise(F.lit(""))
    out = pages.withColumn("__rest", rest)
    host = F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return out.withColumn("host", host).withColumn("path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1))


def listed(rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits ``host`` and ``path`` (else NULL).
    Longest: by the rule's length, host before path."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith("/" + rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """Distinct tokens of a url, marked by where they stand; numbers fold to one token."""
    word = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), F.when(x.rlike("^[0-9]+$"), "#").otherwise(F.lower(x))))
    query = F.regexp_extract("__rest", r"\?([^#]*)", 1)
    return F.array_distinct(F.concat(
        word("scheme", F.array(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^([A-Za-z0-9+.-]*)://", 1))),
        word("host", F.split("host", r"\.")),
        word("path", F.split(F.regexp_replace("path", r"\.[A-Za-z0-9]{1,5}$", ""), "[/_.-]+")),
        word("ext", F.array(F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1))),
        word("key", F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))),
    ))


def vocabulary(marked: DataFrame) -> list[str]:
    """All tokens with ``MIN_SUPPORT``, of which there are at most a url's mean tokens
    divided by ``MIN_SUPPORT``; none if all labels are equal."""
    n = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(n) < 2:
        return []
    counts = marked.select(F.explode("tokens").alias("token")).groupBy("token").count()
    return sorted(r.token for r in counts.where(F.col("count") >= MIN_SUPPORT * sum(n.values())).collect())


def among(words: list[str], column: str) -> Column:
    """The tokens of ``column`` that are in ``words``, by a hashed set."""
    return F.filter(column, lambda x: x.isin(words))


def merged(marked: DataFrame, words: list[str]) -> DataFrame:
    """``(token, item, n, block)``: the item of each token, how many urls have it and how many of them are to be blocked. Tokens with
    the same urls have the same item, named by the first of them."""
    seen = marked.select("label", F.explode(among(words, "tokens")).alias("token"), F.array_sort("tokens").alias("whole"))
    seen = seen.select("token", F.xxhash64("whole").alias("h"), (F.col("label") == "block").cast("long").alias("block"))
    # sums and parities of hashes tell sets of urls apart
    per = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("block").alias("block"), F.sum(F.shiftrightunsigned("h", 33)).alias("a"), F.bit_xor("h").alias("b"))
    first = per.groupBy("n", "block", "a", "b").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))  # tokens of the vocabulary
    return materialize(first.select(F.explode("tokens").alias("token"), "item", "n", "block"))


def mine(marked: DataFrame, words: list[str], items: DataFrame | None = None) -> DataFrame:
    """``(rule, items, verdict, confidence, support)`` of the pruned association rules; ``items`` as from ``merged``."""
    spark = marked.sparkSession
    schema = "rule bigint, items array<string>, verdict string, confidence double, support double"
    if not words:
        return spark.createDataFrame([], schema)
    items = merged(marked, words) if items is None else items
    total = marked.count()
    one = items.select("item", "n", "block").distinct()
    both = one.select("item", "n", F.explode(F.array(
        F.struct(F.lit("block").alias("verdict"), F.col("block").alias("hits")), F.struct(F.lit("allow").alias("verdict"), (F.col("n") - F.col("block")).alias("hits")),
    )).alias("v")).select("item", "n", "v.*")
    alone = both.select(F.array("item").alias("items"), "verdict", (F.col("hits") / F.col("n")).alias("confidence"), (F.col("hits") / total).alias("support"))
    alone = alone.where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
    open_ = one.where((F.col("block") > 0) & (F.col("block") < F.col("n")) & (F.col("n") < total)).select(F.col("item").alias("word"))
    left = sorted(r.word for r in open_.collect())  # as few as the vocabulary
    found = alone
    if left:
        # of an item's tokens the first stands for all
        entries = F.concat(among(left, "tokens"), F.array(F.concat(F.lit("="), F.col("label"))))
        sets = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT).fit(marked.select(entries.alias("items"))).freqItemsets
        sets = materialize(sets.select(F.array_sort(F.filter("items", lambda x: ~x.startswith("="))).alias("items"), F.get(F.filter("items", lambda x: x.startswith("=")), F.lit(0)).alias("label"), "freq"))
        with_label = sets.where("label is not null and size(items) > 1")
        without = sets.where("label is null").select("items", F.col("freq").alias("n"))
        longer = with_label.join(without, "items").select("items", F.expr("substring(label, 2)").alias("verdict"), (F.col("freq") / F.col("n")).alias("confidence"), (F.col("freq") / total).alias("support"))
        found = alone.unionByName(longer.where(F.col("confidence") >= MIN_CONFIDENCE))
    # a shorter rule at least as confident makes a longer one redundant
    rules = materialize(found)
    inner = rules.select(F.col("items").alias("inner"), F.col("verdict").alias("v"), F.col("confidence").alias("c"), F.col("items")[0].alias("word"))
    beaten = (
        rules.where("size(items) > 1").select("items", "verdict", "confidence", F.explode("items").alias("word")).join(inner, "word")
        .where("verdict = v and c >= confidence and size(inner) < size(items) and size(array_except(inner, items)) = 0").select("items", "verdict").distinct()
    )
    kept = rules.join(beaten, ["items", "verdict"], "left_anti")
    return kept.withColumn("rule", F.xxhash64("items", "verdict")).select("rule", "items", "verdict", "confidence", "support")


def judge_sets(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """``(__signature, __mined)`` for distinct token sets, by an inverted index from a rule's rarest item."""
    rarity = items.select("item", "n").distinct()
    rarest = rules.select("rule", F.explode("items").alias("item")).join(rarity, "item").groupBy("rule").agg(F.min(F.struct("n", "item"))["item"].alias("item"))
    index = rules.join(rarest, "rule").select("item", "items", "verdict", (F.col("confidence") * F.col("support")).alias("weight"))
    # how many tokens of each item a set has
    has = (
        sets.select("__signature", F.explode("__signature").alias("token")).join(items.select("token", "item"), "token")
        .groupBy("__signature", "item").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("__signature").agg(F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias("has"))
    )
    met = has.select("__signature", "has", F.explode(F.map_keys("has")).alias("item")).join(index, "item")
    choices = F.aggregate("items", F.lit(1).cast("double"), lambda s, x: s * F.coalesce(F.try_element_at(F.col("has"), x), F.lit(0)))
    matched = met.withColumn("w", choices * F.col("weight")).where("w > 0")
    vote = F.round(F.sum(F.when(F.col("verdict") == "block", F.col("w")).otherwise(-F.col("w"))), 9)
    return matched.groupBy("__signature").agg(F.when(vote > 0, "block").otherwise("allow").alias("__mined"))


def judge(pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages``."""
    clash = ["host", "path", "rule", "verdict"]
    parted = with_parts(pages.drop(*clash))
    name, verdict = listed(rules)
    marked = parted.withColumns({"rule": name, "__listed": verdict}).withColumn("__tokens", tokens())
    train = marked.where("__listed is not null").select(F.col("__listed").alias("label"), F.col("__tokens").alias("tokens"))
    words = vocabulary(train)
    signed = marked.withColumn("__signature", F.array_sort(among(words, "__tokens")))
    sets = signed.where("__listed is null").select("__signature").distinct()
    items = merged(train, words)
    mined = judge_sets(sets, mine(train, words, items), items)
    return (
        signed.join(mined, "__signature", "left")
        .withColumn("verdict", F.coalesce("__listed", "__mined", F.lit("allow")))
        .drop("__rest", "__listed", "__tokens", "__signature", "__mined")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
