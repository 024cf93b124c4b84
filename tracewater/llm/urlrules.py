"""URL filters: stated host and path rules, and association rules mined from labels.

**Stated rules.** A rule has a host, a path and a verdict. It fits its host and
all subdomains, if the url's path starts with the rule's path. Of several the
one with the longest text decides (then the longer host, then ``block``).
Candidates meet their rules by key: the endings of a host that have as many
labels as some rule, then the beginnings of the path that are as long as some
rule's path on that host.

**Mined rules.** A url becomes tokens: scheme, host labels and their words,
folders, the last part of the path with digits folded, query keys. Labelled
pages are transactions of tokens; a combination that is frequent together with
the unwanted label is a rule if it implies the label with at least
``confidence``. Rules that contain a rule of at least their own confidence go.
Combinations grow by a token a round, as rows of an equi join, from all tokens
of a page. Two kinds are not grown, since whatever contains them would go: those
that imply the label without exception, and those with a token that the others
imply without exception (the host of a path that only it has). So the rules are
the same as without this, and tokens that always come together add nothing.
Tokens that nearly always do are costly: rows then grow with their combinations.

Rules are posted under their rarest token. A url's tokens meet the postings in
an equi join, and a rule fires if the url has all its tokens.

Both kinds judge every different url once; the verdicts go back by url, so a
repeated url costs one row. A url without a stated or mined rule is allowed.

Cases: a null url or one without ``://`` has an empty host and path and no
tokens, and is allowed. Repeated rows are judged each; a page with
contradicting labels is a transaction for each; null labels and ids take no
part. Without labelled pages nothing is mined. Very long urls: only as many
host endings and path beginnings are made as there are rule sizes; tokens are
whole. An empty table gives an empty result. Columns other than the named ones
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewater.llm.common import stage

BLOCK, ALLOW = "block", "allow"
SUPPORT, LEAST, CONFIDENCE = 0.002, 5, 0.8
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
MINED_SCHEMA = "items array<string>, support long, confidence double"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, else an empty text."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Different tokens of a url, with their kind in front."""

    def named(kind: str, parts: Column) -> Column:
        full = F.filter(parts, lambda p: p != "")
        return F.transform(full, lambda p: F.concat(F.lit(f"{kind}:"), F.translate(p, _UPPER, _LOWER)))

    labels = F.split(host_of(url), r"\.")
    words = F.flatten(F.transform(F.filter(labels, lambda x: F.contains(x, F.lit("-"))), lambda x: F.split(x, "-")))
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    last = F.transform(F.slice(parts, F.greatest(F.size(parts), F.lit(1)), 1), lambda p: F.regexp_replace(p, "[0-9]+", "0"))
    asked = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(asked, "&"), lambda p: F.split_part(p, F.lit("="), F.lit(1)))
    at = F.instr(url, "://")
    scheme = F.array(F.coalesce(F.when(at > 0, F.substring(url, F.lit(1), at - 1)), F.lit("")))
    kinds = {"host": labels, "word": words, "in": folders, "last": last, "key": keys, "scheme": scheme}
    return F.coalesce(F.array_distinct(F.concat(*[named(k, v) for k, v in kinds.items()])), F.array().cast("array<string>"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def mine(
    labelled: DataFrame,
    support: float = SUPPORT,
    least: int = LEAST,
    confidence: float = CONFIDENCE,
    width: int | None = None,
) -> DataFrame:
    """``url, unwanted`` (boolean) -> ``items, support, confidence``: what implies an unwanted page.

    ``support`` is the least share, ``least`` the least number of all labelled
    pages that have the combination and the label. A ``width`` lets a page enter
    with that many tokens only, those that tell most about the label.
    """
    spark = labelled.sparkSession
    rows = stage(
        labelled.filter("unwanted is not null").select(F.monotonically_increasing_id().alias("row"), tokens(F.col("url")).alias("items"), "unwanted"),
        "transactions",
    )
    n, bad = rows.agg(F.count("*"), F.count_if("unwanted")).first()
    if not bad:
        return spark.createDataFrame([], MINED_SCHEMA)
    floor = max(support, least / n)
    if floor > 1:
        return spark.createDataFrame([], MINED_SCHEMA)
    # A hair below the floor, so that a count right at it is not lost to rounding.
    need = F.lit(floor * (1 - 1e-9) * n)
    single = rows.select("row", "unwanted", F.explode("items").alias("item"))
    # Only an item that is frequent together with the label can stand in a rule.
    frequent = _counted(single.withColumn("items", F.array("item"))).filter(F.col("bad") >= need)
    if width is not None:
        telling = F.abs(F.col("bad") / F.col("n") - F.lit(bad / n)) * F.sqrt("n")
        best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("telling")).alias("order"), "item"))), 1, width)
        chosen = single.join(frequent.select(F.col("items")[0].alias("item"), telling.alias("telling")), "item").groupBy("row", "unwanted").agg(best.alias("best"))
        single = stage(chosen.select("row", "unwanted", F.explode("best.item").alias("item")), "chosen")
        frequent = _counted(single.withColumn("items", F.array("item"))).filter(F.col("bad") >= need)
    level = stage(frequent, "tokens")
    posts = stage(single.join(level.select(F.col("items")[0].alias("item")), "item"), "posts")
    have = posts.select("row", "unwanted", F.array("item").alias("items"))
    found = [level]
    while not (growing := level.filter(F.col("bad") < F.col("n"))).isEmpty():
        held = have.join(growing.select("items"), "items").withColumn("last", F.element_at("items", -1))
        longer = held.join(posts.select("row", "item"), "row").filter(F.col("item") > F.col("last"))
        have = stage(longer.select("row", "unwanted", F.array_append("items", F.col("item")).alias("items")), "grown")
        level = stage(_needing_all(_counted(have).filter(F.col("bad") >= need), growing), "combinations")
        found.append(level)
    implied = reduce(DataFrame.unionByName, found).withColumn("confidence", F.col("bad") / F.col("n"))
    rules = implied.select("items", F.col("bad").alias("support"), "confidence")
    return _without_narrower(stage(rules.filter(F.col("confidence") >= confidence), "rules"))


def _counted(holding: DataFrame) -> DataFrame:
    """``items, n, bad``: the transactions, and the unwanted ones, that have the items."""
    return holding.groupBy("items").agg(F.count("*").alias("n"), F.count_if("unwanted").alias("bad"))


def _needing_all(longer: DataFrame, growing: DataFrame) -> DataFrame:
    """Combinations that without any one of their items are all growing ones with more transactions."""
    less = longer.select("*", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("fewer"))
    kept = less.join(growing.select(F.col("items").alias("fewer"), F.col("n").alias("of_fewer")), "fewer").filter(F.col("of_fewer") > F.col("n"))
    whole = kept.groupBy("items").agg(F.any_value("n").alias("n"), F.any_value("bad").alias("bad"), F.count("*").alias("held"))
    return whole.filter(F.col("held") == F.size("items")).drop("held")


def _without_narrower(rules: DataFrame) -> DataFrame:
    """Rules without those that contain a rule of at least their own confidence."""
    subsets = F.aggregate(
        "items",
        F.array(F.array().cast("array<string>")),
        lambda have, item: F.concat(have, F.transform(have, lambda s: F.concat(s, F.array(item)))),
    )
    parts = rules.select(F.col("items").alias("whole"), F.col("confidence").alias("own"), F.explode(subsets).alias("items"))
    wider = parts.filter(F.size("items") < F.size("whole")).join(rules.select("items", "confidence"), "items")
    gone = wider.filter(F.col("confidence") >= F.col("own")).select(F.col("whole").alias("items"))
    return rules.join(gone, "items", "left_anti").select("items", "support", "confidence")


def _postings(mined: DataFrame) -> DataFrame:
    """``anchor, items, confidence``: each rule under the one of its tokens that the fewest rules have."""
    used = mined.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    spread = mined.select("items", "confidence", F.explode("items").alias("token")).join(used, "token")
    return spread.groupBy("items", "confidence").agg(F.min_by("token", F.struct("uses", "token")).alias("anchor"))


def _stated(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, host, path`` -> ``url, rule, verdict`` of the longest rule that fits."""
    sizes = rules.select(F.size(F.split("rule_host", r"\.")).alias("n")).agg(F.array_sort(F.collect_set("n"))).scalar()
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    hosts = urls.select("host").distinct().withColumn("sizes", sizes)
    endings = hosts.withColumn("n", F.explode(F.filter("sizes", lambda n: n <= F.size(labels))))
    endings = endings.select("host", F.array_join(F.slice(labels, -F.col("n"), F.col("n")), ".").alias("rule_host"))
    known = endings.join(lengths, "rule_host").select("host", "rule_host", F.explode("lengths").alias("n"))
    tried = urls.join(known, "host").filter(F.length("path") >= F.col("n")).select(
        "url", "rule_host", F.substring("path", F.lit(1), F.col("n")).alias("rule_path")
    )
    fits = tried.join(rules, ["rule_host", "rule_path"])
    text = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(text).alias("a"), F.length("rule_host").alias("b"), F.col("rule_verdict").alias("verdict"), text.alias("rule")))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")


def _fired(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """``url, items`` -> ``url, confidence, because`` of the surest mined rule whose tokens the url has."""
    met = urls.select("url", F.col("tokens"), F.explode("tokens").alias("anchor")).join(_postings(mined), "anchor")
    held = met.filter(F.size(F.array_except("items", "tokens")) == 0)
    best = F.max(F.struct("confidence", "items"))
    return held.groupBy("url").agg(best.alias("best")).select("url", "best.confidence", F.col("best.items").alias("because"))


def judge(pages: DataFrame, rules: DataFrame, mined: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keep, host, path, rule, verdict, confidence, because`` for every row of ``pages``.

    ``confidence`` and ``because`` are those of the surest mined rule, also
    where a stated rule decides.
    """
    urls = stage(
        pages.select("url").filter("url is not null").distinct()
        .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens")),
        "urls",
    )
    mined = stage(mined, "mined")
    decided = (
        urls.select("url", "host", "path").join(_stated(urls.select("url", "host", "path"), rules), "url", "left")
        .join(_fired(urls.select("url", "tokens"), mined), "url", "left")
    )
    method = F.when(F.col("confidence").isNotNull(), BLOCK).otherwise(ALLOW)
    columns = [F.col(f"`{c}`") for c in keep]
    return pages.select(*columns, F.col("url").alias("__url")).join(decided.withColumnRenamed("url", "__url"), "__url", "left").select(
        *columns,
        F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
        F.coalesce("verdict", method).alias("verdict"), "confidence", "because",
    )
