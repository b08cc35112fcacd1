"""URL filtering by explicit rules and by mined association rules.

Explicit rules name a host and a path prefix; the longest that fits decides.
For other URLs, FP-growth mines combinations of URL tokens from the labelled
URLs (here: those that an explicit rule decides). Tokens that are always together on
labelled URLs are one item (a deep path that many URLs share would else give every
subset of its segments). Rules whose confidence and
support are high enough are kept, unless a part of their items already says
the same with no less confidence: sub-rules are looked up, from the smallest rules on.
They are matched by an inverted index from token to item to rule: a rule fires if the URL
has a token of each of its items, just as the rules of all those token combinations would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
#: Rows that one row becomes at a time where URLs are written out as often as they occur.
COPIES = 1_024


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased) and path (then up to ``?``, ``#`` or the end); both are empty
    if the url is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)


def _values(spark, rows: list[tuple[str, str, str]]) -> DataFrame:
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if not rows:
        return spark.sql("SELECT '' AS rule_host, '' AS rule_path, '' AS rule_verdict WHERE false")
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({', '.join(map(quote, r))})" for r in rows) + " AS t(rule_host, rule_path, rule_verdict)")


def explicit_verdicts(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) of ``urls`` that a
    rule (host, path, verdict) fits: its host or a subdomain, and its path is a
    prefix. The longest rule wins; of equally long ones the smallest."""
    labels = F.split("host", r"\.")
    longest = max((host.count(".") + 1 for host, *_ in rules), default=1)
    # the ends of the host that a rule can name
    ends = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - (longest - 1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ended = urls.select("host", "path", F.explode(ends).alias("rule_host"))
    fits = ended.join(_values(urls.sparkSession, rules), "rule_host").where(F.startswith("path", "rule_path"))
    rule = F.concat("rule_host", "rule_path")
    best = F.min(F.struct((-F.length(rule)).alias("l"), rule.alias("rule"), F.col("rule_verdict").alias("verdict")))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, the host's last two labels, path segments."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    site = F.when(F.size(labels) > 1, F.array(F.concat(F.lit("s:"), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.transform(labels, lambda x: F.concat(F.lit("h:"), x)), site, F.transform(segments, lambda x: F.concat(F.lit("p:"), x))))


def token_items(kinds: DataFrame) -> DataFrame:
    """(token, item): tokens that are on the same rows of (kind long, tokens) share an
    item, named after the first of them."""
    on = kinds.select("kind", F.explode("tokens").alias("token")).groupBy("token")
    # the same rows: as many, and of equal sums of two row hashes
    marks = [F.sum(F.xxhash64(F.lit(x), "kind").cast("decimal(38,0)")).alias(x) for x in ("x", "y")]
    marked = on.agg(F.count("*").alias("many"), *marks)
    first = marked.groupBy("many", "x", "y").agg(F.min("token").alias("item"))
    return marked.join(first, ["many", "x", "y"]).select("token", "item")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """((id, items, verdict, confidence, support), (token, item)): association rules from item
    combinations to a verdict, mined from (tokens, verdict, n): n URLs of a kind."""
    spark = labelled.sparkSession
    kinds = labelled.where("n > 0 AND size(tokens) > 0").withColumn("kind", F.xxhash64("tokens"))
    kinds = materialise(kinds.select("kind", "tokens", "verdict", "n"), "url-kinds")
    items = materialise(token_items(kinds.select("kind", "tokens").distinct()), "url-items")
    if kinds.isEmpty():
        return spark.sql("SELECT '' AS id, array('') AS items, '' AS verdict, 0D AS confidence, 0D AS support WHERE false"), items
    of_kind = kinds.select("kind", F.explode("tokens").alias("token")).join(items, "token").groupBy("kind").agg(F.collect_set("item").alias("items"))
    said = F.concat("items", F.array(F.concat(F.lit("="), "verdict")))
    blocks = kinds.join(of_kind, "kind").select(said.alias("items"), "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")).alias("block"))
    dealt = blocks.repartition("items", "block")
    rows = dealt.select("items", F.explode(F.expr(f"sequence(1L, least({COPIES}L, n - block * {COPIES}))")).alias("copy")).select("items")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(rows)
    said = F.element_at("consequent", 1)
    found = model.associationRules.where(F.startswith(said, F.lit("=")) & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit("="))))
    own = F.array_sort("antecedent")
    rules = materialise(found.select(F.array_join(own, " ").alias("id"), own.alias("items"), F.substring(said, 2, 1000).alias("verdict"), "confidence", "support"), "url-rules")
    return _unspared(rules, min_confidence), items


def _unspared(rules: DataFrame, min_confidence: float) -> DataFrame:
    """The rules of ``min_confidence`` of which no part has the verdict with no less confidence.

    ``rules`` holds every part of its rules. From one size to the next, ``best`` is the highest
    confidence of a rule and its parts, looked up from its parts of one item less.
    """
    done, last = [], None
    for size in range(1, (rules.agg(F.max(F.size("items"))).first()[0] or 0) + 1):
        now = rules.where(F.size("items") == size)
        if last is None:
            now = now.withColumn("below", F.lit(-1.0))
        else:
            parts = now.select("id", "verdict", F.explode(F.transform("items", lambda x: F.array_join(F.array_remove("items", x), " "))).alias("part"))
            below = parts.join(last.select(F.col("id").alias("part"), "verdict", "best"), ["part", "verdict"]).groupBy("id", "verdict").agg(F.max("best").alias("below"))
            now = now.join(below, ["id", "verdict"], "left").withColumn("below", F.coalesce("below", F.lit(-1.0)))
        last = materialise(now.withColumn("best", F.greatest("confidence", "below")).select("id", "items", "verdict", "confidence", "support", "below", "best"), "url-rules-by-size")
        done.append(last.where((F.col("confidence") >= min_confidence) & (F.col("below") < F.col("confidence"))))
    out = reduce(DataFrame.union, done) if done else rules.withColumns({"below": F.lit(0.0), "best": F.lit(0.0)})
    return out.select("id", "items", "verdict", "confidence", "support")


def mined_verdicts(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(host, path, verdict) of the distinct (host, path, tokens) of ``urls`` on
    which a mined rule fires: the most confident, best supported, longest one."""
    index = rules.select("id", "verdict", "confidence", "support", F.size("items").alias("n"), F.explode("items").alias("item")).join(items, "item")
    hits = urls.select("host", "path", F.explode("tokens").alias("token")).join(index, "token")
    rule = ["host", "path", "id", "verdict", "confidence", "support", "n"]
    # of an item's tokens the last one names the combination
    by_item = hits.groupBy(*rule, "item").agg(F.max("token").alias("token"))
    fired = by_item.groupBy(*rule).agg(F.array_sort(F.collect_list("token")).alias("tokens")).where(F.size("tokens") == F.col("n"))
    best = F.max(F.struct("confidence", "support", "n", F.array_join("tokens", " ").alias("name"), "verdict"))
    return fired.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.verdict")


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    ``rules`` are (host, path, verdict) and decide first; ``rule`` names the one
    that did, else it is null and the verdict is that of the mined rules, or
    ``default`` where none fires (also for null urls and urls without a host).
    Verdicts depend on host and path alone, so they are found once for each
    distinct pair; repeated rows are repeated.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = materialise(rows.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("tokens", url_tokens(F.col("host"), F.col("path"))), "urls")
    ruled = materialise(explicit_verdicts(urls, rules), "urls-ruled")
    labelled = urls.join(ruled, ["host", "path"]).groupBy("tokens", "verdict").agg(F.sum("n").alias("n"))
    mined, items = mine_rules(labelled, min_support, min_confidence)
    rest = mined_verdicts(urls.join(ruled, ["host", "path"], "left_anti"), materialise(mined, "url-rules-kept"), items).select("host", "path", F.lit(None).cast("string").alias("rule"), "verdict")
    known = materialise(ruled.unionByName(rest), "urls-judged")
    return rows.join(known, ["host", "path"], "left").select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
