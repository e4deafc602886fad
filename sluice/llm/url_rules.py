"""URL filter by association rules, on DataFrame functions only.

Every URL becomes a set of tokens (host labels, path folders, query keys, file
ending). Labelled URLs with their label as one more token are mined by Spark's
FP-growth; rules whose consequence is the blocking label, with enough support
and confidence, are kept. They are matched by an inverted index: every rule is
filed under its rarest token, so a URL meets only rules that share a token with
it, and the rest of the rule's tokens are then looked up in the URL's set.
Fixed rules for hosts and paths come first.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Fixed rules of the contract: verdict, host and path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
BLOCK = "label=block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The URL's tokens: ``h=`` per host label with its suffix ``t=``, ``p=``
    per folder of the path, ``f=`` for the file ending, ``q=`` per query key.
    Numbers stand as ``#``, so that pages of one kind share tokens."""
    labels = F.split(host_of(url), r"\.")
    parts = F.split(path_of(url), "/")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "#")
    tagged = lambda tag, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(tag), plain(x)))
    ending = F.regexp_extract(F.element_at(parts, -1), r"\.([A-Za-z0-9]{1,8})$", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    all_tokens = F.concat(
        tagged("h=", labels), tagged("t=", F.slice(labels, -1, 1)), tagged("p=", parts),
        tagged("f=", F.array(ending)), tagged("q=", keys))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(all_tokens)).otherwise(
        F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8,
         min_count: int = 20) -> DataFrame:
    """``rule_id, tokens, confidence, count`` of the rules that block.

    ``labelled(url, blocked boolean)``; rows with a null in either are left
    out. A rule needs ``min_support`` of the labelled URLs and ``min_count`` of
    them as support, so the number of rules is bounded by the parameters and
    not by the table. Without a blocked URL there are no rules.
    """
    label = F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array(F.lit("label=allow")))
    baskets = settle(labelled.filter("url is not null and blocked is not null")
                     .select(F.concat(tokens_of(F.col("url")), label).alias("items")), "baskets")
    total = baskets.count()
    schema = "rule_id long, tokens array<string>, confidence double, count long"
    if not total:
        return baskets.sparkSession.createDataFrame([], schema)
    share = min(1.0, max(min_support, min_count / total))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter(F.element_at("consequent", 1) == BLOCK)
    return settle(rules.select(
        F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("tokens"),
        "confidence", F.round(F.col("support") * total).cast("long").alias("count")), "rules")


def index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rules filed under their rarest token by the counts ``tokens(token, n)``."""
    each = rules.select("rule_id", F.explode("tokens").alias("token"))
    rarest = (each.join(tokens, "token", "left").groupBy("rule_id")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("m"))
              .select("rule_id", F.col("m.token").alias("filed")))
    return settle(rules.join(rarest, "rule_id"), "rule-index")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, rule_id, confidence`` of the most confident rule of each distinct
    URL that any rule matches (ties: more support, then the smaller id)."""
    tokens = settle(urls.select("url").filter("url is not null").distinct()
                    .withColumn("tokens", tokens_of(F.col("url"))), "url-tokens")
    counts = tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    filed = index(rules, counts).withColumnRenamed("tokens", "needed")
    hits = (tokens.select("url", "tokens", F.explode("tokens").alias("token"))
            .join(filed, F.col("token") == F.col("filed"))
            .filter(F.size(F.array_except("needed", "tokens")) == 0))
    best = F.max(F.struct("confidence", "count", (-F.col("rule_id")).alias("order"), "rule_id"))
    return hits.groupBy("url").agg(best.alias("b")).select(
        "url", F.col("b.rule_id").alias("rule_id"), F.col("b.confidence").alias("confidence"))


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest fixed rule that fits, as struct(rule, verdict); null if none.
    A rule fits its host and all subdomains, where the path starts with its own."""
    fits = [(len(h + p), F.when(
        ((host == h) | host.endswith("." + h)) & path.startswith(p),
        F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))) for v, h, p in rules]
    return F.coalesce(*[column for _, column in sorted(fits, key=lambda x: -x[0])])


def judge(pages: DataFrame, labelled: DataFrame, key: str = "page_id", url: str = "url",
          fixed: tuple[tuple[str, str, str], ...] = RULES, **options) -> DataFrame:
    """One row per row of ``pages``: key, host, path, ``rule`` (the fixed rule
    that decides, or null), ``verdict``, ``rule_id`` and ``confidence`` of the
    mined rule the URL matches, if any.

    Defined cases: a null URL or one without ``://`` has an empty host and path
    and is allowed; repeated rows are judged alike; an empty table gives no
    rows; without labels nothing is mined and only fixed rules block; other
    columns are ignored. A URL that many rows share is matched once.
    """
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"))
    found = settle(match(rows, mine(labelled, **options)), "url-verdicts").withColumnRenamed("url", "u")
    out = (rows.join(found, F.col("url") == F.col("u"), "left")
           .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))))
    out = out.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), fixed))
    mined = F.when(F.col("rule_id").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("key").alias(key), "host", "path", F.col("fixed.rule").alias("rule"),
                      F.coalesce("fixed.verdict", mined).alias("verdict"), "rule_id", "confidence")


def _sql(min_support: float = 0.002, min_confidence: float = 0.8, min_count: int = 20) -> str:
    """DuckDB SQL for the verdicts on ``pages``: every subset of the tokens of
    every labelled URL is counted, in place of FP-growth."""
    fixed = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in fixed]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, fixed))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, fixed))
    plain = "regexp_replace({}, '[0-9]+', '#', 'g')"
    tagged = lambda tag, xs: f"list_transform(list_filter({xs}, lambda x: x <> ''), lambda x: '{tag}' || {plain.format('x')})"
    return rf"""
WITH u AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query FROM pages),
t AS (SELECT *, CASE WHEN contains(url, '://') THEN list_distinct(list_concat(
        {tagged('h=', "string_split(host, '.')")}, {tagged('t=', "[string_split(host, '.')[-1]]")},
        {tagged('p=', "string_split(path, '/')")},
        {tagged('f=', "[regexp_extract(string_split(path, '/')[-1], '[.]([A-Za-z0-9]{1,8})$', 1)]")},
        {tagged('q=', "list_transform(string_split(query, '&'), lambda x: string_split(x, '=')[1])")})) ELSE [] END AS tokens FROM u),
mark AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
bag AS (SELECT list_sort(tokens) AS tokens, bad FROM t JOIN mark ON doc_id = page_id WHERE url IS NOT NULL AND bad IS NOT NULL),
distinct_bag AS (SELECT tokens, sum(bad) AS bad, count(*) AS n FROM bag GROUP BY tokens),
subset AS (SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items, bad, n
           FROM (SELECT *, unnest(range(1, (1::BIGINT << len(tokens)))) AS mask FROM distinct_bag)),
rules AS (SELECT items FROM subset GROUP BY items
          HAVING sum(bad) >= ceil(least(1.0, greatest({min_support}, {min_count} / (SELECT count(*) FROM bag)::DOUBLE))
                                  * (SELECT count(*) FROM bag)) AND sum(bad) / sum(n)::DOUBLE >= {min_confidence})
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN EXISTS (SELECT 1 FROM rules WHERE list_has_all(t.tokens, rules.items)) THEN 'block' ELSE 'allow' END AS verdict
FROM t"""


SQL = _sql()
