"""URL rules by a sorted sweep over reversed hosts.

Reversed label by label and closed by a mark, hosts sort so that a host and all its
subdomains are one interval. So rules and urls are put into one sorted list, and a sweep
through it keeps a stack of the rules that are open: the number of open rules at each
place is a running sum of begins and ends, and the rule at each height of the stack is
the last one that began at this height. A second sweep of the same kind finds, among the
paths of each open host, the longest that begins the url's path.

The list is cut into cells that are swept on their own: ranges between rules, so that no
cell has more than `CELL_RULES` of them, times as many salts as the urls need; a rule is
put into all salts of the ranges it reaches. A url is swept once, however many rows have
it, and a host with a third of all urls is spread over the salts. Only DataFrame functions
are used.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table

CELL_RULES, CELL_URLS = 20_000, 200_000
#: Least number of salts.
LEAST_SALTS = 64
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Sorts before any character of a host or path, and after any.
_MARK, _LAST = "\u0001", "\U0010ffff"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A to Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed by a mark: a host's key begins all keys of its
    subdomains and no others."""
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, _MARK), F.lit(_MARK))


def open_prefixes(urls: DataFrame, key: str, prefixes: DataFrame, name: str) -> DataFrame:
    """`urls` with `name`: a row for each of the prefixes that begin its `key`; urls that
    none begins are left out. `prefixes` has the one column `name`, without nulls.

    Needs no columns of `urls` that begin with `_s`.
    """
    marks = kept(prefixes.select(F.col(name).alias("_sp")).distinct())
    many = marks.count()
    salts = max(LEAST_SALTS, math.ceil(urls.count() / CELL_URLS))
    # One prefix in CELL_RULES, by a hash, begins a range; the first of them is cell 0.
    cuts: list[str] = []
    if many > CELL_RULES:
        cuts = [r[0] for r in marks.filter(F.pmod(F.xxhash64("_sp"), F.lit(CELL_RULES)) == 0).collect()]
    borders = F.array(*[F.lit(c) for c in cuts]).cast("array<string>")

    def range_of(value: Column) -> Column:
        return F.size(F.filter(borders, lambda c: c <= value))

    begin, end = F.col("_sp"), F.concat("_sp", F.lit(_LAST))
    events = marks.select(
        F.explode(F.sequence(range_of(begin), range_of(end))).alias("_sg"),
        "_sp",
        F.explode(F.array(F.struct(begin.alias("at"), F.lit(1).alias("step")), F.struct(end.alias("at"), F.lit(-1).alias("step")))).alias("_se"),
    )
    events = events.withColumn("_ss", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "_sg", "_ss", F.col("_se.at").alias("_sk"), F.col("_se.step").alias("_st"), "_sp"
    )
    rows = urls.select(F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("_sr"), F.col(key).alias("_sk"))
    salt = F.pmod(F.xxhash64("_sr"), F.lit(salts)).cast("int")
    probes = rows.select(range_of(F.col("_sk")).alias("_sg"), salt.alias("_ss"), "_sk", F.lit(0).alias("_st"), "_sr")
    both = events.unionByName(probes, allowMissingColumns=True)
    # At one place: what ends, what begins (a longer one later, as its key is), urls.
    turn = F.when(F.col("_st") == -1, 0).when(F.col("_st") == 1, 1).otherwise(2)
    sweep = Window.partitionBy("_sg", "_ss").orderBy("_sk", turn)
    height = F.sum("_st").over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    swept = both.withColumn("_sh", height.cast("int")).filter((F.col("_st") >= 0) & (F.col("_sh") > 0))
    # A url asks at every height of the stack; a rule stands at its own.
    levels = F.when(F.col("_st") == 0, F.sequence(F.lit(1), "_sh")).otherwise(F.array("_sh"))
    asked = swept.withColumn("_sl", F.explode(levels))
    top = Window.partitionBy("_sg", "_ss", "_sl").orderBy("_sk", turn).rowsBetween(Window.unboundedPreceding, 0)
    found = asked.withColumn("_sf", F.last("_sp", ignorenulls=True).over(top)).filter("_st = 0")
    columns = [F.col(f"_sr.`{c}`") for c in urls.columns if c != name]
    return found.select(*columns, F.col("_sf").alias(name))


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`df` with `host`, `path`, `rule` and `verdict` of its urls.

    `rules` has host, path and verdict, all text. A rule fits its host and all subdomains,
    if the url's path begins with the rule's; of several the longest text of host and path
    wins, then the longer host, and of rules that differ in the verdict alone `block`.
    Without a rule that fits, `rule` is null and the verdict is the default. Null urls and
    urls without `://` have empty host and path, which no rule fits. Rules with a null or
    an empty host are no rules. Columns of these four names are replaced, others pass;
    repeated rows stay repeated. An empty table gives no rows.
    """
    new = ("host", "path", "rule", "verdict")
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new]
    rows = df.select(
        F.struct(*rest, F.lit(0).alias("_s0")).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    )
    valid = rules.filter("host != '' AND path IS NOT NULL AND verdict IS NOT NULL").select("host", "path", "verdict")
    valid = valid.withColumn("place", host_key(F.col("host")))
    names = valid.select("place", F.concat("place", "path").alias("prefix"), F.concat("host", "path").alias("rule"), "verdict", "host")
    names = kept(names.groupBy("prefix").agg(F.max_by(F.struct("rule", "verdict", F.length("host").alias("size")), "verdict").alias("r"), F.first("place").alias("place")))
    urls = kept(rows.select("host", "path").distinct().withColumn("key", host_key(F.col("host"))))
    hosts = open_prefixes(urls, "key", names.select("place"), "place")
    hosts = hosts.withColumn("key", F.concat("place", "path")).select("host", "path", "place", "key")
    found = open_prefixes(hosts, "key", names.select("prefix"), "prefix")
    # A longer host is a longer place; a path is looked for under its own host only.
    found = found.join(names.select("prefix", F.col("place").alias("own"), "r"), "prefix").filter("place = own")
    best = F.max(F.struct(F.length("r.rule").alias("length"), F.col("r.size").alias("size"), F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict")))
    judged = kept(found.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict"))
    out = rows.join(judged, ["host", "path"], "left")
    back = [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in new]
    return out.select(*back, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op5_reversed_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS x FROM pages
), u AS (
  SELECT page_id,
    translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS n
  FROM u, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT u.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM u LEFT JOIN m ON m.page_id = u.page_id AND n = 1
"""
