"""URL filters: a temporal join of captures with dated list entries.

A list is a log of dated entries: at a time, a key (a host, a domain, or a host
with a path prefix) is added to or removed from a category, to block or to
allow. The log becomes validity intervals, from an entry to the next one of the
same key and category. Every capture is evaluated as of its fetch time: its
URL gives its possible keys (the host's domains, the path's prefixes), these
meet the intervals by key, and those valid at the fetch time count. The most
specific key decides; on equal keys a block wins.

Distinct (key, fetch time) pairs of a hot host are evaluated once, so a host
that holds a third of all captures meets its intervals once per fetch time, and
the join is an equi-join on the key that adaptive execution can split.

A URL's possible keys go as deep as the list's own keys do. The host is what stands
between the scheme (or a leading //) and the path without user information, port
and a trailing dot.

Defined results: URLs without a host match no entry and are kept; NULL fetch
times match no interval; entries of one key, category and time count in the
order removed, added, so the later state is 'added'; an entry is valid from its
own time on, and no longer at the time of the next; repeated captures are each
evaluated; empty lists keep everything; an empty capture table gives no rows;
of the captures, only the id, the URL and the time are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import table

_SCHEME = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?"


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), _SCHEME + r"(\[[^\]/?#]*\]|[^/:?#]*?)\.?(?=[/:?#]|$)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + r"[^/?#]+(/[^?#]*)", 1)


def keys_of(url: Column, depth: int) -> Column:
    """array<struct<key, rank>>: the URL's possible keys with up to `depth` path segments, more specific ones with a higher rank."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.concat_ws(".", F.slice(labels, n - i + 1, i)).alias("key"), i.alias("rank")))
    parts = F.filter(F.split(path(url), "/"), lambda p: p != "")
    depths = F.filter(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(depth))), lambda i: i > 0)
    prefixes = F.transform(depths, lambda i: F.struct(
        F.concat_ws("/", host(url), F.concat_ws("/", F.slice(parts, 1, i))).alias("key"), (n + i).alias("rank")))
    return F.when(host(url) != "", F.concat(domains, prefixes)).otherwise(F.array().cast("array<struct<key:string,rank:int>>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, category, action, valid_from, valid_to) from the log (key, category, action, change, changed_at):
    change is 'add' or 'remove'; valid_to is NULL while an entry stands."""
    w = W.partitionBy("key", "category").orderBy("changed_at", F.when(F.col("change") == "add", 1).otherwise(0), "action")
    return entries.withColumn("valid_to", F.lead("changed_at").over(w)).where(
        (F.col("change") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("changed_at")))).select(
        "key", "category", "action", F.col("changed_at").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, url, fetched_at, verdict, matched_key, category) of captures (id, url, fetched_at)."""
    # path segments of the deepest key of the list
    depth = spans.agg(F.coalesce(F.max(F.size(F.split("key", "/"))), F.lit(1))).first()[0] - 1
    distinct = captures.groupBy("id", "url", "fetched_at").agg(F.count("*").alias("copies"))
    asked = distinct.select("id", "url", "fetched_at", "copies", F.explode_outer(keys_of(F.col("url"), depth)).alias("k")).select(
        "id", "url", "fetched_at", "copies", F.col("k.key").alias("key"), F.col("k.rank").alias("rank"))
    # each key is evaluated once per fetch time, however many captures share it
    points = asked.select("key", "fetched_at").where("key IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    active = points.join(spans, "key").where(
        (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    decided = active.groupBy("key", "fetched_at").agg(F.max(F.struct(
        (F.col("action") == "block").alias("blocks"), "category")).alias("hit"))
    best = F.max(F.when(F.col("hit").isNotNull(), F.struct("rank", "key", "hit")))
    return asked.join(decided, ["key", "fetched_at"], "left").groupBy("id", "url", "fetched_at").agg(
        best.alias("b"), F.max("copies").cast("int").alias("copies")).select(
        "id", "url", "fetched_at",
        F.when(F.col("b.hit.blocks"), "block").when(F.col("b").isNotNull(), "allow").otherwise("keep").alias("verdict"),
        F.col("b.key").alias("matched_key"), F.col("b.hit.category").alias("category"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


# ---- the query: a list log derived from the pages' hosts ------------------------------------------------------------

DAY = 86400
# every statement runs in Spark and in DuckDB: entries and their days come from the hosts and their first pages
CAPTURES_SQL = """
SELECT page_id AS id, url, CAST(page_id % 365 AS BIGINT) AS fetched_at FROM pages
"""
HOSTS_SQL = """
SELECT host, MIN(page_id) AS first_id, COUNT(*) AS n FROM (
  SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages) AS h WHERE host <> '' GROUP BY host
"""
LOG_SQL = """
SELECT host AS key, 'spam' AS category, 'block' AS action, 'add' AS change, first_id * 7 % 200 AS changed_at FROM hosts WHERE first_id % 3 <> 0
UNION ALL SELECT host, 'spam', 'block', 'remove', first_id * 7 % 200 + 40 + first_id % 90 FROM hosts WHERE first_id % 3 = 1
UNION ALL SELECT host, 'spam', 'block', 'add', first_id * 7 % 200 + 150 FROM hosts WHERE first_id % 6 = 1
UNION ALL SELECT host || '/en', 'news', 'allow', 'add', first_id * 11 % 300 FROM hosts WHERE first_id % 2 = 0
UNION ALL SELECT 'example.org', 'parked', 'block', 'add', 100 FROM hosts WHERE first_id = (SELECT MIN(first_id) FROM hosts)
UNION ALL SELECT 'example.org', 'parked', 'block', 'remove', 220 FROM hosts WHERE first_id = (SELECT MIN(first_id) FROM hosts)
"""


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL evaluated at its fetch day against a dated list derived from the pages' hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = spark.sql(CAPTURES_SQL.replace("FROM pages", "FROM {pages}"), pages=pages)
    hosts = spark.sql(HOSTS_SQL.replace("FROM pages", "FROM {pages}"), pages=pages)
    log = spark.sql(LOG_SQL.replace("FROM hosts", "FROM {hosts}"), hosts=hosts)
    return evaluate(captures, intervals(log)).withColumnRenamed("id", "page_id")


def op1_sql() -> str:
    """DuckDB form: every capture against the latest entry of each key and category at its time."""
    return f"""
WITH captures AS ({CAPTURES_SQL}), hosts AS ({HOSTS_SQL}), log AS ({LOG_SQL}),
c AS (SELECT *, string_split(h, '.') AS l, list_filter(string_split(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+(/[^?#]*)', 1), '/'), lambda x: x <> '') AS p
      FROM (SELECT *, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS h FROM captures) AS x),
asked AS (SELECT id, url, fetched_at, array_to_string(l[len(l) - i + 1:], '.') AS key, i AS rank FROM c, unnest(range(1, len(l) + 1)) AS t(i) WHERE h <> ''
  UNION ALL SELECT id, url, fetched_at, h || '/' || array_to_string(p[1:i], '/') AS key, len(l) + i AS rank FROM c, unnest(range(1, len(p) + 1)) AS t(i)
  WHERE h <> ''),
state AS (SELECT a.id, a.url, a.fetched_at, a.key, a.rank, g.category, arg_max(g.action, (g.changed_at, g.change = 'add')) AS action,
                 arg_max(g.change, (g.changed_at, g.change = 'add')) AS change
          FROM asked a JOIN log g ON a.key = g.key AND g.changed_at <= a.fetched_at GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY id, url, fetched_at ORDER BY rank DESC, key DESC, action = 'block' DESC, category DESC) AS r
         FROM state WHERE change = 'add')
SELECT c.id AS page_id, c.url, c.fetched_at, COALESCE(b.action, 'keep') AS verdict, b.key AS matched_key, b.category
FROM captures c LEFT JOIN best b ON b.r = 1 AND c.id = b.id AND c.url = b.url AND c.fetched_at = b.fetched_at"""
