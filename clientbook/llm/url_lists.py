"""URL filters by a temporal list join.

A list is a log of dated changes: an entry is added or removed on a day. The log becomes
validity intervals, and each capture is judged by the entries that were active on the day it
was fetched, whatever the list says today.

Only the distinct (host, day) pairs of the captures are joined, which also folds a host that
holds a third of all captures into one row per day. Intervals and captures meet on entry and
month, so an entry with a long history is not compared with captures of other times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clientbook.llm.common import table

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
#: Validity of an entry that is never removed ends here.
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL; null where there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(F.length(found) > 0, found)


def intervals(changes: DataFrame) -> DataFrame:
    """(entry, valid_from, valid_to) from (entry, action, changed_on).

    ``action`` is ``add`` or ``remove``. ``valid_to`` is excluded. If both happen on one day the
    removal counts. Repeated additions continue an interval as a new one with the later
    start. Rows with a null entry, action or day are ignored.
    """
    daily = (
        changes.filter("entry IS NOT NULL AND changed_on IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("entry", "changed_on")
        .agg(F.max("action").alias("action"))
    )
    following = F.lead("changed_on").over(Window.partitionBy("entry").orderBy("changed_on"))
    return (
        daily.withColumn("valid_to", F.coalesce(following, F.lit(FOREVER).cast("date")))
        .filter("action = 'add'")
        .select("entry", F.col("changed_on").alias("valid_from"), "valid_to")
    )


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def active_entries(visits: DataFrame, valid: DataFrame) -> DataFrame:
    """Per distinct (host, fetched_on): how many entries were active, and the most specific.

    An entry covers its host and all hosts below it. The longest active entry is reported,
    with the day from which it was valid. Visits without an active entry have no row.
    """
    seen = visits.filter("host IS NOT NULL AND fetched_on IS NOT NULL").distinct()
    labels = F.split("host", r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size("labels")),
        lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."),
    )
    asked = (
        seen.withColumn("labels", labels)
        .select("host", "fetched_on", F.explode(F.array_distinct(names)).alias("entry"))
        .withColumn("month", _month(F.col("fetched_on")))
    )
    # The months that captures can have bound what an open-ended interval is spread over.
    bounds = seen.agg(
        F.min(_month(F.col("fetched_on"))).alias("low"), F.max(_month(F.col("fetched_on"))).alias("high")
    )
    first = F.greatest(_month(F.col("valid_from")), F.col("low"))
    last = F.least(_month(F.date_sub("valid_to", 1)), F.col("high"))
    spread = (
        valid.join(F.broadcast(bounds))
        .withColumn("first", first)
        .withColumn("last", last)
        .filter("first <= last AND valid_from < valid_to")
        .select("entry", "valid_from", "valid_to", F.explode(F.sequence("first", "last")).alias("month"))
    )
    return (
        asked.join(spread, ["entry", "month"])
        .filter("fetched_on >= valid_from AND fetched_on < valid_to")
        .groupBy("host", "fetched_on")
        .agg(
            F.count("*").alias("n_active"),
            F.max(F.struct(F.length("entry").alias("size"), F.col("entry"), F.col("valid_from"))).alias("top"),
        )
        .select("host", "fetched_on", "n_active", "top.entry", "top.valid_from")
    )


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (with ``url`` and ``fetched_on``) plus the ``list_`` columns of the decision.

    ``list_blocked`` is true if an entry that covers the host was active on the day of the
    fetch. A null or relative URL, or a null day, matches nothing. Repeated captures are judged
    alike; other columns are kept, names starting with ``list_`` are for the operator.
    """
    hosted = captures.withColumn("list_host", host_of(F.col("url")))
    found = active_entries(
        hosted.select(F.col("list_host").alias("host"), "fetched_on"), intervals(changes)
    ).select(
        F.col("host").alias("list_on_host"),
        F.col("fetched_on").alias("list_on_day"),
        F.col("n_active").alias("list_active"),
        F.col("entry").alias("list_entry"),
        F.col("valid_from").alias("list_since"),
    )
    return (
        hosted.join(
            found,
            (F.col("list_host") == F.col("list_on_host")) & (F.col("fetched_on") == F.col("list_on_day")),
            "left",
        )
        .drop("list_on_host", "list_on_day")
        .withColumn("list_active", F.coalesce("list_active", F.lit(0)).cast("bigint"))
        .withColumn("list_blocked", F.col("list_active") > 0)
    )


def _number(text: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(text), at, 4), 16, 10).cast("int")


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages with a day of 2024 as their fetch day, drawn from a hash of the page id."""
    key = F.concat(F.lit("fetch:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return pages.select(
        "page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), _number(key, 1) % 366).alias("fetched_on")
    )


def host_changes(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of the pages and the domains above them.

    Hash-drawn: about 3 of 8 hosts and domains are added on some day; 3 in 4 of those are removed
    up to 120 days later, and half of the removed come back up to 90 days after that.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host IS NOT NULL").distinct()
    domain = F.regexp_replace("host", r"^[^.]+\.", "")
    names = hosts.select(F.explode(F.array("host", domain)).alias("entry")).filter(
        "entry LIKE '%.%'"
    ).distinct()
    name = F.col("entry")
    added = F.date_add(F.lit("2024-01-01").cast("date"), _number(name, 5) % 300)
    removed = F.date_add(F.col("added"), _number(name, 9) % 120 + 1)
    again = F.date_add(F.col("removed"), _number(name, 13) % 90 + 1)
    fate = _number(name, 17) % 8
    dated = (
        names.filter(_number(name, 1) % 8 < 3)
        .withColumn("added", added)
        .withColumn("removed", removed)
        .withColumn("again", again)
        .withColumn("fate", fate)
    )
    change = lambda action, day, when: F.when(
        when, F.struct(F.lit(action).alias("action"), F.col(day).alias("changed_on"))
    )
    changes = F.array_compact(
        F.array(
            change("add", "added", F.lit(True)),
            change("remove", "removed", F.col("fate") < 6),
            change("add", "again", F.col("fate") < 3),
        )
    )
    return dated.select("entry", F.explode(changes).alias("change")).select("entry", "change.*")


def query(spark, folder: str) -> DataFrame:
    """Every capture judged by the list entries in force when it was fetched; lists and days come from the pages."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = judge(page_captures(pages), host_changes(pages))
    return judged.select(
        "page_id",
        F.col("list_host").alias("host"),
        F.col("fetched_on").cast("string").alias("fetched_on"),
        F.col("list_active").alias("n_active"),
        F.col("list_blocked").alias("blocked"),
        F.col("list_entry").alias("entry"),
        F.col("list_since").cast("string").alias("listed_since"),
    )


SQL = r"""
WITH hosted AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
    DATE '2024-01-01' + CAST(CAST('0x' || substr(md5('fetch:' || coalesce(CAST(page_id AS VARCHAR), '')), 1, 4) AS INT) % 366 AS INT) AS day
  FROM pages),
names AS (
  SELECT host AS entry FROM hosted WHERE host LIKE '%.%'
  UNION SELECT regexp_replace(host, '^[^.]+\.', '') FROM hosted
        WHERE regexp_replace(host, '^[^.]+\.', '') LIKE '%.%'),
drawn AS (
  SELECT entry, md5(entry) AS d FROM names),
dated AS (
  SELECT entry, CAST('0x' || substr(d, 17, 4) AS INT) % 8 AS fate,
    DATE '2024-01-01' + CAST(CAST('0x' || substr(d, 5, 4) AS INT) % 300 AS INT) AS a,
    CAST(CAST('0x' || substr(d, 9, 4) AS INT) % 120 + 1 AS INT) AS stay,
    CAST(CAST('0x' || substr(d, 13, 4) AS INT) % 90 + 1 AS INT) AS pause
  FROM drawn WHERE CAST('0x' || substr(d, 1, 4) AS INT) % 8 < 3),
valid AS (
  SELECT entry, a AS f, CASE WHEN fate < 6 THEN a + stay ELSE DATE '9999-12-31' END AS t FROM dated
  UNION ALL
  SELECT entry, a + stay + pause, DATE '9999-12-31' FROM dated WHERE fate < 3),
visits AS (SELECT DISTINCT host, day FROM hosted WHERE host IS NOT NULL),
asked AS (
  SELECT DISTINCT host, day, array_to_string(list_slice(l, i, len(l)), '.') AS entry
  FROM (SELECT host, day, string_split(host, '.') AS l FROM visits), LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)),
found AS (
  SELECT host, day, count(*) AS n, max({'s': length(a.entry), 'e': a.entry, 'f': f}) AS top
  FROM asked a JOIN valid v ON a.entry = v.entry AND day >= f AND day < t GROUP BY host, day)
SELECT h.page_id, h.host, CAST(h.day AS VARCHAR) AS fetched_on, coalesce(n, 0) AS n_active,
  n IS NOT NULL AS blocked, top.e AS entry, CAST(CAST(top.f AS DATE) AS VARCHAR) AS listed_since
FROM hosted h LEFT JOIN found f ON h.host = f.host AND h.day = f.day
"""
