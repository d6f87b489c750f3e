"""URL filter lists with dates, evaluated for every capture as they stood when it was fetched.

A list entry says from when on a pattern is listed, or no longer listed.  Of one list and pattern each entry holds until
the next one, so entries become validity intervals; a capture is on a list if one of its patterns (its host, the domains
above it, its host with the first part of the path) has a listing interval around the fetch time.

The as-of join works in time slots.  The last entry of every pattern and slot, carried forward over the slots in which
something happens, gives what holds at a slot's start; inside a slot entries and captures meet by pattern and slot.  So
a pattern with very many entries or captures is spread over its slots, only one row per slot of it is ever ordered
together, and what is left uneven is an ordinary skewed join, which adaptive execution splits.

Times are microseconds.  Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.sqltext import unused

SLOT = 3_600 * 1_000_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"
FIRST_PART = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def with_host(urls: DataFrame) -> DataFrame:
    """Adds host (lower case) and first path part; empty where the address has none."""
    return urls.withColumns(
        {
            "host": F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))),
            "part": F.coalesce(F.regexp_extract("url", FIRST_PART, 1), F.lit("")),
        }
    )


def patterns() -> str:
    """SQL for the (scope, pattern) pairs of an address with ``host`` and ``part``."""
    labels = "split(host, '[.]')"
    domains = (
        f"transform(sequence(1, greatest(size({labels}) - 1, 1)), "
        f"i -> named_struct('scope', 'domain', 'pattern', array_join(slice({labels}, i, size({labels})), '.')))"
    )
    host = "array(named_struct('scope', 'host', 'pattern', host))"
    prefix = "IF(part = '', array(), array(named_struct('scope', 'prefix', 'pattern', concat(host, '/', part))))"
    return f"IF(host = '', array(), concat({host}, {domains}, {prefix}))"


def listing_intervals(entries: DataFrame, asked: DataFrame, slot: int = SLOT) -> DataFrame:
    """list, scope, pattern, slot, since, until: within each slot asked for, when the pattern is listed.

    ``entries`` has list, scope, pattern, at, seq and listed; of entries at one time the one with the larger ``seq``
    holds.  ``asked`` has the distinct scope, pattern and slot of the captures.
    """
    key = ["list", "scope", "pattern"]
    dated = entries.where("list IS NOT NULL AND scope IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL")
    dated = dated.withColumn("slot", F.expr(f"floor(at / {slot})")).withColumn("seq", F.coalesce("seq", F.lit(0)))
    # Entries at one time count as one.
    dated = dated.groupBy(*key, "slot", "at").agg(F.max_by("listed", F.struct("seq", "listed")).alias("listed"))
    last = dated.groupBy(*key, "slot").agg(F.max_by("listed", "at").alias("last"))
    slots = asked.join(last.select(*key).distinct(), ["scope", "pattern"]).select(*key, "slot")
    slots = slots.withColumns({"last": F.lit(None).cast("boolean"), "wanted": F.lit(True)})
    both = last.withColumn("wanted", F.lit(False)).unionByName(slots)
    one = both.groupBy(*key, "slot").agg(F.max("last").alias("last"), F.max("wanted").alias("wanted"))
    before = Window.partitionBy(*key).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = one.withColumn("listed", F.last("last", ignorenulls=True).over(before)).where("wanted AND listed")
    carried = carried.select(*key, "slot", F.expr(f"slot * {slot}").alias("at"), F.lit(-1).alias("order"), "listed")
    inside = dated.join(slots.select(*key, "slot"), [*key, "slot"], "left_semi")
    inside = inside.select(*key, "slot", "at", F.lit(0).alias("order"), "listed")
    following = Window.partitionBy(*key, "slot").orderBy("at", "order")
    closed = carried.unionByName(inside).withColumn(
        "until", F.coalesce(F.lead("at").over(following), F.expr(f"(slot + 1) * {slot}"))
    )
    return closed.where("listed AND until > at").select(*key, "slot", F.col("at").alias("since"), "until")


def captures_on_lists(captures: DataFrame, entries: DataFrame, slot: int = SLOT) -> DataFrame:
    """Every row of ``captures`` (url, fetched_at and others) plus ``lists``, sorted and comma-separated, and ``blocked``.

    A null address or time is on no list.  Repeated captures each keep their row.
    """
    each = with_host(captures.where("url IS NOT NULL AND fetched_at IS NOT NULL").select("url", "fetched_at").distinct())
    keyed = each.selectExpr("url", "fetched_at", f"floor(fetched_at / {slot}) AS slot", f"inline({patterns()})")
    listed = listing_intervals(entries, keyed.select("scope", "pattern", "slot").distinct(), slot)
    hits = keyed.join(listed, ["scope", "pattern", "slot"]).where("fetched_at >= since AND fetched_at < until")
    name = unused("_lists", captures.columns)
    found = hits.groupBy("url", "fetched_at").agg(F.array_join(F.sort_array(F.collect_set("list")), ",").alias(name))
    joined = captures.join(found, ["url", "fetched_at"], "left")
    others = [c for c in captures.columns if c not in ("lists", "blocked")]
    return joined.select(
        *others, F.coalesce(name, F.lit("")).alias("lists"), F.col(name).isNotNull().alias("blocked")
    )


def example_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures, each with a fetch time in January 2024 that follows from its number."""
    at = F.expr("1704067200000000 + page_id * 104729 % 2678400 * 1000000")
    return pages.select("page_id", "url", at.alias("fetched_at"))


def example_entries(pages: DataFrame, events: DataFrame) -> DataFrame:
    """Dated entries from all events: the kind of event names the list, the page the event falls on the pattern."""
    sites = with_host(pages.select("page_id", "url"))
    count = pages.agg(F.coalesce(F.max("page_id") + 1, F.lit(1)).alias("n"))
    numbered = events.crossJoin(F.broadcast(count)).withColumn("page_id", F.expr("event_id % n"))
    scope = F.expr("element_at(array('host', 'domain', 'prefix'), CAST(event_id % 3 AS INT) + 1)")
    domain = "array_join(slice(split(host, '[.]'), greatest(size(split(host, '[.]')) - 2, 1), 3), '.')"
    pattern = F.expr(
        f"CASE event_id % 3 WHEN 0 THEN host WHEN 1 THEN {domain} ELSE concat(host, '/', part) END"
    )
    return numbered.join(sites, "page_id").select(
        F.col("event_type").alias("list"),
        scope.alias("scope"),
        pattern.alias("pattern"),
        F.expr("unix_micros(CAST(ts AS TIMESTAMP))").alias("at"),
        F.col("event_id").alias("seq"),
        F.expr("value >= 100").alias("listed"),
    )


ORACLE = r"""
    WITH sites AS (
      SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
             regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS part,
             1704067200000000 + page_id * 104729 % 2678400 * 1000000 AS fetched_at
      FROM pages),
    entries AS (
      SELECT event_type AS list, ['host', 'domain', 'prefix'][event_id % 3 + 1] AS scope,
             CASE event_id % 3 WHEN 0 THEN host
               WHEN 1 THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE host || '/' || part END AS pattern,
             epoch_us(ts) AS since, event_id AS seq, value >= 100 AS listed
      FROM events JOIN sites ON sites.page_id = event_id % (SELECT max(page_id) + 1 FROM pages)),
    keys AS (
      SELECT page_id, fetched_at, 'host' AS scope, host AS pattern FROM sites
      UNION ALL
      SELECT page_id, fetched_at, 'domain', array_to_string(string_split(host, '.')[i:], '.')
      FROM (SELECT *, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i FROM sites)
      UNION ALL
      SELECT page_id, fetched_at, 'prefix', host || '/' || part FROM sites WHERE part <> ''),
    states AS (
      SELECT page_id, k.scope, k.pattern, list, max_by(listed, (since, seq)) AS listed
      FROM keys k JOIN entries e ON k.scope = e.scope AND k.pattern = e.pattern AND e.since <= k.fetched_at
      GROUP BY ALL),
    found AS (
      SELECT page_id, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists FROM states WHERE listed GROUP BY 1)
    SELECT s.page_id, url, fetched_at, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked
    FROM sites s LEFT JOIN found f ON s.page_id = f.page_id"""
