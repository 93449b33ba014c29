"""Not-modified revisits in web archives: each gets the full response that it stands for (operator 10)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import settled, settled_in_place, ship, table

#: Headers of a 304 that say nothing about the stored response: of the connection, or of the body it does not have.
NOT_MERGED = (
    "connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade", "content-length", "content-encoding", "content-type", "content-range",
)
#: Query parameters that do not change what a url names.
IGNORED_PARAMETERS = "utm_[^=&]*|ref|sessionid"


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, the scheme's default port and ignored parameters; host in lower case; an empty path is ``/``."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    rest = F.regexp_replace(bare, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    rest = F.regexp_replace(rest, rf"([?&])(?:(?:{IGNORED_PARAMETERS})=[^&]*(?:&|$))+", "$1")
    rest = F.regexp_replace(rest, r"[?&]$", "")
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    scheme = F.lower(F.regexp_extract(bare, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443").otherwise(":")
    named = F.when(F.endswith(host, port), F.substring(host, F.lit(1), F.length(host) - F.length(port))).otherwise(host)
    return F.when(host != "", F.concat(named, rest))


def latest_earlier(events: DataFrame) -> DataFrame:
    """``record_id, response_id``: for each row that is not ``full``, the last full one of its key strictly before it.

    ``events``: ``key, at, full, record_id``, ids of any type that has an order. Of full ones at the same time the greatest
    record_id counts. Rows are dealt out by ranges of (key, at), so that a key of very many rows spreads over partitions;
    what each partition ends with, a row each, reaches the driver, which says what the next one starts with.
    """
    spark = events.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "at", "full", "record_id"]
    kind = events.schema["record_id"].dataType.simpleString()
    dealt = settled_in_place(events.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()))

    def ends(batches):
        key, response, pid, ids = None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, full, ids = batch.column(0), np.asarray(batch.column(2)).astype(bool), batch.column(3)
            last = keys[-1].as_py()
            if last != key:
                key, response = last, None
            pid = batch.column(4)[0].as_py()
            found = np.flatnonzero(full & np.asarray(pc.equal(keys, last)))
            if len(found):
                response = ids[int(found[-1])].as_py()
        if pid is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([key]), pa.array([response], ids.type)], ["pid", "key", "response_id"])

    carried, start = (None, None), {}
    for pid, key, response in sorted(map(tuple, dealt.mapInArrow(ends, f"pid int, key string, response_id {kind}").collect()), key=lambda r: r[0]):
        start[pid] = carried
        if key != carried[0] or response is not None:
            carried = (key, response)
    before = spark.sparkContext.broadcast(start)

    def fill(batches):
        key, response = None, None
        begun = False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if not begun:
                key, response = before.value[batch.column(4)[0].as_py()]
                begun = True
            keys, full, ids = batch.column(0), np.asarray(batch.column(2)).astype(bool), batch.column(3)
            new = np.ones(n, dtype=bool)
            new[1:] = np.asarray(pc.not_equal(keys[1:], keys[:-1])) if n > 1 else []
            new[0] = keys[0].as_py() != key
            head = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            seen = np.maximum.accumulate(np.where(full, np.arange(n), -1))
            inside = (seen >= 0) & (seen >= head)
            # What the rows before this batch carry stands behind its own ids.
            place = np.where(inside, seen, np.where(head < 0, n, n + 1))
            answer = pa.concat_arrays([ids, pa.array([response, None], ids.type)]).take(pa.array(place))
            key, response = keys[-1].as_py(), answer[-1].as_py()
            ask = pa.array(~full)
            yield pa.RecordBatch.from_arrays([ids.filter(ask), answer.filter(ask)], ["record_id", "response_id"])

    return dealt.mapInArrow(fill, f"record_id {kind}, response_id {kind}")


def _header(headers: str, name: str) -> Column:
    return F.try_element_at(F.col(headers), F.lit(name))


def _lowered(headers: Column) -> Column:
    """Headers by their names in lower case; of names that differ in case alone the least value counts; null is empty."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_min(F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == n), lambda e: e["value"]))))


def resolved(captures: DataFrame) -> DataFrame:
    """One row for each revisit: ``record_id, url_key, response_id, outcome, headers, payload``.

    ``captures``: ``record_id, kind, target_uri, at, status, headers, payload``, one row for each record; ids are text, such as
    URNs, or numbers; header names count in lower case (of those that differ in case alone the least value). A revisit (kind ``revisit``, status 304) stands for the latest earlier
    record with kind ``response`` and status 200 of the same canonical url. If the 304 has an entity tag it must equal
    the response's, weak or strong; else its last-modified must. ``outcome``: ``resolved``; ``unverified`` if the 304
    has neither; ``mismatch``; ``missing`` if there is no such response, or no url or time. Unless it is ``missing``,
    response_id names the response. Resolved and unverified ones get the response's payload, and its headers with those
    of the 304 put over them that may be. Null maps count as empty. Rows that repeat a revisit are answered each. Of
    rows that repeat a response's record id the one with the least payload, then the least headers, counts. A revisit
    with a null record id is missing its response; an empty table has no rows. Extra columns are ignored.
    """
    rows = captures.select("record_id", "kind", "at", "status", _lowered(F.col("headers")).alias("headers"), "payload", canonical_url(F.col("target_uri")).alias("url_key"))
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))
    revisit = F.coalesce((F.col("kind") == "revisit") & (F.col("status") == 304), F.lit(False))
    events = rows.where((full | revisit) & F.col("record_id").isNotNull() & F.col("url_key").isNotNull() & F.col("at").isNotNull()).select(F.col("url_key").alias("key"), "at", full.alias("full"), "record_id")
    pairs = settled(latest_earlier(events).where("response_id is not null").distinct().withColumnRenamed("record_id", "_asks"))
    asks = rows.where(revisit).select("record_id", "url_key", "headers")
    found = asks.join(pairs, asks["record_id"] == pairs["_asks"], "left").drop("_asks")
    # Only responses that something stands for are grouped; of the others no payload moves.
    named = rows.where(full).join(pairs.select(F.col("response_id").alias("_id")).distinct(), F.col("record_id") == F.col("_id"), "left_semi")
    first = F.min_by(F.struct("headers", "payload"), F.struct("payload", F.to_json("headers"))).alias("given")
    given = named.groupBy(F.col("record_id").alias("_id")).agg(first).select("_id", F.col("given.headers").alias("base"), F.col("given.payload").alias("payload"))
    both = found.join(given, F.col("response_id") == F.col("_id"), "left")
    tag, base_tag = (F.regexp_replace(_header(h, "etag"), "^W/", "") for h in ("headers", "base"))
    changed, base_changed = _header("headers", "last-modified"), _header("base", "last-modified")
    outcome = (
        F.when(F.col("_id").isNull(), "missing")
        .when(tag.isNotNull(), F.when(tag.eqNullSafe(base_tag), "resolved").otherwise("mismatch"))
        .when(changed.isNotNull(), F.when(changed.eqNullSafe(base_changed), "resolved").otherwise("mismatch"))
        .otherwise("unverified")
    )
    both = both.withColumn("outcome", outcome)
    taken = F.col("outcome").isin("resolved", "unverified")
    over = F.map_filter("headers", lambda k, v: ~k.isin(*NOT_MERGED))
    merged = F.map_concat(F.map_filter("base", lambda k, v: ~F.map_contains_key(over, k)), over)
    return both.select("record_id", "url_key", "response_id", "outcome", F.when(taken, merged).alias("headers"), F.when(taken, F.col("payload")).alias("payload"))


def captures_of(pages: DataFrame) -> DataFrame:
    """An archive of two records for each page: its full response, and a 304 some time after it.

    Pages have no times, so these follow from page_id: a response each minute, the 304 half a minute later and up to
    six days. The 304's validator is the page's entity tag, its weak form, its last-modified, or none, in turn. Every
    eleventh has a validator of something else; every thirteenth 304 has no time, every seventeenth one before all responses.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    tag = F.concat(F.lit('"'), F.substring(F.sha1("html"), 1, 16), F.lit('"'))
    changed = F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    text = lambda *pairs: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in pairs])
    response = page.select(
        (2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("kind"), "target_uri", (60 * F.col("page_id")).alias("at"), F.lit(200).alias("status"),
        text("etag", tag, "last-modified", changed, "content-type", "text/html", "cache-control", "max-age=60", "content-length", F.octet_length("html").cast("string")).alias("headers"),
        F.col("html").alias("payload"),
    )
    turn = F.pmod("page_id", F.lit(4))
    other = F.pmod("page_id", F.lit(11)) == 3
    tag, changed = F.when(other, F.lit('"other"')).otherwise(tag), F.when(other, F.lit("another day")).otherwise(changed)
    at = F.when(F.pmod("page_id", F.lit(13)) == 5, F.lit(None)).when(F.pmod("page_id", F.lit(17)) == 7, F.lit(-1)).otherwise(60 * F.col("page_id") + 30 + F.pmod("page_id", F.lit(7)) * 86_400)
    validator = F.when(turn == 0, text("etag", tag)).when(turn == 1, text("etag", F.concat(F.lit("W/"), tag))).when(turn == 2, text("last-modified", changed)).otherwise(F.create_map().cast("map<string,string>"))
    again = page.select(
        (2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("kind"), "target_uri", at.cast("long").alias("at"), F.lit(304).alias("status"),
        F.map_concat(validator, text("cache-control", "max-age=3600", "content-length", "0", "connection", "close")).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return response.union(again)


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolved(captures_of(table(spark, sf_dir, "pages")))
    names = {"etag": "etag", "last_modified": "last-modified", "content_type": "content-type", "cache_control": "cache-control", "content_length": "content-length", "connection": "connection"}
    return found.select("record_id", "url_key", "response_id", "outcome", *[_header("headers", h).alias(c) for c, h in names.items()], F.sha2("payload", 256).alias("payload_sha256"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, '"' || substr(sha1(coalesce(html, '')), 1, 16) || '"' AS tag, 'day ' || (page_id % 28) AS changed,
         regexp_replace(trim(url), '(?s)#.*$', '') AS bare FROM pages
), u AS (
  SELECT *, lower(regexp_extract(bare, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) AS host, lower(regexp_extract(bare, '(?s)^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
    regexp_replace(regexp_replace(regexp_replace(bare, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', ''), '([?&])(?:(?:utm_[^=&]*|ref|sessionid)=[^&]*(?:&|$))+', '\\1', 'g'), '[?&]$', '') AS rest FROM p
), k AS (
  SELECT *, CASE WHEN host <> '' THEN CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '') WHEN 'https' THEN regexp_replace(host, ':443$', '') ELSE regexp_replace(host, ':$', '') END || CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END END AS url_key FROM u
), f AS (
  SELECT url_key AS key, 60 * page_id AS at, 2 * page_id AS response_id, tag AS base_tag, changed AS base_changed, html, strlen(html)::VARCHAR AS length FROM k WHERE url_key IS NOT NULL
), a AS (
  SELECT 2 * page_id + 1 AS record_id, url_key, CASE WHEN page_id % 13 = 5 THEN NULL WHEN page_id % 17 = 7 THEN -1 ELSE 60 * page_id + 30 + page_id % 7 * 86400 END AS at, page_id % 4 AS turn,
    CASE WHEN page_id % 11 = 3 THEN '"other"' ELSE tag END AS tag, CASE WHEN page_id % 11 = 3 THEN 'another day' ELSE changed END AS changed FROM k
), j AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN turn < 2 THEN CASE WHEN tag = base_tag THEN 'resolved' ELSE 'mismatch' END
    WHEN turn = 2 THEN CASE WHEN changed = base_changed THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS outcome
  FROM a ASOF LEFT JOIN f ON a.url_key = f.key AND a.at > f.at
)
SELECT record_id, url_key, response_id, outcome, CASE WHEN ok THEN CASE WHEN turn = 1 THEN 'W/' || tag ELSE base_tag END END AS etag,
  CASE WHEN ok THEN base_changed END AS last_modified, CASE WHEN ok THEN 'text/html' END AS content_type, CASE WHEN ok THEN 'max-age=3600' END AS cache_control,
  CASE WHEN ok THEN length END AS content_length, CAST(NULL AS VARCHAR) AS connection, CASE WHEN ok THEN sha256(html) END AS payload_sha256
FROM (SELECT *, outcome IN ('resolved', 'unverified') AS ok FROM j)
"""
