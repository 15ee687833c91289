"""Not-modified revisit records of web archives, resolved by an as-of join.

A revisit stands for a fetch that the server answered with "not modified". It is resolved to the latest earlier full
response of the same canonical URL if their validators agree; the stored headers are then updated with those that a
304 answer may carry.

The as-of join is a range sort: records are ranged by (url, time), so a URL with a third of all records is spread
over many tasks by time. Each range looks back within itself; one row per range carries the latest response over
the border. Payloads do not travel: responses are referred to by id and digest.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machpulse.sources.storage import stored

#: The headers that a 304 answer may update (RFC 9110, section 15.4.5), in lower case.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that do not select content.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical_url(url) -> Column:
    """Host in lower case without ``www.`` and default port, path without closing slashes, sorted query without
    tracking parameters; no scheme, no fragment. Null for a null url."""
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"(?s)#.*", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(
        F.split(F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1), "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)
    ))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def _strong(etag) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def agree(revisit_headers, response_headers) -> Column:
    """Weak comparison of entity tags where both have one, else equality of Last-Modified; otherwise false."""
    def of(headers, name: str) -> Column:
        return F.try_element_at(headers, F.lit(name))

    tags = _strong(of(revisit_headers, "etag")) == _strong(of(response_headers, "etag"))
    dates = of(revisit_headers, "last-modified") == of(response_headers, "last-modified")
    return F.coalesce(tags, dates, F.lit(False))


def merged(revisit_headers, response_headers) -> Column:
    """The response's headers, with the permitted ones of the revisit in their place."""
    fresh = F.map_filter(revisit_headers, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(response_headers, lambda k, v: ~F.map_contains_key(fresh, k))
    return F.map_concat(kept, fresh)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, canonical_url, ts, status, refers_to, payload_digest, headers``.

    ``records`` has ``record_id, kind ('response' or 'revisit'), url, ts, headers (map with names in lower case),
    payload_digest``. Earlier means a smaller ``ts``; of responses at one time the highest record id counts. ``status``
    is ``resolved``, ``validators differ`` or ``no earlier response`` (also for a null url or time); unless resolved,
    ``refers_to`` and the digest are null and the headers are the revisit's own. Null headers are none. Repeated
    revisits are resolved each. Other columns are ignored.
    """
    empty = F.create_map().cast("map<string,string>")
    lean = records.select(
        canonical_url(F.col("url")).alias("url"),
        F.col("ts").cast("long").alias("ts"),
        (F.col("kind") == "response").cast("int").alias("full"),  # at equal times revisits come first
        F.col("record_id").alias("id"),
        F.coalesce("headers", empty).alias("headers"),
        F.col("payload_digest").alias("digest"),
    ).filter(F.col("full").isNotNull())
    order = ["ts", "full", "id"]
    ranged = lean.repartitionByRange("url", *order).sortWithinPartitions("url", *order)
    ranged = stored(ranged.withColumn("slice", F.spark_partition_id()), "revisit-order")

    known = F.col("url").isNotNull() & F.col("ts").isNotNull()
    response = F.when(known & (F.col("full") == 1), F.struct("id", "headers", "digest"))
    tops = ranged.groupBy("slice").agg(
        F.min("url").alias("first_url"),
        F.max("url").alias("last_url"),
        F.max_by(F.struct("url", "id", "headers", "digest"), F.when(response.isNotNull(), F.struct("url", *order))).alias("top"),
    )
    at_end = F.when(F.col("top.url") == F.col("last_url"), F.struct("top.id", "top.headers", "top.digest"))
    chain = Window.partitionBy("last_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    tops = tops.withColumn("open", F.last(at_end, ignorenulls=True).over(chain))
    before = F.lag(F.struct("last_url", "open")).over(Window.orderBy("slice"))
    borders = tops.withColumn("b", before).select(
        F.col("slice"), F.when(F.col("b.last_url") == F.col("first_url"), F.col("first_url")).alias("border_url"),
        F.col("b.open").alias("border"),
    )
    back = Window.partitionBy("slice", "url").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    revisits = (
        ranged.withColumn("near", F.last(response, ignorenulls=True).over(back))
        .filter((F.col("full") == 0))
        .join(F.broadcast(borders), "slice")
        .withColumn("found", F.when(known, F.coalesce("near", F.when(F.col("border_url") == F.col("url"), F.col("border")))))
    )
    same = agree(F.col("headers"), F.col("found.headers"))
    status = (
        F.when(F.col("found").isNull(), "no earlier response").when(same, "resolved").otherwise("validators differ")
    )
    good = F.col("status") == "resolved"
    return revisits.withColumn("status", status).select(
        F.col("id").alias("record_id"),
        F.col("url").alias("canonical_url"),
        "ts",
        "status",
        F.when(good, F.col("found.id")).alias("refers_to"),
        F.when(good, F.col("found.digest")).alias("payload_digest"),
        F.when(good, merged(F.col("headers"), F.col("found.headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def header_lines(headers) -> Column:
    """Headers as text: ``name=value`` by name, joined by ``; ``."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.array_sort(lines), "; ")
