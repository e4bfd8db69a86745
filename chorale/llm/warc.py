"""Not-modified revisits of web captures: an as-of join to the latest earlier full response of the canonical URL.

Responses are first reduced to one for each URL and second, and revisits to the distinct seconds that are asked for, so no
URL has more rows than seconds.  Time is cut into buckets of fixed length: a bucket of one URL has a bounded number of rows,
and the last response of each bucket is carried into the following ones.  The answers then go back to all revisits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import quoted, without

#: Header fields that a 304 response is to repeat (RFC 9110, 15.4.5); only these update the stored response.
PERMITTED_HEADERS = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that do not change the page.
TRACKING = r"^(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)="
#: Seconds of a time bucket: a bucket of a URL has at most two rows for each second.
BUCKET_SECONDS = 200_000
_RESULTS = ("canonical_url", "outcome", "response_id", "age", "merged_headers")


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment, tracking parameters and trailing slash.

    Host letters A-Z are lower-cased and parameters sorted.  Null where the URL is null or has no ``://`` or host.
    """
    pattern = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, pattern, 2), "/+$", "")
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(url, pattern, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.coalesce(host, F.lit("")) != "", F.concat(host, path, query))


def _entries(headers: Column) -> Column:
    return F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(_entries(headers), lambda e: (F.lower(e["key"]) == name) & e["value"].isNotNull()), F.lit(0))["value"]


def _tag(headers: Column) -> Column:
    """The entity tag for the weak comparison that not-modified answers use."""
    return F.regexp_replace(_header(headers, "etag"), "^W/", "")


def merge_headers(stored: Column, update: Column) -> Column:
    """The stored fields, of which the permitted ones that the update has are replaced."""
    allowed = F.filter(_entries(update), lambda e: F.lower(e["key"]).isin(*PERMITTED_HEADERS))
    names = F.transform(allowed, lambda e: F.lower(e["key"]))
    return F.map_from_entries(F.concat(F.filter(_entries(stored), lambda e: ~F.array_contains(names, F.lower(e["key"]))), allowed))


def latest_before(responses: DataFrame, asked: DataFrame, bucket_seconds: int) -> DataFrame:
    """``responses`` (key, at, found) and ``asked`` (key, at), one row for each pair, to (key, at, found): the latest strictly before."""
    # Questions sort before a response of the same second, which is not earlier.
    rows = asked.select("key", "at", F.lit(None).cast(responses.schema["found"].dataType).alias("found"), F.lit(0).alias("answers")).unionByName(
        responses.withColumn("answers", F.lit(1))
    )
    rows = rows.withColumn("bucket", F.floor(F.col("at") / bucket_seconds))
    inside = Window.partitionBy("key", "bucket").orderBy("at", "answers").rowsBetween(Window.unboundedPreceding, 0)
    upto = rows.withColumn("near", F.last("found", ignorenulls=True).over(inside)).select("key", "bucket", "at", "answers", "near")
    ends = upto.groupBy("key", "bucket").agg(F.max_by("near", F.struct("at", "answers")).alias("end"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "bucket", F.last("end", ignorenulls=True).over(earlier).alias("far"))
    return upto.where("answers = 0").join(carried, ["key", "bucket"]).select("key", "at", F.coalesce("near", "far").alias("found"))


def resolve_revisits(captures: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The revisit rows of ``captures`` plus canonical_url, outcome, response_id, age and merged_headers.

    ``captures`` has record_id, url, captured_at (in whole seconds), record_type (``response`` or ``revisit``), status and
    headers (map of strings).  A full response has status 200.  The latest one strictly before the revisit counts (of equal
    times the largest record_id).  Outcomes: ``resolved`` if the entity tags agree, or without both tags the
    Last-Modified fields; ``mismatch`` if those compared differ; ``unverified`` if there is nothing to compare;
    ``orphan`` without an earlier response, and for null URLs or times.  Only resolved rows have response_id, age and
    headers.  Repeated rows stay and agree.  URLs of any length are keys as a whole.  Input columns named like a result (in
    any case) are replaced; others may be there.  An empty table gives no rows.
    """
    names = without(captures, *_RESULTS).columns
    at = {c.lower(): F.col(f"c{i}") for i, c in enumerate(names)}
    numbered = captures.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])
    keyed = numbered.select("*", canonical_url(at["url"]).alias("key"), at["captured_at"].cast("long").alias("at"))
    joinable = keyed.where("key is not null and at is not null")
    full, revisit = (at["record_type"] == "response") & (at["status"] == 200), at["record_type"] == "revisit"
    found = F.struct(F.col("at"), at["record_id"].alias("id"), _entries(at["headers"]).alias("headers"))
    # A null id sorts below all others, also where max_by would leave it out.
    responses = joinable.where(full).groupBy("key", "at").agg(F.max_by(found, F.struct(at["record_id"])).alias("found"))
    answers = latest_before(responses, joinable.where(revisit).select("key", "at").distinct(), bucket_seconds)
    # Many revisits to one answer: a hot second of a hot URL is split by AQE's skew join.
    judged = keyed.where(revisit).join(answers, ["key", "at"], "left")
    mine, theirs = at["headers"], F.map_from_entries("found.headers")
    tags, dates = (_tag(mine), _tag(theirs)), (_header(mine, "last-modified"), _header(theirs, "last-modified"))
    outcome = (
        F.when(F.col("found").isNull(), "orphan")
        .when(tags[0].isNotNull() & tags[1].isNotNull(), F.when(tags[0] == tags[1], "resolved").otherwise("mismatch"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("mismatch"))
        .otherwise("unverified")
    )
    judged = judged.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return judged.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
        F.col("key").alias("canonical_url"),
        "outcome",
        F.when(resolved, F.col("found.id")).alias("response_id"),
        F.when(resolved, F.col("at") - F.col("found.at")).alias("age"),
        F.when(resolved, merge_headers(theirs, mine)).alias("merged_headers"),
    )
