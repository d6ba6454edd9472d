"""WARC not-modified revisits resolved to the response that they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.session import table

#: Header fields that a 304 may update in the stored response; fixed values (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not change what a URL names.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
_PARTS = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)(\?(.*))?$"
#: Quantile cuts of time that split a hot URL.
CUTS = 128


def canonical_url(url: Column) -> Column:
    """Scheme, fragment, ``www.``, default port, trailing slash and tracking parameters dropped; host lower case; parameters sorted."""
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, _PARTS, 1)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, _PARTS, 2), "/+$", "")
    kept = F.filter(F.split(F.regexp_extract(bare, _PARTS, 4), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    joined = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(bare.rlike(_PARTS), joined).otherwise(bare)


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED, cuts: int = CUTS) -> DataFrame:
    """Adds canonical_url, resolution, resolved_id, merged_headers and merged_payload to records.

    records: record_id, url, ts (long), rtype ('response' or 'revisit'),
    status, etag, last_modified, headers map<string,string>, payload.

    A revisit looks for the latest response with status 200 and the same
    canonical URL and a strictly smaller ts (ties: larger record_id). The
    strongest validator that both carry decides: entity tag (weak comparison),
    else Last-Modified. resolution is 'response' for what is no revisit,
    'resolved', 'mismatch', 'unverified' (no common validator) or 'no_prior';
    only 'resolved' rows get headers and payload: the response's, with the
    permitted fields of the revisit over them, all names in lower case.

    The as-of join works on distinct (URL, ts) points, pre-aggregated before
    the shuffle and split by quantile cuts of ts: within a cut a window finds
    the last response, and what earlier cuts carry in comes from a table of
    at most ``cuts`` rows per URL. A URL with a third of all rows is so spread
    over the cuts. Revisits without a prior response leave before the join
    that fetches headers and payload. In that join a response goes to each cut in
    which it is asked for, so that its revisits are spread as well, and no
    aggregate stands in its stage, so AQE can split what is still skewed.

    Null url or ts: 'no_prior'. A response with a null record_id cannot be
    referred to and is no prior of any revisit. Of several responses with one
    record_id the smallest by (ts, payload) counts. Repeated revisits give a
    row each. Payloads and headers may be of any length. An empty table gives no
    rows. Columns of records that are named as one of the added are replaced;
    all others are kept, whatever their names.
    """
    added = ("canonical_url", "resolution", "resolved_id", "merged_headers", "merged_payload")
    kept = [F.col(f"`{c}`") for c in records.columns if c.lower() not in added]
    # The caller's row is one column, so that its names cannot meet those used here.
    r = records.select(F.struct(*kept).alias("rec"), canonical_url(F.col("url")).alias("canon"), F.col("ts").alias("at"), F.col("rtype").alias("kind"))
    full = (F.col("kind") == "response") & (F.col("rec.status") == 200) & F.col("rec.record_id").isNotNull()
    marks = r.agg(F.percentile_approx("at", [i / cuts for i in range(1, cuts)], 2000)).first()[0]
    steps = F.array(*[F.lit(int(x)) for x in sorted(set(marks or []))]) if marks else F.array().cast("array<bigint>")
    points = r.where("canon IS NOT NULL AND at IS NOT NULL").groupBy("canon", "at").agg(F.max(F.when(full, F.col("rec.record_id"))).alias("at_id"))
    points = points.withColumn("cut", F.size(F.filter(steps, lambda x: x <= F.col("at"))))
    last = F.when(F.col("at_id").isNotNull(), F.struct("at", "at_id"))
    inner = Window.partitionBy("canon", "cut").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("canon").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = points.groupBy("canon", "cut").agg(F.max(last).alias("last"))
    carried = carried.select("canon", "cut", F.max("last").over(outer).alias("carried"))
    points = points.withColumn("own", F.max(last).over(inner)).join(carried, ["canon", "cut"])
    prior = points.select("canon", "at", "cut", F.coalesce("own", "carried").getField("at_id").alias("prior")).where("prior IS NOT NULL")
    asked = r.where("kind = 'revisit'").join(prior, ["canon", "at"], "left")
    fields = F.struct("at", "rec.payload", "rec.etag", "rec.last_modified", F.map_entries(_lower(F.col("rec.headers"))).alias("h"))
    stored = r.where(full).groupBy(F.col("rec.record_id").alias("prior")).agg(F.min(fields).alias("stored"))
    dealt = prior.select("prior", "cut").distinct().join(stored, "prior")
    found = asked.where("prior IS NOT NULL").join(dealt, ["prior", "cut"])
    s = F.col("stored")
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    agree = F.when(F.col("rec.etag").isNotNull() & s["etag"].isNotNull(), tag(F.col("rec.etag")) == tag(s["etag"])).when(
        F.col("rec.last_modified").isNotNull() & s["last_modified"].isNotNull(), F.col("rec.last_modified") == s["last_modified"]
    )
    state = F.when(agree.isNull(), "unverified").when(agree, "resolved").otherwise("mismatch")
    fresh = F.map_filter(_lower(F.coalesce(F.col("rec.headers"), F.create_map().cast("map<string,string>"))), lambda k, _: k.isin(*permitted))
    old = F.map_filter(F.coalesce(F.map_from_entries(s["h"]), F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(fresh, k))
    done = F.col("resolution") == "resolved"
    found = found.withColumn("resolution", state).select(
        "rec", "canon", "resolution", F.when(done, F.col("prior")).alias("resolved_id"),
        F.when(done, F.map_concat(old, fresh)).alias("merged_headers"), F.when(done, s["payload"]).alias("merged_payload"),
    )
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields[3:]]
    bare = [asked.where("prior IS NULL").select("rec", "canon", F.lit("no_prior").alias("resolution"), *none)]
    bare.append(r.where("kind IS NULL OR kind <> 'revisit'").select("rec", "canon", F.lit("response").alias("resolution"), *none))
    every = found.unionByName(bare[0]).unionByName(bare[1])
    return every.select("rec.*", F.col("canon").alias("canonical_url"), *added[1:])


def _lower(headers: Column) -> Column:
    """Header names in lower case; of equal names the last in byte order of (name, value) wins."""
    low = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    last = F.filter(low, lambda e, i: ~F.exists(F.slice(low, i + 2, F.size(low)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(F.filter(last, lambda e: e["key"].isNotNull()))


def captures(pages: DataFrame) -> DataFrame:
    """WARC records out of the pages table, by fixed integer rules: every third page is a 304."""
    canon = canonical_url(F.col("url"))
    p = pages.select(F.col("page_id").alias("record_id"), "url", "html", canon.alias("_c")).withColumn("ts", F.lit(1600000000) + (F.col("record_id") * 7919) % 1000003)
    epoch = F.floor(F.col("ts") / 400000)
    p = p.withColumn("rtype", F.when(F.col("record_id") % 3 == 1, "revisit").otherwise("response"))
    p = p.withColumn("status", F.when(F.col("rtype") == "revisit", 304).when(F.col("record_id") % 10 == 9, 404).otherwise(200))
    p = p.withColumn("etag", F.when(F.col("record_id") % 7 != 0, F.concat(F.when(F.col("record_id") % 2 == 0, "W/").otherwise(""), F.lit('"'), F.substring(F.md5(F.concat_ws("#", "_c", epoch.cast("string"))), 1, 16), F.lit('"'))))
    p = p.withColumn("last_modified", F.when(F.col("record_id") % 11 != 0, (epoch * 400000).cast("string")))
    headers = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in {
        "Content-Type": F.when(F.col("rtype") == "response", "text/html"), "Date": F.col("ts").cast("string"), "ETag": F.col("etag"),
        "Last-Modified": F.col("last_modified"), "Server": F.when(F.col("rtype") == "response", "origin").otherwise("cache"),
    }.items()]), lambda e: e["value"].isNotNull()))
    return p.select("record_id", "url", "ts", "rtype", "status", "etag", "last_modified", headers.alias("headers"), F.when(F.col("rtype") == "response", F.col("html")).alias("payload"))


def op1_resolve_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("merged_headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select("record_id", "canonical_url", "ts", "rtype", "resolution", "resolved_id", lines.alias("headers"), F.sha2("merged_payload", 256).alias("payload_sha256"))


OP1_SQL = rf"""
WITH bare AS (SELECT page_id AS record_id, regexp_replace(url, '#.*$', '') AS b, html FROM pages),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '{_PARTS}', 1)), ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_replace(regexp_extract(b, '{_PARTS}', 2), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '{_PARTS}', 4), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))), '&') AS q
  FROM bare
), rec AS (
  SELECT record_id, CASE WHEN regexp_matches(b, '{_PARTS}') THEN host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END ELSE b END AS canonical_url,
    1600000000 + (record_id * 7919) % 1000003 AS ts, CASE WHEN record_id % 3 = 1 THEN 'revisit' ELSE 'response' END AS rtype,
    CASE WHEN record_id % 3 = 1 THEN 304 WHEN record_id % 10 = 9 THEN 404 ELSE 200 END AS status, html
  FROM parts
), val AS (
  SELECT *, CASE WHEN record_id % 7 <> 0 THEN '"' || substr(md5(canonical_url || '#' || (ts // 400000)), 1, 16) || '"' END AS tag,
    CASE WHEN record_id % 2 = 0 THEN 'W/' ELSE '' END AS weak,
    CASE WHEN record_id % 11 <> 0 THEN CAST(ts // 400000 * 400000 AS VARCHAR) END AS lm
  FROM rec
), prior AS (
  SELECT v.*, (SELECT arg_max(f.record_id, (f.ts, f.record_id)) FROM val f WHERE f.status = 200 AND f.rtype = 'response' AND f.canonical_url = v.canonical_url AND f.ts < v.ts) AS pid
  FROM val v WHERE v.rtype = 'revisit'
), done AS (
  SELECT p.*, f.html AS full_html, f.tag AS ftag, f.weak AS fweak, f.lm AS flm, f.ts AS fts,
    CASE WHEN pid IS NULL THEN 'no_prior' WHEN p.tag IS NOT NULL AND f.tag IS NOT NULL THEN CASE WHEN p.tag = f.tag THEN 'resolved' ELSE 'mismatch' END
      WHEN p.lm IS NOT NULL AND f.lm IS NOT NULL THEN CASE WHEN p.lm = f.lm THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS resolution
  FROM prior p LEFT JOIN val f ON f.record_id = p.pid
)
SELECT record_id, canonical_url, ts, rtype, resolution, CASE WHEN resolution = 'resolved' THEN pid END AS resolved_id,
  CASE WHEN resolution = 'resolved' THEN 'content-type=text/html;date=' || ts
    || coalesce(';etag=' || CASE WHEN tag IS NOT NULL THEN weak || tag ELSE fweak || ftag END, '')
    || coalesce(';last-modified=' || coalesce(lm, flm), '') || ';server=origin' END AS headers,
  CASE WHEN resolution = 'resolved' THEN sha256(full_html) END AS payload_sha256
FROM done
UNION ALL SELECT record_id, canonical_url, ts, rtype, 'response', NULL, NULL, NULL FROM val WHERE rtype = 'response'
"""
