"""Resolution of not-modified revisit records in web archives.

A revisit says "unchanged since an earlier capture" and holds no body of its own. Each
is joined as of its date to the latest earlier full response of the same canonical URL;
the validators of both are compared, and the response's headers are updated by those
that a not-modified answer may renew.

The as-of join range-partitions all records by (canonical URL, date, id), so a URL with
a third of all records is spread over many tasks. Inside a partition a window carries
the last response along; what a partition inherits from those before it comes from one
row per (URL, partition). Bodies take no part in any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart.llm.common import stored, table

# The headers that a not-modified answer may renew, and query parameters
# that do not change what a URL names.
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning"]
TRACKING = "^(utm_[a-z]+|gclid|fbclid|phpsessid|jsessionid|sid)="

RECORD = ["record_id", "type", "url", "ts", "status", "etag", "last_modified", "digest", "headers"]


def canonical_url(url: Column) -> Column:
    """Scheme, ``www`` prefix, default port, fragment, tracking parameters and trailing slashes dropped.

    The host is in lower case, query parameters are sorted. A string that is no absolute
    URL stays as it is but for its fragment; null stays null.
    """
    bare = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    pattern = "(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, pattern, 1)), "(:80|:443)$", "")
    host = F.regexp_replace(host, "^www[0-9]*\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, pattern, 2), "/+$", "")
    query = F.array_join(F.array_sort(F.filter(
        F.split(F.regexp_replace(F.regexp_extract(bare, pattern, 3), "^\\?", ""), "&"),
        lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(bare.rlike(pattern), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                                .otherwise(""))).otherwise(bare)


def _lower_names(headers: Column) -> Column:
    """Header map with names in lower case; of names that differ by case only the first in order stays."""
    entries = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(entries, lambda e: e["key"])
    return F.coalesce(F.map_from_entries(F.filter(
        entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)), F.create_map().cast("map<string,string>"))


def merge_headers(response: Column, revisit: Column, permitted: list[str] = PERMITTED) -> Column:
    """The response's headers with the permitted ones of the revisit put over them."""
    allowed = F.array(*map(F.lit, permitted))
    renewed = F.map_filter(_lower_names(revisit), lambda k, v: F.array_contains(allowed, k) & v.isNotNull())
    kept = F.map_filter(_lower_names(response), lambda k, v: ~F.array_contains(F.map_keys(renewed), k))
    return F.map_concat(kept, renewed)


def _opaque(etag: Column) -> Column:
    """Entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record of ``records`` (the columns of ``RECORD``).

    Full responses are rows of type ``response`` with status 200. ``outcome`` is

    ``resolved``     the latest earlier response agrees in every validator both have
                     (payload digest; entity tag, compared weakly, or else date of
                     change), ``refers_to`` and the merged ``headers`` are set;
    ``mismatch``     one of these differs;
    ``no_validator`` they have none in common;
    ``no_response``  there is no earlier response, or URL or date is null.

    "Earlier" is strict. Of responses at one date the one with the largest record_id
    counts; repeated revisit rows each give a row. Other columns are ignored; an empty
    table gives no rows.
    """
    r = records.select(*RECORD).withColumn("key", canonical_url(F.col("url"))) \
        .where((F.col("type") == "revisit") | ((F.col("type") == "response") & (F.col("status") == 200)))
    full = F.col("type") == "response"
    r = r.where(~full | (F.col("key").isNotNull() & F.col("ts").isNotNull()))
    n = max(2, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("key"), F.col("ts"), full.cast("int"), F.col("record_id")]  # a revisit before responses at its date
    placed = stored(r.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()), "revisits") \
        .withColumn("part", F.shiftright("at", 33))
    response = F.when(full, F.struct("record_id", "ts", "status", "etag", "last_modified", "digest", "headers"))
    so_far = Window.partitionBy("part", "key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    seen = placed.withColumn("own", F.last(response, True).over(so_far))
    ends = placed.where(full).groupBy("key", "part").agg(F.max_by(response, "at").alias("end"))
    parts = placed.groupBy("key", "part").agg(F.lit(1).alias("one")).drop("one").join(ends, ["key", "part"], "left")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inherited = parts.select("key", "part", F.last("end", True).over(before).alias("inherited")) \
        .where("inherited IS NOT NULL")
    found = (seen.where(~full).join(inherited, ["key", "part"], "left")
             .withColumn("found", F.when(F.col("ts").isNotNull(), F.coalesce("own", "inherited"))))
    same = {
        "digest": F.col("digest") == F.col("found.digest"),
        "etag": _opaque(F.col("etag")) == _opaque(F.col("found.etag")),
        "last_modified": F.col("last_modified") == F.col("found.last_modified"),
    }
    dated = F.coalesce(same["etag"], same["last_modified"])
    agree = F.coalesce(same["digest"] & dated, same["digest"], dated)
    outcome = (F.when(F.col("found").isNull(), "no_response").when(agree.isNull(), "no_validator")
               .when(agree, "resolved").otherwise("mismatch"))
    ok = F.col("outcome") == "resolved"
    return found.withColumn("outcome", outcome).select(
        "record_id", F.col("key").alias("canonical_url"), "ts", "outcome",
        F.when(same["etag"].isNotNull(), "etag").when(same["last_modified"].isNotNull(), "last_modified")
        .when(same["digest"].isNotNull(), "digest").alias("validator"),
        F.when(ok, F.col("found.record_id")).alias("refers_to"),
        F.when(ok, F.col("found.ts")).alias("refers_to_ts"),
        F.when(ok, F.col("found.status")).alias("status"),
        F.when(ok, F.col("found.digest")).alias("payload_digest"),
        F.when(ok, merge_headers(F.col("found.headers"), F.col("headers"))).alias("headers"))


def capture_log(pages: DataFrame) -> DataFrame:
    """A capture history of every page: one or two full responses and two revisits.

    The revisits come under another spelling of the URL; some carry a weak tag, some
    only a date of change, some a tag of another version, some precede every response.
    """
    page = F.col("page_id")
    tag = F.md5(F.coalesce("html", F.lit("")))
    quoted = F.concat(F.lit('"'), tag, F.lit('"'))
    second = F.concat(F.lit('"2-'), tag, F.lit('"'))

    def moment(days: Column | int) -> Column:
        days = F.lit(days) if isinstance(days, int) else days
        return page * 60 + days * 86400 + 1704067200

    def record(kind: str, k: int, url: Column, ts: Column, etag: Column, changed: Column | None,
               digest: Column | None, headers: dict[str, Column]) -> Column:
        none = F.lit(None).cast("string")
        given = {"date": ts.cast("string"), **headers}
        return F.struct((page * 4 + k).alias("record_id"), F.lit(kind).alias("type"), url.alias("url"),
                        F.timestamp_seconds(ts).alias("ts"), F.lit(200 if kind == "response" else 304).alias("status"),
                        etag.alias("etag"), (none if changed is None else changed).alias("last_modified"),
                        (none if digest is None else digest).alias("digest"),
                        F.create_map(*[x for k_, v in given.items() for x in (F.lit(k_), v)]).alias("headers"))

    plain = {"Content-Type": F.lit("text/html"), "Server": F.concat(F.lit("s"), (page % 5).cast("string")),
             "Cache-Control": F.lit("max-age=60")}
    renewed = {"Content-Type": F.lit("text/plain"), "cache-control": F.lit("max-age=120"), "Expires": F.lit("0")}
    url = F.col("url")
    told = (F.when(page % 11 == 0, F.lit('"x"')).when(page % 7 == 0, F.lit(None).cast("string"))
            .when(page % 2 == 0, F.concat(F.lit("W/"), quoted)).otherwise(quoted))
    start = moment(0).cast("string")
    log = F.array(
        record("response", 0, url, moment(0), quoted, start, tag, plain),
        F.when(page % 3 == 0, record("response", 1, url, moment(10), second, start, second, plain)),
        record("revisit", 2, F.concat(url, F.lit("#again")),
               moment(F.when(page % 13 == 0, -5).otherwise(5)), told, start, None, renewed),
        record("revisit", 3, F.regexp_replace(url, "^https?://", "HTTP://"), moment(20),
               F.when(page % 3 == 0, second).otherwise(quoted), None, None, renewed))
    return pages.select(F.explode(F.filter(log, lambda x: x.isNotNull())).alias("r")).select("r.*")


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit in the capture history of all pages, headers as text."""
    got = resolve_revisits(capture_log(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return got.select("record_id", "canonical_url", F.unix_seconds("ts").alias("ts"), "outcome", "validator",
                      "refers_to", F.unix_seconds("refers_to_ts").alias("refers_to_ts"), "status", "payload_digest",
                      F.array_join(lines, ";").alias("headers"))


OP1_SQL = r"""
WITH log AS (
    SELECT page_id AS p, url, md5(coalesce(html, '')) AS tag,
           page_id * 60 + 1704067200 AS t0, unnest([0, 1, 2, 3]) AS k
    FROM pages
), record AS (
    SELECT p, p * 4 + k AS record_id, k, tag,
           CASE k WHEN 2 THEN url || '#again' WHEN 3 THEN regexp_replace(url, '^https?://', 'HTTP://') ELSE url END AS url,
           t0 + 86400 * CASE k WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN CASE WHEN p % 13 = 0 THEN -5 ELSE 5 END ELSE 20 END AS ts,
           CASE k WHEN 0 THEN '"' || tag || '"'
                  WHEN 1 THEN '"2-' || tag || '"'
                  WHEN 2 THEN CASE WHEN p % 11 = 0 THEN '"x"' WHEN p % 7 = 0 THEN NULL ELSE '"' || tag || '"' END
                  ELSE CASE WHEN p % 3 = 0 THEN '"2-' || tag || '"' ELSE '"' || tag || '"' END END AS etag,
           CASE WHEN k < 3 THEN CAST(t0 AS VARCHAR) END AS changed,
           CASE k WHEN 0 THEN tag WHEN 1 THEN '"2-' || tag || '"' END AS digest
    FROM log WHERE k <> 1 OR p % 3 = 0
), bare AS (
    SELECT *, regexp_replace(trim(url), '#.*$', '', 's') AS b FROM record
), split AS (
    SELECT *,
           regexp_replace(regexp_replace(lower(regexp_extract(b, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)),
                                         '(:80|:443)$', ''), '^www[0-9]*\.', '') AS host,
           regexp_replace(regexp_extract(b, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
           array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1, 's'), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|phpsessid|jsessionid|sid)='))), '&') AS query
    FROM bare
), keyed AS (
    SELECT *, CASE WHEN regexp_matches(b, '^[A-Za-z][A-Za-z0-9+.-]*://')
                   THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE b END AS key
    FROM split
), joined AS (
    SELECT v.record_id, v.key, v.ts, v.etag = r.etag AS same_tag, v.changed = r.changed AS same_change,
           r.record_id AS rid, r.ts AS rts, r.digest AS rdigest, r.p AS rp
    FROM (SELECT * FROM keyed WHERE k >= 2) v
    LEFT JOIN (SELECT * FROM keyed WHERE k < 2) r ON r.key = v.key AND r.ts < v.ts
    QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) = 1
), told AS (
    SELECT *, CASE WHEN rid IS NULL THEN 'no_response'
                   WHEN coalesce(same_tag, same_change) IS NULL THEN 'no_validator'
                   WHEN coalesce(same_tag, same_change) THEN 'resolved' ELSE 'mismatch' END AS outcome
    FROM joined
)
SELECT record_id, key AS canonical_url, CAST(ts AS BIGINT) AS ts, outcome,
       CASE WHEN same_tag IS NOT NULL THEN 'etag' WHEN same_change IS NOT NULL THEN 'last_modified' END AS validator,
       CASE WHEN outcome = 'resolved' THEN rid END AS refers_to,
       CASE WHEN outcome = 'resolved' THEN CAST(rts AS BIGINT) END AS refers_to_ts,
       CASE WHEN outcome = 'resolved' THEN CAST(200 AS INTEGER) END AS status,
       CASE WHEN outcome = 'resolved' THEN rdigest END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN
           'cache-control=max-age=120;content-type=text/html;date=' || CAST(ts AS VARCHAR) || ';expires=0;server=s'
           || CAST(rp % 5 AS VARCHAR) END AS headers
FROM told
"""
