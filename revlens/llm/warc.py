"""Not-modified revisits of a crawl, resolved to the response they stand for.

A WARC ``revisit`` record of a 304 answer has headers and no body. Its body is
that of the latest earlier full response (status 200) of the same canonical URL,
if the validators agree; its headers are that response's, updated by those the
304 may change (RFC 9111, section 3.2).

The as-of join runs over ids only. Captures of one URL are cut into time
buckets: each bucket's last full response is a grouped maximum (combined
map-side), a window over a URL's few buckets carries it forward, and a running
window inside a bucket finds earlier responses of the same bucket. A URL with a
third of all captures is thus spread over its buckets. Headers and payloads join
by record id afterwards, on exchanges that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut

BUCKET_SECONDS = 3600
# Fields a 304 answer must not change (RFC 9111 section 3.2, RFC 9110 section 7.6.1).
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te",
              "trailer", "transfer-encoding", "upgrade")
# Query parameters that do not change the page.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|msclkid|sid|sessionid|phpsessid|jsessionid)(=|$)"
_START = "^[A-Za-z][A-Za-z0-9+.-]*://"


def canonical_url(url: str) -> str:
    """SQL for the canonical form of a URL column: no scheme, user, ``www.``,
    default port, fragment, tracking parameters or closing slashes; host in
    lower case, parameters sorted. Text that is no URL stays as it is, trimmed."""
    plain = f"regexp_replace(trim({url}), '#[\\\\s\\\\S]*$', '')"
    host = f"regexp_replace(lower(regexp_extract(u, '{_START}(?:[^/?@]*@)?([^/?:]*)', 1)), '^www[.]', '')"
    port = f"regexp_replace(regexp_extract(u, '{_START}(?:[^/?@]*@)?[^/?:]*(:[0-9]+)', 1), '^:(80|443)$', '')"
    path = f"regexp_replace(regexp_extract(u, '{_START}[^/?]*([^?]*)', 1), '/+$', '')"
    query = (f"array_join(array_sort(filter(split(regexp_extract(u, '[?]([\\\\s\\\\S]*)$', 1), '&'), "
             f"p -> p <> '' AND NOT lower(p) RLIKE '{TRACKING}')), '&')")
    whole = f"concat({host}, {port}, {path}, transform(array({query}), q -> if(q = '', '', concat('?', q)))[0])"
    return f"transform(array({plain}), u -> if(u RLIKE '{_START}', {whole}, u))[0]"


def fields(headers: str) -> str:
    """SQL for the header fields of an HTTP head as array of (name, value):
    names in lower case, the status line left out, lines without colon ignored."""
    lines = f"split(coalesce({headers}, ''), '\\r?\\n')"
    return (f"transform(filter({lines}, (x, i) -> i > 0 AND instr(x, ':') > 1), x -> struct("
            "lower(trim(substring_index(x, ':', 1))) as name, trim(substr(x, instr(x, ':') + 1)) as value))")


def _field(array: str, name: str) -> str:
    """Value of a field; null when absent, the first of several."""
    return f"get(filter({array}, f -> f.name = '{name}'), 0).value"


def _status(headers: str) -> str:
    return f"try_cast(regexp_extract(coalesce({headers}, ''), '^HTTP/[0-9.]+ +([0-9]+)', 1) as int)"


def _latest(slim: DataFrame) -> DataFrame:
    """record_id of every revisit -> response_id, the latest earlier full response."""
    spark = slim.sparkSession
    slim = persist_cut(slim.withColumn("bucket", F.floor(F.col("at") / (BUCKET_SECONDS * 1_000_000))), spark, "captures")
    full = F.when(F.col("full"), F.struct("at", "record_id"))
    last = slim.groupBy("url", "bucket").agg(F.max(full).alias("last"))
    by_time = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = persist_cut(last.select("url", "bucket", F.last("last", True).over(by_time).alias("carried"))
                          .where("carried IS NOT NULL").select("url", "bucket", F.col("carried.record_id").alias("carried")),
                          spark, "carried")
    inside = Window.partitionBy("url", "bucket").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    here = slim.withColumn("here", F.last(F.when(F.col("full"), F.col("record_id")), True).over(inside)).where("revisit")
    return here.join(carried, ["url", "bucket"], "left").select(
        "record_id", F.col("url").alias("canonical_url"), F.coalesce("here", "carried").alias("response_id"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolve the not-modified revisits among WARC records.

    ``records``: record_id long (unique), warc_type, target_uri, warc_date (ISO
    8601 text), http_headers (status line and fields), payload; other columns
    are ignored. One row per ``revisit`` record of status 304: record_id,
    canonical_url, response_id, outcome, http_headers, payload. The outcome is

    * ``resolved``: headers are merged, the payload is the response's;
    * ``validator_mismatch``: the latest earlier response has another ETag
      (compared weakly; Last-Modified where the revisit has no ETag; a revisit
      with neither agrees only with a response with neither). Headers are the
      revisit's own, the payload is null;
    * ``no_response``: no earlier full response; likewise;
    * ``no_key``: the revisit has no URL or no readable date; likewise.

    Captures of equal time are ordered by record_id. Responses without URL,
    readable date or status 200 answer nothing. Rows with a null record_id are
    ignored. Rows that repeat a record_id (a file read twice) are copies of it: one
    row comes back for each revisit row, whatever the copies of responses.
    """
    spark = records.sparkSession
    r = records.where("record_id IS NOT NULL").select(
        "record_id", F.expr(canonical_url("target_uri")).alias("url"),
        F.expr("unix_micros(try_to_timestamp(warc_date))").alias("at"), F.expr(_status("http_headers")).alias("status"),
        F.lower("warc_type").alias("type"), "http_headers", "payload")
    revisit, full = (F.coalesce((F.col("type") == t) & (F.col("status") == s), F.lit(False))
                     for t, s in (("revisit", 304), ("response", 200)))
    known = r.where("url IS NOT NULL AND at IS NOT NULL")
    latest = persist_cut(_latest(known.select("record_id", "url", "at", revisit.alias("revisit"), full.alias("full"))
                                 .where("revisit OR full")), spark, "revisits")
    asked = r.where(revisit).select("record_id", "http_headers").join(
        latest.dropDuplicates(["record_id"]), "record_id", "left")
    stored = r.where(full).select(F.col("record_id").alias("response_id"), F.col("http_headers").alias("stored"),
                                  "payload").join(latest.select("response_id").distinct(), "response_id", "left_semi").dropDuplicates(["response_id"])
    both = asked.join(stored, "response_id", "left").select(
        "*", F.expr(fields("http_headers")).alias("new"), F.expr(fields("stored")).alias("old"))
    return both.select("record_id", "canonical_url", "response_id", _outcome().alias("outcome"),
                       "http_headers", "stored", "payload", "new", "old").select(
        "record_id", "canonical_url", "response_id", "outcome",
        F.when(F.col("outcome") == "resolved", F.expr(_merged())).otherwise(F.col("http_headers")).alias("http_headers"),
        F.when(F.col("outcome") == "resolved", F.col("payload")).alias("payload"))


def _outcome() -> Column:
    tag, date = ((_field("new", n), _field("old", n)) for n in ("etag", "last-modified"))
    weak = "regexp_replace({0}, '^W/', '')"
    agree = (f"CASE WHEN {tag[0]} IS NOT NULL THEN {weak.format(tag[0])} <=> {weak.format(tag[1])} "
             f"WHEN {date[0]} IS NOT NULL THEN {date[0]} <=> {date[1]} "
             f"ELSE {tag[1]} IS NULL AND {date[1]} IS NULL END")
    return F.expr("CASE WHEN canonical_url IS NULL THEN 'no_key' WHEN response_id IS NULL THEN 'no_response' "
                  f"WHEN {agree} THEN 'resolved' ELSE 'validator_mismatch' END")


def _merged() -> str:
    """Status line of the response, its fields that stay, the fields the 304 sets."""
    fixed = ", ".join(f"'{n}'" for n in NOT_MERGED)
    allowed = f"filter(new, f -> f.name NOT IN ({fixed}))"
    stay = "filter(old, f -> NOT array_contains(transform(a, g -> g.name), f.name))"
    text = "transform(concat({0}, a), f -> concat(f.name, ': ', f.value))".format(stay)
    return (f"concat_ws('\\r\\n', array(regexp_extract(stored, '^([^\\r\\n]*)', 1)), "
            f"transform(array({allowed}), a -> {text})[0])")
