"""WARC records derived from the table ``pages``: every page is captured as a
full response, and by rules on its id revisited, with answers 304 whose
validators agree or not, before and after the response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (kind, seconds after the response, which pages, validator line of the answer)
_TAG, _DATE = "concat('ETag: \"', md5(html), '\"')", "concat('Last-Modified: day ', CAST(page_id % 28 + 1 AS STRING))"
_REVISITS = (
    (1, 86400, "page_id % 3 = 0", f"CASE WHEN page_id % 15 = 0 THEN 'ETag: \"changed\"' ELSE {_TAG} END"),
    (2, -1000, "page_id % 7 = 0", _TAG),
    (3, 172800, "page_id % 5 = 0", f"CASE WHEN page_id % 20 = 0 THEN 'X-None: 1' ELSE {_DATE} END"),
)


def _date(seconds: int) -> str:
    return f"date_format(timestamp_seconds(1700000000 + page_id * 37 + {seconds}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def warc_records(pages: DataFrame) -> DataFrame:
    full = pages.select(
        F.expr("page_id * 4").alias("record_id"), F.lit("response").alias("warc_type"),
        F.col("url").alias("target_uri"), F.expr(_date(0)).alias("warc_date"),
        F.expr("concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html\\r\\nCache-Control: max-age=60\\r\\n', "
               f"CASE WHEN page_id % 11 = 0 THEN 'W/' ELSE '' END, {_TAG}, '\\r\\n', {_DATE}, '\\r\\nContent-Length: ', "
               "CAST(octet_length(html) AS STRING))").alias("http_headers"),
        F.col("html").alias("payload"))
    out = full.withColumn("http_headers", F.regexp_replace("http_headers", "W/ETag: ", "ETag: W/"))
    for kind, later, which, validator in _REVISITS:
        out = out.unionByName(pages.where(which).select(
            F.expr(f"page_id * 4 + {kind}").alias("record_id"), F.lit("revisit").alias("warc_type"),
            F.col("url").alias("target_uri"), F.expr(_date(later)).alias("warc_date"),
            F.expr("concat('HTTP/1.1 304 Not Modified\\r\\nCache-Control: max-age=600\\r\\nContent-Length: 0\\r\\n', "
                   f"{validator})").alias("http_headers"), F.lit(None).cast("string").alias("payload")))
    return out
