"""Line deduplication by the number of distinct sites, JVM built-ins only.

A line that stands on ``min_sites`` sites or more is boilerplate and is removed
everywhere. Counting sites exactly for every line would shuffle a row per line
and site; here

1. lines occurring fewer than ``min_sites`` times are out at once (they cannot
   be on so many sites), by a count that combines map-side;
2. the others get a HyperLogLog sketch of their sites, merged by aggregation, so
   a line on a third of all pages moves one sketch per task;
3. estimates further than ``BAND`` from the threshold decide; lines nearer to it
   are counted exactly.

Lines are compared by 128 bits of hash; blank lines are never removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import native as N
from revlens.sources.io import persist_cut

#: Log2 of the sketch's buckets: a standard error of 1.6 %.
LG_BUCKETS = 12
#: Share of the threshold within which an estimate does not decide: more than
#: ten standard errors.
BAND = 0.2


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, site, place and hash of every line with a word."""
    at = docs.select("doc_id", "site", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return at.where(f"NOT ({N.is_blank('line')})").select(
        "doc_id", "site", "place", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"))


def boilerplate(docs: DataFrame, min_sites: int) -> DataFrame:
    """Hashes (h1, h2) of the lines of ``docs`` (doc_id, site, text) on
    ``min_sites`` distinct non-null sites or more."""
    spark = docs.sparkSession
    lines = _lines(docs).where("site IS NOT NULL")
    often = persist_cut(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
                        .select("h1", "h2"), spark, "frequent-lines")
    lines = persist_cut(lines.join(often, ["h1", "h2"], "left_semi").select("h1", "h2", "site"), spark, "line-sites")
    sketch = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", LG_BUCKETS).alias("sketch"))
    spread = persist_cut(sketch.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites")), spark, "line-spread")
    low, high = min_sites * (1 - BAND), min_sites * (1 + BAND)
    near = spread.where((F.col("sites") >= low) & (F.col("sites") <= high)).select("h1", "h2")
    exact = (lines.join(near, ["h1", "h2"], "left_semi").distinct().groupBy("h1", "h2")
             .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites))
    return spread.where(F.col("sites") > high).select("h1", "h2").unionByName(exact.select("h1", "h2"))


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, site: str = "source") -> DataFrame:
    """``docs`` without its boilerplate lines.

    ``docs``: doc_id long, text string, ``site`` and any further columns. Returns
    all its columns, in ``text`` the remaining lines joined by newlines, then
    n_lines (lines with a word before) and n_removed; columns of these two names
    are replaced. Null text stays null with 0 lines; empty texts stay empty.
    A null site counts as no site, but its documents lose boilerplate too. Rows
    with a null doc_id come back unchanged. Rows that repeat a doc_id lose each
    line found to be boilerplate in any of them at the same place.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_removed")
    d = docs.select("doc_id", "text", F.col(site).cast("string").alias("site"))
    known = persist_cut(boilerplate(d, min_sites), spark, "boilerplate")
    taken = {c.lower() for c in docs.columns}
    places = next(n for n in ("gone_places" + "_" * k for k in range(len(taken) + 1)) if n not in taken)
    gone = (_lines(d).where("doc_id IS NOT NULL").join(known, ["h1", "h2"]).groupBy(F.col("doc_id").alias("gone_id"))
            .agg(F.collect_set("place").alias(places)))
    all_lines = "split(text, '\\n')"
    worded = f"cast(size(filter({all_lines}, x -> NOT ({N.is_blank('x')}))) as bigint)"
    kept = F.expr(f"CASE WHEN {places} IS NULL THEN text ELSE " + N.let(
        "l", all_lines, f"array_join(transform(array_except(sequence(0, size(l) - 1), {places}), i -> l[i]), '\\n')")
        + " END")
    cut = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left")
    return cut.select(
        *[kept.alias("text") if c == "text" else docs[c] for c in docs.columns],
        F.expr(f"CASE WHEN text IS NULL THEN 0L ELSE {worded} END").alias("n_lines"),
        F.expr(f"coalesce(cast(size({places}) as bigint), 0L)").alias("n_removed"))
