"""Training-corpus pipeline over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.llm.bpe import digests
from revlens.llm.contain import decontaminate
from revlens.llm.line_crf import fit_quality, keep_good
from revlens.llm.lines import remove_boilerplate
from revlens.llm.partenum import keep_first
from revlens.llm.queries import GOOD, public_vocabulary
from revlens.llm.samples import remainder
from revlens.sources.io import persist_cut


def quality(spark, docs, sf_dir):
    """Documents that the line field scores 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    theta = fit_quality(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    return keep_good(docs, theta, GOOD)


def line_dedup(spark, docs, sf_dir):
    """Texts without lines that stand in ten sources or more."""
    out = remove_boilerplate(docs, min_sites=10, site="source")
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """The smallest doc_id of each class of five-word Jaccard 0.8."""
    return keep_first(docs, words=5, percent=80)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=80)


def tokens(spark, docs, sf_dir, path=None):
    """Token ids of each text and what they decode to, as digests."""
    return digests(docs, public_vocabulary(path))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]
#: The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, from ``documents`` to token digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = persist_cut(stage(spark, docs, sf_dir), spark, name.replace(" ", "-"))
    return docs
