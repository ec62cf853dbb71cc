"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.llm import oracle as O
from revlens.llm.bpe import Vocabulary, digests
from revlens.llm.contain import contaminated
from revlens.llm.crawl import warc_records
from revlens.llm.dualtree import ranked_search
from revlens.llm.hyperminhash import near_duplicates
from revlens.llm.line_crf import fit_quality, score_quality
from revlens.llm.langid import predict_held_out
from revlens.llm.lines import remove_boilerplate
from revlens.llm.partenum import jaccard_classes
from revlens.llm.rules import quality_rules
from revlens.llm.samples import remainder
from revlens.llm.spelling import variants, words
from revlens.llm.substring import remove_repeats
from revlens.llm.toxicity import fit_toxicity, score_toxicity
from revlens.llm.warc import resolve_revisits


#: Scores from which a document counts as good, and as toxic.
GOOD, TOXIC = 0.3, 0.7


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark, sf_dir):
    """Near-duplicate class of every document, 4-word shingles, Jaccard 0.85."""
    return jaccard_classes(_docs(spark, sf_dir), words=4, percent=85)


def op2_substring_dedup(spark, sf_dir):
    """Every document without its repeats of 50 words and more."""
    return remove_repeats(_docs(spark, sf_dir), width=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_ngram_likelihood_rules(spark, sf_dir):
    """Base counts and the verdict of every document; documents labelled good
    are the trusted target."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return quality_rules(_docs(spark, sf_dir), trusted)


def op4_line_site_spread(spark, sf_dir):
    """Every document without lines that stand in ten sources or more."""
    return remove_boilerplate(_docs(spark, sf_dir), min_sites=10).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_benchmark_containment(spark, sf_dir):
    """Benchmark items of which a document holds 80 % of the 5-word shingles."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(_docs(spark, sf_dir), items, percent=80)


def op8_byte_bpe(spark, sf_dir, path=None, pattern=None):
    """Ids of every document and the text they decode to, as digests."""
    return digests(_docs(spark, sf_dir), public_vocabulary(path, pattern))


def public_vocabulary(path=None, pattern=None):
    """A rank file and its pattern, by default the public 50k byte vocabulary."""
    import public_tokenizers  # only where tokens are asked for
    return Vocabulary.read(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           pattern or public_tokenizers.PATTERN)


def op6_warc_revisits(spark, sf_dir):
    """Every not-modified revisit of the crawl derived from the pages."""
    records = warc_records(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return resolve_revisits(records).select("record_id", "canonical_url", "response_id", "outcome",
                                            F.md5("payload").alias("payload_md5"), "http_headers")


def op7_word_first_language(spark, sf_dir):
    """Language of every document; rows of remainder 0 mod 5 are held out."""
    return predict_held_out(_docs(spark, sf_dir), 5)


def op9_line_crf_quality(spark, sf_dir):
    """Quality score of every document; rows of remainder 0 mod 5 are held out."""
    docs, labels = _docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    theta = fit_quality(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    return score_quality(docs, theta).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"), "n_lines", "n_good_lines")


def op10_counterfactual_toxicity(spark, sf_dir):
    """Toxicity score of every document; rows of remainder 1 mod 3 are held out."""
    docs, labels = _docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels, remainder(F.col("doc_id"), 3) != 1)
    return score_toxicity(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op11_hyperminhash(spark, sf_dir):
    """Near-duplicate class of every document, 3-word shingles, Jaccard 0.85."""
    return near_duplicates(_docs(spark, sf_dir), words=3, percent=85)


def op12_dual_tree_search(spark, sf_dir):
    """The 20 best documents for every benchmark item."""
    return ranked_search(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=20)


def op13_spelling_variants(spark, sf_dir):
    """Every word of seven letters or more with its spelling form and root."""
    return variants(words(_docs(spark, sf_dir), every=31, least=7, times=2), times=10)


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_likelihood_rules": op3_ngram_likelihood_rules,
    "op4_line_site_spread": op4_line_site_spread,
    "op5_benchmark_containment": op5_benchmark_containment,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_word_first_language": op7_word_first_language,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_line_crf_quality": op9_line_crf_quality,
    "op10_counterfactual_toxicity": op10_counterfactual_toxicity,
    "op11_hyperminhash": op11_hyperminhash,
    "op12_dual_tree_search": op12_dual_tree_search,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE = {
    "op1_ngram_jaccard": O.JACCARD,
    "op2_substring_dedup": O.SUBSTRING,
    "op4_line_site_spread": O.LINES,
    "op5_benchmark_containment": O.CONTAINED,
    "op6_warc_revisits": O.REVISITS,
    "op11_hyperminhash": O.HYPERMINHASH,
    "op12_dual_tree_search": O.RANKED,
    "op13_spelling_variants": O.VARIANTS,
}
