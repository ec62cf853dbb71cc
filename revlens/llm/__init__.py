"""Operators for building training corpora: near-duplicate joins, substring and
line deduplication, quality rules and classifiers, decontamination, crawl
records, language identification, byte-level BPE and toxicity scoring.

Nothing else in the library imports this subpackage.
"""
