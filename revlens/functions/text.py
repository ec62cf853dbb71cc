"""Text cleaning as JVM column expressions (no Python per row).

The patterns use explicit ASCII classes so that Java regex (Spark) and RE2
(the DuckDB oracle) read them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning rules of the review-text pipeline.
# Keep code points 1..126; every other character is dropped.
NON_ASCII = r"[^\x01-\x7E]"
# A hyperlink: scheme, optional www., host.tld, path segments, trailing slash.
URL = r"https?://(www.)?\w+\.\w+(/\w+)*/?"
# One ASCII punctuation character (the 32 characters of C's ispunct).
PUNCT = r"[!-/:-@\[-`{-~]"
DIGITS = r"\d+"
# The same 32 characters, and runs of the six ASCII blanks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BLANKS = r"[\x09-\x0D ]+"
# The default English stop words of Spark ML (Apache License 2.0),
# which StopWordsRemover.loadDefaultStopWords("english") returns.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they",
    "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't",
    "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's",
    "when's", "where's", "who's", "why's", "would",
]


def strip_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, NON_ASCII, "")


def remove_features(c: Column) -> Column:
    """Hyperlinks, then punctuation, then digit runs become a blank, in that order."""
    c = F.regexp_replace(c, URL, " ")
    c = F.regexp_replace(c, PUNCT, " ")
    return F.regexp_replace(c, DIGITS, " ")


def ascii_lower(c: Column) -> Column:
    """ASCII-only lower-case text. Stripping first keeps lower-casing ASCII-only,
    so no engine-specific Unicode case mapping can add characters."""
    return F.lower(strip_non_ascii(c))


def remove_blanks(c: Column) -> Column:
    return F.regexp_replace(c, " ", "")


def sanitize_name(c: Column) -> Column:
    """Keep only characters allowed in a generated column name."""
    return F.regexp_replace(c, "[^0-9a-zA-Z$]+", "")
