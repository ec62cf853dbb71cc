"""Language identification, word first, backing off to character n-grams.

A word the model knows adds its log-frequency in each language. An unseen word
is spelled out in character n-grams, word ends included, of five characters,
then four and so on to one: the first length of which any n-gram is known
decides, and the word adds the mean log-frequency of the known ones. The
language with the largest sum wins.

Learned from a bounded sample (``MOST_DOCS`` labelled documents of each
language, the first by hashed id): the tables hold every word found twice or
more and every n-gram found ``LEAST_GRAM`` times or more in the sample, up to
each language's own ``MOST_ENTRIES`` most frequent ones, however many languages
there are. All texts are predicted, whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.llm.samples import remainder
from revlens.sources.io import persist_cut

MOST_DOCS = 1000
LONGEST = 5
LEAST_WORD, LEAST_GRAM = 2, 3
#: Entries of one language in a table, at most: its most frequent ones.
MOST_ENTRIES = 100_000
_U = np.uint64
_BLANK = 0x20
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Table of letters by code point, made once per process."""
    if not _letters:
        t = np.zeros(0x110000, bool)
        for c in range(0x110000):
            if chr(c).isalpha():
                t[c] = True
        _letters.append(t)
    return _letters[0]


class Letters:
    """Words (runs of letters, in lower case) of some texts, each one between
    blanks, with hashes. ``doc`` is the text of each word."""

    def __init__(self, texts: list[str]):
        low = [t.lower() for t in texts]
        cp = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.cp = np.where(_is_letter()[cp], cp, _BLANK)
        step = np.diff((self.cp != _BLANK).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
        begin = np.cumsum([1] + [len(t) + 1 for t in low])
        self.doc = np.searchsorted(begin, self.starts, "right") - 1
        self.h = X.hash_spans(self._values, self.starts, self.ends)

    def _values(self, a: int, b: int) -> np.ndarray:
        return X.mix(self.cp[a:b].astype(_U) * X.GRAM[3] + X.GRAM[4])

    def grams(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """n-gram hashes of the given words with one blank at either end, and
        the position in ``words`` each belongs to."""
        s, e = self.starts[words] - 1, self.ends[words] + 1
        count = np.maximum(e - s - n + 1, 0)
        owner = np.repeat(np.arange(len(words)), count)
        at = np.repeat(s - (np.cumsum(count) - count), count) + np.arange(count.sum())
        h = np.zeros(len(at), _U)
        for k in range(n):
            h = h * X.GRAM[5] + X.mix(self.cp[at + k].astype(_U) * X.GRAM[6] + X.GRAM[7])
        return X.mix(h + _U(n)), owner


def _pieces(texts: list[str]):
    """Index ranges of consecutive texts of about ``BLOCK_BYTES`` / 2 characters."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > X.BLOCK_BYTES // 2:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, back = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    return h, np.bincount(back, np.concatenate([k for _, k in parts]), len(h)).astype(np.int64)


def _count(batches):
    """Words (length 0) and n-grams of the sample: language, length, hash, count."""
    found: dict[tuple[str, int], list] = {}
    for batch in X.small(batches):
        lang, texts = batch.column("lang").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        for a, b in _pieces(texts):
            w = Letters(texts[a:b])
            by_doc = np.array(lang[a:b], object)[w.doc] if len(w.doc) else np.empty(0, object)
            for one in set(lang[a:b]):
                mine = np.flatnonzero(by_doc == one)
                for n in range(LONGEST + 1):
                    h = w.grams(mine, n)[0] if n else w.h[mine]
                    parts = found.setdefault((one, n), [])
                    parts.append(np.unique(h, return_counts=True))
                    if len(parts) >= 16:
                        parts[:] = [_summed(parts)]
    for (one, n), parts in found.items():
        h, k = _summed(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([one] * len(h), pa.string()), pa.array(np.full(len(h), n, np.int32)), pa.array(h.view(np.int64)),
             pa.array(k)], names=["lang", "n", "h", "k"])


class Table:
    """Sorted hashes, each with the log-frequencies of the languages that have
    it; the others have ``base``. Sparse: few languages share an entry."""

    def __init__(self, h: np.ndarray, lang: np.ndarray, k: np.ndarray, n_langs: int):
        self.h, at = np.unique(h, return_inverse=True)
        order = np.argsort(at, kind="stable")
        self.begin = np.r_[0, np.cumsum(np.bincount(at, minlength=len(self.h)))].astype(np.int64)
        self.lang = lang[order]
        total = np.bincount(lang, k, n_langs) + 0.5 * max(1, len(self.h))
        self.base = np.log(0.5 / total)
        self.value = np.log((k[order] + 0.5) / total[self.lang])

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where unknown."""
        if not len(self.h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, at, -1)

    def sums(self, rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Summed log-frequencies of rows by owner, as (n, languages) matrix."""
        count = self.begin[rows + 1] - self.begin[rows]
        cell = np.repeat(self.begin[rows] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        lang, width = self.lang[cell], len(self.base)
        more = np.bincount(np.repeat(owner, count) * width + lang, self.value[cell] - self.base[lang], n * width)
        return np.bincount(owner, minlength=n)[:, None] * self.base + more.reshape(n, width)


class Model:
    """Languages in order, and per length (0: words) a table."""

    def __init__(self, langs: list[str], tables: dict[int, Table]):
        self.langs, self.tables = langs, tables

    def word_scores(self, w: Letters) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents' summed scores per language as (document, language) matrix
        pieces: word index -> score row, for all words of ``w``."""
        at = self.tables[0].find(w.h)
        hit = at >= 0
        known = np.flatnonzero(hit)
        rows = self.tables[0].sums(at[known], known, len(w.h))
        unseen = np.flatnonzero(~hit)
        _, first, back = np.unique(w.h[unseen], return_index=True, return_inverse=True)
        words = unseen[first]
        score = np.zeros((len(words), len(self.langs)))
        left = np.arange(len(words))
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            h, owner = w.grams(words[left], n)
            g = self.tables[n].find(h)
            ok = g >= 0
            k = np.bincount(owner[ok], minlength=len(left))
            score[left] = self.tables[n].sums(g[ok], owner[ok], len(left)) / np.maximum(k, 1)[:, None]
            left = left[k == 0]
        rows[unseen] = score[back]
        return rows, hit, len(words)


def fit_language(docs: DataFrame, usable: Column, most: int = MOST_DOCS) -> Model:
    """Learn from ``docs`` (doc_id, text, lang) where ``usable`` holds and lang
    and text are not null."""
    few = (docs.where(usable).where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
           .select("doc_id", "lang").withColumn("rank", F.row_number().over(
               Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))).where(F.col("rank") <= most))
    # at most ``most`` ids of each language
    sample = docs.select("doc_id", "text").join(F.broadcast(few.select("doc_id", "lang").distinct()), "doc_id")
    langs = sorted(r.lang for r in few.select("lang").distinct().collect())
    if not langs:
        return Model([], {})
    counts = persist_cut(sample.select("lang", "text").mapInArrow(_count, "lang string, n int, h long, k long")
                         .groupBy("n", "h", "lang").agg(F.sum("k").alias("k")), docs.sparkSession, "language-counts")
    often = counts.groupBy("n", "h").agg(F.sum("k").alias("all")).where(
        F.when(F.col("n") == 0, F.col("all") >= LEAST_WORD).otherwise(F.col("all") >= LEAST_GRAM)).select("n", "h")
    counts = persist_cut(counts.join(often, ["n", "h"], "left_semi"), docs.sparkSession, "language-often")
    # The union of every language's own most frequent entries, with the counts of all languages.
    rank = F.row_number().over(Window.partitionBy("n", "lang").orderBy(F.desc("k"), "h"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= MOST_ENTRIES).select("n", "h").distinct()
    counts = persist_cut(counts.join(top, ["n", "h"], "left_semi"), docs.sparkSession, "language-tables")
    tables = {}
    for n in range(LONGEST + 1):
        t = counts.where(F.col("n") == n).orderBy("h", "lang").select("h", "lang", "k").toArrow()
        lang = t.column("lang").combine_chunks().dictionary_encode()
        place = np.array([langs.index(x) for x in lang.dictionary.to_pylist()], np.int64)
        tables[n] = Table(t.column("h").to_numpy().view(_U), place[lang.indices.to_numpy()],
                          t.column("k").to_numpy().astype(float), len(langs))
    return Model(langs, tables)


def _predict(shared):
    def run(batches):
        model = shared.value
        for batch in X.small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lang, score, seen, known = [], [], [], []
            for a, b in _pieces(texts):
                w = Letters(texts[a:b])
                n = np.bincount(w.doc, minlength=b - a)
                if model.langs:
                    rows, hit, _ = model.word_scores(w)
                    total = np.stack([np.bincount(w.doc, rows[:, c], b - a) for c in range(len(model.langs))], 1)
                    best = total.argmax(1)
                    p = 1 / np.exp(total - total.max(1)[:, None]).sum(1)
                    words = np.bincount(w.doc, hit, b - a)
                else:
                    best, p, words = None, np.zeros(b - a), np.zeros(b - a)
                has = (n > 0) & (best is not None)
                lang += [model.langs[best[i]] if x else "und" for i, x in enumerate(has)]
                score.append(np.where(has, p, 0.0))
                seen.append(n)
                known.append(words)
            cat = (lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(cat(score, float)),
                 pa.array(cat(seen, np.int64)), pa.array(cat(known, np.int64))],
                names=["doc_id", "lang_pred", "score", "n_words", "n_known_words"])
    return run


def predict_language(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (posterior of the prediction, 0 to 1), n_words
    (runs of letters) and n_known_words, for every row of ``docs`` (doc_id,
    text; other columns are ignored). Null text and text without letters gives
    ``und`` and 0. Equal sums go to the first language by name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        _predict(shared), "doc_id long, lang_pred string, score double, n_words long, n_known_words long")


def predict_held_out(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Fit on documents whose remainder by ``folds`` is not 0, predict all."""
    held = remainder(F.col("doc_id"), folds) == 0
    out = predict_language(docs, fit_language(docs, ~held))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_words", "n_known_words")
