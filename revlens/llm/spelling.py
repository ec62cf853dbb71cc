"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is the vector of its letter counts; an inserted or deleted letter moves it
by one, a replaced letter by two, in L1 distance. Words one edit apart therefore
lie in each other's boxes, and the order of letters is verified for those alone.

1. *Words.* Runs of letters are counted by a grouped sum, combined map-side.
2. *Top trees.* For each word length a k-d tree over a bounded hashed part of the
   words splits that length into cells of some ``CELL`` words. Only its planes come
   from a part; every word is placed and searched.
3. *Range search, length pair by length pair.* A word asks the tree of its own
   length for vectors that differ by one letter up and one down, and the tree of
   the next length for vectors with one letter more. It is sent to the cells whose
   box holds such a vector: a path may leave the word's own side at most once up
   and once down.
4. *In a cell* the home words form a k-d tree whose nodes carry their exact box of
   counts; visiting words are pruned box by box, batch by batch, then compared.
5. *Forms* are grouped minima over the pairs found, *roots* the ends of the chains
   of forms, by doubling: counts grow tenfold a step, so chains are short.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.sources.io import persist_cut

#: Letters a to z and the code points from 00C0 to 00FF.
LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
DIMS = len(LETTERS)
_PLACE = np.zeros(0x100, np.int64)
_PLACE[LETTERS] = np.arange(DIMS)
#: Words of a cell, words from which the planes of all top trees are chosen.
CELL, SAMPLE = 8192, 100_000
#: Largest count of a letter that vectors hold, so that differences fit a byte.
MOST = 60
#: Words of a leaf of a cell's own tree.
LEAF = 48
#: Cells of the rows compared at once, so that long words stay bounded.
COMPARED = 4_000_000
_PARTS = 1 << 30


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    return np.array([list(w.encode("latin-1")) for w in words], np.uint8).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Vectors of words of one length; counts beyond ``MOST`` are cut there, which
    only brings vectors nearer."""
    n = len(codes)
    key = _PLACE[codes] + np.arange(n)[:, None] * DIMS
    return np.minimum(np.bincount(key.ravel(), minlength=n * DIMS), MOST).astype(np.int8).reshape(n, DIMS)


def plane(v: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that halve some vectors best: a vector goes left if it
    has at most so many of the letter. None if all are alike."""
    n = len(v)
    best, at = 0, None
    for s in np.unique(v)[:-1].tolist():
        left = (v <= s).sum(0)
        even = np.minimum(left, n - left)
        d = int(even.argmax())
        if even[d] > best:
            best, at = int(even[d]), (d, s)
        if best * 3 > n:
            break
    return at


class TopTree:
    """Planes of one length. Nodes are lists [letter, count, left, right]; a
    negative child is the cell ``-1 - child``."""

    def __init__(self, v: np.ndarray, share: float):
        self.nodes: list[list[int]] = []
        self.cells, self.root = 0, None
        todo = [(v, None, 0)]
        while todo:
            v, parent, side = todo.pop()
            p = plane(v) if len(v) > 16 and len(v) * share > CELL else None
            if p is None:
                self.cells += 1
                me = -self.cells
            else:
                me = len(self.nodes)
                self.nodes.append([*p, 0, 0])
                left = v[:, p[0]] <= p[1]
                todo += [(v[left], me, 2), (v[~left], me, 3)]
            if parent is None:
                self.root = me
            else:
                self.nodes[parent][side] = me

    def visits(self, v: np.ndarray, down: bool):
        """(rows, cell, whether it is their own) for every cell that may hold a
        vector one letter up, and with ``down`` one letter down, from a row. Without
        ``down`` no cell is a row's own."""
        n = len(v)
        none = np.full(n, -1)
        todo = [(self.root, np.arange(n), none, none if down else np.full(n, -2))]
        while todo:
            node, rows, up, off = todo.pop()  # letters already moved up and down
            if not len(rows):
                continue
            if node < 0:
                yield rows, -1 - node, (up == -1) & (off == -1)
                continue
            d, s, left, right = self.nodes[node]
            x = v[rows, d] + (up == d) - (off == d)
            low = x <= s
            rise = low & (x == s) & (up == -1) & (off != d)
            fall = ~low & (x == s + 1) & (off == -1) & (up != d)
            todo.append((left, np.r_[rows[low], rows[fall]], np.r_[up[low], up[fall]],
                         np.r_[off[low], np.full(int(fall.sum()), d)]))
            todo.append((right, np.r_[rows[~low], rows[rise]], np.r_[up[~low], np.full(int(rise.sum()), d)],
                         np.r_[off[~low], off[rise]]))


class KdTree:
    """Home words of a cell: a k-d tree whose nodes hold the box of their vectors.
    It knows only the letters that home words have; what a visitor has of others
    can but be letters down."""

    def __init__(self, v: np.ndarray):
        self.used = v.any(0)
        v = np.ascontiguousarray(v[:, self.used])
        self.v = v
        self.order = np.arange(len(v))
        self.nodes: list[tuple[int, int, list[int]]] = []
        low, high = [], []
        todo: list[tuple] = [(0, len(v), None)]
        while todo:
            a, b, parent = todo.pop()
            rows = self.order[a:b]
            own = v[rows]
            if parent is not None:
                self.nodes[parent][2].append(len(self.nodes))
            self.nodes.append((a, b, []))
            low.append(own.min(0))
            high.append(own.max(0))
            p = plane(own) if b - a > LEAF else None
            if p is not None:
                left = own[:, p[0]] <= p[1]
                self.order[a:b] = np.r_[rows[left], rows[~left]]
                mid = a + int(left.sum())
                me = len(self.nodes) - 1
                todo += [(a, mid, me), (mid, b, me)]
        self.low, self.high = np.array(low), np.array(high)

    def near(self, q: np.ndarray, down: int):
        """(query rows, word rows) whose vectors differ by at most ``down`` (0 or 1)
        letters down and one up, leaf by leaf; a few of more up are among them."""
        left = down - q[:, ~self.used].sum(1, dtype=np.int64)
        rows = np.flatnonzero(left >= 0)
        q = np.ascontiguousarray(q[:, self.used])
        todo = [(0, rows)]
        while todo:
            node, rows = todo.pop()
            x = q[rows]
            up = np.maximum(self.low[node] - x, 0).sum(1, dtype=np.int16)
            off = np.maximum(x - self.high[node], 0).sum(1, dtype=np.int16)
            rows = rows[(up <= 1) & (off <= left[rows])]
            if not len(rows):
                continue
            a, b, below = self.nodes[node]
            if below:
                todo += [(c, rows) for c in below]
                continue
            own = self.order[a:b]
            step = max(1, COMPARED // ((b - a) * max(1, q.shape[1])))
            for i in range(0, len(rows), step):
                some = rows[i:i + step]
                far = np.abs(self.v[own][None] - q[some][:, None]).sum(2, dtype=np.int16)
                r, c = np.nonzero(far <= (1 + left[some])[:, None])
                yield some[r], own[c]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of codes of one length that differ in one place."""
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows ``b``, one code longer, from which deleting one code makes ``a``."""
    n = a.shape[1]
    head = np.cumprod(a == b[:, :n], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    return head + tail >= n


def _by_length(words: list[str]):
    """(length, rows of that length)."""
    size = np.array([len(w) for w in words], np.int64)
    for n in np.unique(size).tolist():
        yield n, np.flatnonzero(size == n)


def _place(shared):
    """Words -> (length of the cell's words, cell, home, word, n), for every cell
    in which they live or search."""
    def run(batches):
        trees = shared.value
        one = TopTree(np.empty((0, DIMS), np.int8), 1.0)  # lengths without planes are one cell
        for batch in X.small(batches, 4096):
            words, n = batch.column("word").to_pylist(), batch.column("n")
            for size, rows in _by_length(words):
                step = max(1, COMPARED // size)
                for part in (rows[i:i + step] for i in range(0, len(rows), step)):
                    v = letter_counts(_codes([words[i] for i in part]))
                    found = [(size, *x) for x in trees.get(size, one).visits(v, True)]
                    found += [(size + 1, *x) for x in trees.get(size + 1, one).visits(v, False)]
                    at = part[np.concatenate([r for _, r, _, _ in found])]
                    count = [len(r) for _, r, _, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([s for s, _, _, _ in found], count).astype(np.int32)),
                         pa.array(np.repeat([c for _, _, c, _ in found], count).astype(np.int32)),
                         pa.array(np.concatenate([h for _, _, _, h in found])),
                         batch.column("word").take(pa.array(at)), n.take(pa.array(at))],
                        names=["size", "cell", "home", "word", "n"])
    return run


class _Cell:
    """Home words of one cell and what finds their near words among visitors."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = np.array(words, object), n
        self.codes = _codes(words)
        self.tree = KdTree(letter_counts(self.codes))

    def search(self, words: list[str], n: np.ndarray):
        for size, rows in _by_length(words):
            same = size == self.codes.shape[1]
            codes = _codes([words[i] for i in rows])
            for q, h in self.tree.near(letter_counts(codes), int(same)):
                step = max(1, COMPARED // size)
                for i in range(0, len(q), step):
                    a, b = codes[q[i:i + step]], self.codes[h[i:i + step]]
                    # of two words of one length, the smaller asks
                    ok = one_replaced(a, b) & (a < b).any(1) if same else one_inserted(a, b)
                    u, v = rows[q[i:i + step][ok]], h[i:i + step][ok]
                    if len(u):
                        yield [words[k] for k in u], n[u], self.words[v].tolist(), self.n[v]


def _search(batches):
    """Rows sorted by (size, cell, part, home words first) -> pairs of near words.
    The home words of one cell part are held, visitors pass in batches."""
    key, home, cell = None, [], None

    def pairs(rows: pa.RecordBatch):
        found = list(cell.search(rows.column("word").to_pylist(), rows.column("n").to_numpy()))
        if found:
            u, n, v, m = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(itertools.chain.from_iterable(u), pa.string()), pa.array(np.concatenate(n)),
                 pa.array(itertools.chain.from_iterable(v), pa.string()), pa.array(np.concatenate(m))],
                names=["u", "nu", "v", "nv"])

    for batch in X.small(batches, 8192):
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(c).to_numpy() for c in ("size", "cell", "part")] +
                      [batch.column("home").to_numpy(zero_copy_only=False)], 1)
        begin = np.r_[0, np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1, len(at)].tolist()
        for i, j in zip(begin[:-1], begin[1:]):
            rows, mine = batch.slice(i, j - i), tuple(at[i, :3].tolist())
            if mine != key:
                key, home, cell = mine, [], None
            if at[i, 3]:
                home.append((rows.column("word").to_pylist(), rows.column("n").to_numpy()))
                continue
            if home:
                words = list(itertools.chain.from_iterable(w for w, _ in home))
                cell, home = _Cell(words, np.concatenate([n for _, n in home])), []
            if cell is not None:
                yield from pairs(rows)


def words(docs: DataFrame, every: int = 31, least: int = 7, times: int = 2) -> DataFrame:
    """(word, n) of ``docs`` (doc_id, text): runs of letters, A-Z lower-cased, of
    ``least`` code points or more and ``times`` occurrences or more. Of a run whose
    crc32 together with its document's id is a multiple of ``every``, one letter is
    lost (misspellings at a known rate). Null texts hold no run; a null id counts as
    empty text."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
                       F.explode(F.regexp_extract_all(text, F.lit("[a-zÀ-ÿ]+"), 0)).alias("run"))
    runs = runs.where(F.length("run") >= least)
    h = F.crc32(F.concat("_id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    lost = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    word = runs.select("run", h.alias("h"), at.alias("at")).select(
        F.when(F.col("h") % every == 0, lost).otherwise(F.col("run")).alias("word"))
    return word.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= times)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs (u, nu, v, nv) of words of ``vocabulary`` (word, n; distinct words of
    the letters above) that are one edit apart, each pair once."""
    spark = vocabulary.sparkSession
    total = vocabulary.count()
    part = F.pmod(F.xxhash64("word"), F.lit(_PARTS)) < int(_PARTS * min(1.0, SAMPLE / max(total, 1)))
    sample = [r["word"] for r in vocabulary.where(part).select("word").collect()] if total > CELL else []
    trees = {}
    for size, rows in _by_length(sample):
        trees[size] = TopTree(letter_counts(_codes([sample[i] for i in rows])), total / max(len(sample), 1))
    placed = persist_cut(vocabulary.mapInArrow(_place(spark.sparkContext.broadcast(trees)),
                                               "size int, cell int, home boolean, word string, n long"),
                         spark, "spelling-cells")
    # Words that planes cannot part (anagrams) may crowd a cell: its home words are
    # split, and its visitors go to every part.
    crowded = persist_cut(placed.where("home").groupBy("size", "cell").agg(
        F.ceil(F.count(F.lit(1)) / (2 * CELL)).cast("int").alias("parts")).where("parts > 1"), spark, "spelling-crowded")
    rows = placed.join(crowded, ["size", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), "parts").cast("int")
    home = rows.where("home").withColumn("part", own).drop("parts")
    guest = rows.withColumn("home", F.lit(False)).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    return (home.unionByName(guest).repartition("size", "cell", "part")
            .sortWithinPartitions("size", "cell", "part", F.desc("home"))
            .mapInArrow(_search, "u string, nu long, v string, nv long"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form) without cycles: the last form of each chain,
    by doubling."""
    spark = forms.sparkSession
    cur = persist_cut(forms.select("word", F.col("form").alias("root")), spark, "spelling-roots")
    while True:
        on = cur.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        cur = persist_cut(cur.join(on, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            spark, "spelling-roots")
        moved = cur.where("moved").limit(1).count()
        cur = cur.drop("moved")
        if not moved:
            return cur


def variants(vocabulary: DataFrame, times: int = 10) -> DataFrame:
    """Spelling variants of a ``vocabulary`` (word, n; distinct words of letters
    a-z and 00C0-00FF; other columns are ignored).

    Returns one row per word: word, n, n_near (words one inserted, deleted or
    replaced letter away), form (its near word of largest n, ties by code point
    order, if that n is at least ``times`` its own; else null), form_n, root (the
    last form from the word on; itself without one). ``times`` must exceed 1. An
    empty table gives an empty result.
    """
    if times <= 1:
        raise ValueError("times must exceed 1, else forms could go in circles")
    spark = vocabulary.sparkSession
    vocabulary = persist_cut(vocabulary.select("word", "n"), spark, "spelling-words")
    pairs = persist_cut(near_pairs(vocabulary), spark, "spelling-pairs")
    each = pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("word"), F.col("v").alias("other"), F.col("nv").alias("m")),
        F.struct(F.col("v").alias("word"), F.col("u").alias("other"), F.col("nu").alias("m")))).alias("p")).select("p.*")
    best = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    big = -F.col("best.less") >= times * F.col("n")
    out = persist_cut(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(big, F.col("best.other")).alias("form"),
        F.when(big, -F.col("best.less")).alias("form_n")), spark, "spelling-forms")
    end = roots(out.where("form IS NOT NULL"))
    return out.join(end, "word", "left").withColumn("root", F.coalesce("root", "word"))
