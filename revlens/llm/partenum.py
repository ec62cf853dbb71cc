"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti, Kaushik, VLDB 2006).

Two texts link when their word-shingle sets have Jaccard similarity of at
least ``percent``/100. The join is exact:

1. *Equal sets* are one node (128 bits of set fingerprint and the size folded
   to 64), so copies cost nothing further.
2. *Signatures.* Sizes fall into bands whose ends have the ratio of the
   threshold, so a linked pair lies in one band or two neighbouring ones, and
   each set signs for its own band and the next. Within a band the threshold
   bounds the symmetric difference by k. The feature domain is hashed into n1
   parts of n2 sub-parts; some part holds at most k2 = k // n1 differences, so
   some n2 - k2 of its sub-parts are equal in both sets. A signature is the
   content of such a subset of sub-parts; all subsets are enumerated.
3. *Buckets* of equal signatures come from one shuffle of (signature, node),
   sorted and scanned as a stream; only buckets of two nodes or more are kept.
4. *First round.* Each node is paired with the bucket minima it meets most
   often. These few pairs, verified, join most of a large group of near copies.
5. *Second round.* Buckets that still hold several components are searched
   completely, in blocks of bounded size: all pairs of different components
   are compared by odd sketches (one parity bit per slot; the number of
   unequal bits never exceeds the symmetric difference, so the filter loses no
   link) and the survivors verified. A pair that an early bucket has reported
   is not reported again. After it no link can join two components.

Verification counts the intersection of the two texts' shingle sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.llm.components import components
from revlens.llm.samples import without
from revlens.sources.io import persist_cut

#: Nodes in one block of a bucket in the second round; larger buckets are
#: split into blocks and every pair of blocks is searched.
BLOCK_NODES = 2048
#: A pair met in one of the first so many buckets of both nodes is not reported
#: again by a later one. More only saves repeated reports.
KNOWN_BUCKETS = 16
#: Ids up to which the texts to verify are picked by a broadcast semi join
#: (16 bytes each); beyond it the same join shuffles.
BROADCAST_IDS = 500_000
_U = np.uint64


class Bands:
    """Size bands and signature parameters for a threshold of percent/100."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must be in 1..100")
        self.percent = percent
        self._low = [1]

    def of(self, size: int) -> int:
        while self._low[-1] <= size:
            self._low.append(self._low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self._low, size, "right")) - 1

    def top(self, band: int) -> int:
        """Largest size in a band."""
        while len(self._low) <= band + 1:
            self._low.append(self._low[-1] * 100 // self.percent + 1)
        return self._low[band + 1] - 1

    def differences(self, band: int) -> int:
        """Largest symmetric difference of a linked pair that meets in ``band``."""
        return 2 * (100 - self.percent) * self.top(band) // (100 + self.percent)

    def parts(self, band: int) -> tuple[int, int, int]:
        """Parts, sub-parts of each, and differences tolerated in a part: one of the
        parts of a linked pair holds at most one difference, so two of its three
        sub-parts agree. A signature covers 4/3 of the domain that it would with
        k + 1 plain parts, at 3/2 as many signatures."""
        k = self.differences(band)
        n1 = (k + 2) // 2
        k2 = k // n1
        return n1, 3 if k2 else 1, k2

    def slots(self, band: int) -> int:
        """Bits of the odd sketch, one to two for each element of the largest set."""
        return max(64, 1 << (self.top(band) - 1).bit_length())


def signatures(s: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """PartEnum signatures of a non-empty set for one band."""
    n1, n2, k2 = bands.parts(band)
    x = X.mix(s ^ X.GRAM[20] * np.array([band + 1], _U))
    part = (x % _U(n1 * n2)).astype(np.int64)
    y = X.mix(x + X.GRAM[21])
    # bincount sums doubles, exact for 2^21 halves of 32 bits
    low = np.bincount(part, (y & _U(0xFFFFFFFF)).astype(float), n1 * n2).astype(_U)
    high = np.bincount(part, (y >> _U(32)).astype(float), n1 * n2).astype(_U)
    content = X.mix(low * X.GRAM[22] + high * X.GRAM[23]).reshape(n1, n2)
    out = []
    for subset in itertools.combinations(range(n2), n2 - k2):
        sig = np.zeros(n1, _U)
        for place, sub in enumerate(subset):
            sig = sig + content[:, sub] * X.GRAM[24 + place]
        out.append(sig + X.GRAM[30] * np.array([sum(1 << c for c in subset)], _U))
    key = np.arange(n1, dtype=_U) * X.GRAM[31] + X.GRAM[32] * np.array([band + 1], _U)
    # the lowest bit tells the band from its neighbours
    return np.concatenate([(X.mix(o + key) & ~_U(1)) | _U(band & 1) for o in out])


def odd_sketch(s: np.ndarray, slots: int) -> bytes:
    """Parity of the number of elements hashed to each slot."""
    at = (X.mix(s + X.GRAM[33]) % _U(slots)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=slots) & 1).astype(np.uint8).tobytes()


def _node(s: np.ndarray) -> int:
    """64-bit id of a set: two independent sums of mixed elements and the size."""
    a = X.mix(s + X.GRAM[34]).sum(dtype=_U)
    b = X.mix(s ^ X.GRAM[35]).sum(dtype=_U)
    v = X.mix(np.array([a], _U) * X.GRAM[36] + np.array([b], _U) * X.GRAM[37] + _U(len(s)))
    return int(v.astype(np.int64)[0])


def _sets(texts: list[bytes], words: int) -> Iterator[tuple[int, np.ndarray]]:
    for block in X.blocks(texts, lower=True):
        for row, h in block.docs():
            yield row, X.shingle_set(h, words)


def _describe(words: int, percent: int):
    def run(batches):
        bands = Bands(percent)
        for batch in X.small(batches):
            n, node, band, home, guest = [], [], [], [], []
            for _, s in _sets(X.text_bytes(batch.column("text")), words):
                n.append(len(s))
                if len(s):
                    b = bands.of(len(s))
                    node.append(_node(s))
                    band.append(b)
                    home.append(odd_sketch(s, bands.slots(b)))
                    guest.append(odd_sketch(s, bands.slots(b + 1)))
                else:
                    for a in (node, band, home, guest):
                        a.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(band, pa.int32()), pa.array(home, pa.binary()), pa.array(guest, pa.binary())],
                names=["doc_id", "n_shingles", "node", "band", "home", "guest"])
    return run


def _sign(words: int, percent: int):
    def run(batches):
        bands = Bands(percent)
        done: set[int] = set()  # nodes this task has signed: a combiner for copies
        for batch in X.small(batches):
            sig, node = [], []
            for _, s in _sets(X.text_bytes(batch.column("text")), words):
                if not len(s) or (i := _node(s)) in done:
                    continue
                done.add(i)
                b = bands.of(len(s))
                for one in (b, b + 1):
                    sig.append(signatures(s, one, bands))
                    node.append(np.full(len(sig[-1]), i, np.int64))
            if sig:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(node))],
                    names=["sig", "node"])
    return run


def _shared(batches):
    """Rows sorted by (sig, node) -> distinct rows of signatures with two nodes
    or more, with the signature's smallest node. A stream: between batches only
    the last row, its signature's first node and node count are held."""
    sig = node = np.empty(0, np.int64)
    first, seen = 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.r_[sig, batch.column("sig").to_numpy()]
        node = np.r_[node, batch.column("node").to_numpy()]
        fresh = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
        sig, node = sig[fresh], node[fresh]
        opens = np.r_[True, sig[1:] != sig[:-1]]
        begin = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        low, size = node[begin], np.diff(np.r_[begin, len(sig)])
        if seen:
            low[0], size[0] = first, size[0] + seen - 1
        keep = size[run] > 1
        if seen > 1:
            keep[0] = False  # went out with an earlier batch
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(node[keep]), pa.array(low[run][keep])],
                                             names=["sig", "node", "pivot"])
        first, seen = low[-1], int(size[-1])
        sig, node = sig[-1:], node[-1:]


def _far(a: bytes, b: bytes) -> int:
    return int(np.bitwise_count(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).sum())


def _most(n, m, percent: int):
    """Largest symmetric difference of linked sets of sizes n and m."""
    return (100 - percent) * (n + m) // (100 + percent)


def _close(percent: int):
    """Pairs with sketches -> pairs whose sketches allow a link."""
    def run(batches):
        for batch in X.small(batches):
            keep = []
            c = {k: batch.column(k).to_pylist() for k in ("nu", "nv", "bu", "bv", "hu", "hv", "gu", "gv")}
            for nu, nv, bu, bv, hu, hv, gu, gv in zip(*c.values()):
                if abs(bu - bv) > 1:
                    keep.append(False)
                    continue
                far = _far(hu, hv) if bu == bv else _far(gu, hv) if bu < bv else _far(hu, gv)
                keep.append(far <= _most(nu, nv, percent))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _candidates(t: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block pair of one bucket that are of different components,
    near by their sketches and not known to be together in a bucket of smaller
    signature, which reports them."""
    bits = np.frombuffer(b"".join(t["sketch"]), np.uint8).reshape(len(t["sketch"]), -1)
    rep, comp, n, side = t["rep"], t["comp"], t["n_shingles"], t["side"]
    within = side.min() == side.max()
    earlier: dict[int, frozenset] = {}  # by row: its smaller signatures
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def met_before(i: int, j: int) -> bool:
        for k in (i, j):
            if k not in earlier:
                earlier[k] = frozenset(t["earlier"][k])
        return not earlier[i].isdisjoint(earlier[j])

    for i in range(len(rep)):
        j = np.flatnonzero((comp != comp[i]) & ((rep > rep[i]) if within else (side > side[i])))
        if len(j):
            most = _most(n[j], n[i], percent)
            j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64) <= most]
            j = np.array([k for k in j.tolist() if not met_before(i, k)], np.int64)
            us.append(np.full(len(j), rep[i]))
            vs.append(rep[j])
    return np.concatenate(us), np.concatenate(vs)


def _search(percent: int):
    """Rows sorted by (sig, lo, hi), one run per block pair of a bucket ->
    candidate pairs. A run has at most about ``2 * BLOCK_NODES`` rows, and no
    more than one run is held between batches."""
    def run(batches):
        rest: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                t, rest = rest, None
            else:
                t = pa.Table.from_batches([batch])
                t = pa.concat_tables([rest, t]) if rest is not None else t
            if t is None or not t.num_rows:
                continue
            key = np.stack([t.column(c).to_numpy() for c in ("sig", "lo", "hi")], 1)
            begin = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)]
            if batch is not None:
                rest = t.slice(int(begin[-2]))
                begin = begin[:-1]
            c = {k: t.column(k).to_numpy() for k in ("rep", "comp", "n_shingles", "side")}
            # Sketches and bucket lists become Python objects one run at a time.
            pairs = [_candidates({k: v[i:j] for k, v in c.items()} | {
                k: t.column(k).slice(i, j - i).to_pylist() for k in ("sketch", "earlier")}, percent)
                for i, j in zip(begin[:-1].tolist(), begin[1:].tolist())]
            if pairs:
                u, v = (np.concatenate(x) for x in zip(*pairs))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))],
                                                 names=["u", "v"])
    return run


def _verify(words: int, percent: int):
    def run(batches):
        for batch in X.small(batches):
            keep = []
            for (_, a), (_, b) in zip(*(_sets(X.text_bytes(batch.column(c)), words) for c in ("tu", "tv"))):
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the given doc_ids; the ids are broadcast when few enough."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among ``pairs`` (u, v), by the texts' own shingle sets."""
    spark = docs.sparkSession
    ids = persist_cut(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), spark, "verify-ids")
    texts = persist_cut(_texts(docs, ids), spark, "verify-texts")
    u = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    v = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv"))
    return pairs.join(u, "u").join(v, "v").select("u", "v", "tu", "tv").mapInArrow(
        _verify(words, percent), "u long, v long")


def jaccard_classes(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id long unique, text string;
    other columns are ignored).

    Returns one row per document: doc_id, n_shingles (distinct shingles),
    component_id (smallest doc_id reachable by links, its own without links).
    Null, empty and blank texts have no shingles and stay alone. Rows with a
    null doc_id are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    base = persist_cut(docs.mapInArrow(_describe(words, percent),
                                       "doc_id long, n_shingles long, node long, band int, home binary, guest binary"),
                       spark, "sets")
    shared = persist_cut(docs.mapInArrow(_sign(words, percent), "sig long, node long")
                         .repartition("sig").sortWithinPartitions("sig", "node")
                         .mapInArrow(_shared, "sig long, node long, pivot long"), spark, "buckets")
    reps = persist_cut(base.where("node IS NOT NULL").groupBy("node").agg(
        F.min_by(F.struct("doc_id", "n_shingles", "band", "home", "guest"), "doc_id").alias("r"))
        .select("node", F.col("r.doc_id").alias("rep"), "r.n_shingles", "r.band", "r.home", "r.guest")
        .join(shared.select("node").distinct(), "node", "left_semi"), spark, "reps")

    # First round: the two bucket minima met most often.
    met = shared.where("node <> pivot").groupBy("node", "pivot").count()
    best = met.withColumn("rank", F.row_number().over(
        Window.partitionBy("node").orderBy(F.desc("count"), "pivot"))).where("rank <= 2")
    left, right = (reps.select(F.col("node").alias(k), F.col("rep").alias(u), F.col("n_shingles").alias("n" + u),
                               F.col("band").alias("b" + u), F.col("home").alias("h" + u),
                               F.col("guest").alias("g" + u)) for k, u in (("node", "u"), ("pivot", "v")))
    first = persist_cut(best.join(left, "node").join(right, "pivot")
                        .select("u", "v", "nu", "nv", "bu", "bv", "hu", "hv", "gu", "gv")
                        .mapInArrow(_close(percent), "u long, v long"), spark, "pairs")
    links1 = persist_cut(_verified(first, docs, words, percent), spark, "links")
    comp1 = persist_cut(components(links1), spark, "components")

    # Second round: buckets that still hold several components.
    known = reps.join(comp1, reps.rep == comp1.node, "left").select(
        reps.node, "rep", F.coalesce("component", "rep").alias("comp"))
    rows = persist_cut(shared.select("sig", "node").join(known, "node"), spark, "bucket-rows")
    mixed = rows.groupBy("sig").agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(38,0)")).alias("y")).where("least < most")
    # Buckets of one band with the same members are searched once.
    mixed = persist_cut(mixed.groupBy("x", "y", "n", F.expr("sig & 1")).agg(F.min("sig").alias("sig")).select(
        "sig", F.ceil(F.col("n") / BLOCK_NODES).cast("int").alias("n_blocks")), spark, "mixed")
    at_home = F.expr("(sig & 1) = (band & 1)")
    # A node's buckets in order, so that each knows the first ones before it.
    of_node = rows.join(mixed, "sig").groupBy("node", "rep", "comp").agg(
        F.array_sort(F.collect_list(F.struct("sig", "n_blocks"))).alias("buckets"))
    todo = (of_node.join(reps.select("node", "n_shingles", "band", "home", "guest"), "node")
            .select("*", F.posexplode("buckets").alias("place", "bucket"))
            .select("rep", "comp", "n_shingles", "band", "home", "guest", "bucket.sig", "bucket.n_blocks",
                    F.slice("buckets.sig", F.lit(1), F.least("place", F.lit(KNOWN_BUCKETS))).alias("earlier"))
            .select("sig", "rep", "comp", "n_shingles", "n_blocks", "earlier",
                    F.pmod(F.xxhash64("rep"), "n_blocks").cast("int").alias("side"),
                    F.when(at_home, F.col("home")).otherwise(F.col("guest")).alias("sketch"))
            .withColumn("other", F.explode(F.expr("sequence(0, n_blocks - 1)")))
            .select("*", F.least("side", "other").cast("long").alias("lo"),
                    F.greatest("side", "other").cast("long").alias("hi")).drop("other", "n_blocks"))
    second = persist_cut(todo.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi")
                         .mapInArrow(_search(percent), "u long, v long").distinct(), spark, "pairs")
    links = links1.unionByName(_verified(second, docs, words, percent))
    comp = components(links)
    own = base.groupBy("node").agg(F.min("doc_id").alias("rep")).where("node IS NOT NULL")
    own = persist_cut(own.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "node", F.coalesce("component", "rep").alias("component_id")), spark, "classes")
    return base.select("doc_id", "n_shingles", "node").join(own, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all their columns, but those whose class has a smaller doc_id."""
    return without(docs, jaccard_classes(docs, words, percent).where("component_id < doc_id"))
