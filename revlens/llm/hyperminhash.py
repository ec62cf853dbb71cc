"""Near duplicates by HyperMinHash registers (Yu and Weber, 2017).

Every word shingle hashes into one of 256 buckets; a bucket keeps its smallest
hash, compressed to 16 bits: the number of leading zeros and the ten bits after
the first one. Two texts link when the Jaccard similarity of their shingle sets
is at least ``percent``/100.

1. *One pass over the texts* gives each set its size, a 128-bit fingerprint, its
   registers and its band keys. Equal sets are one node from here on, whose id is
   the smallest doc_id that has it, so copies cost nothing further.
2. *Bands.* The registers of a band are hashed to one key. An empty bucket lends
   its place in a band to the first full bucket of a fixed random order of its own
   (optimal densification), so that each register of small sets, too, agrees with
   a probability near the Jaccard similarity. Bands have as many registers as keep
   the chance that all bands of a linked pair differ under ``MISS``: six for 0.85,
   where it is (1 - 0.85^6)^42 = 2e-9.
3. *Meeting.* Smallest node and number of rows of a key are a grouped minimum and
   count, combined map-side; keys of two nodes or more come back to their rows by
   a join on the key, which AQE can split when a key is hot.
4. *First round.* Each node is paired with the two smallest nodes of its buckets
   that it meets most often. Verified, these pairs join most of a large group.
5. *Second round.* Buckets that still hold several components are searched
   completely, in blocks of bounded size, the likeliest pairs first. A pair is
   verified there only while its components are apart, and a block hands on no
   more links than join its components.
6. *Estimate.* The share of equal registers among buckets that either set fills,
   less the equal registers that chance makes (closed form for the two sizes). A
   pair is dropped only when it lies ``SLACK`` standard errors under the threshold;
   registers are drawn from the union without replacement, so small sets, whose
   shingles are nearly all seen, are told apart sharply.
7. *Verification* counts the intersection of the two whole shingle sets.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm import textops as X
from revlens.llm.components import components
from revlens.sources.io import persist_cut

#: Registers, a power of two, and bits of a hash that follow its bucket number.
BUCKETS, HASH_BITS = 256, 48
#: Bits kept after the first one bit of a hash.
MANTISSA = 10
#: Largest probability of a pair at the threshold to meet in no band.
MISS = 1e-8
#: Standard errors of the estimate by which a pair must fall short to be dropped:
#: a link is lost here with a probability of 1e-9.
SLACK = 6.0
#: Nodes, and their shingles, of one block of a bucket in the second round; larger
#: buckets are split into blocks and every pair of blocks is searched.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1_000_000
#: Ids up to which texts that meet are picked, and copies left out, by a broadcast
#: join (at most 32 bytes each); beyond it the same join shuffles.
BROADCAST_IDS = 500_000
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(19))
#: For each bucket the others in random order, from which an empty one borrows.
_LENDERS = np.stack([_rng.permutation(np.delete(np.arange(BUCKETS), j)) for j in range(BUCKETS)]).astype(np.uint8)
_BAND_KEYS = _rng.integers(0, 2**64, BUCKETS, dtype=_U) | _U(1)
_EDGES = np.arange(BUCKETS, dtype=_U) << _U(56)
#: Left ends of the octaves that the leading zeros tell apart.
_OCTAVE = 0.5 ** np.arange(1, HASH_BITS + 1)


def registers(s: np.ndarray) -> np.ndarray:
    """The 256 registers of a set of mixed 64-bit shingle hashes; 0 is an empty
    bucket."""
    x = np.sort(X.mix(s ^ X.GRAM[40]))
    at = np.searchsorted(x, _EDGES)
    end = np.r_[at[1:], len(x)]
    full = end > at
    least = (x[np.minimum(at, len(x) - 1)] << _U(8)) >> _U(64 - HASH_BITS)
    frac, size = np.frexp(least.astype(np.float64))  # 48 bits are exact in a double
    tail = ((frac * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    zeros = HASH_BITS - size
    value = ((zeros + 1) << MANTISSA) | np.where(least > 0, tail, 0)
    return np.where(full, value, 0).astype(np.uint16)


def densified(r: np.ndarray) -> np.ndarray:
    """Registers with empty buckets filled from the first full one in their
    order of lenders; at least one must be full."""
    full = r > 0
    empty = np.flatnonzero(~full)
    if not len(empty):
        return r
    out = r.copy()
    width = 16
    while len(empty):
        can = full[_LENDERS[empty, :width]]
        found = can.any(1)
        some = empty[found]
        out[some] = r[_LENDERS[some, can[found].argmax(1)]]
        empty, width = empty[~found], BUCKETS
    return out


def band_rows(percent: int) -> int:
    """Registers of one band: the most that keep a miss under ``MISS``."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    t = percent / 100
    return max([1] + [r for r in range(2, 17) if (1 - t ** r) ** (BUCKETS // r) <= MISS])


def band_keys(r: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` densified registers."""
    n = BUCKETS // rows * rows
    x = X.mix(r[:n].astype(_U) * _BAND_KEYS[:n] + _BAND_KEYS[:n]).reshape(-1, rows)
    return X.mix(x.sum(1, dtype=_U) + _BAND_KEYS[:n:rows])


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected number of equal registers of two disjoint sets of sizes n and m:
    the minima of a bucket are nearly exponential with rates n and m a bucket;
    registers are equal when both fall into the same of the 2^MANTISSA equal
    pieces of an octave."""
    a, b = (np.asarray(v, float)[..., None] / BUCKETS for v in (n, m))
    mass = np.exp(-(a + b) * _OCTAVE) - np.exp(-(a + b) * 2 * _OCTAVE)
    return BUCKETS * (a * b / (a + b) * mass * _OCTAVE / (1 << MANTISSA)).sum(-1)


def estimate(same: np.ndarray, used: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard similarity of sets of sizes n and m that agree
    in ``same`` of the ``used`` buckets which either fills: chance makes equal its
    share of what would differ."""
    c = np.minimum(chance(n, m) / BUCKETS, 0.5)
    return (same / used - c) / (1 - c)


def least_equal(used: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest estimate, ``SLACK`` standard errors under the threshold, that a
    linked pair of sets of sizes n and m may show on ``used`` buckets: a sample
    without replacement of the union, whose size is (n + m) / (1 + J)."""
    t = percent / 100
    union = (n + m) / (1 + t)
    seen = np.clip((union - used) / np.maximum(union - 1, 1), 0, 1)
    return t - SLACK * np.sqrt(t * (1 - t) / used * seen) - 1.0 / used - 1e-9


def occupied(r: np.ndarray) -> np.ndarray:
    """Bits of the full buckets of register rows."""
    return np.packbits(r > 0, axis=-1).view(np.uint64)


def likely(one, many, n: int, m: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of register rows ``many`` those that may link with ``one`` (each a pair of
    registers and occupied bits; sizes n and m), and their estimates."""
    (r, full), (rs, fulls) = one, many
    used = np.bitwise_count(fulls | full).sum(1, dtype=np.int64)
    same = (rs == r).sum(1) - (BUCKETS - used)  # less the buckets that both leave empty
    least = least_equal(used, n, m, percent)
    ok = np.flatnonzero((same >= least * used) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
    j = estimate(same[ok], used[ok], np.full(len(ok), n), m[ok])  # the correction only lowers
    fit = j >= least[ok]
    return ok[fit], j[fit]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted shingle sets link."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two independent sums of mixed elements, the size mixed in."""
    a = X.mix(s + X.GRAM[41]).sum(dtype=_U)
    b = X.mix(s ^ X.GRAM[42]).sum(dtype=_U)
    size = _U(len(s))
    return tuple(X.mix(np.array([a, b], _U) * X.GRAM[43:45] + size).astype(np.int64).tolist())


def _sets(texts: list[bytes], words: int):
    for block in X.blocks(texts, lower=True):
        for row, h in block.docs():
            yield row, X.shingle_set(h, words)


def _describe(words: int, percent: int):
    rows = band_rows(percent)

    def run(batches):
        for batch in X.small(batches):
            n, fa, fb, bands = [], [], [], []
            for _, s in _sets(X.text_bytes(batch.column("text")), words):
                n.append(len(s))
                a, b = _fingerprint(s) if len(s) else (None, None)
                fa.append(a)
                fb.append(b)
                bands.append(band_keys(densified(registers(s)), rows).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fa, pa.int64()), pa.array(fb, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "fa", "fb", "bands"])
    return run


def _sketch(words: int):
    """Texts -> registers and sorted shingle set."""
    def run(batches):
        for batch in X.small(batches, 128):
            n, regs, sets = [], [], []
            for _, s in _sets(X.text_bytes(batch.column("text")), words):
                n.append(len(s))
                regs.append(registers(s).tobytes() if len(s) else b"")
                sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(n, pa.int64()), pa.array(regs, pa.binary()), pa.array(sets, pa.binary())],
                names=["node", "n_shingles", "registers", "shingles"])
    return run


def _rows(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), BUCKETS)


def _verify(percent: int):
    """Pairs with registers and sets -> links, by estimate, then by sets."""
    def run(batches):
        for batch in X.small(batches, 128):
            keep = []
            c = {k: batch.column(k).to_pylist() for k in ("ru", "rv", "su", "sv")}
            for ru, rv, su, sv in zip(*c.values()):
                a, b = np.frombuffer(su, _U), np.frombuffer(sv, _U)
                x, y = _rows([ru]), _rows([rv])
                ok, _ = likely((x[0], occupied(x)[0]), (y, occupied(y)), len(a), np.array([len(b)]), percent)
                keep.append(bool(len(ok)) and linked(a, b, percent))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _join_block(t: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Links that join the components within a block, or between two blocks, of one
    bucket: every pair of different components that may link is verified, the
    likeliest first, unless links found here have joined its components."""
    node, comp, n, side = (t.column(c).to_numpy() for c in ("node", "comp", "n_shingles", "side"))
    r = _rows(t.column("registers").to_pylist())
    full = occupied(r)
    within = side.min() == side.max()
    found = []
    for i in range(len(node)):
        j = np.flatnonzero((comp != comp[i]) & ((node > node[i]) if within else (side > side[i])))
        if len(j):
            ok, est = likely((r[i], full[i]), (r[j], full[j]), int(n[i]), n[j], percent)
            found.append((np.full(len(ok), i), j[ok], est))
    us, vs = [], []
    if not found:
        return us, vs
    i, j, est = (np.concatenate(x) for x in zip(*found))
    by = np.argsort(-est, kind="stable")
    sets = t.column("shingles")
    held: dict[int, np.ndarray] = {}
    root = {c: c for c in np.unique(comp).tolist()}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    for a, b in zip(i[by].tolist(), j[by].tolist()):
        x, y = top(int(comp[a])), top(int(comp[b]))
        if x == y:
            continue
        for k in (a, b):
            if k not in held:
                held[k] = np.frombuffer(sets[k].as_py(), _U)
        if linked(held[a], held[b], percent):
            root[max(x, y)] = min(x, y)
            us.append(min(int(node[a]), int(node[b])))
            vs.append(max(int(node[a]), int(node[b])))
    return us, vs


def _search(percent: int):
    """Rows sorted by (key, lo, hi), one run per block pair of a bucket, to links. A
    run has at most about two blocks and no more than one is held between batches."""
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
            key = np.stack([t.column(c).to_numpy() for c in ("key", "lo", "hi")], 1)
            begin = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)].tolist()
            if batch is not None:
                rest = t.slice(begin[-2])
                begin.pop()
            for i, j in zip(begin[:-1], begin[1:]):
                u, v = _join_block(t.slice(i, j - i), percent)
                if u:
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                                     names=["u", "v"])
        pa.default_memory_pool().release_unused()
    return run


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id long, text string; other
    columns, whatever their names, are ignored).

    Returns one row per input row: doc_id, n_shingles (distinct shingles of the
    lower-cased text), component_id (smallest doc_id reachable by links, its own
    without links) and kept (doc_id = component_id). Null, empty and blank texts
    have no shingles and are linked with nothing. Rows with a null doc_id are left
    out. Ids are meant to be unique; a row of a repeated id gets the class of its
    own text. Nothing depends on the order of rows; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    base = persist_cut(docs.mapInArrow(_describe(words, percent),
                                       "doc_id long, n_shingles long, fa long, fb long, bands array<long>"),
                       spark, "hmh-base")
    first = base.where("fa IS NOT NULL").groupBy("fa", "fb").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = persist_cut(first.select("fa", "fb", "node"), spark, "hmh-copied")  # sets of several rows
    copies = persist_cut(base.select("doc_id", "fa", "fb").join(first, ["fa", "fb"]).where("doc_id <> node")
                         .drop("node").distinct(), spark, "hmh-copies")
    nodes = base.where("fa IS NOT NULL").join(F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies,
                                              ["doc_id", "fa", "fb"], "left_anti")
    keys = persist_cut(nodes.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key")), spark, "hmh-keys")

    low = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("other")).where("pivot < other")
    met = persist_cut(keys.join(low.select("key", "pivot"), "key").select("key", "node", "pivot"), spark, "hmh-met")
    meet = persist_cut(met.select(F.col("node").alias("doc_id")).distinct(), spark, "hmh-meet")
    few = meet.count() <= BROADCAST_IDS
    sets = persist_cut(docs.join(F.broadcast(meet) if few else meet, "doc_id", "left_semi")
                       .select(F.col("doc_id").alias("node"), "text")
                       .mapInArrow(_sketch(words), "node long, n_shingles long, registers binary, shingles binary"),
                       spark, "hmh-sets")

    # First round: the two smallest nodes of buckets that a node meets most often.
    often = met.where("node <> pivot").groupBy("node", "pivot").count().withColumn("rank", F.row_number().over(
        Window.partitionBy("node").orderBy(F.desc("count"), "pivot"))).where("rank <= 2")
    left, right = (sets.select(F.col("node").alias(k), F.col("node").alias(u), F.col("registers").alias("r" + u),
                               F.col("shingles").alias("s" + u)) for k, u in (("node", "u"), ("pivot", "v")))
    links = persist_cut(often.join(left, "node").join(right, "pivot").select("u", "v", "ru", "rv", "su", "sv")
                        .mapInArrow(_verify(percent), "u long, v long").distinct(), spark, "hmh-links")
    found = persist_cut(components(links), spark, "hmh-components")

    # Second round: complete search of buckets that hold several components.
    known = sets.select("node", "n_shingles").join(found, "node", "left").select(
        "node", "n_shingles", F.coalesce("component", "node").alias("comp"))
    rows = persist_cut(met.select("key", "node").join(known, "node"), spark, "hmh-rows")
    mixed = rows.groupBy("key").agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("n"),
        F.sum("n_shingles").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("y")).where("least < most")
    # Buckets of the same members are searched once.
    mixed = persist_cut(mixed.groupBy("x", "y", "n", "size").agg(F.min("key").alias("key")).select(
        "key", F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
        .alias("n_blocks")), spark, "hmh-mixed")
    todo = (rows.join(mixed, "key").join(sets.drop("n_shingles"), "node")
            .withColumn("side", F.pmod(F.xxhash64("node"), "n_blocks").cast("int"))
            .withColumn("beside", F.explode(F.expr("sequence(0, n_blocks - 1)")))
            .select("key", F.least("side", "beside").cast("long").alias("lo"),
                    F.greatest("side", "beside").cast("long").alias("hi"),
                    "node", "comp", "n_shingles", "side", "registers", "shingles"))
    late = persist_cut(todo.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
                       .mapInArrow(_search(percent), "u long, v long").distinct(), spark, "hmh-links")
    comp = persist_cut(components(links.unionByName(late)), spark, "hmh-components")
    back = base.select("doc_id", "n_shingles", "fa", "fb").join(first, ["fa", "fb"], "left").withColumn(
        "node", F.coalesce("node", "doc_id"))
    out = back.join(comp, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
