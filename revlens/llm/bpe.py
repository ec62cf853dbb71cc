"""Byte-level BPE with a two-tier lookup.

Tier one resolves whole pre-tokens that are in the vocabulary through a minimal
perfect hash (hash and displace): one hash, one displacement, one comparison.
Tier two merges the rest: the pre-token's bytes form a linked list, and the pair
of lowest rank, leftmost first, is merged until no pair is in the vocabulary. A
heap gives that pair in long pre-tokens and in lengths of which few are new;
short ones of equal length stand side by side as columns of arrays, which make
each step together. Ranks, pattern and results are those of the public rank files.

The vocabulary is read once on the driver (its size does not depend on the
data) and broadcast. Texts are independent: nothing is shuffled.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from revlens.llm import textops as X

#: Pre-tokens, and their characters, remembered by a task before it turns to a
#: new memory; the last one stays at hand. Only time depends on them.
REMEMBERED = 100_000
REMEMBERED_CHARS = 4_000_000
#: Text bytes after which a task hands on a batch.
BATCH_BYTES = 1 << 20
#: Pre-tokens up to this many bytes are merged as columns, where at least ``FEW``
#: of a length are new, ``COLUMNS`` at a time. Only time and memory depend on them.
SHORT, FEW, COLUMNS = 32, 16, 1 << 12
#: Displacements tried for a group of keys before the table takes another seed,
#: and seeds tried.
MOST_SHIFT, MOST_SEEDS = 1 << 16, 1000
_MASK = (1 << 64) - 1
_NEVER = (1 << 63) - 1


class PerfectHash:
    """Minimal perfect hash over distinct byte strings: n keys fill n slots."""

    def __init__(self, keys: list[bytes]):
        if len(set(keys)) < len(keys):
            raise ValueError("keys must be distinct")
        self.n = max(1, len(keys))
        self.groups = self.n // 3 + 1
        for self.seed in range(MOST_SEEDS):
            if self._place(keys):
                return
        raise ValueError("no seed places every key")  # needs keys of equal hash

    def _place(self, keys: list[bytes]) -> bool:
        """Fill the table under the present seed: the largest groups first, by
        displacement; groups of one key take the slots left over."""
        groups: list[list[int]] = [[] for _ in range(self.groups)]
        hashes = [xxhash.xxh3_64_intdigest(k, self.seed) for k in keys]
        for i, h in enumerate(hashes):
            groups[h % self.groups].append(i)
        self.shift = [0] * self.groups
        self.key: list[bytes | None] = [None] * self.n
        self.value = [0] * self.n
        for g in sorted(range(self.groups), key=lambda g: -len(groups[g])):
            if len(groups[g]) < 2:
                break
            for d in range(MOST_SHIFT):
                at = {self._slot(hashes[i], d) for i in groups[g]}
                if len(at) == len(groups[g]) and all(self.key[s] is None for s in at):
                    break
            else:
                return False
            self.shift[g] = d
            for i in groups[g]:
                s = self._slot(hashes[i], d)
                self.key[s], self.value[s] = keys[i], i
        free = iter([s for s in range(self.n) if self.key[s] is None])
        for g, members in enumerate(groups):
            if len(members) == 1:  # any free slot will do: a negative shift names it
                s = next(free)
                self.shift[g] = -1 - s
                self.key[s], self.value[s] = keys[members[0]], members[0]
        return True

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ d * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & _MASK
        x = (x ^ x >> 31) * 0x94D049BB133111EB & _MASK
        return (x >> 32) * self.n >> 32

    def get(self, key: bytes) -> int:
        """Index of the key in the list it was built from, -1 for others."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        d = self.shift[h % self.groups]
        s = -1 - d if d < 0 else self._slot(h, d)
        return self.value[s] if self.key[s] == key else -1


class Vocabulary:
    """Tokens by rank, which are their ids, and the pattern of pre-tokens."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.hash = PerfectHash(tokens)
        self.byte = [self.hash.get(bytes([b])) for b in range(256)]
        if min(self.byte) < 0:
            raise ValueError("a byte-level vocabulary holds every single byte")
        self.numbers = list(range(len(tokens)))  # one object for each id, however often it is remembered
        self.pairs = self._pairs()
        #: The same pairs in ascending order, closed by one that no ids make.
        self.pair_keys = np.sort(np.array([*self.pairs, _NEVER], np.int64))
        self.pair_ids = np.array([self.pairs.get(k, -1) for k in self.pair_keys.tolist()], np.int64)

    def _pairs(self) -> dict[int, int]:
        """(left id << 32 | right id) -> id of every pair that merges: each way
        of cutting a token into two tokens. What is not here never merges, so
        encoding needs no table that grows with the texts."""
        ids = {t: i for i, t in enumerate(self.tokens)}
        return {ids[t[:k]] << 32 | ids[t[k:]]: i for i, t in enumerate(self.tokens)
                for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids}

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of what each pair of ids merges to, -1 for pairs that never merge
        and where an id is -1."""
        pair = left << 32 | right
        at = np.searchsorted(self.pair_keys, pair)
        return np.where(self.pair_keys[at] == pair, self.pair_ids[at], -1)

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """A rank file: base64 token, blank, rank; ranks count from 0."""
        with open(path, "rb") as f:
            ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
        return cls([ranks[i] for i in range(len(ranks))], pattern)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.split = regex.compile(vocabulary.pattern).findall
        #: Ids of remembered pre-tokens: this generation and the one before.
        self.memory: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.chars = 0

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one pre-token outside the vocabulary. Heap entries are rank and
        position in one integer; ``rank`` tells which of them still hold."""
        pair, own = self.v.pairs.get, self.v.numbers
        ids = list(map(self.v.byte.__getitem__, word))
        n = len(ids)
        shift = max(10, n.bit_length())  # small entries compare fastest
        mask = (1 << shift) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, heap = [-1] * n, []
        a = ids[0]
        for i in range(n - 1):
            b = ids[i + 1]
            r = pair(a << 32 | b)
            if r is not None:
                rank[i] = r
                heap.append(r << shift | i)
            a = b
        heapify(heap)
        while heap:
            top = heappop(heap)
            r, i = top >> shift, top & mask
            if rank[i] != r:
                continue  # merged or changed since
            j = after[i]
            ids[i], ids[j], rank[j] = own[r], -1, -1
            k = after[i] = after[j]
            rank[i] = -1
            if k < n:
                before[k] = i
                s = pair(r << 32 | ids[k])
                if s is not None:
                    rank[i] = s
                    heappush(heap, s << shift | i)
            p = before[i]
            if p >= 0:
                s = pair(ids[p] << 32 | r)
                if s is not None:
                    rank[p] = s
                    heappush(heap, s << shift | p)
                else:
                    rank[p] = -1
        return tuple([x for x in ids if x >= 0])

    def merge_columns(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """``merge`` of many pre-tokens of one length, a column each. Row ``i``
        belongs to the token that begins at byte ``i``; the last row, which is
        also the one before the first, stands for no token."""
        merged, length, columns = self.v.merged, len(words[0]), len(words)
        shift = length.bit_length()
        ids = np.full((length + 1, columns), -1, np.int64)
        ids[:-1] = np.array(self.v.byte)[np.frombuffer(b"".join(words), np.uint8).reshape(columns, length).T]
        row = np.arange(length + 1)[:, None]
        after, before = np.repeat(row + 1, columns, 1), np.repeat(row - 1, columns, 1)

        def entry(rank, i):
            return np.where(rank >= 0, rank << shift | i, _NEVER)

        entries = np.full((length + 1, columns), _NEVER)
        entries[:-2] = entry(merged(ids[:-2], ids[1:-1]), row[:-2])
        while True:
            top = entries.min(axis=0)
            c = np.flatnonzero(top != _NEVER)
            if not len(c):
                break
            top = top[c]
            r, i = top >> shift, top & (1 << shift) - 1
            j, p = after[i, c], before[i, c]
            k = after[j, c]
            ids[i, c], ids[j, c], entries[j, c] = r, -1, _NEVER
            after[i, c], before[k, c] = k, i
            entries[i, c] = entry(merged(r, ids[k, c]), i)
            entries[p, c] = entry(merged(ids[p, c], r), p)
        ids = ids.T
        flat = list(map(self.v.numbers.__getitem__, ids[ids >= 0].tolist()))
        end = np.cumsum((ids >= 0).sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *end], end)]

    def merge_all(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """``merge`` of every pre-token."""
        out, lengths = [()] * len(words), defaultdict(list)
        for i, w in enumerate(words):
            lengths[len(w)].append(i)
        for length, members in lengths.items():
            if length > SHORT or len(members) < FEW:
                for i in members:
                    out[i] = self.merge(words[i])
                continue
            for a in range(0, len(members), COLUMNS):
                block = members[a:a + COLUMNS]
                for i, ids in zip(block, self.merge_columns([words[i] for i in block])):
                    out[i] = ids
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; their new pre-tokens are merged together."""
        split = [self.split(t) for t in texts]
        if len(self.memory) >= REMEMBERED or self.chars >= REMEMBERED_CHARS:
            # the words in use come back from the older one
            self.memory, self.older, self.chars = {}, self.memory, 0
        memory, older, find, tokens = self.memory, self.older.get, self.v.hash.get, self.v.numbers
        rest = []
        for w in set(chain.from_iterable(split)).difference(memory):
            ids = older(w)
            if ids is None:
                i = find(w.encode())
                if i < 0:
                    rest.append(w)
                    continue
                ids = (tokens[i],)
            memory[w] = ids
            self.chars += len(w)
        memory.update(zip(rest, self.merge_all([w.encode() for w in rest])))
        self.chars += sum(map(len, rest))
        return [list(chain.from_iterable(map(memory.__getitem__, words))) for words in split]


class Decoder:
    """Bytes of token ids by one gather over the concatenated vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        return self.flat[np.repeat(self.begin[ids] - (end - size), size) + np.arange(total)].tobytes()


def _encoded(batches, encoder):
    """(doc_id column, ids of each text) of runs of rows of some ``BATCH_BYTES``."""
    for batch in X.small(batches):
        texts = batch.column("text")
        size = np.cumsum(np.r_[0, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)])
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(size, size[first] + BATCH_BYTES, "right")) - 1)
            ids = encoder.encode_all([t or "" for t in texts.slice(first, last - first).to_pylist()])
            yield batch.column("doc_id").slice(first, last - first), ids
            first = last


def _encode(shared):
    def run(batches):
        for doc_id, ids in _encoded(batches, Encoder(shared.value)):  # its memory goes with the task
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return run


def _digest(shared):
    def run(batches):
        decoder = Decoder(shared.value)
        names = [str(i).encode() for i in range(len(shared.value.tokens))]
        for doc_id, ids in _encoded(batches, Encoder(shared.value)):
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([sha256(b",".join(map(names.__getitem__, x))).hexdigest() for x in ids], pa.string()),
                 pa.array([sha256(decoder.decode(np.array(x, np.int32))).hexdigest() for x in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def lists(col) -> list[np.ndarray]:
    """Views of an Arrow list column's int arrays; a null list is empty."""
    flat, at = col.values.to_numpy(), col.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _decode(shared):
    def run(batches):
        decoder = Decoder(shared.value)
        for batch in X.small(batches):
            names = [c for c in batch.schema.names if c not in ("ids", "bytes")]
            text = pa.array([decoder.decode(x) for x in lists(batch.column("ids"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [text], names=names + ["bytes"])
    return run


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and ids (array of int) of every row of ``docs`` (doc_id, text;
    other columns are ignored). Null and empty texts give no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(_encode(shared), "doc_id long, ids array<int>")


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the bytes that the ids decode to) of every row of ``docs``
    (doc_id, text; other columns are ignored): encoded and decoded in one pass,
    so ids do not leave the task. Null and empty texts have no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(
        _digest(shared), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with its ids (array of int) replaced by their bytes (column
    ``bytes``; one of the input of that name is replaced). Null ids give empty
    bytes. Ids from elsewhere need not make whole characters, so the result is
    binary."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    kept = T.StructType([f for f in encoded.schema.fields if f.name not in ("ids", "bytes")])
    return encoded.select(*kept.names, "ids").mapInArrow(_decode(shared), kept.add("bytes", "binary"))
