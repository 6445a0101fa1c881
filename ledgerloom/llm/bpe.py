"""Byte-level BPE encoding and decoding over length-bucketed, padded numpy matrices.

A text is cut into pieces by the tokenizer's pattern; a piece that is itself in the vocabulary is one id. The other
pieces of a batch, each once, are bucketed by length and laid out as padded matrices of ids. In every round each row
merges its leftmost pair of minimum rank (pairs are found in an open-addressing hash table) and the matrix is compacted
by one column; rows without a pair to merge leave. A piece longer than LONG bytes would make the rounds quadratic; it
goes through a heap that applies the same order of merges.

Null and empty texts give no ids and the hash of the empty string. Ids decode to the text's UTF-8 bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import columns, prepare

NONE = np.int32(2**31 - 1)
LONG = 2048  # bytes of a piece beyond which the heap is used
CELLS = 1 << 20  # cells of a matrix at most
KNOWN = 600_000  # pieces whose ids a worker remembers
#: A pattern under which a piece always begins at a space before a non-space and never looks behind it (fixed value):
#: a text without other spaces may be cut there, and what lies between two cuts is looked up as a whole.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_codecs: dict[tuple[str, str], Codec] = {}


class Codec:
    """Encoder and decoder for a rank file (base64 token and rank on each line)."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.odd = regex.compile(r" (?:\s|$)").search if pattern == SPACED else None
        self.first = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.known: dict[str, tuple[int, ...]] = {}
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self._hash(np.array(pairs, dtype=np.int64).reshape(-1, 3))

    def _hash(self, pairs: np.ndarray) -> None:
        """Fill the hash table of pairs; slots are tried one after the other."""
        size = 1 << max(4, int(len(pairs) * 4).bit_length())
        self.mask, self.keys, self.values = size - 1, np.full(size, -1, dtype=np.int64), np.full(size, NONE, dtype=np.int32)
        key, left, step = pairs[:, 0] << 32 | pairs[:, 1], np.arange(len(pairs)), 0
        while len(left):
            slot = (self._slot(key[left]) + step) & self.mask
            free = self.keys[slot] == -1
            at, one = np.unique(slot[free], return_index=True)
            winners = left[free][one]
            self.keys[at], self.values[at] = key[winners], pairs[winners, 2]
            left, step = np.setdiff1d(left, winners, assume_unique=True), step + 1
        self.probes = step

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) & self.mask

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, NONE where it isn't one or an id is padding."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        out, left, slot = np.full(len(key), NONE, dtype=np.int32), np.flatnonzero((a >= 0) & (b >= 0)), self._slot(key)
        for step in range(self.probes + 1):
            at = (slot[left] + step) & self.mask
            got = self.keys[at]
            hit = got == key[left]
            out[left[hit]] = self.values[at[hit]]
            left = left[~hit & (got != -1)]
            if not len(left):
                break
        return out

    def _matrix(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(pieces)
        width = max(map(len, pieces))
        ids = np.full((len(pieces), width), -1, dtype=np.int32)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ids[np.arange(width) < sizes[:, None]] = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rows = np.arange(len(pieces))
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            if done.any():
                over = ids[done]
                for i, row, n in zip(rows[done].tolist(), over.tolist(), (over >= 0).sum(axis=1).tolist(), strict=True):
                    out[i] = tuple(row[:n])
                go = ~done
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                if not len(rows):
                    break
            n, w = ids.shape
            one = np.arange(n)
            ids[one, at] = best
            stay = np.ones((n, w), dtype=bool)
            stay[one, at + 1] = False
            ids = ids[stay].reshape(n, w - 1)
            gone = np.ones((n, w - 1), dtype=bool)
            gone[one, at] = False
            ranks = ranks[gone].reshape(n, w - 2)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < w - 2)
            ranks[before, at[before] - 1] = self.rank(ids[before, at[before] - 1], ids[before, at[before]])
            ranks[after, at[after]] = self.rank(ids[after, at[after]], ids[after, at[after] + 1])
        return out

    def _heap(self, piece: bytes) -> tuple[int, ...]:
        ids = self.first[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        nxt, prev = [*range(1, n), -1], [*range(-1, n - 1)]
        table, byte = self.ranks, self.bytes_of

        def rank(i: int) -> int | None:
            return table.get(byte[ids[i]] + byte[ids[nxt[i]]]) if nxt[i] >= 0 else None

        heap = [(int(r), i) for i, r in enumerate(self.rank(np.array(ids[:-1], dtype=np.int32), np.array(ids[1:], dtype=np.int32))) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            j = nxt[i]
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and (new := rank(k)) is not None:
                    heapq.heappush(heap, (new, k))
        return tuple(x for x in ids if x >= 0)

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece (not empty), in order."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (r := self.ranks.get(p)) is not None:
                out[i] = (r,)
            elif len(p) > LONG:
                out[i] = self._heap(p)
            else:
                n = len(p)
                buckets.setdefault(n if n <= 24 else 1 << (n - 1).bit_length(), []).append(i)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                part = members[k : k + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _cut(self, text: str | None) -> list[str]:
        """Parts of the text whose pieces don't depend on each other; all but the first stand for a space and the part."""
        if not text:
            return []
        return text.split(" ") if self.odd and not self.odd(text) else [text]

    def encode_batch(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text."""
        group: list[tuple[str, list[str]]] = []
        held = 0
        for i, text in enumerate(texts):
            head, *rest = self._cut(text) or [""]
            group.append((head, rest))
            held += len(rest) + len(head) // 8
            if held > 500_000 or i == len(texts) - 1:
                yield from self._encode_group(group)
                group, held = [], 0

    def _encode_group(self, group: list[tuple[str, list[str]]]) -> Iterator[list[int]]:
        known, parts = self.known, set(chain.from_iterable(rest for _, rest in group))
        fresh = list(parts.difference(known))
        if len(known) + len(fresh) > KNOWN:
            known.clear()
            fresh = list(parts)
        cut = [*(self.find(f" {p}") for p in fresh), *(self.find(head) for head, _ in group)]
        pieces = list(set(chain.from_iterable(cut)))
        ids = dict(zip(pieces, self.encode_pieces([p.encode() for p in pieces]), strict=True))
        whole = [tuple(chain.from_iterable(map(ids.__getitem__, x))) for x in cut]
        known.update(zip(fresh, whole, strict=False))
        for (_, rest), first in zip(group, whole[len(fresh) :], strict=True):
            yield [*first, *chain.from_iterable(map(known.__getitem__, rest))]
        for p in fresh:
            if len(p) > 64:
                del known[p]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns named in keep, and each text's ids (array<int>)."""
    return _run(docs, path, pattern, keep, text, [("ids", "array<int>", pa.list_(pa.int32()), lambda c, ids: ids)])


def digest(docs: DataFrame, path: str, pattern: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes decoded from the ids), and the ids if asked for."""
    ids = [("ids", "array<int>", pa.list_(pa.int32()), lambda c, ids: ids)] if with_ids else []
    return _run(docs, path, pattern, ("doc_id",), text, [
        ("n_tokens", "long", pa.int64(), lambda c, ids: len(ids)),
        ("ids_sha256", "string", pa.string(), lambda c, ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()),
        ("decoded_sha256", "string", pa.string(), lambda c, ids: hashlib.sha256(c.decode(ids)).hexdigest()),
        *ids,
    ])


def _run(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...], text: str, out: list[tuple]) -> DataFrame:
    prepare(docs.sparkSession)
    source = docs.select(*keep, docs[text].alias("__text"))
    names = [*keep, *(x[0] for x in out)]

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in it:
            (texts,) = columns(batch, "__text")
            rows: list[list] = [[] for _ in out]
            for ids in c.encode_batch(texts):
                for col, x in zip(rows, out, strict=True):
                    col.append(x[3](c, ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(col, type=x[2]) for col, x in zip(rows, out, strict=True))], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), *(f"{x[0]} {x[1]}" for x in out)])
    return source.mapInArrow(each, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


