"""Byte-level BPE in numpy: padded matrices of token ids, one row for each distinct piece of a length bucket.

A text is split by the pattern; distinct pieces that the worker has not met yet are encoded together. Each round every
row merges its leftmost pair of least rank; ranks of pairs come from an open-addressing hash table, the columns right
of a merge move left, and finished rows leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from gossamr.llm.common import append, field, public_pattern

#: Rank of a pair that does not merge.
NONE = np.int32(2**31 - 1)
#: Bytes from which a piece is merged with a queue instead of a matrix row, as a row costs its length squared.
LONG = 8192
#: Matrix widths: a piece goes to the first that holds it.
WIDTHS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256, 512, 1024, 2048, 4096, LONG)
#: Pieces that a worker's cache holds before it is emptied; a piece and its ids are some 150 bytes.
CACHE = 400_000
#: Rows of a matrix times its width, at most.
CELLS = 1 << 20


def unicode_spaces(pattern: str) -> str:
    """The pattern with white space as the Unicode property; this library's own class has four control characters more."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class PairTable:
    """(left id, right id) -> rank of the merged token, by linear probing in arrays."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (3 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys, ranks = np.fromiter(pairs.keys(), np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self.keys[slots[put]], self.ranks[slots[put]] = keys[put], ranks[put]
            keys, ranks, slots = keys[~put], ranks[~put], slots[~put]
            slots = np.where(self.keys[slots] >= 0, (slots + 1) & (len(self.keys) - 1), slots)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        left = np.nonzero((found != keys) & (found >= 0))[0]
        while len(left):
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[left]]
            hit = found == keys[left]
            out[left[hit]] = self.ranks[slots[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class ByteBPE:
    """Encoder and decoder for a file of ranks (base64 token and rank a line). pattern: splits texts before the merges."""

    def __init__(self, path: str, pattern: str | None = None):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.vocab = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.vocab[rank] = token
        self.size = len(self.vocab)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pair_dict = pairs
        self.pairs = PairTable(pairs)
        self.pattern = regex.compile(unicode_spaces(pattern or public_pattern()))
        self.cache: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = self._queued(piece)
            elif piece:
                buckets.setdefault(next(w for w in WIDTHS if w >= len(piece)), []).append(i)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens = np.full((len(pieces), width), -1, np.int32)
        tokens[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self._lookup(tokens[:, :-1], tokens[:, 1:])
        rows, out = np.arange(len(pieces)), [b""] * len(pieces)
        while True:
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            least = ranks[np.arange(len(rows)), best] if ranks.shape[1] else np.full(len(rows), NONE)
            done = least == NONE
            if done.any():
                for row, ids in zip(rows[done], tokens[done], strict=True):
                    out[row] = ids[ids >= 0].astype("<u4").tobytes()
                keep = ~done
                rows, tokens, ranks, best, least = rows[keep], tokens[keep], ranks[keep], best[keep], least[keep]
                if not len(rows):
                    return out
            n = np.arange(len(rows))
            tokens[n, best] = least
            columns = np.arange(tokens.shape[1] - 1)
            tokens = np.take_along_axis(tokens, columns + (columns > best[:, None]), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns > best[:, None]), 1) if len(columns) else np.empty((len(rows), 0), np.int32)
            for at, some in ((best, best < tokens.shape[1] - 1), (best - 1, best > 0)):
                r, c = n[some], at[some]
                ranks[r, c] = self._lookup(tokens[r, c], tokens[r, c + 1])

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2)
        out = np.full(keys.shape, NONE, np.int32)
        some = keys >= 0
        out[some] = self.pairs(keys[some])
        return out

    def _queued(self, piece: bytes) -> bytes:
        """The same merges by a queue of (rank, place), for very long pieces."""
        ids = [int(self.byte_ids[b]) for b in piece]
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        rank_of = lambda i: self.pair_dict.get(ids[i] * self.size + ids[after[i]]) if after[i] < n else None
        queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of(i)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            if not alive[i] or after[i] >= n or ids[i] != a or ids[after[i]] != b:
                continue
            j = after[i]
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank_of(k)) is not None:
                    heapq.heappush(queue, (r, k, ids[k], ids[after[k]]))
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], "<u4").tobytes()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) if t else [] for t in texts]
        cache = self.cache
        missing = [w for w in set().union(*split) if w not in cache]
        if len(cache) + len(missing) > CACHE:
            cache.clear()
            missing = list(set().union(*split))
        cache.update(zip(missing, self.encode_pieces([w.encode("utf-8", "surrogatepass") for w in missing]), strict=True))
        return [b"".join(map(cache.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, ByteBPE] = {}


def loaded(path: str) -> ByteBPE:
    """The encoder for a file, one for each worker process."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def _pass(path: str, result: Callable[[ByteBPE, bytes], tuple], width: int) -> Callable:
    def start():
        bpe = loaded(path)

        def work(texts):
            rows = [result(bpe, ids) for ids in bpe.encode_batch(texts)]
            return tuple(map(list, zip(*rows, strict=True))) if rows else tuple([] for _ in range(width))

        return work

    return start


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs (text and any other columns) with ids (binary: little-endian unsigned 32-bit) and n_tokens appended.

    Null and empty texts have no ids. Columns named ids or n_tokens are replaced.
    """
    return append(docs, ["text"], [field("ids", "binary"), field("n_tokens", "long")], _pass(path, lambda bpe, ids: (ids, len(ids) // 4), 2))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (ids and any other columns) with decoded (binary) appended; null ids give null."""

    def start():
        bpe = loaded(path)
        return lambda many: ([None if ids is None else bpe.decode(ids) for ids in many],)

    return append(encoded, ["ids"], [field("decoded", "binary")], start)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; the digests are taken where the ids are made."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    digests = lambda bpe, ids: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest())
    fields = [field("n_tokens", "long"), field("ids_sha256", "string"), field("decoded_sha256", "string")]
    return append(docs, ["text"], fields, _pass(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), digests, 3)).drop("text")
