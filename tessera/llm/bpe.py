"""Byte-level BPE encoding and decoding in padded numpy matrices.

A text is cut into pieces by the tokenizer's pattern.  Pieces not seen before
are encoded together: rows of byte ids, bucketed by length and padded, in
which every row merges its leftmost pair of least rank in each round.  Ranks
of pairs come from a hash table held in arrays; finished rows are compacted
away.  Pieces above ``LONG`` bytes, for which whole-row rounds would cost the
square of the length, merge the same pairs in the same order from a heap.
Decoding gathers token bytes through one index array.

Encoding and decoding are map-only; the ranks (a vocabulary file, about a
megabyte) are the only thing sent to the tasks.

Defined results: null and empty texts have no ids and decode to no bytes;
repeated rows are encoded alike; an empty table gives an empty result; a
null list of ids decodes to no bytes.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from . import textbatch as tb
from .shipping import ship

#: Pieces of more bytes are merged from a heap.
LONG = 96
#: Distinct chunks whose ids a worker remembers before it starts afresh.
REMEMBERED = 600_000
_NONE = np.int32(2**31 - 1)
_WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64, LONG)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [t for _, t in pairs]


class PairTable:
    """Open-addressing hash table from a pair of token ids to the merged id,
    looked up for whole arrays at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(left), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        todo, value = left.astype(np.int64) << 32 | right, merged.astype(np.int32)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = todo[free]
            placed = self.keys[slot] == todo
            self.values[slot[placed]] = value[placed]
            todo, value = todo[~placed], value[~placed]
            slot = (slot[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids; a very large number where the pair doesn't merge (also for padding, -1)."""
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(key), _NONE, np.int32)
        open_ = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(key[open_])
        while len(open_):
            held = self.keys[slot]
            same = held == key[open_]
            out[open_[same]] = self.values[slot[same]]
            on = ~same & (held >= 0)
            open_, slot = open_[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out.reshape(left.shape)


class Codec:
    """Encoder and decoder of one vocabulary.  Token ids are ranks."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.byte_id = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_id < 0).any():
            raise ValueError("every byte must be a token")
        left, right, merged = [], [], []
        for i, t in enumerate(tokens):
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int64))
        size = np.array([len(t) for t in tokens], np.int64)
        self.token_size, self.token_at = size, np.cumsum(size) - size
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.piece_ids: dict[str, bytes] = {}
        self.chunk_ids: dict[str, bytes] = {}

    # -- pieces -----------------------------------------------------------
    def _merge_rows(self, rows: np.ndarray) -> list[bytes]:
        """Ids of each padded row (-1 after its end) as little-endian bytes."""
        out: list[bytes] = [b""] * len(rows)
        alive = np.arange(len(rows))
        rank = self.pairs.find(rows[:, :-1], rows[:, 1:])
        while len(alive):
            at = rank.argmin(1)
            least = rank[np.arange(len(rank)), at]
            done = least == _NONE
            if done.any():
                ended = rows[done]
                ids = ended[ended >= 0].astype("<u4").tobytes()
                ends = np.cumsum((ended >= 0).sum(1)) * 4
                start = 0
                for i, end in zip(alive[done].tolist(), ends.tolist(), strict=True):
                    out[i], start = ids[start:end], end
                alive, rows, rank, at, least = (x[~done] for x in (alive, rows, rank, at, least))
                if not len(alive):
                    break
            n, width = rows.shape
            every = np.arange(n)
            rows[every, at] = least
            column = np.arange(width - 1)
            source = column[None, :] + (column[None, :] > at[:, None])
            rows = np.take_along_axis(rows, source, 1)
            rank = np.take_along_axis(rank, np.minimum(source[:, :-1], width - 2), 1)
            if rows.shape[1] < 2:
                rank = np.full((n, 1), _NONE, np.int32)
                rows = np.column_stack([rows, np.full(n, -1, np.int32)])
                continue
            for shift in (-1, 0):  # only the pairs beside the merged token are new
                k = at + shift
                ok = (k >= 0) & (k < rank.shape[1])
                i, k = every[ok], k[ok]
                rank[i, k] = self.pairs.find(rows[i, k], rows[i, k + 1])
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        ids = [int(self.byte_id[b]) for b in piece]
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))

        def merged(a: int, b: int) -> int:
            return int(self.pairs.find(np.array([a]), np.array([b]))[0])

        first = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := merged(ids[x], ids[y])) != _NONE:
                    heapq.heappush(heap, (m, x, ids[x], ids[y]))
        return np.array([t for t in ids if t >= 0], "<u4").tobytes()

    def _encode_pieces(self, pieces: list[str]) -> None:
        """Fill ``piece_ids`` for pieces that aren't in it."""
        short: list[tuple[str, bytes]] = []
        for p in pieces:
            raw = p.encode("utf-8")
            whole = self.rank.get(raw)
            if whole is not None:
                self.piece_ids[p] = np.array([whole], "<u4").tobytes()
            elif len(raw) > LONG:
                self.piece_ids[p] = self._merge_long(raw)
            else:
                short.append((p, raw))
        size = np.array([len(raw) for _, raw in short], np.int64)
        low = 0
        for width in _WIDTHS:
            at = np.flatnonzero((size > low) & (size <= width))
            low = width
            for part in np.array_split(at, max(1, len(at) * width // 500_000 + 1)):
                if len(part):
                    flat = np.frombuffer(b"".join(short[i][1].ljust(width, b"\0") for i in part), np.uint8)
                    rows = self.byte_id[flat].reshape(len(part), width)
                    rows[np.arange(width)[None, :] >= size[part][:, None]] = -1
                    for i, ids in zip(part, self._merge_rows(rows), strict=True):
                        self.piece_ids[short[i][0]] = ids

    # -- texts ------------------------------------------------------------
    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.chunk_ids) + len(self.piece_ids) > REMEMBERED:
            self.chunk_ids, self.piece_ids = {}, {}
        lists: list[tuple[bool, list[str]]] = []
        new_chunks: set[str] = set()
        new_pieces: set[str] = set()
        for text in texts:
            text = text or ""
            # a single blank between other characters always begins a piece
            plain = _BLANKS.search(text) is None
            parts = text.split(" ") if plain else self.split(text)
            lists.append((plain, parts))
            if plain and parts[0]:
                new_chunks.update(set(parts[1:]).difference(self.chunk_ids))
                new_pieces.update(p for p in self.split(parts[0]) if p not in self.piece_ids)
            elif not plain:
                new_pieces.update(set(parts).difference(self.piece_ids))
        cut = {c: self.split(" " + c) for c in new_chunks}
        for pieces in cut.values():
            new_pieces.update(pieces)
        self._encode_pieces([p for p in new_pieces if p not in self.piece_ids])
        known = self.piece_ids
        for c, pieces in cut.items():
            self.chunk_ids[c] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])
        out = []
        for plain, parts in lists:
            if not plain:
                out.append(b"".join([known[p] for p in parts]))
            elif not parts[0]:
                out.append(b"")
            else:
                head = b"".join([known[p] for p in self.split(parts[0])])
                out.append(head + b"".join(map(self.chunk_ids.__getitem__, parts[1:])))
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of concatenated id lists of the given lengths, and each list's end."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.token_size)):
            raise ValueError("an id is not in the vocabulary")
        size = self.token_size[ids]
        ends = np.cumsum(size)
        source = np.repeat(self.token_at[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        total = np.concatenate([[0], ends])
        return self.token_bytes[source], total[np.cumsum(counts)]


#: White space as the tokenizers' patterns mean it, next to a blank or at an end.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　\x1c-\x1f"
_BLANKS = re.compile(f"[{_SPACES}] | [{_SPACES}]|^ | $|^$")

_CODECS: dict[tuple, Codec] = {}


def _codec(tokens: list[bytes], pattern: str) -> Codec:
    """One codec for each vocabulary in a worker process, kept between tasks."""
    key = (hash(tuple(tokens)), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens, pattern)
    return _CODECS[key]


IDS = StructType([StructField("n_tokens", IntegerType()), StructField("ids", ArrayType(IntegerType()))])


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, keep: list[str], text: str = "text",
           out: str = "bpe") -> DataFrame:
    """``docs[keep]`` and a struct ``out`` of ``n_tokens`` and ``ids``."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tokens)

    def work():
        codec = _codec(sent.value, pattern)

        def apply(texts: pa.Array) -> list[pa.Array]:
            ids: list[bytes] = []
            for first, last, _, _ in tb.byte_runs(texts):
                ids += codec.encode(texts.slice(first, last - first).to_pylist())
            counts = np.array([len(i) // 4 for i in ids], np.int32)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            flat = np.frombuffer(b"".join(ids), "<i4")
            return [pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
        return apply

    return tb.annotate(docs, text, keep, out, IDS, work)


def decode(rows: DataFrame, tokens: list[bytes], keep: list[str], ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``rows[keep]`` and a struct ``out`` of ``decoded``: the bytes of the ids."""
    spark = rows.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tokens)

    def work():
        codec = _codec(sent.value, "")

        def apply(lists: pa.Array) -> list[pa.Array]:
            lists = lists.cast(pa.list_(pa.int32()))
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            flat = np.asarray(lists.flatten(), np.int64)
            data, ends = codec.decode(flat, counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            return [pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(data)])]
        return apply

    return tb.annotate(rows, ids, keep, out, StructType([StructField("decoded", BinaryType())]), work)
