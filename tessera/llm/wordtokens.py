"""Token ids of whole texts for a ``tokenizers`` file, over arrays of words.

A run of texts is viewed as bytes and cut at ASCII white space.  Every
distinct word is encoded once: its bytes are its key (two machine words up to
15 bytes, a byte string above), so equal keys are equal words, and the ids of
a run are gathered through index arrays.  Words of plain letters are merged
together in padded matrices (the rounds of :mod:`bpe` over this vocabulary's
merges); all others go through the library.

That is right only for a tokenizer which lower-cases, drops white space and
never joins over it (:func:`separable` reads that from the file); with any
other file whole texts go through the library.

:func:`tokenise` writes the ids once to the shared folder, cut into full
windows and a remainder, with what is needed to number both without gathering
equal lengths anywhere.

Defined results: a null or empty text has no ids of its own, only the end id;
an empty table gives an empty result; columns other than the key and the text
are ignored.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ..session import shared_path
from . import bpe
from . import textbatch as tb
from .shipping import ship

#: Distinct words whose ids a worker remembers before it starts afresh.
REMEMBERED = 700_000
#: Longest word whose key is two machine words.
SHORT = 15
#: Letters that are their own lower case and stay as they are under NFC.
_LETTERS = "a-zß-öø-ÿ"
#: A word of such letters, and marks that begin a piece of their own after it.
_PLAIN = re.compile(f"([{_LETTERS}]*)([!-&(-/:-@\\[-`{{-~]*)")
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_AZ = np.zeros(256, bool)
_AZ[97:123] = True
# fixed values: the pipeline of the file for which words are separable
_NORMAL = ["NFC", "Replace", "Lowercase"]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def separable(definition: dict) -> bool:
    """Whether words between white space have the same ids in every text."""
    normal = definition.get("normalizer") or {}
    steps = [s.get("type") for s in normal.get("normalizers", [])]
    cut = (definition.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = definition.get("model", {})
    return (steps == _NORMAL and len(cut) == 2 and cut[0].get("pattern") == {"Regex": _PIECES}
            and cut[0].get("invert") is True and cut[1].get("type") == "ByteLevel"
            and not cut[1].get("add_prefix_space") and not cut[1].get("use_regex")
            and model.get("type") == "BPE" and not model.get("dropout"))


def _byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones for themselves, the rest in order from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges(bpe.Codec):
    """The merging rounds of :class:`bpe.Codec` over a list of merges."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        #: ids must rise with the order of the merges: then they are ranks
        self.ordered = bool((np.diff(merged) > 0).all()) if len(merged) else False
        names = _byte_names()
        self.inner = np.array([vocab.get(c, -1) for c in names], np.int32)
        self.last = np.array([vocab.get(c + suffix, -1) for c in names], np.int32)
        self.usable = self.ordered and bool((self.inner >= 0).all() and (self.last >= 0).all())
        if self.usable:
            self.pairs = bpe.PairTable(np.array([vocab[a] for a, _ in pairs], np.int64),
                                       np.array([vocab[b] for _, b in pairs], np.int64), merged)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each (short, not empty) word."""
        out = [b""] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        low = 0
        for width in (4, 6, 8, 10, 12, 16, 24, 32, 48, 64):
            at = np.flatnonzero((size > low) & (size <= width))
            low = width
            for part in np.array_split(at, len(at) * width // 500_000 + 1):
                if len(part):
                    raw = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in part.tolist()]), np.uint8)
                    raw = raw.reshape(len(part), width)
                    rows = self.inner[raw]
                    end = size[part] - 1
                    every = np.arange(len(part))
                    rows[every, end] = self.last[raw[every, end]]
                    rows[np.arange(width)[None, :] > end[:, None]] = -1
                    for i, ids in zip(part.tolist(), self._merge_rows(rows), strict=True):
                        out[i] = ids
        return out


class WordTokenizer:
    """Ids of byte runs; remembers the words it has seen."""

    def __init__(self, definition: str, width: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_str(definition)
        self.library.encode_special_tokens = True
        self.width = np.dtype(width)
        content = json.loads(definition)
        self.by_word = separable(content)
        self.merges = Merges(content["model"]) if self.by_word else None
        self._forget()

    def _forget(self) -> None:
        self.ids = np.zeros(1 << 16, self.width)
        self.used = 0
        self.at = np.zeros(0, np.int64)      # of each known word: where its ids begin
        self.size = np.zeros(0, np.int64)    # and how many they are
        self.hash = np.zeros(0, np.uint64)   # short words, by hash: key and number
        self.low = np.zeros(0, np.uint64)
        self.high = np.zeros(0, np.uint64)
        self.entry = np.zeros(0, np.int64)
        self.long: dict[bytes, int] = {}

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words that aren't known."""
        ids: list[bytes] = [b""] * len(words)
        plain: list[tuple[int, bytes]] = []
        marks: list[tuple[int, str]] = []
        other: list[tuple[int, str]] = []
        for i, raw in enumerate(words):
            text = raw.decode("utf-8", "replace")
            got = _PLAIN.fullmatch(text) if self.merges.usable and len(raw) <= 64 else None
            if got is None:
                other.append((i, text))
                continue
            if got[1]:
                plain.append((i, got[1].encode("utf-8")))
            if got[2]:
                marks.append((i, got[2]))
        distinct = list(dict.fromkeys(w for _, w in plain))
        known = dict(zip(distinct, self.merges.encode_words(distinct), strict=True)) if distinct else {}
        for i, w in plain:
            ids[i] = known[w]
        for todo in (marks, other):
            distinct = list(dict.fromkeys(w for _, w in todo))
            known = {}
            for k in range(0, len(distinct), 4096):
                part = distinct[k:k + 4096]
                for w, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                    known[w] = np.array(e.ids, "<u4").tobytes()
            for i, w in todo:
                ids[i] += known[w]
        size = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        if self.used + len(flat) > len(self.ids):
            grown = np.zeros(2 * (self.used + len(flat)), self.width)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:self.used + len(flat)] = flat
        first = len(self.at)
        self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used += len(flat)
        return np.arange(first, first + len(words))

    def _short(self, data: np.ndarray, padded: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of words of at most ``SHORT`` bytes (-1: hash taken by another word)."""
        size = end - begin
        eight = np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,))
        low = eight[begin] & _MASK[np.minimum(size, 8)]
        high = (eight[begin + 8] & _MASK[np.maximum(size - 8, 0)]) | (size.astype(np.uint64) << np.uint64(56))
        key = tb.mix(low + tb.mix(high))
        _, one, member = np.unique(key, return_index=True, return_inverse=True)
        ok = (low == low[one][member]) & (high == high[one][member])
        k, lo, hi = key[one], low[one], high[one]
        number = np.full(len(one), -1, np.int64)
        if len(self.hash):
            i = np.minimum(np.searchsorted(self.hash, k), len(self.hash) - 1)
            taken = self.hash[i] == k
            same = taken & (self.low[i] == lo) & (self.high[i] == hi)
            number[same] = self.entry[i[same]]
            new = np.flatnonzero(~taken)
        else:
            new = np.arange(len(one))
        if len(new):
            b, e = begin[one[new]].tolist(), end[one[new]].tolist()
            raw = data.tobytes()
            number[new] = self._learn([raw[x:y] for x, y in zip(b, e, strict=True)])
            place = np.searchsorted(self.hash, k[new])
            self.hash = np.insert(self.hash, place, k[new])
            self.low = np.insert(self.low, place, lo[new])
            self.high = np.insert(self.high, place, hi[new])
            self.entry = np.insert(self.entry, place, number[new])
        return np.where(ok, number[member], -1)

    def _numbers(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.at) > REMEMBERED:
            self._forget()
        number = np.full(len(begin), -1, np.int64)
        padded = np.concatenate([data, np.zeros(24, np.uint8)])
        short = np.flatnonzero(end - begin <= SHORT)
        if len(short):
            number[short] = self._short(data, padded, begin[short], end[short])
        rest = np.flatnonzero(number < 0)
        if len(rest):
            raw = data.tobytes()
            words = [raw[b:e] for b, e in zip(begin[rest].tolist(), end[rest].tolist(), strict=True)]
            new = [w for w in dict.fromkeys(words) if w not in self.long]
            self.long.update(zip(new, self._learn(new).tolist(), strict=True))
            number[rest] = [self.long[w] for w in words]
        return number

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a byte run's texts, end to end, and how many each text has."""
        n = len(offsets) - 1
        if not self.by_word:
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            got = [np.array(e.ids, self.width) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([*got, np.zeros(0, self.width)]), np.array([len(x) for x in got], np.int64)
        data = tb.LOWER[data]
        begin, end, doc = tb.words(data, offsets, tb.SPACE)
        # a closing mark after a letter is a piece of its own
        size = end - begin
        mark = np.flatnonzero(size > 2)
        closing = data[end[mark] - 1]
        before, more = data[end[mark] - 2], data[end[mark] - 3]
        letter = _AZ[before] | ((more == 0xC3) & (before >= 0x9F) & (before != 0xB7))
        mark = mark[((closing == 44) | (closing == 46)) & letter]
        all_begin = np.insert(begin, mark + 1, end[mark] - 1)
        cut = end.copy()
        cut[mark] -= 1
        all_end = np.insert(cut, mark + 1, end[mark])
        doc = np.insert(doc, mark + 1, doc[mark])
        number = self._numbers(data, all_begin, all_end)
        size = self.size[number]
        stop = np.cumsum(size)
        source = np.repeat(self.at[number] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
        return self.ids[source], np.bincount(doc, size, n).astype(np.int64)


_TOKENIZERS: dict[tuple, WordTokenizer] = {}


def _tokenizer(definition: str, width: str) -> WordTokenizer:
    key = (hash(definition), width)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordTokenizer(definition, width)
    return _TOKENIZERS[key]


def tokenise(docs: DataFrame, definition: str, end_id: int, window: int, doc_id: str = "doc_id",
             text: str = "text") -> tuple[DataFrame, str]:
    """``(doc_id, part, n, n_full, full_at, rem, local, ids_full, ids_rem)``,
    written to the shared folder, and the numpy type of the ids.

    A document's ids and the end id are ``n_full`` windows and a remainder of
    ``rem`` ids.  ``part`` is the task that made the row, ``full_at`` the
    windows before the row's in its part, ``local`` the rows of the part
    before it with the same ``rem``: with the parts' totals
    (:func:`before_parts`) these number all windows, and all rows of a length.
    """
    from tokenizers import Tokenizer as Library

    spark = docs.sparkSession
    ship(spark)
    size = Library.from_str(definition).get_vocab_size(with_added_tokens=True)
    width = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    step = int(width[-1])
    sent = spark.sparkContext.broadcast(definition)
    key = docs.schema[doc_id]
    schema = StructType([key, *(StructField(n, t) for n, t in (
        ("part", LongType()), ("n", LongType()), ("n_full", LongType()), ("full_at", LongType()),
        ("rem", IntegerType()), ("local", LongType()), ("ids_full", BinaryType()), ("ids_rem", BinaryType())))])
    end = np.array([end_id], width).tobytes()

    def run(batches):
        tokenizer = _tokenizer(sent.value, width)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window, np.int64)
        windows = 0
        for batch in batches:
            for first, last, data, offsets in tb.byte_runs(batch.column(1)):
                ids, counts = tokenizer.encode(data, offsets)
                raw, stop = ids.tobytes(), np.cumsum(counts) * step
                whole = [raw[b - c:b] + end for b, c in zip(stop.tolist(), (counts * step).tolist(), strict=True)]
                n = counts + 1
                full, rem = n // window, n % window
                order = np.argsort(rem, kind="stable")
                ordered = rem[order]
                local = np.empty(len(n), np.int64)
                local[order] = np.arange(len(n)) - np.searchsorted(ordered, ordered, "left")
                local += seen[rem]
                seen += np.bincount(rem, minlength=window)
                full_at = windows + np.cumsum(full) - full
                windows += int(full.sum())
                cut = (full * window * step).tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(np.full(len(n), part, np.int64)), pa.array(n),
                    pa.array(full), pa.array(full_at), pa.array(rem.astype(np.int32)), pa.array(local),
                    pa.array([x[:c] for x, c in zip(whole, cut, strict=True)], pa.binary()),
                    pa.array([x[c:] for x, c in zip(whole, cut, strict=True)], pa.binary())], names=schema.names)

    path = shared_path(spark, "packing/tokens")
    docs.select(docs[doc_id], docs[text]).mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path), width


#: Parts that are summed together before their groups are.
_GROUP = 512


def before_parts(totals: DataFrame, keys: list[str], value: Column | str) -> DataFrame:
    """``keys, part, base``: the sum of ``value`` over all earlier parts of the
    same keys; ``totals`` has one row a part and key.

    Sums run inside groups of parts and over the groups, so that of a key no
    task takes a row for each part of the input.
    """
    rows = totals.select(*keys, "part", F.col(value).alias("v") if isinstance(value, str) else value.alias("v"))
    rows = rows.withColumn("grp", F.floor(F.col("part") / F.lit(_GROUP)))
    earlier = (Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("v").over(Window.partitionBy(*keys, "grp").orderBy("part").rowsBetween(*earlier)), F.lit(0))
    groups = rows.groupBy(*keys, "grp").agg(F.sum("v").alias("v"))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ahead = F.coalesce(F.sum("v").over(over.orderBy("grp").rowsBetween(*earlier)), F.lit(0))
    ahead = groups.select(*keys, "grp", ahead.alias("ahead"))
    return rows.withColumn("inside", inside).join(ahead, [*keys, "grp"]).select(
        *keys, "part", (F.col("inside") + F.col("ahead")).alias("base"))
