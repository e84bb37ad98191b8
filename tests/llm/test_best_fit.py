"""Best-fit packing: the reduction against exhaustive search, the pieces against the library."""

import collections
import functools

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import bestfit, wordtokens


def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def fewest(items, window):
    """The least number of sequences, by trying every assignment."""
    items = tuple(sorted(items, reverse=True))

    @functools.lru_cache(None)
    def go(at, rooms):
        if at == len(items):
            return 0
        best = 1 + go(at + 1, tuple(sorted((*rooms, window - items[at]))))
        for i, room in enumerate(rooms):
            if room >= items[at] and (i == 0 or rooms[i - 1] != room):
                best = min(best, go(at + 1, tuple(sorted((*rooms[:i], room - items[at], *rooms[i + 1:])))))
        return best

    return go(0, ())


def placed_once(plan, hist):
    used = collections.Counter()
    for length in np.flatnonzero(hist).tolist():
        n = int(hist[length])
        sequence, offset = plan.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            for k in range(length):
                used[(s, o + k)] += 1
    assert max(used.values(), default=1) == 1 and len(used) == int((hist * np.arange(len(hist))).sum())
    ends = collections.Counter(s for s, _ in used)
    assert all((s, o) in used for s, n in ends.items() for o in range(n))  # gapless from 0
    assert set(ends) == set(range(plan.sequences))


def test_the_reduction_never_costs_a_sequence():
    rng = np.random.default_rng(4)
    fixed = 0
    for trial in range(250):
        window = int(rng.integers(8, 30))
        low = int(rng.integers(1, max(2, window // 3)))
        items = rng.integers(low, window, int(rng.integers(1, 9))).tolist()
        hist = np.bincount(items, minlength=window)
        sets, left = bestfit.reduce(hist, window)
        fixed += bool(sets)
        assert all(sum(s) <= window for s, _ in sets)
        rest = np.repeat(np.arange(window), left).tolist()
        assert sum(t for _, t in sets) + fewest(rest, window) == fewest(items, window), (items, window, sets)
        placed_once(bestfit.make_plan(hist, window), hist)
    assert fixed > 200


def test_plans_place_every_piece_once_and_as_well_as_one_by_one():
    rng = np.random.default_rng(5)
    for scale in (1, 7, 40):
        hist = np.bincount(rng.integers(1, 64, 300), minlength=64) * scale
        placed_once(bestfit.make_plan(hist, 64), hist)
        _, total = bestfit.best_fit(hist, 64)
        rooms: list[int] = []
        for length in np.repeat(np.arange(64), hist)[::-1].tolist():
            fit = [(r, i) for i, r in enumerate(rooms) if r >= length]
            if fit:
                rooms[min(fit)[1]] -= length
            else:
                rooms.append(64 - length)
        assert total == len(rooms)
    hist = np.zeros(64, np.int64)
    assert bestfit.make_plan(hist, 64).sequences == 0
    hist[3] = 10_000_000  # one length, however often, is one run
    plan = bestfit.make_plan(hist, 64)
    assert plan.sequences == -(-10_000_000 // 21) and len(plan.rank) <= 2


@pytest.mark.parametrize("window", [64, 4096])
def test_pieces(spark, docs, empty, window):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(definition())
    library.encode_special_tokens = True
    rows = bestfit.pack(docs, definition(), end_id=1, window=window).collect()
    whole = collections.Counter()
    for r in docs.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), window):
            whole[(r.doc_id, k // window, k, len(ids[k:k + window]), ids[k:k + window].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == whole
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert len(sequences) <= 1.2 * sum(r.length for r in rows) / window + 1
    assert bestfit.pack(empty, definition(), end_id=1, window=window).count() == 0


def test_word_arrays_equal_the_library():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from tessera.llm import textbatch as tb

    library = Tokenizer.from_str(definition())
    library.encode_special_tokens = True
    rng = random.Random(1)
    letters = "abcAZéÉèÀßüÜŸÿ.,'\"!*%&<|>09 \n\t\r\x0b\x0c  ́̊KİıΣσς中文\U0001f600\x00sStTrRvVmMlLdD…”“"
    odd = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(4000)]
    odd += ["<|endoftext|> <|startoftext|>x", "", None, "it's we'll they're.", "a" * 5000, "word, word. Word WORD"]
    plain = '{"version":"1.0","normalizer":null,"pre_tokenizer":null,"post_processor":null,"decoder":null,' \
            '"added_tokens":[],"model":{"type":"BPE","vocab":{"a":0,"b":1," ":2,"b ":3},"merges":[["b"," "]]}}'
    for text, expected in ((definition(), True), (plain, False)):
        tokenizer = wordtokens.WordTokenizer(text, "<u2")
        assert tokenizer.by_word == expected
        library = Tokenizer.from_str(text)
        library.encode_special_tokens = True
        got = []
        for _, _, data, offsets in tb.byte_runs(pa.array(odd), limit=5000):
            ids, counts = tokenizer.encode(data, offsets)
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in odd]


def test_sums_before_a_part(spark):
    rows = [(p, k, (p * 7 + k) % 5) for p in range(0, 1500, 3) for k in (1, 2)]
    got = wordtokens.before_parts(spark.createDataFrame(rows, "part long, k int, v long"), ["k"], "v").collect()
    assert {(r.part, r.k): r.base for r in got} == {(p, k): sum(v for q, j, v in rows if j == k and q < p) for p, k, _ in rows}
