"""The suffix order sorts again only what is undecided; sets are hashed by runs."""

import numpy as np
import pytest

from tessera.llm import rindex, shingles


def test_suffixes_with_a_place_are_not_sorted_again(monkeypatch):
    rng = np.random.default_rng(2)
    long = rng.integers(1, 200, 300)
    text = np.concatenate([rng.integers(1, 200, 20_000), long, [0], long])
    sizes, sort = [], np.argsort
    monkeypatch.setattr(rindex.np, "argsort", lambda x, *a, **k: sizes.append(len(x)) or sort(x, *a, **k))
    order = rindex.suffix_array(text)
    assert len(sizes) > 4 and sizes[0] == len(text) and sum(sizes[1:]) < len(text)
    body = text.astype(np.uint8).tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: body[i:])


@pytest.mark.parametrize("symbols", [1, 2, 5])
def test_suffix_order_of_short_and_periodic_texts(symbols):
    rng = np.random.default_rng(symbols)
    for n in [*range(9), 40, 150]:
        text = rng.integers(0, symbols, n)
        assert rindex.suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_sets_are_hashed_together():
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 3, 1, 0, 0, 250, 7, 0)]
    for part in (sets, sets[:1], sets[1:3], sets[3:]):
        assert shingles.set_keys(part).tolist() == [list(shingles.set_key(s)) for s in part]
    assert shingles.set_keys([]).shape == (0, 2)
