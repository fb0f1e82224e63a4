"""Sums of distances against all pairs."""

import numpy as np
import pytest

from habitra.functions import pairs

G = np.random.default_rng(3)
EVEN = G.uniform(0, 4e4, (2, 12_000)) + [[5e5], [5.2e6]]
FAR = EVEN.copy()
FAR[:, 0] = 9e6, 1.0
TWO = EVEN + np.where(np.arange(12_000) < 5000, 1e6, 0)
LINE = np.array([EVEN[0], np.full(12_000, 5.2e6)])
STEPS = np.round(EVEN / 500) * 500
CASES = {"even": EVEN, "one far off": FAR, "two far apart": TWO, "on a line": LINE, "on steps": STEPS}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("first", [0, 5000])
def test_far_sums_are_those_of_all_pairs(monkeypatch, name, first):
    x, y = CASES[name]
    w = G.integers(1, 5, len(x)).astype(float)
    met, plain = [], pairs.plain_sums
    monkeypatch.setattr(pairs, "plain_sums", lambda a, b, c, d, e: met.append(len(a) * len(c)) or plain(a, b, c, d, e))
    got = pairs.pair_sums(x, y, w, first)
    if first:
        want = np.concatenate([plain(x[:first], y[:first], x[first:], y[first:], w[first:]), plain(x[first:], y[first:], x[:first], y[:first], w[:first])])
    else:
        want = plain(x, y, x, y, w)
    np.testing.assert_allclose(got, want, rtol=1e-13)
    assert sum(met) < len(x) ** 2 / 5  # the rest meet through nodes


def test_few_and_odd_places():
    x, y, w = np.array([0.0, 3.0, 3.0]), np.array([0.0, 4.0, 4.0]), np.array([1.0, 2.0, 1.0])
    assert pairs.pair_sums(x, y, w).tolist() == [15, 5, 5] and pairs.pair_sums(x, y, w, 1).tolist() == [15, 5, 5]
    assert pairs.pair_sums(x[:1], y[:1], w[:1]).tolist() == [0]
    same = np.full(9000, 7.0)
    assert not pairs.pair_sums(same, same, same).any()
    x = EVEN[0].copy()
    x[7] = np.nan
    assert np.isnan(pairs.pair_sums(x, EVEN[1], np.ones(len(x)))).all()


def test_crowds_meet_in_tiles(monkeypatch):
    """Cells are bounded: where a level would have too many, a coarser one or all pairs give the same."""
    monkeypatch.setattr(pairs, "MOST_CELLS", 40)
    w = np.ones(12_000)
    np.testing.assert_allclose(pairs.pair_sums(*EVEN, w), pairs.plain_sums(*EVEN, *EVEN, w), rtol=1e-13)
