"""Measures of a pulse are rounded step by step as in SQL, so that ties in the last digit shown fall to the same side."""

from functools import reduce
from operator import add

import numpy as np
import pytest

from siltwave.operators import pulses
from siltwave.params import Params


def test_integral_and_height_to_the_last_bit():
    rng, p, other = np.random.default_rng(4), Params(), 0
    for _ in range(300):
        w = (np.abs(np.arange(40) - 20.5) * -60 + 1300 + rng.integers(-90, 90, 40) - rng.integers(0, 2560) / 2560).tolist()
        got = dict(zip(pulses.NUMBERS, pulses.measured(w, w, 8, 31, 0, 39, 1.0, 1.0, 1e9, True, p)))
        base, top = got["local_baseline"], max(range(8, 32), key=lambda i: w[i])
        i, j = 8, 31
        while i > 0 and w[i - 1] - base > 0:
            i -= 1
        while j < 39 and w[j + 1] - base > 0:
            j += 1
        parts = [x - base for x in w[i : j + 1]]
        other += sum(parts) != reduce(add, parts, 0.0)
        assert got["integral"] == reduce(add, parts, 0.0)
        y1, y2, y3 = (w[k] - base for k in (top - 1, top, top + 1))
        assert got["amplitude"] == y2 - 0.25 * (y1 - y3) * (got["max_sample"] - top)
    assert other  # the compensated sum of Python differs


def in_order(w, n, h):
    """The boxcar of the first ``n`` samples, each window added from left to right."""
    return [reduce(add, w[max(0, i - h) : min(n, i + h + 1)]) / (min(n, i + h + 1) - max(0, i - h)) for i in range(n)]


@pytest.mark.parametrize("samples, width", [(32, 5), (64, 4), (40, 21), (12, 31), (1, 5)])
def test_smoothed_gate_to_the_last_bit(samples, width):
    rng = np.random.default_rng(7)
    wf = rng.integers(-90, 90, (60, samples)) - rng.integers(0, 2560, (60, samples)) / 2560
    for length in (np.full(60, samples), rng.integers(0, samples + 1, 60)):
        wf = np.where(np.arange(samples) < length[:, None], wf, 0.0)
        got = pulses.smoothed(wf, length, width)
        for w, n, g in zip(wf.tolist(), length.tolist(), got.tolist()):
            assert g[:n] == in_order(w, n, width // 2)


def test_equally_deep_valleys_are_told_apart_as_in_sql():
    """A waveform and its mirror image: two valleys of one depth, up to what the order of adding rounds."""
    rng, p, cuts = np.random.default_rng(3), Params(), set()
    for _ in range(300):
        half = np.array([30, 70, 90, 70, 4, 3, 40, 80, 100]) * rng.uniform(0.5, 2, 9)
        w = np.concatenate([half, half[::-1], np.zeros(8)])
        got, want = pulses.smoothed(w[None], np.array([len(w)]), 5)[0], np.array(in_order(w.tolist(), len(w), 2))
        got, want = (pulses.deepest_valley(g[:18].tolist(), p.min_width) for g in (got, want))
        assert got == want
        cuts.add(want[1])
    assert min(cuts) < 9 < max(cuts)
