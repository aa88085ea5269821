"""The sample that packing fits its directions on is held by the driver, in little memory."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from creditmart.llm import locality


def test_the_driver_fits_the_directions_in_little_memory():
    random_ = np.random.Generator(np.random.PCG64(1))
    tokens, ids = 49_152, [random_.integers(0, 49_152, 200).astype("<u2") for _ in range(4_096)]
    how = locality.Weights(np.ones(tokens, np.float32), None, 1.2, 0.75)
    tracemalloc.start()
    basis = locality.projection(locality.sampled(ids, how, 200.0), len(ids), tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert basis.shape == (tokens, locality.RANK) and np.linalg.norm(basis, axis=0) == pytest.approx(1, abs=1e-4)
    assert peak < 75e6  # 134.8 MB when whole arrays of 64-bit numbers were held and sorted


def test_sums_by_group_equal_a_plain_sum(monkeypatch):
    monkeypatch.setattr(locality, "PART", 7)
    random_ = np.random.Generator(np.random.PCG64(2))
    group, index, weight, rows = random_.integers(0, 9, 100), random_.integers(0, 5, 100), random_.random(100).astype(np.float32), random_.random((5, 3)).astype(np.float32)
    plain = np.zeros((9, 3), np.float32)
    np.add.at(plain, group, rows[index] * weight[:, None])
    assert np.allclose(locality._sums(group, weight, rows, index, 9), plain, atol=1e-5)
