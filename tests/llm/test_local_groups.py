"""Grouping of equal phrases inside a task."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from sunledger.llm import collocations


def groups(columns):
    order, starts = collocations.local_groups(columns)
    rows = list(zip(*(c[order].tolist() for c in columns), strict=True))
    ends = [*starts[1:], len(rows)]
    assert sorted(order.tolist()) == list(range(len(rows)))
    assert all(len(set(rows[s:e])) == 1 for s, e in zip(starts, ends, strict=True))
    return Counter({rows[s]: int(e - s) for s, e in zip(starts, ends, strict=True)}), len(starts)


@pytest.mark.parametrize("alike", [False, True])
@pytest.mark.parametrize("rows", [1, 2, 500])
def test_equal_rows_meet_also_when_hashes_clash(monkeypatch, alike, rows):
    if alike:  # every phrase has the hash of every other
        monkeypatch.setattr(collocations, "mixed", lambda h: h * np.uint64(0))
    rng = np.random.default_rng(rows)
    columns = [rng.integers(-3, 3, rows) for _ in range(3)]
    found, count = groups(columns)
    assert found == Counter(zip(*(c.tolist() for c in columns), strict=True)) and count == len(found)
