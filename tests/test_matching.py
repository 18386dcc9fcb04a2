"""The automaton reads Arrow batches text by text."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from vacancylab.functions.matching import group_matcher


def test_groups_and_nulls():
    match = group_matcher([(" ai", 1), (" ai", 0), (" ö😀", 2)], 3).func
    found = match(pa.array(["an ai", None, "", "x ö😀 ai", "ai"]))
    assert found.to_pylist() == [[0, 1], None, [], [0, 1, 2], []]


def test_a_batch_is_not_held_as_python_strings():
    batch = pa.array([f"{i} " + "word " * 20_000 for i in range(100)])    # 10 MB
    match = group_matcher([(" absent", 0)], 1).func
    match(batch[:1])
    tracemalloc.start()
    assert match(batch).to_pylist() == [[]] * 100
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000
