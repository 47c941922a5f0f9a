"""A dictionary as a table: one plan for small ones and one for large ones, the same rows."""

import pytest

from listwell.operators.dictionary import dictionary, looked_up


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_lookup(spark, most):
    entries = dictionary(spark.createDataFrame([(" Brick ", 1), ("brick", 2), ("panel", 3), (None, 4), ("empty", None)], "k string, v int"), "k", "v")
    rows = spark.createDataFrame([(1, "BRICK"), (2, "panel "), (3, None), (4, "wood"), (5, "empty"), (6, "")], "id int, wall string")
    got = looked_up(rows, "wall", entries, name="kind", broadcast_bytes=most)
    assert got.columns == ["id", "wall", "kind", "_reason"]
    assert {r.id: (r.kind, r._reason) for r in got.collect()} == {1: (1, None), 2: (3, None), 3: (None, None), 4: (None, "kind: not in dictionary"), 5: (None, None), 6: (None, "kind: not in dictionary")}
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == (most > 0)
    # a second lookup keeps the first reason
    twice = looked_up(got, "wall", entries, name="kind", broadcast_bytes=most)
    assert {r.id: r._reason for r in twice.collect()}[4] == "kind: not in dictionary" and twice.columns == ["id", "wall", "kind", "_reason"]
