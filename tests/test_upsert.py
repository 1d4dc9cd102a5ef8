from __future__ import annotations

import pytest

from bodega.operators.upsert import AmbiguousUpdate, merged, require_unambiguous


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, j bigint, v string")


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replaces_matches_and_adds_the_rest(spark):
    target = frame(spark, [(1, 1, "old"), (2, 1, "kept"), (None, 1, "null kept")])
    updates = frame(spark, [(1, 1, "new"), (3, 1, "added"), (None, 1, "null added")])
    assert result(merged(target, updates, ["k", "j"])) == sorted(
        [(1, 1, "new"), (2, 1, "kept"), (3, 1, "added"), (None, 1, "null kept"), (None, 1, "null added")], key=repr
    )


def test_applying_twice_changes_nothing_more(spark):
    target = frame(spark, [(1, 1, "old"), (2, 1, "kept")])
    updates = frame(spark, [(1, 1, "new"), (3, 1, "added")])
    once = merged(target, updates, ["k"])
    assert result(merged(once, updates, ["k"])) == result(once)


def test_repeated_updates_of_a_target_row_raise(spark):
    target = frame(spark, [(1, 1, "old")])
    twice = frame(spark, [(1, 1, "a"), (1, 1, "b")])
    with pytest.raises(AmbiguousUpdate, match="'k': 1"):
        require_unambiguous(target, twice, ["k"])


def test_repeated_updates_without_target_row_are_all_added(spark):
    target = frame(spark, [(1, 1, "old"), (None, 1, "null")])
    updates = frame(spark, [(2, 1, "a"), (2, 1, "b"), (None, 1, "c"), (None, 1, "d")])
    require_unambiguous(target, updates, ["k"])
    assert merged(target, updates, ["k"]).count() == 6


def test_hot_update_key_is_found_without_collecting_it(spark):
    target = frame(spark, [(7, 1, "old")])
    updates = spark.range(5000).selectExpr("case when id % 3 = 0 then 7 else id + 100 end as k", "1L as j", "'x' as v")
    with pytest.raises(AmbiguousUpdate):
        require_unambiguous(target, updates, ["k"])
