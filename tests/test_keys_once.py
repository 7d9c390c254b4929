"""Numbering rows whose copies count once."""

from attrition.operators.keys import with_key


def test_copies_that_count_once_are_numbered_as_distinct_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2), ("b", None), ("c", 3)], "x string, y int")
    once = with_key(rows, "k", once=True).collect()
    assert sorted(map(tuple, once), key=str) == sorted(map(tuple, with_key(rows.distinct(), "k", distinct=True).collect()), key=str)
    assert sorted(r.k for r in once) == [1, 2, 3, 4]
