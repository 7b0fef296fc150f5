"""Intermediate tables."""

import os

from tidewatch import session


def test_a_superseded_table_is_deleted_and_no_other(spark):
    first = session.cut_lineage(spark.range(5).toDF("x"), "first")
    second = session.cut_lineage(first.where("x > 2"), "second")
    at = [session._WRITTEN[-2], session._WRITTEN[-1]]
    session.drop_stage(first)
    session.drop_stage(first)  # a second call finds nothing to do
    assert [os.path.exists(p.removeprefix("file:")) for p in at] == [False, True]
    assert sorted(r.x for r in second.collect()) == [3, 4]
    assert at[0] not in session._WRITTEN
