"""Tables of passing use are removed, those that are kept stay."""

import os
import time

import pytest

from grainfold.session import discard, passing_tables, stored


def test_passing_tables_go(spark):
    with passing_tables() as keep:
        first = stored(spark.range(5))
        with passing_tables() as keep_inner:
            inner = keep_inner(stored(first.selectExpr("id * 2 AS x")))
            gone = stored(inner)
        kept = keep(stored(inner.where("x > 2")))
        assert not os.path.exists(gone._stored_at.removeprefix("file:")) and inner.count() == 5
    assert kept.count() == 3
    assert not any(os.path.exists(t._stored_at.removeprefix("file:")) for t in (first, inner, gone))
    discard(kept)
    discard(kept)


def test_tables_go_after_an_error(spark):
    with pytest.raises(ValueError), passing_tables():
        table = stored(spark.range(1))
        raise ValueError
    assert not os.path.exists(table._stored_at.removeprefix("file:"))


def test_shuffle_files_go_with_the_query(spark):
    def files():
        manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
        return {f.toString() for f in (lambda it: [it.apply(i) for i in range(it.size())])(manager.getAllFiles()) if "shuffle_" in f.toString()}

    before = files()
    table = stored(spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").sum("id"))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 7
