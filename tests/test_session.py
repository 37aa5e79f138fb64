"""Scratch tables of the shared folder."""

import os

import pytest

from tidemark.session import scratch, settle


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scratch(spark):
    outside = settle(spark.range(3))
    with scratch(spark):
        inner = settle(spark.range(4))
        kept = settle(inner.filter("id > 1"), lasting=True)
        with scratch(spark):
            deeper = folder(settle(spark.range(2)))
            passed_on = folder(settle(spark.range(2), lasting=True))
        assert not os.path.exists(deeper) and os.path.exists(passed_on)
        gone = folder(inner)
    assert not os.path.exists(gone) and not os.path.exists(passed_on)
    assert kept.count() == 2 and outside.count() == 3
    with pytest.raises(ZeroDivisionError), scratch(spark):
        gone = folder(settle(spark.range(4)))
        1 / 0
    assert not os.path.exists(gone)
