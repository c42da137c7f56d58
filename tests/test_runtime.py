"""Scopes of written tables."""

import threading

from seatloom import runtime
from seatloom.sources import sinks


def folder_of(df):
    return df.inputFiles()[0].rpartition("/")[0]


def test_scopes_of_threads_are_apart(spark):
    inside, ended, kept = threading.Event(), threading.Event(), []

    def other():
        with runtime.scope(spark):
            kept.append(folder_of(runtime.materialise(spark.range(3), "other")))
            inside.set()
            ended.wait(60)
            kept.append(sinks.exists(spark, kept[0]))

    thread = threading.Thread(target=other)
    with runtime.scope(spark):
        thread.start()
        inside.wait(60)
        own = folder_of(runtime.materialise(spark.range(3), "own"))
        with runtime.scope(spark):
            inner = folder_of(runtime.materialise(spark.range(3), "inner"))
        assert not sinks.exists(spark, inner) and sinks.exists(spark, own)
        result = folder_of(runtime.materialise(spark.range(3), "result", scoped=False))
    ended.set()
    thread.join()
    assert kept[1] and not sinks.exists(spark, own) and not sinks.exists(spark, kept[0]) and sinks.exists(spark, result)
