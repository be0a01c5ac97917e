import time

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import store


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    before, setting = shuffles(), spark.conf.get(store._CLEANUP, None)
    counted = spark.range(10000).groupBy((F.col("id") % 7).alias("k")).count()
    held = store.written(counted, "counts")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(store._CLEANUP, None) == setting
    assert sorted(held.collect()) == sorted(counted.collect())


def test_a_worker_forgets_what_is_kept_for_other_steps(spark, monkeypatch):
    # Workers of its own: of those that other tests left idle, each task may get another one.
    monkeypatch.setitem(spark.sparkContext.environment, "LEDGERLOOM_TEST", "own workers")

    def hold(batches):
        for batch in batches:
            store.kept["model"] = (b"key", list(range(1000)))
            yield batch

    def count(batches):
        for batch in batches:
            yield batch.set_column(0, "id", pa.array([len(store.kept)] * batch.num_rows))

    held = lambda work, keep: store.map_arrow(spark.range(8).repartition(1), work, "id long", keep)
    held(hold, True).collect()
    assert {r["id"] for r in held(count, True).collect()} == {1}
    assert {r["id"] for r in held(count, False).collect()} == {0}
