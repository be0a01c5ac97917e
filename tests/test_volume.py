"""How much is written and how many partitions there are: what must follow the rows only."""

import glob
import gzip
import os
import pathlib
import time

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from checks import queries, staged
from ledgerloom.operators.star import write_star
from ledgerloom.schemas import STAR
from ledgerloom.session import freed_shuffles, materialised
from ledgerloom.sources import published as pub
from ledgerloom.sources import raw

ROWS = [(1, "a"), (2, 'two\nlines, "quoted"'), (3, None), (4, ""), (5, " x ")]


@pytest.fixture
def notes(spark):
    return spark.createDataFrame(ROWS, "id int, note string").coalesce(1)


def test_packed_text_is_read_as_it_was(spark, notes, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "_PACKED_ROWS", 2)
    raw.write_csv(notes, f"{tmp_path}/packed.csv", packed=True)
    raw.write_csv(notes, f"{tmp_path}/plain.csv")
    assert len(glob.glob(f"{tmp_path}/packed.csv/*.csv.gz")) == 3  # of two rows at most
    packed, plain = (raw.scan_text(spark, f"{tmp_path}/{n}.csv") for n in ("packed", "plain"))
    assert sorted(values(packed, "id", "note"), key=str) == sorted(values(plain, "id", "note"), key=str)
    assert ("2", 'two\nlines, "quoted"') in values(packed, "id", "note")


def test_tables_are_packed_in_any_session(spark, notes, tmp_path):
    name = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(name)
    spark.conf.set(name, "snappy")
    try:
        materialised(notes, f"{tmp_path}/work")
        pub.publish_clean({"notes": notes}, str(tmp_path))
    finally:
        spark.conf.set(name, before)
    for folder in ("work", "notes_clean"):
        assert glob.glob(f"{tmp_path}/{folder}/*.zstd.parquet")


def test_staged_text_is_packed(spark, sf_dir):
    folder = queries.text_files(spark, sf_dir)
    assert glob.glob(f"{folder}/fact_sales.csv/*.csv.gz")


def test_spreading_is_not_bound_to_the_cores(spark, sf_dir):
    """A fixed number of partitions grows with the table, and in the end spills."""
    plan = plan_of(staged.file_text(spark, sf_dir)["fact_purchase_order"])
    assert "REPARTITION_BY_COL" in plan
    assert "REPARTITION_BY_NUM" not in plan


def _sums(spark, n=20000):
    return spark.range(n).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("s"))


def test_written_files_take_no_more_time_to_pack_than_need_be(spark, tmp_path):
    texts = spark.range(0, 30000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("t"))
    raw.write_csv(texts, f"{tmp_path}/t.csv", packed=True)
    (file,) = glob.glob(f"{tmp_path}/t.csv/*.gz")
    text = gzip.decompress(pathlib.Path(file).read_bytes())
    size = os.path.getsize(file)
    fast, usual = (len(gzip.compress(text, level)) for level in (1, 6))
    assert abs(size - fast) < abs(size - usual)
    assert spark.read.option("header", "true").csv(f"{tmp_path}/t.csv").count() == 30000


def test_a_loaded_star_is_packed_in_any_session(spark, tmp_path):
    name = "spark.sql.parquet.compression.codec"
    given = spark.conf.get(name)
    spark.conf.set(name, "snappy")
    try:
        tables = {t: spark.createDataFrame([], s) for t, s in STAR.items()}
        write_star(tables, str(tmp_path))
    finally:
        spark.conf.set(name, given)
    assert glob.glob(f"{tmp_path}/dim_store/*.zstd.parquet")


@pytest.mark.parametrize("write", ["csv", "parquet"])
def test_writing_leaves_no_shuffle_files(spark, tmp_path, write):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    before = shuffles()
    pub.publish_clean({"t": _sums(spark)}, str(tmp_path), write)
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before


def test_the_session_is_left_as_it_was(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given = spark.conf.get(name, None)
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == given
