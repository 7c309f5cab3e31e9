import pytest
from pyspark.sql import functions as F

from quarry.sources import csv as csvio
from quarry.sources.positions import with_file_position


@pytest.fixture
def files(spark, tmp_path):
    """Labelled samples in five files of different sizes; label = place of the row."""
    rows = spark.range(5000).select(F.col("id").alias("label"), F.array(F.rand(1), F.rand(2)).alias("v"))
    path = str(tmp_path / "s")
    csvio.write_labelled_csv(rows.repartitionByRange(5, F.expr("sqrt(label)")).sortWithinPartitions("label"), "label", "v", path, n_features=2)
    yield path
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ids_do_not_depend_on_split_size_or_packing(spark, files):
    for size, cost in ((1 << 27, 1 << 22), (3000, 0), (20_000, 0), (20_000, 5000), (100, 0)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", str(cost))
        df = csvio.read_labelled_csv(spark, files, 2, True)
        got = with_file_position(df).select("row_id", "label").collect()
        assert len(got) == 5000 and all(r.row_id == r.label for r in got), (size, cost)
    assert df.rdd.getNumPartitions() > 100


def test_empty_files_and_taken_names(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    (tmp_path / "b.txt").write_text("x\ny\n")
    df = spark.read.text(str(tmp_path))
    assert sorted((r.row_id, r.value) for r in with_file_position(df).collect()) == [(0, "x"), (1, "y")]
    assert with_file_position(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        with_file_position(df, "value")
