from pyspark.sql import functions as F

from marginalia.operators.staging import staged, staging_folder


def test_folder_is_the_one_the_session_names(spark):
    assert staging_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_rows_are_fixed(spark):
    table = staged(spark.range(100).withColumn("v", F.rand()))
    assert table.collect() == table.collect() and table.count() == 100
    assert any(path.startswith(f"file:{staging_folder(spark)}") or staging_folder(spark) in path for path in table.inputFiles())
