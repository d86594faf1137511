from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.sources import domain


def test_tasks_of_the_change_log_follow_its_rows(spark):
    """The join behind the change log gets more tasks with more rows, and says the same."""
    rows = sum(spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("orders", "lineitem"))
    few, many = domain.change_log(spark, SF_SMALL), domain.change_log(spark, SF_SMALL, task_rows=rows // 64)
    cores = spark.sparkContext.defaultParallelism
    assert many.select(F.spark_partition_id().alias("p")).distinct().count() > max(cores, 48)
    assert few.select(F.spark_partition_id().alias("p")).distinct().count() <= cores
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
