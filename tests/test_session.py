"""Session settings."""

from pyspark.sql import functions as F

from layerhouse import session


def test_tasks_after_a_shuffle_do_not_grow_with_the_input(spark):
    session.configure(spark)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    given = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        tasks = spark.range(4_000_000).select(F.xxhash64("id").alias("id")).distinct().rdd.getNumPartitions()
    finally:
        spark.conf.set(size, given)
    assert tasks > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_table_of_many_days_is_listed_by_some_tasks(spark, folder):
    session.configure(spark)
    spark.range(200).select("id", (F.col("id") % 100).alias("day")).repartition(1).write.partitionBy("day").parquet(folder, mode="overwrite")
    context, group = spark.sparkContext, "listing of many days"
    context.setJobGroup(group, group)
    try:
        assert len(spark.read.schema("id bigint, day bigint").option("basePath", folder).parquet(*[f"{folder}/day={n}" for n in range(100)]).inputFiles()) == 100
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    told = context.statusTracker()
    tasks = [told.getStageInfo(s).numTasks for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds]
    assert tasks and max(tasks) < 100
