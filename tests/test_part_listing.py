"""the files of a table of many small parts are listed in few tasks."""

from pyspark.sql import types as T

from lookout.session import work_dir
from lookout.sources.tables import read_part_csvs

SCHEMA = T.StructType(
    [
        T.StructField("image", T.StringType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
BATCHES = 60


def test_parts_are_listed_in_few_tasks(spark):
    base = work_dir(spark, "listing")
    rows = spark.range(2 * BATCHES).selectExpr(
        "concat('i', id) AS image", "string(id % 11) AS prediction", "id div 2 AS batch_id", "id % 2 AS odd"
    )
    for odd, columns in ((0, ["image", "prediction"]), (1, ["prediction", "image"])):
        part = rows.where(f"odd = {odd}").select(*columns, "batch_id")
        part.write.mode("append").partitionBy("batch_id").option("header", True).csv(base)
    sc, key = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    sc.setJobGroup("few-tasks", "listing")
    try:
        found = read_part_csvs(spark, base, SCHEMA)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds}
    tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s)) is not None]
    assert tasks and max(tasks) < BATCHES
    assert spark.conf.get(key, None) == before
    expected = {(f"i{i}", str(i % 11), i // 2) for i in range(2 * BATCHES)}
    assert {tuple(r) for r in found.collect()} == expected and found.count() == 2 * BATCHES
