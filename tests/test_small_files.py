"""Many small files are dealt to tasks by their number, not by their bytes."""

from sluicegate.sources import ranges
from sluicegate.sources.lines import raw_lines
from sluicegate.workspace import tasks_for_small_work
from workload import fixtures as X

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def tasks_of(df):
    return df.rdd.getNumPartitions()


def test_beginnings_of_a_list_are_read_by_all_cores(spark, write, tmp_path):
    for i in range(40):
        write(f"in/{i}.csv", f"id,name\n{i},x\n")
    heads = ranges.with_first_lines(ranges.list_files(spark, str(tmp_path / "in")), 2)
    assert tasks_of(heads) == tasks_for_small_work(spark)
    assert sorted(bytes(r.heads[1]) for r in heads.collect()) == sorted(f"{i},x".encode() for i in range(40))


def test_listing_of_a_scan_leaves_the_session_as_it_was(spark, write, tmp_path):
    for i in range(40):
        write(f"in/d{i}/f.csv", f"{i}\n")
    before = spark.conf.get(LISTING_TASKS)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        lines = raw_lines(spark, str(tmp_path / "in"))
        jobs = tracker.getJobIdsForGroup("listing")
        stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert 0 < max(s.numTasks for s in stages) <= tasks_for_small_work(spark) < 40
    assert spark.conf.get(LISTING_TASKS) == before
    assert lines.count() == 40


def test_files_are_written_by_many_tasks(spark, sf_dir):
    rows = X.extract_rows(spark, sf_dir).unionAll(X.extract_rows(spark, sf_dir).withColumn("file_no", X.F.col("file_no") + 100))
    written = X.written_by_file(rows, "customer_id")
    assert tasks_of(written._df) == tasks_for_small_work(spark)
