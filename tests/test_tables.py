import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicegate import workspace
from sluicegate.operators import tables
from sluicegate.plans.load import load_delimited
from sluicegate.sources.delimited import Layout
from sluicegate.streaming.ingest import ingest_incremental, loaded_rows, rejected_rows


@pytest.fixture
def table(spark):
    name = "made_by_test"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_write_modes(spark, table):
    tables.write_table(spark.range(3), table)
    with pytest.raises(AnalysisException):
        tables.write_table(spark.range(5), table, "fail")
    assert spark.table(table).count() == 3
    tables.write_table(spark.range(2), table, "append")
    assert spark.table(table).count() == 5
    tables.write_table(spark.range(1).withColumn("x", F.lit("a")), table, "replace")
    assert spark.table(table).columns == ["id", "x"]
    tables.write_table(spark.range(1).select(F.lit("b").alias("x"), "id"), table, "append")
    assert {r.x for r in spark.table(table).collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), table, "sometimes")


@pytest.mark.parametrize("partitions", [1, 9])
def test_surrogate_ids(spark, partitions):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(partitions)
    rows = tables.add_surrogate_id(df, ["k"]).collect()
    assert sorted(r.id for r in rows) == list(range(1, 5001))
    assert [r.k for r in sorted(rows, key=lambda r: r.id)] == sorted(r.k for r in rows)


def test_surrogate_ids_with_a_hot_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = tables.add_surrogate_id(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.id for r in placed.collect()) == list(range(1, 9001))
    # the copies of the key are spread over more than one task
    spread = placed.where("k = 5").groupBy(F.spark_partition_id()).count().count()
    assert spread > 1


def test_surrogate_id_is_kept(spark):
    assert tables.add_surrogate_id(spark.range(3), ["id"]).columns == ["id"]
    assert tables.add_surrogate_id(spark.range(0).toDF("k"), ["k"]).count() == 0


def test_table_stats(spark):
    spark.sql("CREATE DATABASE stats_db")
    try:
        tables.write_table(spark.range(10), "stats_db.ten")
        tables.write_table(spark.range(4).withColumn("x", F.lit("a")), "stats_db.four")
        rows = {r.table_name: r for r in tables.table_stats_report(spark, "stats_db").collect()}
        assert {n: (r.row_count, r.column_count) for n, r in rows.items()} == {
            "ten": (10, 1), "four": (4, 2), "(all tables)": (14, 3)
        }
        assert rows["(all tables)"].size_bytes == rows["ten"].size_bytes + rows["four"].size_bytes > 0
    finally:
        spark.sql("DROP DATABASE stats_db CASCADE")


COLUMNS = ["order_no", "day", "amount", "note"]
CONTENT = "order_no;day;amount;note\n" + "".join(
    f"{i};{i % 28 + 1:02d}/02/2024;{'bad' if i % 50 == 0 else i * 1.5};n{i}{';x' if i % 60 == 1 else ''}\n"
    for i in range(300)
)


def test_load(spark, write, table, tmp_path):
    path = write("in/orders.csv", CONTENT)
    rejected = str(tmp_path / "rejected")
    stats = load_delimited(
        spark, path, table, COLUMNS, Layout(";"), overrides={"amount": "DOUBLE"},
        required=["order_no"], id_column="id", id_order=["order_no"], quarantine_path=rejected,
    ).first()
    # 6 amounts do not read as numbers, 5 lines have a field too many
    assert tuple(stats)[1:] == (300, 289, 11, "96.33%", "Completed with errors")
    loaded = spark.table(table)
    assert dict(loaded.dtypes) == {
        "id": "bigint", "order_no": "int", "day": "date", "amount": "double", "note": "string"
    }
    assert sorted(r.id for r in loaded.collect()) == list(range(1, 290))
    bad = spark.read.json(rejected)
    assert bad.count() == 11
    assert {r.error_type for r in bad.collect()} == {"malformed_row", "cast_error"}
    assert "source_file" in bad.columns


def test_load_with_explicit_types_and_append(spark, write, table):
    path = write("a.csv", "k,v\n1,x\n2,y\n")
    for mode in ["fail", "append"]:
        stats = load_delimited(
            spark, path, table, ["k", "v"], Layout(), mode, types={"k": "bigint", "v": "string"}
        )
        assert stats.first().status == "Completed"
    assert spark.table(table).count() == 4
    with pytest.raises(ValueError):
        load_delimited(spark, path, table, ["k", "v"])


def test_ids_follow_the_files_and_go_on(spark, write, table, tmp_path):
    write("in/b.csv", "k\n" + "".join(f"b{i}\n" for i in range(500)))
    write("in/a.csv", "k\n" + "".join(f"a{i}\n" for i in range(700)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        for _ in range(2):
            load_delimited(
                spark, str(tmp_path / "in"), table, ["k"], types={"k": "string"},
                id_column="id", if_exists="append",
            )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = [(r.id, r.k) for r in spark.table(table).orderBy("id").collect()]
    once = [f"a{i}" for i in range(700)] + [f"b{i}" for i in range(500)]
    assert rows == list(enumerate(once + once, start=1))


def test_incremental_load_takes_each_file_once(spark, write, tmp_path):
    types = {"k": "int", "v": "string"}
    target, state = str(tmp_path / "target"), str(tmp_path / "state")

    def run():
        query = ingest_incremental(
            spark, str(tmp_path / "in"), target, state, types, required=["v"], files_per_batch=1
        )
        query.awaitTermination()

    write("in/a.csv", "k,v\n1,x\n2,y\n")
    write("in/b.csv", "k,v\n3,z\noops,w\n4,\n5,v,more\n")
    run()
    assert sorted(r.k for r in loaded_rows(spark, target, types).collect()) == [1, 2, 3]
    run()
    assert loaded_rows(spark, target, types).count() == 3
    write("in/c.csv", "k,v\n6,u\n")
    run()
    assert sorted(r.k for r in loaded_rows(spark, target, types).collect()) == [1, 2, 3, 6]
    errors = sorted(r.error_type for r in rejected_rows(spark, target, list(types)).collect())
    assert errors == ["cast_error", "malformed_row", "null_violation"]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.staging_path(spark, "x").startswith(folder + "/")
    assert workspace.staging_path(spark, "x") != workspace.staging_path(spark, "x")


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_of_a_session_without_one():
    with pytest.raises(ValueError):
        workspace.shared_folder(_Session("spark://cluster:7077"))
    local = _Session("local[2]")
    assert workspace.shared_folder(local) == workspace.shared_folder(local) == local.folder


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE made_by_test_db")
    yield "made_by_test_db"
    spark.sql("DROP DATABASE made_by_test_db CASCADE")


def test_append_refuses_unknown_columns(spark, database):
    name = f"{database}.grown"
    tables.write_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    with pytest.raises(ValueError, match="no column extra"):
        tables.write_table(spark.createDataFrame([(2, "b", "lost")], "k int, v string, extra string"), name, "append")
    tables.write_table(spark.createDataFrame([(3,)], "K int"), name, "append")
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (3, None)]


def test_failed_replace_keeps_the_table(spark, database):
    name = f"{database}.kept"
    tables.write_table(spark.range(3), name)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(broken, name, "replace")
    assert spark.table(name).count() == 3
    tables.write_table(spark.table(name).where("id > 0"), name, "replace")
    assert spark.table(name).count() == 2
    assert [t.name for t in spark.catalog.listTables(database) if "kept" in t.name] == ["kept"]


def test_load_with_an_id_column_of_its_own(spark, write, database):
    path = write("own/a.csv", "id,name\n7,x\n9,y\n")
    load_delimited(spark, path, f"{database}.own", ["id", "name"], id_column="id")
    assert sorted(map(tuple, spark.table(f"{database}.own").collect())) == [(7, "x"), (9, "y")]


def test_load_month_first_and_unique(spark, write, database):
    path = write("dates/a.csv", "k,d\n1,03/04/2024\n01,12/31/2024\n2,12/31/2024\n")
    stats = load_delimited(
        spark, path, f"{database}.dates", ["k", "d"], types={"k": "bigint", "d": "date"},
        day_first={"d": False}, unique_key=["k"],
    ).first()
    assert (stats.successful_rows, stats.failed_rows) == (2, 1)
    assert sorted((r.k, str(r.d)) for r in spark.table(f"{database}.dates").collect()) == [(1, "2024-03-04"), (2, "2024-12-31")]


def test_stream_month_first_layout_and_nothing_loaded(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    types = {"k": "int", "d": "date"}

    def run(**more):
        ingest_incremental(spark, str(source), target, str(tmp_path / "state"), types, **more).awaitTermination()

    run()
    assert loaded_rows(spark, target, types).count() == 0
    (source / "a.csv").write_text("k,d\n1,12/31/2024\nx,01/01/2024\n2,03/04/2024,more\n")
    run(day_first={"d": False})
    assert [(r.k, str(r.d)) for r in loaded_rows(spark, target, types).collect()] == [(1, "2024-12-31")]
    errors = sorted(r.error_type for r in rejected_rows(spark, target, types).collect())
    assert errors == ["cast_error", "malformed_row"]
    with pytest.raises(ValueError, match="header on top"):
        run(layout=Layout(header_row=1))
