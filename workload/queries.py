"""One callable per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions import names as N
from sluicegate.operators import cast, infer, profile, reconcile, tables, validate
from sluicegate.plans.analyze import analyze_files
from sluicegate.plans.profile import column_profile
from sluicegate.plans.load import load_delimited
from sluicegate.plans.mixed import scan_mixed
from sluicegate.plans.validation import validate_table, validation_report
from sluicegate.sources import delimited, dialect, files
from sluicegate.sources.delimited import Layout
from sluicegate.sources.heads import head_lines
from sluicegate.streaming.ingest import ingest_incremental, loaded_rows
from sluicegate.streaming.tables import load_incremental
from sluicegate.workspace import staging_path
from workload import fixtures as X
from workload.fixtures import table

PARSE_TYPES = {**X.ORDER_TYPES, "order_date": "string"}


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Doubles rounded, so that the order of addition does not show."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# -- flagship ---------------------------------------------------------------------------


def messy_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How clean is this load? Totals, errors by type and missing values in one report."""
    classified = cast.classify(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    return cast.load_report(classified, X.ORDER_COLUMNS)


# -- scans, sources, sinks --------------------------------------------------------------


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.order_files(spark, sf_dir)
    rows = delimited.scan_delimited(spark, path, list(X.ORDER_FILE_TYPES))
    return cast.typed_cast(rows, X.ORDER_FILE_TYPES)


def csv_delimiter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = dialect.delimiter_report(spark, X.mixed_files(spark, sf_dir))
    return report.select(X.file_no_of(), "delimiter")


def csv_encoding_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = dialect.encoding_report(spark, X.mixed_files(spark, sf_dir))
    return report.select(X.file_no_of(), "encoding")


def csv_header_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = dialect.header_report(spark, X.mixed_files(spark, sf_dir))
    return report.select(
        X.file_no_of(), "has_header", "num_columns",
        F.concat_ws(",", "column_names").alias("column_names"),
    )


def csv_header_row_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.preamble_files(spark, sf_dir)
    layout = Layout(header_row=2)
    rows = delimited.scan_delimited(spark, path, X.CUSTOMER_COLUMNS, layout)
    return cast.typed_cast(rows, X.CUSTOMER_TYPES)


def csv_no_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.customer_files(spark, sf_dir, header=False)
    names = delimited.positional_names(len(X.CUSTOMER_COLUMNS))
    rows = delimited.scan_delimited(spark, path, names, Layout(header=False))
    return cast.typed_cast(rows, dict(zip(names, X.CUSTOMER_TYPES.values())))


def csv_skip_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.messy_order_files(spark, sf_dir)
    rows = delimited.scan_delimited(
        spark, path, X.ORDER_COLUMNS, X.ORDER_LAYOUT, on_bad_lines="skip"
    )
    return cast.typed_cast(rows, X.ORDER_TYPES)


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.sample_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 1000)


def csv_head_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.preamble_files(spark, sf_dir)
    return head_lines(spark, path, 5).select(X.file_no_of(), "line_no", F.col("value").alias("line"))


def _fresh_table(label: str) -> str:
    return f"sluicegate_{label}_{uuid.uuid4().hex}"


def _fresh_database(spark: SparkSession) -> str:
    """A database of its own in the shared folder."""
    name = _fresh_table("db")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{staging_path(spark, 'database')}'")
    return name


def table_write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, then their changed copy with the columns in another order."""
    name, path = _fresh_table("append"), staging_path(spark, "append")
    tables.write_table(table(spark, sf_dir, "orders"), name, "append", path)
    copy = X.changed_orders(spark, sf_dir)
    tables.write_table(copy.select(*reversed(copy.columns)), name, "append", path)
    spark.sql(f"DROP TABLE {name}")  # the files of an external table stay
    return spark.read.parquet(path)


def table_write_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _fresh_table("replace"), staging_path(spark, "replace")
    tables.write_table(table(spark, sf_dir, "customer"), name, "fail", path)
    tables.write_table(table(spark, sf_dir, "orders"), name, "replace", path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


def table_write_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was, and whether the second write was refused."""
    name, path = _fresh_table("fail"), staging_path(spark, "fail")
    tables.write_table(table(spark, sf_dir, "customer"), name, "fail", path)
    try:
        tables.write_table(table(spark, sf_dir, "orders"), name, "fail", path)
        refused = False
    except AnalysisException:
        refused = True
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


def add_surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return tables.add_surrogate_id(orders, ["o_orderdate", "o_orderkey"])


def csv_utf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers from UTF-16 files with lines above the header and the byte of a line feed in letters."""
    path = X.preamble_files(spark, sf_dir, "UTF-16")
    layout = Layout(header_row=2, encoding="UTF-16")
    return cast.typed_cast(delimited.scan_delimited(spark, path, X.CUSTOMER_COLUMNS, layout), X.CUSTOMER_TYPES)


def ingest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders into a table by two runs of an incremental load, files coming in between; ids without gaps."""
    path, state = staging_path(spark, "orders-coming"), staging_path(spark, "table-state")
    name = f"{_fresh_database(spark)}.orders"
    for half in (0, 1):
        part = X.order_cells(spark, sf_dir).where(F.col("o_orderkey") % 2 == half)
        part.write.mode("append").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
        load_incremental(
            spark, path, name, state, id_column="ID", files_per_batch=2,
            overrides={"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_totalprice": "DOUBLE", "o_orderdate": "DATETIME"},
        ).awaitTermination()
    loaded = spark.table(name)
    facts = loaded.agg(F.min("ID").alias("low"), F.max("ID").alias("high"), F.count_distinct("ID").alias("ids"), F.count(F.lit(1)).alias("n"))
    dense = (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("ids") == F.col("n"))
    return loaded.drop("ID", "load_batch").withColumn("ids_dense", facts.select(dense).scalar())


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.order_files(spark, sf_dir)
    target, state = staging_path(spark, "ingested"), staging_path(spark, "ingest-state")
    query = ingest_incremental(
        spark, path, target, state, X.ORDER_FILE_TYPES, files_per_batch=2
    )
    query.awaitTermination()
    return loaded_rows(spark, target, X.ORDER_FILE_TYPES)


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = cast.classify(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    return cast.quarantine_rows(classified, X.ORDER_COLUMNS).drop(
        "error_timestamp", "source_file"
    )


def quarantine_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by type with a unique order key and a required status."""
    numbered = X.parsed_orders(spark, sf_dir).withColumn("row_no", F.monotonically_increasing_id())
    place = staging_path(spark, "numbered")
    numbered.write.parquet(place)  # the numbers are the same wherever they are read
    rows = spark.read.schema(numbered.schema).parquet(place)
    classified = cast.classify(rows, PARSE_TYPES, required=["status"])
    marked = cast.mark_duplicate_keys(classified, ["order_id"], "row_no")
    return cast.error_stats(marked)


def error_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.error_stats(cast.classify(X.parsed_orders(spark, sf_dir), PARSE_TYPES))


def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.load_stats(cast.classify(X.parsed_orders(spark, sf_dir), PARSE_TYPES))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = files.file_inventory(spark, X.preamble_files(spark, sf_dir))
    return report.select(X.file_no_of(), "extension", "file_size", "size_text", "estimated_rows")


def load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to table: scan, infer, type, number, write, quarantine; then read the table."""
    path = X.messy_order_files(spark, sf_dir)
    name = f"{_fresh_database(spark)}.orders"
    load_delimited(
        spark, path, name, X.ORDER_COLUMNS, X.ORDER_LAYOUT,
        overrides={"amount": "DOUBLE", "order_id": "BIGINT", "customer_id": "BIGINT",
                   "order_date": "DATETIME"},
        required=["order_id"],
        id_column="id", id_order=["order_id"],
        quarantine_path=staging_path(spark, "rejected"),
    )
    return spark.table(name)


def load_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers from files of six dialects, matched by column name."""
    rows = scan_mixed(spark, X.mixed_files(spark, sf_dir), X.EXTRACT_COLUMNS)
    absent = [c for c in X.EXTRACT_TYPES if c not in rows.columns]  # few files: not every dialect
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent})
    return cast.typed_cast(rows, X.EXTRACT_TYPES)


def load_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose files bring the id column that the load would add."""
    path = staging_path(spark, "own-ids")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus")
    orders.write.option("header", True).csv(path)
    name = f"{_fresh_database(spark)}.own_ids"
    load_delimited(spark, path, name, orders.columns, Layout(), id_column="id")
    return spark.table(name)


def stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in lines with a quote inside a field; every seventh has a field too many."""
    path = staging_path(spark, "stray")
    more = F.when(F.col("o_orderkey") % 7 == 0, ';3" bolt').otherwise("")
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(';5" pipe;'), "o_orderstatus", more)
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    rows = delimited.scan_delimited(spark, path, ["id", "item", "status"], Layout(sep=";", header=False))
    return rows.select(F.col("id").cast("bigint").alias("id"), "item", "status", F.col("_bad_line").isNotNull().alias("bad"))


def analyze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout and schema of the customer files, nothing given but the folder."""
    report = analyze_files(spark, X.customer_files(spark, sf_dir, header=True))
    return report.select(
        "position", "column_name", "sql_type", "nullable", "max_length",
        "encoding", "delimiter", "has_header",
    )


# -- inference --------------------------------------------------------------------------


def _inference_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.messy_orders(spark, sf_dir).select(*X.ORDER_COLUMNS)


def infer_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = infer.infer_column_types(_inference_input(spark, sf_dir))
    contacts = infer.infer_column_types(X.contacts(spark, sf_dir))
    return orders.unionAll(contacts)


def infer_nullability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.infer_nullability(_inference_input(spark, sf_dir))


def infer_varchar_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source")
    customers = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    return infer.infer_varchar_bucket(documents).unionAll(infer.infer_varchar_bucket(customers))


def infer_semantic_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = infer.infer_semantic_type(_inference_input(spark, sf_dir))
    return orders.unionAll(infer.infer_semantic_type(X.contacts(spark, sf_dir)))


def likely_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = infer.likely_datetime(_inference_input(spark, sf_dir))
    return orders.unionAll(infer.likely_datetime(X.contacts(spark, sf_dir)))


def likely_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = infer.likely_numeric(_inference_input(spark, sf_dir))
    return orders.unionAll(infer.likely_numeric(X.contacts(spark, sf_dir)))


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.typed_cast(_inference_input(spark, sf_dir), X.ORDER_TYPES)


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.schema_report(_inference_input(spark, sf_dir), key="order_id")


def schema_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _inference_input(spark, sf_dir)
    report = infer.schema_report(rows, overrides={"amount": "decimal(12,2)", "customer_id": "bigint", "priority": "SMALLINT"})
    return report.select("position", "column_name", "sql_type", "spark_type")


def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    turns = table(spark, sf_dir, "conversations").select(F.col("text").alias("name"))
    names = parts.unionAll(turns).distinct()
    return names.select("name", N.sanitize_name(F.col("name")).alias("sanitized"))


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    turns = table(spark, sf_dir, "conversations").select(F.col("text").alias("name"))
    nothing = spark.range(1).select(F.lit(None).cast("string").alias("name"))
    names = parts.unionAll(turns).distinct().unionAll(nothing)
    return names.select("name", N.normalize_name(F.col("name")).alias("normalized"))


# -- profiles ---------------------------------------------------------------------------


def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.column_stats(table(spark, sf_dir, "lineitem")))


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast.typed_cast(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    return profile.null_counts(rows).select("position", "column_name", "null_count")


def null_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast.typed_cast(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    return profile.null_counts(rows).select("column_name", "null_percentage")


def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast.typed_cast(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    return profile.table_summary(rows)


def unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = profile.unique_counts(table(spark, sf_dir, "orders"))
    return orders.unionAll(profile.unique_counts(table(spark, sf_dir, "documents")))


def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, and orders with whole numbers and decimals that no floating-point number holds."""
    k = F.col("o_orderkey")
    big = table(spark, sf_dir, "orders").select(
        (k * 3 + F.lit(9007199254740993)).alias("big"),
        (F.col("o_totalprice").cast("decimal(18,2)") + F.lit("100000000000000000000").cast("decimal(21,0)"))
        .cast("decimal(38,2)")
        .alias("wide"),
    )
    items = profile.numeric_summary(table(spark, sf_dir, "lineitem"))
    return rounded(items.unionAll(profile.numeric_summary(big)), 4)


def string_avg_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = profile.string_lengths(table(spark, sf_dir, "documents"))
    return rounded(lengths.select("column_name", "avg_length"), 4)


def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = profile.top_values(table(spark, sf_dir, "orders"))
    parts = profile.top_values(table(spark, sf_dir, "part"))
    documents = profile.top_values(table(spark, sf_dir, "documents"))
    return orders.unionAll(parts).unionAll(documents)


def data_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = profile.data_size(table(spark, sf_dir, "documents"))
    orders = profile.data_size(table(spark, sf_dir, "orders"))
    return documents.select(F.lit("documents").alias("table_name"), "*").unionAll(
        orders.select(F.lit("orders").alias("table_name"), "*")
    )


def full_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast.typed_cast(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    report = column_profile(rows).withColumn("top_values", F.to_json("top_values"))
    return rounded(report, 4)


# -- validation -------------------------------------------------------------------------


def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed copy of the orders against the size of the orders, and without a size."""
    expected = table(spark, sf_dir, "orders").count()
    copy = X.changed_orders(spark, sf_dir)
    return validate.check_row_count(copy, expected).unionAll(validate.check_row_count(copy))


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return validate.duplicate_groups(lines, ["l_orderkey", "l_linenumber"])


def duplicate_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        ("lineitem", ["l_orderkey", "l_linenumber"]),
        ("documents", ["text"]),
        ("conversations", ["conv_id", "turn"]),
    ]
    report = None
    for name, columns in checks:
        part = validate.duplicate_total(table(spark, sf_dir, name), columns)
        part = part.select(F.lit(name).alias("table_name"), "*")
        report = part if report is None else report.unionAll(part)
    return report


def compare_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = delimited.scan_delimited(
        spark, X.order_files(spark, sf_dir), list(X.ORDER_FILE_TYPES)
    )
    return validate.compare_row_counts(source, X.changed_orders(spark, sf_dir))


def compare_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, copy = table(spark, sf_dir, "orders"), X.changed_orders(spark, sf_dir)
    return (
        validate.compare_status(orders, orders)
        .unionAll(validate.compare_status(orders, copy))
        .unionAll(validate.compare_status(orders, orders.drop("o_orderpriority")))
    )


def column_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = dialect.header_report(spark, X.mixed_files(spark, sf_dir))
    diff = dialect.column_set_diff(headers, X.EXTRACT_COLUMNS)
    return diff.select(X.file_no_of(), "status", "column_name")


def sample_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, copy = table(spark, sf_dir, "orders"), X.changed_orders(spark, sf_dir)
    report = reconcile.sample_comparison(orders, copy, ["o_orderkey"])
    return report.select("column_name", "match")


def reconcile_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, copy = table(spark, sf_dir, "orders"), X.changed_orders(spark, sf_dir)
    return reconcile.reconcile_by_key(orders, copy, ["o_orderkey"])


def reconcile_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, copy = table(spark, sf_dir, "orders"), X.changed_orders(spark, sf_dir)
    return reconcile.reconcile_multiset(orders, copy)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, copy = table(spark, sf_dir, "orders"), X.changed_orders(spark, sf_dir)
    report = validation_report(copy, orders, duplicate_columns=["o_orderkey"], order_by=["o_orderkey"])
    # JSON differs in the writing of numbers: the keys of rows and values tell
    key = F.get_json_object("detail", "$.o_orderkey")
    return rounded(report).withColumn("detail", F.when(F.col("test") == "sample_data", key))


def validated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a table that is in order, of one with a column that cannot be read, and of none."""
    database = _fresh_database(spark)
    orders = table(spark, sf_dir, "orders")
    orders.write.saveAsTable(f"{database}.good")
    spark.sql(
        f"CREATE VIEW {database}.broken AS SELECT o_orderkey, o_custkey, "
        f"CAST(raise_error('unreadable') AS DOUBLE) AS o_totalprice FROM {database}.good"
    )
    reports = [
        validate_table(
            spark, f"{database}.{name}", orders, duplicate_columns=["o_orderkey"], order_by=["o_orderkey"]
        ).select(F.lit(name).alias("subject"), "test", "status", "metric", F.round("value", 2).alias("value"))
        for name in ("good", "broken", "missing")
    ]
    return reports[0].unionAll(reports[1]).unionAll(reports[2])


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = cast.classify(X.parsed_orders(spark, sf_dir), PARSE_TYPES)
    rows = cast.loaded_and_rejected(classified, X.ORDER_COLUMNS)
    return validate.quality_gate(
        rows, F.col("is_good"), required=["order_id", "status"], unique_key=["order_id"]
    )


def table_stats_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a database with three tables; sizes depend on the writer and are left out."""
    database = _fresh_database(spark)
    for name in ["orders", "customer", "part"]:
        tables.write_table(table(spark, sf_dir, name), f"{database}.{name}")
    stats = tables.table_stats_report(spark, database)
    return stats.select(
        "table_name", "row_count", "column_count", (F.col("size_bytes") > 0).alias("has_bytes")
    )


QUERIES = {
    "messy_load_report": messy_load_report,
    "csv_scan": csv_scan,
    "csv_delimiter_report": csv_delimiter_report,
    "csv_encoding_report": csv_encoding_report,
    "csv_header_report": csv_header_report,
    "csv_header_row_skip": csv_header_row_skip,
    "csv_no_header": csv_no_header,
    "csv_skip_bad_lines": csv_skip_bad_lines,
    "sample_rows": sample_rows,
    "csv_head_per_file": csv_head_per_file,
    "table_write_append": table_write_append,
    "table_write_replace": table_write_replace,
    "table_write_fail": table_write_fail,
    "add_surrogate_id": add_surrogate_id,
    "ingest_incremental": ingest,
    "ingest_table": ingest_table,
    "csv_utf16": csv_utf16,
    "quarantine_rows": quarantine_rows,
    "quarantine_keys": quarantine_keys,
    "error_stats": error_stats,
    "load_stats": load_stats,
    "file_inventory": file_inventory,
    "load_delimited": load_files,
    "load_mixed_files": load_mixed_files,
    "load_with_id": load_with_id,
    "csv_stray_quotes": stray_quotes,
    "analyze_files": analyze,
    "infer_column_types": infer_column_types,
    "infer_nullability": infer_nullability,
    "infer_varchar_bucket": infer_varchar_bucket,
    "infer_semantic_type": infer_semantic_type,
    "likely_datetime": likely_datetime,
    "likely_numeric": likely_numeric,
    "typed_cast": typed_cast,
    "schema_report": schema_report,
    "schema_override": schema_override,
    "sanitize_names": sanitize_names,
    "normalize_names": normalize_names,
    "column_stats": column_stats,
    "null_counts": null_counts,
    "null_percentage": null_percentage,
    "table_summary": table_summary,
    "unique_counts": unique_counts,
    "numeric_summary": numeric_summary,
    "string_avg_length": string_avg_length,
    "top_values": top_values,
    "data_size": data_size,
    "column_profile": full_profile,
    "check_row_count": check_row_count,
    "duplicate_groups": duplicate_groups,
    "duplicate_total": duplicate_total,
    "compare_row_counts": compare_row_counts,
    "compare_status": compare_status,
    "column_set_diff": column_set_diff,
    "sample_comparison": sample_comparison,
    "reconcile_by_key": reconcile_by_key,
    "reconcile_multiset": reconcile_multiset,
    "validation_report": report,
    "validate_table": validated_tables,
    "quality_gate": quality_gate,
    "table_stats_report": table_stats_report,
}
