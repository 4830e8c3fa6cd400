"""Messy inputs that Spark derives from the given tables; every row of a table takes part.

The modulo rules only decide *which defect* a row gets. They never leave rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from sluicegate.sources.delimited import Layout, parse_lines
from sluicegate.workspace import staging_path, tasks_for_small_work

# Messy orders -------------------------------------------------------------------------

ORDER_COLUMNS = ["order_id", "customer_id", "status", "amount", "order_date", "priority"]
ORDER_TYPES = {
    "order_id": "bigint",
    "customer_id": "bigint",
    "status": "string",
    "amount": "double",
    "order_date": "timestamp_ntz",
    "priority": "string",
}
ORDER_LAYOUT = Layout(sep=";", header=False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as text cells, some a second time, with the defects of a real export."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    twice = F.when(k % 31 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = orders.withColumn("copy", F.explode(twice))
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return rows.select(
        k.alias("k"),
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(k % 17 == 0, "NA").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 23 == 0, "bad").when(k % 19 == 0, "").otherwise(amount).alias("amount"),
        F.when(k % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


def messy_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy orders as delimited lines; some have a field too many."""
    rows = messy_orders(spark, sf_dir)
    line = F.concat_ws(";", *[F.col(c) for c in ORDER_COLUMNS])
    extra = F.when(F.col("k") % 29 == 0, F.lit(";EXTRA")).otherwise(F.lit(""))
    return rows.select(F.concat(line, extra).alias("line"))


def parsed_orders(spark: SparkSession, sf_dir: str, on_bad_lines: str = "warn") -> DataFrame:
    lines = messy_order_lines(spark, sf_dir)
    return parse_lines(lines, "line", ORDER_COLUMNS, ORDER_LAYOUT, on_bad_lines)


def messy_order_files(spark: SparkSession, sf_dir: str) -> str:
    """The messy lines as files in the shared folder."""
    path = staging_path(spark, "messy-orders")
    messy_order_lines(spark, sf_dir).write.text(path)
    return path


# Clean files --------------------------------------------------------------------------

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment",
    )


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")
    )


ORDER_FILE_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


def order_files(spark: SparkSession, sf_dir: str) -> str:
    """All orders as comma-separated files with a header."""
    path = staging_path(spark, "orders")
    order_cells(spark, sf_dir).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(path)
    return path


def customer_files(spark: SparkSession, sf_dir: str, header: bool) -> str:
    path = staging_path(spark, "customers")
    customer_cells(spark, sf_dir).write.option("header", header).csv(path)
    return path


ROWS_PER_FILE = 50


def file_number() -> Column:
    return F.expr(f"c_custkey div {ROWS_PER_FILE}").alias("file_no")


def written_by_file(rows: DataFrame, *order: str) -> DataFrameWriter:
    """A writer of one file for each file number, by all cores.

    The rows are few bytes and would come to a task or two unless the number of tasks is given.
    """
    dealt = rows.repartition(tasks_for_small_work(rows.sparkSession), "file_no").sortWithinPartitions("file_no", *order)
    return dealt.drop(*[c for c in order if c.startswith("_")]).write.partitionBy("file_no")


def preamble_files(spark: SparkSession, sf_dir: str, encoding: str = "UTF-8") -> str:
    """Customers in files of 50, each with two comment lines and a blank one above the header.

    In UTF-16 names end with a letter that has the byte of a line feed.
    """
    path = staging_path(spark, "preamble")
    cells = customer_cells(spark, sf_dir)
    if encoding != "UTF-8":
        cells = cells.withColumn("c_name", F.concat("c_name", F.lit("\u010a")))
    row = F.concat_ws(",", *[F.col(c).cast("string") for c in CUSTOMER_COLUMNS])
    lines = cells.select(file_number(), F.lit(4).alias("part"), "c_custkey", row.alias("line"))
    tops = [(1, "# customer extract"), (2, "# one row per customer"), (3, ""),
            (4, ",".join(CUSTOMER_COLUMNS))]
    top = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(t).alias("line")) for p, t in tops])
    heads = (
        cells.select(file_number())
        .distinct()
        .select("file_no", F.inline(top))
        .select("file_no", "part", F.lit(-1).cast("bigint").alias("c_custkey"), "line")
    )
    rows = lines.unionAll(heads).select("file_no", "line", F.col("part").alias("_part"), F.col("c_custkey").alias("_key"))
    written = written_by_file(rows, "_part", "_key")
    if encoding == "UTF-8":
        written.text(path)
    else:  # lines as they are: a separator and a quote that they do not hold
        written.options(sep="\u0001", quote="\u0000", emptyValue="", encoding=encoding).csv(path)
    return path


# File set in mixed dialects -----------------------------------------------------------

DIALECTS = [
    # (separator, encoding, header?, what is special about it)
    (",", "UTF-8", True, "plain"),
    (";", "ISO-8859-1", True, "plain"),
    ("\t", "UTF-8", False, "quoted"),  # a separator of the notes, on all lines alike, would win by the rule
    ("|", "UTF-16", True, "plain"),
    (",", "UTF-8", True, "byte-order mark and a column too many"),
    (";", "UTF-8", True, "lacks the segment"),
]
EXTRACT_COLUMNS = [
    "customer_id", "full_name", "nation", "balance", "opened", "segment", "note",
]


EXTRACT_TYPES = {
    "customer_id": "bigint", "full_name": "string", "nation": "int", "balance": "double",
    "opened": "date", "segment": "string", "note": "string", "channel": "string",
}


def extract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with a date and a note that holds separators."""
    customers = customer_cells(spark, sf_dir)
    return customers.select(
        file_number(),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.expr("date_add(date'2020-01-01', cast(c_custkey % 365 as int))").alias("opened"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("café, "), F.lower("c_mktsegment"), F.lit("; visit|call")).alias("note"),
    )


def mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """All customers in files of 50, the dialect going round by file number."""
    path = staging_path(spark, "mixed")
    rows = extract_rows(spark, sf_dir)
    for i, (sep, encoding, header, special) in enumerate(DIALECTS):
        part = rows.where(F.col("file_no") % len(DIALECTS) == i)
        names = list(EXTRACT_COLUMNS)
        if "lacks" in special:
            names.remove("segment")
        columns = [F.col(c) for c in names]
        if "byte-order" in special:
            columns[0] = F.col("customer_id").alias("\ufeffcustomer_id")
            columns.append(F.lit("web").alias("channel"))
        (
            written_by_file(part.select("file_no", *columns, F.col("customer_id").alias("_key")), "_key")
            .options(sep=sep, encoding=encoding, header=header, escape='"', quoteAll="quoted" in special)
            .csv(f"{path}/dialect={i}")
        )
    return path


def file_no_of(column: str = "file") -> Column:
    return F.regexp_extract(column, r"file_no=(\d+)", 1).cast("bigint").alias("file_no")


# Table and a changed copy -------------------------------------------------------------

def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders but those a fault lost; some prices are off by one."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.when(k % 103 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.where(k % 101 != 0).withColumn("o_totalprice", price)


# Contact columns ----------------------------------------------------------------------

def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with e-mail, phone, dates and times as text."""
    k = F.col("c_custkey")
    number = F.lpad(k.cast("string"), 9, "0")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+84 "), number).alias("phone"),
        F.date_format(F.expr("date_add(date'2020-01-01', cast(c_custkey % 1000 as int))"),
                      "dd.MM.yyyy").alias("birthday"),
        F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((k % 60).cast("string"), 2, "0")).alias("call_time"),
        F.concat(F.date_format(F.expr("date_add(date'2020-01-01', cast(c_custkey % 1000 as int))"),
                               "yyyy-MM-dd"), F.lit(" 10:20:30")).alias("created"),
        F.format_number(k * 1000 + 1, 0).alias("points"),
        F.when(k % 2 == 0, "true").otherwise("False").alias("active"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance"),
        (k + F.lit(3_000_000_000)).cast("string").alias("account"),
        F.lit(None).cast("string").alias("fax"),
        F.when(k % 4 == 0, F.col("c_mktsegment")).otherwise(F.lit("N/A")).alias("segment"),
    )
