"""Column and table profiles.

Counts and numeric statistics of all columns come from one aggregate over the table
(one scan, one row per task shuffled). Distinct counts and frequent values come from one
grouping by (column, value), whose map-side aggregation absorbs a value that fills a
third of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.rows import grouping_keys, value_key
from sluicegate.functions.sizes import size_text
from sluicegate.workspace import ship, staged, stages_removed

FLOATING = (T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type; booleans are not numbers here."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN in floating-point columns."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return df[name].isNull() | F.isnan(df[name])
    return df[name].isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with missing values as NULL, so aggregates skip them."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(df[name]), df[name])
    return df[name]


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum that neither overflows nor loses digits for integers and decimals."""
    kind = df.schema[name].dataType
    value = present(df, name)
    if isinstance(kind, T.IntegralType):
        digits = 10 if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)) else 20
        value = value.cast(T.DecimalType(digits, 0))
    return F.sum(value)


# Wider aggregates outgrow compiled code; column groups read disjoint columns, so a
# columnar table is still read once.
COLUMNS_PER_PASS = 60


def one_pass(
    df: DataFrame, columns: Sequence[str], facts: dict, whole: dict | None = None
) -> DataFrame:
    """One aggregate over ``df`` (one per 60 columns), returned as one row per column.

    ``facts`` maps an output name to ``f(name) -> aggregate``; ``whole`` maps an output
    name to an aggregate over the table, repeated on every row.
    """
    whole = whole or {}
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        group = list(enumerate(columns[start : start + COLUMNS_PER_PASS], start))
        aggregates = [agg.alias(f"w_{key}") for key, agg in whole.items()]
        for i, name in group:
            aggregates += [fact(name).alias(f"c{i}_{key}") for key, fact in facts.items()]
        entries = [
            F.struct(
                F.lit(i + 1).cast("bigint").alias("position"),
                F.lit(name).alias("column_name"),
                *[F.col(f"w_{key}").alias(key) for key in whole],
                *[F.col(f"c{i}_{key}").alias(key) for key in facts],
            )
            for i, name in group
        ]
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*entries))))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionAll(part)
    return report


def _count_missing(df: DataFrame):
    return lambda name: F.count_if(is_missing(df, name))


def _nothing(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum, mean, sum and counts of every numeric column."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    if not columns:
        return _nothing(
            df,
            "column_name string, min_val double, max_val double, avg_val double, "
            "sum_val double, count_val bigint, non_null_count bigint",
        )
    report = one_pass(
        df,
        columns,
        {
            "min_val": lambda c: F.min(present(df, c)).cast("double"),
            "max_val": lambda c: F.max(present(df, c)).cast("double"),
            "sum_val": lambda c: exact_sum(df, c).cast("double"),
            "non_null_count": lambda c: F.count(present(df, c)),
        },
        {"count_val": F.count(F.lit(1))},
    )
    return report.select(
        "column_name",
        "min_val",
        "max_val",
        F.expr("try_divide(sum_val, non_null_count)").alias("avg_val"),
        "sum_val",
        "count_val",
        "non_null_count",
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column and their share of the rows in percent (two decimals)."""
    columns = list(columns) if columns is not None else df.columns
    report = one_pass(
        df,
        columns,
        {"null_count": _count_missing(df)},
        {"row_count": F.count(F.lit(1))},
    )
    share = F.when(F.col("row_count") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("null_count") * F.lit(100.0) / F.col("row_count"), 2)
    )
    return report.select(
        "position", "column_name", "row_count", "null_count", share.alias("null_percentage")
    )


def string_lengths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean and longest length (characters) of text columns over the values present."""
    columns = list(columns) if columns is not None else string_columns(df)
    if not columns:
        return _nothing(df, "column_name string, avg_length double, max_length bigint")
    return one_pass(
        df,
        columns,
        {
            "avg_length": lambda c: F.coalesce(F.avg(F.length(df[c])), F.lit(0.0)),
            "max_length": lambda c: F.max(F.length(df[c])).cast("bigint"),
        },
    ).select("column_name", "avg_length", "max_length")


# --------------------------------------------------------------------------- medians

#: Leading bits of a key that the first scan tells apart at least, and those that the second does.
FIRST_BITS, SECOND_BITS = 20, 42
#: Buckets that a further scan cuts the keys around a median into, unless too many bits would be left.
KEY_BUCKETS = 1 << 16
#: Rows around a median up to which keys are counted one by one, however far apart.
MEDIAN_GROUP_LIMIT = 1 << 16
_LEAST_KEY, _LAST_KEY = -(1 << 63), (1 << 63) - 1


def is_exact(kind: T.DataType) -> bool:
    """Whether values of a type are written as they are by a decimal number."""
    return isinstance(kind, (T.IntegralType, T.DecimalType))


def _is_wide(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.precision > 18


def _number(kind: T.DataType, key: int) -> Decimal | float:
    """The value that a key was made of."""
    if isinstance(kind, T.IntegralType):
        return Decimal(key)
    if isinstance(kind, T.DecimalType):
        return Decimal(key).scaleb(-kind.scale)
    return float(np.array([key if key >= 0 else key ^ _ORDERED], np.int64).view(np.float64)[0])


_ORDERED = (1 << 63) - 1
_GROUPS = "idx int, prefix long, text string, task int, rows long, low long, high long, mean double, squares double"


def order_keys(values: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the values: whole numbers as they are, of doubles their bits.

    The bits of a positive double are in its order, those of a negative one in the opposite.
    """
    if values.dtype.kind == "i":
        return values.astype(np.int64)
    bits = (values.astype(np.float64) + 0.0).view(np.int64)  # one zero
    return np.where(bits < 0, bits ^ np.int64(_ORDERED), bits)


@dataclass
class _Moments:
    """Count, extreme keys, mean and sum of squared distances of the numbers of one task.

    Keys are taken from the first one on, so that large whole numbers lose nothing.
    """

    n: int = 0
    low: int = 0
    high: int = 0
    start: int = 0
    mean: float = 0.0
    squares: float = 0.0

    def add(self, keys: np.ndarray, values: np.ndarray | None) -> None:
        low, high = int(keys.min()), int(keys.max())
        if not self.n:
            self.low, self.high, self.start = low, high, int(keys[0])
        self.low, self.high = min(low, self.low), max(high, self.high)
        if values is None:
            near = max(high - self.start, self.start - low) < 1 << 62
            values = (keys - np.int64(self.start) if near else keys.astype(float) - self.start).astype(float)
        with np.errstate(invalid="ignore", over="ignore"):
            mean = float(values.mean())
            squares = float(((values - mean) ** 2).sum())
            n, apart = self.n + len(keys), mean - self.mean
            self.squares += squares + apart * apart * (self.n * len(keys) / n)
            self.mean += apart * (len(keys) / n) if self.n else mean
        self.n = n


def _buckets(keys: np.ndarray, low: int, width: int) -> np.ndarray:
    """Which bucket of ``width`` keys from ``low`` on each key is in; differences may need all 64 bits."""
    return ((keys.view(np.uint64) - np.uint64(low % (1 << 64))) // np.uint64(width)).astype(np.int64)


def _width(found: tuple[list[tuple[int, int]], float], bits: int, group_limit: int) -> int:
    """Keys in a bucket of the spans (first key, last key) that hold so many rows; see :func:`number_facts`."""
    spans, rows = found
    keys = sum(high - low + 1 for low, high in spans)
    return 1 if rows <= group_limit else min(1 << (64 - bits), -(-keys // KEY_BUCKETS))


def _key_groups(
    df: DataFrame, columns: Sequence[str], near: dict[int, tuple], lows: dict | None, bits: int, group_limit: int
) -> DataFrame:
    """Rows by buckets of their keys, counted where they are read: idx, prefix (the least key), rows, ...

    ``near`` has the spans of keys that are read of a column, and the rows in them. A task holds a
    counter for each of 2**16 buckets, or the keys of few rows; finer buckets are counted batch by
    batch. All 64 bits of a wide decimal do not tell its value, so its text comes along then. ``lows``
    asks for moments too: one row without prefix for each task and column, of distances from
    ``lows`` for wide decimals.
    """
    widths = {i: _width(found, bits, group_limit) for i, found in near.items()}
    spans, few = {i: found[0] for i, found in near.items()}, {i for i, found in near.items() if found[1] <= group_limit}
    kinds = {i: df.schema[c].dataType for i, c in enumerate(columns) if i in spans}
    wide = {i for i, kind in kinds.items() if _is_wide(kind)}
    texts_of = {i for i in wide if widths[i] == 1}
    chosen = []
    for i, kind in kinds.items():
        number = present(df, columns[i])
        if isinstance(kind, T.DecimalType) and i not in wide:
            number = number * F.lit(10**kind.scale).cast(T.DecimalType(kind.scale + 1, 0))
        chosen.append(number.cast("bigint" if is_exact(kind) and i not in wide else "double").alias(f"k{i}"))
        if i in wide and lows is not None:
            chosen.append((present(df, columns[i]) - F.lit(lows.get(columns[i]) or 0).cast(kind)).cast("double").alias(f"v{i}"))
        if i in texts_of:
            chosen.append(present(df, columns[i]).cast("string").alias(f"t{i}"))
    whole = {i for i, kind in kinds.items() if is_exact(kind) and i not in wide}

    def batch_of(idx: int, prefix, rows, text=None) -> pa.RecordBatch:
        n = len(rows)
        none = lambda kind: pa.nulls(n, kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, idx, np.int32)), pa.array(prefix, pa.int64()),
                none(pa.string()) if text is None else text, pa.array(np.full(n, -1, np.int32)), pa.array(rows, pa.int64()),
                none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()),
            ],
            [field.split()[0] for field in _GROUPS.split(", ")],
        )

    def first_keys(buckets: np.ndarray, low: int, width: int) -> np.ndarray:
        return (np.uint64(low % (1 << 64)) + buckets.astype(np.uint64) * np.uint64(width)).view(np.int64)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, held = {i: _Moments() for i in kinds}, {}
        for batch in batches:
            for i in kinds:
                column = batch.column(f"k{i}")
                there = column.is_valid()
                keys = order_keys(column.drop_null().to_numpy(zero_copy_only=False))
                if not len(keys):
                    continue
                if lows is not None:
                    values = batch.column(f"v{i}" if i in wide else f"k{i}").filter(there)
                    moments[i].add(keys, None if i in whole else values.to_numpy(zero_copy_only=False))
                for place, (low, high) in enumerate(spans[i]):
                    kept = (keys >= low) & (keys <= high)
                    if not kept.any():
                        continue
                    ours = keys[kept]
                    if i in texts_of:
                        texts = batch.column(f"t{i}").filter(there).filter(pa.array(kept))
                        counted = pa.table({"key": ours, "text": texts}).group_by(["key", "text"]).aggregate([([], "count_all")])
                        yield batch_of(i, counted["key"].to_numpy(), counted["count_all"].to_numpy(), counted["text"].combine_chunks())
                    elif (size := -(-(high - low + 1) // widths[i])) <= KEY_BUCKETS:
                        if (i, place) not in held:
                            held[i, place] = np.zeros(size, np.int64)
                        held[i, place] += np.bincount(_buckets(ours, low, widths[i]), minlength=size)
                    elif i in few:
                        held.setdefault((i, place), []).append(ours)
                    else:
                        buckets, counted = np.unique(_buckets(ours, low, widths[i]), return_counts=True)
                        yield batch_of(i, first_keys(buckets, low, widths[i]), counted)
        for (i, place), found in held.items():
            if isinstance(found, list):
                yield batch_of(i, *np.unique(np.concatenate(found), return_counts=True))
            else:
                there = np.flatnonzero(found)
                yield batch_of(i, first_keys(there, spans[i][place][0], widths[i]), found[there])
        task = TaskContext.get().partitionId()
        rows = [
            (i, None, None, task, m.n, m.low, m.high, m.mean + (m.start - m.low if i in whole else 0.0), m.squares)
            for i, m in moments.items()
            if lows is not None and m.n
        ]
        if rows:
            types = [pa.int32(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)],
                [field.split()[0] for field in _GROUPS.split(", ")],
            )

    ship(df.sparkSession)
    counted = df.select(*chosen).mapInArrow(step, _GROUPS)
    return counted.groupBy("idx", "prefix", "text", "task").agg(
        F.sum("rows").alias("rows"), *[F.max(c).alias(c) for c in ("low", "high", "mean", "squares")]
    )


def _middle(groups: DataFrame, by: list[str], below: dict[int, int], ranks: dict[int, tuple[int, int]] | None) -> DataFrame:
    """Groups (idx, rows, ...) that hold their column's middle rows, with the rows before them.

    ``below`` are the rows in front of all groups of a column; ``ranks`` the places of its middle
    rows, else the middle of the groups themselves. Groups are few for every column: prefixes, or
    the values that share one.
    """
    order = Window.partitionBy("idx").orderBy(*by)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    front = F.lit(0)
    for i, rows in below.items():
        front = F.when(F.col("idx") == i, rows).otherwise(front)
    placed = groups.withColumn("upto", F.sum("rows").over(running) + front).withColumn("below", F.col("upto") - F.col("rows"))
    if ranks is None:
        n = F.sum("rows").over(Window.partitionBy("idx"))
        first, last = F.expr("(n - 1) div 2"), F.expr("n div 2")
        placed = placed.withColumn("n", n)
    else:
        first = last = F.lit(0)
        for i, (one, two) in ranks.items():
            first = F.when(F.col("idx") == i, one).otherwise(first)
            last = F.when(F.col("idx") == i, two).otherwise(last)
    return placed.withColumn("middle", (F.col("below") <= last) & (first < F.col("upto")))


def number_facts(df: DataFrame, columns: Sequence[str], group_limit: int = MEDIAN_GROUP_LIMIT) -> dict[str, dict]:
    """Count, extremes, mean, sample deviation and exact median of numeric columns.

    Values become 64-bit keys in their order, made and counted where they are read (numpy on Arrow
    batches; only counters leave a task). The first scan counts keys by their first bits and takes
    all other facts along. Where more than ``group_limit`` rows share the bucket of a median, a second scan
    cuts the keys there, between the column's extremes, into 2**16 buckets, or as many more as let a
    third scan count single keys. So there are three scans at most, whatever the values are; a
    column has 2**16 counters in each, and only a column with more than 2**32 possible keys and
    very many different ones in one bucket has up to 2**22. No column is gathered anywhere, and a
    few rows per column reach the driver.
    Wide decimals take one aggregate more for their exact extremes.
    """
    columns, kinds = list(columns), {i: df.schema[c].dataType for i, c in enumerate(columns)}
    facts = {c: {"n": 0, "low": None, "high": None, "mean": None, "deviation": None, "median": None} for c in columns}
    wide = [c for i, c in enumerate(columns) if _is_wide(kinds[i])]
    if wide:
        ends = df.agg(*[f(df[c]) for c in wide for f in (F.min, F.max)]).first()
        for k, c in enumerate(wide):
            facts[c] |= {"low": ends[2 * k], "high": ends[2 * k + 1]}
    whole = [i for i in kinds if is_exact(kinds[i]) and not _is_wide(kinds[i])]
    with stages_removed(df.sparkSession):
        lows = {c: facts[c]["low"] for c in wide}
        groups = staged(
            _key_groups(df, columns, {i: ([(_LEAST_KEY, _LAST_KEY)], math.inf) for i in kinds}, lows, FIRST_BITS, group_limit),
            "number-groups",
        )
        near_rows = _middle(groups.where("prefix IS NOT NULL"), ["prefix"], {}, None).where("middle").collect()
        moments = groups.where("prefix IS NULL").drop("prefix")  # a row for every task and column
        column = Window.partitionBy("idx")
        # means of whole numbers are taken from the column's least key on
        exact = F.col("idx").isin(whole) if whole else F.lit(False)
        apart = F.col("low").cast("decimal(20,0)") - F.min("low").over(column).cast("decimal(20,0)")
        mean = F.when(exact, F.col("mean") + apart.cast("double")).otherwise(F.col("mean"))
        placed = moments.withColumn("mean", mean)
        centre = F.sum(F.col("rows") * F.col("mean")).over(column) / F.sum("rows").over(column)
        found = (
            placed.withColumn("centre", centre)
            .groupBy("idx")
            .agg(
                F.sum("rows").alias("n"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
                F.max("centre").alias("mean"),
                F.sum(F.col("squares") + F.col("rows") * (F.col("mean") - F.col("centre")) ** 2).alias("squares"),
            )
            .collect()
        )
    ranks, below, near, ends = {}, {}, {}, {}

    def keep(i: int, groups: list, width: int, low: int, high: int) -> None:
        spans = [(max(low, g["prefix"]), min(high, g["prefix"] + width - 1)) for g in groups]
        near[i] = spans, sum(g["rows"] for g in groups)
        below[i] = min(g["below"] for g in groups)

    for r in found:
        i, n = r["idx"], r["n"]
        ranks[i] = (n - 1) // 2, n // 2
        ends[i] = r["low"], r["high"]
        keep(i, [g for g in near_rows if g["idx"] == i], 1 << (64 - FIRST_BITS), *ends[i])  # at most two
        fact, mean = facts[columns[i]], r["mean"]
        deviation = math.sqrt(r["squares"] / (n - 1)) if n > 1 else None
        if i in whole:
            unit = 10 ** getattr(kinds[i], "scale", 0)
            mean, deviation = float((r["low"] + Decimal(mean)) / unit), deviation and deviation / unit
        elif fact["low"] is not None:
            mean = float(fact["low"] + Decimal(mean))
        fact |= {"n": n, "mean": mean, "deviation": deviation}
        if fact["low"] is None:
            fact |= {"low": _number(kinds[i], r["low"]), "high": _number(kinds[i], r["high"])}
    done = FIRST_BITS
    while near:
        # between the two buckets that hold the middle rows there is nothing, so ranks go on in order
        finer = done == FIRST_BITS and any(_width(found, SECOND_BITS, group_limit) > 1 for found in near.values())
        done = SECOND_BITS if finer else 64
        widths = {i: _width(found, done, group_limit) for i, found in near.items()}
        groups, middle = _key_groups(df, columns, dict(near), None, done, group_limit), {}
        for g in _middle(groups, ["prefix", *_text_order()], dict(below), ranks).where("middle").collect():
            middle.setdefault(g["idx"], []).append(g)
        near.clear()
        for i, found in middle.items():
            if widths[i] > 1:
                keep(i, found, widths[i], *ends[i])
                continue
            numbers = sorted(Decimal(g["text"]) if g["text"] is not None else _number(kinds[i], g["prefix"]) for g in found)
            facts[columns[i]]["median"] = numbers[0] if len(numbers) == 1 else _halfway(numbers[0], numbers[-1])
    return facts


def _text_order() -> list[Column]:
    """Sort keys of decimals of one column written as text: sign, then digits of one length, by size."""
    negative = F.col("text").startswith("-")
    digits = F.regexp_replace("text", "^-", "")
    length, back = F.length(digits), F.translate(digits, "0123456789", "9876543210")
    return [
        F.when(negative, 0).otherwise(1),
        F.when(negative, -length).otherwise(length),
        F.when(negative, back).otherwise(digits),
    ]


def _halfway(one, two):
    if isinstance(one, Decimal):
        with localcontext() as context:
            context.prec = 60
            return (one + two) / 2
    return one / 2 + two / 2 if math.isinf(one + two) else (one + two) / 2


def exact_medians(df: DataFrame, columns: Sequence[str], group_limit: int = MEDIAN_GROUP_LIMIT) -> DataFrame:
    """(column_name, median_val): the exact median of each numeric column; see :func:`number_facts`."""
    facts = number_facts(df, columns, group_limit)
    rows = [(c, None if f["median"] is None else float(f["median"])) for c, f in facts.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, median_val double")


def _as_text(number) -> str | None:
    return format(number, "f") if isinstance(number, Decimal) else None


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum, mean, exact median and sample deviation; NULLs when nothing is present.

    Whole numbers and decimals also have their extremes and median as exact text.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    schema = (
        "column_name string, min_val double, max_val double, mean_val double, median_val double, "
        "std_val double, min_exact string, max_exact string, median_exact string"
    )
    plain = lambda number: None if number is None else float(number)
    rows = [
        (c, plain(f["low"]), plain(f["high"]), f["mean"], plain(f["median"]), f["deviation"],
         _as_text(f["low"]), _as_text(f["high"]), _as_text(f["median"]))
        for c, f in (number_facts(df, columns) if columns else {}).items()
    ]
    return df.sparkSession.createDataFrame(rows, schema)


# ------------------------------------------------------------------- values and counts


def _cells(df: DataFrame, columns: Sequence[str], as_key: bool) -> DataFrame:
    """One row per cell: (column_name, value as text), missing values dropped."""

    def text(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(df[name]))
            value = F.when(df[name].isNotNull(), value)
        elif isinstance(kind, FLOATING):
            value = (present(df, name) + F.lit(0.0)).cast("string")
        elif isinstance(kind, T.BinaryType):
            value = F.hex(df[name])
        else:
            value = df[name].cast("string")
        return value_key(value) if as_key and isinstance(kind, T.StringType) else value

    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns]
    )
    return df.select(F.inline(cells)).where(F.col("value").isNotNull())


def most_frequent(frequencies: DataFrame, k: int) -> DataFrame:
    """The ``k`` first values per column by frequency, then by value."""
    rank = F.row_number().over(
        Window.partitionBy("column_name").orderBy(F.desc("frequency"), F.asc("value"))
    )
    return (
        frequencies.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("column_name", "value", "frequency", F.col("rank").cast("bigint").alias("rank"))
    )


def unique_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct values per column, missing ones not counted.

    Exact by default: one grouping by (column, value) in which texts longer than a digest
    travel as their digest. ``approximate`` uses a sketch and no shuffle of values.
    """
    columns = list(columns) if columns is not None else df.columns
    if approximate:
        return one_pass(
            df, columns, {"unique_count": lambda c: F.approx_count_distinct(present(df, c))}
        ).select("column_name", "unique_count")
    counted = (
        _cells(df, columns, as_key=True)
        .groupBy("column_name", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("unique_count"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    every = df.sparkSession.range(1, numPartitions=1).select(F.explode(names).alias("column_name"))
    return every.join(counted, "column_name", "left").select(
        "column_name", F.coalesce("unique_count", F.lit(0).cast("bigint")).alias("unique_count")
    )


#: Buckets of a column's values that the first scan of :func:`top_values` counts.
VALUE_BUCKETS = 1 << 16
_PREFIX_CHARS = 16


def _digested(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per text present: (idx, bucket, one, two, prefix): a 128-bit name and the first letters."""
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("idx"),
                F.xxhash64(df[c]).alias("one"),
                F.xxhash64(F.lit("two"), df[c]).alias("two"),
                F.substring(df[c], 1, _PREFIX_CHARS).alias("prefix"),
            )
            for i, c in enumerate(columns)
        ]
    )
    rows = df.select(F.inline(cells)).where(F.col("prefix").isNotNull())
    return rows.withColumn("bucket", F.col("one").bitwiseAND(F.lit(VALUE_BUCKETS - 1)).cast("int"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of each text column; ties go to the smaller value.

    A sketch of bounded size comes first: rows per bucket of values, and whether a bucket holds
    one value only. The k-th largest count of such values bounds the winners from below, so only
    buckets with more rows are counted value by value, by digest. Whole texts are fetched for the
    winners alone, and for values that only texts longer than a prefix could tell from them.
    """
    columns = list(columns) if columns is not None else string_columns(df)
    if not columns:
        return _nothing(df, "column_name string, value string, frequency bigint, rank bigint")
    rows = _digested(df, columns)
    facts = [F.count(F.lit(1)).alias("rows"), F.min("prefix").alias("prefix")]
    ends = [f(c).alias(f"{c}_{n}") for c in ("one", "two") for n, f in (("low", F.min), ("high", F.max))]
    sketch = rows.groupBy("idx", "bucket").agg(*facts, *ends)
    single = (F.col("one_low") == F.col("one_high")) & (F.col("two_low") == F.col("two_high"))
    by_rows = Window.partitionBy("idx").orderBy(F.desc_nulls_last("known"))
    bounded = (
        sketch.withColumn("single", single)
        .withColumn("known", F.when(F.col("single"), F.col("rows")))
        .withColumn("place", F.row_number().over(by_rows))
        .withColumn("least", F.max(F.when(F.col("place") == k, F.col("known"))).over(Window.partitionBy("idx")))
    )
    least = F.coalesce("least", F.lit(0))
    sketched = bounded.where(F.col("single") & (F.col("rows") >= least)).select(
        "idx", F.col("one_low").alias("one"), F.col("two_low").alias("two"), "rows", "prefix"
    )
    mixed = bounded.where(~F.col("single") & (F.col("rows") > least)).select("idx", "bucket", least.alias("least"))
    counted = (
        rows.join(mixed, ["idx", "bucket"])
        .groupBy("idx", "one", "two")
        .agg(*facts, F.first("least").alias("least"))
        .where(F.col("rows") >= F.col("least"))
        .drop("least")
    )
    rank = F.rank().over(Window.partitionBy("idx").orderBy(F.desc("rows"), "prefix"))
    near = sketched.unionByName(counted).withColumn("near", rank).where(F.col("near") <= k)
    winners = near.select("idx", "one", "two", "rows")
    texts = F.array(
        *[
            F.struct(
                F.lit(i).alias("idx"),
                F.xxhash64(df[c]).alias("one"),
                F.xxhash64(F.lit("two"), df[c]).alias("two"),
                df[c].alias("value"),
            )
            for i, c in enumerate(columns)
        ]
    )
    fetched = (
        df.select(F.inline(texts))
        .where(F.col("value").isNotNull())
        .join(winners, ["idx", "one", "two"])
        .groupBy("idx", "one", "two")
        .agg(F.first("value").alias("value"), F.first("rows").alias("frequency"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return most_frequent(fetched.withColumn("column_name", F.get(names, F.col("idx"))), k)


# ----------------------------------------------------------------------------- tables

# Bytes of one stored value of a fixed-width type.
_WIDTHS = {
    "boolean": 1,
    "tinyint": 1,
    "smallint": 2,
    "int": 4,
    "float": 4,
    "date": 4,
    "bigint": 8,
    "double": 8,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def _cell_bytes(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    width = _WIDTHS.get(kind.simpleString())
    if width is not None:
        size = F.lit(width)
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(df[name])
    elif isinstance(kind, T.DecimalType):
        size = F.lit(8 if kind.precision <= 18 else 16)
    else:
        size = F.octet_length(F.to_json(F.struct(df[name])))
    return F.when(df[name].isNotNull(), size.cast("bigint"))


def data_size(df: DataFrame) -> DataFrame:
    """Bytes of the values in the table, as a number and as text."""
    # one sum per column: no row-wide expression, and a bigint holds each
    total = [F.coalesce(F.sum(_cell_bytes(df, c)), F.lit(0).cast("bigint")).alias(f"b{i}")
             for i, c in enumerate(df.columns)]
    sums = df.agg(*total)
    combined = sum((F.col(f"b{i}") for i in range(1, len(df.columns))), F.col("b0"))
    return sums.select(combined.alias("data_bytes")).select(
        "data_bytes", size_text(F.col("data_bytes")).alias("data_size")
    )


def duplicate_row_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(groups with copies, rows in them, extra rows) over the given or all columns."""
    keys = grouping_keys(df, list(columns) if columns is not None else df.columns)
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    repeated = F.col("copies") > 1

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(repeated, value)), F.lit(0).cast("bigint"))

    return copies.agg(
        F.count_if(repeated).alias("duplicate_groups"),
        total(F.col("copies")).alias("rows_in_groups"),
        total(F.col("copies") - 1).alias("extra_rows"),
    )


def table_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, repeated rows and missing cells of the table, in one row.

    One scan and one grouping: equal rows have equally many missing cells, so the counters of
    missing cells go through the grouping of repeated rows.
    """
    missing = sum((is_missing(df, c).cast("int") for c in df.columns[1:]), is_missing(df, df.columns[0]).cast("int"))
    keys = grouping_keys(df, df.columns)
    names = [f"key_{i}" for i in range(len(keys))]
    # a generator of one row keeps later steps from computing the row's values again
    rows = df.select(F.inline(F.array(F.struct(*keys, missing.alias("missing")))))
    copies = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"), F.sum("missing").alias("missing"))
    nothing = F.lit(0).cast("bigint")
    return copies.agg(
        F.coalesce(F.sum("copies"), nothing).alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.coalesce(F.sum(F.col("copies") - 1), nothing).alias("duplicated_rows"),
        F.coalesce(F.sum("missing"), nothing).alias("null_values_total"),
    )
