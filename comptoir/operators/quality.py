"""Data-quality checks: a table of findings and one row of metrics, from one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.functions.columns import nan_to_null, ref

Bounds = tuple[float | None, float | None]

MAX_MISSING_SHARE = 0.5

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType, T.DecimalType, T.IntegerType, T.LongType)
_TEXT = (T.StringType, T.VarcharType, T.CharType)
# The type names a rule may use, with the Spark types that satisfy them. A date column
# may be declared as plain text ("object"), because files deliver it as text.
TYPE_NAMES = {
    "int": _WHOLE,
    "float": _REAL,
    "str": _TEXT,
    "string": _TEXT,
    "category": _TEXT,
    "object": _TEXT,
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "bool": (T.BooleanType,),
}

# The declared business rules for sales and customer files.
SALES_SCHEMA = {
    "required_columns": ["date", "produit", "categorie", "prix", "quantite", "ville", "source"],
    "column_types": {"prix": "float", "quantite": "int"},
    "value_ranges": {"prix": (0, None), "quantite": (1, None)},
}
CUSTOMER_SCHEMA = {
    "required_columns": ["customer_id", "name", "email"],
    "column_types": {"customer_id": "int"},
}
_SALES_TYPES = {
    "date": "object", "produit": "str", "categorie": "str", "prix": "float", "quantite": "int",
    "ville": "str", "source": "str",
}

_FINDING = (
    "array<struct<severity:string,check:string,column:string,observed:double,total:double,message:string>>"
)


def missing_required(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def wrong_types(df: DataFrame, expected: dict[str, str]) -> dict[str, str]:
    """Columns whose type does not satisfy the rule, with their actual type; absent columns are skipped."""
    wrong = {}
    for column, name in expected.items():
        if column in df.columns:
            actual = df.schema[column].dataType
            accepted = TYPE_NAMES.get(name)
            if not (isinstance(actual, accepted) if accepted else actual.simpleString() == name):
                wrong[column] = actual.simpleString()
    return wrong


def _outside(column: Column, low: float | None, high: float | None) -> list[Column]:
    """Conditions for a value below ``low`` and one above ``high``; NULL and text that is no number meet neither."""
    number = column.try_cast("double")
    return ([number < low] if low is not None else []) + ([number > high] if high is not None else [])


def range_violations(df: DataFrame, value_ranges: dict[str, Bounds]) -> DataFrame:
    """One row per ruled column with its number of values outside the bounds, from one pass."""
    ruled = {c: b for c, b in value_ranges.items() if c in df.columns}
    outside = [reduce(Column.__add__, [F.count_if(x) for x in _outside(ref(c), *b)], F.lit(0).cast("bigint")) for c, b in ruled.items()]
    counts = df.agg(*[n.alias(f"r{i}") for i, n in enumerate(outside)], F.lit(1))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("invalid")) for i, c in enumerate(ruled)]
    return counts.select(F.inline(F.array(*rows))) if rows else df.sparkSession.createDataFrame(
        [], "column string, invalid bigint")


def _masks(conditions: Sequence[Column]) -> list[Column]:
    """Which conditions a row meets, as bits of whole numbers, 62 in each."""
    bits = [F.when(met, F.lit(1 << i % 62).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, met in enumerate(conditions)]
    return [reduce(Column.bitwiseOR, bits[i:i + 62]) for i in range(0, len(bits), 62)]


def _fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row, with different seeds. Which columns are NULL is part of both, as a hash passes over NULLs.

    Different rows agree in both with a chance of 2 ** -128 for each pair of rows: about 1e-15 for a table of 10 ** 12.
    """
    gaps = _masks([ref(c).isNull() for c in df.columns])
    return [F.xxhash64(F.lit(seed), *gaps, *[ref(c) for c in df.columns]) for seed in (11, 97)]


def _counted(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """One row: ``total`` rows, ``different`` ones, and in ``c0, c1, ..`` how many rows meet each condition.

    One pass and one shuffle, of fingerprints and the bits of the conditions, which equal rows share; equal rows combine
    before the shuffle. Columns themselves never move.
    """
    masks = _masks(conditions)
    named = [*zip(("_a", "_b"), _fingerprint(df)), *[(f"_m{i}", m) for i, m in enumerate(masks)]]
    keys = [name for name, _ in named]
    grouped = df.select(*[c.alias(name) for name, c in named]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def of(i: int) -> Column:
        met = F.col(f"_m{i // 62}").bitwiseAND(F.lit(1 << i % 62).cast("bigint")) != 0
        return F.coalesce(F.sum(F.when(met, F.col("n"))), F.lit(0)).alias(f"c{i}")

    return grouped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("different"), *[of(i) for i in range(len(conditions))])


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows (NULLs equal, and NaN with them)."""
    return _counted(nan_to_null(df), []).select((F.col("total") - F.col("different")).alias("duplicate_rows"))


def missing_counts(df: DataFrame) -> DataFrame:
    """One row per column: missing values, rows, and the missing percentage."""
    df = nan_to_null(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(ref(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("count")) for i, c in enumerate(df.columns)]
    long = counts.select("total", F.inline(F.array(*rows)))
    return long.withColumn("percentage", F.try_divide(F.col("count").cast("double"), F.col("total")) * 100)


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percentage of the columns that have any."""
    return missing_counts(df).filter(F.col("count") > 0).select("column", "count", "percentage")


def table_metrics(df: DataFrame) -> DataFrame:
    """One row: rows, columns, cells, missing cells and percentage, duplicate rows, column types."""
    df = nan_to_null(df)
    return _metrics(df, _counted(df, [ref(c).isNull() for c in df.columns]))


def _metrics(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Metrics from counts whose first conditions say which columns are NULL."""
    width = len(df.columns)
    cells, missing = F.col("total") * width, reduce(Column.__add__, [F.col(f"c{i}") for i in range(width)], F.lit(0).cast("bigint"))
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return counts.select(
        F.col("total").alias("n_rows"), F.lit(width).alias("n_columns"), cells.alias("total_cells"), missing.alias("missing_cells"),
        F.coalesce(F.try_divide(missing.cast("double"), cells) * 100, F.lit(0.0)).alias("missing_percentage"),
        (F.col("total") - F.col("different")).alias("duplicate_rows"), types.alias("column_types"),
    )


@dataclass
class Validation:
    """Outcome of :func:`validate`: nothing runs until it is used; then one pass makes one row of counts, for findings and metrics."""

    _counts: DataFrame
    _findings: Callable[[DataFrame], DataFrame]
    _measured: Callable[[DataFrame], DataFrame]
    _known: DataFrame | None = field(default=None, repr=False)
    _rows: list | None = field(default=None, repr=False)

    def _counted(self) -> DataFrame:
        if self._known is None:
            self._known = self._counts.sparkSession.createDataFrame([self._counts.first()], self._counts.schema)
        return self._known

    @property
    def findings(self) -> DataFrame:
        return self._findings(self._counted())

    @property
    def metrics(self) -> DataFrame:
        return self._measured(self._counted())

    def _collected(self) -> list:
        if self._rows is None:
            self._rows = self.findings.collect()  # at most a few rows per column of the table
        return self._rows

    @property
    def errors(self) -> list[str]:
        return [r["message"] for r in self._collected() if r["severity"] == "error"]

    @property
    def warnings(self) -> list[str]:
        return [r["message"] for r in self._collected() if r["severity"] == "warning"]

    @property
    def is_valid(self) -> bool:
        return not self.errors


def validate(
    df: DataFrame, required_columns: Sequence[str] | None = None, column_types: dict[str, str] | None = None,
    check_duplicates: bool = True, check_missing: bool = True, value_ranges: dict[str, Bounds] | None = None,
    min_rows: int | None = None, strict: bool = False, max_missing: float = MAX_MISSING_SHARE,
) -> Validation:
    """Check a table. ``strict`` turns the missing-value and duplicate warnings into errors.

    Everything that counts rows comes from one pass, whose shuffle moves fingerprints of rows and counts.
    """
    df = nan_to_null(df)
    soft = "error" if strict else "warning"
    conditions = [ref(c).isNull() for c in df.columns]
    found: list[tuple[Column, Column]] = []  # (condition, finding)

    def count_of(*met: Column) -> Column:
        conditions.extend(met)
        return reduce(Column.__add__, [F.col(f"c{i}") for i in range(len(conditions) - len(met), len(conditions))], F.lit(0).cast("bigint"))

    def finding(when, severity, check, column, observed, message):
        found.append((when, F.struct(
            F.lit(severity).alias("severity"), F.lit(check).alias("check"), F.lit(column).alias("column"),
            observed.cast("double").alias("observed"), F.col("total").cast("double").alias("total"),
            message.alias("message"),
        )))

    def text(pattern: str, *values: Column) -> Column:
        return F.format_string(pattern, *values)

    always = F.lit(True)
    for column in missing_required(df, required_columns or []):
        finding(always, "error", "required", column, F.lit(None), F.lit(f"required column '{column}' is missing"))
    for column, actual in wrong_types(df, column_types or {}).items():
        message = f"column '{column}' should be {column_types[column]} but is {actual}"
        finding(always, "error", "type", column, F.lit(None), F.lit(message))
    if check_missing:
        for i, column in enumerate(df.columns):
            share = F.try_divide(F.col(f"c{i}").cast("double"), F.col("total"))
            message = text(f"column '{_escaped(column)}': %.1f%% of %d values missing", share * 100, F.col("total"))
            finding(share > max_missing, soft, "missing", column, F.col(f"c{i}"), message)
    if check_duplicates:
        copies = F.col("total") - F.col("different")
        finding(copies > 0, soft, "duplicates", None, copies, text("%d duplicate rows among %d", copies, F.col("total")))
    for column, (low, high) in (value_ranges or {}).items():
        if column in df.columns:
            outside = count_of(*_outside(ref(column), low, high))
            finding(outside > 0, "error", "range", column, outside, text(f"column '{_escaped(column)}': %d values outside [{low}, {high}]", outside))
            if not isinstance(df.schema[column].dataType, T.NumericType):
                odd = count_of(ref(column).isNotNull() & ref(column).cast("string").try_cast("double").isNull())
                finding(odd > 0, "error", "type", column, odd, text(f"column '{_escaped(column)}': %d values are no numbers", odd))
    if min_rows:
        finding(F.col("total") < min_rows, "error", "rows", None, F.col("total"),
                text(f"%d rows, at least {min_rows} needed", F.col("total")))

    listed = F.array(*[F.when(when, what) for when, what in found]).cast(_FINDING)
    return Validation(
        _counted(df, conditions), lambda counts: counts.select(F.inline(F.filter(listed, lambda x: x.isNotNull()))), lambda counts: _metrics(df, counts))


def _escaped(name: str) -> str:
    return name.replace("%", "%%")


def validate_sales_data(df: DataFrame, strict: bool = False) -> Validation:
    """All rules for a sales file: seven typed columns, no negative price, at least one piece, one row."""
    rules = {**SALES_SCHEMA, "column_types": _SALES_TYPES}
    return validate(df, **rules, min_rows=1, strict=strict)
