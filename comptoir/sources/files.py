"""Reading delimited text, Parquet and JSON from files, folders and globs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from comptoir.functions.columns import as_list, nan_to_null, ref, unique_names
from comptoir.sources.errors import CorruptInputError, EmptyInputError, MissingPathError, UnsupportedFormatError
from comptoir.sources.records import quoted_records

FORMATS = ("csv", "parquet", "json")
DELIMITERS = (",", ";", "\t", "|")
_HEAD_LINES = 5

# Text that stands for a missing value in delimited files.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Spark reads cp1252 as ISO-8859-1, which differs in the bytes 80 to 9F only; these are put right afterwards.
_CP1252_BYTES = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
_AS_LATIN1, _AS_CP1252 = _CP1252_BYTES.decode("latin-1"), _CP1252_BYTES.decode("cp1252")
# Usual names of the encodings read here.
_ENCODINGS = {
    "utf-8": "UTF-8", "utf8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "cp1252": "cp1252", "windows-1252": "cp1252",
    "utf-16": "UTF-16", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE", "utf-32": "UTF-32",
}
# Encodings that write ASCII as single bytes, so that quotes and line ends can be found in the bytes.
_BYTE_ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1", "cp1252")
_BOM = "﻿"
# Byte order marks that name an encoding other than UTF-8, longest first.
_MARKS = {b"\xff\xfe\x00\x00": "UTF-32", b"\x00\x00\xfe\xff": "UTF-32", b"\xff\xfe": "UTF-16", b"\xfe\xff": "UTF-16"}
_WHOLE = r"^[+-]?\d+$"
_WIDE = r"^[+-]?\d{1,38}$"
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"
_LOGIC = ["True", "False", "TRUE", "FALSE", "true", "false"]
# What a value looks like, as bits.
_IS_NUMBER, _IS_WHOLE, _IS_WIDE, _FITS, _IS_LOGIC = 1, 2, 4, 8, 16
_EVERY = 31
_WITNESSES = 1000  # rows that rule out types before all rows are asked about the others
_EXTRA = "_extra"  # catches the fields of a row that has more than the header


def profile_files(spark: SparkSession, paths: str | Sequence[str], delimiter: str | None = None) -> DataFrame:
    """One row per file: ``path, encoding, delimiter, header, lines, multiline``; ``header`` is the first line as raw bytes.

    A byte order mark names UTF-16 and UTF-32. Otherwise a file that is valid UTF-8 throughout is UTF-8; otherwise it is cp1252 when it has bytes only that
    uses, else ISO-8859-1. The delimiter is the candidate that is most regular over the first lines
    (present in all, the same number of times), then the most frequent one. ``multiline`` says that a line
    has an odd number of quotes, and a line a quote that opens a field (at its start or after ``delimiter`` or a candidate) and is not
    closed in it, so that a field may hold a line break. One distributed pass; the lines of a file
    never meet in one task, except its first few.
    """
    lines = spark.read.text(as_list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("position"),
    )
    raw = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    valid = F.is_valid_utf8("value")
    ascii_only = valid & (F.length("value") == F.octet_length("value"))
    seps = "|".join(re.escape(d) for d in [*DELIMITERS, *([delimiter] if delimiter else [])])
    quoted = F.contains("value", F.lit('"'))  # most lines are done with this
    opened = quoted & F.col("value").rlike(f'(?:^\\uFEFF?|{seps})"(?:[^"]|"")*+$')
    files = lines.groupBy("path").agg(
        F.bool_and(valid).alias("utf8"),
        F.bool_or(F.when(~ascii_only, raw.rlike("[\\x80-\\x9F]")).otherwise(False)).alias("high"),
        F.count(F.lit(1)).alias("lines"),
        F.bool_or(quoted & ((F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1)).alias("odd"),
        F.bool_or(opened).alias("opened"),
    )
    marked = F.lit(None)
    for mark, name in reversed(_MARKS.items()):
        marked = F.when(F.substring("header", 1, len(mark)) == F.lit(bytearray(mark)), name).otherwise(marked)
    encoding = F.when(F.col("utf8"), "UTF-8").when(F.col("high"), "cp1252").otherwise("ISO-8859-1")

    # The first split of a file holds its first lines in order; the limit per file prunes before the shuffle.
    nth = F.row_number().over(W.partitionBy("path").orderBy("position"))
    head = lines.filter((F.col("start") == 0) & (F.length(F.trim("value")) > 0)).withColumn("nth", nth)
    head = head.filter(F.col("nth") <= _HEAD_LINES)
    scores = []
    for i, d in enumerate(DELIMITERS):
        # Quoted text does not separate fields.
        bare = F.regexp_replace("value", '"[^"]*"', "")
        times = F.length(bare) - F.length(F.replace(bare, F.lit(d)))
        regular = (F.min(times) == F.max(times)) & (F.min(times) > 0)
        scores.append(F.struct(regular.alias("regular"), F.sum(times).alias("times"), F.lit(-i).alias("order"), F.lit(d).alias("d")))
    best = head.groupBy("path").agg(
        F.greatest(*scores).getField("d").alias("delimiter"),
        F.min_by(F.col("value").cast("binary"), "position").alias("header"),
    )
    return files.join(best, "path", "left").select(
        "path", F.coalesce(marked, encoding).alias("encoding"), F.coalesce("delimiter", F.lit(",")).alias("delimiter"), "header", "lines",
        F.coalesce(F.col("odd") & F.col("opened"), F.lit(False)).alias("multiline"),
    )


def load_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
    encoding: str | None = None, delimiter: str | None = None, on_bad: str = "fail",
    na_tokens: Sequence[str] = NA_TOKENS, **options,
) -> DataFrame:
    """Load delimited text with a header line.

    Encoding and delimiter are detected per file unless given; files that agree, also in their header,
    are read together, so columns go by name. One pass over the lines also finds files whose quoted fields hold line breaks; their
    records are cut in parallel (:mod:`comptoir.sources.records`) when this is called. UTF-16 and UTF-32 files are read whole, one task per file. With a ``schema`` no types are inferred. Without, types come from one pass over the text: whole numbers (64 bits, else
    decimal, beyond 38 digits text), numbers, booleans, else text (dates stay text). Rows with more fields than the header make the load
    fail, or are left out with ``on_bad="skip"`` (see :func:`rejected_rows`).
    """
    text = _text_table(spark, paths, encoding, delimiter, options)
    names = [c for c in text.columns if c != _EXTRA]
    tokens = list(na_tokens)
    valued = text.select(*[F.when(~ref(c).isin(tokens), ref(c)).alias(c) for c in names], ref(_EXTRA))
    bad = ref(_EXTRA).isNotNull()
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if on_bad == "fail":
            message = F.concat(F.lit("row with more fields than the header: "), F.to_json(F.struct(*map(ref, names))))
            valued = valued.withColumn(names[0], F.when(bad, F.raise_error(message)).otherwise(ref(names[0])))
        else:
            valued = valued.filter(~bad)
        return valued.select(*[ref(f.name).cast(f.dataType).alias(f.name) for f in wanted])

    # A type that one value rules out is settled; all rows are asked only about the types that are left.
    trimmed = valued.select(bad.alias("bad"), *[F.trim(ref(c)).alias(f"v{i}") for i, c in enumerate(names)])
    few = trimmed.limit(_WITNESSES).agg(F.lit(0), *[F.bit_and(_kind(F.col(f"v{i}"))) for i in range(len(names))]).first()[1:]
    asked = [i for i, bits in enumerate(few) if bits != 0]
    kinds = [F.bit_and(_kind(F.col(f"v{i}"), _EVERY if few[i] is None else few[i])) for i in asked]
    facts = trimmed.agg(F.count(F.lit(1)), F.count_if("bad"), *kinds).first()
    found = dict(zip(asked, facts[2:]))
    rows, bad_rows = facts[:2]
    if rows == 0:
        raise EmptyInputError("no data rows", paths=as_list(paths))
    if bad_rows and on_bad == "fail":
        raise CorruptInputError(f"{bad_rows} rows have more fields than the header", paths=as_list(paths), rows=bad_rows)
    kept = valued.filter(~bad) if bad_rows else valued
    return kept.select(*[_typed(c, found.get(i, 0)) for i, c in enumerate(names)])


def rejected_rows(
    spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None, delimiter: str | None = None, **options
) -> DataFrame:
    """The rows with more fields than the header, as text, with the first surplus field in ``_extra``."""
    return _text_table(spark, paths, encoding, delimiter, options).filter(ref(_EXTRA).isNotNull())


def _kind(value: Column, asked: int = _EVERY) -> Column:
    """Bits that say what a value looks like, of the bits asked for; NULL without a value. Patterns, not casts: a failed cast of text is costly."""
    number = _IS_NUMBER | _IS_WHOLE | _IS_WIDE
    tests = [
        (_IS_WIDE | _FITS, value.rlike(_WIDE), F.when(value.try_cast("bigint").isNotNull(), number | _FITS).otherwise(number)),
        (_IS_WHOLE, value.rlike(_WHOLE), F.lit(_IS_NUMBER | _IS_WHOLE)),
        (_IS_NUMBER, value.rlike(_NUMBER), F.lit(_IS_NUMBER)),
        (_IS_LOGIC, value.isin(_LOGIC), F.lit(_IS_LOGIC)),
    ]
    bits = F.when(value.isNull(), F.lit(None).cast("int"))
    for of, met, kind in tests:
        if asked & of:
            bits = bits.when(met, kind)
    return bits.otherwise(0)


def _typed(column: str, bits: int | None) -> Column:
    """The column in the type whose bits all its values have; doubles where it has no value."""
    value = F.trim(ref(column))
    if bits is None:
        return value.cast("double").alias(column)
    if bits & _IS_WHOLE:
        # identifiers keep every digit: never a double
        if bits & _FITS:
            return value.cast("bigint").alias(column)
        return value.cast("decimal(38,0)").alias(column) if bits & _IS_WIDE else ref(column).alias(column)
    if bits & _IS_NUMBER:
        return value.cast("double").alias(column)
    if bits & _IS_LOGIC:
        return value.cast("boolean").alias(column)
    return ref(column).alias(column)


def _text_table(spark: SparkSession, paths, encoding: str | None, delimiter: str | None, options: dict) -> DataFrame:
    """All columns as text plus ``_extra``; one read per group of files with the same encoding and delimiter."""
    paths = as_list(paths)
    try:
        profile = profile_files(spark, paths, delimiter).select(
            "path", F.lit(_encoding(encoding)).alias("encoding") if encoding else "encoding",
            F.lit(delimiter).alias("delimiter") if delimiter else "delimiter", F.coalesce("header", F.lit(bytearray())).alias("header"), "multiline")
        kinds = profile.drop("path").distinct().collect()  # a few; paths come to the driver only where files differ
        groups = {}
        if len(kinds) == 1:
            groups[(*kinds[0][:2], bytes(kinds[0]["header"]), kinds[0]["multiline"])] = paths
        elif kinds:
            for row in profile.collect():
                groups.setdefault((row["encoding"], row["delimiter"], bytes(row["header"]), row["multiline"]), []).append(unquote(row["path"]))
        if not groups:
            raise EmptyInputError("no lines", paths=paths)
        tables = [_read_group(spark, files, *kind[:2], kind[3], options) for kind, files in sorted(groups.items())]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingPathError(f"no such path: {', '.join(paths)}", paths=paths) from error
        raise
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _encoding(name: str) -> str:
    return _ENCODINGS.get(name.lower(), name)


def _read_group(spark: SparkSession, files: list[str], encoding: str, delimiter: str, multiline: bool, options: dict) -> DataFrame:
    records = multiline and encoding in _BYTE_ENCODINGS and not {"multiLine", "quote", "escape", "comment"} & set(options)
    options = {"multiLine": multiline or encoding.startswith(("UTF-16", "UTF-32")), **options}
    reader = spark.read.options(**options).option("sep", delimiter).option("encoding", "ISO-8859-1" if encoding == "cp1252" else encoding)
    reader = reader.option("escape", '"')
    header = reader.option("header", False).csv(files).limit(1).first()
    if header is None:
        raise EmptyInputError("no header line", paths=files)
    names = unique_names([_repair(v, encoding) if v is not None else "" for v in header])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _EXTRA]])
    if records:
        rows = quoted_records(spark, files, delimiter, encoding).where("NOT first")
        value = F.col("value").cast("string") if encoding.startswith("U") else F.decode("value", "ISO-8859-1")
        places = [f"c{i}" for i in range(len(schema))]
        fields = F.from_csv(value, ", ".join(f"{c} string" for c in places), {"sep": delimiter, "escape": '"', "mode": "PERMISSIVE", **{k: str(v) for k, v in options.items()}})
        table = rows.select(fields.alias("f")).select(*[F.col(f"f.{c}").alias(n) for c, n in zip(places, schema.names)])
    else:
        table = reader.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(files)
    if encoding == "cp1252":
        table = table.select(*[F.translate(ref(c), _AS_LATIN1, _AS_CP1252).alias(c) for c in table.columns])
    return table


def _repair(text: str, encoding: str) -> str:
    text = text.removeprefix(_BOM)
    return text.translate(str.maketrans(_AS_LATIN1, _AS_CP1252)) if encoding == "cp1252" else text


def load_data(spark: SparkSession, path: str, file_format: str | None = None, **options) -> DataFrame:
    """Load by format, which the extension gives when it is not named."""
    kind = (file_format or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if kind not in FORMATS:
        raise UnsupportedFormatError(f"format not supported: {kind}", path=path, supported=FORMATS)
    if kind == "csv":
        return nan_to_null(load_csv(spark, path, **options))
    try:
        df = spark.read.options(**options).format(kind).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingPathError(f"no such path: {path}", path=path) from error
        raise
    if df.isEmpty():
        raise EmptyInputError("no data rows", path=path)
    return nan_to_null(df)


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, matched by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
