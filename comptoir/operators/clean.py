"""Text and date clean-up, and the fixed cleaning sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.functions.columns import as_list, categorical_columns, nan_to_null, ref
from comptoir.operators.encode import encode_categorical_columns
from comptoir.operators.impute import columns_with_missing, impute_missing_values
from comptoir.operators.outliers import remove_outliers as drop_outliers
from comptoir.operators.scale import normalize_numeric_columns

# Unicode white space and the four ASCII separators, as the usual text libraries count it.
_BLANK = r"(?U)[\s\x1C-\x1F]+"
# What may hold white space other than single spaces; text without it is only trimmed.
_UNTIDY = r"[^\x20-\x7E]|  "

# Strftime directives and the Java pattern letters that mean the same.
_DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm", "%S": "ss",
    "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM", "%j": "DDD", "%%": "%",
}

_ONE_OR_TWO = ("%m", "%d", "%H", "%I", "%M", "%S")

# Day first, where both readings are possible. Tried in turn when no format is given; ISO dates and timestamps need none.
DATE_FORMATS = ("%d/%m/%Y", "%d/%m/%Y %H:%M:%S", "%d-%m-%Y", "%Y/%m/%d", "%d.%m.%Y", "%Y%m%d")


def clean_string_columns(df: DataFrame, columns: str | Sequence[str] | None = None) -> DataFrame:
    """Drop white space at both ends and collapse each run inside to one space."""
    names = categorical_columns(df) if columns is None else [c for c in as_list(columns) if c in df.columns]
    tidied = {c: F.when(ref(c).rlike(_UNTIDY), F.trim(F.regexp_replace(ref(c), _BLANK, " "))).otherwise(F.trim(ref(c))) for c in names}
    return df.withColumns(tidied) if names else df


def java_pattern(strftime: str) -> str:
    """Translate a strftime format; other letters are quoted.

    Days, months and times take one or two digits, as in strptime, unless they touch another directive.
    """
    out, i = "", 0
    while i < len(strftime):
        if strftime[i] == "%":
            directive = strftime[i:i + 2]
            if directive not in _DIRECTIVES:
                raise ValueError(f"date directive not supported: {directive}")
            letters = _DIRECTIVES[directive]
            touches = strftime[i + 2:i + 3] == "%" or i >= 2 and strftime[i - 2] == "%"
            out += letters[0] if directive in _ONE_OR_TWO and not touches else letters
            i += 2
        else:
            out += f"'{strftime[i]}'" if strftime[i].isalpha() else strftime[i]
            i += 1
    return out


def convert_dates(
    df: DataFrame, date_columns: str | Sequence[str], format: str | None = None,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Parse text to timestamps, NULL where it is no date; unknown columns are skipped.

    Without a format, ISO text is tried first and then each of ``formats``.
    """
    converted = {}
    for name in as_list(date_columns):
        if name not in df.columns or not isinstance(df.schema[name].dataType, T.StringType):
            continue
        if format is not None:
            converted[name] = F.try_to_timestamp(ref(name), F.lit(java_pattern(format)))
        else:
            tries = [F.try_to_timestamp(ref(name), F.lit(java_pattern(f))) for f in formats]
            converted[name] = F.coalesce(F.try_to_timestamp(ref(name)), *tries)
    return df.withColumns(converted) if converted else df


def clean(
    df: DataFrame, remove_outliers: bool = True, impute_missing: bool = True, normalize: bool = False,
    encode_categorical: bool = False, clean_strings: bool = True,
) -> DataFrame:
    """Strings, then outliers, missing values, scaling and encoding, each step optional."""
    # Cleaned text is NULL where it was before: gaps are looked for in the text as it is, which costs no cleaning.
    gaps = columns_with_missing(nan_to_null(df), df.columns) if impute_missing else []
    if clean_strings:
        df = clean_string_columns(df)
    if remove_outliers:
        df = drop_outliers(df)
    if impute_missing:
        df = impute_missing_values(df, columns=gaps)
    if normalize:
        df = normalize_numeric_columns(df)
    if encode_categorical:
        df = encode_categorical_columns(df)
    return df
