"""Change-detection hashes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.fixed_values import DATE_FORMAT, HASH_SEPARATOR, TIMESTAMP_FORMAT


def as_text(name: str, kind: T.DataType, fill: bool = True) -> str:
    """SQL for a column's hash text. ``fill`` turns NULL into '' (0 for numbers)."""
    text, blank = f"`{name}`", "''"
    if isinstance(kind, T.NumericType):
        filled = f"coalesce({text}, CAST(0 AS {kind.simpleString()}))"
        return f"CAST({filled if fill else text} AS STRING)"
    if isinstance(kind, T.DateType):
        text = f"date_format({text}, '{DATE_FORMAT}')"
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = f"date_format({text}, '{TIMESTAMP_FORMAT}')"
    return f"coalesce({text}, {blank})" if fill else text


def row_hash(df: DataFrame, columns: list[str], unfilled: tuple[str, ...] = ()) -> Column:
    """sha-256 over ``columns``. NULLs in ``unfilled`` are skipped, shifting what follows."""
    kinds = df.schema
    texts = ", ".join(as_text(c, kinds[c].dataType, c not in unfilled) for c in columns)
    return F.expr(f"sha2(concat_ws('{HASH_SEPARATOR}', {texts}), 256)")


def strict_row_hash(df: DataFrame, columns: list[str]) -> Column:
    """Collision-safe variant: each text is length-prefixed and NULL differs from ''."""
    kinds = df.schema
    texts = [as_text(c, kinds[c].dataType, fill=False) for c in columns]
    return F.expr("sha2(concat(" + ", ".join(f"coalesce(concat(length({t}), ':', {t}), '-')" for t in texts) + "), 256)")


def unknown_hash(key: str) -> Column:
    return F.sha2(F.lit(key), 256)
