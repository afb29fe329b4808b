"""Rows to name/value maps and JSON messages, and back."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def reject_duplicates(names: Iterable[str]) -> None:
    """A message has one value per name."""
    names = list(names)
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"duplicate column names: {', '.join(repeated)}")


def numbers_as_double(value: Column, data_type: T.DataType) -> Column:
    """Widen integer columns the way an untyped JSON round trip does. Whole
    numbers above 2^53 lose precision."""
    return value.cast("double") if isinstance(data_type, T.NumericType) else value


def row_map(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """All columns of a row as MAP<STRING, STRING>, names discovered from the schema."""
    names = list(columns or df.columns)
    reject_duplicates(names)
    pairs = [F.struct(F.lit(n).alias("key"), quoted(n).cast("string").alias("value")) for n in names]
    return F.map_from_entries(F.array(*pairs))


def row_json(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """All columns of a row as JSON text, in the order given. NULL fields are left out."""
    names = list(columns or df.columns)
    reject_duplicates(names)
    return F.to_json(F.struct(*[quoted(n).alias(n) for n in names]))


def fields_json(fields: Mapping[str, Column]) -> Column:
    """Named expressions as JSON text."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def put_fields(base: Mapping[str, Column], extra: Mapping[str, Column]) -> dict[str, Column]:
    """Add fields to a message; an added field replaces one of the same name."""
    kept = {name: value for name, value in base.items() if name not in extra}
    return {**kept, **extra}


def put_map(base: Column, extra: Mapping[str, Column]) -> Column:
    """As :func:`put_fields`, for a map column whose names are only known per row."""
    names = list(extra)
    kept = F.map_filter(base, lambda key, _: ~key.isin(names))
    added = F.create_map(*[part for n in names for part in (F.lit(n), extra[n].cast("string"))])
    return F.map_concat(kept, added)


def json_to_map(text: Column | str, value_type: str = "string") -> Column:
    """JSON object to a map, for messages whose fields are not known in advance.
    ``value_type='double'`` is for objects of numbers only, and widens each."""
    return F.from_json(text, f"map<string,{value_type}>")


def json_to_struct(text: Column | str, schema: str | T.StructType) -> Column:
    """JSON object to typed fields."""
    return F.from_json(text, schema)


def json_to_variant(text: Column | str) -> Column:
    """JSON text to VARIANT: any shape, each value with its own type."""
    return F.parse_json(F.col(text) if isinstance(text, str) else text)
