"""Redaction of sensitive keys in structured columns and JSON text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys whose values are never shown, compared in lower case.
SENSITIVE_KEYS = (
    "customerid",
    "customer_id",
    "customer_name",
    "gender",
    "raw_payload",
    "customer_record",
    "features",
    "payload",
    "request_body",
    "input_data",
    "name",
    "email",
    "address",
)
MASK = "[REDACTED]"


def _clean(value: Column, kind: T.DataType, keys: frozenset[str]) -> Column:
    """Walk one column by its type and mask sensitive struct fields and map entries."""
    if isinstance(kind, T.StructType):
        fields = [
            F.lit(MASK).alias(f.name)
            if f.name.lower() in keys
            else _clean(value.getField(f.name), f.dataType, keys).alias(f.name)
            for f in kind.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _clean(item, kind.elementType, keys))
    if isinstance(kind, T.MapType):
        # A mask is text, so the values of a map become text: plain ones as they print,
        # nested ones as JSON, each cleaned before.
        def entry(k: Column, v: Column) -> Column:
            inner = _clean(v, kind.valueType, keys)
            nested = isinstance(kind.valueType, (T.StructType, T.ArrayType, T.MapType))
            shown = F.to_json(inner) if nested else inner.cast("string")
            return F.when(F.lower(k.cast("string")).isin(*keys), F.lit(MASK)).otherwise(shown)

        return F.transform_values(value, entry)
    return value


def redact_columns(df: DataFrame, keys: tuple[str, ...] = SENSITIVE_KEYS) -> DataFrame:
    """Mask sensitive top-level columns and everything sensitive nested in the others."""
    names = frozenset(k.lower() for k in keys)
    return df.select(
        *[
            F.lit(MASK).alias(f.name)
            if f.name.lower() in names
            else _clean(F.col(f.name), f.dataType, names).alias(f.name)
            for f in df.schema.fields
        ]
    )


def redact_json(text: Column, keys: tuple[str, ...] = SENSITIVE_KEYS) -> Column:
    """Mask sensitive keys of JSON text at every depth; all other values keep their types.

    Built-in functions cannot walk JSON of unknown depth, so this is a Pandas UDF. Text that is
    no JSON object or array gives null rather than passing through unseen.
    """
    names, mask = frozenset(k.lower() for k in keys), MASK

    @F.pandas_udf("string")
    def masked(batch: pd.Series) -> pd.Series:
        import json

        import pandas

        def walk(value):
            if isinstance(value, dict):
                return {k: mask if k.lower() in names else walk(v) for k, v in value.items()}
            return [walk(v) for v in value] if isinstance(value, list) else value

        def one(cell):
            try:
                value = json.loads(cell)
            except (TypeError, ValueError, RecursionError):
                return None
            if not isinstance(value, (dict, list)):
                return None
            return json.dumps(walk(value), ensure_ascii=False, separators=(",", ":"))

        return pandas.Series([one(cell) for cell in batch], dtype="object")

    return masked(text)
