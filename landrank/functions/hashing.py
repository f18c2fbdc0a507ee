"""Hashes of rows: self-consistent, with nulls kept apart from empty texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits kept, by use.
ATTRIBUTE, ROW, CONTENT, FULL = 16, 24, 32, 64


def row_hash(columns: list[str], digits: int = CONTENT) -> Column:
    return F.substring(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), 1, digits)


def differences(before: str, after: str, fields: list[str]) -> Column:
    """An array of (field, before, after) of the fields that differ, null being equal to null."""
    one = [F.struct(F.lit(f).alias("field"), F.col(f"{before}.{f}").cast("string").alias("before"), F.col(f"{after}.{f}").cast("string").alias("after"))
           for f in fields]
    return F.filter(F.array(*one), lambda d: ~d["before"].eqNullSafe(d["after"]))


def schema_fingerprint(df: DataFrame, **facts) -> str:
    """A digest of names and types, whatever their order, and of further facts."""
    import hashlib

    said = "\n".join([*sorted(f"{f.name.lower()}:{f.dataType.simpleString()}" for f in df.schema.fields), *(f"{k}={v}" for k, v in sorted(facts.items()))])
    return hashlib.sha256(said.encode()).hexdigest()
