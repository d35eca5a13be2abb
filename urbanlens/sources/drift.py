"""Parquet months whose schemas differ (A1): one table, each file read as it was written.

Monthly files change over the years: a column is an integer in one and a double in
another, appears late or changes its capitals. Spark's own merging fails on the first kind. Here the
footers are read, files with one schema form a group, a target schema is reconciled, and
every group is scanned with its own schema and widened by casts. The casts keep
values, so filters on the widened columns are still pushed to each group's files.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.sources.versions import files_of

# Numbers widen upwards in this order; bigint to double is the one step that may round (above 2^53).
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
_WIDENS = {("date", "timestamp_ntz"): "timestamp_ntz", ("date", "timestamp"): "timestamp"}


def file_schemas(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by their schema (as JSON). Footers only: a scan of no columns and no rows per file."""
    found: dict[str, list[str]] = {}
    for name in files:
        found.setdefault(spark.read.option("mergeSchema", False).parquet(name).schema.json(), []).append(name)
    return found


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both, ValueError if there is none without a loss of meaning."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    if x in _NUMBERS and y in _NUMBERS:
        if {x, y} in ({"int", "float"}, {"bigint", "float"}):
            return T.DoubleType()
        return a if _NUMBERS.index(x) > _NUMBERS.index(y) else b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if (x, y) in _WIDENS or (y, x) in _WIDENS:
        return T._parse_datatype_string(_WIDENS.get((x, y)) or _WIDENS[y, x])
    raise ValueError(f"no common type of {x} and {y}")


def reconcile(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for all: columns by name without regard to capitals, in order of first appearance, each as wide
    as its widest; what is missing somewhere may be NULL."""
    fields: dict[str, T.StructField] = {}
    for s in schemas:
        seen = set()
        for f in s.fields:
            key = f.name.lower()
            if key in seen:
                raise ValueError(f"two columns are called {f.name}")
            seen.add(key)
            if key in fields:
                try:
                    kind = wider(fields[key].dataType, f.dataType)
                except ValueError as e:
                    raise ValueError(f"column {f.name}: {e}") from None
                fields[key] = T.StructField(fields[key].name, kind, True)
            else:
                fields[key] = T.StructField(f.name, f.dataType, True)
    return T.StructType(list(fields.values()))


def read_drifting(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """All Parquet files below ``paths`` as one table. ``defaults`` replace a column in files that lack it (NULL otherwise)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = [name for p in paths for name, _, _ in files_of(spark, p) if name.endswith(".parquet")]
    if not files:
        raise ValueError(f"no Parquet files below {paths}")
    groups = {T.StructType.fromJson(json.loads(k)): v for k, v in file_schemas(spark, files).items()}
    target = reconcile(list(groups))
    wanted = [f for f in target.fields if columns is None or f.name.lower() in {c.lower() for c in columns}]
    if columns is not None and len(wanted) != len({c.lower() for c in columns}):
        raise ValueError(f"no file has all of {list(columns)}")
    parts = []
    for schema, names in groups.items():
        has = {f.name.lower(): f.name for f in schema.fields}
        out = []
        for f in wanted:
            if f.name.lower() in has:
                out.append(F.col(f"`{has[f.name.lower()]}`").cast(f.dataType).alias(f.name))
            else:
                out.append(F.lit((defaults or {}).get(f.name)).cast(f.dataType).alias(f.name))
        parts.append(spark.read.schema(schema).parquet(*names).select(*out))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole
