"""Projection and schema-conforming operators (rename, cast, pad, tag, reorder).

Column names of raw monthly files differ in letter case between services
(``PUlocationID`` vs ``PULocationID``, ``Airport_fee`` vs ``airport_fee``), so
every presence test here is case-insensitive, like Spark's own resolver.
All steps build one ``select`` so the plan stays a single projection.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import fixed


def _lower_index(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def find_column(df: DataFrame, name: str) -> str | None:
    """Actual name of ``name`` in ``df`` ignoring letter case, else None."""
    return _lower_index(df).get(name.lower())


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present (case-insensitive match)."""
    idx = _lower_index(df)
    renames = {}
    for old, new in mapping.items():
        actual = idx.get(old.lower())
        if actual is not None and actual != new and actual not in renames:
            renames[actual] = new
    return df.withColumnsRenamed(renames) if renames else df


def cast_columns(df: DataFrame, mapping: Mapping[str, T.DataType | str], *, safe: bool = False) -> DataFrame:
    """Cast the present columns; ``safe`` uses ``try_cast`` (bad values -> null
    instead of an ANSI error)."""
    idx = _lower_index(df)
    targets = {idx[k.lower()]: t for k, t in mapping.items() if k.lower() in idx}
    if not targets:
        return df
    cols = []
    for c in df.columns:
        if c in targets:
            t = targets[c]
            cols.append((F.col(c).try_cast(t) if safe else F.col(c).cast(t)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def pad_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every schema field that is absent (case-insensitive) as a typed null."""
    idx = _lower_index(df)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
               if f.name.lower() not in idx]
    return df.select("*", *missing) if missing else df


def tag_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns (service, year, month, flags)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def project_alias(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """SQL-expression projection, e.g. ``["LocationID AS pk_location"]``."""
    return df.selectExpr(*exprs)


def select_reorder(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def conform_service(df: DataFrame, service: str | None = None, *,
                    renames: Mapping[str, str] = fixed.CONFORM_RENAMES,
                    extra_renames: Mapping[str, str] | None = None,
                    casts: Mapping[str, T.DataType] | None = None,
                    schema: T.StructType = fixed.CONFORMED_TRIP_SCHEMA,
                    keep_extra: bool = False) -> DataFrame:
    """Rename + cast + pad + tag one service's frame into the conformed schema.

    ``extra_renames`` is the per-service profile (e.g. high-volume
    ``trip_miles -> trip_distance``). Casts use ``try_cast`` so a dirty code
    becomes null instead of failing the job. Output columns follow ``schema``;
    ``keep_extra`` keeps the remaining columns after them, ``casts`` casts some.
    """
    mapping = dict(renames)
    if extra_renames:
        mapping.update(extra_renames)
    out = rename_columns(df, mapping)
    if service is not None:
        out = out.withColumn("service_type", F.lit(service))
    out = pad_missing_columns(out, schema)
    idx = _lower_index(out)
    cols = []
    for f in schema.fields:
        actual = idx[f.name.lower()]
        cols.append(F.col(actual).try_cast(f.dataType).alias(f.name))
    if keep_extra:
        wanted = {f.name.lower() for f in schema.fields}
        cols += [F.col(c) for c in out.columns if c.lower() not in wanted]
    out = out.select(*cols)
    extra_casts = {k: v for k, v in (casts or {}).items() if k.lower() not in {f.name.lower() for f in schema.fields}}
    return cast_columns(out, extra_casts, safe=True) if extra_casts else out
