"""Which cleaning rule removes which rows.

Every rule that a row breaks sets a bit. Counts by rule (broken at all, broken
alone, broken first in the rules' order) are plain sums over these bits, so one
pass gives them all; ``write_audited`` takes them from the very pass that writes
the kept rows (``observe``), and the input is read once.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT = T.StructType([T.StructField("rule", T.StringType()), T.StructField("position", T.IntegerType())]
                      + [T.StructField(n, T.LongType()) for n in ("n_broken", "n_alone", "n_first", "n_before", "n_after")])


def broken_rules(rules: Mapping[str, Column | str]) -> Column:
    """A bit mask: bit i is set where the row breaks rule i. A rule that is
    neither true nor false (a null) is broken, as a filter would drop the row."""
    keep = [F.expr(r) if isinstance(r, str) else r for r in rules.values()]
    bits = [F.when(F.coalesce(k, F.lit(False)), F.lit(0).cast("bigint")).otherwise(F.lit(1 << i).cast("bigint")) for i, k in enumerate(keep)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("bigint"))


def _counts(rules: Mapping, mask: str) -> list[Column]:
    m, aggs = F.col(mask), [F.count(F.lit(1)).alias("n_before"), F.count_if(F.col(mask) == 0).alias("n_after")]
    for i in range(len(rules)):
        bit = 1 << i
        aggs += [F.count_if(m.bitwiseAND(bit) != 0).alias(f"broken{i}"), F.count_if(m == bit).alias(f"alone{i}"),
                 F.count_if(m.bitwiseAND(2 * bit - 1) == bit).alias(f"first{i}")]
    return aggs


def _report(spark, rules: Mapping, got: Mapping[str, int]) -> DataFrame:
    rows = [(r, i + 1, got[f"broken{i}"], got[f"alone{i}"], got[f"first{i}"], got["n_before"], got["n_after"]) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, REPORT)


def audit_rules(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """(rule, position, n_broken, n_alone, n_first, n_before, n_after); the rows a
    rule removes first add up to all removed. At most 62 rules."""
    got = df.select(broken_rules(rules).alias("__broken")).agg(*_counts(rules, "__broken")).first()
    return _report(df.sparkSession, rules, got.asDict())


def write_audited(df: DataFrame, rules: Mapping[str, Column | str], path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the rows that keep every rule, and report as ``audit_rules`` does."""
    seen = Observation()
    marked = df.withColumn("__broken", broken_rules(rules)).observe(seen, *_counts(rules, "__broken"))
    marked.where(F.col("__broken") == 0).drop("__broken").write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return _report(df.sparkSession, rules, seen.get)


def kept_rows(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    return df.where(broken_rules(rules) == 0)
