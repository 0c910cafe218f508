"""Type-2 slowly changing dimension merge.

One full outer join of the open versions with the new snapshot on the
natural key; each joined row emits one or two output versions through an
``explode`` of a 2-element array (no second pass, no self-union of the join).
Attribute comparison is null-safe (``<=>``), so a change to or from null is a
change. Closed history rows pass through untouched, so running the merge
twice with the same snapshot changes nothing.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scd2_merge(new: DataFrame, current: DataFrame, key: str, attrs: Sequence[str], today,
               *, eff: str = "effective_date", end: str = "end_date", flag: str = "is_current") -> DataFrame:
    """Return the full dimension after applying snapshot ``new``.

    ``current`` has ``key, *attrs, eff, end, flag`` (history included).
    Keys missing from ``new`` stay open (a snapshot does not delete).
    """
    attrs = list(attrs)
    if isinstance(today, str):
        today = _dt.date.fromisoformat(today)
    day = F.lit(today).cast("date")
    history = current.where(~F.col(flag))
    open_ = current.where(F.col(flag)).select(key, *[F.col(a).alias(f"c_{a}") for a in attrs],
                                             F.col(eff).alias("c_eff"), F.col(end).alias("c_end"),
                                             F.lit(True).alias("c_in"))
    snap = new.select(key, *[F.col(a).alias(f"n_{a}") for a in attrs], F.lit(True).alias("n_in"))
    j = open_.join(snap, on=key, how="full_outer")
    in_c = F.coalesce(F.col("c_in"), F.lit(False))
    in_n = F.coalesce(F.col("n_in"), F.lit(False))
    changed = reduce(lambda a, b: a | b, [~F.col(f"c_{a}").eqNullSafe(F.col(f"n_{a}")) for a in attrs])
    changed = in_c & in_n & changed
    version = lambda src, e, en, fl: F.struct(
        *[F.col(f"{src}_{a}").alias(a) for a in attrs], e.alias(eff), en.alias(end), fl.alias(flag))
    cur_version = F.when(in_c, version("c", F.col("c_eff"),
                                       F.when(changed, day).otherwise(F.col("c_end")),
                                       ~changed))
    new_version = F.when(in_n & (~in_c | changed),
                         version("n", day, F.lit(None).cast("date"), F.lit(True)))
    out = (j.select(key, F.explode(F.array(cur_version, new_version)).alias("v"))
            .where(F.col("v").isNotNull())
            .select(key, *[F.col(f"v.{a}").alias(a) for a in attrs], F.col(f"v.{eff}").alias(eff),
                    F.col(f"v.{end}").alias(end), F.col(f"v.{flag}").alias(flag)))
    return history.select(*out.columns).unionByName(out)


def scd2_initial(snapshot: DataFrame, key: str, attrs: Sequence[str], today,
                 *, eff: str = "effective_date", end: str = "end_date", flag: str = "is_current") -> DataFrame:
    """First load: every row opens a version on ``today``."""
    if isinstance(today, str):
        today = _dt.date.fromisoformat(today)
    return snapshot.select(key, *attrs, F.lit(today).cast("date").alias(eff),
                           F.lit(None).cast("date").alias(end), F.lit(True).alias(flag))
