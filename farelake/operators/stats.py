"""Distribution statistics: exact percentiles, describe, histogram, box plot,
least-squares trend, outlier trimming.

Exact percentiles do not use the ``percentile`` aggregate, whose final merge
keeps every distinct value of a group in one task's memory, and need no range
shuffle. ``bracket_quantiles`` selects by brackets, for many columns at once:

1. one pass takes the count and a bounded sketch of each column and group; the
   sketch's rank error is known, so it gives two values around every wanted rank;
2. while more rows than ``few`` lie between the two, a pass counts the rows
   below and between them and sketches those between, which narrows them;
3. one pass maps each value to the bracket it lies in, or to the gap between two
   brackets, and counts: a gap is one number, a bracket its few distinct values
   (map-side combined, so a hot group or value is a few rows a task);
4. running counts over these give the values at the wanted ranks, interpolated
   linearly (the numpy / ``quantile_cont`` rule).

The passes read a stored copy of the columns at hand (``stored`` says that the
input is one), so joins before them run once, whatever the number of passes.

Groups beyond a bound can't be broadcast; ``ranged_quantiles`` does those by
value counts in a stored range layout.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.joins import checked_broadcast
from farelake.session import ensure_checkpoint_dir, shared_table

MAX_GROUPS = 20_000    # whose brackets are broadcast
ACCURACY = 2_000       # of the first sketch: its rank error is 1 / ACCURACY of the rows


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged_value_counts(df: DataFrame, value: str, by: Sequence[str] = (), *,
                        num_partitions: int | None = None, checkpoint: bool = False) -> DataFrame:
    """Value counts of ``value`` per group, range-partitioned on (group, value),
    with the range partition (``__pid``) and the running count inside it
    (``__end``). A hot group's values are spread over several partitions."""
    by = list(by)
    n_parts = _num_partitions(df, num_partitions)
    vc = (df.where(F.col(value).isNotNull())
            .groupBy(*by, F.col(value).cast("double").alias("__v"))
            .agg(F.count(F.lit(1)).alias("__c")))
    if checkpoint:
        # With AQE the aggregation's shuffle output is materialised once and
        # reused by the range partitioner's sampling job, so the source is not
        # re-read; ``checkpoint=True`` additionally cuts the lineage (shared
        # checkpoint folder) for very long upstream plans.
        ensure_checkpoint_dir(df.sparkSession)
        vc = vc.checkpoint(eager=True)
    # stored once: offsets and running counts must come from the same range bounds
    ranged = shared_table(vc.repartitionByRange(n_parts, *by, "__v").withColumn("__pid", F.spark_partition_id()), "value-counts")
    run = Window.partitionBy(*by, "__pid").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.withColumn("__end", F.sum("__c").over(run))


def _sketches(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int,
              extra: Sequence = ()) -> list | None:
    """One row a group: for column i its count ``n{i}``, ``lo{i}``, ``hi{i}`` and
    ``q{i}``, sketched values at each probability less and plus twice the rank
    error; ``extra`` aggregates. None if there are more than ``MAX_GROUPS``."""
    grid = [min(max(p + side * 2 / accuracy, 0.0), 1.0) for p in probs for side in (-1, 1)]
    aggs = list(extra)
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.percentile_approx(x, grid, accuracy).alias(f"q{i}")]
    rows = (df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)).limit(MAX_GROUPS + 1).collect()
    return rows if len(rows) <= MAX_GROUPS else None


def _merged(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint brackets in ascending order."""
    out: list[tuple[float, float]] = []
    for a, b in sorted(brackets):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _with_brackets(df: DataFrame, rows: list, by: Sequence[str], table: list[dict[str, float | None]]) -> DataFrame:
    """``df`` with the columns of ``table`` (a dict a row of ``rows``) of its group."""
    names = list(table[0])
    if not by:
        return df.withColumns({n: F.lit(table[0][n]).cast("double") for n in names})
    schema = T.StructType([T.StructField(f"__b{k}", df.schema[b].dataType) for k, b in enumerate(by)]
                          + [T.StructField(n, T.DoubleType()) for n in names])
    side = df.sparkSession.createDataFrame([(*[r[b] for b in by], *t.values()) for r, t in zip(rows, table)], schema)
    on = reduce(lambda x, y: x & y, [F.col(b).eqNullSafe(F.col(f"__b{k}")) for k, b in enumerate(by)])
    return df.join(F.broadcast(side), on).drop(*[f"__b{k}" for k in range(len(by))])  # at most MAX_GROUPS rows


def bracket_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), *,
                      accuracy: int = ACCURACY, few: int = 20_000, rows: list | None = None) -> DataFrame | None:
    """Exact linear-interpolation quantiles: (*by, column, p, value), a row a
    group, column and probability; columns without a value in a group have none.
    ``rows`` may hold the sketches of an earlier pass. None if there are too many
    groups to broadcast. The result is bounded (``MAX_GROUPS`` x columns x
    probabilities) and fetched, which also shows whether each rank was inside its
    bracket; else the column's values are counted without brackets."""
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    rows = _sketches(df, cols, probs, by, accuracy) if rows is None else rows
    if rows is None:
        return None
    wide = df.select(*by, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    # brackets[row][column][target] = (low, high, rows between at most)
    brackets = [[[_first_bracket(r, i, t, p, accuracy, few) for t, p in enumerate(probs)] for i in range(len(cols))] for r in rows]
    while any(m > few and a < b for g in brackets for c in g for a, b, m in c):
        brackets = _narrowed(wide, rows, by, probs, brackets, accuracy, few)
    out = _select(wide, rows, cols, probs, by, brackets)
    if any(v[-1] is None for v in out):
        out = _select(wide, rows, cols, probs, by, [[[(r[f"lo{i}"], r[f"hi{i}"], 0)] for i in range(len(cols))] for r in rows])
    kinds = [df.schema[b] for b in by] + [T.StructField("column", T.StringType()), T.StructField("p", T.DoubleType()),
                                          T.StructField("value", T.DoubleType())]
    return df.sparkSession.createDataFrame(out, T.StructType(kinds))


def _select(wide: DataFrame, rows: list, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], brackets: list) -> list[tuple]:
    """The values at the wanted ranks; null where a rank lies outside its bracket."""
    merged = [[_merged([(a, b) for a, b, _ in c if a is not None]) for c in g] for g in brackets]
    most = max((len(c) for g in merged for c in g), default=0)
    if not most:
        return []
    table = [{f"__{end}{i}_{k}": (c[k][e] if k < len(c) else None) for i, c in enumerate(g) for k in range(most) for e, end in enumerate("ab")}
             for g in merged]
    placed = _with_brackets(wide, rows, by, table)
    cells = []
    for i, c in enumerate(cols):
        x = F.col(f"__x{i}")
        above = sum((F.coalesce((x > F.col(f"__b{i}_{k}")).cast("int"), F.lit(0)) for k in range(most)), F.lit(0))
        inside = reduce(lambda u, v: u | v, [F.coalesce(x.between(F.col(f"__a{i}_{k}"), F.col(f"__b{i}_{k}")), F.lit(False)) for k in range(most)])
        cells.append(F.struct(F.lit(c).alias("column"), (2 * above + inside.cast("int")).alias("region"),
                              F.when(inside, x).alias("v"), x.isNotNull().alias("given")))
    counts = (placed.select(*by, F.explode(F.array(*cells)).alias("c")).where("c.given")
              .groupBy(*by, "c.column", "c.region", "c.v").agg(F.count(F.lit(1)).alias("__c")))
    upto = Window.partitionBy(*by, "column").orderBy("region", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("__end", F.sum("__c").over(upto))
    # the wanted ranks of each group and column
    kinds = [T.StructField(f"__b{k}", wide.schema[b].dataType) for k, b in enumerate(by)]
    wanted = [(*[r[b] for b in by], c, p, math.floor(q), math.ceil(q), q - math.floor(q))
              for r in rows for i, c in enumerate(cols) if r[f"n{i}"] for p in probs for q in [p * (r[f"n{i}"] - 1)]]
    targets = wide.sparkSession.createDataFrame(wanted, T.StructType(kinds + [
        T.StructField("__col", T.StringType()), T.StructField("p", T.DoubleType()), T.StructField("__lo", T.LongType()),
        T.StructField("__hi", T.LongType()), T.StructField("__f", T.DoubleType())]))
    on = reduce(lambda x, y: x & y, [F.col(b).eqNullSafe(F.col(f"__b{k}")) for k, b in enumerate(by)], F.col("column") == F.col("__col"))
    start = F.col("__end") - F.col("__c")
    at = lambda r: (F.col(r) >= start) & (F.col(r) < F.col("__end"))
    hits = counts.join(F.broadcast(targets), on).where(at("__lo") | at("__hi"))  # MAX_GROUPS x columns x probabilities at most
    out = hits.groupBy(*by, "column", "p").agg(F.max(F.when(at("__lo"), F.col("v"))).alias("__l"),
                                               F.max(F.when(at("__hi"), F.col("v"))).alias("__h"), F.max("__f").alias("__f"))
    value = F.col("__l") + F.col("__f") * (F.col("__h") - F.col("__l"))
    return [tuple(r) for r in out.select(*by, "column", "p", value.alias("value")).collect()]


def _first_bracket(r, i: int, t: int, p: float, accuracy: int, few: int) -> tuple:
    """Two values around the rank of ``p``, and how many rows lie between at most:
    all where they are few (the sketch's error is then below a rank or two)."""
    n, lo, hi, q = r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"], r[f"q{i}"]
    if not n:
        return None, None, 0
    if n <= max(few, 20 * accuracy):
        return lo, hi, 0
    return (q[2 * t] if p > 2 / accuracy else lo, q[2 * t + 1] if p < 1 - 2 / accuracy else hi, 6 * n // accuracy + 2)


def _narrowed(wide: DataFrame, rows: list, by: Sequence[str], probs: Sequence[float], brackets: list, accuracy: int, few: int) -> list:
    """Brackets about 30 times narrower: what lies below and between is counted,
    and what lies between is sketched at every hundredth."""
    table = [{f"__{end}{i}_{t}": c[t][e] for i, c in enumerate(g) for t in range(len(probs)) for e, end in enumerate("ab")} for g in brackets]
    placed, aggs, grid = _with_brackets(wide, rows, by, table), [], [k / 100 for k in range(101)]
    for i in range(len(brackets[0])):
        for t in range(len(probs)):
            x, a, b = F.col(f"__x{i}"), F.col(f"__a{i}_{t}"), F.col(f"__b{i}_{t}")
            aggs += [F.count_if(x < a).alias(f"below{i}_{t}"), F.count_if(x.between(a, b)).alias(f"in{i}_{t}"),
                     F.percentile_approx(F.when(x.between(a, b), x), grid, accuracy).alias(f"q{i}_{t}")]
    got = (placed.groupBy(*by).agg(*aggs) if by else placed.agg(*aggs)).collect()  # a row a group
    at = {tuple(g[b] for b in by): g for g in got}
    out = []
    for r, g in zip(rows, brackets):
        s, new = at[tuple(r[b] for b in by)], []
        for i, c in enumerate(g):
            new.append([])
            for t, (a, b, m) in enumerate(c):
                if m > few and a < b:
                    n, between = probs[t] * (r[f"n{i}"] - 1) - s[f"below{i}_{t}"], s[f"in{i}_{t}"]
                    if not 0 <= n <= between - 1:    # the sketch missed the rank
                        new[-1].append((r[f"lo{i}"], r[f"hi{i}"], 0))
                        continue
                    k, q, spare = math.floor(100 * n / between), s[f"q{i}_{t}"], 1 + math.ceil(200 / accuracy)
                    low, high = q[k - spare] if k > spare else a, q[k + 1 + spare] if k + 1 + spare < 100 else b
                    # equal values can't be told apart by narrowing: they are one count
                    a, b, m = low, high, 0 if (low, high) == (a, b) else between * (1 + 2 * spare) // 100 + 2 * between // accuracy + 2
                new[-1].append((a, b, m))
        out.append(new)
    return out


def _columns(df: DataFrame, cols: Sequence[str], stored: bool) -> DataFrame:
    """These columns of ``df``, stored for several passes unless they are already."""
    return df if stored else shared_table(df.select(*dict.fromkeys(cols)), "passes")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    *, num_partitions: int | None = None, out: str = "value",
                    checkpoint: bool = False, stored: bool = False) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per ``by`` group.

    Returns one row per (group, p): ``*by, p, <out>``. Nulls are ignored.
    ``num_partitions`` and ``checkpoint`` apply to very many groups only.
    """
    df = _columns(df, [*by, value], stored)
    got = bracket_quantiles(df, [value], probs, by)
    if got is None:
        return ranged_quantiles(df, value, probs, by, num_partitions=num_partitions, out=out, checkpoint=checkpoint)
    return got.select(*by, "p", F.col("value").alias(out))


def ranged_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                     *, num_partitions: int | None = None, out: str = "value",
                     checkpoint: bool = False) -> DataFrame:
    """The same by value counts in a stored range layout, for any number of groups."""
    by = list(by)
    probs = [float(p) for p in probs]
    ranged = ranged_value_counts(df, value, by, num_partitions=num_partitions, checkpoint=checkpoint)

    part = ranged.groupBy(*by, "__pid").agg(F.sum("__c").alias("__pn"))
    before = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    part = (part.withColumn("__off", F.coalesce(F.sum("__pn").over(before), F.lit(0)))
                .withColumn("__n", F.sum("__pn").over(Window.partitionBy(*by))))
    pos = [F.lit(p) * (F.col("__n") - 1) for p in probs]
    targets = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), F.floor(q).alias("lo"),
                 F.ceil(q).alias("hi"), (q - F.floor(q)).alias("frac"))
        for i, (p, q) in enumerate(zip(probs, pos))
    ])
    part = part.withColumn("__t", targets).select(*[F.col(b).alias(f"__b{i}") for i, b in enumerate(by)],
                                                  F.col("__pid").alias("__ppid"), "__off", "__n", "__t")
    on = F.col("__pid") == F.col("__ppid")
    for i, b in enumerate(by):  # a null group is a group
        on = on & F.col(b).eqNullSafe(F.col(f"__b{i}"))
    joined = ranged.join(part, on, "inner")
    start = F.col("__off") + F.col("__end") - F.col("__c")
    end = F.col("__off") + F.col("__end")
    covers = lambda r: (r >= start) & (r < end)
    joined = joined.where(F.exists("__t", lambda t: covers(t["lo"]) | covers(t["hi"])))
    hits = (joined.select(*by, "__v", start.alias("__s"), end.alias("__e"), F.explode("__t").alias("t"))
                  .where(((F.col("t.lo") >= F.col("__s")) & (F.col("t.lo") < F.col("__e")))
                         | ((F.col("t.hi") >= F.col("__s")) & (F.col("t.hi") < F.col("__e")))))
    in_lo = (F.col("t.lo") >= F.col("__s")) & (F.col("t.lo") < F.col("__e"))
    in_hi = (F.col("t.hi") >= F.col("__s")) & (F.col("t.hi") < F.col("__e"))
    agg = (hits.groupBy(*by, F.col("t.i").alias("__i"))
               .agg(F.first("t.p").alias("p"), F.first("t.frac").alias("__f"),
                    F.max(F.when(in_lo, F.col("__v"))).alias("__lo"),
                    F.max(F.when(in_hi, F.col("__v"))).alias("__hi")))
    result = F.col("__lo") + F.col("__f") * (F.col("__hi") - F.col("__lo"))
    return agg.select(*by, "p", result.alias(out))


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                     accuracy: int = 10_000, out: str = "value") -> DataFrame:
    """Sketch-based quantiles (bounded memory, one pass) for very large groups."""
    by = list(by)
    agg = df.groupBy(*by).agg(F.percentile_approx(value, [float(p) for p in probs], accuracy).alias("__q"))
    return agg.select(*by, F.posexplode("__q").alias("__i", out)).select(
        *by, F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1).alias("p"), out)


def percentile_exact(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                     method: str = "exact", stored: bool = False) -> DataFrame:
    """Wide result: one row per group, one column ``p<100*p>`` per probability."""
    by = list(by)
    long = (exact_quantiles(df, value, probs, by, stored=stored) if method == "exact"
            else approx_quantiles(df, value, probs, by))
    names = {float(p): "p" + format(float(p) * 100, "g").replace(".", "_") for p in probs}
    cols = [F.max(F.when(F.col("p") == F.lit(p), F.col("value"))).alias(n) for p, n in names.items()]
    if by:
        return long.groupBy(*by).agg(*cols)
    return long.agg(*cols)


def quantile_scalars(df: DataFrame, value: str, probs: Sequence[float], stored: bool = False) -> list[float | None]:
    """Driver-side list of a few overall quantiles (a bounded, tiny result)."""
    rows = exact_quantiles(df, value, probs, stored=stored).collect()
    got = {float(r["p"]): r["value"] for r in rows}
    return [got.get(float(p)) for p in probs]


def trim_outliers(df: DataFrame, value: str, p_lo: float, p_hi: float) -> DataFrame:
    """Rows whose ``value`` lies between the two percentiles (inclusive).

    The rows are stored once; the two bounds are computed from them by a
    distributed job and used as literals, so the final filter is pushed into
    the scan of what is stored.
    """
    df = shared_table(df, "trim")
    lo, hi = quantile_scalars(df, value, [p_lo, p_hi], stored=True)
    if lo is None:
        return df.limit(0)
    return df.filter(F.col(value).between(F.lit(lo), F.lit(hi)))


def histogram(df: DataFrame, value: str, bins: int = 40, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """Equal-width histogram over [lo, hi]; last bin closed, empty bins kept.

    Bounds default to the column's min and max. Columns: bin, bin_lo, bin_hi, n.
    """
    if lo is None or hi is None:
        mm = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
        lo = mm["lo"] if lo is None else lo
        hi = mm["hi"] if hi is None else hi
    spark = df.sparkSession
    if lo is None:
        return spark.range(bins).select(F.col("id").alias("bin"), F.lit(None).cast("double").alias("bin_lo"),
                                        F.lit(None).cast("double").alias("bin_hi"), F.lit(0).cast("bigint").alias("n"))
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins
    x = F.col(value)
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0).cast("bigint")
    counts = (df.where(x.between(F.lit(lo), F.lit(hi)))
                .groupBy(b.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    domain = spark.range(bins).withColumnRenamed("id", "bin")
    # ``counts`` has at most ``bins`` rows: a proven bound.
    out = domain.join(F.broadcast(counts), "bin", "left")
    return out.select("bin",
                      (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), method: str = "exact", stored: bool = False) -> DataFrame:
    """Box-plot numbers per group: q1, median, q3, whisker ends (most extreme
    values inside 1.5 IQR fences), outlier count, n."""
    by = list(by)
    df = _columns(df, [*by, value], stored)
    q = percentile_exact(df, value, [0.25, 0.5, 0.75], by, method=method, stored=True)
    q = q.select(*by, F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"))
    q = (q.withColumn("__lf", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
          .withColumn("__hf", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    keyed = by or ["__g"]
    data = df.where(F.col(value).isNotNull())
    if not by:
        data = data.withColumn("__g", F.lit(0))
        q = q.withColumn("__g", F.lit(0))
    # one row per group: collected once behind the size check, then used both
    # as the broadcast fences and for the output (quantiles are not recomputed)
    fences = checked_broadcast(q.select(*keyed, "q1", "median", "q3", "__lf", "__hf"))
    x = F.col(value)
    stats = (data.join(fences.select(*keyed, "__lf", "__hf"), keyed, "inner").groupBy(*keyed).agg(
        F.min(F.when(x >= F.col("__lf"), x)).alias("whisker_lo"),
        F.max(F.when(x <= F.col("__hf"), x)).alias("whisker_hi"),
        F.count(F.when((x < F.col("__lf")) | (x > F.col("__hf")), 1)).alias("n_out"),
        F.count(F.lit(1)).alias("n")))
    return fences.join(stats, keyed, "inner").select(*by, "q1", "median", "q3", "whisker_lo", "whisker_hi",
                                                     "n_out", "n")


def ols_trend(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of y on x: slope, intercept, r2, n (pairs with both set)."""
    by = list(by)
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2"),
            F.regr_count(F.col(y), F.col(x)).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


_DESCRIBE_ORDER = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int | None = 2,
                     method: str = "exact") -> DataFrame:
    """pandas-style ``describe``: rows count, mean, std (sample), min, 25%, 50%,
    75%, max; one column per input column; exact percentiles. Two passes over
    a stored copy of the columns: the second for the exact quartiles."""
    cols, quartiles = list(cols), [0.25, 0.5, 0.75]
    df = _columns(df, cols, False)
    simple = [a for i, c in enumerate(cols) for x in [F.col(c).cast("double")]
              for a in (F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"))]
    rows = _sketches(df, cols, quartiles, [], ACCURACY, simple)  # one row
    one = rows[0]
    if method == "exact":
        got = bracket_quantiles(df, cols, quartiles, rows=rows).collect()
        exact = {(r["column"], r["p"]): r["value"] for r in got}
    else:
        sketch = df.agg(*[F.percentile_approx(F.col(c).cast("double"), quartiles, 10_000).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        exact = {(c, p): sketch[f"q{i}"][t] if sketch[f"q{i}"] else None for i, c in enumerate(cols) for t, p in enumerate(quartiles)}
    table = []
    for order, stat in enumerate(_DESCRIBE_ORDER):
        values = []
        for i, c in enumerate(cols):
            plain = {"count": float(one[f"n{i}"]), "mean": one[f"mean{i}"], "std": one[f"std{i}"], "min": one[f"lo{i}"], "max": one[f"hi{i}"]}
            values.append(plain[stat] if stat in plain else exact.get((c, float(stat[:-1]) / 100)))
        table.append((stat, *values, order))
    out = df.sparkSession.createDataFrame(table, T.StructType(
        [T.StructField("stat", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in cols] + [T.StructField("stat_order", T.IntegerType())]))
    return out.withColumns({c: F.round(c, digits) for c in cols}) if digits is not None else out
