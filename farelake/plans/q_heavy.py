"""Registered queries: top keys of large domains by mergeable summaries
(inventory section 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake.functions import columns as C
from farelake.operators import heavy as H
from farelake.plans.catalog import SEASON_PT, WT, T, register
from farelake.plans.q_sources import scratch

PAIR = ["id_location_pickup", "id_location_dropoff"]
PAIR_DAY = [*PAIR, "pickup_datetime"]
_SET = " AND ".join(f"{c} IS NOT NULL" for c in PAIR)


def _summarised(spark, d, cols):
    """The trips, stored, and a stored summary of each pickup year."""
    at, kept = scratch(spark, "pairs"), scratch(spark, "summaries")
    T(spark, d).select(*PAIR, "pickup_datetime").write.parquet(at)
    t = spark.read.parquet(at)
    H.key_summaries(t, cols, [C.year_of("pickup_datetime").alias("year")]).write.parquet(kept)
    return t, spark.read.parquet(kept)


@register("top_od_pairs", f"""{WT} SELECT {', '.join(PAIR)}, count(*) AS n FROM t WHERE {_SET}
GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 20""")
def q_top_od_pairs(spark, d):
    t, summaries = _summarised(spark, d, PAIR)
    return H.top_k_keys(t, PAIR, 20, summaries=summaries)


@register("top_od_pair_days", f"""{WT} SELECT {', '.join(PAIR_DAY)}, count(*) AS n FROM t
WHERE {_SET} AND pickup_datetime IS NOT NULL GROUP BY 1, 2, 3 ORDER BY n DESC, 1, 2, 3 LIMIT 50""")
def q_top_od_pair_days(spark, d):
    t, summaries = _summarised(spark, d, PAIR_DAY)
    return H.top_k_keys(t, PAIR_DAY, 50, summaries=summaries)


@register("hotspot_pair_evolution", f"""{WT},
top AS (SELECT {', '.join(PAIR)} FROM t WHERE {_SET} AND year(pickup_datetime) = 1998
        GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 5)
SELECT {SEASON_PT('month(pickup_datetime)')} AS season, {', '.join(PAIR)}, count(*) AS trips
FROM t JOIN top USING ({', '.join(PAIR)}) GROUP BY 1, 2, 3""")
def q_hotspot_pair_evolution(spark, d):
    t = T(spark, d)
    return H.pair_evolution(t, PAIR, C.season_label(C.month_of("pickup_datetime")).alias("season"), 5,
                            reference=t.where(F.year("pickup_datetime") == 1998))
