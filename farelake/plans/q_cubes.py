"""Registered queries: the frames of the four screens read from a stored cube of
the trips, which two runs have built. The SQL is that of the frames over the
trips themselves (inventory section 2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake.plans import cube_screens as CS
from farelake.plans import q_analytics  # noqa: F401  (its SQL is used below)
from farelake.plans.catalog import ORACLE, T, Z, register, rnd
from farelake.plans.q_sources import scratch
from farelake.session import shared_table
from farelake.sinks.commits import table_exists

_STORED: dict[tuple[str, str], str] = {}


def stored_cells(spark, d):
    """The cube of the trips under ``d``, built once a session: a run over the
    earlier pickup years, then a run that adds the later ones."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _STORED or not table_exists(spark, _STORED[at], CS.TABLE):
        root = scratch(spark, "cube")
        # the joined trips are stored once for the two runs, with the columns that the cube reads
        t = shared_table(T(spark, d).drop("id_vendor", "id_payment_type", "id_rate", "passenger_count"), "cube-trips")
        lo, hi = t.agg(F.min(F.year("pickup_datetime")), F.max(F.year("pickup_datetime"))).first()
        early = F.year("pickup_datetime") <= ((lo or 0) + (hi or 0)) // 2
        for part in (early, ~early):
            CS.refresh_cube(spark, root, t.where(part))
        _STORED[at] = root
    return CS.read_cube(spark, _STORED[at])


def _frame(name: str, screen, frame: str, *rounded, zones: bool = False, **filters) -> None:
    @register(f"cube_{name}", ORACLE[name])
    def q(spark, d):
        out = screen(stored_cells(spark, d), *((Z(spark, d),) if zones else ()), **filters)[frame]
        if frame.startswith("trend"):
            return out.withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 4), "r2": F.round("r2", 6)})
        return rnd(out, *rounded) if rounded else out


_frame("screen_demand", CS.demand, "temporal", service="greenTaxi")
for _f in ("by_hour", "by_month_service"):
    _frame(f"screen_demand_{_f}", CS.demand, _f, service="greenTaxi", weekday="Segunda-feira")

_frame("screen_efficiency", CS.efficiency, "by_service", "mean_revenue_hour", zones=True, year=1997)
for _f, _mean in (("duration", "mean_duration_min"), ("distance", "mean_distance"), ("revenue_trip", "mean_revenue_trip"),
                  ("revenue_hour", "mean_revenue_hour"), ("top_regions", "mean_revenue_hour")):
    _frame(f"screen_efficiency_{_f}", CS.efficiency, _f, _mean, zones=True, service="yellowTaxi")

_frame("screen_hotspots", CS.hotspots, "evolution", zones=True, service="yellowTaxi", ref_year=1998)
for _f in ("top_pickup", "top_dropoff", "heatmap"):
    _frame(f"screen_hotspots_{_f}", CS.hotspots, _f, zones=True, service="yellowTaxi")
for _f in ("years", "seasons", "services"):
    _frame(f"screen_hotspots_{_f}", CS.hotspots, _f, zones=True)

for _f, _mean in (("fare", "mean_fare"), ("tip", "mean_tip")):
    _frame(f"screen_fares_{_f}", CS.fares, _f, _mean, service="greenTaxi")
for _f in ("trend_duration", "trend_distance"):
    _frame(f"screen_fares_{_f}", CS.fares, _f, service="greenTaxi")
