"""SQL access: the pipeline's tables and reports as temp views.

A user who queried the reference's tables and report views by name can do
the same with ``spark.sql`` after ``register_views``. Names are the
reference's table names without schema prefix (temp views have none); the
reports take the report date at registration instead of the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from depotlens.operators import facts as fx
from depotlens.operators import reports
from depotlens.plans.pipeline import Pipeline

REPORT_VIEWS = ("rpt_pickup_station_claims_14d", "rpt_recipients_over5_complaints_2m")


def register_views(pipeline: Pipeline, as_of: dt.date) -> dict[str, DataFrame]:
    """Create or replace temp views over the current state and return them."""
    st = pipeline.store
    views: dict[str, DataFrame] = {"landing_file": pipeline.ledger()}
    for name in ("stg_complaint", "stg_delivery_event", "dim_pickup_station", "fact_delivery_event",
                 "monitoring_complaints"):
        if st.has(name):
            views[name] = st.get(name)
    snapshots = pipeline.snapshots()
    if snapshots is not None:
        views["stg_pickup_station"] = snapshots
    links = st.get("complaint_station_link") if st.has("complaint_station_link") else None
    if st.has("fact_complaint"):
        fact = st.get("fact_complaint")
        views["fact_complaint"] = fx.complaint_view(fact, links)
        if links is not None and "dim_pickup_station" in views:
            dim = views["dim_pickup_station"]
            views["rpt_pickup_station_claims_14d"] = reports.station_claims(fact, links, dim, as_of)
            views["rpt_recipients_over5_complaints_2m"] = reports.frequent_recipients(fact, links, dim, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
