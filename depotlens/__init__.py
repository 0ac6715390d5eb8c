"""depotlens: daily parcel-service monitoring as Spark DataFrame jobs.

Every step is a function from DataFrames (plus explicit ``as_of`` date and
``run_ts`` timestamp) to a DataFrame, so a run can be repeated and tested.
State tables (ledger, station history, facts, links) are written by
:mod:`depotlens.sources.store` as parquet versions under the shared folder
named by ``spark.checkpoint.dir``.
"""

__all__ = ["session", "schemas"]
