import datetime as dt

from pyspark.sql import functions as F

from depotlens.schemas import STATION_LIST

T1 = dt.datetime(2024, 3, 1, 6, 0, 0)
T2 = dt.datetime(2024, 3, 2, 6, 0, 0)
T3 = dt.datetime(2024, 3, 3, 6, 0, 0)
D1, D2, D3 = T1.date(), T2.date(), T3.date()


def stations(spark, rows):
    """rows: (identifier, name, city, zip_code, street)"""
    return spark.createDataFrame(rows, STATION_LIST)


def as_dicts(df, order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def current(dim):
    return {r["ref_identifier"]: r["pickup_station_id"]
            for r in dim.where(F.col("is_current")).collect()}
