"""Typed staging rows, exact duplicates removed over the business columns only."""

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.functions.keys import exact, from_epoch_ms
from cadenza.schemas import EVENT_SCHEMAS

_CASTS = {
    "ts": lambda c: c.cast("timestamp"),
    "registration": from_epoch_ms,
    "lon": exact,
    "lat": exact,
    "duration": exact,
    "sessionId": lambda c: c.cast("int"),
    "itemInSession": lambda c: c.cast("int"),
    "userId": lambda c: c.cast("int"),
    "status": lambda c: c.cast("int"),
    "success": lambda c: c.cast("boolean"),
}


def typed(name: str) -> Column:
    cast = _CASTS.get(name, lambda c: c.cast("string"))
    return cast(F.col(name)).alias(name)


def exact_rows(df: DataFrame, business_columns: list[str]) -> DataFrame:
    """An event delivered at two offsets collapses, because delivery columns go first.

    The distinct is a hash aggregate: copies are merged in the map task before the shuffle, so a
    heavily repeated row never travels more than once per task.
    """
    return df.select(*business_columns).distinct()


def stage(landing: DataFrame, topic: str) -> DataFrame:
    names = EVENT_SCHEMAS[topic].fieldNames()
    return exact_rows(landing.select(*[typed(n) for n in names]), names)


def stg_auth_events(landing: DataFrame) -> DataFrame:
    return stage(landing, "auth_events")


def stg_listen_events(landing: DataFrame) -> DataFrame:
    return stage(landing, "listen_events")


def stg_page_view_events(landing: DataFrame) -> DataFrame:
    return stage(landing, "page_view_events")


def stg_status_change_events(landing: DataFrame) -> DataFrame:
    return stage(landing, "status_change_events")
