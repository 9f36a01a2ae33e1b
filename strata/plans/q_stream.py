"""Registered speed-layer queries (F8, F9, P6, J8, T5, T7, T8), batch form.

The same transforms run inside the streaming jobs (``strata.streaming.jobs``);
here they run over the whole event table as a static DataFrame so the
result is deterministic and comparable with SQL. Stream-only behaviour
(watermark drops, restart from checkpoint) is covered by the two-drain tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import contracts as C
from ..sources import testdata as D
from ..streaming import speed
from . import oracle as O
from .q_scd2 import _with, merged_dim
from .registry import AS_OF, query

_REQ = O._REQ
_PAYLOADS = "SELECT event_id, payload FROM payloads"
_VALID_EVENTS = "SELECT * FROM valid_events"
_EV = ("raw_events", "payloads", "valid_events")


def valid_events(spark, sf):
    valid, _ = speed.ingest_events(D.event_payloads(spark, sf), watermark=None)
    return valid


@query("event_validation", O.sql(f"""
    SELECT event_id, CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT'
                          AND list_has_all(json_keys(payload), [{_REQ}]) ELSE FALSE END AS is_valid
    FROM ({_PAYLOADS}) p""", *_EV))
def q_event_validation(spark, sf):
    p = D.event_payloads(spark, sf)
    return p.select("event_id", speed.has_required_keys("value", C.EVENT_REQUIRED_KEYS).alias("is_valid"))


@query("event_ingest", O.sql(_VALID_EVENTS, *_EV))
def q_event_ingest(spark, sf):
    return valid_events(spark, sf)


@query("event_quarantine_counts", O.sql(f"""
    SELECT count(*) AS n_quarantined FROM ({_PAYLOADS}) p
    WHERE NOT CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT'
                   AND list_has_all(json_keys(payload), [{_REQ}]) ELSE FALSE END""", *_EV))
def q_event_quarantine(spark, sf):
    _, bad = speed.ingest_events(D.event_payloads(spark, sf), watermark=None)
    return bad.agg(F.count(F.lit(1)).alias("n_quarantined"))


@query("speed_filter", O.sql(f"""
    SELECT * FROM ({_VALID_EVENTS}) v WHERE order_value > 0 AND order_status IS NOT NULL""", *_EV))
def q_speed_filter(spark, sf):
    return speed.speed_filter(valid_events(spark, sf))


@query("stream_enriched", _with(f"""
SELECT v.customer_id, v.order_id, v.order_status, v.event_timestamp, v.order_value,
       m.customer_state, m.customer_city, TIMESTAMP '{AS_OF} 00:00:00' AS processing_timestamp
FROM ({_VALID_EVENTS}) v LEFT JOIN (SELECT * FROM merged WHERE is_current) m ON v.customer_id = m.customer_id
WHERE v.order_value > 0 AND v.order_status IS NOT NULL""", *_EV, merged=True))
def q_stream_enriched(spark, sf):
    ev = speed.speed_filter(valid_events(spark, sf))
    dim = merged_dim(spark, sf, "on_change")
    return speed.enrich_events(ev, dim, F.lit(f"{AS_OF} 00:00:00").cast("timestamp"))


@query("stream_dedup", O.sql(f"""
    SELECT * FROM ({_VALID_EVENTS}) v
    QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_timestamp ASC NULLS LAST,
             customer_id ASC NULLS LAST, order_status ASC NULLS LAST, order_value ASC NULLS LAST) = 1""",
                              *_EV))
def q_stream_dedup(spark, sf):
    return speed.dedup_events(valid_events(spark, sf), ["order_id"])


@query("stream_hourly_counts", O.sql(f"""
    SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start,
           time_bucket(INTERVAL 1 HOUR, event_timestamp) + INTERVAL 1 HOUR AS window_end,
           order_status, count(*) AS n_events,
           CAST(SUM(CAST(order_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM ({_VALID_EVENTS}) v WHERE order_value > 0 AND order_status IS NOT NULL
    GROUP BY 1, 2, 3""", *_EV))
def q_stream_hourly(spark, sf):
    return speed.hourly_counts(speed.speed_filter(valid_events(spark, sf)))


@query("stream_hour_partitions", O.sql(f"""
    SELECT CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month,
           CAST(day(event_timestamp) AS INTEGER) AS day, CAST(hour(event_timestamp) AS INTEGER) AS hour,
           count(*) AS n_events
    FROM ({_VALID_EVENTS}) v GROUP BY 1, 2, 3, 4""", *_EV))
def q_stream_hour_partitions(spark, sf):
    ev = speed.hour_partition_cols(valid_events(spark, sf))
    return ev.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n_events"))
