"""Timestamp quality and table profiles of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as op
from . import inputs as px
from .registry import query, rounded

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
STREAM = ["session_id", "kind"]
GAPS = "gaps AS (SELECT * FROM (SELECT session_id, kind, event_id, client_ms AS ts_ms, CAST(client_ms-lag(client_ms) OVER (PARTITION BY session_id, kind ORDER BY client_ms, event_id) AS DOUBLE) AS gap FROM px_events) WHERE gap IS NOT NULL)"


def gaps(spark, d):
    rows = px.events(spark, d).selectExpr("session_id", "kind", "event_id", "client_ms AS ts_ms")
    return op.frame_gaps(rows, STREAM, ["ts_ms", "event_id"], 30 * px.DAY)


@query(
    "l1_stream_rates",
    "SELECT session_id, kind, min(client_ms) AS first_ms, max(client_ms) AS last_ms, count(*) AS n, (max(client_ms)-min(client_ms))/1000.0::DOUBLE AS duration_s, round(count(*)/nullif((max(client_ms)-min(client_ms))/1000.0::DOUBLE,0),9) AS rate FROM px_events GROUP BY 1,2",
)
def _(spark, d):
    return rounded(op.rates(px.events(spark, d), ["session_id", "kind"], "client_ms"), 9, "rate")


@query(
    "l2_event_times",
    """WITH e AS (SELECT kind, event_id, CASE WHEN kind='view' OR value<5 THEN 0 ELSE client_ms END AS client_ms, client_ms+7 AS server_ms FROM px_events)
 SELECT kind, event_id, CASE WHEN m>0 THEN client_ms ELSE server_ms END AS ts_ms FROM (SELECT *, max(client_ms) OVER (PARTITION BY kind) AS m FROM e) WHERE m<=0 OR client_ms>0""",
)
def _(spark, d):
    e = px.events(spark, d).selectExpr("kind", "event_id", "CASE WHEN kind = 'view' OR value < 5 THEN 0 ELSE client_ms END AS client_ms", "client_ms + 7 AS server_ms")
    return op.event_times(e, ["kind"]).select("kind", "event_id", "ts_ms")


@query(
    "l3_gap_stats",
    f"WITH {GAPS} SELECT session_id, kind, count(*) AS n_gaps, min(gap) AS min_gap, max(gap) AS max_gap, round(avg(gap),3) AS mean_gap, round(stddev_pop(gap),3) AS std_gap, sum(gap) AS session_ms, round(median(gap),3) AS median_gap, round(1000/avg(gap),9) AS hz FROM gaps GROUP BY 1,2",
)
def _(spark, d):
    out = op.gap_stats(gaps(spark, d), STREAM)
    return rounded(rounded(out, 3, "mean_gap", "std_gap", "median_gap"), 9, "hz")


@query(
    "l4_gap_outliers",
    f"""WITH {GAPS}, s AS (SELECT session_id, kind, median(gap) AS m, stddev_pop(gap) AS s FROM gaps GROUP BY 1,2),
 o AS (SELECT session_id, kind, event_id, gap, abs(gap-m) AS deviation FROM gaps JOIN s USING (session_id, kind) WHERE abs(gap-m)>1.5*s)
 SELECT session_id, kind, event_id, gap, round(deviation,3) AS deviation FROM (SELECT *, row_number() OVER (PARTITION BY session_id, kind ORDER BY deviation DESC, event_id) AS r FROM o) WHERE r<=2""",
)
def _(spark, d):
    out = op.gap_outliers(gaps(spark, d), STREAM, ["event_id"], 1.5, 2)
    return rounded(out.select("session_id", "kind", "event_id", "gap", "deviation"), 3)


@query(
    "l5_common_gaps",
    f"""WITH {GAPS}, r AS (SELECT session_id, round_even(gap/3600000, 2) AS gap, count(*) AS n FROM gaps GROUP BY 1,2),
 k AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, gap) AS r, sum(n) OVER (PARTITION BY session_id) AS total FROM r)
 SELECT session_id, gap, n, round(n*100.0::DOUBLE/total,6) AS percent FROM k WHERE r<=10""",
)
def _(spark, d):
    hours = gaps(spark, d).withColumn("gap", F.col("gap") / 3600000)
    return rounded(op.common_gaps(hours, ["session_id"]))


@query(
    "l6_clock_offsets",
    """SELECT session_id, kind, round(min(value),6) AS min_offset, round(max(value),6) AS max_offset, round(avg(value),6) AS mean_offset, round(stddev_pop(value),6) AS std_offset,
 (min(client_ms)-first_ms)/1000.0::DOUBLE AS start_s FROM px_events JOIN (SELECT session_id, min(client_ms) AS first_ms FROM px_events GROUP BY 1) USING (session_id) GROUP BY session_id, kind, first_ms""",
)
def _(spark, d):
    rows = px.events(spark, d)
    return rounded(op.offsets(rows, "kind", ["session_id"], "client_ms", "value"), 6, "min_offset", "max_offset", "mean_offset", "std_offset")


INV = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, CAST(count(*) AS INT) AS n_columns, CAST(count(*) FILTER (column_type IN ('INTEGER','BIGINT','DOUBLE','FLOAT')) AS INT) AS n_numeric, {str(t == 'embeddings').lower()} AS has_eeg, {str(t == 'lineitem').lower()} AS has_fnirs FROM (DESCRIBE {t})"
    for t in TABLES
)


@query("l7_table_inventory", INV)
def _(spark, d):
    tables = {t: px.table(spark, d, t) for t in TABLES}
    return op.inventory(tables, {"eeg": ["embeddings"], "fnirs": ["lineitem"]})


PROFILED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "l8_column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(min({c})::DOUBLE,4) AS min, round(max({c})::DOUBLE,4) AS max, round(avg({c}),4) AS mean, round(stddev_pop({c}),4) AS std, bool_or({c}=0) AS has_zeros, bool_or(isnan({c}::DOUBLE)) AS has_nan FROM lineitem"
        for c in PROFILED
    ),
)
def _(spark, d):
    return rounded(op.profile(px.table(spark, d, "lineitem")), 4)
