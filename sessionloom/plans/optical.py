"""Optical channel queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ordered import dealt
from ..operators import optical as op
from . import inputs as px
from .registry import query, rounded

NAME = """'W'||wave||'('||CASE wave WHEN 0 THEN 'Red' ELSE 'IR' END||')_M'||moment||'('||CASE moment WHEN 0 THEN 'Zeroth' WHEN 1 THEN 'First' ELSE 'Second' END||')_S'||src_mod||'_'||src_id||'_D'||det_mod||'_'||det_id"""
FIN = "isfinite(value)"
NEG = "value = CAST('-inf' AS DOUBLE)"
USED = "(SELECT DISTINCT channel FROM px_cells)"
MODS = "(SELECT DISTINCT CAST(s_nationkey+1 AS INT) AS mod FROM supplier)"
DIST = f"""dist AS (SELECT c.*, coalesce(sqrt((s.x-d.x)**2+(s.y-d.y)**2+(s.z-d.z)**2), CAST('inf' AS DOUBLE)) AS distance FROM px_channels c JOIN {USED} u USING (channel)
 LEFT JOIN (SELECT * FROM px_layout WHERE kind='source') s ON s.mod=c.src_mod AND s.part=c.src_id LEFT JOIN (SELECT * FROM px_layout WHERE kind='detector') d ON d.mod=c.det_mod AND d.part=c.det_id)"""
DOUT = "CASE WHEN isinf(distance) THEN -1 ELSE round(distance,4) END AS distance"


def modules(spark, d):
    return px.table(spark, d, "supplier").selectExpr("int(s_nationkey + 1) AS mod").distinct()


def used(spark, d):
    return px.cells(spark, d).select("channel").distinct()


def distances(spark, d):
    return op.distances(op.decode(used(spark, d)), px.layout(spark, d))


def dist_out(df):
    return df.withColumn("distance", F.expr("CASE WHEN distance = double('Infinity') THEN -1D ELSE round(distance, 4) END"))


@query(
    "g1_encode_channel",
    "SELECT channel, channel AS encoded, src_mod, det_mod FROM px_channels JOIN (SELECT DISTINCT channel FROM px_measurements) USING (channel)",
)
def _(spark, d):
    m = op.decode(px.measurements(spark, d).select("channel").distinct())
    code = op.encode(*[F.col(c) for c in ("wave", "moment", "src_mod", "src_id", "det_mod", "det_id")])
    return m.select("channel", code.cast("long").alias("encoded"), "src_mod", "det_mod")


@query(
    "g2_decode_channel",
    """SELECT m.idx, coalesce(wave,-1) AS wave, coalesce(moment,-1) AS moment, coalesce(src_mod,-1) AS src_mod, coalesce(src_id,-1) AS src_id, coalesce(det_mod,-1) AS det_mod, coalesce(det_id,-1) AS det_id
 FROM (SELECT DISTINCT l_partkey*131 AS idx FROM lineitem) m LEFT JOIN px_channels c ON c.channel=m.idx""",
)
def _(spark, d):
    digits = ["wave", "moment", "src_mod", "src_id", "det_mod", "det_id"]
    idx = px.table(spark, d, "lineitem").selectExpr("l_partkey * 131 AS idx").distinct()
    return op.decode(idx, "idx").select("idx", *[F.coalesce(c, F.lit(-1)).alias(c) for c in digits])


@query("g3_channel_names", f"SELECT channel, {NAME} AS name, n FROM px_channels JOIN (SELECT channel, count(*) AS n FROM px_cells GROUP BY 1) USING (channel)")
def _(spark, d):
    n = px.cells(spark, d).groupBy("channel").agg(F.count(F.lit(1)).alias("n"))
    return op.channels(spark).join(n, "channel").select("channel", "name", "n")


@query(
    "g4_valid_indices",
    f"SELECT channel, {NAME} AS name FROM px_channels JOIN {USED} u USING (channel) WHERE src_mod IN (SELECT mod FROM {MODS}) AND det_mod IN (SELECT mod FROM {MODS})",
)
def _(spark, d):
    return op.with_name(op.valid_channels(op.decode(used(spark, d)), modules(spark, d))).select("channel", "name")


@query(
    "g4_channels_by_category",
    f"""SELECT coalesce(wave,-1) AS wave, coalesce(moment,-1) AS moment, CAST(count(*) AS BIGINT) AS n, min(channel) AS first_channel, max(channel) AS last_channel FROM px_channels JOIN {USED} u USING (channel)
 WHERE src_mod IN (SELECT mod FROM {MODS}) AND det_mod IN (SELECT mod FROM {MODS}) GROUP BY GROUPING SETS ((wave,moment),(wave),(moment))""",
)
def _(spark, d):
    return op.by_category(op.valid_channels(op.decode(used(spark, d)), modules(spark, d)))


@query("g5_source_detector_distance", f"WITH {DIST} SELECT channel, {DOUT} FROM dist")
def _(spark, d):
    return dist_out(distances(spark, d)).select("channel", "distance")


@query(
    "g6_feasible_channels",
    f"WITH {DIST} SELECT channel, {DOUT} FROM dist WHERE distance<=25 AND src_mod IN (SELECT mod FROM {MODS}) AND det_mod IN (SELECT mod FROM {MODS})",
)
def _(spark, d):
    return dist_out(op.feasible(distances(spark, d), modules(spark, d), 25.0)).select("channel", "distance")


@query("g6_feasible_other_module", f"WITH {DIST} SELECT channel, {DOUT} FROM dist WHERE distance BETWEEN 5 AND 20 AND src_mod<>det_mod")
def _(spark, d):
    return dist_out(op.feasible(distances(spark, d), None, 20.0, 5.0, False)).select("channel", "distance")


@query(
    "g7_distance_profile",
    f"""WITH {DIST}, t AS (SELECT 'below' AS kind, unnest([1,2,3,4,5,10,15,20,30,40,50])::DOUBLE AS bound, NULL::DOUBLE AS upto UNION ALL
  SELECT 'range_from', unnest([0,1,3,5,10,20,30,50])::DOUBLE, unnest([1,3,5,10,20,30,50,1e308])::DOUBLE)
 SELECT kind, bound, count(*) FILTER (CASE WHEN kind='below' THEN distance<bound WHEN upto=1e308 THEN distance>=bound ELSE distance>=bound AND distance<upto END) AS n,
  round(count(*) FILTER (CASE WHEN kind='below' THEN distance<bound WHEN upto=1e308 THEN distance>=bound ELSE distance>=bound AND distance<upto END)/count(*)::DOUBLE*100,6) AS percent FROM t, dist GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.distance_profile(distances(spark, d)))


@query(
    "g7_same_module_distances",
    f"WITH {DIST} SELECT src_id, det_id, count(*) AS n, round(min(distance),4) AS min_distance, round(max(distance),4) AS max_distance, round(avg(distance),4) AS mean_distance FROM dist WHERE src_mod=det_mod AND NOT isinf(distance) GROUP BY 1,2",
)
def _(spark, d):
    known = distances(spark, d).where("distance < double('Infinity')")
    return rounded(op.same_module_distances(known), 4)


@query(
    "g8_prune_frames",
    f"""WITH {DIST}, kept AS (SELECT channel FROM dist WHERE distance<=25), top AS (SELECT file_id, max(channel)<(SELECT min(channel) FROM kept) AS beyond FROM px_cells GROUP BY 1)
 SELECT file_id, frame, channel, count(*) AS n FROM px_cells JOIN top USING (file_id) WHERE beyond OR channel IN (SELECT channel FROM kept) GROUP BY 1,2,3""",
)
def _(spark, d):
    cells = px.cells(spark, d)
    out = op.prune(cells, op.feasible(distances(spark, d), None, 25.0))
    keys = ["file_id", "frame", "channel"]
    return dealt(out.select(*keys), keys, cells.count()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "g8_prune_without_match",
    "SELECT file_id, count(*) AS n, count(DISTINCT channel) AS n_channels FROM px_cells GROUP BY 1",
)
def _(spark, d):
    none = op.feasible(distances(spark, d), None, -1.0)
    cells = px.cells(spark, d)
    out = dealt(op.prune(cells, none).select("file_id", "channel"), ["file_id", "channel"], cells.count())
    return out.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("channel").alias("n_channels"))


@query(
    "g9_channel_validity",
    f"""WITH {DIST}, kept AS (SELECT channel FROM dist WHERE distance<=25), nk AS (SELECT count(*) AS n FROM kept), v AS (SELECT file_id, channel, bool_or({FIN}) AS valid FROM px_cells GROUP BY 1,2),
 k AS (SELECT f.file_id, count(v.channel) FILTER (v.valid) AS included_valid FROM (SELECT DISTINCT file_id FROM px_cells) f CROSS JOIN kept LEFT JOIN v ON v.file_id=f.file_id AND v.channel=kept.channel GROUP BY 1),
 o AS (SELECT file_id, count(*) FILTER (valid AND channel NOT IN (SELECT channel FROM kept)) AS excluded_valid FROM v GROUP BY 1)
 SELECT file_id, included_valid, n-included_valid AS included_invalid, excluded_valid, round(included_valid/n::DOUBLE*100,6) AS valid_percent FROM k JOIN o USING (file_id), nk""",
)
def _(spark, d):
    return rounded(op.validity(px.cells(spark, d), op.feasible(distances(spark, d), None, 25.0)))


@query(
    "g10_describe_moment_wavelength",
    f"""WITH l AS (SELECT file_id, moment, wave, CASE WHEN value>0 AND {FIN} THEN ln(value) END AS x FROM px_cells JOIN px_channels USING (channel))
 SELECT file_id, moment, wave, count(*) AS n_points, count(x) AS n, count(*) FILTER (x<>0) AS n_nonzero, round(min(x),6) AS min, round(avg(x),6) AS mean, round(max(x),6) AS max, round(stddev_pop(x),6) AS std,
  round(quantile_cont(x,0.25),6) AS q1, round(median(x),6) AS median, round(quantile_cont(x,0.75),6) AS q3, round(quantile_cont(x,0.75)-quantile_cont(x,0.25),6) AS iqr,
  round(count(*) FILTER (x<>0)/count(*)::DOUBLE*100,6) AS finite_nonzero_percent FROM l GROUP BY 1,2,3""",
)
def _(spark, d):
    return rounded(op.describe(op.decode(px.cells(spark, d))))


FLAGS = f"flags AS (SELECT file_id, channel, bool_or(NOT ({NEG})) AS ev FROM px_cells GROUP BY 1,2)"


@query(
    "g11_ever_valid",
    f"WITH {FLAGS} SELECT file_id, count(*) FILTER (ev) AS ever_valid_channels, 248832-count(*) FILTER (ev) AS always_inf_channels, count(DISTINCT channel%41472) FILTER (ev) AS valid_pairs FROM flags GROUP BY 1",
)
def _(spark, d):
    return op.ever_valid(px.cells(spark, d))


@query(
    "g11_module_pairs",
    f"""WITH {FLAGS} SELECT file_id, src_mod, det_mod, count(*) AS n_channels, array_to_string(list_sort(list_distinct(list(src_id))),',') AS source_ids, array_to_string(list_sort(list_distinct(list(det_id))),',') AS detector_ids,
 count(DISTINCT (src_id,det_id)) AS n_pairs FROM flags JOIN px_channels USING (channel) WHERE ev GROUP BY 1,2,3""",
)
def _(spark, d):
    return op.module_pairs(px.cells(spark, d))


def spaced_sql(n: int) -> str:
    """Frames as in numpy.linspace(0, last, n, dtype=int), of each file."""
    return f"""last AS (SELECT file_id, max(frame)::DOUBLE AS m FROM px_cells GROUP BY 1), pickf AS (SELECT DISTINCT file_id, CAST(floor(i*greatest(1.0::DOUBLE, m/{n - 1}::DOUBLE)) AS BIGINT) AS frame FROM last, range(0,{n}) r(i)),
 spaced AS (SELECT * FROM px_cells SEMI JOIN pickf USING (file_id, frame))"""


@query(
    "g12_channel_transitions",
    f"""WITH {spaced_sql(4000)}, t AS (SELECT file_id, channel, array_to_string(list_sort(list_distinct(list(frame) FILTER (NOT ({NEG})))),',') AS valid_frames, array_to_string(list_sort(list_distinct(list(frame) FILTER ({NEG}))),',') AS inf_frames FROM spaced GROUP BY 1,2)
 SELECT file_id, channel, {NAME} AS name, valid_frames, inf_frames FROM t JOIN px_channels USING (channel) WHERE coalesce(valid_frames,'')<>'' AND coalesce(inf_frames,'')<>''""",
)
def _(spark, d):
    return op.transitions(px.cells(spark, d), 4000).select("file_id", "channel", "name", "valid_frames", "inf_frames")


@query(
    "g12_transitioning_pairs",
    f"""WITH {spaced_sql(4000)} SELECT file_id, channel%41472 AS pair, count(DISTINCT frame) FILTER (NOT ({NEG})) AS n_valid_frames, count(DISTINCT frame) FILTER ({NEG}) AS n_inf_frames FROM spaced GROUP BY 1,2
 HAVING count(*) FILTER (NOT ({NEG}))>0 AND count(*) FILTER ({NEG})>0""",
)
def _(spark, d):
    return op.transitioning_pairs(px.cells(spark, d), 4000)


# Each file has all 41,472 pairs of six channels; what has no cell is -inf.
@query(
    "g13_pair_consistency",
    f"""WITH {FLAGS}, p AS (SELECT file_id, channel%41472 AS pair, count(*) FILTER (ev) AS v FROM flags GROUP BY 1,2)
 SELECT file_id, count(*) FILTER (v=6) AS fully_valid, count(*) FILTER (v BETWEEN 1 AND 5) AS partly_valid, 41472-count(*) FILTER (v>0) AS fully_invalid FROM p GROUP BY 1""",
)
def _(spark, d):
    return op.pair_consistency(px.cells(spark, d))


# A hundred orders are one frame of their parts here, so that pairs meet.
@query(
    "g13_mixed_pairs",
    f"""SELECT file_id, frame, pair, n_valid, n_inf FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY frame, pair) AS r FROM
 (SELECT file_id%7 AS file_id, frame//100 AS frame, channel%41472 AS pair, count(*) FILTER (NOT ({NEG})) AS n_valid, count(*) FILTER ({NEG}) AS n_inf FROM px_cells GROUP BY 1,2,3) WHERE n_valid>0 AND n_inf>0) WHERE r<=10""",
)
def _(spark, d):
    return op.mixed_pairs(px.cells(spark, d).withColumn("frame", F.expr("frame div 100")).withColumn("file_id", F.expr("file_id % 7")))


STATS = f"""count(*) AS n, round(count(*) FILTER ({NEG})/count(*)::DOUBLE*100,6) AS neg_inf_percent, round(count(*) FILTER (isinf(value) AND value>0)/count(*)::DOUBLE*100,6) AS pos_inf_percent,
 round(count(*) FILTER (isnan(value))/count(*)::DOUBLE*100,6) AS nan_percent, round(count(*) FILTER (value=0)/count(*)::DOUBLE*100,6) AS zero_percent, round(count(*) FILTER ({FIN} AND value<>0)/count(*)::DOUBLE*100,6) AS nonzero_percent,
 round(min(value) FILTER ({FIN}),6) AS min, round(max(value) FILTER ({FIN}),6) AS max, round(avg(value) FILTER ({FIN}),6) AS mean, round(stddev_pop(value) FILTER ({FIN}),6) AS std, round(median(value) FILTER ({FIN}),6) AS median"""


@query("g14_value_stats", f"SELECT file_id, {STATS} FROM px_cells GROUP BY 1")
def _(spark, d):
    return rounded(op.value_stats(px.cells(spark, d), ["file_id"]))


@query("g14_value_stats_overall", f"SELECT {STATS} FROM px_cells")
def _(spark, d):
    return rounded(op.value_stats(px.cells(spark, d), []))


COVER = f"""cov AS (SELECT file_id, count(*) AS n_channels, count(*) FILTER (i) AS inf_channels, count(*) FILTER (NOT i) AS valid_channels, count(*) FILTER (NOT i)/count(*)::DOUBLE*100 AS valid_percent
 FROM (SELECT file_id, channel, bool_or({NEG}) AS i FROM px_cells GROUP BY 1,2) GROUP BY 1)"""


@query("g15_file_coverage", f"WITH {COVER} SELECT file_id, n_channels, inf_channels, valid_channels, round(valid_percent,6) AS valid_percent FROM cov")
def _(spark, d):
    return rounded(op.file_coverage(px.cells(spark, d)))


@query(
    "g15_corpus_summary",
    f"""WITH {COVER} SELECT count(*) AS n_files, round(avg(valid_percent),6) AS mean_valid_percent, (SELECT file_id FROM cov ORDER BY valid_percent DESC, file_id LIMIT 1) AS best_file, round(max(valid_percent),6) AS best_percent,
 (SELECT file_id FROM cov ORDER BY valid_percent, file_id LIMIT 1) AS worst_file, round(min(valid_percent),6) AS worst_percent FROM cov""",
)
def _(spark, d):
    return rounded(op.corpus_summary(op.file_coverage(px.cells(spark, d))))


@query("g16_evenly_spaced_frames", f"WITH {spaced_sql(500)} SELECT file_id, frame, count(*) AS n FROM spaced GROUP BY 1,2")
def _(spark, d):
    return op.evenly_spaced(px.cells(spark, d), 500).groupBy("file_id", "frame").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g16_random_frames",
    "SELECT file_id, frame FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY md5(frame||'-7'), frame) AS r FROM (SELECT DISTINCT file_id, frame FROM px_cells)) WHERE r<=20",
)
def _(spark, d):
    return op.random_frames(px.cells(spark, d), 20, 7)


MAPPED = """mapped AS (SELECT m.file_id, m.data_type, m.channel, CASE wave WHEN 0 THEN 'Red' ELSE 'IR' END AS wavelength, CASE moment WHEN 0 THEN 'Zeroth' WHEN 1 THEN 'First' ELSE 'Second' END AS moment_name,
 wave+1 AS wavelength_index, moment+1 AS data_type_index, src_mod AS source_group, src_id AS source_position, det_mod AS detector_group, det_id AS detector_position FROM px_measurements m JOIN px_channels USING (channel))"""


@query("g17_map_channels", f"WITH {MAPPED} SELECT wavelength, moment_name, source_group, source_position, detector_group, detector_position, count(*) AS n FROM mapped GROUP BY ALL")
def _(spark, d):
    m = op.map_channels(px.measurements(spark, d))
    return m.groupBy(
        "wavelength", "moment_name", "source_group", "source_position", "detector_group", "detector_position"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "g17_filter_channels",
    f"WITH {MAPPED} SELECT file_id, data_type, channel, wavelength, moment_name FROM mapped WHERE wavelength_index=2 AND data_type_index IN (1,3) AND source_position IN (1,2) AND detector_group IN (3,5,7,9)",
)
def _(spark, d):
    m = op.filter_channels(
        op.map_channels(px.measurements(spark, d)),
        wavelength_index=[2],
        data_type_index=[1, 3],
        source_group=[],
        source_position=[1, 2],
        detector_group=[3, 5, 7, 9],
    )
    return m.select("file_id", "data_type", "channel", "wavelength", "moment_name")


@query("g18_channels_above", f"SELECT file_id, channel FROM px_cells WHERE {FIN} GROUP BY 1,2 HAVING max(value)>40")
def _(spark, d):
    return op.valid_above(px.cells(spark, d), 40.0)


@query(
    "g19_nearest_position",
    """SELECT sensor, nearest_id, round(distance,6) AS distance FROM (SELECT s.sensor, arg_min(l.mod*10+l.pos, (sqrt((s.x-l.x)**2+(s.y-l.y)**2+(s.z-l.z)**2), l.mod*10+l.pos)) AS nearest_id,
 min(sqrt((s.x-l.x)**2+(s.y-l.y)**2+(s.z-l.z)**2)) AS distance FROM px_sensors s, px_layout l GROUP BY 1) WHERE distance<5""",
)
def _(spark, d):
    places = px.layout(spark, d).selectExpr("mod * 10 + pos AS id", "x", "y", "z")
    out = op.nearest_within(px.sensors(spark, d).select("sensor", "x", "y", "z"), places, 5.0)
    return rounded(out.select("sensor", "nearest_id", "distance"))


CMP = """cmp AS (SELECT coalesce(a.sensor,b.id) AS id, CASE WHEN b.id IS NULL THEN 'extra' WHEN a.sensor IS NULL THEN 'missing' ELSE 'matched' END AS status, a.x-b.x AS dx, a.y-b.y AS dy, a.z-b.z AS dz,
 sqrt((a.x-b.x)**2+(a.y-b.y)**2+(a.z-b.z)**2) AS distance FROM px_sensors a FULL JOIN (SELECT (mod-1)*9+pos-1+100 AS id, x, y, z FROM px_layout) b ON a.sensor=b.id)"""


def compared(spark, d):
    b = px.layout(spark, d).selectExpr("bigint((mod - 1) * 9 + pos - 1 + 100) AS id", "x", "y", "z")
    return op.compare_positions(px.sensors(spark, d).withColumnRenamed("sensor", "id"), b)


@query("g20_compare_positions", f"WITH {CMP} SELECT id, status, round(dx,6)+0.0 AS dx, round(dy,6)+0.0 AS dy, round(dz,6)+0.0 AS dz, round(distance,6) AS distance FROM cmp")
def _(spark, d):
    return rounded(compared(spark, d))


@query(
    "g20_comparison_summary",
    f"WITH {CMP} SELECT count(*) FILTER (status='matched') AS matched, count(*) FILTER (status='missing') AS missing, count(*) FILTER (status='extra') AS extra, round(max(distance),6) AS max_distance, round(min(distance),6) AS min_distance, round(avg(distance),6) AS avg_distance FROM cmp",
)
def _(spark, d):
    return rounded(op.comparison_summary(compared(spark, d)))


MATCH = """mat AS (SELECT l.mod, l.part AS pos, EXISTS (SELECT 1 FROM px_sensors s WHERE sqrt((s.x-l.x)**2+(s.y-l.y)**2+(s.z-l.z)**2)<0.001::DOUBLE) AS m FROM px_layout l WHERE kind='detector')"""


@query(
    "g21_module_coverage",
    f"WITH {MATCH} SELECT mod, count(*) AS total, count(*) FILTER (m) AS n_matched, coalesce(array_to_string(list_sort(list(pos) FILTER (m)),','),'') AS positions, round(count(*) FILTER (m)/count(*)::DOUBLE*100,6) AS percent FROM mat GROUP BY 1",
)
def _(spark, d):
    return rounded(op.module_coverage(px.layout(spark, d), px.sensors(spark, d)))


@query(
    "g21_position_frequency",
    f"WITH {MATCH} SELECT pos, count(*) AS n, round(count(*)/(SELECT count(DISTINCT mod) FROM mat WHERE m)::DOUBLE*100,6) AS percent FROM mat WHERE m GROUP BY 1",
)
def _(spark, d):
    return rounded(op.position_frequency(px.layout(spark, d), px.sensors(spark, d)))


@query(
    "g22_module_geometry",
    """WITH c AS (SELECT *, avg(x) OVER w AS cx, avg(y) OVER w AS cy, avg(z) OVER w AS cz FROM px_layout WINDOW w AS (PARTITION BY mod)), dd AS (SELECT *, sqrt((x-cx)**2+(y-cy)**2+(z-cz)**2) AS distance FROM c),
 r AS (SELECT *, row_number() OVER (PARTITION BY mod ORDER BY distance, pos) AS rank FROM dd) SELECT mod, round(cx,6) AS cx, round(cy,6) AS cy, round(cz,6) AS cz, round(distance,6) AS distance, CAST(rank AS INT) AS rank FROM r WHERE pos=7""",
)
def _(spark, d):
    return rounded(op.module_geometry(px.layout(spark, d)))


def axes_sql() -> str:
    rows = ", ".join(
        f"({i}, '{n}', {', '.join(f'{s}*s.{c}' for c, s in zip(a, sg))})" for i, (n, a, sg) in enumerate(op.AXIS_CONVENTIONS)
    )
    return f"""costs AS (SELECT ord, name, sum(d) AS cost FROM (SELECT s.sensor, t.ord, t.name, min(sqrt((t.x-l.x)**2+(t.y-l.y)**2+(t.z-l.z)**2)) AS d
  FROM px_sensors s, LATERAL (VALUES {rows}) t(ord,name,x,y,z), px_layout l GROUP BY 1,2,3) GROUP BY 1,2)"""


@query("g23_axis_convention_costs", f"WITH {axes_sql()} SELECT name, round(cost,4) AS cost FROM costs")
def _(spark, d):
    return rounded(op.axis_costs(px.sensors(spark, d), px.layout(spark, d)), 4).select("name", "cost")


@query("g23_best_axis_convention", f"WITH {axes_sql()} SELECT name, round(cost,4) AS cost FROM costs ORDER BY costs.cost, ord LIMIT 1")
def _(spark, d):
    return rounded(op.best_axes(px.sensors(spark, d), px.layout(spark, d)), 4)


@query(
    "g24_measurement_inventory",
    "SELECT file_id, data_type, count(*) AS n, count(DISTINCT channel%41472) AS n_pairs, count(DISTINCT wave) AS n_wavelengths FROM px_measurements JOIN px_channels USING (channel) GROUP BY 1,2",
)
def _(spark, d):
    return op.inventory(px.measurements(spark, d))


@query(
    "g25_first_infinite_cells",
    "SELECT file_id, frame, channel, value>0 AS positive FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY frame, channel, value) AS r FROM px_cells WHERE isinf(value)) WHERE r<=20",
)
def _(spark, d):
    return op.infinite_cells(px.cells(spark, d)).selectExpr("file_id", "frame", "channel", "value > 0 AS positive")


@query(
    "g25_inf_by_frame_channel",
    f"SELECT file_id, frame, channel, count(*) AS n, count(*) FILTER ({NEG}) AS n_inf, count(*)=count(*) FILTER ({NEG}) AS fully_inf FROM px_cells GROUP BY 1,2,3 HAVING count(*) FILTER ({NEG})>0",
)
def _(spark, d):
    return op.inf_by_frame_channel(px.cells(spark, d))


def audit_sql() -> str:
    kinds = {"nan": "isnan(value)", "inf": "isinf(value)", "zero": "value=0", "negative": f"value<0 AND NOT ({NEG})"}
    per = ", ".join(f"count(*) FILTER ({c}) AS k_{k}" for k, c in kinds.items())
    out = ", ".join(
        f"CAST(sum(k_{k}) AS BIGINT) AS n_{k}, count(*) FILTER (k_{k}>0) AS channels_with_{k}, count(*) FILTER (k_{k}=n) AS channels_all_{k}" for k in kinds
    )
    return f"SELECT file_id, CAST(sum(n) AS BIGINT) AS total, {out} FROM (SELECT file_id, channel, count(*) AS n, {per} FROM px_cells GROUP BY 1,2) GROUP BY 1"


@query("g26_value_audit", audit_sql())
def _(spark, d):
    return op.value_audit(px.cells(spark, d))


@query(
    "g26_value_ladder",
    f"SELECT file_id, p AS percentile, round(v,6) AS value FROM (SELECT file_id, unnest([{','.join(str(float(p)) for p in op.LADDER)}]::DOUBLE[]) AS p, unnest(quantile_cont(value, [{','.join(repr(p / 100.0) for p in op.LADDER)}])) AS v FROM px_cells WHERE {FIN} AND value>0 GROUP BY 1)",
)
def _(spark, d):
    return rounded(op.value_ladder(px.cells(spark, d)))
