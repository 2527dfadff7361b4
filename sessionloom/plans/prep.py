"""Dataset preparation and evaluation on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep as op
from ..operators import spectral
from . import inputs as px
from .registry import query, rounded


def vectors(spark, d):
    return px.table(spark, d, "embeddings").selectExpr("vec_id", "label")


@query(
    "k1_validate_sessions",
    """WITH w AS (SELECT session_id, CASE kind WHEN 'click' THEN 'eeg' ELSE 'fnirs' END AS modality, CASE WHEN value>200 THEN 20 ELSE 21 END AS ch, CASE WHEN kind='error' OR value>0.5 THEN 1 END AS label FROM px_events WHERE kind IN ('click','error')),
 p AS (SELECT session_id, count(*) FILTER (modality='eeg') AS e, count(*) FILTER (modality='fnirs') AS f, count(label) FILTER (modality='eeg') AS l, count(*) FILTER (modality='eeg' AND ch<>21) AS o FROM w GROUP BY 1)
 SELECT session_id, CASE WHEN e=0 OR f=0 THEN 'missing_modality' WHEN e<>f THEN 'unequal_window_counts' WHEN l=0 THEN 'no_labels' WHEN l<>e THEN 'label_count_differs' WHEN o>0 THEN 'unexpected_shape' ELSE '' END AS reason,
  e>0 AND f>0 AND e=f AND l=e AND o=0 AS valid FROM p""",
)
def _(spark, d):
    w = px.events(spark, d).where("kind IN ('click', 'error')").selectExpr(
        "session_id",
        "CASE kind WHEN 'click' THEN 'eeg' ELSE 'fnirs' END AS modality",
        "CASE WHEN value > 200 THEN 20 ELSE 21 END AS n_channels",
        "105 AS n_samples",
        "CASE WHEN kind = 'error' OR value > 0.5 THEN 1 END AS label",
    )
    return op.validate_sessions(w, ["eeg", "fnirs"])


@query(
    "k2_label_conversion",
    "SELECT event_id, coalesce(TRY_CAST(t AS INT), CASE t WHEN 'view' THEN 1 WHEN 'click' THEN 2 END, 0) AS label FROM (SELECT event_id, CASE WHEN value>40 THEN kind ELSE k END AS t FROM px_events)",
)
def _(spark, d):
    e = px.events(spark, d).selectExpr("event_id", "CASE WHEN value > 40 THEN kind ELSE k END AS t")
    return e.select("event_id", op.to_label(F.col("t"), {"view": 1, "click": 2}).alias("label"))


@query(
    "k3_label_distribution",
    """SELECT label, n, round(imb,6) AS imbalance, round(n/t::DOUBLE,6) AS share, round(t/(k*n)::DOUBLE,6) AS weight FROM (SELECT label, count(*) AS n, sum(count(*)) OVER () AS t, count(*) OVER () AS k, max(count(*)) OVER ()/min(count(*)) OVER ()::DOUBLE AS imb FROM embeddings GROUP BY 1)""",
)
def _(spark, d):
    return rounded(op.distribution(vectors(spark, d)))


@query(
    "k4_inverse_weights",
    "SELECT label, round(1.0::DOUBLE/n/sum(1.0::DOUBLE/n) OVER (),6) AS weight FROM (SELECT label, count(*) AS n FROM embeddings WHERE label BETWEEN 0 AND 4 GROUP BY 1) QUALIFY count(*) OVER ()=5",
)
def _(spark, d):
    return rounded(op.inverse_weights(vectors(spark, d), 5))


@query("k5_binary_labels", "SELECT vec_id, label FROM embeddings WHERE label IN (0,1)")
def _(spark, d):
    return op.keep_labels(vectors(spark, d))


@query("k5_label_range", "SELECT vec_id, label FROM embeddings WHERE label BETWEEN 2 AND 6")
def _(spark, d):
    return op.keep_labels(vectors(spark, d), 2, 6)


RSPLIT = """rs AS (SELECT vec_id, label, CASE WHEN r<=floor(n*0.7::DOUBLE) THEN 'train' WHEN r<=floor(n*0.7::DOUBLE)+floor(n*0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM
 (SELECT *, row_number() OVER (ORDER BY substr(md5(vec_id||'-42'),1,15), vec_id) AS r, count(*) OVER () AS n FROM embeddings))"""


@query("k6_row_split", f"WITH {RSPLIT} SELECT * FROM rs")
def _(spark, d):
    return op.split_rows(vectors(spark, d), ["vec_id"], 0.7, 0.15)


@query(
    "k7_session_split",
    """WITH s AS (SELECT session_id, row_number() OVER (ORDER BY substr(md5(session_id||'-42'),1,15), session_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT session_id FROM px_events))
 SELECT event_id, session_id, CASE WHEN r<=greatest(1,floor(n*0.7::DOUBLE)) THEN 'train' WHEN r<=greatest(1,floor(n*0.7::DOUBLE))+floor(n*0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM px_events JOIN s USING (session_id)""",
)
def _(spark, d):
    return op.split_sessions(px.events(spark, d).select("event_id", "session_id"), 0.7, 0.15)


@query(
    "k8_split_by_size",
    """WITH RECURSIVE s AS (SELECT session_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, session_id) AS t FROM (SELECT user_id AS session_id FROM events) GROUP BY 1),
 g(t, tr, va, part) AS (SELECT 0::BIGINT, 0, 0, '' UNION ALL
  SELECT t+1, tr+CASE WHEN tr<0.7::DOUBLE*(t+1) THEN 1 ELSE 0 END, va+CASE WHEN tr>=0.7::DOUBLE*(t+1) AND va<0.15::DOUBLE*(t+1) THEN 1 ELSE 0 END,
   CASE WHEN tr<0.7::DOUBLE*(t+1) THEN 'train' WHEN va<0.15::DOUBLE*(t+1) THEN 'val' ELSE 'test' END FROM g WHERE t<(SELECT count(*) FROM s))
 SELECT session_id, n, part AS split FROM s JOIN g USING (t)""",
)
def _(spark, d):
    rows = op.split_by_size(px.events(spark, d).select("session_id"), 0.7, 0.15)
    return rows.groupBy("session_id", "split").agg(F.count(F.lit(1)).alias("n"))


def draws_sql(src: str) -> str:
    """As many draws as rows: the hash of a draw's number falls on the line of all weights."""
    return f"""v AS ({src}), wt AS (SELECT label, count(*) AS n, sum(count(*)) OVER ()/(count(*) OVER ()*count(*))::DOUBLE AS w, max(count(*)) OVER ()/min(count(*)) OVER ()::DOUBLE AS imb FROM v GROUP BY 1),
 ln AS (SELECT *, sum(n*w) OVER (ORDER BY label) AS upto FROM wt), li AS (SELECT *, lag(upto,1,0.0::DOUBLE) OVER (ORDER BY label) AS since, max(upto) OVER () AS whole FROM ln),
 u AS (SELECT ('0x'||substr(md5(i||'-42'),1,15))::BIGINT/1152921504606846976::DOUBLE AS u FROM range((SELECT count(*) FROM v)) t(i)),
 dr AS (SELECT label, least(n, floor((u*whole-since)/w)::BIGINT+1) AS r, count(*) AS c FROM u JOIN li ON u*whole>=since AND u*whole<upto GROUP BY 1,2),
 rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY substr(md5(vec_id||'-42'),1,15), vec_id) AS r FROM v),
 cp AS (SELECT vec_id, label, c FROM rk JOIN dr USING (label, r))"""


UNEVEN = "SELECT vec_id, CASE WHEN label=0 THEN 0 ELSE 1 END AS label FROM embeddings"
DRAWN = "SELECT vec_id, label, unnest(range(1,c+1)) AS copy FROM cp"


@query("k9_weighted_resample", f"WITH {draws_sql('SELECT vec_id, label FROM embeddings')} {DRAWN}")
def _(spark, d):
    v = vectors(spark, d)
    return op.resample(v, op.distribution(v), ["vec_id"]).select("vec_id", "label", "copy")


@query(
    "k10_auto_balance",
    f"WITH {draws_sql(UNEVEN)}, b AS (SELECT any_value(imb)>3 AS uneven FROM wt) SELECT * FROM ({DRAWN}) WHERE (SELECT uneven FROM b) UNION ALL SELECT vec_id, label, 1 FROM v WHERE NOT (SELECT uneven FROM b)",
)
def _(spark, d):
    skewed = vectors(spark, d).withColumn("label", F.expr("CASE WHEN label = 0 THEN 0 ELSE 1 END"))
    return op.auto_balance(skewed, ["vec_id"]).select("vec_id", "label", "copy")


@query(
    "k11_train_normalisation",
    f"""WITH {RSPLIT}, x AS (SELECT s.channel AS vec_id, s.channel%16 AS channel, s.sample, s.x, rs.split FROM px_samples s JOIN rs ON rs.vec_id=s.channel),
 f AS (SELECT channel, avg(x) AS m, greatest(stddev_samp(x),1e-8) AS s FROM x WHERE split='train' GROUP BY 1) SELECT vec_id, sample, split, round((x-m)/s,5) AS x FROM x JOIN f USING (channel)""",
)
def _(spark, d):
    split = op.split_rows(vectors(spark, d), ["vec_id"], 0.7, 0.15).select("vec_id", "split")
    x = px.samples(spark, d).selectExpr("channel AS vec_id", "channel % 16 AS channel", "sample", "x").join(split, "vec_id")
    out = op.apply_norm(x, op.fit_norm(x, ["channel"]), ["channel"])
    return rounded(out.select("vec_id", "sample", "split", "x"), 5)


@query("k12_confusion", "SELECT y, p, count(*) AS n FROM px_predictions GROUP BY 1,2")
def _(spark, d):
    return op.confusion(px.predictions(spark, d))


@query("k12_confusion_matrix", "SELECT y, count(*) FILTER (p=0) AS p0, count(*) FILTER (p=1) AS p1 FROM px_predictions GROUP BY 1")
def _(spark, d):
    return op.confusion_matrix(px.predictions(spark, d), [0, 1])


@query(
    "k13_class_report",
    """WITH c AS (SELECT DISTINCT y AS c FROM px_predictions UNION SELECT DISTINCT p FROM px_predictions), m AS (SELECT c, count(*) FILTER (y=c AND p=c) AS tp, count(*) FILTER (y=c) AS s, count(*) FILTER (p=c) AS q FROM c, px_predictions GROUP BY 1),
 r AS (SELECT *, coalesce(tp/nullif(q,0)::DOUBLE,0) AS pr, coalesce(tp/nullif(s,0)::DOUBLE,0) AS re FROM m)
 SELECT c AS class, round(pr,6) AS precision, round(re,6) AS recall, round(coalesce(2*pr*re/nullif(pr+re,0),0),6) AS f1, s AS support FROM r""",
)
def _(spark, d):
    return rounded(op.class_report(px.predictions(spark, d)))


@query("k14_class_accuracy", "SELECT y AS class, round(avg(CASE WHEN y=p THEN 1.0::DOUBLE ELSE 0 END),6) AS accuracy, count(*) AS n FROM px_predictions GROUP BY 1")
def _(spark, d):
    return rounded(op.class_accuracy(px.predictions(spark, d)))


@query(
    "k14_accuracy",
    """SELECT round(sum(a*n)/sum(n),6) AS accuracy, round(avg(a),6) AS balanced_accuracy, CAST(sum(n) AS BIGINT) AS n FROM (SELECT y, avg(CASE WHEN y=p THEN 1.0::DOUBLE ELSE 0 END) AS a, count(*) AS n FROM px_predictions GROUP BY 1)""",
)
def _(spark, d):
    return rounded(op.accuracy(px.predictions(spark, d)))


def band_features(spark, d):
    v = op.keep_labels(vectors(spark, d))
    split = op.split_rows(v, ["vec_id"], 0.7, 0.15)
    x = px.samples(spark, d).withColumn("session_id", F.lit(0)).join(v.select(F.col("vec_id").alias("channel")), "channel", "left_semi")
    power = spectral.band_power(spectral.psd(x, 64.0, 64), ["channel"], closed=True, mean=True)
    wide = power.groupBy(F.col("channel").alias("vec_id")).agg(*[F.sum(F.when(F.col("band") == b, F.col("power"))).alias(b) for b in spectral.BANDS])
    return split.join(wide, "vec_id")


@query("k15_logistic_baseline")
def _(spark, d):
    out = op.lr_baseline(band_features(spark, d), list(spectral.BANDS))
    return rounded(out.select("vec_id", "label", "split", "p", "p1"), 4)


# At the best fit the weighted gradient of every coefficient is zero.
@query(
    "k15_logistic_optimum",
    f"""WITH rs AS (SELECT vec_id, label, CASE WHEN r<=floor(n*0.7::DOUBLE) THEN 'train' WHEN r<=floor(n*0.7::DOUBLE)+floor(n*0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM
 (SELECT *, row_number() OVER (ORDER BY substr(md5(vec_id||'-42'),1,15), vec_id) AS r, count(*) OVER () AS n FROM embeddings WHERE label IN (0,1)))
 SELECT b.band, 0.0::DOUBLE AS gradient, count(*) FILTER (split='train' AND label=0) AS train_0, count(*) FILTER (split='train' AND label=1) AS train_1, count(*) FILTER (split<>'train') AS others
 FROM rs, (SELECT unnest([{','.join(repr(b) for b in spectral.BANDS)}]) AS band) b GROUP BY 1""",
)
def _(spark, d):
    out = op.lr_baseline(band_features(spark, d), list(spectral.BANDS))
    train = F.col("split") == "train"
    sizes = out.where(train).groupBy("label").agg(F.count(F.lit(1)).alias("__n"))
    w = 1.0 / F.col("__n")
    rows = out.join(sizes, "label", "left").select(
        "label", "split", w.alias("w"), (F.col("p1") - F.col("label")).alias("e"),
        F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("x")) for b in spectral.BANDS])).alias("f"),
    )
    slope = F.sum(F.when(train, F.col("w") * F.col("e") * F.col("f.x"))) / F.sum(F.when(train, F.col("w") * F.abs("f.x")))
    return rounded(
        rows.groupBy("f.band").agg(
            slope.alias("gradient"),
            F.count_if(train & (F.col("label") == 0)).alias("train_0"),
            F.count_if(train & (F.col("label") == 1)).alias("train_1"),
            F.count_if(~train).alias("others"),
        ),
        2,
    )


@query("k16_split_label_counts", f"WITH {RSPLIT} SELECT split, label, count(*) AS n FROM rs GROUP BY 1,2")
def _(spark, d):
    return op.split_counts(op.split_rows(vectors(spark, d), ["vec_id"], 0.7, 0.15))


@query(
    "k17_feature_shapes",
    "SELECT 'embedding' AS modality, CAST(len(embedding) AS INT) AS length, count(*) AS n FROM embeddings GROUP BY 2 UNION ALL SELECT 'half', CAST(len(embedding)/2 AS INT), count(*) FROM embeddings GROUP BY 2",
)
def _(spark, d):
    w = px.table(spark, d, "embeddings").selectExpr("embedding", "slice(embedding, 1, int(size(embedding) / 2)) AS half")
    return op.feature_shapes(w, ["embedding", "half"])
