"""Labels, splits, balancing, normalisation and evaluation."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import attach, with_row
from ..functions.lineage import cut
from ..functions.ordered import over_slices

HASH_BITS = 60
RANK_SLICES = 1 << 16


def hash60(seed: int, *cols: str) -> Column:
    """A uniform 60-bit number from row values; the same on every run."""
    text = F.concat_ws("-", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shuffled_rank(df: DataFrame, id_cols: list[str], seed: int, name: str = "rank") -> DataFrame:
    """1-based place of every row in a reproducible random order.

    The order is that of a hash, so equal hash ranges hold equally many rows.
    """
    hashed = df.withColumn("__h", hash60(seed, *id_cols))
    return over_slices(hashed, [], ["__h", *id_cols], 2.0**HASH_BITS / RANK_SLICES, rank=name).drop("__h")


def validate_sessions(windows: DataFrame, modalities: list[str], n_channels: int = 21, n_samples: int = 105) -> DataFrame:
    """Valid flag and reject reason per session.

    ``windows`` has session_id, modality, n_channels, n_samples, label.
    """
    n = lambda m: F.count_if(F.col("modality") == m)
    first = modalities[0]
    per = windows.where(F.col("modality").isin(modalities)).groupBy("session_id").agg(
        *[n(m).alias(f"n_{m}") for m in modalities],
        F.count_if((F.col("modality") == first) & F.col("label").isNotNull()).alias("n_labels"),
        F.count_if((F.col("modality") == first) & ((F.col("n_channels") != n_channels) | (F.col("n_samples") != n_samples))).alias("n_odd"),
    )
    missing = F.lit(False)
    unequal = F.lit(False)
    for m in modalities:
        missing |= F.col(f"n_{m}") == 0
        unequal |= F.col(f"n_{m}") != F.col(f"n_{first}")
    reason = (
        F.when(missing, "missing_modality")
        .when(unequal, "unequal_window_counts")
        .when(F.col("n_labels") == 0, "no_labels")
        .when(F.col("n_labels") != F.col(f"n_{first}"), "label_count_differs")
        .when(F.col("n_odd") > 0, "unexpected_shape")
        .otherwise("")
    )
    return per.select("session_id", reason.alias("reason")).withColumn("valid", F.col("reason") == "")


def to_label(text: Column, label_map: dict[str, int]) -> Column:
    """An integer in the text, else its value in the map, else 0."""
    words = F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv])
    return F.coalesce(text.try_cast("int"), F.try_element_at(words, text), F.lit(0))


def distribution(rows: DataFrame, label: str = "label") -> DataFrame:
    """Count, balanced weight and overall imbalance per label."""
    per = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"), (F.max("n") / F.min("n")).alias("imbalance"))
    return (
        with_row(per, total)
        .withColumn("share", F.col("n") / F.col("total"))
        .withColumn("weight", F.col("total") / (F.col("k") * F.col("n")))
        .drop("total", "k")
    )


def inverse_weights(rows: DataFrame, n_classes: int, label: str = "label") -> DataFrame:
    """Inverse-count weights that add up to 1; no row unless all classes occur."""
    per = rows.where(F.col(label).between(0, n_classes - 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum(1.0 / F.col("n")).alias("s"), F.count(F.lit(1)).alias("k"))
    return with_row(per, total).where(F.col("k") == n_classes).select(label, (1.0 / F.col("n") / F.col("s")).alias("weight"))


def keep_labels(rows: DataFrame, low: int = 0, high: int = 1, label: str = "label") -> DataFrame:
    return rows.where(F.col(label).between(low, high))


def split_rows(rows: DataFrame, id_cols: list[str], train: float, val: float, seed: int = 42) -> DataFrame:
    """Random split with exact counts int(r*n); the rest is the test part."""
    n = rows.agg(F.count(F.lit(1)).alias("__n"))
    ranked = with_row(shuffled_rank(rows, id_cols, seed, "__r"), n)
    a, b = F.floor(F.col("__n") * F.lit(train)), F.floor(F.col("__n") * F.lit(val))
    empty = (a == 0) | ((F.lit(val) > 0) & (b == 0)) | ((F.lit(1 - train - val) > 1e-9) & (F.col("__n") - a - b == 0))
    part = (
        F.when(empty, F.raise_error(F.lit("a split would be empty")).cast("string"))
        .when(F.col("__r") <= a, "train")
        .when(F.col("__r") <= a + b, "val")
        .otherwise("test")
    )
    return ranked.withColumn("split", part).drop("__r", "__n")


def split_sessions(rows: DataFrame, train: float, val: float, seed: int = 42, session: str = "session_id") -> DataFrame:
    """Split whole sessions, so none is in two parts; the test part is never empty."""
    sessions = rows.select(session).distinct()
    ranked = with_row(shuffled_rank(sessions, [session], seed, "__r"), sessions.agg(F.count(F.lit(1)).alias("__n")))
    n = F.col("__n")
    a = F.greatest(F.lit(1), F.floor(n * F.lit(train)))
    b = F.greatest(F.lit(0), F.floor(n * F.lit(val)))
    if 1 - train - val > 1e-9:
        b = F.when(n - a - b == 0, F.greatest(F.lit(0), b - 1)).otherwise(b)
    part = F.when(F.col("__r") <= a, "train").when(F.col("__r") <= a + b, "val").otherwise("test")
    return attach(rows, ranked.select(session, part.alias("split")), [session])


def split_by_size(rows: DataFrame, train: float, val: float, session: str = "session_id", slice_rows: int = 1_000_000) -> DataFrame:
    """Give sessions, largest first, to the part that lags behind its share.

    The t-th session goes to train when train holds fewer than train*t, else to
    val when val holds fewer than val*t, else to test.  So train holds
    ceil(train*t) after t sessions.  With g(t) = t - ceil(train*t) sessions not
    in train and at most ceil(val*t) wanted by val, val holds
    g(t) + min over s <= t of (ceil(val*s) - g(s)): a running minimum instead
    of a loop.
    """
    size = rows.groupBy(session).agg(F.count(F.lit(1)).alias("n"))
    # Largest first, then by id: rank inside slices of the size.
    ranked = over_slices(size.withColumn("__k", -F.col("n")), [], ["__k", session], 64, rank="t")
    t = F.col("t")
    wanted = lambda r, k: F.ceil(F.lit(float(r)) * k)
    g = ranked.withColumn("__g", t - wanted(train, t)).withColumn("__d", F.least(F.lit(0), wanted(val, t) - F.col("__g")))
    low = over_slices(g, [], ["t"], slice_rows, mins={"__m": "__d"})
    held = low.withColumn("__v", F.col("__g") + F.col("__m"))
    # Compare with what val held one session earlier.
    prev = over_slices(held, [], ["t"], slice_rows, lags={"__v0": "__v"})
    in_train = wanted(train, t) > wanted(train, t - 1)
    in_val = F.col("__v") > F.coalesce("__v0", F.lit(0))
    part = F.when(in_train, "train").when(in_val, "val").otherwise("test")
    return attach(rows, prev.select(session, part.alias("split")), [session])


def draw_places(classes: DataFrame, n: int, seed: int, label: str = "label") -> DataFrame:
    """``n`` draws with replacement: label, rank (1-based, within the label), copies.

    ``classes`` has label, n (rows) and weight (of each row).  All weights form
    one line, class after class; the draw with number i falls where the hash of
    i says, so neither tasks nor retries change it, and there are ``n`` draws.
    """
    running = Window.orderBy(label)  # one row per class
    line = classes.where((F.col("n") > 0) & (F.col("weight") > 0)).withColumn("upto", F.sum(F.col("n") * F.col("weight")).over(running))
    line = line.withColumn("since", F.lag("upto", 1, 0.0).over(running))
    packed = line.agg(F.sort_array(F.collect_list(F.struct("upto", "since", "weight", "n", label))).alias("__line"))
    u = hash60(seed, "id") / F.lit(2.0**HASH_BITS)
    at = F.col("__at")
    hit = F.coalesce(F.try_element_at(F.filter("__line", lambda c: c["upto"] > at), F.lit(1)), F.try_element_at("__line", F.lit(-1)))
    return (
        with_row(classes.sparkSession.range(n), packed)
        .where(F.size("__line") > 0)
        .withColumn("__at", u * F.element_at("__line", -1)["upto"])
        .withColumn("__hit", hit)
        .select(
            F.col(f"__hit.{label}").alias(label),
            F.least(F.col("__hit.n"), F.floor((at - F.col("__hit.since")) / F.col("__hit.weight")) + 1).cast("long").alias("rank"),
        )
        .groupBy(label, "rank")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def resample(rows: DataFrame, weights: DataFrame, id_cols: list[str], seed: int = 42, label: str = "label", n: int | None = None) -> DataFrame:
    """Draw ``n`` rows (as many as there are) with replacement, each with the weight of its label.

    Rows of a label are numbered by their hash in slices; draws name numbers
    and are counted before they meet the rows, so no label is gathered in one
    task.  ``copy`` counts the copies of a row.  Rows without a label, or with
    one that has no weight, are never drawn.  ``id_cols`` identify a row.
    """
    labelled = rows.where(F.col(label).isNotNull())
    if n is None:
        n = labelled.count()
    sizes = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    places = draw_places(sizes.join(weights.select(label, F.col("weight").cast("double")), label), n, seed, label)
    hashed = labelled.withColumn("__h", hash60(seed, *id_cols))
    ranked = over_slices(hashed, [label], ["__h", *id_cols], 2.0**HASH_BITS / RANK_SLICES, rank="__rank")
    drawn = ranked.join(places.withColumnsRenamed({"rank": "__rank", "copies": "__copies"}), [label, "__rank"])
    return drawn.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("copy"))


def auto_balance(rows: DataFrame, id_cols: list[str], threshold: float = 3.0, seed: int = 42, label: str = "label") -> DataFrame:
    """Resample with balanced weights when the largest class exceeds ``threshold`` times the smallest."""
    dist = cut(distribution(rows.where(F.col(label).isNotNull()), label))
    imbalance = dist.agg(F.max("imbalance")).first()[0]
    if imbalance is None or imbalance <= threshold:
        return rows.withColumn("copy", F.lit(1).cast("long"))
    return resample(rows, dist, id_cols, seed, label)


def fit_norm(samples: DataFrame, keys: list[str], value: str = "x", floor: float = 1e-8) -> DataFrame:
    """Mean and sample std per channel of the training part."""
    return (
        samples.where("split = 'train'")
        .groupBy(*keys)
        .agg(F.avg(value).alias("mean"), F.greatest(F.coalesce(F.stddev_samp(value), F.lit(0.0)), F.lit(floor)).alias("std"))
    )


def apply_norm(samples: DataFrame, norm: DataFrame, keys: list[str], value: str = "x") -> DataFrame:
    return attach(samples, norm, keys).withColumn(value, (F.col(value) - F.col("mean")) / F.col("std")).drop("mean", "std")


def confusion(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return pred.groupBy(y, p).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame, classes: list[int], y: str = "y", p: str = "p") -> DataFrame:
    """One row per true class, one column per predicted class."""
    return pred.groupBy(y).agg(*[F.count_if(F.col(p) == c).alias(f"p{c}") for c in classes])


def class_report(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall and F1 per class; 0 where undefined."""
    cell = confusion(pred, y, p)
    ends = cell.select(F.explode(F.array(F.struct(F.col(y).alias("class"), F.lit(1).alias("t"), F.lit(0).alias("q")), F.struct(F.col(p).alias("class"), F.lit(0).alias("t"), F.lit(1).alias("q")))).alias("e"), "n", y, p)
    per = ends.groupBy("e.class").agg(
        F.sum(F.when((F.col("e.t") == 1) & (F.col(y) == F.col(p)), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.col("e.t") * F.col("n")).alias("support"),
        F.sum(F.col("e.q") * F.col("n")).alias("predicted"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return (
        per.withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .select("class", "precision", "recall", "f1", "support")
    )


def class_accuracy(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return pred.groupBy(F.col(y).alias("class")).agg(
        F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


def accuracy(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Overall and balanced accuracy."""
    return class_accuracy(pred, y, p).agg(
        (F.sum(F.col("accuracy") * F.col("n")) / F.sum("n")).alias("accuracy"),
        F.avg("accuracy").alias("balanced_accuracy"),
        F.sum("n").alias("n"),
    )


def lr_baseline(features: DataFrame, columns: list[str], max_iter: int = 1000) -> DataFrame:
    """Class-balanced logistic regression, fitted on the training part, applied to all rows.

    ``features`` has label (0/1), split and the feature columns.
    """
    weights = distribution(features.where("split = 'train'"))
    rows = attach(features, weights.select("label", "weight"), ["label"])
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(cut(rows))  # read once per iteration
    model = LogisticRegression(maxIter=max_iter, weightCol="weight").fit(rows.where("split = 'train'"))
    out = model.transform(rows)
    return out.withColumn("p1", vector_to_array("probability")[1]).withColumn("p", F.col("prediction").cast("int")).drop(
        "features", "rawPrediction", "probability", "prediction", "weight"
    )


def split_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))


def feature_shapes(windows: DataFrame, modalities: list[str]) -> DataFrame:
    """Distinct array lengths per modality with their counts."""
    rows = F.array(*[F.struct(F.lit(m).alias("modality"), F.size(m).alias("length")) for m in modalities])
    return windows.select(F.explode(rows).alias("r")).groupBy("r.modality", "r.length").agg(F.count(F.lit(1)).alias("n"))
