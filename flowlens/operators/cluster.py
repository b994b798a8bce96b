"""M1-M6: splitting per-minute activity into normal and unusually high.

* ``kmeans`` (M1, M2, M4): VectorAssembler + MLlib KMeans in a Pipeline,
  seeded.  The input aggregate is checkpointed to the cluster's checkpoint
  folder first, so the ~20 iterations read it back instead of recomputing
  the scan and shuffle, and a lost executor costs a re-read, not a rescan.
* ``kmeans_cost`` (M3): within-cluster sum of squares with a DataFrame
  aggregate (MLlib's computeCost no longer exists; the training summary
  reports the cost before the last centre update).
* ``silhouette`` (M5): ClusteringEvaluator's definition as a DataFrame
  aggregate (``silhouette_evaluator`` calls the evaluator itself).
* ``two_means_exact`` (M6): for one feature and k=2 the optimum is a
  threshold.  Distinct values with their multiplicities are aggregated,
  then running sums are built in two levels -- inside ``BUCKETS`` ranges of about equally
  many values (a window per bucket) and across the bucket totals -- so no step moves all values into one task.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.schemas import COUNT
from flowlens.session import reliable_checkpoint

FEATURES = "features"
DEFAULT_SEED = 1


def _centre_text(centre) -> str:
    return ",".join(repr(float(x)) for x in centre)


def _empty_result(df: DataFrame, k: int) -> DataFrame:
    return df.select(
        "*",
        F.lit(None).cast("int").alias("prediction"),
        F.lit(None).cast("array<string>").alias("CENTROID"),
        F.lit(None).cast("array<array<double>>").alias("CENTROIDS"),
        F.lit(None).cast("boolean").alias("IS_HIGH"),
    ).limit(0)


def fit(data: DataFrame, features=(COUNT,), k: int = 2, seed: int = DEFAULT_SEED, max_iter: int = 20,
        tol: float = 1e-4) -> PipelineModel | None:
    """The fitted pipeline (assembler and k-means), or None for no row.  ``data`` has no null feature and is read some 20 times."""
    if data.isEmpty():
        return None
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    return Pipeline(stages=[assembler, KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol=FEATURES)]).fit(data)


def assign(data: DataFrame, model: PipelineModel | None, k: int = 2) -> DataFrame:
    """M4: every row of ``data`` labelled by ``model``, fitted on these rows or on earlier ones; see ``kmeans`` for the columns."""
    if model is None:
        return _empty_result(data, k)
    centres = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]  # k values, bounded
    norms = [sum(x * x for x in c) ** 0.5 for c in centres]
    high = max(range(len(centres)), key=lambda i: norms[i])
    features = model.stages[0].getInputCols()
    out = model.transform(data.dropna(subset=features)).drop(FEATURES)
    return out.withColumns({
        "CENTROID": F.array(*[F.lit(_centre_text(c)) for c in centres]),
        "CENTROIDS": F.array(*[F.array(*[F.lit(x).cast("double") for x in c]) for c in centres]),
        "IS_HIGH": (F.col("prediction") == F.lit(high)) if len(centres) > 1 else F.lit(False),
    })


def kmeans(
    df: DataFrame,
    features=(COUNT,),
    k: int = 2,
    seed: int = DEFAULT_SEED,
    max_iter: int = 20,
    checkpoint: bool = True,
    dropna: bool = True,
    tol: float = 1e-4,
) -> DataFrame:
    """Fit k-means on ``features`` and label every row.

    Adds ``prediction`` (cluster index), ``CENTROID`` (every centre as
    text, the same array on every row), ``CENTROIDS`` (the centres as numbers, one
    array per centre) and ``IS_HIGH`` (row belongs to the centre with the
    largest norm; false with a single centre: nothing stands out).  Empty input gives
    an empty frame with this schema; fewer distinct points than ``k``
    gives fewer centres.
    """
    data = df.dropna(subset=list(features)) if dropna else df
    if checkpoint:
        data = reliable_checkpoint(data)
    return assign(data, fit(data, features, k, seed, max_iter, tol), k)


def kmeans_multi(df: DataFrame, features=("DURATION", "ORIG_PKTS", "ORIG_BYTES"), **kw) -> DataFrame:
    """M2: k-means on several sums; rows with a null feature are left out."""
    return kmeans(df, features=features, dropna=True, **kw)


def centre_means(assigned: DataFrame, features) -> DataFrame:
    """Per cluster: ``prediction``, N, its centre and the mean of its rows.  At a fixed point of Lloyd's method the two are
    equal (``kmeans`` with ``tol=0`` and enough rounds ends there)."""
    own = F.element_at("CENTROIDS", F.col("prediction").cast("int") + 1)
    means = F.array(*(F.avg(F.col(f).cast("double")) for f in features))
    return assigned.groupBy("prediction").agg(F.count(F.lit(1)).alias("N"), F.any_value(own).alias("CENTRE"), means.alias("MEAN"))


def kmeans_cost(assigned: DataFrame, features=(COUNT,), prediction: str = "prediction") -> DataFrame:
    """M3: one row, WSSSE = sum of squared distances to the model's own centres, carried in ``CENTROIDS``."""
    own = F.element_at(F.col("CENTROIDS"), F.col(prediction).cast("int") + 1)
    sq = sum(((F.col(f) - F.element_at(own, i + 1)) ** 2 for i, f in enumerate(features)), F.lit(0.0))
    return assigned.agg(F.sum(sq).alias("WSSSE"))


def silhouette_evaluator(assigned: DataFrame, features=(COUNT,), prediction: str = "prediction") -> float:
    """M5 as a number, from Spark's ClusteringEvaluator (squared Euclidean)."""
    vec = VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(assigned)
    return ClusteringEvaluator(featuresCol=FEATURES, predictionCol=prediction).evaluate(vec)


def silhouette(assigned: DataFrame, features=(COUNT,), prediction: str = "prediction") -> DataFrame:
    """M5: mean squared-Euclidean silhouette as a one-row DataFrame.

    The mean squared distance from a point x to the points of cluster c is
    (n_c*|x|^2 + Q_c - 2 x.S_c) / n_c, with n_c, S_c (feature sums) and
    Q_c (sum of squared norms) from one aggregate of k rows.  Those k rows
    come to the driver (bounded by k) and the per-point score is a column
    expression, so the points are read once more in parallel.  Same
    definition as ClusteringEvaluator; null when there is one cluster.
    """
    features = list(features)
    data = assigned.dropna(subset=[*features, prediction])
    norm2 = sum((F.col(f).cast("double") ** 2 for f in features), F.lit(0.0))
    stats = data.groupBy(prediction).agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm2).alias("q"),
        *[F.sum(F.col(f).cast("double")).alias(f"s{i}") for i, f in enumerate(features)],
    ).collect()  # k rows
    if len(stats) < 2:
        return data.agg(F.lit(None).cast("double").alias("SILHOUETTE"))
    pred = F.col(prediction)
    dist = {}
    for r in stats:
        dot = sum((F.col(f).cast("double") * F.lit(float(r[f"s{i}"])) for i, f in enumerate(features)), F.lit(0.0))
        dist[r[prediction]] = (norm2 * F.lit(float(r["n"])) + F.lit(float(r["q"])) - F.lit(2.0) * dot) / F.lit(float(r["n"]))
    sizes = {r[prediction]: int(r["n"]) for r in stats}
    own = None
    own_n = None
    for c, dc in dist.items():
        adj = dc * F.lit(float(sizes[c])) / F.lit(float(max(sizes[c] - 1, 1)))
        own = F.when(pred == c, adj) if own is None else own.when(pred == c, adj)
        own_n = F.when(pred == c, F.lit(sizes[c])) if own_n is None else own_n.when(pred == c, F.lit(sizes[c]))
    other = F.least(*[F.when(pred != c, dc) for c, dc in dist.items()])
    score = (
        F.when(own_n == 1, F.lit(0.0))
        .when(own < other, F.lit(1.0) - own / other)
        .when(own > other, other / own - F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return data.agg(F.avg(score).alias("SILHOUETTE"))


# ----------------------------------------------------------------- M6
BUCKETS = 256


def two_means_exact(df: DataFrame, feature: str = COUNT, checkpoint: bool = True) -> DataFrame:
    """M6: exact 1-D two-means; one row, or none for empty input.

    Columns: N, K (2, or 1 when all values are equal), THRESHOLD (largest
    value of the low cluster), LOW_N, HIGH_N, LOW_CENTER, HIGH_CENTER,
    COST (within-cluster sum of squares).  Ties go to the lower threshold.

    The distinct values (at most about sqrt(2 * rows) of them for counts)
    feed two branches; ``checkpoint`` stores them once in the checkpoint
    folder so the input is aggregated once, not once per branch.
    """
    x = F.col(feature)
    is_integral = isinstance(df.schema[feature].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    acc = T.DecimalType(38, 0) if is_integral else T.DoubleType()
    values = (
        df.where(x.isNotNull())
        .groupBy(x.alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("xa", F.col("x").cast(acc))
        .withColumn("s", F.col("n").cast(acc) * F.col("xa"))
        .withColumn("q", F.col("s") * F.col("xa"))
    )
    # Buckets are ranges of the value between sampled quantiles of the distinct values: about equal in size for any feature.
    if checkpoint:
        values = reliable_checkpoint(values)
    cuts = values.agg(F.percentile_approx("x", [i / BUCKETS for i in range(1, BUCKETS)], 100 * BUCKETS)).first()[0]
    cuts = sorted(set(cuts or []))
    values = values.withColumn("b", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("x"))) if cuts else F.lit(0))
    # Level 1: totals per bucket (at most BUCKETS rows) and their running sums.
    buckets = values.groupBy("b").agg(F.sum("n").alias("bn"), F.sum("s").alias("bs"), F.sum("q").alias("bq"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = buckets.select(
        "b",
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("on"),
        F.coalesce(F.sum("bs").over(before), F.lit(0).cast(acc)).alias("os"),
        F.coalesce(F.sum("bq").over(before), F.lit(0).cast(acc)).alias("oq"),
        F.sum("bn").over(everything).alias("tn"),
        F.sum("bs").over(everything).alias("ts"),
        F.sum("bq").over(everything).alias("tq"),
    )
    # Level 2: running sums inside each bucket, shifted by the bucket offset.
    upto = Window.partitionBy("b").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = values.select(
        "b", "x",
        F.sum("n").over(upto).alias("pn"), F.sum("s").over(upto).alias("ps"), F.sum("q").over(upto).alias("pq"),
    ).join(F.broadcast(offsets), "b")  # offsets: one row per bucket, bounded
    # Sums are added exactly (long / decimal) and only then turned into doubles.
    nl = F.col("on") + F.col("pn")
    sl_x = F.col("os") + F.col("ps")
    ql_x = F.col("oq") + F.col("pq")
    nr = F.col("tn") - nl
    sl, ql = sl_x.cast("double"), ql_x.cast("double")
    sr, qr = (F.col("ts") - sl_x).cast("double"), (F.col("tq") - ql_x).cast("double")
    cand = prefix.select(
        F.col("x").alias("THRESHOLD"),
        F.col("tn").alias("N"),
        nl.alias("LOW_N"),
        nr.alias("HIGH_N"),
        (sl / nl).alias("LOW_CENTER"),
        F.when(nr > 0, sr / nr).alias("HIGH_CENTER"),
        F.greatest((ql - sl * sl / nl) + F.when(nr > 0, qr - sr * sr / nr).otherwise(F.lit(0.0)),
                   F.lit(0.0)).alias("COST"),
        F.when(nr > 0, F.lit(2)).otherwise(F.lit(1)).alias("K"),
    )
    best = cand.orderBy(F.col("K").desc(), F.col("COST").asc(), F.col("THRESHOLD").asc()).limit(1)
    return best.select("N", "K", "THRESHOLD", "LOW_N", "HIGH_N", "LOW_CENTER", "HIGH_CENTER", "COST")
