"""Clusters, their names, and principal components."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.sources.rounds import settled


def _vectors(df: DataFrame, cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol="_v").transform(df.dropna(subset=cols))


def kmeans(df: DataFrame, cols: list[str], k: int, restarts: int = 10, seed: int = 42, name: str = "cluster") -> DataFrame:
    """Complete rows with the label of the best of `restarts` runs (lowest cost)."""
    rows = settled(_vectors(df, cols))  # read by every run
    runs = [KMeans(k=k, seed=seed + i, featuresCol="_v", predictionCol=name).fit(rows) for i in range(restarts)]
    return min(runs, key=lambda m: m.summary.trainingCost).transform(rows).drop("_v")


def relabel_by_mean(df: DataFrame, label: str, col: str, names: list[str], out: str = "level") -> DataFrame:
    """Adds <out> and <out>_ord: clusters renamed in the order of a column's mean (ties by label)."""
    means = df.groupBy(label).agg(F.avg(col).alias("_m"))
    ranked = means.select(label, (F.row_number().over(Window.orderBy("_m", label)) - 1).alias(f"{out}_ord"))  # k rows
    titles = F.array(*[F.lit(n) for n in names])
    return df.join(F.broadcast(ranked), label).withColumn(out, F.try_element_at(titles, F.col(f"{out}_ord") + 1))


def relabel_by_profile(df: DataFrame, label: str, steps: list[tuple[str, str]], rest: str, out: str = "context_name", number: str | None = None) -> DataFrame:
    """Names clusters in turn: each step (column, name) takes the unnamed cluster with the largest mean of the column; what
    is left gets `rest`. `number` adds the step's place, whatever the labels are. The profile has k rows."""
    profile = df.groupBy(label).agg(*[F.avg(c).alias(f"_m{i}") for i, (c, _) in enumerate(steps)])
    rows, named = sorted(profile.collect(), key=lambda r: r[label]), {}
    for i, (_, title) in enumerate(steps):
        free = [r for r in rows if r[label] not in named and r[f"_m{i}"] is not None]
        if free:
            named[max(free, key=lambda r: (r[f"_m{i}"], -r[label]))[label]] = (i, title)
    place = F.lit(len(steps))
    for got, (i, _) in named.items():
        place = F.when(F.col(label) == got, F.lit(i)).otherwise(place)
    titles = F.array(*[F.lit(t) for _, t in steps], F.lit(rest))
    named_df = df.withColumn(out, F.element_at(titles, place + 1))
    return named_df.withColumn(number, place) if number else named_df


def segment_features(knn: DataFrame, key: str, id_cols: list[str], attrs: DataFrame, attr_id: str, enabled: str, order: str, level: str) -> DataFrame:
    """Per place: median and maximum order, median and minimum level of its enabled near segments (wide ids to long)."""
    one = attrs.groupBy(attr_id).agg(F.first(enabled).alias(enabled), F.first(order).alias(order), F.first(level).alias(level))
    long = knn.select(key, F.explode(F.array(*id_cols)).alias(attr_id)).where(F.col(attr_id).isNotNull())
    on = long.join(one, attr_id).where(F.col(enabled) == 1)
    med = lambda c: F.percentile(F.col(c), F.lit(0.5))
    got = on.groupBy(key).agg(med(order).alias("order_median"), F.max(order).alias("order_max"), med(level).alias("level_median"), F.min(level).alias("level_min"))
    return knn.select(key).join(got, key, "left")


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds <col>_s by the population deviation of complete rows; 0 for constant columns, null for incomplete rows."""
    full = df.dropna(subset=cols)
    stats = full.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"_d{i}") for i, c in enumerate(cols)])
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    z = lambda i, c: F.when(whole, F.coalesce(F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_d{i}")), F.lit(0.0)))
    return df.join(F.broadcast(stats), how="cross").select(*df.columns, *[z(i, c).alias(f"{c}_s") for i, c in enumerate(cols)])


# Names of the proximity levels and, in their order, of the contexts with the column that picks each.
LEVELS = ["Muy cercano", "Cercano", "Lejano", "Muy lejano"]
CONTEXTS = [("proximity_ord", "Lejos de la red"), ("order_median", "Junto a colectores"), ("level_median", "Arroyos menores muy cerca")]
REST = "Los más cercanos"


def hydro_context(knn: DataFrame, key: str, dist_cols: list[str], features: DataFrame, k: int = 4, restarts: int = 10) -> DataFrame:
    """Proximity level of each place from its distances (clusters ordered by the mean of the first), then a context from level and
    network features: its number, 0 to 3 in the order of CONTEXTS, and its name. Places with incomplete features get none."""
    near = relabel_by_mean(kmeans(knn, dist_cols, k, restarts, name="_p"), "_p", dist_cols[0], LEVELS[:k], "proximity").drop("_p")
    both = settled(near.join(features, key))
    cols = ["proximity_ord", "order_median", "order_max", "level_median", "level_min"]
    scaled = standardise(both, cols)
    grouped = kmeans(scaled, [f"{c}_s" for c in cols], k, restarts, name="_c")
    named = relabel_by_profile(grouped, "_c", CONTEXTS, REST, number="context")
    return both.join(named.select(key, "context", "context_name"), key, "left")


def elbow_k(df: DataFrame, cols: list[str], ks: range = range(2, 9), seed: int = 42) -> DataFrame:
    """(k, cost, distance, best): fits per k, distance of the cost curve to its chord, the farthest is the choice."""
    rows = settled(_vectors(df, cols))  # read by every fit
    costs = [(k, KMeans(k=k, seed=seed, featuresCol="_v").fit(rows).summary.trainingCost) for k in ks]
    (k0, c0), (k1, c1) = costs[0], costs[-1]
    norm = ((k1 - k0) ** 2 + (c1 - c0) ** 2) ** 0.5 or 1.0
    far = [(k, float(c), abs((c1 - c0) * k - (k1 - k0) * c + k1 * c0 - c1 * k0) / norm) for k, c in costs]
    best = max(far, key=lambda r: (r[2], -r[0]))[0]
    return df.sparkSession.createDataFrame([(k, c, d, k == best) for k, c, d in far], "k int, cost double, distance double, best boolean")


def pca(df: DataFrame, key: str, cols: list[str], n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(variance, loadings, scores) of the first n components of the centred columns. Each component's largest loading is positive."""
    means = df.dropna(subset=cols).agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    centred = df.dropna(subset=cols).join(F.broadcast(means), how="cross").select(key, *[(F.col(c) - F.col(f"_m{i}")).alias(c) for i, c in enumerate(cols)])
    rows = _vectors(centred, cols)
    model = PCA(k=n, inputCol="_v", outputCol="_s").fit(rows)
    weights, signs = model.pc.toArray(), []
    for j in range(n):
        signs.append(1.0 if weights[abs(weights[:, j]).argmax(), j] >= 0 else -1.0)
    spark = df.sparkSession
    ratio, total = model.explainedVariance.toArray().tolist(), 0.0
    variance = [(j, r, total := total + r) for j, r in enumerate(ratio)]
    loadings = [(c, j, float(weights[i, j] * signs[j])) for i, c in enumerate(cols) for j in range(n)]
    arr = vector_to_array("_s")
    scores = model.transform(rows).select(key, *[(arr[j] * signs[j]).alias(f"pc{j}") for j in range(n)])
    return spark.createDataFrame(variance, "component int, explained double, cumulative double"), spark.createDataFrame(loadings, "column string, component int, loading double"), scores


def cluster_crosstab(df: DataFrame, a: str, b: str, cols: list[str]) -> DataFrame:
    """Rows per cluster and sector with the cluster's means."""
    means = df.groupBy(a).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])
    return df.groupBy(a, b).agg(F.count("*").alias("n")).join(means, a)
