"""Pain-point vectors and their clusters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.binding import add_kept
from ..functions.numeric import percent
from ..functions.valence import ValenceLexicon, valence
from ..session import scratch_dir
from .mentions import Dictionary
from .resampling import exact_sample


def pain_point_vectors(
    texts: DataFrame, subject: Sequence[tx.Term], pain_points: Dictionary, lexicon: ValenceLexicon,
    cut: float = -0.2, keep: Sequence[str] = ("community", "text", "source"), word: bool = False,
) -> DataFrame:
    """Negative texts on the subject with a 0/1 column per pain point, at least one of them 1.

    The cheap filters come first; only texts that pass them are scored.
    """
    lowered = F.lower("text")
    about = texts.where(tx.text_mentions(F.col("text"), subject, word))
    flags = F.struct(*[tx.mentions(lowered, terms, word).cast("int").alias(name) for name, terms in pain_points.items()])
    flagged = add_kept(about, "__flags", flags, lambda f: reduce(or_, [f[name] == 1 for name in pain_points]))
    negative = add_kept(flagged, "sentiment", valence(F.col("text"), lexicon), lambda score: score < cut)
    return negative.select(*keep, "sentiment", "__flags.*")


def _rows(weight: str | None) -> Column:
    """How many rows of the texts a row stands for."""
    return F.lit(1) if weight is None else F.col(weight)


def weighted_points(vectors: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Distinct 0/1 vectors with the number of rows having each: at most 2**len(columns) rows,
    whatever the number of texts, and the same clusters as the rows themselves. They lie in one
    partition in order, so that sums over them repeat to the last digit."""
    points = vectors.groupBy(*columns).agg(F.sum(_rows(weight)).cast("double").alias("weight")).repartition(1).sortWithinPartitions(*columns)
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(points)


def counted_vectors(vectors: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct 0/1 vectors of each group with the number of rows having each, as ``weight``, written to the scratch folder.

    Texts are scored once for this table, and the fit and the shares read it instead: at most
    2**len(columns) rows a group, whatever the number of texts.
    """
    path = scratch_dir(vectors.sparkSession, "vectors")
    counted = vectors.groupBy(*by, *columns).agg(F.count(F.lit(1)).alias("weight"))
    counted.write.parquet(path)
    return vectors.sparkSession.read.schema(counted.schema).parquet(path)


def fit_kmeans(points: DataFrame, k: int, seed: int = 42) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", weightCol="weight", predictionCol="cluster").fit(points)


def kmeans_sweep(
    vectors: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(2, 10), seed: int = 42,
    key: str | None = None, judged_rows: int | None = None,
) -> DataFrame:
    """Inertia and silhouette per k over all rows, with the best k by silhouette marked.

    With ``judged_rows``, silhouettes are those of a sample of exactly so many rows by ``key``.

    ``on_boundary`` says that the best k is the largest tried, so the range was too short.
    There is a row for each k. One that can't be fitted, since there are no more distinct vectors than
    clusters or fewer than two clusters, has ``tried`` false and null measures.
    """
    points = weighted_points(vectors, columns).persist(StorageLevel.MEMORY_AND_DISK)
    distinct = points.count()
    judged = points if judged_rows is None else weighted_points(exact_sample(vectors, key, judged_rows, seed=seed), columns).persist(StorageLevel.MEMORY_AND_DISK)
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", weightCol="weight")
    rows = []
    for k in (k for k in ks if 1 < k < distinct):
        model = fit_kmeans(points, k, seed)
        rows.append((k, float(model.summary.trainingCost), float(evaluator.evaluate(model.transform(judged)))))
    points.unpersist()
    judged.unpersist()
    best = max(rows, key=lambda r: (r[2], -r[0]))[0] if rows else None
    last = max(ks)
    measured = {k: (cost, score) for k, cost, score in rows}
    marked = [(k, *measured.get(k, (None, None)), k in measured, k == best, k == best == last) for k in ks]
    return vectors.sparkSession.createDataFrame(
        marked, "k int, inertia double, silhouette double, tried boolean, is_best boolean, on_boundary boolean"
    )


def centroids(vectors: DataFrame, columns: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Cluster, pain point and centre coordinate in long form."""
    points = weighted_points(vectors, columns).persist(StorageLevel.MEMORY_AND_DISK)
    model = fit_kmeans(points, k, seed)
    points.unpersist()
    rows = [(c, name, float(x)) for c, centre in enumerate(model.clusterCenters()) for name, x in zip(columns, centre)]
    return vectors.sparkSession.createDataFrame(rows, "cluster int, pain_point string, value double")


def community_share(
    clustered: DataFrame, clusters: Sequence[int], community: str = "community", cluster: str = "cluster", weight: str | None = None,
) -> DataFrame:
    """Percentage of each community's rows per cluster, one column per cluster. Rows may stand for as many as ``weight`` says."""
    total = F.sum(_rows(weight))
    return clustered.groupBy(community).agg(*[
        percent(F.sum(F.when(F.col(cluster) == c, _rows(weight)).otherwise(0)), total).alias(f"cluster_{c}_pct") for c in clusters
    ])


def assign_clusters(vectors: DataFrame, columns: Sequence[str], model: KMeansModel) -> DataFrame:
    """Each row with the ``cluster`` of its vector. Only distinct vectors are predicted, at most
    2**len(columns) of them, and sent to the rows."""
    distinct = VectorAssembler(inputCols=list(columns), outputCol="features").transform(vectors.select(*columns).distinct())
    return vectors.join(F.broadcast(model.transform(distinct).select(*columns, "cluster")), list(columns))


def cluster_sizes(clustered: DataFrame, columns: Sequence[str], cluster: str = "cluster", weight: str | None = None) -> DataFrame:
    """Rows of each cluster and the share of them with each column's flag."""
    size = F.sum(_rows(weight))
    return clustered.groupBy(cluster).agg(size.alias("size"), *[(F.sum(F.col(c) * _rows(weight)) / size).alias(c) for c in columns])
