"""Clusters of counted vectors."""

from agorascope.operators import clusters
from agorascope.plans import modelling

FLAGS = ["a", "b", "c"]


def _vectors(spark):
    rows = [(f"s{i % 3}", i % 2, (i // 2) % 2, int(i % 7 == 0)) for i in range(200)]
    return spark.createDataFrame(rows, "community string, a int, b int, c int").repartition(7)


def test_counted_vectors_give_the_shares_and_sizes_of_the_rows(spark, rows):
    vectors = _vectors(spark)
    counted = clusters.counted_vectors(vectors, FLAGS, ["community"])
    model = clusters.fit_kmeans(clusters.weighted_points(vectors, FLAGS), 3)
    of_rows = clusters.assign_clusters(vectors, FLAGS, model)
    of_counts = clusters.assign_clusters(counted, FLAGS, model)
    assert counted.count() <= 3 * 8
    assert rows(clusters.weighted_points(counted, FLAGS, "weight")) == rows(clusters.weighted_points(vectors, FLAGS))
    assert rows(clusters.community_share(of_counts, range(3), weight="weight")) == rows(clusters.community_share(of_rows, range(3)))
    assert rows(clusters.cluster_sizes(of_counts, FLAGS, weight="weight")) == rows(clusters.cluster_sizes(of_rows, FLAGS))


def test_points_come_in_order(spark):
    points = [tuple(r[:3]) for r in clusters.weighted_points(_vectors(spark), FLAGS).collect()]
    assert points == sorted(points)


def test_texts_are_scored_once_for_fitted_clusters(spark, monkeypatch):
    scored = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            scored.add(batch.num_rows)
            yield batch

    vectors = _vectors(spark).withColumnsRenamed(dict(zip(FLAGS, modelling.PAINS)))
    for name in modelling.PAINS[3:]:
        vectors = vectors.selectExpr("*", f"0 as {name}")
    monkeypatch.setattr(modelling, "_vectors", lambda *_: vectors.mapInArrow(counting, vectors.schema))
    shares = modelling.community_fitted_cluster_share(spark, "").collect()
    assert len(shares) == 3 and scored.value == 200
