"""Model inputs, labels, metrics, profiles, clusters and fitted models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..operators import brands as br, clusters, early, evaluation as ev, hygiene, importance as imp, models, profiles
from . import bindings as b
from .depth import EARLY, WINDOW
from .registry import query
from .sqltext import has_any, key_fraction, normalized, utc
from .textmine import _list_sentiment, valence_ctes


# --- features and labels -------------------------------------------------------------------------

@query("content_time_features", b.with_ctes(b.TEXTS) + f"""
SELECT id, concat_ws(' ', title, selftext) AS text, round(CASE WHEN score > -1 THEN ln(1 + score) END, 6) AS log_score,
       CAST(coalesce(length(title), 0) AS INTEGER) AS title_len, CAST(coalesce(length(selftext), 0) AS INTEGER) AS selftext_len,
       CAST(hour({utc('created_utc')}) AS DOUBLE) AS post_hour, CAST(dayofweek({utc('created_utc')}) + 1 AS DOUBLE) AS post_dow
FROM texts""")
def content_time_features(spark, folder):
    featured = models.content_time_features(b.texts(spark, folder))
    return b.rounded(featured.select("id", "text", "log_score", *models.CONTENT_NUMBERS))


VIRAL = """ranked AS (SELECT id, score, ln(1 + score) AS log_score, percent_rank() OVER (ORDER BY score DESC) AS r FROM posts),
labelled AS (SELECT id, CASE WHEN r <= 0.10 THEN 1 ELSE 0 END AS is_viral FROM ranked)"""


def _viral_posts(spark, folder):
    return ev.viral_label(b.posts(spark, folder).withColumn("log_score", F.log1p("score")))


@query("viral_label", b.with_ctes(b.POSTS, VIRAL) + "SELECT id, is_viral FROM labelled")
def viral_label(spark, folder):
    return _viral_posts(spark, folder).select("id", "is_viral")


@query("viral_class_balance", b.with_ctes(b.POSTS, VIRAL) + """
SELECT is_viral, count(*) AS n_rows, round(100.0 * count(*) / (SELECT count(*) FROM labelled), 6) AS pct FROM labelled GROUP BY 1""")
def viral_class_balance(spark, folder):
    return b.rounded(ev.class_balance(_viral_posts(spark, folder), "is_viral"))


PROFILES = """profiles AS (
  SELECT *, CASE WHEN activity_span_days > 0 THEN total_comments / activity_span_days ELSE CAST(total_comments AS DOUBLE) END AS comments_per_day,
         upvoted_comments / total_comments AS upvote_rate, very_short_comments / total_comments AS short_comment_rate
  FROM (SELECT author, count(*) AS total_comments, count(DISTINCT community) AS subreddit_diversity,
      count(DISTINCT CAST(created AS DATE)) AS active_days, coalesce(stddev(hour(created)), 0) AS posting_hour_std,
      avg(hour(created)) AS avg_posting_hour, avg(score) AS avg_comment_score, coalesce(stddev(score), 0) AS score_std,
      count(*) FILTER (score > 1) AS upvoted_comments, avg(length) AS avg_comment_length,
      coalesce(stddev(length), 0) AS text_length_std, count(*) FILTER (length < 9) AS very_short_comments,
      min(created) AS first_comment, max(created) AS last_comment,
      CAST(CAST(max(created) AS DATE) - CAST(min(created) AS DATE) AS INTEGER) AS activity_span_days
    FROM (SELECT event_id, user_id AS author, event_type AS community, value AS score, ts AS created, length(props) AS length FROM events)
    GROUP BY author))"""
SUSPICIOUS = """suspects AS (SELECT *, CASE WHEN (total_comments > 70 AND subreddit_diversity < 6)
    OR (short_comment_rate > 0.7 AND avg_comment_score < 2) OR comments_per_day > 20 OR posting_hour_std < 6 THEN 1 ELSE 0 END
    AS is_suspicious FROM profiles)"""
LIMITS = {"many": 70, "few_communities": 6, "hour_std": 6}


def _profiles(spark, folder):
    rows = b.table(spark, folder, "events").select(
        F.col("user_id").alias("author"), F.col("event_type").alias("community"), F.col("value").alias("score"),
        F.col("ts").alias("created"), "props",
    )
    return profiles.user_profiles(rows, length=F.length("props"), short=9)


def _round_list(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


@query("user_behavior_features", b.with_ctes(PROFILES) + f"""
SELECT author, total_comments, subreddit_diversity, active_days, upvoted_comments, very_short_comments, activity_span_days,
       strftime(first_comment, '%Y-%m-%d %H:%M:%S') AS first_comment, strftime(last_comment, '%Y-%m-%d %H:%M:%S') AS last_comment,
       {_round_list(['posting_hour_std', 'avg_posting_hour', 'avg_comment_score', 'score_std', 'avg_comment_length', 'text_length_std',
                     'comments_per_day', 'upvote_rate', 'short_comment_rate'])}
FROM profiles""")
def user_behavior_features(spark, folder):
    return b.rounded(_profiles(spark, folder))


@query("suspicious_label", b.with_ctes(PROFILES, SUSPICIOUS) + "SELECT author, is_suspicious FROM suspects")
def suspicious_label(spark, folder):
    return profiles.label_suspicious(_profiles(spark, folder), **LIMITS).select("author", "is_suspicious")


@query("suspicious_class_balance", b.with_ctes(PROFILES, SUSPICIOUS) + """
SELECT is_suspicious, count(*) AS n_rows, round(100.0 * count(*) / (SELECT count(*) FROM suspects), 6) AS pct FROM suspects GROUP BY 1""")
def suspicious_class_balance(spark, folder):
    return b.rounded(ev.class_balance(profiles.label_suspicious(_profiles(spark, folder), **LIMITS), "is_suspicious"))


# --- metrics on given predictions ----------------------------------------------------------------

PREDICTED = f"""predicted AS (
  SELECT p.community, ln(1 + p.score) AS log_score, ln(1 + p.score) * 0.9 + 0.3 AS first,
         ln(1 + p.score) * 0.95 + 0.02 * e.early_comment_avg_score AS second
  FROM posts p JOIN early e ON e.id = p.id)"""
ONE_MODEL = b.with_ctes(b.POSTS, b.COMMENTS, EARLY, PREDICTED)


def _errors(column: str) -> str:
    return f"""1 - avg(pow({column} - log_score, 2)) / var_pop(log_score) AS r2, sqrt(avg(pow({column} - log_score, 2))) AS rmse,
       avg(abs({column} - log_score)) AS mae"""


def _predicted(spark, folder):
    """Posts with two predictions that are simple functions of their columns."""
    featured = early.early_comment_features(b.posts(spark, folder), b.comments(spark, folder), WINDOW)
    log_score = F.log1p("score")
    return featured.select(
        "community", log_score.alias("log_score"), (log_score * 0.9 + 0.3).alias("first"),
        (log_score * 0.95 + F.col("early_comment_avg_score") * 0.02).alias("second"),
    )


@query("regression_metrics", ONE_MODEL + f"""
SELECT n, round(r2, 6) AS r2, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM (SELECT count(*) AS n, {_errors('second')} FROM predicted)""")
def regression_metrics(spark, folder):
    return b.rounded(ev.regression_metrics(_predicted(spark, folder), "log_score", "second"))


@query("rmse_by_community", ONE_MODEL + """
SELECT community, count(*) AS n_samples, round(avg(pow(second - log_score, 2)), 6) AS mse, round(avg(log_score), 6) AS avg_true,
       round(avg(second), 6) AS avg_pred, round(sqrt(avg(pow(second - log_score, 2))), 6) AS rmse FROM predicted GROUP BY 1""")
def rmse_by_community(spark, folder):
    return b.rounded(ev.rmse_by(_predicted(spark, folder), "community", "log_score", "second").orderBy("rmse"))


@query("model_comparison", ONE_MODEL + f""",
a AS (SELECT {_errors('first')} FROM predicted), z AS (SELECT {_errors('second')} FROM predicted)
SELECT metric, round(m1, 6) AS model_1, round(m2, 6) AS model_2, round(m2 - m1, 6) AS delta FROM (
  SELECT 'r2' AS metric, a.r2 AS m1, z.r2 AS m2 FROM a, z UNION ALL SELECT 'rmse', a.rmse, z.rmse FROM a, z
  UNION ALL SELECT 'mae', a.mae, z.mae FROM a, z)""")
def model_comparison(spark, folder):
    return b.rounded(ev.compare_models(_predicted(spark, folder), "log_score", "first", "second"))


JUDGED = """judged AS (SELECT l.doc_id, l.quality AS label, CAST(d.n_chars % 2 AS INTEGER) AS prediction, d.n_chars % 97 AS score
  FROM labels l JOIN documents d USING (doc_id))"""
CLASSES = """classes AS (
  SELECT c AS class, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (prediction = c) AS predicted,
         count(*) FILTER (label = c) AS support FROM judged, (SELECT unnest([0, 1]) AS c) GROUP BY c),
rated AS (SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall FROM classes),
report AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rated),
means AS (SELECT sum(tp) / sum(support) AS accuracy, max(support) / sum(support) AS majority_rate,
    avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) / sum(support) AS wp,
    sum(recall * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf, CAST(sum(support) AS BIGINT) AS support FROM report)"""


def _judged(spark, folder):
    documents = b.table(spark, folder, "documents").select(
        "doc_id", (F.col("n_chars") % 2).cast("int").alias("prediction"), (F.col("n_chars") % 97).alias("score")
    )
    labels = b.table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return labels.join(documents, "doc_id")


CURVES = """points AS (
  SELECT *, coalesce(sum(p) OVER earlier, 0) AS p0, coalesce(sum(n) OVER earlier, 0) AS n0, sum(p) OVER () AS pt, sum(n) OVER () AS nt
  FROM (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n FROM judged GROUP BY score)
  WINDOW earlier AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
areas AS (SELECT sum(n * (p0 + p / 2)) / max(pt * nt) AS auc_roc,
    sum(p * ((p0 + p) / (p0 + p + n0 + n) + CASE WHEN p0 + n0 > 0 THEN p0 / (p0 + n0) ELSE p / (p + n) END) / 2) / max(pt) AS auc_pr
  FROM points)"""


@query("classification_metrics", b.with_ctes(JUDGED, CLASSES, CURVES) + """
SELECT round(accuracy, 6) AS accuracy, round(majority_rate, 6) AS majority_rate, round(wp, 6) AS weighted_precision,
       round(wr, 6) AS weighted_recall, round(wf, 6) AS weighted_f1, support, round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr
FROM means, areas""")
def classification_metrics(spark, folder):
    return b.rounded(ev.classification_metrics(_judged(spark, folder), "label", "prediction", "score"))


@query("confusion_matrix", b.with_ctes(JUDGED) + """
SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1 FROM judged GROUP BY 1""")
def confusion_matrix(spark, folder):
    return ev.confusion_matrix(_judged(spark, folder), "label", "prediction", [0, 1])


@query("class_report", b.with_ctes(JUDGED, CLASSES) + """
SELECT CAST(class AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report
UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), support FROM means
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), support FROM means
UNION ALL SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), support FROM means""")
def class_report(spark, folder):
    return b.rounded(ev.class_report(_judged(spark, folder), "label", "prediction"))


@query("class_distribution", f"""
WITH parts AS (SELECT quality AS label, {key_fraction('doc_id', 42)} < 0.8 AS train FROM labels),
     long AS (SELECT 'all' AS part, label FROM parts UNION ALL SELECT CASE WHEN train THEN 'train' ELSE 'test' END, label FROM parts)
SELECT part, label, count(*) AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY part), 6) AS pct FROM long GROUP BY 1, 2""")
def class_distribution(spark, folder):
    from ..functions.sampling import in_sample

    rows = b.table(spark, folder, "labels").select(
        F.col("quality").alias("label"), in_sample(F.col("doc_id"), 0.8, 42).alias("train")
    )
    return b.rounded(ev.class_distribution(rows, "label", "train").withColumn("n_rows", F.col("n_rows").cast("long")))


# --- pain points and clusters ---------------------------------------------------------------------

SUBJECT = ["th", "de"]
PAINS = list(b.FEATURES)
VECTORS = b.with_ctes(b.TEXTS, b.THREADS) + f""",
united AS (SELECT 'd' || id AS key, community, body AS text, 'comment' AS source FROM texts
  UNION ALL SELECT 't' || id, community, body, 'comment' FROM thread_comments
  UNION ALL SELECT 'c' || id, community, lower(regexp_replace(concat_ws(' ', title, selftext), '\\s+', ' ', 'g')), 'submission' FROM thread_posts),
{valence_ctes('united', 'key', 'text')},
vectors AS (SELECT u.*, s.compound AS sentiment, {', '.join(f"CAST({has_any('lower(u.text)', t)} AS INTEGER) AS {n}" for n, t in b.FEATURES.items())}
  FROM united u JOIN scored s ON s.k = u.key
  WHERE {has_any('lower(u.text)', SUBJECT)} AND ({' OR '.join(has_any('lower(u.text)', t) for t in b.FEATURES.values())}) AND s.compound < -0.2)"""


def _vectors(spark, folder):
    threads = b.keyed(b.thread_posts(spark, folder), "c")
    united = hygiene.unify(b.all_comments(spark, folder), threads, nulls="collapse", keep=["key", "community"])
    return clusters.pain_point_vectors(united, SUBJECT, b.FEATURES, b.VALENCE, keep=("key", "community", "source"))


@query("pain_point_vectors", VECTORS + f"SELECT key, community, source, round(sentiment, 6) AS sentiment, {', '.join(PAINS)} FROM vectors")
def pain_point_vectors(spark, folder):
    return b.rounded(_vectors(spark, folder))


@query("kmeans_sweep")
def kmeans_sweep(spark, folder):
    return clusters.kmeans_sweep(_vectors(spark, folder), PAINS)


@query("cluster_centroids")
def cluster_centroids(spark, folder):
    return clusters.centroids(_vectors(spark, folder), PAINS, 4)


@query("community_cluster_share", VECTORS + f""",
grouped AS (SELECT community, least({' + '.join(PAINS)}, 4) - 1 AS cluster FROM vectors)
SELECT community, {', '.join(f"round(100.0 * count(*) FILTER (cluster = {c}) / count(*), 6) AS cluster_{c}_pct" for c in range(4))}
FROM grouped GROUP BY 1""")
def community_cluster_share(spark, folder):
    """Shares for a cluster column given by the number of pain points, so that SQL can follow."""
    number = sum((F.col(p) for p in PAINS[1:]), F.col(PAINS[0]))
    grouped = _vectors(spark, folder).withColumn("cluster", F.least(number, F.lit(4)) - 1)
    return b.rounded(clusters.community_share(grouped, range(4)))


def _clustered(spark, folder, k=4):
    """Distinct vectors of each community with their cluster and the number of texts, ``weight``."""
    counted = clusters.counted_vectors(_vectors(spark, folder), PAINS, ["community"])
    model = clusters.fit_kmeans(clusters.weighted_points(counted, PAINS, "weight"), k)
    return clusters.assign_clusters(counted, PAINS, model)


@query("cluster_flag_means", VECTORS + f"""
SELECT count(*) AS n_vectors, {', '.join(f"round(avg({p}), 6) AS {p}" for p in PAINS)} FROM vectors""")
def cluster_flag_means(spark, folder):
    """Means of the flags over all vectors, from the sizes and centres of fitted clusters."""
    sizes = clusters.cluster_sizes(_clustered(spark, folder), PAINS, weight="weight")
    total = F.sum("size")
    return b.rounded(sizes.agg(total.alias("n_vectors"), *[(F.sum(F.col("size") * F.col(p)) / total).alias(p) for p in PAINS]))


@query("community_fitted_cluster_share")
def community_fitted_cluster_share(spark, folder):
    """Shares of each community's vectors in fitted clusters."""
    return clusters.community_share(_clustered(spark, folder), range(4), weight="weight")


# --- fitted models, at the library's defaults ------------------------------------------------------


def _featured(spark, folder):
    return models.content_time_features(b.texts(spark, folder))


def _with_early(spark, folder, featured):
    """Texts as posts with the lines of the order of the same number as comments, made from one
    hour before the post to four hours after it."""
    opened = featured.withColumn("link_id", b.link("id"))
    return early.early_comment_features(opened, b.text_comments(spark, folder), spread=("id",))


def _featured_early(spark, folder):
    return _with_early(spark, folder, _featured(spark, folder))


@query("early_features_of_texts", b.with_ctes(b.TEXTS, b.TEXT_COMMENTS) + """
, early AS (
  SELECT t.id, count(c.id) AS n, avg(c.score) AS mean, max(c.score) AS most, avg(c.length) AS length, stddev_samp(c.score) AS deviation
  FROM texts t LEFT JOIN text_comments c ON c.link_id = 't3_' || t.id AND c.created_utc BETWEEN t.created_utc AND t.created_utc + 3600
  GROUP BY 1)
SELECT id, n AS early_comment_count, round(coalesce(mean, 0), 6) AS early_comment_avg_score,
       CAST(coalesce(most, 0) AS BIGINT) AS early_comment_max_score, round(coalesce(length, 0), 6) AS early_comment_avg_length,
       round(coalesce(deviation, 0), 6) AS early_comment_score_std
FROM early""")
def early_features_of_texts(spark, folder):
    """The columns that the models with early comments see beside the content."""
    return b.rounded(_featured_early(spark, folder).select("id", *models.EARLY_NUMBERS))


@query("tfidf_features")
def tfidf_features(spark, folder):
    featured = _featured(spark, folder).select("id", "text")
    fitted = Pipeline(stages=models.tfidf_stages("text")).fit(featured)
    return b.rounded(models.vector_values(fitted.transform(featured), "id", "tfidf"))


@query("category_encoding", """
SELECT doc_id AS id, CAST(substr(source, 4) AS INTEGER) AS index, CAST(1 AS DOUBLE) AS value FROM documents
WHERE regexp_full_match(source, 'src(1?[0-9])')""")
def category_encoding(spark, folder):
    featured = _featured(spark, folder).select("id", "community")
    fitted = Pipeline(stages=models.category_stages(values=b.SOURCES)).fit(featured)
    return models.vector_values(fitted.transform(featured), "id", "community_vec")


@query("engagement_regression_content")
def engagement_regression_content(spark, folder):
    _, scored = models.engagement_regression(_featured(spark, folder), communities=b.SOURCES)
    return ev.regression_metrics(scored, "log_score", "prediction")


@query("engagement_regression_early")
def engagement_regression_early(spark, folder):
    _, scored = models.engagement_regression(_featured_early(spark, folder), extra=models.EARLY_NUMBERS, communities=b.SOURCES)
    return ev.regression_metrics(scored, "log_score", "prediction")


@query("prediction_sample")
def prediction_sample(spark, folder):
    _, scored = models.engagement_regression(_featured(spark, folder), communities=b.SOURCES)
    return models.prediction_sample(scored)


@query("regression_test_rows", b.with_ctes(b.TEXTS) + f"""
SELECT id, round(ln(1 + score), 6) AS log_score FROM texts WHERE score > -1 AND {key_fraction('id', 42)} >= 0.8""")
def regression_test_rows(spark, folder):
    """Keys and true values of the rows on which both regressions are judged."""
    return b.rounded(models.regression_rows(_featured(spark, folder))[1].select("id", "log_score"))


@query("fitted_model_comparison")
def fitted_model_comparison(spark, folder):
    """Metrics of a model on content and of one with early comments, fitted and judged on the same rows."""
    both = models.compared_regressions(_featured_early(spark, folder), models.EARLY_NUMBERS, communities=b.SOURCES)
    return ev.compare_models(both, "log_score", "content", "extended")


@query("term_weights", b.with_ctes(b.TEXTS) + """,
said AS (SELECT id, unnest(string_split_regex(lower(concat_ws(' ', title, selftext)), '\\s+')) AS term FROM texts),
counted AS (SELECT id, term, count(*) AS n FROM said WHERE term <> '' GROUP BY 1, 2),
found AS (SELECT term, count(*) AS texts FROM counted GROUP BY 1)
SELECT id, term, n, round(n * CASE WHEN texts >= 2 THEN ln(((SELECT count(*) FROM texts) + 1.0) / (texts + 1)) ELSE 0 END, 6) AS weight
FROM counted JOIN found USING (term)""")
def term_weights(spark, folder):
    return b.rounded(models.term_weights(_featured(spark, folder)))


def _viral_texts(df):
    return ev.viral_label(df)


@query("viral_classifier_content")
def viral_classifier_content(spark, folder):
    _, scored = models.viral_classifier(_viral_texts(_featured(spark, folder)), communities=b.SOURCES)
    return models.binary_report(scored, "is_viral")


@query("viral_classifier_early")
def viral_classifier_early(spark, folder):
    extra = ["early_comment_count", "early_comment_avg_score", "early_comment_score_std"]
    # The label takes passes over the texts, which needn't meet the comments for it.
    labelled = _with_early(spark, folder, _viral_texts(_featured(spark, folder)))
    _, scored = models.viral_classifier(labelled, extra=extra, communities=b.SOURCES)
    return models.binary_report(scored, "is_viral")


@query("suspicious_classifier")
def suspicious_classifier(spark, folder):
    """Importances of the profile measures, with the area under the ROC curve on the test rows."""
    labelled = profiles.label_suspicious(_profiles(spark, folder), **LIMITS)
    model, scored = models.suspicious_classifier(labelled)
    auc = models.binary_report(scored, "is_suspicious").select("auc_roc").scalar()
    table = imp.feature_importance(spark, model, profiles.PROFILE_FEATURES, {})
    return table.select("feature", "importance", "rank").withColumn("auc_roc", auc)


@query("suspicious_metrics")
def suspicious_metrics(spark, folder):
    """Accuracy, weighted scores and the areas under both curves of the account model on its test rows."""
    labelled = profiles.label_suspicious(_profiles(spark, folder), **LIMITS)
    return models.binary_report(models.suspicious_classifier(labelled)[1], "is_suspicious")


@query("suspicious_confusion")
def suspicious_confusion(spark, folder):
    labelled = profiles.label_suspicious(_profiles(spark, folder), **LIMITS)
    _, scored = models.suspicious_classifier(labelled)
    return ev.confusion_matrix(scored, "is_suspicious", "prediction", [0, 1])


@query("sentiment_classifier")
def sentiment_classifier(spark, folder):
    texts = hygiene.normalized_texts(b.texts(spark, folder), "body")
    labelled = texts.withColumn("sentiment", br.list_sentiment(F.lower("body"), b.POSITIVE, b.NEGATIVE))
    _, scored = models.sentiment_classifier(labelled)
    return ev.class_report(scored, "sentiment", "predicted_sentiment")


@query("sentiment_weak_labels", b.with_ctes(b.TEXTS) + f"""
SELECT id, {_list_sentiment('lower(body)')} AS sentiment FROM texts WHERE length({normalized('body')}) >= 20""")
def sentiment_weak_labels(spark, folder):
    texts = hygiene.normalized_texts(b.texts(spark, folder), "body")
    return texts.select("id", br.list_sentiment(F.lower("body"), b.POSITIVE, b.NEGATIVE).alias("sentiment"))


def _importance(spark, posts, extra=(), named=False):
    model, scored = models.engagement_regression(posts, extra=extra, communities=b.SOURCES)
    texts = models.regression_rows(posts)[0].select("text") if named else None
    return imp.feature_importance(spark, model, imp.feature_names(scored), texts=texts)


@query("feature_importance")
def feature_importance(spark, folder):
    """All slots by importance, the leading text slots with the terms that they stand for."""
    return _importance(spark, _featured(spark, folder), named=True)


@query("importance_comparison")
def importance_comparison(spark, folder):
    content = imp.group_totals(_importance(spark, _featured(spark, folder)))
    with_early = imp.group_totals(_importance(spark, _featured_early(spark, folder), models.EARLY_NUMBERS))
    return imp.compare_groups(content, with_early)
