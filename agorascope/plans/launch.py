"""Before and after an event."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.valence import add_valence, category
from ..operators import hygiene, launch, topics
from . import bindings as b
from .registry import query
from .sqltext import in_list, quoted, utc
from .textmine import valence_ctes

CORPUS = f"""united AS (
  SELECT 'd' || id AS key, community, body AS text, score, created_utc, 'comment' AS type FROM texts
  UNION ALL SELECT 't' || id, community, body, score, created_utc, 'comment' FROM thread_comments
  UNION ALL
  SELECT 'c' || id, community, CASE WHEN length(selftext) > 0 THEN concat_ws(' ', title, selftext) ELSE title END,
         score, created_utc, 'submission' FROM thread_posts),
dated AS (SELECT *, CAST({utc('created_utc')} AS DATE) AS date FROM united),
corpus AS (SELECT *, strftime(date, '%Y-%m') AS year_month,
    CASE WHEN date < DATE '{b.LAUNCH_DAY}' THEN 'Pre-Launch' ELSE 'Post-Launch' END AS period
  FROM dated WHERE date BETWEEN DATE '{b.FIRST_DAY}' AND DATE '{b.LAST_DAY}'
    AND regexp_matches(text, '{b.PRODUCT}') AND length(text) >= 20)"""
BASE = b.with_ctes(b.TEXTS, b.THREADS, CORPUS)


def _corpus(spark, folder):
    threads = b.keyed(b.thread_posts(spark, folder), "c")
    united = hygiene.unify(b.all_comments(spark, folder), threads, "type", "title", ["key", "community", "score", "created_utc"])
    return launch.corpus(united, b.PRODUCT, b.FIRST_DAY, b.LAST_DAY, b.LAUNCH_DAY)


def _scored(spark, folder):
    scored = add_valence(_corpus(spark, folder), "text", b.VALENCE)
    return scored.withColumn("sentiment_category", category(F.col("sentiment_score")))


@query("launch_corpus", BASE + "SELECT key, type, period, year_month, strftime(date, '%Y-%m-%d') AS date, text FROM corpus")
def launch_corpus(spark, folder):
    return b.rounded(_corpus(spark, folder).select("key", "type", "period", "year_month", "date", "text"))


@query("volume_by_period", BASE + "SELECT period, count(*) AS total_posts, round(avg(score), 6) AS avg_score FROM corpus GROUP BY 1")
def volume_by_period(spark, folder):
    return b.rounded(launch.volume_by_period(_corpus(spark, folder)))


@query("volume_daily", BASE + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS post_count, round(avg(score), 6) AS avg_score FROM corpus GROUP BY corpus.date""")
def volume_daily(spark, folder):
    return b.rounded(launch.volume_daily(_corpus(spark, folder)))


@query("volume_weekly", BASE + """
SELECT strftime(date_trunc('week', date), '%Y-%m-%d') AS week, count(*) AS post_count, round(avg(score), 6) AS avg_score
FROM corpus GROUP BY 1""")
def volume_weekly(spark, folder):
    return b.rounded(launch.volume_weekly(_corpus(spark, folder)))


@query("volume_monthly_by_type", BASE + "SELECT year_month, period, type, count(*) AS count FROM corpus GROUP BY 1, 2, 3")
def volume_monthly_by_type(spark, folder):
    return launch.volume_monthly_by_type(_corpus(spark, folder))


SENTIMENT = b.with_ctes(b.TEXTS, b.THREADS, CORPUS, valence_ctes("corpus", "key", "text")) + """,
felt AS (SELECT c.*, s.compound, CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative'
           ELSE 'Neutral' END AS sentiment_category FROM corpus c JOIN scored s ON s.k = c.key)"""


@query("sentiment_by_period", SENTIMENT + """
SELECT period, round(avg(compound), 6) AS avg_sentiment, count(*) AS total_posts FROM felt GROUP BY 1""")
def sentiment_by_period(spark, folder):
    return b.rounded(launch.sentiment_by(_scored(spark, folder), ["period"], "total_posts"))


@query("sentiment_dist_by_period", SENTIMENT + """
SELECT period, sentiment_category, count(*) AS count,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY period), 6) AS pct FROM felt GROUP BY 1, 2""")
def sentiment_dist_by_period(spark, folder):
    return b.rounded(launch.sentiment_distribution(_scored(spark, folder)))


@query("sentiment_monthly", SENTIMENT + """
SELECT year_month, period, round(avg(compound), 6) AS avg_sentiment, count(*) AS count FROM felt GROUP BY 1, 2""")
def sentiment_monthly(spark, folder):
    return b.rounded(launch.sentiment_by(_scored(spark, folder), ["year_month", "period"], "count").orderBy("year_month"))


UNIQUE = tx.unique_keywords(b.KEYWORDS)


def _flag_sql(keyword: str) -> str:
    return rf"CAST(regexp_matches(lower(text), '\b{keyword.replace('-', ' ').replace(' ', '[-\\s]?')}\b') AS INTEGER)"


FLAGGED = "flagged AS (SELECT *, " + ", ".join(f"{_flag_sql(k)} AS {tx.keyword_column(k)}" for k in UNIQUE) + " FROM corpus)"
RATES = "rates AS (" + " UNION ALL ".join(
    f"SELECT period, count(*) AS total_posts, {quoted(k)} AS keyword, CAST(sum({tx.keyword_column(k)}) AS BIGINT) AS mentions, "
    f"100.0 * sum({tx.keyword_column(k)}) / count(*) AS mention_rate FROM flagged GROUP BY 1" for k in UNIQUE
) + ")"
CHANGE = """change AS (SELECT keyword, pre_rate, post_rate, 100.0 * (post_rate - pre_rate) / nullif(pre_rate, 0) AS change_pct FROM (
  SELECT keyword, max(mention_rate) FILTER (period = 'Pre-Launch') AS pre_rate,
         max(mention_rate) FILTER (period = 'Post-Launch') AS post_rate FROM rates GROUP BY 1))"""
KEYWORD_BASE = b.with_ctes(b.TEXTS, b.THREADS, CORPUS, FLAGGED, RATES, CHANGE)


def _rates(spark, folder):
    return launch.keyword_rates(launch.keyword_flags(_corpus(spark, folder), b.KEYWORDS), b.KEYWORDS)


@query("keyword_flags", KEYWORD_BASE + f"SELECT key, period, {', '.join(tx.keyword_column(k) for k in UNIQUE)} FROM flagged")
def keyword_flags(spark, folder):
    flagged = launch.keyword_flags(_corpus(spark, folder), b.KEYWORDS)
    return flagged.select("key", "period", *[tx.keyword_column(k) for k in UNIQUE])


@query("keyword_rates", KEYWORD_BASE + """
SELECT keyword, period, mentions, total_posts, round(mention_rate, 6) AS mention_rate FROM rates""")
def keyword_rates(spark, folder):
    return b.rounded(_rates(spark, folder))


@query("keyword_change", KEYWORD_BASE + """
SELECT keyword, round(pre_rate, 6) AS pre_rate, round(post_rate, 6) AS post_rate, round(change_pct, 6) AS change_pct FROM change""")
def keyword_change(spark, folder):
    return b.rounded(launch.keyword_change(_rates(spark, folder)))


@query("launch_summary", b.with_ctes(b.TEXTS, b.THREADS, CORPUS, FLAGGED, RATES, CHANGE, valence_ctes("corpus", "key", "text")) + """,
felt AS (SELECT c.period, s.compound FROM corpus c JOIN scored s ON s.k = c.key),
front AS (SELECT 'keyword: ' || keyword AS metric, change_pct AS value FROM change WHERE change_pct IS NOT NULL
            ORDER BY change_pct DESC, keyword LIMIT 3)
SELECT 'volume_change_pct' AS metric, round(100.0 * (count(*) FILTER (period = 'Post-Launch') - count(*) FILTER (period = 'Pre-Launch'))
       / nullif(count(*) FILTER (period = 'Pre-Launch'), 0), 6) AS value FROM corpus
UNION ALL SELECT 'sentiment_change', round(avg(compound) FILTER (period = 'Post-Launch') - avg(compound) FILTER (period = 'Pre-Launch'), 6) FROM felt
UNION ALL SELECT metric, round(value, 6) FROM front""")
def launch_summary(spark, folder):
    sentiment = launch.sentiment_by(_scored(spark, folder), ["period"], "total_posts")
    return b.rounded(launch.summary(sentiment, launch.keyword_change(_rates(spark, folder))))


@query("topics_by_period")
def topics_by_period(spark, folder):
    return topics.topics_by_period(_corpus(spark, folder), [launch.PRE, launch.POST])


@query("topic_fit")
def topic_fit(spark, folder):
    """How well each period's topics fit a tenth of its texts that they were not learned from."""
    return topics.topic_fit(spark, topics.fit_topics(_corpus(spark, folder), [launch.PRE, launch.POST], train=0.9))


@query("paired_topics")
def paired_topics(spark, folder):
    """Topics before and after the event, the closest pairs first."""
    before, after = topics.fit_topics(_corpus(spark, folder), [launch.PRE, launch.POST])
    return topics.paired_topics(spark, before, after)


@query("period_vocabulary", BASE + f""",
said AS (SELECT key, period, unnest(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]')) AS term FROM corpus),
counted AS (SELECT period, term, count(*) AS occurrences, count(DISTINCT key) AS documents FROM said
  WHERE term <> '' AND term NOT IN {in_list(topics.FORUM_STOP_WORDS)} GROUP BY 1, 2),
sizes AS (SELECT period, count(*) AS period_documents FROM corpus GROUP BY 1)
SELECT period, term, occurrences, documents, period_documents FROM counted JOIN sizes USING (period) WHERE documents >= 5
QUALIFY row_number() OVER (PARTITION BY period ORDER BY occurrences DESC, term) <= 1000""")
def period_vocabulary(spark, folder):
    """The words that each period's topics are made of."""
    return topics.period_vocabulary(_corpus(spark, folder), stop_words=topics.FORUM_STOP_WORDS)
