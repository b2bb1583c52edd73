"""The given tables under the canonical column names, in Spark and in SQL.

Each binding has a DataFrame function and the same definition as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.valence import ValenceLexicon
from ..sources.tables import read_table

DAY0 = 1685577600  # 2023-06-01 UTC


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, days and timestamps as text, for comparison across engines."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            # Adding 0.0 turns -0.0 into 0.0.
            c = F.round(c, digits) + F.lit(0.0)
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(name))
    return df.select(*out)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# --- activity: one row per event -----------------------------------------------------------

ACTIVITY = """activity AS (
  SELECT event_id AS id, user_id AS author, event_type AS community, value AS score, ts AS created
  FROM events)"""


def activity(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("author"), F.col("event_type").alias("community"),
        F.col("value").alias("score"), F.col("ts").alias("created"),
    )


# --- posts and comments: orders and their lines --------------------------------------------

POSTS = """posts AS (
  SELECT o_orderkey AS id, 't3_' || o_orderkey AS link_id, o_custkey AS author, o_orderpriority AS community,
         CAST(floor(o_totalprice / 1000) AS BIGINT) AS score, CAST(epoch(o_orderdate) AS BIGINT) AS created_utc,
         CAST(o_orderdate AS DATE) AS date
  FROM orders)"""

COMMENTS = """comments AS (
  SELECT 't3_' || l_orderkey AS link_id, l_suppkey AS author,
         CASE l_suppkey % 6 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
              ELSE 'lot-' || (l_suppkey % 6) END AS community,
         CAST(floor(l_quantity) AS BIGINT) AS score, CAST(epoch(l_shipdate) AS BIGINT) AS created_utc,
         CAST(l_shipdate AS DATE) AS date, l_linenumber AS length
  FROM lineitem)"""


def _epoch(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def link(key: str) -> Column:
    return F.concat(F.lit("t3_"), F.col(key).cast("string"))


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), link("o_orderkey").alias("link_id"), F.col("o_custkey").alias("author"),
        F.col("o_orderpriority").alias("community"), F.floor(F.col("o_totalprice") / 1000).alias("score"),
        _epoch("o_orderdate").alias("created_utc"), F.to_date("o_orderdate").alias("date"),
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    lot = F.col("l_suppkey") % 6
    named = (
        F.when(lot == 0, "1-URGENT").when(lot == 1, "2-HIGH").when(lot == 2, "3-MEDIUM")
        .otherwise(F.concat(F.lit("lot-"), lot.cast("string")))
    )
    return table(spark, folder, "lineitem").select(
        link("l_orderkey").alias("link_id"), F.col("l_suppkey").alias("author"), named.alias("community"),
        F.floor("l_quantity").alias("score"), _epoch("l_shipdate").alias("created_utc"),
        F.to_date("l_shipdate").alias("date"), F.col("l_linenumber").alias("length"),
    )


# --- posts with the number of their comments -----------------------------------------------

COUNTED_POSTS = """counted AS (
  SELECT p.*, coalesce(c.n, 0) AS num_comments
  FROM posts p LEFT JOIN (SELECT link_id, count(*) AS n FROM comments GROUP BY 1) c USING (link_id))"""


def counted_posts(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.depth import post_comment_counts

    counted = post_comment_counts(posts(spark, folder), comments(spark, folder))
    return counted.withColumnRenamed("actual_comment_count", "num_comments")


# --- texts: documents ------------------------------------------------------------------------

TEXTS = f"""texts AS (
  SELECT doc_id AS id, source AS community,
         CASE WHEN lang = 'de' THEN 'AutoModerator' ELSE 'user_' || source END AS author,
         text AS body, split_part(text, chr(10), 1) AS title,
         CASE WHEN contains(text, chr(10)) THEN substr(text, length(split_part(text, chr(10), 1)) + 2) END AS selftext,
         {DAY0} + (doc_id % 427) * 86400 + (doc_id * 7919) % 86400 AS created_utc,
         n_chars % 211 - 10 AS score, lang = 'de' AS over_18
  FROM documents)"""


def _first_line(text: str) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1))


def _after_first_line(text: str) -> Column:
    start = F.instr(text, "\n")
    return F.when(start > 0, F.substr(F.col(text), start + 1))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, folder, "documents").select(
        doc.alias("id"), F.col("source").alias("community"),
        F.when(F.col("lang") == "de", "AutoModerator").otherwise(F.concat(F.lit("user_"), "source")).alias("author"),
        F.col("text").alias("body"), _first_line("text").alias("title"), _after_first_line("text").alias("selftext"),
        (DAY0 + (doc % 427) * 86400 + (doc * 7919) % 86400).alias("created_utc"),
        (F.col("n_chars") % 211 - 10).alias("score"), (F.col("lang") == "de").alias("over_18"),
    )


# --- comments of texts: the lines of the order with the text's number ---------------------------

TEXT_COMMENTS = f"""text_comments AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, 't3_' || l_orderkey AS link_id,
         {DAY0} + (l_orderkey % 427) * 86400 + (l_orderkey * 7919) % 86400 + (l_orderkey * 31 + l_linenumber * 1973) % 18000 - 3600 AS created_utc,
         CAST(floor(l_quantity) AS BIGINT) AS score, l_linenumber AS length
  FROM lineitem)"""


def text_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Made from an hour before the text of the same number to four hours after it."""
    post, line = F.col("l_orderkey"), F.col("l_linenumber")
    posted = DAY0 + (post % 427) * 86400 + (post * 7919) % 86400
    return table(spark, folder, "lineitem").select(
        (post * 10 + line).alias("id"), link("l_orderkey").alias("link_id"),
        (posted + (post * 31 + line * 1973) % 18000 - 3600).alias("created_utc"),
        F.floor("l_quantity").alias("score"), line.alias("length"),
    )


# --- threads: the first turn of a conversation is a post, later turns are comments ----------

THREAD_POSTS = f"""thread_posts AS (
  SELECT conv_id AS id, role AS community, split_part(text, chr(10), 1) AS title,
         CASE WHEN contains(text, chr(10)) THEN substr(text, length(split_part(text, chr(10), 1)) + 2) END AS selftext,
         {DAY0} + (conv_id % 427) * 86400 AS created_utc, length(text) % 211 - 10 AS score
  FROM conversations WHERE turn = 0)"""


def thread_posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").where(F.col("turn") == 0).select(
        F.col("conv_id").alias("id"), F.col("role").alias("community"), _first_line("text").alias("title"),
        _after_first_line("text").alias("selftext"), (DAY0 + (F.col("conv_id") % 427) * 86400).alias("created_utc"),
        (F.length("text") % 211 - 10).cast("long").alias("score"),
    )


THREAD_COMMENTS = f"""thread_comments AS (
  SELECT 't3_' || conv_id AS link_id, conv_id * 1000 + turn AS id, role AS community, text AS body,
         {DAY0} + (conv_id % 427) * 86400 + turn * 600 AS created_utc, length(text) % 211 - 10 AS score
  FROM conversations WHERE turn > 0)"""


def thread_comments(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("turn")
    return table(spark, folder, "conversations").where(turn > 0).select(
        link("conv_id").alias("link_id"), (F.col("conv_id") * 1000 + turn).alias("id"), F.col("role").alias("community"),
        F.col("text").alias("body"), (DAY0 + (F.col("conv_id") % 427) * 86400 + turn * 600).alias("created_utc"),
        (F.length("text") % 211 - 10).cast("long").alias("score"),
    )


THREADS = f"{THREAD_POSTS}, {THREAD_COMMENTS}"


def keyed(df: DataFrame, prefix: str) -> DataFrame:
    """A ``key`` that stays unique when tables are united."""
    return df.withColumn("key", F.concat(F.lit(prefix), F.col("id").cast("string")))


def all_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and the later turns of threads."""
    columns = ["key", "id", "community", "body", "score", "created_utc"]
    return keyed(texts(spark, folder), "d").select(columns).unionByName(keyed(thread_comments(spark, folder), "t").select(columns))


# --- text posts with comments ------------------------------------------------------------------

DEPTH = """depth AS (
  SELECT t.id, t.community, t.score, CAST(length(t.title) AS INTEGER) AS title_length,
         CAST(hour(to_timestamp(t.created_utc) AT TIME ZONE 'UTC') AS INTEGER) AS hour_posted,
         CAST(dayofweek(to_timestamp(t.created_utc) AT TIME ZONE 'UTC') + 1 AS INTEGER) AS day_of_week,
         CAST(month(to_timestamp(t.created_utc) AT TIME ZONE 'UTC') AS INTEGER) AS month,
         CAST(year(to_timestamp(t.created_utc) AT TIME ZONE 'UTC') AS INTEGER) AS year,
         CASE WHEN length(t.selftext) > 0 THEN 1 ELSE 0 END AS has_selftext,
         CASE WHEN t.over_18 THEN 1 ELSE 0 END AS is_nsfw, 't3_' || t.id AS link_id,
         coalesce(c.n, 0) AS actual_comment_count
  FROM texts t LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON c.l_orderkey = t.id)"""


def depth_posts(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators import depth

    features = depth.post_features(texts(spark, folder))
    return depth.post_comment_counts(features, comments(spark, folder))


# --- vocabulary that occurs in the given texts ------------------------------------------------

SOURCES = [f"src{i}" for i in range(20)]
FEATURES = {
    "connect": ["and", "with"],
    "suffix": ["tion"],
    "legal": ["license", "copyright"],
    "praise": ["best", "great"],
    "hate": ["hate"],
    "article": ["the", "der", "la"],
}
BRANDS = {"Alpha": ["the"], "Beta": ["of"], "Gamma": ["der", "und"], "Delta": ["que", "la"]}
CONTEXT = ["and", "tion", "est"]
POSITIVE = ["best", "great", "free", "with", "for"]
NEGATIVE = ["hate", "license", "der", "que", "was"]
STAGES = [
    ("troubleshooting", ["license", "hate"]),
    ("research", ["which", "que"]),
    ("post-purchase", ["for", "der"]),
    ("long-term use", ["tion"]),
]
EMOTION_WORDS = {
    "best": ["joy", "positive"],
    "with": ["joy", "positive", "trust"],
    "was": ["anger", "negative"],
    "license": ["fear", "negative"],
    "der": ["trust"],
    "que": ["sadness", "negative"],
    "for": ["anticipation"],
    "at": ["disgust", "negative"],
    "on": ["surprise"],
}
VALENCE = ValenceLexicon(
    words={
        "best": 3.2, "great": 3.1, "with": 0.9, "for": 0.6, "is": 0.4, "le": 0.5, "el": 0.7,
        "hate": -2.7, "license": -0.8, "was": -0.9, "der": -0.6, "que": -0.5, "at": -0.7, "worthless": -1.9,
        "of the": 0.8, "is that of": -1.3, "für": 0.6, ":)": 2.0, "<3": 1.9,
    },
    boosters={"the": 0.293, "of": -0.293, "la": 0.293, "in the": -0.293, "für die": 0.293},
    negators=frozenset(["and", "un", "und", "to the"]),
    contrast="as",
)
PRODUCT = "(?i)(the|la|der)"
LAUNCH_DAY, FIRST_DAY, LAST_DAY = "2024-01-01", "2023-06-01", "2024-07-31"
KEYWORDS = ["of the", "of-the", "and the", "license", "tion", "nothing here"]
CONCERNS = ["license", "hate", "tion", "der"]
WANTED = ["with", "best", "of the", "ent"]
