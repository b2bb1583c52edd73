"""Features, brands, emotions and sentiment in texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.valence import add_valence, category
from ..operators import brands as br, emotions as em, mentions as me
from ..presets import EMOTIONS, NEGATIVE_EMOTIONS
from ..sources import lexicon as lex
from . import bindings as b
from .registry import query
from .sqltext import (
    has_any, has_word, hits, in_list, long_flags, normalized, quoted, utc, values_table, word_hits,
)

LOWERED = "lowered AS (SELECT *, lower(body) AS body_lower FROM texts)"
TAGGED = f"tagged AS ({long_flags('lowered', 'id, body, created_utc', 'body_lower', b.FEATURES, 'feature')})"
MENTIONED = "mentioned AS (SELECT feature, count(*) AS mentions FROM tagged GROUP BY 1)"
BASE = b.with_ctes(b.TEXTS, LOWERED, TAGGED, MENTIONED)


def _lowered(spark, folder):
    return b.texts(spark, folder).withColumn("body_lower", F.lower("body"))


def _emotion_lexicon(spark):
    return lex.from_dict(spark, b.EMOTION_WORDS)


# --- valence in SQL: tokens unnested, context by window functions -----------------------------

def _capitals(raw: str) -> str:
    return f"(upper({raw}) = {raw} AND lower({raw}) <> {raw} AND length({raw}) > 1)"


def _loud(distance: str) -> str:
    """What capitals of the word so far before add to it as a booster."""
    return f"CASE WHEN d.caps > 0 AND d.caps < d.n AND {_capitals(f'c.r{distance}')} THEN 0.733 ELSE 0 END"


def _tokens(text: str) -> str:
    """Words, and emoticons between white space; then phrases as one of them, the longest first."""
    v = b.VALENCE
    chunks = f"string_split_regex({text}, '[ \\t\\n\\x0B\\f\\r]+')"
    letters = r"regexp_extract_all(c, '[\pL\pM'']+')"
    faces = f"CASE WHEN lower(c) IN {in_list(v.emoticons())} THEN [c] ELSE {letters} END" if v.emoticons() else letters
    tokens = f"flatten(list_transform({chunks}, lambda c: {faces}))"
    if not v.phrases():
        return tokens
    longest_first = "|".join(sorted((p.replace("'", "''") for p in v.phrases()), key=lambda p: -len(p.split())))
    joined = f"array_to_string({tokens}, ' ')"
    return f"list_transform(regexp_extract_all({joined}, '(?i:{longest_first})(?: |$)|[^ ]+(?: |$)'), lambda t: rtrim(t))"


def valence_ctes(source: str, key: str, text: str) -> str:
    """CTEs ending in ``scored(key, compound)`` for the rows of a relation."""
    v = b.VALENCE
    return f"""
{values_table('valence', 'w, v', sorted(v.words.items()))},
{values_table('booster', 'w, b', sorted(v.boosters.items()))},
raws AS (SELECT {key} AS k, {text} AS txt, {_tokens(text)} AS raws FROM {source}),
tok AS (SELECT k, unnest(raws) AS raw, unnest(range(1, len(raws) + 1)) AS pos FROM raws),
word AS (SELECT *, lower(raw) AS w FROM tok),
ctx AS (SELECT *, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2, lag(w, 3) OVER o AS w3,
               lag(raw, 1) OVER o AS r1, lag(raw, 2) OVER o AS r2, lag(raw, 3) OVER o AS r3
        FROM word WINDOW o AS (PARTITION BY k ORDER BY pos)),
doc AS (SELECT k, count(*) AS n, count(*) FILTER ({_capitals('raw')}) AS caps,
               coalesce(min(pos) FILTER (w = {quoted(v.contrast)}), 0) AS but_at FROM word GROUP BY k),
hit AS (SELECT c.k, c.pos,
   (v.v + CASE WHEN d.caps > 0 AND d.caps < d.n AND {_capitals('c.raw')} THEN sign(v.v) * 0.733 ELSE 0 END
        + coalesce(b1.b + {_loud('1')}, 0) * sign(v.v) + coalesce(b2.b + {_loud('2')}, 0) * sign(v.v) * 0.95
        + coalesce(b3.b + {_loud('3')}, 0) * sign(v.v) * 0.9)
   * CASE WHEN c.w1 IN {in_list(sorted(v.negators))} THEN -0.74 ELSE 1 END
   * CASE WHEN c.w2 = 'never' AND c.w1 IN ('so', 'this') THEN 1.25 WHEN c.w2 = 'without' AND c.w1 = 'doubt' THEN 1
          WHEN c.w2 IN {in_list(sorted(v.negators))} THEN -0.74 ELSE 1 END
   * CASE WHEN c.w3 = 'never' AND (c.w2 IN ('so', 'this') OR c.w1 IN ('so', 'this')) THEN 1.25
          WHEN c.w3 = 'without' AND (c.w2 = 'doubt' OR c.w1 = 'doubt') THEN 1 WHEN c.w3 IN {in_list(sorted(v.negators))} THEN -0.74 ELSE 1 END
   * CASE WHEN c.w1 = 'least' AND coalesce(c.w2, '') NOT IN ('at', 'very') THEN -0.74 ELSE 1 END
   * CASE WHEN d.but_at = 0 THEN 1.0 WHEN c.pos < d.but_at THEN 0.5 WHEN c.pos > d.but_at THEN 1.5 ELSE 1.0 END AS s
   FROM ctx c JOIN valence v ON v.w = c.w JOIN doc d ON d.k = c.k
   LEFT JOIN booster b1 ON b1.w = c.w1 LEFT JOIN booster b2 ON b2.w = c.w2 LEFT JOIN booster b3 ON b3.w = c.w3),
summed AS (SELECT k, sum(s ORDER BY pos) AS s FROM hit GROUP BY k),
stressed AS (SELECT r.k, coalesce(s.s, 0) + sign(coalesce(s.s, 0)) * (
     least(length(txt) - length(replace(txt, '!', '')), 4) * 0.292
     + CASE WHEN length(txt) - length(replace(txt, '?', '')) <= 1 THEN 0
            WHEN length(txt) - length(replace(txt, '?', '')) <= 3 THEN (length(txt) - length(replace(txt, '?', ''))) * 0.18
            ELSE 0.96 END) AS t
   FROM raws r LEFT JOIN summed s ON s.k = r.k),
scored AS (SELECT k, round(t / sqrt(t * t + 15.0), 4) + 0.0 AS compound FROM stressed)"""


@query("valence_score", b.with_ctes(b.TEXTS, valence_ctes("texts", "id", "body")) + """
SELECT k AS id, compound AS sentiment_score,
       CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative' ELSE 'Neutral' END AS sentiment_category
FROM scored""")
def valence_score(spark, folder):
    scored = add_valence(b.texts(spark, folder), "body", b.VALENCE)
    return b.rounded(scored.select("id", "sentiment_score", category(F.col("sentiment_score")).alias("sentiment_category")))


# --- features -----------------------------------------------------------------------------------

@query("feature_mentions", BASE + "SELECT feature, mentions FROM mentioned")
def feature_mentions(spark, folder):
    return me.feature_mentions(_lowered(spark, folder), "body_lower", b.FEATURES)


SENTIMENT = b.with_ctes(b.TEXTS, LOWERED, TAGGED, MENTIONED, valence_ctes("texts", "id", "body")) + """,
said AS (SELECT feature, compound FROM tagged JOIN scored ON k = id),
sentiment AS (
  SELECT feature, count(*) AS total_mentions, count(*) FILTER (compound >= 0.05) AS positive,
         count(*) FILTER (compound <= -0.05) AS negative, count(*) FILTER (compound > -0.05 AND compound < 0.05) AS neutral,
         avg(compound) AS avg_sentiment FROM said GROUP BY 1),
pain AS (SELECT feature, count(*) AS negative_mentions FROM said WHERE compound <= -0.1 GROUP BY 1)"""


def _scored_features(spark, folder):
    return me.scored_features(b.texts(spark, folder), "body", b.FEATURES, b.VALENCE)


@query("feature_sentiment", SENTIMENT + """
SELECT feature, total_mentions, positive, negative, neutral, round(avg_sentiment, 6) AS avg_sentiment,
       round(100.0 * positive / total_mentions, 6) AS positive_pct, round(100.0 * negative / total_mentions, 6) AS negative_pct,
       round(100.0 * neutral / total_mentions, 6) AS neutral_pct FROM sentiment""")
def feature_sentiment(spark, folder):
    return b.rounded(me.feature_sentiment(_scored_features(spark, folder)))


@query("feature_pain_points", SENTIMENT + """
SELECT feature, negative_mentions, negative_mentions AS estimated_negative_mentions FROM pain""")
def feature_pain_points(spark, folder):
    return me.feature_pain_points(_scored_features(spark, folder))


# --- brands and features ------------------------------------------------------------------------

BRANDED = f"""context AS (SELECT * FROM lowered WHERE {has_any('body_lower', b.CONTEXT)}),
branded AS ({' UNION ALL '.join(
    f"SELECT id, body_lower, {quoted(name)} AS brand FROM context WHERE {has_word('body_lower', terms)}"
    for name, terms in b.BRANDS.items())}),
brand_texts AS (SELECT brand, count(*) AS matching_texts FROM branded GROUP BY 1 HAVING count(*) >= 10),
brand_feature AS ({long_flags('branded', 'id, brand', 'body_lower', b.FEATURES, 'feature')}),
matrix AS (SELECT brand, feature, count(*) AS mentions, matching_texts
           FROM brand_feature JOIN brand_texts USING (brand) GROUP BY brand, feature, matching_texts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY mentions DESC, feature) AS place FROM matrix),
summary AS (SELECT brand, CAST(sum(mentions) AS BIGINT) AS total_mentions, max(matching_texts) AS matching_texts,
  string_agg(feature || ' (' || mentions || ')', ', ' ORDER BY place) FILTER (place <= 3) AS top_features FROM ranked GROUP BY 1)"""
BRAND_BASE = b.with_ctes(b.TEXTS, LOWERED, BRANDED)


def _matrix(spark, folder):
    return me.brand_feature_counts(_lowered(spark, folder), "body_lower", b.BRANDS, b.CONTEXT, b.FEATURES)


@query("brand_feature_matrix", BRAND_BASE + "SELECT brand, feature, mentions, matching_texts FROM matrix")
def brand_feature_matrix(spark, folder):
    return _matrix(spark, folder)


@query("brand_mentions", BRAND_BASE + "SELECT brand, total_mentions, matching_texts, top_features FROM summary")
def brand_mentions(spark, folder):
    return me.brand_summary(_matrix(spark, folder))


@query("feature_report", SENTIMENT + ", " + BRANDED + """,
listed AS (
  SELECT 'most_discussed' AS section, feature AS item, CAST(mentions AS DOUBLE) AS value, -mentions AS key, 10 AS k FROM mentioned
  UNION ALL SELECT 'lowest_sentiment', feature, avg_sentiment, avg_sentiment, 5 FROM sentiment
  UNION ALL SELECT 'pain_points', feature, negative_mentions, -negative_mentions, 10 FROM pain
  UNION ALL SELECT 'brands', brand, total_mentions, -total_mentions, 1000000 FROM summary),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY section ORDER BY key, item) AS INTEGER) AS rank FROM listed)
SELECT section, rank, item, round(value, 6) AS value FROM placed WHERE rank <= k""")
def feature_report(spark, folder):
    opinions = me.feature_opinions(_scored_features(spark, folder))
    return b.rounded(me.feature_report(opinions, me.brand_summary(_matrix(spark, folder))))


# --- emotions -----------------------------------------------------------------------------------

LEXICON = values_table("lex", "word, emotion", [(w, e) for w, es in b.EMOTION_WORDS.items() for e in es])
TOKENS = "toks AS (SELECT id, unnest(regexp_extract_all(lower(body), '[a-z'']+')) AS word FROM texts)"
TEXT_HITS = "text_hits AS (SELECT id, emotion, count(*) AS hits FROM toks JOIN lex USING (word) GROUP BY 1, 2)"
MONTH = f"CAST(year({utc('created_utc')}) * 100 + month({utc('created_utc')}) AS INTEGER)"
FEATURE_HITS = f"""feature_hits AS (
  SELECT feature, {MONTH} AS yyyymm, emotion, CAST(sum(hits) AS BIGINT) AS hits
  FROM tagged JOIN text_hits USING (id) GROUP BY 1, 2, 3)"""
EMOTION_BASE = b.with_ctes(b.TEXTS, LOWERED, TAGGED, MENTIONED, LEXICON, TOKENS, TEXT_HITS, FEATURE_HITS)


def _emotion_columns() -> str:
    counts = [f"CAST(coalesce(sum(hits) FILTER (emotion = '{e}'), 0) AS BIGINT) AS {e}" for e in EMOTIONS]
    shares = [
        f"round(coalesce(100.0 * coalesce(sum(hits) FILTER (emotion = '{e}'), 0) / nullif(sum(hits), 0), 0), 6) AS {e}_pct"
        for e in EMOTIONS
    ]
    return ", ".join(["CAST(coalesce(sum(hits), 0) AS BIGINT) AS total_emotion_hits", *counts, *shares])


EMOTION_TABLE = f"""emotion_table AS (
  SELECT m.feature, m.mentions AS total_comments, {_emotion_columns()}
  FROM mentioned m LEFT JOIN feature_hits h ON h.feature = m.feature GROUP BY m.feature, m.mentions)"""


def _hits(spark, folder, keys=()):
    monthly = b.texts(spark, folder).withColumn("yyyymm", _month())
    return em.feature_emotion_hits(monthly, "body", b.FEATURES, _emotion_lexicon(spark), keys)


def _month():
    from ..functions.time import epoch_timestamp, month_number

    return month_number(epoch_timestamp(F.col("created_utc")))


def _emotion_table(spark, folder):
    counts = me.feature_mentions(_lowered(spark, folder), "body_lower", b.FEATURES)
    return em.feature_emotions(counts, _hits(spark, folder))


@query("lexicon_token_join", b.with_ctes(b.TEXTS, LEXICON, TOKENS, TEXT_HITS) + "SELECT id, emotion, hits FROM text_hits")
def lexicon_token_join(spark, folder):
    return em.lexicon_hits(b.texts(spark, folder), "id", "body", _emotion_lexicon(spark))


@query("feature_emotions", EMOTION_BASE + ", " + EMOTION_TABLE + " SELECT * FROM emotion_table")
def feature_emotions(spark, folder):
    return b.rounded(_emotion_table(spark, folder))


@query("feature_emotions_monthly", EMOTION_BASE + f"SELECT feature, yyyymm, {_emotion_columns()} FROM feature_hits GROUP BY 1, 2")
def feature_emotions_monthly(spark, folder):
    return b.rounded(em.pivot_emotions(_hits(spark, folder, ["yyyymm"]), ["feature", "yyyymm"]))


@query("feature_pain_emotions", EMOTION_BASE + f"""
SELECT feature, CAST(sum(hits) AS BIGINT) AS estimated_negative_mentions FROM feature_hits
WHERE emotion IN {in_list(NEGATIVE_EMOTIONS)} GROUP BY 1""")
def feature_pain_emotions(spark, folder):
    return em.pain_emotions(_hits(spark, folder))


@query("negative_lean_ranking", EMOTION_BASE + ", " + EMOTION_TABLE + f"""
SELECT feature, {' + '.join(NEGATIVE_EMOTIONS)} AS negative_hits, {', '.join(e + '_pct' for e in NEGATIVE_EMOTIONS)}
FROM emotion_table ORDER BY negative_hits DESC, feature LIMIT 5""")
def negative_lean_ranking(spark, folder):
    return b.rounded(em.negative_lean(_emotion_table(spark, folder)))


@query("brand_impressions", EMOTION_BASE + ", " + EMOTION_TABLE + ", " + BRANDED + """
SELECT brand, CAST(place AS INTEGER) AS rank, feature, mentions,
       CASE WHEN coalesce(positive_pct, 0) = 0 AND coalesce(negative_pct, 0) = 0 THEN NULL
            WHEN positive_pct >= negative_pct * 1.2 THEN 'strength' WHEN negative_pct >= positive_pct * 1.2 THEN 'issue'
            ELSE 'mixed' END AS tone
FROM ranked LEFT JOIN emotion_table USING (feature) WHERE place <= 2""")
def brand_impressions(spark, folder):
    return em.brand_impressions(_matrix(spark, folder), _emotion_table(spark, folder))


# --- texts by brand -----------------------------------------------------------------------------

def _count_expr(column: str, terms) -> str:
    return " + ".join(word_hits(column, t) for t in terms)


COUNTED = f"""brand_counts AS (SELECT *, {', '.join(f"{_count_expr('body_lower', t)} AS n_{n.lower()}" for n, t in b.BRANDS.items())} FROM lowered),
most AS (SELECT *, greatest({', '.join(f'n_{n.lower()}' for n in b.BRANDS)}) AS top FROM brand_counts),
dominant AS (SELECT *, CASE WHEN top = 0 OR {' + '.join(f'CASE WHEN n_{n.lower()} = top THEN 1 ELSE 0 END' for n in b.BRANDS)} > 1 THEN NULL
  {' '.join(f'WHEN n_{n.lower()} = top THEN {quoted(n)}' for n in b.BRANDS)} END AS brand FROM most)"""


def _list_hits(column: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, {quoted(w)}) AS INTEGER)" for w in words) + ")"


def _list_sentiment(column: str) -> str:
    p, n = _list_hits(column, b.POSITIVE), _list_hits(column, b.NEGATIVE)
    return f"CASE WHEN {p} > {n} THEN 'positive' WHEN {n} > {p} THEN 'negative' ELSE 'neutral' END"


STAGE = "CASE " + " ".join(f"WHEN {has_any('processed_text', t)} THEN {quoted(s)}" for s, t in b.STAGES) + " ELSE 'general discussion' END"
ABOUT = f"""about AS (SELECT *, {_list_sentiment('processed_text')} AS sentiment, {STAGE} AS journey_stage FROM
  (SELECT id, brand, body, score, {normalized('body')} AS processed_text FROM dominant WHERE brand IS NOT NULL)
  WHERE length(processed_text) >= 10)"""
ABOUT_BASE = b.with_ctes(b.TEXTS, LOWERED, COUNTED, ABOUT)


def _about(spark, folder):
    return br.branded_texts(b.texts(spark, folder), "body", b.BRANDS, b.POSITIVE, b.NEGATIVE, b.STAGES)


@query("dominant_brand", b.with_ctes(b.TEXTS, LOWERED, COUNTED) + "SELECT id, brand FROM dominant")
def dominant_brand(spark, folder):
    return b.texts(spark, folder).select("id", br.dominant_brand(F.lower("body"), b.BRANDS).alias("brand"))


@query("wordlist_sentiment", b.with_ctes(b.TEXTS, LOWERED) + f"SELECT id, {_list_sentiment('body_lower')} AS sentiment FROM lowered")
def wordlist_sentiment(spark, folder):
    return b.texts(spark, folder).select("id", br.list_sentiment(F.lower("body"), b.POSITIVE, b.NEGATIVE).alias("sentiment"))


@query("journey_stage", ABOUT_BASE + "SELECT journey_stage, count(*) AS n_rows FROM about GROUP BY 1")
def journey_stage(spark, folder):
    return br.stage_counts(_about(spark, folder))


BY_BRAND = """by_brand AS (SELECT brand, count(*) AS n, count(*) FILTER (sentiment = 'negative') AS negative,
  count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'positive') AS positive FROM about GROUP BY 1)"""


@query("sentiment_by_brand", ABOUT_BASE + ", " + BY_BRAND + """
SELECT brand, negative, neutral, positive, round(100.0 * negative / n, 6) AS negative_pct,
       round(100.0 * neutral / n, 6) AS neutral_pct, round(100.0 * positive / n, 6) AS positive_pct FROM by_brand""")
def sentiment_by_brand(spark, folder):
    return b.rounded(br.sentiment_by_brand(_about(spark, folder)))


@query("posneg_ratio", ABOUT_BASE + ", " + BY_BRAND + """
SELECT brand, positive AS positive_count, negative AS negative_count, neutral AS neutral_count,
       round(positive / (negative + 1), 6) AS pos_neg_ratio FROM by_brand""")
def posneg_ratio(spark, folder):
    return b.rounded(br.posneg_ratio(br.sentiment_by_brand(_about(spark, folder))))


@query("brand_volume_engagement", ABOUT_BASE + """
SELECT brand, count(*) AS total_posts, round(avg(score), 6) AS score_mean, round(stddev(score), 6) AS score_std,
       min(score) AS score_min, max(score) AS score_max, CAST(median(score) AS DOUBLE) AS score_median FROM about GROUP BY 1""")
def brand_volume_engagement(spark, folder):
    return b.rounded(br.volume_engagement(_about(spark, folder)))


def _term_sql(terms) -> str:
    cells = ", ".join(f"CAST(sum({hits('processed_text', t)}) AS BIGINT) AS {br.column_name(t)}" for t in terms)
    return ABOUT_BASE + f"SELECT brand, {cells} FROM about GROUP BY 1"


@query("brand_concern_counts", _term_sql(b.CONCERNS))
def brand_concern_counts(spark, folder):
    return br.term_counts(_about(spark, folder), b.CONCERNS)


@query("brand_feature_word_counts", _term_sql(b.WANTED))
def brand_feature_word_counts(spark, folder):
    return br.term_counts(_about(spark, folder), b.WANTED)


@query("problem_vs_feature", ABOUT_BASE + f"""
SELECT brand, CAST(sum({' + '.join(hits('processed_text', t) for t in b.CONCERNS)}) AS BIGINT) AS problems,
       CAST(sum({' + '.join(hits('processed_text', t) for t in b.WANTED)}) AS BIGINT) AS features FROM about GROUP BY 1""")
def problem_vs_feature(spark, folder):
    return br.problem_vs_feature(_about(spark, folder), b.CONCERNS, b.WANTED)


@query("brand_avg_text_length", ABOUT_BASE + "SELECT brand, round(avg(length(body)), 6) AS avg_length FROM about GROUP BY 1")
def brand_avg_text_length(spark, folder):
    return b.rounded(br.text_length(_about(spark, folder), "body"))
