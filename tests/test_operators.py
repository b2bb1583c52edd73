"""Operators on small tables, against values worked out by hand or by brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from agorascope import presets
from agorascope.operators import (
    activity, brands, clusters, depth, early, emotions, engagement, evaluation, hygiene, importance, launch, mentions,
    models, overlap, profiles, skew,
)
from agorascope.sources import lexicon, profile, tables


def test_comment_hygiene(spark, rows):
    data = [(1, None, "a"), (2, "", "a"), (3, "[deleted]", "a"), (4, "[removed]", "a"), (5, "long enough text", "AutoModerator"),
            (6, "12345678", "a"), (7, "123456789", "a")]
    df = spark.createDataFrame(data, "id int, body string, author string")
    assert rows(hygiene.clean_comments(df), "id") == [(7,)]
    funnel = hygiene.funnel(df, hygiene.comment_rules())
    assert [r[0] for r in funnel.orderBy("stage").select("n_rows").collect()] == [7, 6, 4, 3, 1]


def test_two_tiers(spark, rows):
    data = [(1, "focus", "x"), (2, "mixed", "has Buds"), (3, "mixed", "none"), (4, "other", "buds"), (5, "mixed", None)]
    df = spark.createDataFrame(data, "id int, community string, title string")
    assert rows(hygiene.two_tier(df, ["focus"], ["mixed"], ["buds"], ["title"]), "id") == [(1,), (2,)]


def test_case_rules_differ(spark, rows):
    df = spark.createDataFrame([("AirPods",), ("airpods",), ("Tech",)], "community string")
    assert rows(hygiene.in_communities(df, ["airpods"])) == [("airpods",)]
    assert rows(hygiene.in_communities_ci(df, ["AIRPODS", "tech"], ["TECH"])) == [("airpods",), ("airpods",)]


def test_split_covers_all_rows_once(spark):
    df = spark.range(1000).union(spark.range(1).select(F.lit(None).cast("long")))
    train, test = hygiene.split_rows(df, "id")
    assert train.count() + test.count() == 1001 and train.intersect(test).count() == 0


def test_unreadable_path_is_named(spark):
    with pytest.raises(tables.UnreadablePath, match="/no/such/folder"):
        tables.read_table(spark, "/no/such/folder")


def test_lexicon_file_and_fallback(spark, rows, tmp_path):
    (tmp_path / "lex.tsv").write_text("Good\tJoy\t1\nGood\tfear\t0\nbad\tanger\t1\n")
    assert rows(lexicon.load(spark, str(tmp_path / "lex.tsv"))) == [("bad", "anger"), ("good", "joy")]
    assert lexicon.load(spark, None).where("word = 'great'").count() == 3


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "n int, s string")
    got = {r["column_name"]: r for r in profile.dataset_profile(df, approximate=False).collect()}
    assert (got["n"]["n_distinct"], got["n"]["min_value"], got["s"]["n_nulls"], got["s"]["max_value"]) == (2, "1", 1, "b")
    assert profile.dataset_profile(df).count() == 2


def comments_and_posts(spark):
    posts = spark.createDataFrame([(1, "t3_1", 1000), (2, "t3_2", 1000), (3, "t3_3", 1000)], "id int, link_id string, created_utc long")
    data = [("t3_1", 999, 50, 1), ("t3_1", 1000, 4, 10), ("t3_1", 4600, 8, 20), ("t3_1", 4601, 50, 1), ("t3_2", 1500, 7, 5),
            ("1", 1500, 99, 5), ("t3_9", 1500, 99, 5)]
    return posts, spark.createDataFrame(data, "link_id string, created_utc long, score int, length int")


@pytest.mark.parametrize("salting", [{}, {"rows_per_task": 1}])
def test_early_window(spark, salting):
    posts, comments = comments_and_posts(spark)
    got = {r["id"]: r for r in early.early_comment_features(posts, comments, 3600, **salting).collect()}
    assert len(got) == 3
    first = got[1]
    assert (first["early_comment_count"], first["early_comment_avg_score"], first["early_comment_max_score"]) == (2, 6.0, 8)
    assert first["early_comment_avg_length"] == 15.0
    assert first["early_comment_score_std"] == pytest.approx(statistics.stdev([4, 8]))
    assert got[2]["early_comment_score_std"] == 0.0
    assert (got[3]["early_comment_count"], got[3]["early_comment_avg_score"]) == (0, 0.0)


def test_comment_counts(spark, rows):
    posts, comments = comments_and_posts(spark)
    assert rows(depth.post_comment_counts(posts, comments), "id", "actual_comment_count") == [(1, 4), (2, 1), (3, 0)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_one_hot_key(spark, rows, how):
    random.seed(3)
    big = [("hot" if i % 3 == 0 else "warm" if i % 3 == 1 and i % 2 else None if i % 5 == 0 else str(random.randrange(40)), i) for i in range(600)]
    small = [("hot", "h"), ("warm", "w"), (None, "n"), *[(str(i), f"v{i}") for i in range(0, 40, 2)]]
    left = spark.createDataFrame(big, "k string, i int")
    right = spark.createDataFrame(small, "k string, v string")
    assert rows(skew.hot_keys(left, "k", 50)) == [("hot", 4), ("warm", 2)]
    plain = left.join(right, "k", how)
    salted = skew.salted_join(left, right, "k", ["i"], how, rows_per_task=50)
    assert rows(salted, "k", "i", "v") == rows(plain, "k", "i", "v")


def test_grouped_median_with_many_ranges_and_null_groups(spark):
    random.seed(8)
    data = [(random.choice(["a", "b", None]), random.uniform(-5, 5), random.randrange(4)) for _ in range(801)] + [("c", None, 2), ("d", 1.0, None)]
    df = spark.createDataFrame(data, "`g.x` string, a double, b int")
    for splits in (2, 7, 256):
        got = {r[0]: (r["a_median"], r["b_median"]) for r in skew.grouped_median(df, ["g.x"], ["a", "b"], splits).collect()}
        for g in ("a", "b", "c", "d", None):
            for i in (0, 1):
                own = [r[i + 1] for r in data if r[0] == g and r[i + 1] is not None]
                assert got[g][i] == (statistics.median(own) if own else None)
    whole = skew.grouped_median(df, [], ["a"], 16).first()[0]
    assert whole == statistics.median(r[1] for r in data if r[1] is not None)


def test_medians_are_planned_without_a_job_and_count_once(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("x"), F.rand(1).alias("y"))
    df = df.repartition(4, "x")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    medians = skew.grouped_median(df, ["g"], ["x", "y"])
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert medians.count() == 3
    medians.collect()
    plan = medians._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Range (0, 3000") == 1  # all that follows reads one shuffle of counts


def test_names_of_any_form(spark, rows):
    from agorascope.operators import hygiene, launch, mentions
    from agorascope.sources.profile import dataset_profile

    texts = spark.createDataFrame([("Pre-Launch", "bluetooth 5.3 and b&o"), ("Post-Launch", "don't use b&o")], "period string, text string")
    words = ["bluetooth 5.3", "b&o", "don't"]
    rates = launch.keyword_rates(launch.keyword_flags(texts, words), words)
    assert rows(rates, "keyword", "period", "mentions") == sorted([(w, p, int(w in t)) for w in words for p, t in (("Pre-Launch", "bluetooth 5.3 and b&o"), ("Post-Launch", "don't use b&o"))], key=repr)
    low = texts.select(F.lower("text").alias("low"))
    assert rows(mentions.feature_mentions(low, "low", {"driver's fit": ["use"], "b\"q`.c": ["b&o"]})) == sorted([("b\"q`.c", 2), ("driver's fit", 1)], key=repr)
    funnel = hygiene.funnel(texts, [("it's `all`", F.lit(True))])
    assert [r["name"] for r in funnel.orderBy("stage").collect()] == ["all", "it's `all`"]
    odd = spark.createDataFrame([(1, "x")], "`a.b` int, `c'd``e` string")
    assert rows(dataset_profile(odd), "column_name", "n_rows") == sorted([("a.b", 1), ("c'd`e", 1)], key=repr)


@pytest.mark.parametrize("descending", [False, True])
def test_ranked_histogram(spark, rows, descending):
    random.seed(1)
    data = [random.choice([1.0, 2.0, random.uniform(0, 500)]) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    got = {r["x"]: (r["n"], r["before"], r["total"]) for r in skew.ranked_histogram(df, "x", descending).collect()}
    ordered = sorted(data, reverse=descending)
    assert got == {x: (data.count(x), ordered.index(x), len(data)) for x in set(data)}


def test_grouped_median(spark):
    random.seed(2)
    data = [(f"g{i % 3}", random.randrange(20), random.choice([None, random.randrange(5)])) for i in range(200)] + [("one", 4, 7)]
    df = spark.createDataFrame(data, "g string, a int, b int")
    got = {r["g"]: (r["a_median"], r["b_median"]) for r in skew.grouped_median(df, ["g"], ["a", "b"]).collect()}
    for g in {d[0] for d in data}:
        a = [d[1] for d in data if d[0] == g]
        b = [d[2] for d in data if d[0] == g and d[2] is not None]
        assert got[g] == (statistics.median(a), statistics.median(b))


@pytest.mark.parametrize("scores", [[5] * 20, list(range(20)), [9] * 3 + [1] * 17, [7], [3, None, 8, 8, 1]])
def test_viral_label(spark, scores):
    df = spark.createDataFrame([(i, None if s is None else float(s)) for i, s in enumerate(scores)], "id int, log_score double")
    got = {r["id"]: r["is_viral"] for r in evaluation.viral_label(df).collect()}
    for i, s in enumerate(scores):
        above = sum(1 for t in scores if t is not None and s is not None and t > s)
        rank = above / (len(scores) - 1) if len(scores) > 1 else 0
        assert got[i] == (1 if s is not None and rank <= 0.10 else 0)


def test_overlap(spark, rows):
    data = [("u", "a"), ("u", "b"), ("u", "c"), ("u", "a"), ("v", "a"), ("v", "b"), ("w", "c"), ("[deleted]", "a"), ("[deleted]", "b")]
    sets = overlap.memberships(spark.createDataFrame(data + [("u1", "unlisted")], "author string, community string"), ["a", "b", "c"])
    assert rows(overlap.shared_users(sets)) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    matrix = {(r[0], r[1]): r[2] for r in overlap.overlap_matrix(sets).collect()}
    assert matrix[("a", "a")] == 2 and matrix[("b", "a")] == 2 and matrix[("c", "c")] == 2


def test_multi_community_users(spark, rows):
    data = [("u", "a"), ("u", "b"), ("v", "a"), ("v", "a"), ("[deleted]", "a")]
    users = engagement.multi_community_users(spark.createDataFrame(data, "author string, community string"))
    assert rows(engagement.user_counts(users)) == [(2, 1)]


def test_full_outer_sides(spark):
    day = "date '2024-01-02'"
    c = spark.createDataFrame([("both", 2), ("left", 4)], "community string, score int").withColumn("date", F.expr(day))
    p = spark.createDataFrame([("both", 4), ("right", 6)], "community string, score int").withColumn("date", F.expr(day))
    got = {r["community"]: r for r in activity.community_statistics(c, p).collect()}
    assert (got["both"]["avg_score"], got["left"]["avg_score"], got["right"]["avg_score"]) == (3.0, 2.0, 3.0)
    assert (got["right"]["num_comments"], got["right"]["weighted_avg_score"]) == (0, 6.0)
    assert got["right"]["date_range"] == "2024-01-02 to 2024-01-02"


def test_unique_counts_approximate(spark):
    df = spark.range(5000).withColumn("a", F.col("id") % 100)
    exact = activity.unique_counts(df, {"n": "id", "m": "a"}).first()
    near = activity.unique_counts(df, {"n": "id", "m": "a"}, approximate=True).first()
    assert (exact["n"], exact["m"]) == (5000, 100) and abs(near["n"] - 5000) < 500


def test_brand_ties_and_shared_terms(spark):
    data = [("nothing",), ("sony sony bose",), ("sony bose",), ("airpods and apple",), (None,), ("beats",)]
    df = spark.createDataFrame(data, "t string")
    got = [r[0] for r in df.select(brands.dominant_brand(F.lower("t"), presets.BRAND_TERMS)).collect()]
    assert got == [None, "Sony", None, "Apple", None, "Beats"]


def test_brand_matrix_counts_and_threshold(spark, rows):
    data = [("sony buds bass",)] * 3 + [("buds sony",)] + [("bose buds bass",)] + [("sony bass",)]
    df = spark.createDataFrame(data, "t string")
    matrix = mentions.brand_feature_counts(df, "t", {"sony": ["sony"], "bose": ["bose"]}, ["buds"], {"sound": ["bass"], "fit": ["fit"]}, 2)
    assert rows(matrix, "brand", "feature", "mentions", "matching_texts") == [("sony", "sound", 3, 4)]
    assert rows(mentions.brand_summary(matrix), "top_features") == [("sound (3)",)]


def test_pain_points_scale_with_the_sample(spark, rows):
    df = spark.createDataFrame([("a", -0.5), ("a", -0.1), ("a", 0.3), ("b", 0.2)], "feature string, sentiment_score double")
    got = mentions.feature_pain_points(df, fraction=0.5)
    assert rows(got, "feature", "negative_mentions", "estimated_negative_mentions") == [("a", 2, 4)]


@pytest.mark.parametrize("limit", [1000, 1])
def test_emotions_with_small_and_large_lexicon(spark, rows, limit):
    lex = spark.createDataFrame([("great", "joy"), ("great", "trust"), ("dead", "sadness")], "word string, emotion string")
    df = spark.createDataFrame([(1, "Great, great battery is DEAD"), (2, "great sound"), (3, "dead")], "id int, body string")
    per_text = emotions.lexicon_hits(df, "id", "body", lex, limit, rows_per_task=2)
    assert rows(per_text, "id", "emotion", "hits") == [
        (1, "joy", 2), (1, "sadness", 1), (1, "trust", 2), (2, "joy", 1), (2, "trust", 1), (3, "sadness", 1)]
    features = {"battery": ["battery"], "sound": ["sound"]}
    hits = emotions.feature_emotion_hits(df, "body", features, lex, max_broadcast_rows=limit)
    assert rows(hits, "feature", "emotion", "hits") == [
        ("battery", "joy", 2), ("battery", "sadness", 1), ("battery", "trust", 2), ("sound", "joy", 1), ("sound", "trust", 1)]


def test_feature_without_emotion_words_keeps_a_row(spark):
    counts = spark.createDataFrame([("x", 4), ("y", 0)], "feature string, mentions long")
    hits = spark.createDataFrame([], "feature string, emotion string, hits long")
    got = emotions.feature_emotions(counts, hits).collect()
    assert len(got) == 1 and got[0]["total_comments"] == 4 and got[0]["joy"] == 0 and got[0]["joy_pct"] == 0.0


def test_launch_corpus_bounds_and_pushdown(spark, rows, tmp_path):
    day = 86400
    start = 1685577600  # 2023-06-01
    data = [(1, start - 1), (2, start), (3, start + 2 * day - 1), (4, start + 2 * day), (5, (start + day) * 1000), (6, None)]
    spark.createDataFrame([(i, e, "the product is fine", 1) for i, e in data], "id int, created_utc long, text string, score int").write.parquet(str(tmp_path / "t"))
    found = launch.corpus(spark.read.parquet(str(tmp_path / "t")), "(?i)PRODUCT", "2023-06-01", "2023-06-02", "2023-06-02", 10)
    assert rows(found, "id", "period") == [(2, launch.PRE), (3, launch.POST), (5, launch.POST)]
    assert "GreaterThanOrEqual(created_utc,1685577600)" in found._jdf.queryExecution().executedPlan().toString()


def test_keyword_change_without_earlier_mentions(spark):
    rates = spark.createDataFrame(
        [("k", launch.PRE, 0.0), ("k", launch.POST, 5.0), ("j", launch.PRE, 4.0), ("j", launch.POST, 5.0)],
        "keyword string, period string, mention_rate double")
    assert [(r["keyword"], r["change_pct"]) for r in launch.keyword_change(rates).collect()] == [("j", 25.0), ("k", None)]


def test_profile_of_a_single_row_author(spark):
    df = spark.sql("select 'a' author, 'c' community, 5 score, timestamp '2024-01-01 10:00:00' created, 'short' body")
    row = profiles.label_suspicious(profiles.user_profiles(df)).first()
    assert (row["score_std"], row["activity_span_days"], row["comments_per_day"], row["short_comment_rate"]) == (0.0, 0, 1.0, 1.0)
    assert row["is_suspicious"] == 1
    assert profiles.user_profiles(df, min_rows=2).count() == 0


def test_class_report_with_missing_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0), (1, 1)], "label int, prediction int")
    got = {r["class"]: r for r in evaluation.class_report(df, "label", "prediction").collect()}
    assert (got["2"]["precision"], got["2"]["recall"], got["2"]["support"]) == (0.0, 0.0, 0)
    assert (got["1"]["precision"], got["1"]["recall"]) == (1.0, 0.5)
    assert got["accuracy"]["f1"] == 0.5


def test_kmeans_on_distinct_vectors(spark):
    data = [(1, 0, 0)] * 50 + [(0, 1, 0)] * 30 + [(0, 0, 1)] * 20 + [(1, 1, 0)] * 2
    df = spark.createDataFrame(data, "a int, b int, c int")
    sweep = {r["k"]: r for r in clusters.kmeans_sweep(df, ["a", "b", "c"], range(2, 10)).collect()}
    assert sorted(sweep) == list(range(2, 10)) and sweep[3]["inertia"] <= sweep[2]["inertia"]
    assert [k for k, r in sweep.items() if r["tried"]] == [2, 3] and sweep[4]["inertia"] is None
    assert sum(r["is_best"] for r in sweep.values()) == 1
    assert clusters.centroids(df, ["a", "b", "c"], 2).count() == 6


def test_importances_carry_true_names(spark):
    data = [(i, f"title {i % 7} word{i % 3}", "body text", i % 11, 1700000000 + i * 5000, f"c{i % 2}") for i in range(120)]
    df = spark.createDataFrame(data, "id int, title string, selftext string, score int, created_utc long, community string")
    model, scored = models.engagement_regression(models.content_time_features(df), features=16, trees=3, depth=3, communities=["c0", "c1"])
    names = importance.feature_names(scored)
    table = importance.feature_importance(spark, model, names)
    assert len(names) == 16 + 2 + 4 and names[-4:] == list(models.CONTENT_NUMBERS)
    totals = {r["feature_group"]: r["importance_pct"] for r in importance.group_totals(table).collect()}
    assert set(totals) == {"TF-IDF", "Community", "Text_Length", "Temporal"} and sum(totals.values()) == pytest.approx(100)


def test_text_slots_are_named_by_their_terms(spark):
    from pyspark.ml.feature import HashingTF

    data = [(i, f"title word{i % 3} Größe{i % 7} the and x{i % 40}", "body text", i % 11, 1700000000 + i * 5000, f"c{i % 2}") for i in range(120)]
    df = spark.createDataFrame(data, "id int, title string, selftext string, score int, created_utc long, community string")
    posts = models.content_time_features(df)
    model, scored = models.engagement_regression(posts, features=32, trees=3, depth=3, communities=["c0", "c1"])
    found = importance.slot_terms(posts, model, range(32)).collect()
    hashing = HashingTF(numFeatures=32)
    want = {}
    for _, title, body, *_ in data:
        for term in set(f"{title} {body}".lower().split()) - {"the", "and"}:
            want[term] = want.get(term, 0) + 1
    assert {r.term: (r.slot, r.documents) for r in found} == {t: (hashing.indexOf(t), n) for t, n in want.items()}
    table = importance.feature_importance(spark, model, importance.feature_names(scored), texts=posts, named_slots=4, k=2)
    named = [r for r in table.orderBy("rank").collect() if r.terms]
    assert table.count() == 32 + 2 + 4 and 0 < len(named) <= 4 and all(r.feature.startswith("tfidf_") for r in named)
    for r in named:
        own = sorted((t for t in want if hashing.indexOf(t) == int(r.feature[6:])), key=lambda t: (-want[t], t))
        assert r.terms == own[:2] and r.n_terms == len(own)
    assert importance.slot_terms(posts, model, []).count() == 0


def test_presets_with_their_operators(spark, rows):
    texts = spark.createDataFrame([(1, "galaxy buds 2 vs sony wf-1000xm4 linkbuds"), (2, "I love this, great fit"), (3, "waste of money, the battery is dead"), (4, "AirPods Pro second gen")], "id int, t string")
    low = F.lower("t")
    got = {r[0]: tuple(r)[1:] for r in texts.select(
        "id", brands.dominant_brand(low, presets.BRAND_TERMS), brands.list_sentiment(low, presets.LABEL_POSITIVE_WORDS, presets.LABEL_NEGATIVE_WORDS),
        brands.list_sentiment(low, presets.POSITIVE_WORDS, presets.NEGATIVE_WORDS),
    ).collect()}
    assert got[1][0] is None and got[4][0] == "Apple"  # as many places for either brand
    assert got[2][1:] == ("positive", "positive") and got[3][1:] == ("negative", "negative")
    pains = {r["feature"]: r["mentions"] for r in mentions.feature_mentions(texts.withColumn("low", low), "low", presets.PAIN_POINTS).collect()}
    assert pains["battery"] == 1 and pains["durability"] == 1 and pains["anc"] == 0
    posts = texts.select(F.col("t").alias("text"), F.lit(1700000000).alias("created_utc"))
    assert launch.corpus(posts, presets.PRODUCT_PATTERNS, *presets.LAUNCH_RANGE, presets.LAUNCH_DAY).count() == 1
    flags = launch.keyword_flags(texts.withColumnRenamed("t", "text"), presets.TRACKED_KEYWORDS)
    assert len(flags.columns) == 2 + len({k.replace(" ", "-") for k in presets.TRACKED_KEYWORDS})
    counts = brands.term_counts(texts.withColumnRenamed("t", "processed_text").withColumn("brand", F.lit("x")), presets.CONCERN_WORDS + presets.FEATURE_WORDS)
    assert counts.count() >= 1


def test_excluded_authors(spark):
    data = [("[deleted]", "a", 1, "2024-01-01"), ("u", "a", 2, "2024-01-02"), (None, "a", 3, "2024-01-02")]
    df = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(data)], "id int, author string, community string, score int, date string, num_comments int").withColumn("date", F.to_date("date"))
    assert engagement.engagement_metrics(df, [], excluded=("[deleted]",)).first()["unique_authors"] == 1
    assert engagement.engagement_metrics(df, []).first()["unique_authors"] == 2
    activity = df.withColumn("created", F.col("date").cast("timestamp")).withColumn("body", F.lit("x"))
    assert {r["author"] for r in profiles.user_profiles(activity, excluded=("[deleted]",)).collect()} == {"u", None}


def test_clusters_are_assigned_to_all_rows(spark):
    data = [(f"c{i % 3}", int(i % 2), int(i % 5 == 0), int(i % 7 == 0)) for i in range(210)]
    df = spark.createDataFrame(data, "community string, a int, b int, c int")
    model = clusters.fit_kmeans(clusters.weighted_points(df, ["a", "b", "c"]), 3)
    clustered = clusters.assign_clusters(df, ["a", "b", "c"], model)
    sizes = clusters.cluster_sizes(clustered, ["a", "b", "c"]).collect()
    assert sum(r["size"] for r in sizes) == 210
    for r in clusters.community_share(clustered, range(3)).collect():
        assert sum(r[f"cluster_{i}_pct"] for i in range(3)) == pytest.approx(100)
    centres = [x for c in model.clusterCenters() for x in c]
    assert sorted(round(float(x), 6) for x in centres) == sorted(round(r[c], 6) for r in sizes for c in "abc")


def test_models_are_judged_on_the_same_rows_and_repeat(spark):
    data = [(i, f"title {i % 7} word{i % 3}", "body text", i % 11, 1700000000 + i * 5000, f"c{i % 2}", float(i % 4)) for i in range(120)]
    df = models.content_time_features(spark.createDataFrame(data, "id int, title string, selftext string, score int, created_utc long, community string, x double"))
    small = {"features": 16, "trees": 3, "depth": 3, "communities": ["c0", "c1"]}
    both = models.compared_regressions(df, ["x"], **small)
    again = models.compared_regressions(df, ["x"], **small)
    test = {r["id"] for r in models.regression_rows(df)[1].collect()}
    assert {r["id"] for r in both.collect()} == test
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, again.collect()))


def test_values_that_are_not_listed_share_the_last_slot(spark):
    from pyspark.ml import Pipeline

    from agorascope.operators import models

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "other"), (4, None)], "id bigint, community string")
    encoded = Pipeline(stages=models.category_stages(values=["a", "b"])).fit(df).transform(df)
    got = models.vector_values(encoded, "id", "community_vec").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0), (4, 2, 1.0)]
