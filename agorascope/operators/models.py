"""Models of engagement, account behaviour and sentiment, built on Spark ML.

Rows are split by a hash of their key, so models that are compared see the same test rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    IDF,
    FeatureHasher,
    HashingTF,
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from ..functions import text as tx
from ..functions.binding import named
from ..functions.time import epoch_timestamp
from ..session import release
from . import evaluation, forests
from .hygiene import split_rows
from .profiles import PROFILE_FEATURES

CONTENT_NUMBERS = ("title_len", "selftext_len", "post_hour", "post_dow")
EARLY_NUMBERS = (
    "early_comment_count", "early_comment_avg_score", "early_comment_max_score",
    "early_comment_avg_length", "early_comment_score_std",
)


def content_time_features(posts: DataFrame, epoch: str = "created_utc") -> DataFrame:
    """Text, log score, text lengths, hour and weekday. Missing texts have length 0; the log
    score is null for scores of -1 and below."""
    ts = epoch_timestamp(F.col(epoch))
    return posts.withColumns({
        "text": tx.assemble(F.col("title"), F.col("selftext")),
        "log_score": F.when(F.col("score") > -1, F.log1p("score")),
        "title_len": F.coalesce(F.length("title"), F.lit(0)),
        "selftext_len": F.coalesce(F.length("selftext"), F.lit(0)),
        "post_hour": F.hour(ts).cast("double"),
        "post_dow": F.dayofweek(ts).cast("double"),
    })


def tfidf_stages(text: str = "text", features: int = 5000, min_doc_freq: int = 2, stop_words: bool = True) -> list:
    tokens = "filtered" if stop_words else "tokens"
    stages = [Tokenizer(inputCol=text, outputCol="tokens")]
    if stop_words:
        stages.append(StopWordsRemover(
            inputCol="tokens", outputCol="filtered", locale="en_US",
            stopWords=StopWordsRemover.loadDefaultStopWords("english"),
        ))
    return [
        *stages,
        HashingTF(inputCol=tokens, outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="tfidf", minDocFreq=min_doc_freq),
    ]


def category_stages(column: str = "community", values: Sequence[str] = (), slots: int = 256, others: bool = True) -> list:
    """A vector with a slot for each listed value and a last one for all others and null; without a list, a hashed
    vector of so many slots. Neither gathers the column's values on the driver. Without ``others``
    these have no slot but all zeros, as models ask of one category."""
    if not values:
        return [FeatureHasher(inputCols=[column], outputCol=f"{column}_vec", numFeatures=slots, categoricalCols=[column])]
    return [
        StringIndexerModel.from_labels(list(values), inputCol=column, outputCol=f"{column}_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{column}_idx"], outputCols=[f"{column}_vec"], dropLast=not others),
    ]


def content_stages(
    extra: Sequence[str] = (), column: str = "community", features: int = 5000, min_doc_freq: int = 2, values: Sequence[str] = (),
) -> list:
    assembler = VectorAssembler(
        inputCols=["tfidf", f"{column}_vec", *CONTENT_NUMBERS, *extra], outputCol="features", handleInvalid="skip"
    )
    return [*tfidf_stages("text", features, min_doc_freq), *category_stages(column, values, others=False), assembler]


def content_columns(extra: Sequence[str], label: str, column: str = "community") -> list[str]:
    """What the estimators among the content stages, the assembler and a forest read."""
    return ["tf", column, *CONTENT_NUMBERS, *extra, label]


#: Rows that one task of a fit takes.
FIT_ROWS = 50_000
#: Binned values, rows by slots, that one task of a forest holds (four bytes each).
FOREST_CELLS = 80_000_000
#: MB of statistics, for each task of a forest, of the nodes that are split in one pass while several forests grow side by side.
GROUP_MB = 4


def fit(stages: list, train: DataFrame, key: str, columns: Sequence[str] | None = None, rows_per_task: int = FIT_ROWS) -> PipelineModel:
    """Fit a pipeline, keeping the input at hand for the passes that the estimators make.

    Stages before the first estimator run once, and of what they give only the key and ``columns``, those that the
    estimators and later stages read, are kept: term counts instead of texts.

    Rows are dealt by their key to as many tasks as the session has cores, or more if one would take over ``rows_per_task`` rows;
    a forest at the end deals them by its own rule (``fit_forest``). Blocks lost with an executor are
    recomputed from the source, and the key deals and orders them as before, so a fit repeats.
    """
    first = next((i for i, stage in enumerate(stages) if isinstance(stage, Estimator)), len(stages))
    count = train.select(key).count()
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-count // rows_per_task))
    many = count > rows_per_task
    if many:  # what was shuffled to count the rows
        release(train.sparkSession)
    # Dealt before these stages, so that they run on all cores however few parts a table has.
    ready = PipelineModel(stages[:first]).transform(train.repartition(tasks, key))
    kept = ready.select(*(dict.fromkeys([key, *columns]) if columns is not None else ready.columns))
    kept = kept.sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)

    def spent() -> None:
        kept.unpersist()
        if many:
            release(train.sparkSession)

    try:
        if not isinstance(stages[-1], (RandomForestClassifier, RandomForestRegressor)):
            return PipelineModel([*stages[:first], *Pipeline(stages=stages[first:]).fit(kept).stages])
        before = Pipeline(stages=stages[first:-1]).fit(kept)
        return PipelineModel([*stages[:first], *before.stages, fit_forest(stages[-1], before.transform(kept), key, count, spent=spent)])
    finally:
        spent()


def fit_forest(
    forest: Estimator, rows: DataFrame, key: str, count: int, cells_per_task: int = FOREST_CELLS, spent: Callable[[], object] = lambda: None,
) -> Model:
    """Fit a random forest as several smaller ones side by side, and unite their trees in one model. A regression on rows
    that fill few of many slots is fitted by those alone (``forests.fit_sparse``).

    Each task of a forest sends the statistics of all nodes that are being split, however few rows it has. So rows are dealt
    to as few tasks as can hold them binned, and the cores are kept busy by as many forests at a time: with
    more tasks than cores there is one, so what they hold binned is bounded by the cores or grows with the rows. Trees
    are grown independently, each from its own sample of rows, so this is the distribution of one forest's; each
    part has a seed of its own, and at least two trees, since Spark gives a single tree all slots to choose from.
    Every row adds to the statistics of all slots of a node's choice, once for each tree: small groups of nodes keep these in
    a core's cache. Results repeat on as many cores. ``spent`` is called when a fit by filled slots
    needs the rows no more.
    """
    features, label, total = forest.getFeaturesCol(), forest.getLabelCol(), forest.getNumTrees()
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    slots = rows.schema[features].metadata["ml_attr"]["num_attrs"]
    if count and slots >= forests.SPARSE_SLOTS and forests.suits(forest):
        cells = rows.agg(F.sum(F.size(forests.filled(features)[0]))).first()[0] or 0
        if cells <= forests.SPARSE_SHARE * count * slots:
            return forests.fit_sparse(forest, rows, key, count, cells, spent=spent)
    tasks = max(1, -(-count * slots // cells_per_task))
    if tasks > cores:
        # Full rounds of tasks.
        tasks = -(-tasks // cores) * cores
    # Half as many tasks again as cores, since each forest waits for the driver between its passes.
    parts = max(1, min(total // 2, -(-(cores + cores // 2) // tasks)))
    group = forest.getMaxMemoryInMB() if parts == 1 else min(forest.getMaxMemoryInMB(), GROUP_MB * tasks)
    # Seeds lie apart, since Spark adds a partition's number to them.
    smaller = [
        forest.copy({
            forest.numTrees: total // parts + (i < total % parts), forest.seed: forest.getSeed() + i * 1_000_003, forest.maxMemoryInMB: group,
        })
        for i in range(parts)
    ]
    dealt = rows.select(key, features, label).repartition(tasks, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dealt.count()
        with ThreadPoolExecutor(parts) as pool:
            return united(forest, list(pool.map(inheritable_thread_target(spark)(lambda part: part.fit(dealt)), smaller)))
    finally:
        dealt.unpersist()


def united(forest: Estimator, fitted: Sequence[Model]) -> Model:
    """One model of the trees of several that copies of ``forest`` fitted on the same rows. Spark ML makes such a model
    from trees, but gives Python no way to, so its constructor is called through the gateway."""
    ours = [model._java_obj for model in fitted]
    trees = [tree for model in ours for tree in model.trees()]
    context = SparkContext.getOrCreate()
    kind = "classification.DecisionTreeClassificationModel" if isinstance(forest, RandomForestClassifier) else "regression.DecisionTreeRegressionModel"
    array = SparkContext._gateway.new_array(getattr(context._jvm, f"org.apache.spark.ml.{kind}"), len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    sizes = [ours[0].numFeatures(), *([ours[0].numClasses()] if isinstance(forest, RandomForestClassifier) else [])]
    made = getattr(context._jvm, ours[0].getClass().getName())(forest.uid, array, *sizes)
    model = forest._copyValues(forest._create_model(made))
    model._transfer_params_to_java()
    return model


def engagement_regression(
    posts: DataFrame, key: str = "id", extra: Sequence[str] = (), features: int = 5000,
    trees: int = 100, depth: int = 12, min_instances: int = 5, subsample: float = 0.8, seed: int = 42, communities: Sequence[str] = (),
) -> tuple[PipelineModel, DataFrame]:
    """Random forest for the log score on content, with ``extra`` numeric columns (such as the
    early comment features). Returns the model and the scored test rows."""
    train, test = regression_rows(posts, key, seed)
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="log_score", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_instances, subsamplingRate=subsample, seed=seed,
    )
    model = fit([*content_stages(extra, features=features, values=communities), forest], train, key, content_columns(extra, "log_score"))
    return model, model.transform(test)


def regression_rows(posts: DataFrame, key: str = "id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The training and test rows of every engagement regression, whatever its features."""
    return split_rows(posts.where(F.col("log_score").isNotNull()), key, seed=seed)


def compared_regressions(posts: DataFrame, extra: Sequence[str], key: str = "id", **settings) -> DataFrame:
    """Predictions of a model on content and of one with ``extra`` columns too, for the same test rows:
    key, community, log_score, ``content`` and ``extended``."""
    _, first = engagement_regression(posts, key, **settings)
    _, second = engagement_regression(posts, key, extra, **settings)
    return first.select(key, "community", "log_score", F.col("prediction").alias("content")).join(
        second.select(key, F.col("prediction").alias("extended")), key
    )


#: Texts whose terms one task counts.
TEXTS_PER_TASK = 5_000


def term_weights(texts: DataFrame, key: str = "id", text: str = "text", min_doc_freq: int = 2, texts_per_task: int = TEXTS_PER_TASK) -> DataFrame:
    """TF-IDF by term instead of by hashed slot: key, term, n, weight. Terms in fewer texts weigh 0, as in Spark ML.

    Texts are shuffled by key, once, so that terms are counted where a text lies and texts are moved instead of
    their terms; a task takes so many that its counts are held without spilling. Counts then meet the weights of the terms, of which as many as a corpus has are no broadcast:
    these are the hashed side of the join, so that counts needn't be sorted.
    """
    terms = F.filter(F.split(F.lower("__text"), r"\s+"), lambda t: t != "")
    total = texts.count()
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-total // texts_per_task))
    said = texts.select(named(key), named(text).alias("__text")).repartition(tasks, named(key)).select(named(key), F.explode(terms).alias("term"))
    counted = said.groupBy(named(key), "term").agg(F.count(F.lit(1)).alias("n"))
    found = counted.groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    idf = F.when(F.col("texts") >= min_doc_freq, F.log(F.lit(total + 1) / (F.col("texts") + 1))).otherwise(0.0)
    weights = found.select("term", idf.alias("idf")).hint("shuffle_hash")
    return counted.join(weights, "term").select(named(key), "term", "n", (F.col("n") * F.col("idf")).alias("weight"))


def viral_classifier(
    posts: DataFrame, key: str = "id", extra: Sequence[str] = (), features: int = 5000,
    trees: int = 100, depth: int = 10, seed: int = 42, label: str = "is_viral", communities: Sequence[str] = (),
) -> tuple[PipelineModel, DataFrame]:
    """Random forest for the top-score label; listed communities have a slot each, as in the regressions."""
    train, test = split_rows(posts, key, seed=seed)
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    stages = [*content_stages(extra, features=features, min_doc_freq=0, values=communities), forest]
    model = fit(stages, train, key, content_columns(extra, label))
    return model, model.transform(test)


def suspicious_classifier(
    profiles: DataFrame, key: str = "author", columns: Sequence[str] = PROFILE_FEATURES,
    trees: int = 100, depth: int = 8, seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Random forest for the rule-based account label on scaled profile measures."""
    train, test = split_rows(profiles, key, seed=seed)
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features"),
        RandomForestClassifier(featuresCol="features", labelCol="is_suspicious", numTrees=trees, maxDepth=depth, seed=seed),
    ]
    model = fit(stages, train, key, ["raw_features", "is_suspicious"])
    return model, model.transform(test)


def sentiment_classifier(
    texts: DataFrame, key: str = "id", text: str = "processed_text", label: str = "sentiment",
    features: int = 1000, iterations: int = 100, seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Multinomial logistic regression on TF-IDF for labels given as text; adds
    ``predicted_<label>`` to the test rows."""
    train, test = split_rows(texts.select(key, text, label), key, seed=seed)
    indexer = StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip").fit(train)
    stages = [
        *tfidf_stages(text, features, 0, stop_words=False),
        indexer,
        LogisticRegression(
            featuresCol="tfidf", labelCol="label", maxIter=iterations, regParam=0.0, elasticNetParam=0.0,
            standardization=True, fitIntercept=True,
        ),
        IndexToString(inputCol="prediction", outputCol=f"predicted_{label}", labels=indexer.labels),
    ]
    model = fit(stages, train, key, ["tf", label])
    return model, model.transform(test)


def binary_report(predictions: DataFrame, label: str) -> DataFrame:
    """Metrics of a binary classifier with the exact areas under both curves, one row."""
    scored = predictions.select(
        label, F.col("prediction").cast("int").alias("prediction"), vector_to_array(F.col("rawPrediction"))[1].alias("__score")
    )
    # A few numbers a row, read several times: dealt to the cores, not left in one task for each that scored texts.
    kept = scored.repartition(predictions.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    metrics = evaluation.classification_metrics(kept, label, "prediction", "__score")
    row = metrics.first()
    kept.unpersist()
    return predictions.sparkSession.createDataFrame([row], metrics.schema)


def prediction_sample(predictions: DataFrame, key: str = "id", k: int = 5000, columns: Sequence[str] = ("community", "title", "score", "log_score")) -> DataFrame:
    """The first k scored rows by key, for reading."""
    return predictions.select(key, *columns, "prediction").orderBy(key).limit(k)


def vector_values(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Non-zero entries of a vector column as (key, index, value)."""
    entries = F.posexplode(vector_to_array(F.col(vector))).alias("index", "value")
    return df.select(key, entries).where(F.col("value") != 0)
