"""Filters, clean-up and the unified text table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import sampling, text as tx
from ..functions.binding import add_kept, as_rows
from ..functions.numeric import percent, whole_or_zero
from ..functions.time import epoch_timestamp

GONE = ("[deleted]", "[removed]")
MODERATOR = "AutoModerator"
SPELLINGS_MAX = 1000


def in_communities(df: DataFrame, names: Sequence[str], column: str = "community") -> DataFrame:
    """Exact-case membership; reaches the parquet scan as a pushed filter."""
    return df.where(F.col(column).isin(list(names)))


def in_communities_ci(
    df: DataFrame, names: Sequence[str], excluded: Sequence[str] = (), column: str = "community"
) -> DataFrame:
    """Membership whatever the case, less an exclusion list; the column comes out lower-cased.

    The spellings that occur are looked up first, in a pass over this column alone, so that the
    filter on the rows is a list of values and reaches the scan. There are at most as many as the
    listed names have spellings; should there be more than ``SPELLINGS_MAX``, rows are lower-cased to be compared.
    """
    wanted = sorted({n.lower() for n in names} - {n.lower() for n in excluded})
    listed = F.lower(column).isin(wanted)
    found = df.where(listed).select(column).distinct().limit(SPELLINGS_MAX + 1).collect()
    if len(found) <= SPELLINGS_MAX:
        listed = F.col(column).isin([r[0] for r in found])
    return df.where(listed).withColumn(column, F.lower(column))


def comment_rules(body: str = "body", author: str = "author", min_length: int = 8, gone: Sequence[str] = GONE) -> list[tuple[str, Column]]:
    """The comment hygiene rules in the order in which they apply."""
    return [
        ("has_body", F.col(body).isNotNull()),
        ("not_gone", ~F.col(body).isin(list(gone))),
        ("not_moderator", F.col(author) != MODERATOR),
        ("long_enough", F.length(body) > min_length),
    ]


def clean_comments(df: DataFrame, body: str = "body", author: str = "author", min_length: int = 8, gone: Sequence[str] = GONE) -> DataFrame:
    """Comments worth analysing, with ``<body>_lower``."""
    for _, rule in comment_rules(body, author, min_length, gone):
        df = df.where(rule)
    return df.withColumn(f"{body}_lower", F.lower(body))


def clean_submissions(df: DataFrame, title: str = "title", min_title: int = 5, score: str | None = None) -> DataFrame:
    """Posts with a title longer than ``min_title``; with ``score``, also a score of 0 or more."""
    kept = df.where(F.col(title).isNotNull() & (F.length(title) > min_title))
    return kept if score is None else kept.where(F.col(score).isNotNull() & (F.col(score) >= 0))


def two_tier(
    df: DataFrame,
    focus: Sequence[str],
    mixed: Sequence[str],
    terms: Sequence[tx.Term],
    texts: Sequence[str],
    column: str = "community",
    word: bool = False,
) -> DataFrame:
    """Every row of the focus communities, and of the mixed ones the rows that mention a term.

    Membership of either list is a separate conjunct so that it is pushed to the scan.
    """
    listed = F.col(column).isin([*focus, *mixed])
    named = F.lit(False)
    for t in texts:
        named = named | F.coalesce(tx.text_mentions(F.col(t), terms, word), F.lit(False))
    return df.where(listed).where(F.col(column).isin(list(focus)) | named)


def fill_numeric(df: DataFrame, columns: Sequence[str], kind: str = "int") -> DataFrame:
    return df.withColumns({c: whole_or_zero(F.col(c), kind) for c in columns})


def normalized_texts(df: DataFrame, text: str, out: str = "processed_text", min_length: int = 20) -> DataFrame:
    return add_kept(df, out, tx.normalize(F.col(text)), lambda t: F.length(t) >= min_length)


def period_rows(df: DataFrame, day: str, first: str, last: str, event_day: str, before="Pre-Launch", after="Post-Launch") -> DataFrame:
    """Rows dated first..last with a label for before or from the event day on."""
    d = F.col(day)
    inside = (d >= F.to_date(F.lit(first))) & (d <= F.to_date(F.lit(last)))
    label = F.when(d < F.to_date(F.lit(event_day)), before).otherwise(after)
    return df.where(inside).withColumn("period", label)


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """A Bernoulli sample by key; the same rows on every run."""
    return df.where(sampling.in_sample(F.col(key), fraction, seed))


def split_rows(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key; null keys go to train."""
    chosen = F.coalesce(sampling.in_sample(F.col(key), train, seed), F.lit(True))
    return df.where(chosen), df.where(~chosen)


def unify(comments: DataFrame, submissions: DataFrame, tag: str = "source", nulls: str = "skip", keep: Sequence[str] = ()) -> DataFrame:
    """Comments and posts as one table of ``text``, a tag, and the ``keep`` columns."""
    c = comments.select(*keep, F.col("body").alias("text"), F.lit("comment").alias(tag))
    s = submissions.select(
        *keep, tx.assemble(F.col("title"), F.col("selftext"), nulls).alias("text"), F.lit("submission").alias(tag)
    )
    return c.unionByName(s)


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each stage and their percentage of all rows, in one aggregate."""
    passed = F.lit(True)
    sums = [F.count(F.lit(1)).alias("s0")]
    for i, (_, rule) in enumerate(stages, start=1):
        passed = passed & F.coalesce(rule, F.lit(False))
        sums.append(F.count_if(passed).alias(f"s{i}"))
    names = ["all", *[name for name, _ in stages]]
    rows = [(F.lit(i), F.lit(name), F.col(f"s{i}")) for i, name in enumerate(names)]
    return (
        df.agg(*sums)
        .select("s0", as_rows(("stage", "name", "n_rows"), rows))
        .select("stage", "name", "n_rows", percent(F.col("n_rows"), F.col("s0")).alias("retained_pct"))
    )


def ingest(df: DataFrame, communities: Sequence[str], columns: Sequence[str], community: str = "community", epoch: str = "created_utc") -> DataFrame:
    """Listed communities, the columns that exist, and a ``date``."""
    present = [c for c in columns if c in df.columns]
    kept = in_communities(df, communities, community).select(*present)
    return kept.withColumn("date", F.to_date(epoch_timestamp(F.col(epoch)))) if epoch in present else kept
