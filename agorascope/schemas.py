"""Schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


COMMENT_SCHEMA = _struct(
    id=StringType(),
    subreddit=StringType(),
    author=StringType(),
    body=StringType(),
    score=LongType(),
    created_utc=LongType(),
    parent_id=StringType(),
    link_id=StringType(),
    controversiality=LongType(),
    gilded=LongType(),
)

SUBMISSION_SCHEMA = _struct(
    id=StringType(),
    subreddit=StringType(),
    author=StringType(),
    title=StringType(),
    selftext=StringType(),
    score=LongType(),
    created_utc=LongType(),
    num_comments=LongType(),
    url=StringType(),
    over_18=BooleanType(),
)

LEXICON_SCHEMA = _struct(word=StringType(), emotion=StringType(), association=IntegerType())

