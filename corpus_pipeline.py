"""A training corpus from ``documents``: by language, without copies, repeats and benchmark passages, packed.

Each stage takes what its predecessor kept. Language ID drops documents without letters and those
whose words speak for no language; near-duplicates keep the smallest ``doc_id`` of each group;
passages that earlier documents have are cut out of texts; documents with benchmark passages go;
what remains is packed into windows among lexical neighbours.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agorascope.llm import decontaminate, langid, packing, simhash, suffixdedup
from agorascope.llm.common import column, read, stored
from agorascope.session import use_utc

#: Least score of a language; of four equally likely ones each has 0.25.
LEAST_SCORE = 0.4
#: A document goes if so large a part of its words, one in so many, lies in benchmark windows.
CONTAMINATED_SHARE = 20
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Learned from all that have one; null texts, and texts without letters, go."""
    model = langid.fit(docs.select("lang", "text"))
    rest = F.struct(*[column(c) for c in docs.columns if c != "text"]).alias("rest")
    found = langid.identify(docs.select("text", rest), model)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest ``doc_id``, of repeated rows one. Documents without words are one group."""
    return simhash.first_of_groups(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without what earlier ones have, ``n_chars`` counted anew where it changed."""
    rest = F.struct(*[column(c) for c in docs.columns if c != "text"]).alias("rest")
    found = suffixdedup.repeated_passages(docs.select("doc_id", "text", F.col("text").isNull().alias("was_null"), rest))
    text = F.when(~F.col("was_null"), F.col("kept_text"))

    def value(name: str) -> Column:
        if name == "text":
            return text.alias(name)
        old = F.col("rest").getField(name)
        if name == "n_chars":
            return F.when(F.size("spans") > 0, F.length(text)).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return found.select(*map(value, docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with fewer than one word in twenty in 13-word windows of the benchmark. Rows are told apart by a hash."""
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select(key.alias("doc_id"), "text")
    hits = decontaminate.judged(decontaminate.benchmark_hits(keyed, read(spark, sf_dir, "benchmark")), CONTAMINATED_SHARE)
    listed = hits.where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    # Whole rows as one value, so that no name of theirs meets the key's.
    rows = docs.select(key.alias("key"), F.struct(*map(column, docs.columns)).alias("row"))
    return rows.join(listed, "key", "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens, each document ended by id 2."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("lexical_packing", pack),
]

#: Fingerprints, components and packing have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
