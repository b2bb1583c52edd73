"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir, use_utc
from . import boxtree, classlm, collocations, decontaminate, langid, licenses, onebit, packing, simhash, sql, suffixdedup, tagpaths, tokenbin, urlfilter
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"


def query(fn: Callable[[SparkSession, str], DataFrame], sql: str | None = None):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(use_utc(spark), folder)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    if sql is not None:
        ORACLES[fn.__name__] = sql
    return fn


@query
def op6_token_blocks(spark, folder):
    """Ids of all texts, each ended by id 1, written in packed blocks and read back."""
    path = scratch_dir(spark, "token-blocks")
    tokenbin.write_ids(read(spark, folder, "documents"), path, public_tokenizers.path(WORD_BPE), end_id=1)
    return tokenbin.read_documents(spark, path)


@query
def op10_lexical_packing(spark, folder):
    """All documents, each ended by id 2, in windows of 4096 tokens among their lexical neighbours."""
    return packing.pack_documents(read(spark, folder, "documents"), public_tokenizers.path(WORD_BPE), end_id=2)


@query
def op4_simhash_groups(spark, folder):
    """Fingerprints of all documents and the groups that four differing bits link."""
    return simhash.near_duplicates(read(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_benchmark_hits(spark, folder):
    """Words of each document that lie in 13-word windows of the benchmark."""
    hits = decontaminate.judged(decontaminate.benchmark_hits(read(spark, folder, "documents"), read(spark, folder, "benchmark")))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), "contaminated",
    )


query(op2_benchmark_hits, sql.BENCHMARK_HITS)


ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]
UNWANTED = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED_HOSTS = [f"{name}.example.{top}" for name in UNWANTED for top in ("com", "net", "org")]


def op1_url_filter(spark, folder):
    """A verdict on every page's URL, by rules and else by a list of hosts."""
    pages = read(spark, folder, "pages").select("page_id", "url")
    hosts = spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "key string")
    return urlfilter.judge_urls(pages, ALLOW, BLOCK, hosts).select("page_id", "host", "path", "rule", "verdict")


query(op1_url_filter, sql.url_filter(ALLOW, BLOCK, BLOCKED_HOSTS))


def fold(docs: DataFrame) -> DataFrame:
    """``docs`` with ``part``, the remainder by 5 of the CRC-32 of the id as text (0 for no id)."""
    return docs.withColumn("part", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0)))


@query
def op8_language_id(spark, folder):
    """The language of every document, learned from four fifths of them."""
    docs = fold(read(spark, folder, "documents"))
    model = langid.fit(docs.where("part <> 0").select("lang", "text"))
    found = langid.identify(docs.select("doc_id", "part", "text"), model)
    return found.select("doc_id", (F.col("part") == 0).alias("held_out"), "lang_pred", "score")


@query
def op5_license_scan(spark, folder):
    """Base phrases and licence labels of every document; the score joins the weights of its detections."""
    found = licenses.scan_licenses(read(spark, folder, "documents"))
    starts, base = F.transform("base", lambda b: b["first"]), F.transform("base", lambda b: b["label"])
    labels = F.concat(base, F.transform("detections", lambda d: d["label"]))
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    unlikely = F.aggregate("detections", F.lit(1.0), lambda p, d: p * (1 - d["weight"]))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(labels).alias("labels"), (1 - unlikely).alias("score"),
    )


@query
def op9_nearest_vectors(spark, folder):
    """The five nearest of every fiftieth vector among all others."""
    return onebit.nearest(read(spark, folder, "embeddings"), divisor=50, k=5)


@query
def op7_class_model(spark, folder):
    """log10 probabilities of all documents, learned from four fifths of them."""
    docs = fold(read(spark, folder, "documents")).withColumn("train", F.col("part") != 1)
    found = classlm.score_documents(docs)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_repeated_passages(spark, folder):
    """What stays of every document without the 50-byte strings that earlier documents have."""
    found = suffixdedup.repeated_passages(read(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["stop"] - s["start"])
    return found.withColumn("n_removed", removed).select(
        "doc_id", (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"), "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_main_text(spark, folder):
    """The main text of every page."""
    return tagpaths.extract_text(read(spark, folder, "pages"))


def op13_collocations(spark, folder):
    """Each language's first 2000 phrases of two to four words."""
    return collocations.collocations(read(spark, folder, "documents")).drop("k")


query(op13_collocations, sql.COLLOCATIONS)


def op12_hard_negatives(spark, folder):
    """Rows of other labels within 30 to 90 percent of each positive's score, for every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return boxtree.mine(read(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label")))


query(op12_hard_negatives, sql.HARD_NEGATIVES)
