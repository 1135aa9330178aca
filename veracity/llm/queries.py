"""Driver queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm.bpe import encode_texts
from veracity.llm.columns import crc_bucket
from veracity.llm.decontaminate import find_leaks
from veracity.llm.jaccard_join import near_duplicates
from veracity.llm.lexical import search
from veracity.llm.licenses import scan_licenses
from veracity.llm.lm_score import score_texts
from veracity.llm.merkle import dataset_manifest
from veracity.llm.nearest import nearest
from veracity.llm.oracles import LEXICAL_SEARCH, MERKLE_MANIFEST
from veracity.llm.quality import score_quality
from veracity.llm.secrets import scan_secrets
from veracity.llm.sharding import assign_shards
from veracity.llm.substring_dedup import remove_repeats
from veracity.llm.token_counts import count_tokens


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed tokenizer collection; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark, sf_dir):
    return remove_repeats(_t(spark, sf_dir, "documents"), window=20)


def op2_lm_scoring(spark, sf_dir):
    return score_texts(_t(spark, sf_dir, "documents"), folds=10)


def op3_sharding(spark, sf_dir):
    return assign_shards(_t(spark, sf_dir, "documents"))


def op4_bpe(spark, sf_dir):
    return encode_texts(_t(spark, sf_dir, "documents"), vocabulary_path(), digest=True)


def op5_license_scan(spark, sf_dir):
    """Documents have no path of their own: source, language and a run of a thousand ids stand for directories."""
    run = F.floor(F.col("doc_id") / 1000).cast("string")
    path = F.concat_ws("/", "source", "lang", run, F.col("doc_id").cast("string"))
    return scan_licenses(_t(spark, sf_dir, "documents"), path)


def op6_quality(spark, sf_dir):
    return score_quality(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), folds=5, threshold=0.3)


def op7_nearest(spark, sf_dir):
    return nearest(_t(spark, sf_dir, "embeddings"), query_mod=100, k=10)


def op8_jaccard_join(spark, sf_dir):
    return near_duplicates(_t(spark, sf_dir, "documents"), shingle=3, percent=90)


def op9_secret_scan(spark, sf_dir):
    return scan_secrets(_t(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return find_leaks(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark, sf_dir):
    return search(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), k=10)


def op12_token_counts(spark, sf_dir):
    return count_tokens(_t(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"), limit=4096)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark, sf_dir):
    """Rows whose id's crc32 is a multiple of five are tampered with: their text's A-Z become lower case."""
    docs = _t(spark, sf_dir, "documents")
    return dataset_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                            {"text": F.translate(docs["text"], _UPPER, _LOWER)}, crc_bucket(docs["doc_id"], 5) == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_lm_scoring, op3_sharding, op4_bpe, op5_license_scan, op6_quality,
                            op7_nearest, op8_jaccard_join, op9_secret_scan, op10_decontamination, op11_lexical_search,
                            op12_token_counts, op13_merkle_manifest)}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {"op11_lexical_search": LEXICAL_SEARCH, "op13_merkle_manifest": MERKLE_MANIFEST}
