"""The registered queries of this subpackage and their DuckDB SQL.  Each reads
its whole table and returns the operator's full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, cluster, decontaminate, exact, imatch, langid, lexical, linededup, near, packing, substring, urls
from .common import prepare

_OPERATORS = {
    "op1_preference_chat": ("conversations", chat.digest),
    "op2_ecoc_language_id": ("documents", langid.digest),
    "op3_imatch_fingerprints": ("documents", imatch.digest),
    "op4_winnowed_line_dedup": ("documents", linededup.digest),
    "op5_tiktoken_bpe": ("documents", bpe.digest),
    "op6_best_fit_packing": ("documents", packing.digest),
    "op7_extendible_hash_dedup": ("documents", exact.digest),
    "op8_odd_sketch_near_dedup": ("documents", near.digest),
    "op9_boosted_url_filter": ("pages", urls.digest),
    "op10_rabin_karp_substring_dedup": ("documents", substring.digest),
    "op11_prefix_decontamination": ("documents benchmark", decontaminate.digest),
    "op12_lemp_lexical_search": ("documents benchmark", lexical.digest),
    "op13_hilbert_centroid_clustering": ("embeddings", cluster.digest),
}


def _query(tables: str, operator: Callable[..., DataFrame]):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return operator(*[spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables.split()])

    return build


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _query(tables, operator) for name, (tables, operator) in _OPERATORS.items()} | {"pipeline": _pipeline}

#: The other operators have no SQL form (models, tokenizers, hashes of our
#: own); their tests compare them with brute force.
ORACLES: dict[str, str] = {
    "op1_preference_chat": chat.SQL,
    "op4_winnowed_line_dedup": linededup.SQL,
    "op7_extendible_hash_dedup": exact.SQL,
    "op8_odd_sketch_near_dedup": near.SQL,
    "op10_rabin_karp_substring_dedup": substring.SQL,
    "op11_prefix_decontamination": decontaminate.SQL,
    "op12_lemp_lexical_search": lexical.SQL,
    "op13_hilbert_centroid_clustering": cluster.SQL,
}
