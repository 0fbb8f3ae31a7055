"""The registered queries: each operator over its whole table, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelens.llm.common import on_workers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return on_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.suffix_dedup import removal_digest

    return removal_digest(_table(spark, sf_dir, "documents"), texts=True)


def op2_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.html_wrapper import main_texts

    return main_texts(_table(spark, sf_dir, "pages"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.token_store import token_digest

    return token_digest(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.quotes import conversations

    return conversations(_table(spark, sf_dir, "conversations"))


def op5_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.shards import shard_digest

    return shard_digest(_table(spark, sf_dir, "documents"))


def op6_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.pieces import piece_digest

    return piece_digest(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op7_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.weak_quality import judgements

    return judgements(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.range_join import cosine_links

    return cosine_links(_table(spark, sf_dir, "embeddings"))


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.shingle_join import shingle_components

    return shingle_components(_table(spark, sf_dir, "documents"))


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.decontaminate import leak_digest

    return leak_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.prefix_trie import prefix_trie

    return prefix_trie(_table(spark, sf_dir, "conversations")).drop("node")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.fill_middle import middle_digest

    return middle_digest(_table(spark, sf_dir, "documents"))


def op13_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.packing import packed_pieces

    return packed_pieces(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from carelens.llm.fill_middle import MIDDLE_SQL
    from carelens.llm.prefix_trie import TRIE_SQL

    return {"op11_prefix_trie": TRIE_SQL, "op12_fill_in_middle": MIDDLE_SQL}
