"""The corpus pipeline: documents that are fit to train on, once each, without what repeats or leaks, as pieces.

``run`` applies the stages to ``documents``; each stage's rows are stored as Parquet and read again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import on_workers, stored, whole_text
from carelens.llm.decontaminate import without_leaks
from carelens.llm.pieces import encode_column
from carelens.llm.shingle_join import shingle_components
from carelens.llm.suffix_dedup import without_repeats
from carelens.llm.weak_quality import accepted

#: Bytes of a repeated passage: passages of over 50 words hold 230 bytes or more.
PASSAGE = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that either scorer rejects (low quality, toxic) go; NULL texts count as empty.

    Each row is judged by its own text, whether it repeats a doc_id or has none; an empty table gives no rows.
    """
    return accepted(docs, on_workers(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the one of least doc_id stays, rows that repeat it once.

    Documents without a doc_id or without words are linked with nothing and stay.  Where a doc_id has rows with different
    texts, what stays of it is one row of each text; which of equal rows that is, is open.  An empty table gives no rows.
    """
    on_workers(spark)
    groups = shingle_components(docs.select("doc_id", "text"))
    kept = stored(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    return docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns).union(
        docs.where("doc_id is null")
    )


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: bytes of passages that start anywhere else too go from the text; n_chars follows.

    Every row is a document of its own, so repeated rows empty one another; a NULL text stays NULL, and no row goes.
    """
    on_workers(spark)
    return _counted(without_repeats(docs, PASSAGE))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item, also with other numbers, names or units, go.

    Each row is judged by its own text; NULL and empty texts hold nothing and stay; without items all rows stay.
    """
    return without_leaks(docs, on_workers(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: the ids of every document's pieces in place of its text.

    NULL and empty texts have no ids; each row is coded on its own, and an empty table gives no rows.
    """
    import public_tokenizers

    on_workers(spark)
    rows = docs.withColumn("text", whole_text())
    return encode_column(rows, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", passages),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding", pieces),
]

#: The stages train a model and merge sorted texts: no SQL gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = on_workers(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
