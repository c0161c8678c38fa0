"""A corpus from documents to packed sequences: quality, near duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.llm.ngram_join import jaccard_components
from fieldmark.llm.packing import packed_pieces
from fieldmark.llm.quality import quality_rules
from fieldmark.llm.queries import table, tokenizer_path
from fieldmark.llm.substring_dedup import remove_repeats
from fieldmark.session import settle

#: Near duplicates: words of a shingle, and percent of shingles in common.
SHINGLE, PERCENT = 5, 80
#: Words of a passage that goes where an earlier document has it.
PASSAGE = 50

#: SQL has no form of the tokenizer's ids; tests compare with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of smallest id.

    Of rows that repeat an id the smallest by all columns stays; rows without an id stay.
    """
    placed = settle(jaccard_components(docs, words=SHINGLE, percent=PERCENT).select("doc_id", "component_id"))
    later = placed.where("doc_id != component_id").select("doc_id")
    repeated = placed.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    gone = settle(later.union(repeated).distinct())
    single = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    first = (
        docs.join(settle(repeated.join(later, "doc_id", "left_anti")), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("row"))
    )
    return single.union(first.select("doc_id", "row.*").select(docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document has; a text that loses none stays as it is."""
    kept = remove_repeats(docs, words=PASSAGE, with_text=True)
    changed = F.col("n_removed") > 0
    kinds = dict(docs.dtypes)
    columns = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.length("kept_text").cast(kinds.get("n_chars", "int"))).otherwise(F.col("row.n_chars") if "n_chars" in kinds else F.lit(0)),
    }
    return kept.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packed_pieces(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
