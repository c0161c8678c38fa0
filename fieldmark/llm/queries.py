"""The operators of this subpackage as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sql import SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; those that SQL can express have it in ``sql.py`` under the same name."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the likelihood-ratio verdict of every document."""
    from .quality import quality_rules

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("score", 6).alias("score"),
    )


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and the component it links into."""
    from .ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that no earlier document's run of 50 covers."""
    from .substring_dedup import remove_repeats

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, words=50).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def tokenizer_path(name: str) -> str:
    """Where the file of a public tokenizer lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 2048."""
    from .packing import packed_pieces

    return packed_pieces(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op9_bpe_automaton")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, and of the text decoded from them."""
    from .bpe_automaton import coded_digests

    return coded_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back through their index."""
    from uuid import uuid4

    from fieldmark.session import shared_folder

    from .warc import read_records, write_archives

    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid4().hex}"
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_vector_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16, sizes near equal, and its slot there."""
    from .sharding import shards

    placed = shards(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op4_embedding_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, within its label."""
    from .near_vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from .html_text import main_text

    return main_text(table(spark, sf_dir, "pages"))


@query("op3_pseudo_likelihood")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's masked pseudo-likelihood under a network trained on all documents."""
    from .pseudo_likelihood import pseudo_likelihood

    return pseudo_likelihood(table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, whitened."""
    from .whitening import by_component, whiten

    return by_component(whiten(table(spark, sf_dir, "embeddings")))


@query("op12_piece_agenda")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's pieces, and of the text decoded from them."""
    from .piece_agenda import coded_digests

    return coded_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op13_fill_in_middle")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, as digests."""
    from .fill_in_middle import fill_in_middle, restored

    moved = restored(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return moved.select(
        "row.doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
