"""The corpus pipeline: documents in, tokenised documents out, one operator per stage.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given.  All but the last
return the columns of ``documents``:

1. quality classifier: documents it rejects go;
2. line dedup: later occurrences of three-line windows go from the texts, and n_chars follows;
3. MinHash near-dedup: of each class of near copies the least doc_id stays;
4. benchmark decontamination: documents that hold a passage close to a benchmark item go;
5. byte-level BPE: doc_id, n_tokens, ids, and decoded, the text read back from the ids.

Rows with a null doc_id are kept apart by their text where a stage needs an id, and go or stay
like others; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.llm import bpe, decontam, lines, near_dedup, quality
from plotloom.operators.sizing import cut_lineage


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.classify(docs).where("keep").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(docs)
    # A text without removals keeps its figure as it was.
    figure = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return kept.withColumn("n_chars", figure).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, pattern = bpe.default_tokenizer()
    # Materialised, so that no task holds a Python worker that encodes and one that decodes at once, and
    # whole texts go to Python in short batches.
    encoded = cut_lineage(bpe.encode(docs, ranks, pattern))
    found = bpe.decode(encoded, ranks)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string"))


STAGES = [
    ("quality", keep_good_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_and_decode),
]

# The quality scorer, edit distances and byte pairs are beyond SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another on ``documents``, each materialised for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
