"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's docs. All
but the last return the columns of `documents`. doc_id names a document; rows without one pass the stages that compare ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm import chaining, language, packing, parity, tiling
from lumenforge.llm.shared import scratch_path, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no learned language, go: so do null and empty texts. Repeated rows are told each on its own;
    an empty table stays empty, and without labelled rows no language is learned and every document goes."""
    model = language.train(docs.filter(~language.held_out()))
    return language.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 of five-word shingles, one row of the smallest doc_id stays.

    Rows may share a doc_id: each is kept or removed by its own place in the stage's input files. Empty texts, and rows without
    a doc_id, are linked with nothing and stay; an empty table stays empty.
    """
    file, row = "_metadata.file_path", "_metadata.row_index"
    places = docs.select("doc_id", "text", F.xxhash64(file).alias("file"), F.col(row).alias("row"))
    groups = parity.near_duplicates(places, k=5, num=80, den=100, keep=("file", "row"))
    member = F.struct("doc_id", "file", "row")
    # what goes: all but the least of each group of several, by a table of the groups that have several
    several = groups.filter("component_id IS NOT NULL AND n_shingles > 0").groupBy("component_id").agg(F.min(member).alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    gone = written(groups.filter("n_shingles > 0").join(several, "component_id").filter(member != F.col("least")).select("file", "row"), "near-duplicates")
    named = docs.withColumn("file ", F.xxhash64(file)).withColumn("row ", F.col(row))
    return named.join(gone, (named["file "] == gone["file"]) & (named["row "] == gone["row"]), "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document holds are cut; the first document keeps them.

    The earlier is the one of the smaller doc_id; rows that share one are told apart by their place in the stage's input files and come
    before all others. Null and empty texts, and rows without a doc_id, pass as they are; an empty table stays empty.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return chaining.without_passages(docs, F.lit(-(1 << 62)) - F.pmod(place, F.lit(1 << 62)))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go. Null and empty texts leak nothing and stay; repeated rows go or stay alike; without
    items, or items of five words, all stay."""
    return tiling.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a document, with its sequence of at most 4096 tokens and its place there. A null or empty text is its end id
    alone; rows that share a doc_id are packed each on its own."""
    import public_tokenizers

    pieces = written(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 1), "pieces")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: SQL cannot express the stages: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
