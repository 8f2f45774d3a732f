"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``; other columns of the
input are carried along, whatever their names.  An empty table gives an empty one.
Texts are worked on whole, at any length.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.llm import mixing, packing, repetition, simhash_pivots, site_lines  # noqa: E402
from barloom.llm.common import scratch_path  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A source holds more various texts than a site, so its shared lines are on fewer of its documents.
LINE_RATIO = 0.06


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    A null or empty text has no words and goes; repeated rows are judged alike; null ids and sources do not matter.
    """
    return repetition.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on over ``LINE_RATIO`` of a source's documents (the source is the host) go; no document does.

    A null source is a source; a null text stays null, an empty one empty; repeated rows count each.
    A document may end up without lines: its text is then empty.
    """
    out = site_lines.drop_site_lines(docs, "source", "text", ["doc_id"], max_ratio=LINE_RATIO)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id.

    Null ids come last, ties go to the smallest content key, repeated rows become one.  Null and empty texts
    have fingerprint zero and are copies of each other.
    """
    return simhash_pivots.keep_one(docs, shingle=4, limit=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents in the number of copies its budget takes; the one at the cut is shortened to it.

    A null source is a source; null and empty texts weigh nothing and are left out.  Equal hashes are ordered by
    content, so reruns agree; repeated rows are taken each.
    """
    return mixing.apply_mix(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in bins; copies of one document never share a bin.

    A long document gives several pieces.  Null and empty texts have one row of size 0 without a bin; null ids are
    copies of each other; a null source is a source.
    """
    sized = docs.select("doc_id", "source", mixing.n_words("text").alias("n_words"), F.xxhash64("doc_id").alias("cluster"))
    return packing.pack(sized, "n_words", "source", "cluster")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("mix sources", mix_sources),
    ("best-fit packing", pack_bins),
]

#: SimHash needs XXH64, which DuckDB lacks; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{i}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
