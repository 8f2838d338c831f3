"""A corpus pipeline: quality rules, line dedup, near-duplicate removal, source mixing, packing.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and works on all that the
one before kept; its result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import checked, jaccard, lines, mixing, packing, quality  # noqa: E402
from tidemark.llm.storage import stored  # noqa: E402

#: No SQL: the likelihood ratio uses Spark's hash, and packing a numerical solver.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; trusted texts are those labelled good and not toxic."""
    labels = checked.table(spark, sf_dir, "labels")
    trusted = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    # The operator replaces columns it adds; the documents' own columns come back under their names.
    judged = quality.quality_rules(
        docs.select("doc_id", "text", F.struct("*").alias("__all")), trusted, checked.QUALITY_THRESHOLD
    )
    return judged.where("kept").select("__all.*")


def _set_apart(docs: DataFrame, *used: str) -> DataFrame:
    """The columns an operator works on, and all others in one, so that none has a name that it adds."""
    rest = [c for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*rest).alias("__rest")) if rest else docs.select(*used)


def _own(column: str, *used: str) -> Column:
    return F.col(column if column in used else f"__rest.`{column}`")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has too; those that lose all have an empty text."""
    cut = lines.drop_shared_lines(_set_apart(docs, "doc_id", "text"), max_docs=1, min_length=10)
    text = F.coalesce("kept_text", F.lit(""))
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, text).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        count = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, count).otherwise(F.col("__rest.n_chars"))
    return cut.select(*[new.get(c, _own(c, "doc_id")).alias(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every near-duplicate group; other texts under the same id stay, and one row without an id of a group that has none."""
    left = jaccard.one_of_each_group(_set_apart(docs, "doc_id", "text"), threshold=0.8, width=5)
    return left.select(*[_own(c, "doc_id", "text").alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of a mix of sources by the square root of their size."""
    mixed = mixing.mix_sources(_set_apart(docs, "doc_id", "source"), block_rows=16, power=0.5)
    order = ["slot", "place"]
    ordered = mixed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select(*[_own(c, "doc_id", "source").alias(c) for c in docs.columns])


def in_stored_order(docs: DataFrame) -> DataFrame:
    """Ids and texts, with ``at_part``, ``at_file`` and ``at_line``: by these, rows are in the order they were stored in.

    Spark reads files in any order, so that order is the number of the task that wrote a file, its name,
    and the row in it. Rows that are not read from files are in the order of the frame.
    """
    try:
        name, line = docs.select("_metadata.file_name", "_metadata.row_index").columns
    except AnalysisException:
        none = {"at_part": F.lit(0).cast("long"), "at_file": F.lit(""), "at_line": F.monotonically_increasing_id()}
        return docs.select("doc_id", "text").withColumns(none)
    part = F.regexp_extract(F.col(f"_metadata.{name}"), r"^part-(\d+)", 1).try_cast("long")
    at = [part.alias("at_part"), F.col("_metadata.file_path").alias("at_file"), F.col(f"_metadata.{line}").alias("at_line")]
    return docs.select("doc_id", "text", *at)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in windows of 1024 tokens.

    Pieces of equal length take their places in the order of the mix, and windows are numbered by it.
    """
    return checked.packed_pieces(in_stored_order(docs), ("at_part", "at_file", "at_line"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; the result of the last."""
    docs = checked.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
