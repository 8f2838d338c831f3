"""Removal of lines that many documents share: explode, hash, count documents, drop, reassemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

#: Blank and the controls from tab to carriage return.
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    # lower() is much faster than translate(), and the same for text of one-byte characters.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """What makes two lines equal: no white space at either end, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def drop_shared_lines(
    docs: DataFrame,
    max_docs: int = 1,
    min_length: int = 10,
    keep_first: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Drop the lines whose key more than ``max_docs`` documents hold; add counts and the text that stays.

    Keys shorter than ``min_length`` code points are never dropped. With ``keep_first`` the
    document with the smallest id keeps its lines of a key. Adds ``n_lines`` (before),
    ``n_dropped`` and ``kept_text`` (the other lines joined by newlines; null where all were
    dropped) to all columns of ``docs``; columns of these names are replaced.

    A null or empty text is one empty line. Rows of equal id count as one document; those
    without an id count as one document that comes last. An empty table gives no rows.

    Keys are counted from (hash, smallest id, number) partial sums, so a line that is in
    every document is one row per task. Only hashes and positions are shuffled, and the
    texts once, by row hash, to take their dropped positions.
    """
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    whole = docs.withColumn("__row", F.xxhash64(F.col(id_col), F.col(text_col)))
    doc = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))
    lines = whole.select(
        "__row",
        doc.alias("__doc"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("__pos", "__line"),
    )
    keyed = lines.withColumn("__key", line_key(F.col("__line"))).where(F.char_length("__key") >= min_length)
    keyed = keyed.select(
        F.xxhash64("__key").alias("__h"), F.hash("__key").alias("__h2"), "__row", "__doc", "__pos"
    )
    if max_docs == 1:
        counted = keyed.groupBy("__h", "__h2").agg(F.min("__doc").alias("__first"), F.max("__doc").alias("__last"))
        shared = counted.where(F.col("__first") != F.col("__last")).select("__h", "__h2", "__first")
    else:
        # One row per key and document first: a distinct count that sums in two steps.
        once = keyed.select("__h", "__h2", "__doc").distinct()
        counted = once.groupBy("__h", "__h2").agg(F.min("__doc").alias("__first"), F.count(F.lit(1)).alias("__docs"))
        shared = counted.where(F.col("__docs") > max_docs).select("__h", "__h2", "__first")
    # Stored, so that the join shuffles both sides and can split a line that a third of all documents hold.
    hit = keyed.join(stored(shared, "shared-lines"), ["__h", "__h2"])
    if keep_first:
        hit = hit.where(F.col("__doc") != F.col("__first"))
    dropped = hit.groupBy("__row").agg(F.collect_set("__pos").alias("__dropped"))
    joined = whole.join(dropped, "__row", "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = F.split(text, "\n", -1)
    size = F.size(split)
    # array_except hashes its second array, so the work is linear in the number of lines.
    stay = F.array_except(F.sequence(F.lit(0), size - 1), F.col("__dropped"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    gone = F.coalesce(F.size("__dropped"), F.lit(0))
    gone = F.when(F.col("__dropped").isNull(), F.lit(0)).otherwise(gone)
    return joined.withColumns(
        {
            "n_lines": size.cast("long"),
            "n_dropped": gone.cast("long"),
            "kept_text": F.when(F.col("__dropped").isNull(), text)
            .when(gone == size, F.lit(None).cast("string"))
            .otherwise(kept),
        }
    ).drop("__row", "__dropped")
