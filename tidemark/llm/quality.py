"""Quality rules: counts of symptoms, and a likelihood ratio of hashed n-grams.

Trusted texts and the raw corpus are each a multinomial over hashed n-grams. A text's score is
the log-likelihood ratio of the two, divided by its number of n-grams; texts below a threshold
are rejected. Everything is DataFrame functions; n-gram counts are summed map-side, so a task
sends at most one row per hash bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.lines import WHITE
from tidemark.llm.storage import stored

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: Hash buckets for each order of n-grams, and the unit of the whole-number log ratios.
BUCKETS = 1 << 14
UNIT = 1_000_000


def words_of(text: Column, separators: str = SPACE) -> Column:
    """Maximal runs of other characters, as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators, -1), "")


def with_symptoms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the counts of :func:`quality_rules` and ``base_failed`` to texts with their ``__words``, which are dropped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__lines", F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    n = F.size("__words")
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.char_length(F.concat_ws("", "__words")).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        }
    )
    two = F.zip_with("__words", F.slice("__words", F.lit(2), n), lambda w, x: F.xxhash64(w, x))
    three = F.zip_with(two, F.slice("__words", F.lit(3), n), lambda g, x: F.xxhash64(g, x))
    out = out.withColumn("__grams", F.slice(three, F.lit(1), F.greatest(n - 2, F.lit(0))))
    # Equal windows stand together in order; most texts have none, and are not sorted.
    some = F.size(F.array_distinct("__grams")) < F.size("__grams")
    ordered = F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    out = out.withColumn("__sorted", F.when(some, ordered)).drop("__grams")
    gram = lambda i: F.get("__sorted", i)["g"]
    again = F.filter(
        "__sorted",
        lambda x, i: F.coalesce(x["g"] == gram(i - 1), F.lit(False)) | F.coalesce(x["g"] == gram(i + 1), F.lit(False)),
    )
    out = out.withColumn("__again", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.transform("__again", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__again", i + 1) - p, F.lit(3))))
    repeated = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    # Never null; but with it no filter on these columns moves below, where every step would be put
    # into the next one's lambda and the texts split again for each word.
    out = out.withColumn("n_repeat_words", F.when(F.monotonically_increasing_id() >= 0, repeated))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("__words", "__lines", "__sorted", "__again")


def tokens_of(text: Column) -> Column:
    """Runs of letters and digits, and runs of other signs, in order."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+", " $0 ")
    return F.array_remove(F.split(spaced, SPACE, -1), "")


def neighbours(words: Column) -> Column:
    """Each word ``w`` with the next one, ``x``; the last one's is null."""
    return F.arrays_zip(words.alias("w"), F.slice(words, F.lit(2), F.size(words)).alias("x"))


def ngram_buckets(pair: Column) -> tuple[Column, Column]:
    """Buckets of a word and of it with its neighbour; the second is null without one."""
    one = F.pmod(F.xxhash64(pair["w"]), F.lit(BUCKETS)).cast("int")
    two = F.pmod(F.xxhash64(pair["w"], pair["x"]), F.lit(BUCKETS)).cast("int") + BUCKETS
    return one, F.when(pair["x"].isNotNull(), two)


def ngram_weights(
    docs: DataFrame, trusted: DataFrame, max_trusted: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row, ``__weights``: per bucket the log ratio of its share in trusted texts to its share in all, in units.

    Counts of the corpus are over all texts. Of the trusted ids at most ``max_trusted`` are used,
    those with the smallest hashes; their number bounds the broadcast.
    """
    ids = trusted.select(F.col(id_col).alias("__id")).where(F.col("__id").isNotNull()).distinct()
    ids = ids.orderBy(F.xxhash64("__id"), "__id").limit(max_trusted).withColumn("__trusted", F.lit(1))
    marked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias(text_col))
    marked = marked.join(F.broadcast(ids), "__id", "left").select("__trusted", text_col)
    listed = marked.select("__trusted", tokens_of(F.col(text_col)).alias("__tokens"))
    # Rows and not lambdas: their hashes are in generated code.
    pairs = listed.select("__trusted", F.explode(neighbours(F.col("__tokens"))).alias("__pair"))
    rows = pairs.select("__trusted", F.explode(F.array(*ngram_buckets(F.col("__pair")))).alias("__bucket"))
    counts = rows.where(F.col("__bucket").isNotNull()).groupBy("__bucket").agg(
        F.count(F.lit(1)).alias("__all"), F.count("__trusted").alias("__good")
    )
    counts = stored(counts, "ngram-counts")
    two = (F.col("__bucket") >= BUCKETS).cast("int").alias("__order")
    total = counts.groupBy(two).agg(F.sum("__all").alias("__alls"), F.sum("__good").alias("__goods"))
    share = lambda n, of: (F.col(n) + 1) / (F.col(of) + BUCKETS)
    ratio = F.log(share("__good", "__goods") / share("__all", "__alls"))
    joined = counts.withColumn("__order", two).join(F.broadcast(total), "__order")
    weights = joined.select("__bucket", F.round(ratio * UNIT).cast("int").alias("__weight"))
    # One row with all weights in order: a fixed number of them.
    every = docs.sparkSession.range(2 * BUCKETS).select(F.col("id").cast("int").alias("__bucket"))
    pair = F.struct("__bucket", F.coalesce("__weight", F.lit(0)).alias("w"))
    listed = every.join(F.broadcast(weights), "__bucket", "left").agg(F.sort_array(F.collect_list(pair)).alias("all"))
    return listed.select(F.transform("all", lambda x: x["w"]).alias("__weights"))


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = -0.3,
    max_trusted: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Judge every document; nothing is left out, all columns of ``docs`` stay and these are added.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a word that are equal to an
    earlier one), ``n_repeat_words`` (words in windows of three that occur twice), ``base_failed``
    (under 50 words, or more than half of them repeated), ``llr`` (mean log ratio of the n-grams;
    null without any) and ``kept``: not failed, and ``llr`` at least ``threshold``. Columns of these
    names are replaced.

    ``trusted`` names trusted documents by ``id_col``. Ratios are whole numbers of 1/1,000,000, so sums
    do not depend on their order and equal texts get equal verdicts. Null texts count as empty,
    and so fail; documents without an id are judged like others but are never trusted; an empty
    table gives no rows. Texts are read once for the counts and once for verdicts; the weights, a row
    of fixed size, go to every task, and no document is shuffled.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")
    docs = docs.drop(*added)
    weights = F.broadcast(stored(ngram_weights(docs, trusted, max_trusted, id_col, text_col), "ngram-weights"))
    listed = docs.withColumns({"__words": words_of(F.col(text_col)), "__tokens": tokens_of(F.col(text_col))})
    pairs = listed.withColumn("__pairs", neighbours(F.col("__tokens"))).drop("__tokens").crossJoin(weights)

    def weight(pair: Column) -> Column:
        one, two = ngram_buckets(pair)
        return F.get("__weights", one) + F.coalesce(F.get("__weights", two), F.lit(0))

    total = F.aggregate("__pairs", F.lit(0).cast("long"), lambda a, pair: a + weight(pair))
    n_grams = 2 * F.size("__pairs") - 1  # of n words, and of n - 1 pairs
    llr = F.when(F.size("__pairs") > 0, total / n_grams / UNIT)
    judged = with_symptoms(pairs.withColumn("llr", llr).drop("__pairs", "__weights"), text_col)
    fine = F.coalesce(F.col("llr") >= threshold, F.lit(False))
    judged = judged.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(fine))
    return judged.select(*docs.columns, *added)
