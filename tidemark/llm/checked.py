"""The checked queries of this subpackage, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bestfit, jaccard, langid, lexical, licenses, lines, lm, mixing, packing, prefixes, quality, substring, topk

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL if there is one."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Least mean log ratio of n-grams of a document that is kept.
QUALITY_THRESHOLD = -0.3

#: White space of the contracts, for SQL.
SPACES_SQL = r"[\x20\x09-\x0D]"

PASSAGE_SQL = rf"""
with w as (
    select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as pos
    from (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES_SQL}+'), lambda x: x <> '') as ws
          from documents)
), g as (
    select doc_id, pos, list(word) over (partition by doc_id order by pos rows between current row and 19 following) as ws
    from w
), k as (
    select doc_id, pos, row_number() over (partition by ws order by doc_id, pos) > 1 as again
    from g where len(ws) = 20
), m as (
    select w.doc_id, w.pos, w.word,
           coalesce(max(k.again) over (partition by w.doc_id order by w.pos rows between 19 preceding and current row),
                    false) as gone
    from w left join k on w.doc_id = k.doc_id and w.pos = k.pos
)
select d.doc_id, count(m.pos) as n_words, count(m.pos) filter (m.gone) as n_removed,
       sha256(coalesce(string_agg(m.word, ' ' order by m.pos) filter (not m.gone), '')) as kept_sha256
from documents d left join m on d.doc_id = m.doc_id group by d.doc_id
"""

LINES_SQL = r"""
with l as (
    select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
), k as (
    select doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from l
), s as (
    select key, min(doc_id) as first_doc from k where length(key) >= 10 group by key having count(distinct doc_id) > 1
), m as (
    select k.*, s.first_doc is not null and s.first_doc <> k.doc_id as gone from k left join s on k.key = s.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""


@checked("op4_substring_dedup", PASSAGE_SQL)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words cut as parts of passages of 20 words that occur earlier."""
    out = substring.remove_repeated_passages(table(spark, sf_dir, "documents"), width=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@checked("op5_line_dedup", LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 10 code points that an earlier document has too, dropped."""
    out = lines.drop_shared_lines(table(spark, sf_dir, "documents"), max_docs=1, min_length=10)
    kept = F.sha2(F.coalesce("kept_text", F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


TOP_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""

NEAR_SQL = rf"""
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACES_SQL}+'),
        lambda x: x <> '') as ws
    from documents
), g as (
    select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s
    from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w where len(ws) > 0)
), n as (select doc_id, count(*) as n from g group by doc_id
), b as (
    select x.doc_id as a, y.doc_id as b, count(*) as both from g x join g y on x.s = y.s and x.doc_id <> y.doc_id group by 1, 2
), l as (
    select b.a, b.b, b.both = p.n and b.both = q.n as same
    from b join n p on b.a = p.doc_id join n q on b.b = q.doc_id where 5 * b.both >= 4 * (p.n + q.n - b.both)
), r as (
    select doc_id as node, doc_id as root from documents
    union
    select l.b as node, r.root from r join l on r.node = l.a
), m as (select node, min(root) as group_id from r group by node
), c as (
    select a, min(b) filter (same) as twin, count(*) filter (same) as twins, count(*) as links from l group by a
)
select d.doc_id, least(d.doc_id, coalesce(c.twin, d.doc_id)) as class_id, m.group_id,
       1 + coalesce(c.twins, 0) as n_copies, coalesce(c.links, 0) as n_links
from documents d join m on d.doc_id = m.node left join c on d.doc_id = c.a
"""


@checked("op1_exact_topk", TOP_SQL)
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows by whole-number inner product for every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@checked("op3_ngram_jaccard", NEAR_SQL)
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text class, near-duplicate group and links of every document, at 0.8 over runs of five words."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8, width=5)


@checked("op10_mix_sources")
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot when sources are interleaved by the square root of their size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs, block_rows=16, power=0.5)


@checked("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symptom counts and the likelihood-ratio verdict of every document."""
    labels = table(spark, sf_dir, "labels")
    trusted = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0))
    out = quality.quality_rules(table(spark, sf_dir, "documents"), trusted, threshold=QUALITY_THRESHOLD)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


@checked("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    out = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    start = F.transform(base, lambda p: p["start"].cast("long"))
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    best = F.array_max(F.transform("places", lambda p: p["score"]))
    return out.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )


def id_remainder(n: int):
    """crc32 of the id as text, modulo ``n``; a missing id is the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def packed_pieces(docs: DataFrame, order_by: tuple[str, ...] = ()) -> DataFrame:
    """Token pieces of documents by the 50,257-word byte vocabulary, with digests, packed into windows of 1024.

    Pieces of equal length take their places by ``doc_id``. With ``order_by``, columns of ``docs`` that
    are not in the result (their names must not begin with ``__``), they do so in that order, and windows are numbered by their first piece in it.
    """
    import public_tokenizers as public

    pieces = packing.cut_pieces(
        docs.select("doc_id", "text", *order_by),
        public.path("byte_bpe_50k.json"),
        window=1024,
        end_id=0,
        ranks=public.path("byte_bpe_50k.tiktoken"),
        pattern=public.PATTERN,
    )
    ids = F.crc32("ids").alias("ids_crc32")
    digests = pieces.select("doc_id", "start", "length", ids, "doc_tokens", *order_by)
    if not order_by:
        return packing.pack_pieces(digests, ["doc_id", "start"], window=1024)
    order = [*order_by, "start"]
    packed = packing.pack_pieces(digests, order, window=1024)
    return packing.sequences_in_order(packed, order).drop(*order_by)


@checked("op2_pack_tokens")
def op2_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces and their places in windows."""
    return packed_pieces(table(spark, sf_dir, "documents"))


@checked("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third of them, by id, is held out of learning."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder(3) == 1)
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@checked("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by single tokens and by the model; a seventh is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder(7) == 2
    model, counts = lm.train(docs.where(~held_out))
    out = lm.score_texts(docs, model, counts)
    return out.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@checked("op12_best_fit_packing")
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents by the word vocabulary, packed best-fit into windows of 2048."""
    import public_tokenizers as public

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = bestfit.cut_long_texts(docs, public.path("word_bpe_49k.json"), window=2048, end_id=0)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return bestfit.pack_best_fit(digests, window=2048)


LEXICAL_SQL = r"""
with w as (
    select doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select *, row_number() over () as row from documents)
), d as (select row, count(*) as n from w group by row
), t as (select (select count(*) from d)::bigint as nn, (select sum(n) from d)::bigint as ll
), f as (select row, any_value(doc_id) as doc_id, term, count(*) as tf from w group by row, term
), g as (select term, count(*) as df from f group by term
), i as (
    select item_id, term, count(*) as reps from (
        select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark)
    group by item_id, term
), s as (
    select i.item_id, f.row, any_value(f.doc_id) as doc_id,
           sum(i.reps * floor(1000 * ln((2 * t.nn + 2)::double / (2 * g.df + 1)::double))::bigint
               * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (25 + (75 * d.n * t.nn) // t.ll))))::bigint as score
    from i join f on i.term = f.term join g on f.term = g.term join d on f.row = d.row cross join t group by i.item_id, f.row
)
select item_id, rank::int as rank, doc_id, score from (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0
) where rank <= 10
"""


@checked("op11_lexical_search", LEXICAL_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item by its terms."""
    return lexical.rank_documents(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=10)


TRIE_SQL = """
with tab as (
    select list(list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)
                order by n) as t
    from (select unnest(range(256)) as n)
), o as (
    select conv_id as c, row_number() over (partition by conv_id
               order by turn nulls first, md5(md5(coalesce(text, '')) || coalesce(role, ''))) as i,
           coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
), c as (
    select c, c - c % 5 as b,
           xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
               lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1]))) % 9 as h
    from (select distinct c from o), tab
), r as (
    select c.c, o.i, 0 as own, o.role, o.text from c join o on o.c = c.b and o.i <= c.h
    union all
    select c.c, o.i, 1 as own, o.role, o.text from c join o on o.c = c.c and o.i > c.h
), s as (
    select c, row_number() over w as depth, strlen(text) as bytes,
           list(md5(md5(text) || role)) over (w rows between unbounded preceding and current row) as path
    from r window w as (partition by c order by own, i)
), d as (select c.c, coalesce(max(s.depth), 0) as depths from c left join s on s.c = c.c group by c.c
), p as (select c, depth, bytes, path, path[:-2] as above from s
         union all select c, 0, 0, [], null from c
), n as (
    select depth, path, any_value(above) as above, min(p.c) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
           sha256(coalesce(string_agg(p.c::varchar, ',' order by p.c) filter (d.depths = p.depth), '')) as ends_sha256
    from p join d on d.c = p.c group by depth, path
), k as (
    select n.*, a.conv_id as parent_conv_id, (select count(*) from n x where x.depth = n.depth + 1 and x.above = n.path) as n_children
    from n left join n a on a.depth = n.depth - 1 and a.path = n.above
), m as (
    select p.depth, p.path, count(*) filter (x.n_children = 0) as n_leaves, sum((x.n_convs - 1) * x.bytes) as saved_tokens
    from k x join p on p.c = x.conv_id and p.depth <= x.depth group by p.depth, p.path
)
select k.conv_id, k.depth::bigint as depth, k.parent_conv_id, k.n_convs, k.n_children, m.n_leaves,
       m.saved_tokens::bigint as saved_tokens, k.ends_sha256
from k join m on m.depth = k.depth and m.path = k.path
"""


@checked("op13_prefix_trie", TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with up to eight turns of another one."""
    conv = F.col("conv")
    return prefixes.prefix_trie(
        table(spark, sf_dir, "conversations"),
        shared_with=conv - conv % 5,
        shared_turns=F.crc32(conv.cast("string")) % 9,
        most_shared=8,
    )
