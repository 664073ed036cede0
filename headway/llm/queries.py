"""One query per operator, over its whole table and with production parameters, and the SQL of those
that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, forest, language, maintext, mixing, packing, periodic, pii, spotsigs, trie_lm, vafile, variants, warc
from headway.llm.shared import remainder, settle, table, text_or_empty

#: Vocabulary file that the queries encode with.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Rank file that texts are packed with, and the free id that fills the rows.
RANKS, PAD = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50_256

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every page to WARC archives and reads them back: one row per page."""
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    records = settle(
        read.select(
            "record_id",
            "record_type",
            "page_id",
            "refers_to",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("payload_digest"),
            "fault",
        ),
        "warc-read",
    )
    held = records.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("holder"),
        F.col("payload_bytes").alias("held_bytes"),
        F.col("payload_digest").alias("held_digest"),
    )
    revisits = records.where(F.col("record_type") == "revisit").join(held, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "fault"]
    return (
        records.where(F.col("record_type") != "revisit")
        .withColumn("refers_to", F.lit(None).cast("long"))
        .select(columns)
        .unionByName(
            revisits.select(
                "page_id",
                F.col("held_bytes").alias("payload_bytes"),
                F.col("held_digest").alias("payload_digest"),
                "record_type",
                F.col("holder").alias("refers_to"),
                "fault",
            )
        )
    )


ORACLES["op6_warc"] = """
with payloads as (
    select page_id, coalesce(html, '') as body from pages
), facts as (
    select page_id, octet_length(encode(body)) as n, sha1(encode(body)) as digest,
           max(page_id) over (partition by body) as largest
    from payloads
)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
       case when n >= 1000 and page_id <> largest then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> largest then largest end as refers_to,
       cast(null as varchar) as fault
from facts
"""


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows by integer inner product for every row whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", vafile.integer_vector(F.col("embedding"), 64).alias("embedding")
    )
    return vafile.exact_top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


ORACLES["op8_exact_top_k"] = """
with whole as (
    select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
    from embeddings
    where embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
    from whole q join whole c on c.vec_id <> q.vec_id
    where q.vec_id % 20 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
)
select query_id, cast(place as integer) as rank, vec_id, score from ranked where place <= 20
"""


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text: counts and digests of the ids and of the decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents: the class of each, and the number of its links."""
    return forest.near_duplicates(table(spark, sf_dir, "documents"))


# Rows are numbered: each is a document, also one whose id another row has.
ORACLES["op5_jaccard_join"] = r"""
with recursive numbered as materialized (
    select row_number() over () as r, doc_id, text from documents
), words as (
    select r, [w for w in string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[ \t\n\x0B\f\r]+') if w <> ''] as w
    from numbered where doc_id is not null
), shingles as (
    select distinct r, case when len(w) < 5 then array_to_string(w, ' ')
               else array_to_string(list_slice(w, i, i + 4), ' ') end as s
    from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)
), sizes as (
    select r, count(*) as n from shingles group by r
), common as (
    select a.r as a, b.r as b, count(*) as n
    from shingles a join shingles b on a.s = b.s and a.r <> b.r group by 1, 2
), links as (
    select a, b from common join sizes x on x.r = a join sizes y on y.r = b
    where common.n / (x.n + y.n - common.n) >= 0.8
), reached(a, b) as (
    select r, r from numbered
    union
    select r.a, l.b from reached r join links l on r.b = l.a
), classes as (
    select a, min(doc_id) as class_id from reached join numbered on r = b group by a
)
select d.doc_id, c.class_id, cast((select count(*) from links l where l.a = d.r) as bigint) as n_links
from numbered d join classes c on c.a = d.r
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the language of every text, learning from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = remainder(F.col("doc_id"), 4)
    model = language.train(docs.where(rest != 2))
    held_out = F.coalesce(rest == 2, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", "text", held_out), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base matches, and what the trained classifier adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    counts = [pii.base_count(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans")
    )


#: Powers that the observed shares are raised to: sources and languages move towards each other.
MIX_POWER = {"source": 0.7, "lang": 0.7, "topic": 0.9}


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, probability and draw of every document of the fitted mix."""
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_POWER, budget=0.5)


@query
def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they and the next one's are."""
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("signatures")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "length_part",
    )


@query
def op10_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every text by a trie of the n-grams of the texts that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trie, words = trie_lm.build(docs.where(remainder(F.col("doc_id"), 7) != 2))
    scores = trie_lm.score(docs, trie, words)
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return scores.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(trie.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in packed rows of 2048 byte-level ids: one row per packed row, with digests of
    its ids and positions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = packing.token_ids(F.col("text"), RANKS, public_tokenizers.PATTERN)
    blocks = packing.pack(docs.select("doc_id", ids.alias("token_ids")), pad=PAD)
    return packing.rows_of(blocks).select(
        "block_id",
        "row",
        F.element_at("cu_seqlens", -1).cast("long").alias("n_tokens"),
        "doc_ids",
        "starts",
        "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"),
    )


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text, one in ten with a tail that repeats, and what is left without them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = docs.select("doc_id", periodic.stuttered(text_or_empty(F.col("text")), F.col("doc_id")).alias("text"))
    found = periodic.with_runs(edited)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = periodic.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best")["length"] / F.col("best")["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, one in 31 with a letter left out, with their near words, forms and roots."""
    docs = table(spark, sf_dir, "documents")
    return variants.variants(variants.word_counts(docs, slips=31))


@query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return maintext.with_main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
