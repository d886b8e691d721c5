"""The registered queries of this subpackage and the SQL that states them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    graph_search,
    importance,
    lexical_search,
    lm_scoring,
    ngram_join,
    packing,
    personal_data,
    piece_sampling,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
    vector_dedup,
)
from millrace.llm.shared import id_crc, table, text_key


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``; those whose id's crc32 modulo 5 is 1 are held out of training."""
    held_out = F.pmod(id_crc("doc_id"), F.lit(5)) == 1
    return lm_scoring.score(table(spark, sf_dir, "documents"), ["doc_id"], held_out)


def op2_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every text of ``documents``."""
    found = piece_sampling.sample_segmentations(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        "sample",
        "ids",
        "round_trip",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_probability",
        "perturbed",
        "inclusion",
        "log_inclusion",
    )


def op3_lz_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` without the words of repeated 35-word windows."""
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return cut.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of all ``embeddings`` to each whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return graph_search.nearest(vectors, F.col("vec_id") % 50 == 0)


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, packed by their words and one end each."""
    lengths = packing.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"])
    return packing.pack(lengths)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: 4-word shingles, linked from a Jaccard similarity of 0.85."""
    docs = table(spark, sf_dir, "documents")
    found = ngram_join.jaccard_components(docs, ["doc_id"])
    return found.select("doc_id", "n_shingles", "component_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all of ``documents``: base patterns and what the character models add."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, by labels of those whose id's crc32 modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(id_crc("doc_id"), F.lit(4)) == 2
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic")
    scored = toxicity.score_texts(docs, ["doc_id"], toxicity.train_model(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings`` of equal label, linked from a cosine of 0.98."""
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), ["vec_id"])


SHARDS = 40


def op10_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in 40 shards of near equal bytes, equal texts together."""
    text = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key().alias("_text"),
    )
    placed = sharding.shard_rows(sized, "_text", "size", SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, a tenth drawn by likeness to all ``benchmark`` texts."""
    target = table(spark, sf_dir, "benchmark")
    return importance.resample(table(spark, sf_dir, "documents"), target)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all ``documents`` for each ``benchmark`` item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all of ``documents``: base patterns and what scores add to them."""
    found = personal_data.find_personal(table(spark, sf_dir, "documents"), ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*personal_data.BASE))
    return found.select(
        "doc_id",
        *[count(kind) for kind in personal_data.BASE],
        F.sha2(personal_data.joined(base), 256).alias("base_sha256"),
        personal_data.joined(F.col("spans")).alias("spans"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_piece_sampling": op2_piece_sampling,
        "op3_lz_substrings": op3_lz_substrings,
        "op4_graph_search": op4_graph_search,
        "op5_length_buckets": op5_length_buckets,
        "op6_ngram_join": op6_ngram_join,
        "op7_secret_scan": op7_secret_scan,
        "op8_toxicity": op8_toxicity,
        "op9_vector_dedup": op9_vector_dedup,
        "pipeline": pipeline,
        "op10_histogram_sort": op10_histogram_sort,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_lexical_search": op12_lexical_search,
        "op13_personal_data": op13_personal_data,
    }


_WORDS = "[^\x20\x09-\x0D]+"

OP3_SQL = rf"""
with texts as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(coalesce(text, ''), '{_WORDS}') as w from documents),
starts as (select r, unnest(range(1, len(w) - 33)) as i from texts where len(w) >= 35),
windows as (
    select r, i, count(*) over (partition by array_to_string(w[i:i + 34], ' ')) as n
    from starts join texts using (r)),
gone as (select distinct r, unnest(range(i, i + 35)) as p from windows where n > 1),
words as (select r, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from texts),
rest as (
    select words.r, string_agg(word, ' ' order by words.p) as kept_text, count(*) as n
    from words left join gone on words.r = gone.r and words.p = gone.p
    where gone.r is null group by words.r)
select doc_id, cast(len(w) as bigint) as n_words,
    cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
    sha256(coalesce(kept_text, '')) as kept_sha256
from texts left join rest using (r)
"""

OP6_SQL = rf"""
with recursive texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as w
    from documents),
sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
    from texts),
shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
common as (
    select a.doc_id as x, b.doc_id as y, any_value(a.n) as m, any_value(b.n) as n, count(*) as k
    from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id group by x, y),
links as (select x, y from common where 100 * k >= 85 * (m + n - k)),
reach as (select doc_id, doc_id as c from sets union select x, c from links join reach on y = doc_id)
select doc_id, len(s) as n_shingles, component_id
from sets join (select doc_id, min(c) as component_id from reach group by doc_id) using (doc_id)
"""

OP9_SQL = """
with recursive valid as (
    select vec_id, label, cast(embedding as double[]) as v from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null
        or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select a.vec_id as x, b.vec_id as y from valid a join valid b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.98),
reach as (select vec_id, vec_id as c from embeddings union select x, c from links join reach on y = vec_id)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from (select vec_id, min(c) as component_id from reach group by vec_id)
left join (select x as vec_id, count(*) as n from links group by x) using (vec_id)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# A checksum byte by byte: the table of 256 remainders is derived from the polynomial.
OP11_SQL = rf"""
with remainders as (
    select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
source as (
    select row_number() over () as r, doc_id,
        regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
target as (
    select unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as f from benchmark),
runs as (select r, unnest(w) as f from source),
features as (select distinct f from runs union select distinct f from target),
bytes as (
    select f, list_transform(range(1, length(hex(encode(f))), 2),
        lambda p: cast('0x' || substr(hex(encode(f)), p, 2) as bigint)) as b from features),
buckets as (
    select f, xor(list_reduce(list_prepend(4294967295, b),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as k
    from bytes, remainders),
s as (select k, count(*) as n from runs join buckets using (f) group by k),
t as (select k, count(*) as n from target join buckets using (f) group by k),
gains as (
    select k, cast(floor(1000 * ln((coalesce(t.n, 0) + 1) * ((select count(*) from runs) + 10000)
        / ((coalesce(s.n, 0) + 1) * ((select count(*) from target) + 10000)))) as bigint) as g
    from (select unnest(range(10000)) as k) left join s using (k) left join t using (k)),
weights as (
    select r, cast(sum(g) as bigint) as weight from runs join buckets using (f) join gains using (k) group by r),
scored as (
    select r, doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:'
            || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5::double) / 4294967296)))
            as bigint) as score
    from source left join weights using (r)),
drawn as (
    select r, row_number() over (order by score desc, doc_id, r) as rank from scored where n_features >= 20
    qualify rank <= 10 * count(*) over () // 100)
select doc_id, n_features, weight, score, rank from scored left join drawn using (r)
"""

OP12_SQL = rf"""
with terms as (
    select r, doc_id, unnest(w) as t, len(w) as n from (
        select row_number() over () as r, doc_id, regexp_extract_all({_LOWER},
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents)),
counts as (select r, doc_id, t, any_value(n) as n, count(*) as tf from terms group by r, doc_id, t),
total as (select count(distinct r) as n_docs, count(*) as n_terms from terms),
held as (select t, count(*) as df from counts group by t),
asked as (
    select i, item_id, t, count(*) as times from (
        select i, item_id, unnest(regexp_extract_all({_LOWER},
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
        from (select row_number() over () as i, item_id, text from benchmark)) group by i, item_id, t),
paid as (
    select i, item_id, t, times * cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as pay
    from asked join held using (t), total),
scores as (
    select i, item_id, r, doc_id, cast(sum(pay * ((1000000000 * tf)
        // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) as bigint) as score
    from paid join counts using (t), total group by i, item_id, r, doc_id)
select item_id, cast(row_number() over (partition by i order by score desc, doc_id, r) as integer) as rank,
    doc_id, score
from scores where score > 0 qualify rank <= 20
"""


def llm_oracle_sql() -> dict[str, str]:
    """The SQL of those queries that SQL can state; tests hold the others against brute force."""
    return {
        "op3_lz_substrings": OP3_SQL,
        "op6_ngram_join": OP6_SQL,
        "op9_vector_dedup": OP9_SQL,
        "op11_importance_resampling": OP11_SQL,
        "op12_lexical_search": OP12_SQL,
    }
