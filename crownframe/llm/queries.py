"""One query per operator over whole tables; each takes (spark, sf_dir). SQL for DuckDB in ORACLE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownframe.llm import (arc_to_warc, byte_bpe, circulant_minhash, exact_dedup, fill_middle, html_text, language_id, metric_tree,
                            pattern_packing, separator_scan, simhash_trees, spelling_variants, token_store)
from crownframe.llm.shared import table


def op1_token_store(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    store = token_store.write_store(docs)
    return token_store.read_ids(store, token_store.all_keys(docs), with_ids=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


def op3_separator_scan(spark: SparkSession, sf: str) -> DataFrame:
    return separator_scan.token_counts(table(spark, sf, "documents"))


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(table(spark, sf, "documents"))


def op5_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


def op6_arc_to_warc(spark: SparkSession, sf: str) -> DataFrame:
    return arc_to_warc.convert(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash_trees(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_trees.near_dups(table(spark, sf, "documents"))


def op8_metric_tree(spark: SparkSession, sf: str) -> DataFrame:
    return metric_tree.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_pattern_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf, "documents"))


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf, "documents"))


def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf, "documents"))


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf, "documents"))


def op13_minhash_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    return circulant_minhash.near_dups(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_store, op2_exact_dedup, op3_separator_scan, op4_language_id, op5_html_text, op6_arc_to_warc,
    op7_simhash_trees, op8_metric_tree, op9_pattern_packing, op10_byte_bpe, op11_fill_middle,
    op12_spelling_variants, op13_minhash_near_dups)}

ORACLE = {
    "op2_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               row_number() over (partition by coalesce(text, '') order by doc_id desc) = 1 as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))""",
    "op6_arc_to_warc": """
        with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
        d as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest, payload,
                     max(page_id) over (partition by payload) as largest from p)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and page_id <> largest then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and page_id <> largest then largest end as refers_to
        from d""",
    "op8_metric_tree": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
                   from embeddings
                   where embedding is not null and not list_contains(list_transform(embedding, lambda x:
                       coalesce(isfinite(x), false)), false)),
        s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v::double[], c.v::double[]) as bigint) as score
              from v q, v c where q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
        r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
    "op11_fill_middle": r"""
        with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h from documents),
        t as (select *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens,
                     ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
                     ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
        c as (select *, len(tokens) as n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as a,
                     greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as b,
                     case when text = '' or h3 % 100 >= 50 or contains(text, '<P>') or contains(text, '<S>')
                               or contains(text, '<M>') then 'plain'
                          when h4 % 100 < 80 then 'spm' else 'psm' end as form from t),
        p as (select *, array_to_string(tokens[1:a], '') as prefix, array_to_string(tokens[a + 1:b], '') as middle,
                     array_to_string(tokens[b + 1:], '') as suffix from c)
        select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
               case when form <> 'plain' then length(middle) end as middle_chars,
               sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(text) as restored_sha256
        from p""",
}
