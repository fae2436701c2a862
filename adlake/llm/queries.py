"""The registered query of each operator, over its whole table, and SQL where it can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import (
    archive, classlm, decontaminate, kdshards, packing, periodic, pii, prefix_tree, quality, repair, spotsigs, topk, transcripts,
)
from adlake.llm.common import table


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    return archive.archived_pages(spark, table(spark, sf, "pages"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_prefix_tree_join(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_tree.near_components(table(spark, sf, "documents"))


def op5_class_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    return classlm.scored(table(spark, sf, "documents"))


def op6_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf, "documents"))
    return pieces.select("doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.recovered(table(spark, sf, "conversations"))


def op8_spotsigs(spark: SparkSession, sf: str) -> DataFrame:
    return spotsigs.fingerprints_of_edits(table(spark, sf, "documents"))


def op9_kd_shards(spark: SparkSession, sf: str) -> DataFrame:
    rows = kdshards.document_shards(table(spark, sf, "documents"), 40)
    return rows.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    rows = pii.found(table(spark, sf, "documents"))
    return rows.select("doc_id", *(f"n_{k}" for k in pii.KINDS),
                       F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op11_segment_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.digests(periodic.periodic(table(spark, sf, "documents"), plant=True))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations")
    return repair.report(conversations, repair.damaged(conversations))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontamination, op2_warc_archive, op3_quality, op4_prefix_tree_join, op5_class_ngrams, op6_mixture_packing,
    op7_transcripts, op8_spotsigs, op9_kd_shards, op10_personal_data, op11_segment_top_k, op12_periodic_runs,
    op13_conversation_repair)}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_warc_archive": """
        with p as (
            select page_id, coalesce(url, '') as url, coalesce(html, '') as html from pages),
        d as (
            select *, strlen(html)::bigint as n, sha256(html) as digest, min(page_id) over (partition by html) as first from p),
        r as (select *, n >= 100 and page_id <> first as again from d)
        select page_id, n as payload_bytes, digest as payload_digest,
               case when again then 'revisit' else 'response' end as record_type,
               case when again then first end as refers_to,
               (strlen('WARC/1.1') + 2
                + strlen('WARC-Type: ') + case when again then 7 else 8 end + 2
                + strlen('WARC-Record-ID: ') + 47 + 2
                + strlen('WARC-Target-URI: ') + strlen(url) + 2
                + strlen('WARC-Date: 2024-01-01T00:00:00Z') + 2
                + strlen('WARC-Payload-Digest: sha256:') + 64 + 2
                + case when again then strlen('WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest') + 2
                       + strlen('WARC-Refers-To: ') + 47 + 2 else 0 end
                + strlen('Content-Type: application/http; msgtype=response') + 2
                + strlen('Content-Length: ') + strlen((h + case when again then 0 else n end)::varchar) + 2
                + 2 + h + case when again then 0 else n end + 4)::bigint as record_bytes
        from (select *, strlen('HTTP/1.1 200 OK') + 2 + strlen('Content-Type: text/html; charset=utf-8') + 2
                        + strlen('Content-Length: ') + strlen(n::varchar) + 4 as h from r)""",
    "op4_prefix_tree_join": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') as w from documents),
        s as (
            select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) end) as g from w),
        n as (select doc_id, count(*) as n from s group by doc_id),
        o as (select a.doc_id as a, b.doc_id as b, count(*) as shared
              from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
        l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
        r(doc_id, m) as (select doc_id, doc_id from documents union select r.doc_id, l.b from r join l on r.m = l.a),
        c as (select doc_id, min(m) as component_id from r group by doc_id)
        select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id
        from documents d join c using (doc_id) left join n using (doc_id)""",
    "op11_segment_top_k": """
        with v as (
            select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(64 * x::double)) as e
            from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select q.vec_id as query_id, q.r, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
            from v q, v c where q.vec_id % 20 = 0 and q.r <> c.r)
        select query_id, rank::integer as rank, vec_id, score from (
            select *, row_number() over (partition by r order by score desc, vec_id) as rank from s) where rank <= 20""",
}
