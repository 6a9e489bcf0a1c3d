"""The queries of this subpackage, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontam, quality, ranked, repeats, secrets, sentencepiece, simhash, tokenbin, vectors, warc, winnow, wrappers
from .common import read_table


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; LEDGERSTREAM_TOKENIZERS names another folder that all executors have."""
    if folder := os.environ.get("LEDGERSTREAM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.token_spans(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op2_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read_table(spark, sf_dir, "pages")).drop("wrapper")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), digest=True)


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op6_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents")).drop("row", "spans_found")


def op7_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnow.fingerprints_and_edits(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), winnow.as_text(F.col("prints")).alias("fingerprint"), winnow.as_text(F.col("edited_prints")).alias("edited_fingerprint"), "near_edited", "near_next")


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_hash")


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_files, op2_html_wrappers, op3_sentencepiece, op4_simhash_groups, op5_quality_scores, op6_secret_spans, op7_warc_roundtrip, op8_winnowing, op9_benchmark_leaks, op10_repeated_bytes, op11_ranked_search, op12_token_alignment, op13_near_vectors)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_warc_roundtrip": """
            with p as (select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as digest, octet_length(encode(coalesce(html, ''))) as n from pages),
            f as (select digest, min(page_id) as first from p where n >= 100 group by digest)
            select p.page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
                   case when first is not null and first <> p.page_id then 'revisit' else 'response' end as record_type,
                   case when first <> p.page_id then first end as refers_to, cast(null as varchar) as problem
            from p left join f using (digest)""",
        "op11_ranked_search": r"""
            with t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
            c as (select count(*) filter (where len(terms) > 0) as n_docs, cast(sum(len(terms)) as bigint) as length from t),
            p as (select doc_id, n, term, count(*) as tf from (select doc_id, len(terms) as n, unnest(terms) as term from t) group by all),
            w as (select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1))) as bigint) as w from p, c group by term, n_docs),
            i as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
            s as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // length)))) as bigint) as score from i join p using (term) join w using (term), c group by item_id, doc_id),
            r as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank from s where score > 0)
            select item_id, rank, doc_id, score from r where rank <= 10""",
        "op13_near_vectors": """
            with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
            l as (select a.vec_id as u, b.vec_id as v from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
            r(u, v) as (select u, v from l union select r.u, l.v from r join l on r.v = l.u),
            n as (select u, count(*) as n from l group by u), m as (select u, min(v) as low from r group by u)
            select vec_id, coalesce(n.n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, least(vec_id, coalesce(low, vec_id)) = vec_id as kept
            from embeddings left join n on n.u = vec_id left join m on m.u = vec_id""",
    }
