"""The registered queries of the operators: thin digests of their real outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import decontam, exact_dedup, html_main, near_dedup, ngram_join, packing, quality, ranked_search, secrets_scan, spelling, surrogates, url_filter, warc_zip
from pricelake.llm.common import table


def packed_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "tier", "step_group")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(packing.pack(table(spark, sf_dir, "documents", "doc_id", "text")))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))

    def of(kind: str):
        return F.filter("spans", lambda s: s.kind == kind)

    base = F.filter("spans", lambda s: s.kind.isin(*secrets_scan.BASE))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets_scan.BASE],
        F.sha2(F.encode(secrets_scan.span_text(base), "UTF-8"), 256).alias("base_sha256"),
        secrets_scan.span_text(F.col("spans")).alias("spans"))


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, weights, keep=["doc_id"]).select(
        "row.doc_id", quality.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def op5_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"))


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_zip.write_archives(table(spark, sf_dir, "pages"), warc_zip.archive_folder(spark))
    read = warc_zip.read_archives(manifest)
    own = F.col("payload").isNotNull()       # a response's figures are those of the bytes read back
    return read.select(
        "page_id", F.when(own, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"), surrogates.session_key(spark))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start, s.end))
    return found.select("doc_id", F.size("spans").cast("long").alias("n_entities"),
                        F.array_join(spans, ",").alias("spans"), "text")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "word", "n", "n_near", "form", "form_n", "root")


def op12_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents", "doc_id", "text"))


REGISTRY = {"op1_packing": op1_packing, "op2_secrets": op2_secrets, "op3_decontam": op3_decontam, "op4_quality": op4_quality, "op5_html_main": op5_html_main, "op6_url_filter": op6_url_filter, "op7_warc_zip": op7_warc_zip,
            "op8_lsh_forest": op8_lsh_forest, "op9_surrogates": op9_surrogates,
            "op10_exact_dedup": op10_exact_dedup, "op11_spelling": op11_spelling, "op12_nra_search": op12_nra_search,
            "op13_ngram_join": op13_ngram_join}

SQL = {
    "op7_warc_zip": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> f THEN f END AS refers_to
        FROM f""",
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op12_nra_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
             q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
             k AS (SELECT doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
             s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM k),
             p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM k) GROUP BY ALL),
             w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
             g AS (SELECT item_id, doc_id,
                          sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // l)))))::BIGINT AS score
                   FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM g WHERE score > 0 QUALIFY rank <= 10""",
}
