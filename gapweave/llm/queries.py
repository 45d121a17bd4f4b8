"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.decontamination import contaminated
from gapweave.llm.line_dedup import dedup_lines
from gapweave.llm.merkle_queries import OP11_SQL, op11_merkle_manifest
from gapweave.llm.mix_queries import op12_source_mix
from gapweave.llm.ngram_join import near_duplicates
from gapweave.llm.packing import pack_sequences, token_pieces
from gapweave.llm.quality_rules import learn_rules, quality_verdicts
from gapweave.llm.recompression import remove_repeats
from gapweave.llm.run_queries import op13_periodic_runs
from gapweave.llm.secret_scan import scan_secrets
from gapweave.llm.shared import written
from gapweave.llm.template_extraction import extract_pages
from gapweave.llm.token_store import token_store_rows, write_token_store
from gapweave.llm.warc import read_warc, write_warc
from gapweave.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

SEQUENCE_IDS = 4096


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), links=True)


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


def op3_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    store = write_token_store(docs, scratch_path(spark, "tokens"), vocabulary("byte_bpe_50k.json"))
    return token_store_rows(store).withColumnRenamed("key", "doc_id")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_verdicts(docs, learn_rules(docs, table(spark, folder, "labels")))


def op5_warc_writer(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, folder, "pages"), path)
    return read_warc(spark, path).drop("url")


OP5_SQL = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
d AS (SELECT page_id, bytes, sha1(html) AS digest,
             CASE WHEN bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d"""


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", kept)


OP6_SQL = r"""WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w),
windows AS (SELECT doc_id, p, array_to_string(ws[p : p + 12], ' ') AS t FROM starts),
least AS (SELECT t, min(doc_id) AS d FROM windows GROUP BY t),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p
         FROM windows JOIN least USING (t) WHERE d < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
marked AS (SELECT doc_id, word, p, g.p IS NOT NULL AS out
           FROM words LEFT JOIN gone g USING (doc_id, p)),
kept AS (SELECT doc_id, count(*) FILTER (out) AS n_removed,
                string_agg(word, ' ' ORDER BY p) FILTER (NOT out) AS text FROM marked GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


OP8_SQL = """WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT doc_id, line, place, coalesce(last <> doc_id, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"), True, 1, SEQUENCE_IDS)
    return pack_sequences(written(pieces, "pieces"), SEQUENCE_IDS)


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_ngram_jaccard_join,
        op2_html_extraction,
        op3_token_store,
        op4_quality_rules,
        op5_warc_writer,
        op6_substring_dedup,
        op7_secret_scan,
        op8_line_dedup,
        op9_benchmark_decontamination,
        op10_best_fit_packing,
        op11_merkle_manifest,
        op12_source_mix,
        op13_periodic_runs,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc_writer": OP5_SQL,
        "op6_substring_dedup": OP6_SQL,
        "op8_line_dedup": OP8_SQL,
        "op11_merkle_manifest": OP11_SQL,
    }
