"""The queries op1_... to op13_... over the test tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm import align, bpe, embedjoin, fingerprint, htmltext, langid, linededup, lm, minhash, packing, urlfilter, vectorcodes, warc
from silverloom.llm.common import shared_folder

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
BLOCKLIST = Path(__file__).with_name("blocklist.txt")


def blocklist(path: Path = BLOCKLIST) -> list[str]:
    """The listed URLs of a configuration file: one a line, '#' begins a comment."""
    lines = (line.split("#")[0].strip() for line in path.read_text(encoding="utf-8").splitlines())
    return [line for line in lines if line]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.beside_next(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op2_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedjoin.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(u,) for u in blocklist()], "url string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES, listed)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(fold("doc_id", 3) != 1))
    found = langid.predict(docs, profiles)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "n_lines", "removed_lines")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, similarity=(85, 100))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.link(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    found = warc.round_trip(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    warc.delete(folder)
    return found


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_embedding_join": op2_embedding_join,
        "op3_lm_score": op3_lm_score,
        "op4_url_filter": op4_url_filter,
        "op5_language_id": op5_language_id,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_bpe": op7_bpe,
        "op8_html_text": op8_html_text,
        "op9_line_dedup": op9_line_dedup,
        "op10_minhash": op10_minhash,
        "op11_token_alignment": op11_token_alignment,
        "op12_warc": op12_warc,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    listed = "\n".join(f"    WHEN site = '{h}' OR ends_with(site, '.{h}') THEN '{h}/'" for h in (u.removeprefix("http://").rstrip("/") for u in blocklist()))
    return {"op4_url_filter": OP4_SQL.replace("    WHEN listed_hosts", listed), "op12_warc": OP12_SQL, "op13_vector_codes": op13_sql()}


#: The listed hosts, whose entries have no path, and their subdomains are blocked; written without the filter.
OP4_SQL = r"""
WITH p AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.{2,}', '.', 'g'), '^\.|\.$', '', 'g') AS site
  FROM p
), l AS (
  SELECT *, CASE
    WHEN listed_hosts
  END AS listed
  FROM r
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  listed
FROM l
"""

#: Base 32 of SHA-1: its 160 bits in groups of five.
OP12_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
b AS (SELECT page_id, payload, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
d AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INT), 5) AS BIGINT)) AS words FROM b
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((words[k // 4 + 1] >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""


def op13_sql(rounds: int = 6) -> str:
    """Every round in SQL, with all entries compared: parts as rows (vec_id, p, q), codebooks as rows (p, e, c)."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        "parts AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] AS q FROM kept, range(8) t(p))",
        "book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, q AS c FROM parts QUALIFY e < 16)",
    ]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, p, q, e, d FROM (
    SELECT vec_id, p, q, e, d, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS rn
    FROM (SELECT vec_id, p, q, e, list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS d FROM parts JOIN book{i} USING (p)) x
  ) y WHERE rn = 1
)""")
        if i < rounds:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS c FROM (
      SELECT p, e, i, CAST(floor(sum(q[i]) / count(*)) AS BIGINT) AS m FROM near{i}, range(1, 9) t(i) GROUP BY p, e, i
    ) z GROUP BY p, e
  ) m USING (p, e)
)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM (
  SELECT vec_id, label, string_agg('0' || substr('0123456789abcdef', CAST(e AS INT) + 1, 1), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} JOIN kept USING (vec_id) GROUP BY vec_id, label
) r"""
