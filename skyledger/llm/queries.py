"""One query per corpus operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    divergence,
    html,
    jaccard,
    mixing,
    periods,
    pieces,
    quality,
    ranking,
    secrets,
    suffixes,
    syncmers,
    tokens,
    warc,
)
from skyledger.llm.common import WORD, scratch, scratch_path, stored, table

#: The vocabulary the queries use; any path that all executors have may be passed to the operators.
MODEL = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        scratch(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return build


ORACLES["op5_quality_rules"] = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
), m AS (
  SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_filter(words, lambda w: list_contains(['{"', '".join(dict.fromkeys(quality.STOP_WORDS.split()))}'], w)))
           AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_cut_lines
  FROM t
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i+2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t)
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id
), b AS (
  SELECT m.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
         n_words < 50 OR 100 * coalesce(r.n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM m LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_bullet_lines,
       n_cut_lines, base_failed,
       NOT base_failed AND n_words <= 100000 AND word_chars BETWEEN 2 * n_words AND 12 * n_words
         AND 1000 * n_symbols <= 100 * n_words AND 1000 * n_stop_words >= 20 * n_words
         AND 1000 * n_dup_lines <= 500 * n_lines AND 1000 * n_bullet_lines <= 900 * n_lines
         AND 1000 * n_cut_lines <= 300 * n_lines AS kept
FROM b
"""


@query
def op5_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", *quality.MEASURES, "base_failed", "kept")


@query
def op10_secret_scans(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.summarise(secrets.find_secrets(docs))


@query
def op2_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # A cache of its own for each run, so that a run's work does not depend on earlier ones.
    return tokens.token_counts(docs, scratch_path(spark, "token_cache"), public_tokenizers.path(MODEL))


@query
def op9_sentencepiece(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = pieces.encode(docs, public_tokenizers.path(MODEL), verify=F.lit(True))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip", "parity")


@query
def op1_html_extraction(spark, folder):
    return html.extract(table(spark, folder, "pages").select("page_id", "url", "html"))


@query
def op6_source_mix(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", mixing.n_words("text").alias("size"))
    plan = mixing.plan_mix(stored(docs, "sizes"))
    each = plan.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    taken = (F.col("size") * F.col("copies")).cast("bigint").alias("taken")
    return each.select("doc_id", "source", "size", "source_size", "target", taken, "copies")


ORACLES["op4_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) || '0' AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
  FROM pages
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, ((5 * i) // 4 + 1)::INT, 2))::INT >> (3 - (5 * i) % 4)::INT) & 31) + 1)::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < largest THEN largest END AS refers_to
FROM p
"""


@query
def op4_warc(spark, folder):
    path = scratch_path(spark, "archives")
    warc.write_pages(table(spark, folder, "pages"), path)
    columns = ["record_id", "record_type", "payload_digest", "refers_to", "payload_bytes"]
    # Payloads of responses are inflated and compared with their digests; of revisits only headers are read.
    responses = warc.read_warc(spark, path, columns, {"record_type": ["response"], "record_id": "<urn:page:*"}, verify=True)
    revisits = warc.read_warc(spark, path, columns, {"record_type": ["revisit"], "refers_to": "<urn:page:*"})
    return responses.union(revisits).select(
        warc.page_number("record_id").alias("page_id"),
        "payload_bytes",
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


@query
def op8_fingerprints(spark, folder):
    return syncmers.compare_with_edits(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op7_jaccard_join(spark, folder):
    return jaccard.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op3_repeated_passages(spark, folder):
    return suffixes.repeated_passages(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op11_quality_ranking(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return ranking.score_quality(docs, table(spark, folder, "labels").select("doc_id", "quality"))


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where a tenth of all texts is made periodic, and its period; texts without an id stay as they are."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


@query
def op12_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return periods.digests(periods.find_runs(docs, rewrite=planted))


ORACLES["op13_source_divergence"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT lang, source, row, unnest(words) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term
), v AS (
  SELECT lang, count(*) AS v, sum(total) AS lang_n FROM k GROUP BY lang
), g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_n, 0) AS lang_n,
         coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS group_n
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v USING (lang)
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (group_n + 5 * v))::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (total + 5)) // (lang_n + 5 * v))::BIGINT AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM f WHERE n > 0 AND p > q
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r
)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_source_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents").select("lang", "source", "text"))
