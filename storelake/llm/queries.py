"""The operators of this package as named queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelake.llm.chat_format import CONTROL, PROBE, format_digests, with_probe
from storelake.llm.decontaminate import contamination
from storelake.llm.exact_dedup import exact_duplicates
from storelake.llm.language_id import languages
from storelake.llm.mixing import mix_plan
from storelake.llm.periodic_runs import periodic_runs, run_digests, with_planted_repeats
from storelake.llm.pii import personal_data, span_digests
from storelake.llm.secrets import secret_digests
from storelake.llm.sharding import shard_rows
from storelake.llm.shared import UPPER, read_table, ship_package
from storelake.llm.simhash_near import near_duplicates
from storelake.llm.source_divergence import MIN_DOCS, SCALE, SMOOTHING, TOP_TERMS, source_divergence
from storelake.llm.vector_search import TOP, UNIT, top_vectors
from storelake.llm.warc import MIN_REVISIT_BYTES, archived_pages

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *tables: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return operator(*[read_table(spark, sf_dir, name) for name in tables])
    return run


QUERIES: dict[str, Query] = {
    "op1_secret_scan": _over(secret_digests, "documents"),
    "op2_temperature_mix": _over(mix_plan, "documents"),
    "op3_chat_format": _over(lambda c: format_digests(with_probe(c)), "conversations"),
    "op4_language_id": _over(languages, "documents"),
    "op5_bounded_ring_shards": _over(shard_rows, "documents"),
    "op6_personal_data": _over(lambda d: span_digests(personal_data(d)), "documents"),
    "op7_decontaminate": _over(contamination, "documents", "benchmark"),
    "op8_exact_dedup": _over(exact_duplicates, "documents"),
    "op9_simhash_near": _over(near_duplicates, "documents"),
    "op10_warc": _over(archived_pages, "pages"),
    "op11_periodic_runs": _over(lambda d: run_digests(periodic_runs(with_planted_repeats(d))), "documents"),
    "op12_vector_search": _over(top_vectors, "embeddings"),
    "op13_source_divergence": _over(source_divergence, "documents"),
}

_TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_CONTROL = CONTROL.replace("\\[", "[[]").replace("\\]", "[]]")

ORACLE: dict[str, str] = {
    "op3_chat_format": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
        marked AS (
            SELECT *, max(CASE WHEN regexp_matches(body, '{_CONTROL}') OR regexp_matches(role, '{_CONTROL}')
                                 OR contains(role, chr(10)) THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS level
            FROM rows),
        sized AS (
            SELECT *, CASE WHEN level = 0 THEN body ELSE regexp_replace(regexp_replace(replace(body, '&', '&amp;'),
                               '<(/?s>|</?SYS>>)', '&lt;\\1', 'g'), '[[](/?INST[]])', '&#91;\\1', 'g') END AS safe,
                   CASE WHEN level = 0 THEN role ELSE replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'),
                               '[', '&#91;'), chr(10), '&#10;') END AS safe_role
            FROM marked)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
               length(coalesce(string_agg(body, '') FILTER (WHERE role = 'assistant'), '')) AS loss_chars,
               sha256(coalesce(string_agg(body, '' ORDER BY turn NULLS FIRST, role, body)
                               FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(3 + sum(8 + length(safe_role) + length(safe)
                            + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 ELSE 0 END) AS BIGINT) AS formatted_chars,
               max(level) AS escape_level
        FROM sized GROUP BY conv_id""",
    "op8_exact_dedup": f"""
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY body)""",
    "op10_warc": f"""
        WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        ranked AS (SELECT *, octet_length(payload) AS size, max(page_id) OVER (PARTITION BY payload) AS last FROM payloads)
        SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
               CASE WHEN size >= {MIN_REVISIT_BYTES} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= {MIN_REVISIT_BYTES} AND page_id < last THEN last END AS refers_to
        FROM ranked""",
    "op12_vector_search": f"""
        WITH v AS (
            SELECT vec_id, row_number() OVER () AS own,
                   list_transform(embedding, lambda x: CAST(floor({UNIT} * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
            FROM embeddings
            WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
              AND list_count(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.own, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
            FROM v q JOIN v ON len(q.vec) = len(v.vec) AND q.own <> v.own WHERE q.vec_id % 20 = 0)
        SELECT query_id, rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= {TOP}""",
    "op13_source_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{_TERM}') AS words
            FROM documents),
        w AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
        counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
        sizes AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
        groups AS (SELECT DISTINCT lang, source FROM d),
        priced AS (
            SELECT lang, source, term, coalesce(counts.n, 0) AS n,
                   1 + {SCALE} * (coalesce(counts.n, 0) + {SMOOTHING}) // (coalesce(sizes.n, 0) + {SMOOTHING} * v) AS p,
                   1 + {SCALE} * (kept.n + {SMOOTHING}) // (langs.n + {SMOOTHING} * v) AS q
            FROM groups JOIN langs USING (lang) JOIN kept USING (lang)
            LEFT JOIN sizes USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
        apart AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
            UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM priced WHERE n > 0 AND p > q)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
        WHERE part = 'pair' OR rank <= {TOP_TERMS}""",
}
