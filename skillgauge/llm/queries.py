"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from skillgauge.llm.bpe import op8_bpe
from skillgauge.llm.burst_trie import ORACLE as BURST_TRIE
from skillgauge.llm.burst_trie import op13_burst_trie
from skillgauge.llm.decontaminate import op6_decontaminate
from skillgauge.llm.hmm import op10_hmm
from skillgauge.llm.jaccard_join import op4_jaccard_join
from skillgauge.llm.language_id import op2_language_id
from skillgauge.llm.line_dedup import op9_line_dedup
from skillgauge.llm.periodic_runs import ORACLE as PERIODIC_RUNS
from skillgauge.llm.periodic_runs import op11_periodic_runs
from skillgauge.llm.substring_dedup import op7_substring_dedup
from skillgauge.llm.tiled_simhash import op12_tiled_simhash
from skillgauge.llm.token_rollup import ORACLE as TOKEN_COUNTS
from skillgauge.llm.token_rollup import op5_token_counts
from skillgauge.llm.vector_search import op1_vector_search
from skillgauge.llm.warc import op3_warc

QUERIES = {
    "op1_vector_search": op1_vector_search,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_counts": op5_token_counts,
    "op6_decontaminate": op6_decontaminate,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe": op8_bpe,
    "op9_line_dedup": op9_line_dedup,
    "op10_hmm": op10_hmm,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_tiled_simhash": op12_tiled_simhash,
    "op13_burst_trie": op13_burst_trie,
}

_VECTORS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

_CAPTURES = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    ((CAST('0x' || substr(x, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM f
"""
_ALNUM = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_CONTAMINATED = f"""
WITH iw AS (SELECT item_id, least(13, len(ws)) AS n, ws FROM (SELECT item_id, {_ALNUM} AS ws FROM benchmark) WHERE len(ws) > 0),
runs AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS run FROM (SELECT *, unnest(range(1, CAST(len(ws) - n + 2 AS BIGINT))) AS i FROM iw)),
w AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS run FROM (
    SELECT w.*, k.n, unnest(range(1, CAST(len(ws) - k.n + 2 AS BIGINT))) AS i FROM w JOIN (SELECT DISTINCT n FROM runs) k ON len(ws) >= k.n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN runs USING (n, run)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY ALL),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY ALL)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
_SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS run FROM (SELECT *, unnest(range(1, CAST(len(ws) - 11 AS BIGINT))) AS i FROM w)),
m AS (SELECT run, min(doc_id) AS first FROM g GROUP BY run),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (run) WHERE first < doc_id),
x AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_filter(ws, lambda v, j: NOT list_contains(coalesce(gone, []), j)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN x USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_vector_search": _VECTORS,
    "op3_warc": _CAPTURES,
    "op5_token_counts": TOKEN_COUNTS,
    "op6_decontaminate": _CONTAMINATED,
    "op7_substring_dedup": _SUBSTRINGS,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op13_burst_trie": BURST_TRIE,
}
