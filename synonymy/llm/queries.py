"""The operators' queries, and SQL where it can express them."""

from __future__ import annotations

from .ann import op4_ann_search
from .chat import op8_chat_formatting
from .decontaminate import op6_decontamination
from .filter_audit import SQL as FILTER_AUDIT
from .filter_audit import op11_filter_audit
from .fingerprint import op13_fingerprints
from .lexical import SQL as LEXICAL
from .lexical import op12_lexical_search
from .licenses import op1_license_scan
from .minhash import op9_minhash_near_dedup
from .ngram import op5_lm_scoring
from .packing import op7_packing
from .pii import op2_pii
from .secrets import op10_secret_scan
from .toxicity import op3_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_pii, op3_toxicity, op4_ann_search, op5_lm_scoring, op6_decontamination, op7_packing, op8_chat_formatting, op9_minhash_near_dedup, op10_secret_scan,
        op11_filter_audit, op12_lexical_search, op13_fingerprints,
    )
}

SQL = {
    "op11_filter_audit": FILTER_AUDIT,
    "op12_lexical_search": LEXICAL,
    "op9_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
g AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) END)) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS d, doc_id AS t FROM documents UNION SELECT r.d, e.y FROM r JOIN e ON r.t = e.x),
m AS (SELECT d, min(t) AS t FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.t AS component_id, w.doc_id = m.t AS kept
FROM w JOIN m ON m.d = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
""",
}
