"""DuckDB SQL for the queries that SQL can express.

Trained models, tokenizers, Spark's hash and Order MinHash have no SQL form;
those queries are tested against brute force, the libraries or held-out labels.
"""

from __future__ import annotations

#: kind, pattern, group whose length counts, least length (the rules of the secret scan, written for RE2)
_SECRETS = (
    ("assign", """(?i:(password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]+", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
)


def _secrets() -> str:
    """Matches and the text between them, numbered; running lengths give the places."""
    parts = []
    for order, (kind, pattern, group, least) in enumerate(_SECRETS):
        parts.append(f"""SELECT doc_id, {order} AS ord, '{kind}' AS kind, {least} AS least,
            generate_subscripts(m, 1) AS k, unnest(m) AS whole, unnest(g) AS part, unnest(gaps[:len(m)]) AS gap
          FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m,
                       regexp_extract_all(text, '{pattern}', {group}) AS g,
                       string_split_regex(text, '{pattern}') AS gaps FROM texts) WHERE len(m) > 0""")
    base = sum(1 for k, *_ in _SECRETS[:3])
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
      matches AS ({" UNION ALL ".join(parts)}),
      placed AS (SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, ord ORDER BY k
                                                                  ROWS UNBOUNDED PRECEDING) AS stop FROM matches),
      spans AS (SELECT doc_id, ord, stop - length(whole) AS start,
                       kind || ':' || CAST(stop - length(whole) AS VARCHAR) || ':' || CAST(stop AS VARCHAR) AS span
                FROM placed WHERE length(part) >= least),
      told AS (SELECT doc_id, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access,
                      count(*) FILTER (WHERE ord = 2) AS n_hex,
                      string_agg(span, ',' ORDER BY start, ord) FILTER (WHERE ord < {base}) AS base,
                      string_agg(span, ',' ORDER BY start, ord) AS spans FROM spans GROUP BY doc_id)
      SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
             coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
      FROM texts d LEFT JOIN told t ON d.doc_id = t.doc_id"""


def _overlaps() -> str:
    """Every word shared by a document and an item, by diagonal; then the best stretch of the item."""
    def words(table: str, key: str) -> str:
        return (f"(SELECT {key}, generate_subscripts(w, 1) AS pos, unnest(w) AS word, len(w) AS size FROM "
                f"(SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table}))")

    return f"""WITH same AS (SELECT doc_id, item_id, d.pos - i.pos AS diagonal, i.pos AS pos, i.size AS size,
                               least(13, i.size) AS stretch
                  FROM {words('documents', 'doc_id')} d JOIN {words('benchmark', 'item_id')} i ON d.word = i.word
                  WHERE i.size >= 5),
      enough AS (SELECT *, CASE WHEN stretch < 7 THEN stretch ELSE CAST(ceil(stretch * 0.8) AS INTEGER) END AS need
                 FROM same QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, diagonal) >= need),
      counted AS (SELECT a.doc_id, a.item_id, a.diagonal, a.pos, a.need, count(*) AS n
                  FROM (SELECT *, least(pos, size - stretch + 1) AS lo FROM enough) a
                  JOIN enough b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.diagonal = b.diagonal
                       AND b.pos BETWEEN a.lo AND a.lo + a.stretch - 1
                  GROUP BY ALL)
      SELECT doc_id, item_id, max(n) AS matched_words FROM counted WHERE n >= need GROUP BY doc_id, item_id"""


_CAPTURES = """WITH told AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                        sha256(coalesce(html, '')) AS payload_digest FROM pages),
      placed AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM told)
      SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
             CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END
               AS record_type,
             CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
      FROM placed"""

_HARD_NEGATIVES = """WITH part AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
                        CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
                 FROM part a JOIN part b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
      positive AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
      SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                                               ORDER BY score DESC, other_id) AS INTEGER) AS rank,
             other_id AS negative_id, positive_score, score AS negative_score
      FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT alike
           AND 100 * score BETWEEN 80 * positive_score AND 100 * positive_score
      QUALIFY rank <= 5"""


ORACLE: dict[str, str] = {
    "op4_secret_index": _secrets(),
    "op7_decontamination": _overlaps(),
    "op11_warc": _CAPTURES,
    "op12_cover_tree": _HARD_NEGATIVES,
}
