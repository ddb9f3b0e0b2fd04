"""Expected SQL of the registered queries, where SQL can say what they compute."""

from __future__ import annotations

from headrace.llm import licenses

_ORACLES: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


def oracle(name: str, sql: str) -> None:
    _ORACLES[name] = sql


def _literal(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Containment is counted for every block and notice, without filters.
oracle(
    "op7_licenses",
    f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents
    ), w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{_ALNUM}') AS w FROM d),
    phrase(words, label) AS (VALUES {", ".join(f"({_literal(p.split())}, '{l}')" for p, l in licenses.PHRASES.items())}),
    hit AS (
        SELECT r, i - 1 AS place, label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w), phrase
        WHERE w[i:i + len(words) - 1] = words
    ), base AS (
        SELECT r, count(*) AS n, min(place) AS a, max(place) AS z, list(DISTINCT label) AS labels FROM hit GROUP BY r
    ), notice(words, label) AS (
        VALUES {", ".join(f"({_literal(sorted(set(t.split())))}, '{l}')" for l, t in licenses.NOTICES.items())}
    ), line AS (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
    block AS (
        SELECT r, list_distinct(regexp_extract_all(lines, '{_ALNUM}')) AS b FROM (
            SELECT r, string_agg(line, chr(10)) OVER (
                PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {licenses.WRAPPED - 1} FOLLOWING
            ) AS lines FROM line
        )
    ), added AS (
        SELECT r, list(DISTINCT label) AS labels, max(len(list_intersect(b, words)) / len(words)) AS share
        FROM block, notice WHERE 100 * len(list_intersect(b, words)) >= {licenses.PERCENT} * len(words) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, z AS last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           array_to_string(list_sort(list_distinct(
               coalesce(base.labels, []::VARCHAR[]) || coalesce(added.labels, []::VARCHAR[]))), ',') AS labels,
           CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(share, 0) END AS DOUBLE) AS score
    FROM w LEFT JOIN base USING (r) LEFT JOIN added USING (r)
    """,
)

# Every place of every document against every window.
oracle(
    "op4_contamination",
    f"""
    WITH b AS (
        SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS id,
               regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_ALNUM}') AS w
        FROM benchmark WHERE text IS NOT NULL
    ), win AS (
        SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
            SELECT id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
            FROM b WHERE len(w) > 0
        )
    ), d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_ALNUM}') AS w
        FROM documents
    ), place AS (
        SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT n FROM win)
        WHERE i + n - 1 <= len(w)
    ), hit AS (SELECT r, i, n, id FROM place JOIN win USING (n, k)),
    covered AS (
        SELECT r, count(*) AS n_hit
        FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS i FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
    ), item AS (SELECT r, list_sort(list(DISTINCT id)) AS ids FROM hit GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
           coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN item USING (r)
    """,
)
