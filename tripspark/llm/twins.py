"""DuckDB twins that are built from a rule: one CTE per level of a tree, for instance."""

from __future__ import annotations

from tripspark.llm import merkle

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
LEXICAL_SQL = f"""
        WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS terms FROM documents WHERE doc_id IS NOT NULL),
        corpus AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM docs WHERE len(terms) > 0),
        tf AS (SELECT doc_id, r, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, r, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs) GROUP BY ALL),
        asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, corpus GROUP BY term, docs),
        scores AS (
          SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
          FROM asked JOIN tf USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id, r
        )
        SELECT item_id, (row_number() OVER w)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 50"""

LEVELS = 6  # 16 ** 6 leaves a tree


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_field(text if f == 'text' else f) for f in merkle.FIELDS)}))"


# crc32 bit by bit: 3988292384 is its reversed polynomial
CRC32 = """xor(list_reduce(flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ord(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda c, x: CASE WHEN (xor(c, x) & 1) = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END, 4294967295::BIGINT), 4294967295::BIGINT)"""


def _levels(name: str) -> list[str]:
    """``name``0 (tree, i, d, n) -> the nodes of every level above, and the runs that are hashed together."""
    out = []
    for k in range(LEVELS):
        out.append(f"{name}_run{k} AS MATERIALIZED (SELECT tree, i // 16 AS run, list(d ORDER BY i) AS ds, max(n) AS n FROM {name}{k} GROUP BY tree, i // 16)")
        out.append(
            f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, run AS i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, (n + 15) // 16 AS n
          FROM {name}_run{k})"""
        )
    return out


def _climb(name: str, first: str, path: str) -> list[str]:
    """``path``0 (tree, i, folded, siblings and what else is kept) up the levels."""
    out = [f"{path}0 AS MATERIALIZED ({first})"]
    for k in range(LEVELS):
        before, after = f"array_to_string(ds[1:i // {16**k} % 16], '')", f"array_to_string(ds[i // {16**k} % 16 + 2:], '')"
        out.append(
            f"""{path}{k + 1} AS MATERIALIZED (SELECT p.* REPLACE (CASE WHEN n > 1 THEN sha256({before} || folded || {after}) ELSE folded END AS folded,
          siblings || {before} || {after} AS siblings) FROM {path}{k} p JOIN {name}_run{k} r ON r.tree = p.tree AND r.run = p.i // {16 ** (k + 1)})"""
        )
    return out


def merkle_sql() -> str:
    ctes = [
        f"leaves AS (SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {CRC32} % 5 = 0 THEN {_leaf(f'''translate(text, '{merkle.UPPER}', '{merkle.LOWER}')''')} END AS claim FROM documents)",
        """placed AS MATERIALIZED (SELECT doc_id, leaf, coalesce(claim, leaf) AS claim, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
          row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves)""",
        "g0 AS MATERIALIZED (SELECT tree, i, leaf AS d, n FROM placed)",
        *_levels("g"),
        f"t0 AS MATERIALIZED (SELECT 0 AS tree, tree AS i, d, count(*) OVER () AS n FROM g{LEVELS})",
        *_levels("t"),
        *_climb("g", "SELECT doc_id, leaf, tree, i, claim AS folded, '' AS siblings FROM placed", "own"),
        *_climb("t", f"SELECT doc_id, leaf, 0 AS tree, tree AS i, folded, siblings FROM own{LEVELS}", "whole"),
    ]
    return f"""WITH {", ".join(ctes)}
        SELECT doc_id, leaf, t0.d AS subroot, root.d AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root.d AS verified
        FROM whole{LEVELS} w JOIN t0 ON t0.i = w.i, t{LEVELS} root"""
