"""DuckDB statements of the manifest and spelling queries."""

from __future__ import annotations

from tabsmith.llm import merkle, spelling

#: The 256 remainders of crc32, from its polynomial.
CRC_TABLE = """SELECT list(list_reduce(list_prepend(b, range(8)), lambda r, k: if(r & 1 = 1, xor(r >> 1, 3988292384), r >> 1)) ORDER BY b) AS crc
  FROM range(256) bytes(b)"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; needs ``crc`` of CRC_TABLE in scope."""
    digits = f"hex(encode({text}))"
    numbers = f"list_transform(range(1, length({digits}), 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {numbers}), lambda r, b: xor(crc[(xor(r, b) & 255) + 1], r >> 8)), 4294967295)"


def _framed(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf(fields) -> str:
    return f"sha256({' || '.join(_framed(f) for f in fields)})"


def _ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, leaves: str) -> str:
    """Recursive nodes of the trees over ``leaves`` (tree, place, size, node), and each node with its run's others."""
    run = f"PARTITION BY tree, level, place // {merkle.FAN} ORDER BY place ROWS BETWEEN"
    return f"""
{name}_nodes(tree, level, place, size, node) AS (
  SELECT tree, 0, place, size, node FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // {merkle.FAN}, (any_value(size) + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(node, '' ORDER BY place))
  FROM {name}_nodes WHERE size > 1 GROUP BY tree, level, place // {merkle.FAN}
),
{name}_runs AS (
  SELECT *, coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}_nodes
),"""


def _climb(name: str, start: str) -> str:
    """Recursive folding of ``start`` (row, tree, place, node, proof) along the runs of a tree, to the level with one node."""
    return f"""
{name}_climb(row, tree, level, place, node, proof) AS (
  SELECT row, tree, 0, place, node, proof FROM {start}
  UNION ALL
  SELECT c.row, c.tree, c.level + 1, c.place // {merkle.FAN}, sha256(r.before || c.node || r.after), c.proof || r.before || r.after
  FROM {name}_climb c JOIN {name}_runs r ON r.tree = c.tree AND r.level = c.level AND r.place = c.place AND r.size > 1
),
{name}_top AS (SELECT * FROM {name}_climb QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1),"""


def manifest_sql(fields, changed: dict[str, str]) -> str:
    own, other = _leaf(fields), _leaf([changed.get(f, f) for f in fields])
    return f"""
WITH RECURSIVE remainders AS ({CRC_TABLE}),
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {own} AS leaf,
         if({crc32_sql("doc_id::VARCHAR")} % 3 = 0, {other}, NULL) AS tampered
  FROM documents, remainders
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS row, leaf AS node,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size
  FROM hashed
),{_tree("lang", "placed")}
subroots AS (
  SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS size, node
  FROM lang_nodes WHERE size = 1
),{_tree("top", "subroots")}
root AS (SELECT node AS root FROM top_nodes WHERE size = 1),
started AS (SELECT row, tree, place, coalesce(tampered, leaf) AS node, '' AS proof FROM placed),{_climb("lang", "started")}
crossed AS (
  SELECT l.row, s.tree, s.place, l.node, l.proof FROM lang_top l JOIN subroots s ON s.lang = l.tree
),{_climb("top", "crossed")}
subroot_of AS (SELECT lang, node AS subroot FROM subroots)
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(t.proof) AS proof_sha256, t.node AS folded_root, t.node = r.root AS verified
FROM placed p JOIN top_top t ON t.row = p.row JOIN subroot_of s ON s.lang = p.tree, root r"""


#: Near words share a form with one code point taken out, or are one such form of the other.
SPELLING_SQL = f"""
WITH remainders AS ({CRC_TABLE}),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
),
counted AS (SELECT doc_id, {_ascii_lower("run")} AS run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT *, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS hash FROM counted, remainders),
written AS (
  SELECT if(hash % {spelling.DAMAGED_EVERY} = 0,
            substr(run, 1, (hash % length(run))::BIGINT) || substr(run, (hash % length(run))::BIGINT + 2), run) AS word, n FROM hashed
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}
),
gaps AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
),
near AS (
  SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON b.word = a.rest
),
best AS (SELECT word, count(*) AS n_near, min({{'m': -n, 'o': encode(other)}}) AS first FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, if(-first.m >= {spelling.FORM_RATIO} * w.n, decode(first.o), NULL) AS form,
         if(-first.m >= {spelling.FORM_RATIO} * w.n, -first.m, NULL) AS form_n
  FROM words w LEFT JOIN best USING (word)
),
followed AS (
  WITH RECURSIVE steps(word, reached) AS (
    SELECT word, word FROM formed
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.reached WHERE f.form IS NOT NULL
  )
  SELECT s.word, s.reached AS root FROM steps s JOIN formed f ON f.word = s.reached WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN followed USING (word)"""
