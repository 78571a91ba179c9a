"""DuckDB SQL of the registered Merkle query."""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


#: CRC-32 of the decimal doc_id, a bit at a time.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
       lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))


def _levels(name: str, leaves: str) -> str:
    """Nodes of all levels, and each one's siblings to the left and right."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, idx, n, hash FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n),
{name}_sides AS (
  SELECT tree, level, idx,
         coalesce(lag(hash, 2) OVER run, '') || coalesce(lag(hash) OVER run, '') AS l,
         coalesce(lead(hash) OVER run, '') || coalesce(lead(hash, 2) OVER run, '') AS r
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, idx // 3 ORDER BY idx))"""


def _walk(name: str, start: str, sides: str) -> str:
    return f"""{name} AS (
  SELECT id, tree, 0 AS level, idx, proof, folded FROM {start}
  UNION ALL
  SELECT id, w.tree, w.level + 1, w.idx // 3, proof || l || r, sha256(l || folded || r)
  FROM {name} w JOIN {sides} s ON s.tree = w.tree AND s.level = w.level AND s.idx = w.idx),
{name}_end AS (SELECT id, tree, proof, folded FROM {name} QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1)"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, source, {_field('source')} AS tree, sha256({_HEAD} || {_field('text')}) AS hash,
         sha256({_HEAD} || {_field("CASE WHEN " + _CRC + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS stored
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM d),
{_levels('inside', 'placed')},
subroots AS (
  SELECT s.tree AS source_tree, '' AS tree, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM inside s JOIN (SELECT DISTINCT tree, source FROM d) USING (tree) WHERE n = 1),
{_levels('above', 'subroots')},
starts AS (SELECT id, tree, idx, '' AS proof, stored AS folded FROM placed),
{_walk('low', 'starts', 'inside_sides')},
middles AS (SELECT e.id, s.tree, s.idx, e.proof, e.folded FROM low_end e JOIN subroots s ON s.source_tree = e.tree),
{_walk('high', 'middles', 'above_sides')}
SELECT p.doc_id, p.hash AS leaf, s.hash AS subroot, t.hash AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
       e.folded = t.hash AS verified
FROM placed p JOIN high_end e ON e.id = p.id JOIN subroots s ON s.source_tree = p.tree, (SELECT hash FROM above WHERE n = 1) t"""
