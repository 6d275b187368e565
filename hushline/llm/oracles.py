"""The queries which SQL can express, in another engine's SQL over the same tables."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_TEXT = "coalesce(text, '')"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WARC = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
             max(page_id) OVER (PARTITION BY payload) AS latest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN latest END AS refers_to
FROM q
"""

NEAR_COPIES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_FOLDED)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS sh FROM w, range(1, len(ws) - 2) t(i) WHERE len(ws) >= 4
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT r.node, u.y FROM r JOIN u ON r.reach = u.x),
m AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

REPEATS = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text=_TEXT)} AS ws FROM documents),
v AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS s FROM w, range(1, len(ws) - 33) t(i)),
again AS (SELECT s FROM v GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM v JOIN again USING (s), range(i, i + 35) t(p)),
per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' '))
         AS kept_sha256
FROM w LEFT JOIN per ON per.doc_id = w.doc_id
"""

QUALITY = f"""
WITH w AS (SELECT doc_id, {_TEXT} AS t, {_WORDS.format(text=_TEXT)} AS ws,
                  list_filter(string_split({_TEXT}, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
v AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS s FROM w, range(1, len(ws) - 3) t(i)),
again AS (SELECT doc_id, s FROM v GROUP BY doc_id, s HAVING count(*) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM v JOIN again USING (doc_id, s), range(i, i + 5) t(p) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x, i: i < len(ws) AND x = ws[i + 1])) AS n_same_next,
         length(regexp_replace(t, '[\\x00-@\\[-`{{-\\x7F]', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations
  FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
f AS (
  SELECT *, (n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (100 * n_symbols > 10 * n_words)::INT
         + 8 * (100 * n_dup_lines > 40 * n_lines)::INT + 16 * (100 * n_same_next > 20 * n_words)::INT
         + 32 * (100 * n_upper > 50 * n_letters)::INT + 64 * (100 * n_exclamations > 30 * n_words)::INT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept,
       failed::BIGINT AS failed
FROM f
"""

#: Unsigned crc32 of a list of bytes {bytes}, by the table in one row of `crc`.
_CRC_TABLE = """crc AS MATERIALIZED (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""
_BYTES = """list_transform(range(strlen({text})), lambda i: 16 * (instr('0123456789ABCDEF', substr(hex({text}), 2 * i + 1, 1)) - 1)
  + instr('0123456789ABCDEF', substr(hex({text}), 2 * i + 2, 1)) - 1)"""
_CRC = """xor(list_reduce(list_prepend(4294967295, """ + _BYTES + """),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""

SPELLING = f"""
WITH {_CRC_TABLE},
o AS (SELECT coalesce(doc_id::VARCHAR, '') AS k, unnest(regexp_extract_all({_FOLDED}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
t AS (SELECT k, run, count(*) AS m FROM o WHERE length(run) >= 7 GROUP BY ALL),
h AS (SELECT run, m, {_CRC.format(text="(k || ':' || run)")} AS h FROM t, crc),
g AS (SELECT m, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM h),
w AS (SELECT word, sum(m)::BIGINT AS n FROM g WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
i AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM w, range(1, length(word) + 1) r(i)),
s AS (SELECT x.word, y.word AS other FROM i x JOIN i y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word),
d AS (SELECT DISTINCT i.word, v.word AS other FROM i JOIN w v ON v.word = i.a || i.b),
e AS (SELECT * FROM s UNION ALL SELECT * FROM d UNION ALL SELECT other, word FROM d),
r AS (SELECT e.word, v.word AS form, v.n AS form_n, count(*) OVER (PARTITION BY e.word) AS n_near,
             row_number() OVER (PARTITION BY e.word ORDER BY v.n DESC, v.word) AS place FROM e JOIN w v ON v.word = e.other),
f AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.form_n >= 10 * w.n THEN r.form END AS form,
             CASE WHEN r.form_n >= 10 * w.n THEN r.form_n END AS form_n FROM w LEFT JOIN r ON r.word = w.word AND r.place = 1),
c AS (SELECT word, word AS root, 0 AS far FROM f UNION ALL SELECT c.word, f.form, far + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n
FROM f JOIN (SELECT word, arg_max(root, far) AS root FROM c GROUP BY word) l ON l.word = f.word
""".replace("WITH crc", "WITH RECURSIVE crc")


def _merkle(source_levels: int = 6, top_levels: int = 4) -> str:
    """Levels written out one after the other: enough for 16 ** source_levels rows a source."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = _CRC.format(text="coalesce(doc_id::VARCHAR, '')")
    parts = [f"""{_CRC_TABLE},
leaves AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree, sha256({head} || {field("text")}) AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN sha256({head} || {field(lowered)}) END AS tampered FROM documents, crc),
p0 AS (SELECT doc_id, tree, leaf, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  coalesce(tampered, leaf) AS cur, '' AS proof FROM leaves),
n0 AS (SELECT tree, idx, leaf AS d, count(*) OVER (PARTITION BY tree) AS total FROM p0)"""]

    def level(k: int) -> str:
        left, right = "substr(run, 1, 64 * (p.idx % 16))", "substr(run, 64 * (p.idx % 16) + 65)"
        return f"""r{k} AS (SELECT tree, idx // 16 AS idx, string_agg(d, '' ORDER BY idx) AS run, any_value(total) AS total FROM n{k} GROUP BY ALL),
n{k + 1} AS (SELECT tree, idx, CASE WHEN total = 1 THEN run ELSE sha256(run) END AS d, (total + 15) // 16 AS total FROM r{k}),
p{k + 1} AS (SELECT p.* REPLACE (p.idx // 16 AS idx, CASE WHEN total = 1 THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
  CASE WHEN total = 1 THEN proof ELSE proof || {left} || {right} END AS proof)
  FROM p{k} p JOIN r{k} r ON r.tree = p.tree AND r.idx = p.idx // 16)"""

    parts += [level(k) for k in range(source_levels)]
    up = source_levels
    parts.append(f"""subroots AS (SELECT tree AS name, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS total FROM n{up}),
n{up + 1} AS (SELECT '' AS tree, idx, subroot AS d, total FROM subroots),
p{up + 1} AS (SELECT p.* REPLACE ('' AS tree, s.idx AS idx), s.subroot FROM p{up} p JOIN subroots s ON s.name = p.tree)""")
    parts += [level(k) for k in range(up + 1, up + 1 + top_levels)]
    last = up + 1 + top_levels
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = d AS verified FROM p{last}, n{last}
"""


MERKLE = _merkle()


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_captures": WARC, "op5_near_copies": NEAR_COPIES, "op7_repeated_passages": REPEATS,
        "op8_quality_ledger": QUALITY, "op11_spelling_variants": SPELLING, "op12_merkle_manifest": MERKLE,
    }
