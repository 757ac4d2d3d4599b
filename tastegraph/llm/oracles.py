"""SQL for the queries that SQL can express."""

import string

LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
WORDS = rf"coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

DECONTAMINATE = f"""
WITH item AS (SELECT item_id, {WORDS} AS w FROM benchmark),
span AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS body FROM (
        SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s
        FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {WORDS} AS w FROM documents),
gram AS (
    SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS body FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM span))),
met AS (SELECT doc_id, s, n, item_id FROM gram JOIN span USING (n, body)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM met)
    GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

BITSLICE = """
WITH q AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
        CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE word AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM word),
element AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingle),
pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM element a JOIN element b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT link.b, reach.other FROM reach JOIN link ON link.a = reach.doc_id),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM shingle JOIN least USING (doc_id)
"""

# links of three-word shingles; where one set is much larger than the other there is none
SET_LINKS = rf"""
WITH RECURSIVE word AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS (
    SELECT doc_id, CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM word),
element AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingle),
pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM element a JOIN element b ON a.x = b.x AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT link.b, reach.other FROM reach JOIN link ON link.a = reach.doc_id),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id FROM shingle JOIN least USING (doc_id)
"""

INFILL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
        list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('1:' || CAST(doc_id AS VARCHAR)), i, 8) AS BIGINT)) AS h
    FROM documents),
cut AS (
    SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
            WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
part AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM part
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_OWN = "CAST(doc_id AS VARCHAR)"
_HEAD = " || ".join(_field(v) for v in (_OWN, "source", "lang", "CAST(n_chars AS VARCHAR)"))
# the remainder of the polynomial division, bit by bit over the digits of the id
_CRC = f"""xor(list_reduce(list_transform(range(1, strlen({_OWN}) + 1), lambda i: CAST(ascii(substr({_OWN}, i, 1)) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda c, bit: xor(c >> 1, (c & 1) * 3988292384), xor(crc, byte)), 4294967295), 4294967295)"""

MANIFEST = f"""
WITH RECURSIVE own AS (
    SELECT doc_id, coalesce('+' || lang, '') AS grp, sha256({_HEAD} || {_field("text")}) AS leaf,
        CASE WHEN {_CRC} % 3 = 0 THEN sha256({_HEAD} || {_field(LOWER)}) ELSE sha256({_HEAD} || {_field("text")}) END AS found
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY grp) AS total
    FROM own),
tree AS (
    SELECT 0 AS level, grp, place, total, leaf AS node FROM leaves
    UNION ALL
    SELECT level + 1, grp, place // 8, (total + 7) // 8, sha256(string_agg(node, '' ORDER BY place)) FROM tree WHERE total > 1
    GROUP BY level, grp, place // 8, total),
roots AS (SELECT grp, node, level AS depth, row_number() OVER (ORDER BY grp) - 1 AS rank, count(*) OVER () AS groups FROM tree WHERE total = 1),
top AS (
    SELECT 0 AS level, rank AS place, groups AS total, node FROM roots
    UNION ALL
    SELECT level + 1, place // 8, (total + 7) // 8, sha256(string_agg(node, '' ORDER BY place)) FROM top WHERE total > 1
    GROUP BY level, place // 8, total),
sibling AS (
    SELECT level, grp, place, total,
        coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM (
        SELECT level, grp, place, total, node FROM tree
        UNION ALL SELECT depth + top.level, grp, place, total, top.node FROM top, (SELECT DISTINCT depth, '*' || depth AS grp FROM roots))
    WHERE total > 1 WINDOW run AS (PARTITION BY level, grp, place // 8 ORDER BY place)),
step AS (
    SELECT grp AS own_grp, s.grp, rank, depth, s.level, s.place, s.l, s.r FROM roots JOIN sibling s USING (grp)
    UNION ALL SELECT roots.grp, s.grp, rank, depth, s.level, s.place, s.l, s.r FROM roots JOIN sibling s ON s.grp = '*' || depth),
path AS (
    SELECT leaves.grp, leaves.place, leaves.found, 0 AS level, leaves.found AS fold, '' AS proof FROM leaves
    UNION ALL
    SELECT p.grp, p.place, p.found, p.level + 1, sha256(s.l || p.fold || s.r), p.proof || s.l || s.r
    FROM path p JOIN step s ON s.own_grp = p.grp AND s.level = p.level
        AND s.place = CASE WHEN p.level < s.depth THEN p.place // CAST(8 ** p.level AS BIGINT) ELSE s.rank // CAST(8 ** (p.level - s.depth) AS BIGINT) END
        AND (s.grp = p.grp) = (p.level < s.depth)),
last AS (SELECT grp, place, fold, proof FROM path QUALIFY level = max(level) OVER (PARTITION BY grp, place))
SELECT doc_id, leaf, roots.node AS subroot, t.node AS root, sha256(last.proof) AS proof_sha256, last.fold AS folded_root,
    last.fold = t.node AS verified
FROM leaves JOIN last USING (grp, place) JOIN roots USING (grp), (SELECT node FROM top WHERE total = 1) t
"""

ORACLES = {"op11_setrelations": SET_LINKS, "op12_infill": INFILL, "op13_manifest": MANIFEST, "op3_bitslice": BITSLICE, "op7_minhash": NEAR_DUPLICATES, "op9_decontaminate": DECONTAMINATE}
