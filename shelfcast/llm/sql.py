"""DuckDB SQL for the queries it can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = f"'{UPPER}', '{UPPER.lower()}'"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {_BLANKS}), {_LOW}) AS key FROM lines),
hot AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.keeper AS gone
  FROM keyed k LEFT JOIN hot h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP3 = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOW}), {_WORDS}) AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOW}), {_WORDS}) AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, sizes WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.n, p.i, f.item_id FROM places p JOIN windows f USING (n, win)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT a AS id, b AS seen FROM link
  UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.seen = l.a),
least AS (SELECT id, min(seen) AS seen FROM reach GROUP BY id),
n AS (SELECT a AS id, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links,
       least(e.vec_id, coalesce(l.seen, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.seen, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.id = e.vec_id LEFT JOIN least l ON l.id = e.vec_id
"""

def _nibble(value: int) -> int:
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


_NIBBLES = "[" + ", ".join(str(_nibble(i)) for i in range(16)) + "]"


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, four bits at a time, the low ones of a byte first."""
    digits = f"string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '')"
    numbers = f"list_transform({digits}, lambda d: strpos('0123456789ABCDEF', d)::BIGINT - 1)"
    step = f"lambda c, d: xor(c >> 4, ({_NIBBLES})[(xor(c, d) & 15) + 1])"
    return f"xor(list_reduce({numbers}, {step}, 4294967295::BIGINT), 4294967295)"


OP11 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_LOW}), {_WORDS}) AS w
  FROM documents),
item AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), {_LOW}), {_WORDS}) AS w FROM benchmark),
source_runs AS (
  SELECT r, array_to_string(w[i:i + n - 1], ' ') AS f
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (VALUES (1), (2), (3)) sizes(n) WHERE len(w) >= n)),
target_runs AS (
  SELECT array_to_string(w[i:i + n - 1], ' ') AS f
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM item, (VALUES (1), (2), (3)) sizes(n) WHERE len(w) >= n)),
distinct_runs AS (SELECT f FROM source_runs UNION SELECT f FROM target_runs),
bucket_of AS (SELECT f, {crc32("f")} % 10000 AS b FROM distinct_runs),
source_counts AS (SELECT b, count(*) AS n FROM source_runs JOIN bucket_of USING (f) GROUP BY b),
target_counts AS (SELECT b, count(*) AS n FROM target_runs JOIN bucket_of USING (f) GROUP BY b),
totals AS (
  SELECT (SELECT count(*) FROM source_runs) AS s_all, (SELECT count(*) FROM target_runs) AS t_all),
gains AS (
  SELECT buckets.b, floor(1000 * ln(
           (coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
           / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) buckets(b), totals
  LEFT JOIN source_counts s ON s.b = buckets.b LEFT JOIN target_counts t ON t.b = buckets.b),
weights AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM source_runs JOIN bucket_of USING (f) JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT doc.r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         len(w) >= 20 AS enough,
         coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln(
           (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
            + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM doc LEFT JOIN weights USING (r)),
places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE enough)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT 5 * count(*) // 100 FROM places) THEN place END AS rank
FROM scored LEFT JOIN places USING (r)
"""


def _field(column: str) -> str:
    text = f"{column}::VARCHAR"
    return f"coalesce(octet_length(encode({text}))::VARCHAR || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def _levels(name: str, nodes: str) -> str:
    """Nodes (g, place, n, node) with all above them: (g, level, place, n, node)."""
    return f"""
{name} AS (
  SELECT g, 0 AS level, place, n, node FROM {nodes}
  UNION ALL
  SELECT g, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
  FROM {name} WHERE n > 1 GROUP BY g, level, place // 8, n)"""


def _steps(name: str, levels: str) -> str:
    """What stands left and right of each node in its run, below the root."""
    return f"""
{name} AS (
  SELECT a.g, a.level, a.place,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lefts,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rights
  FROM {levels} a JOIN {levels} b
    ON a.g IS NOT DISTINCT FROM b.g AND a.level = b.level AND a.place // 8 = b.place // 8
  WHERE a.n > 1 GROUP BY a.g, a.level, a.place)"""


def _walk(name: str, starts: str, steps: str) -> str:
    """Rows (r, g, place, folded, proof) led up a tree as far as it goes."""
    return f"""
{name} AS (
  SELECT r, g, 0 AS level, place, folded, proof FROM {starts}
  UNION ALL
  SELECT w.r, w.g, w.level + 1, w.place // 8, sha256(s.lefts || w.folded || s.rights),
         w.proof || s.lefts || s.rights
  FROM {name} w JOIN {steps} s
    ON s.g IS NOT DISTINCT FROM w.g AND s.level = w.level AND s.place = w.place)"""


OP12 = f"""
WITH RECURSIVE rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, lang AS g, {_leaf("text")} AS node,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0
              THEN {_leaf(f"translate(text, {_LOW})")} ELSE {_leaf("text")} END AS claim
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS place,
         count(*) OVER (PARTITION BY g) AS n
  FROM rows_of),
{_levels("tree", "leaves")},
subroots AS (
  SELECT g AS lang, node, true AS g,
         row_number() OVER (ORDER BY g IS NOT NULL, encode(g)) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1),
{_levels("crown", "subroots")},
root AS (SELECT node AS root FROM crown WHERE n = 1),
{_steps("tree_steps", "tree")},
{_steps("crown_steps", "crown")},
starts AS (SELECT r, g, place, claim AS folded, '' AS proof FROM leaves),
{_walk("climb", "starts", "tree_steps")},
middle AS (
  SELECT c.r, s.g, s.place, c.folded, c.proof
  FROM (SELECT r, g, max_by(folded, level) AS folded, max_by(proof, level) AS proof
        FROM climb GROUP BY r, g) c
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.g),
{_walk("crown_climb", "middle", "crown_steps")},
ends AS (
  SELECT r, max_by(folded, level) AS folded, max_by(proof, level) AS proof
  FROM crown_climb GROUP BY r)
SELECT doc_id, l.node AS leaf, s.node AS subroot, root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = root AS verified
FROM leaves l JOIN ends USING (r) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.g, root
"""

OP13 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id, d.r AS row,
         list_inner_product(q.e::DOUBLE[], d.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.r <> d.r AND len(q.e) = len(d.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, row) AS rank FROM scores)
WHERE rank <= 10
"""

ORACLES = {
    "op2_line_dedup": OP2,
    "op3_decontaminate": OP3,
    "op10_embedding_dedup": OP10,
    "op11_importance_resampling": OP11,
    "op12_merkle_manifest": OP12,
    "op13_top_k": OP13,
}
