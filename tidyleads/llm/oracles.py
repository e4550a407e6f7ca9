"""DuckDB SQL of the operators that SQL can express."""

OP3 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS spread FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS weight,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM d GROUP BY source),
cum AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         coalesce(sum(2 * source_size) OVER w, 0) AS filled, coalesce(sum(weight) OVER w, 0) AS used,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM per WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT *, (1.5::DOUBLE * total - filled::DOUBLE) / (weights - used)::DOUBLE AS l FROM cum),
pick AS (SELECT arg_min(l, {'ratio': cap / weight, 'down': -l}) AS l FROM lev WHERE l * weight <= cap),
tgt AS (SELECT lev.source, source_size, kind, least(cap, coalesce(pick.l * weight, cap)) AS target FROM lev, pick),
seg AS (SELECT * FROM (VALUES (0, 0.0, 1.0, 1.5, -1.0, 0.0), (1, 0.0, 1.0, 1.0, 0.0, 0.0),
                              (2, 0.0, 0.5, 0.25, 1.5, 0.0), (2, 0.5, 0.5, 1.0, 1.5, 0.3125)) s(kind, t0, len, w, m, y0)),
laid AS (
  SELECT d.*, t.source_size, t.target, t.kind,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY spread, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source),
runs AS (
  SELECT *, greatest(least(floor(target) - before, size), 0) AS w0, greatest(least(floor(target) - before - source_size, size), 0) AS w1 FROM laid),
share AS (SELECT *, CASE WHEN w0 > 0 THEN (before + w0 / 2) / target::DOUBLE END AS y FROM runs),
pos AS (
  SELECT s.*, (SELECT max_by(g.t0 + least(2 * (s.y - g.y0) / (g.w + sqrt(greatest(g.w * g.w + 2 * g.m * (s.y - g.y0), 0))), g.len), g.y0)
               FROM seg g WHERE g.kind = s.kind AND g.y0 <= s.y) AS position FROM share s)
SELECT doc_id, size, source, source_size, target, CAST(w0 + w1 AS BIGINT) AS taken, round(position::DOUBLE, 9) AS position FROM pos
"""

OP2 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.conv_id, perspective, turn, speaker, content,
         CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10) WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || speaker || '|>' || chr(10) END AS head
  FROM t JOIN who ON t.conv_id IS NOT DISTINCT FROM who.conv_id),
s AS (SELECT *, head || content || '<|end|>' || chr(10) AS segment FROM r),
o AS (
  SELECT *, row_number() OVER w - 1 AS seq, sum(length(segment)) OVER w - length(segment) AS pos0 FROM s
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, segment ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, CAST(seq AS BIGINT) AS seq, speaker, segment, speaker = perspective AS in_loss,
       CAST(pos0 + length(head) AS BIGINT) AS start, CAST(pos0 + length(segment) - 1 AS BIGINT) AS "end" FROM o
"""

OP5 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

#: CRC-32 of texts: `of` gives the 256 remainders; _crc(x) folds the bytes of x over them.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS rem)"""


def _crc(text: str) -> str:
    bytes_ = (f"list_transform(range(strlen({text})), lambda i: CAST(16 * (strpos('0123456789ABCDEF', substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 1)) - 1)"
              f" + strpos('0123456789ABCDEF', substr(hex(encode({text})), CAST(2 * i + 2 AS INT), 1)) - 1 AS BIGINT))")
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}),"
            f" lambda c, b: xor(c >> 8, rem[1 + (xor(c, b) & 255)])), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
src AS (SELECT source AS name, row_number() OVER (ORDER BY source NULLS FIRST) AS sid FROM (SELECT DISTINCT source FROM documents)),
leaf AS (
  SELECT row_number() OVER () AS rid, doc_id, sid, {_leaf('text')} AS leaf,
         CASE WHEN {_crc("coalesce(CAST(doc_id AS VARCHAR), 'null')")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS changed
  FROM crc, documents JOIN src ON documents.source IS NOT DISTINCT FROM src.name),
placed AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY sid) AS n FROM leaf),
node AS (
  SELECT sid, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT sid, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY sid, level, n, pos // 3),
sub AS (SELECT sid, digest AS subroot FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, sid - 1 AS pos, (SELECT count(*) FROM sub) AS n, subroot AS digest FROM sub
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, n, pos // 3),
step AS (
  SELECT a.rid, b.level, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos // CAST(3 ** b.level AS BIGINT)), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos // CAST(3 ** b.level AS BIGINT)), '') AS r
  FROM placed a JOIN node b ON a.sid = b.sid AND b.n > 1 AND b.pos // 3 = a.pos // CAST(3 ** (b.level + 1) AS BIGINT) GROUP BY a.rid, b.level
  UNION ALL
  SELECT a.rid, 1000 + b.level, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < (a.sid - 1) // CAST(3 ** b.level AS BIGINT)), ''),
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > (a.sid - 1) // CAST(3 ** b.level AS BIGINT)), '')
  FROM placed a JOIN top b ON b.n > 1 AND b.pos // 3 = (a.sid - 1) // CAST(3 ** (b.level + 1) AS BIGINT) GROUP BY a.rid, b.level),
path AS (SELECT rid, string_agg(l || r, '' ORDER BY level) AS proof, list({{'l': l, 'r': r}} ORDER BY level) AS steps FROM step GROUP BY rid),
root AS (SELECT digest AS root FROM top WHERE n = 1),
folded AS (
  SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': changed, 'r': ''}}, coalesce(steps, [])), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root
  FROM placed LEFT JOIN path USING (rid) JOIN sub USING (sid), root)
SELECT *, folded_root = root AS verified FROM folded
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP12 = f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
w AS (SELECT rid, unnest(words) AS word FROM d),
b AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
of AS (SELECT word, {_crc('word')} % 10000 AS bucket FROM (SELECT word FROM w UNION SELECT word FROM b), crc),
s AS (SELECT bucket, count(*) AS s FROM w JOIN of USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN of USING (word) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM w) AS sn, (SELECT count(*) FROM b) AS tn),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (sn + 10000) AS DOUBLE) / CAST((s + 1) * (tn + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), n),
sums AS (SELECT rid, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN of USING (word) JOIN gain USING (bucket) GROUP BY rid),
sc AS (
  SELECT rid, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
           / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN sums USING (rid)),
drawn AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r, count(*) OVER () AS n FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM sc LEFT JOIN drawn USING (rid)
"""
