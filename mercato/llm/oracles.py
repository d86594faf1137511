"""DuckDB SQL for the queries of this package that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def crc32(text: str) -> str:
    """CRC-32 of an ASCII expression, bit by bit."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(substr({text}, i::INT, 1)), 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))"
    step = "xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)"
    return f"xor(list_reduce({bits}, lambda a, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


ORACLES: dict[str, str] = {
    # all 13-word windows, the smallest document of each, the words they cover
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT k, min(doc_id) AS first FROM p GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM p JOIN f USING (k) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op3_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, s, array_to_string(w[i:i + s - 1], ' ') AS k
       FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS i
             FROM (SELECT *, least(10, len(w)) AS s FROM b WHERE len(w) > 0))),
p AS (SELECT doc_id, i, s, array_to_string(w[i:i + s - 1], ' ') AS k
      FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i
            FROM d, (SELECT DISTINCT s FROM bw) WHERE len(w) >= s)),
hit AS (SELECT doc_id, i, s, item_id FROM p JOIN bw USING (s, k)),
n AS (SELECT doc_id, count(*) AS n_hit
      FROM (SELECT DISTINCT doc_id, unnest(range(i, i + s)) AS i FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op4_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met
          FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * met >= 90 * (x.n + y.n - met)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
""",
    # bytes as two hex digits each
    "op6_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 800)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)),
r AS (SELECT doc_id, i FROM p WHERE k IN (SELECT k FROM p GROUP BY k HAVING count(*) > 1)),
m AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true) AS fresh FROM r),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b
         FROM (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM m)
         GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM runs),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS t, max(b) AS e,
                sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans
         FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(t || substr(h, 2 * e + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op2_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
""",
    "op9_chat_format": r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
p AS (SELECT *, '<|im_start|>'
             || replace(replace(replace(role, '%', '%25'), '<', '%3C'), chr(10), '%0A') || chr(10)
             || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS piece
      FROM c),
a AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                                 ORDER BY turn, role, text), '') AS loss,
             sum(length(piece))::BIGINT AS formatted_chars
      FROM p GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM a
""",
    # every prefix of every rebuilt conversation by the hashes of its turns; subtrees by members
    "op11_prefix_trie": rf"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, {crc32("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM own)),
built AS (SELECT cs.c, i, role, text FROM cs JOIN own ON own.c = cs.c - cs.c % 5 AND i <= h
          UNION ALL SELECT cs.c, i + 9, role, text FROM cs JOIN own ON own.c = cs.c AND i > h),
t AS (SELECT c, row_number() OVER w AS d, octet_length(encode(text)) AS b,
             string_agg(md5(length(role) || ':' || role || text), '') OVER w AS k
      FROM built WINDOW w AS (PARTITION BY c ORDER BY i)),
p AS (SELECT c, d, b, k FROM t UNION ALL SELECT c, 0, 0, '' FROM cs),
len AS (SELECT c, max(d) AS n FROM p GROUP BY c),
node AS (SELECT d, k, min(p.c) AS conv_id, count(*) AS n_convs, any_value(b) AS b, count(*) FILTER (n > d) AS more,
                coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (n = d), '') AS ends
         FROM p JOIN len USING (c) GROUP BY d, k),
kids AS (SELECT d - 1 AS d, left(k, -32) AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
sub AS (SELECT a.d, a.k, sum((b.n_convs - 1) * b.b)::BIGINT AS saved_tokens, count(*) FILTER (b.more = 0) AS n_leaves
        FROM node a JOIN node b ON b.d >= a.d AND left(b.k, 32 * a.d) = a.k GROUP BY a.d, a.k)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN sub USING (d, k) LEFT JOIN kids USING (d, k)
LEFT JOIN node up ON up.d = node.d - 1 AND up.k = left(node.k, -32)
""",
    # states: 0 nothing, 1 s, 2 u, 3 a; up to two inserts before each row and behind the last
    "op12_structure_repair": rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS x
  FROM conversations),
bad AS (SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN x = 1 THEN '' WHEN x = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM raw JOIN (VALUES (0), (1)) v(copy) ON copy = 0 OR x = 3 WHERE x <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM bad),
r AS (SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS f
      FROM num),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
                 count(*) FILTER (f = 't') AS truncated, max(pos) AS n,
                 count(*) FILTER (pos > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
          FROM r GROUP BY conv_id),
ins AS (SELECT * FROM (VALUES (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
    (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']),
    (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']), (2, 2, 2, ['assistant:', 'user:']),
    (3, 2, 3, ['user:', 'assistant:'])) v(s, k, q, lines)),
edit AS (SELECT * FROM (VALUES (0, 'D', 0), (1, 'D', 1), (2, 'D', 2), (3, 'D', 3), (0, 'Ks', 1),
    (0, 'Ku', 2), (1, 'Ku', 2), (3, 'Ku', 2), (2, 'Ka', 3), (0, 'R', 2), (1, 'R', 2), (2, 'R', 3), (3, 'R', 2)) v(s, e, q)),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM r
  UNION ALL
  SELECT conv_id, pos, s, cost, audit, lines FROM (
    SELECT r.conv_id, r.pos, edit.q AS s, dp.audit || repeat('I', k) || left(e, 1) AS audit,
           dp.cost + 3 * k + CASE left(e, 1) WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN f = 't' AND e <> 'D' THEN 3 ELSE 0 END AS cost,
           list_concat(list_concat(dp.lines, ins.lines::VARCHAR[]), CASE left(e, 1) WHEN 'D' THEN []
             WHEN 'K' THEN [role || ':' || text] ELSE [CASE edit.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END)
             AS lines
    FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.pos = dp.pos + 1
    JOIN ins ON ins.s = dp.s JOIN edit ON edit.s = ins.q
    WHERE (e = 'D' OR f NOT IN ('b', 'd')) AND (e IN ('D', 'R') OR e = 'K' || i))
  QUALIFY row_number() OVER (PARTITION BY conv_id, pos, s ORDER BY cost, audit) = 1),
done AS (SELECT dp.conv_id, dp.cost + 3 * k AS cost, audit || repeat('I', k) AS audit,
                list_concat(dp.lines, ins.lines::VARCHAR[]) AS lines
         FROM dp JOIN stats ON stats.conv_id IS NOT DISTINCT FROM dp.conv_id AND n = pos
         JOIN ins ON ins.s = dp.s AND ins.q IN (0, 3)
         QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + 3 * k, audit || repeat('I', k)) = 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op13_minhash_dedup": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS k
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met
          FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * met >= 80 * (x.n + y.n - met)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id,
       d.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
""",
}
