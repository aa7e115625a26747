"""DuckDB SQL for the queries that SQL can express."""

QUALITY_RULES = r"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), measured AS MATERIALIZED (
  SELECT doc_id, host, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS (
  SELECT host, count(*) AS n, sum(base_failed::INT) AS f FROM failed WHERE host IS NOT NULL GROUP BY host
), moments AS (
  SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square, count(*) / sum(n) AS per_host FROM hosts
), prior AS (
  SELECT mean, square - mean * mean - mean * (1 - mean) * per_host AS between_hosts FROM moments
), rates AS (
  SELECT host, CASE WHEN between_hosts <= 1e-12 THEN mean
    ELSE (f + mean * greatest(mean * (1 - mean) / between_hosts - 1, 0))
         / (n + greatest(mean * (1 - mean) / between_hosts - 1, 0)) END AS rate
  FROM hosts, prior
)
SELECT doc_id, failed.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(rate, 6) AS host_rate, coalesce(rate > 0.5, false) AS host_failed,
       NOT base_failed AND NOT coalesce(rate > 0.5, false) AS kept
FROM failed LEFT JOIN rates ON failed.host = rates.host
"""

LINE_DEDUP = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775807) AS k,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), l AS MATERIALIZED (
  SELECT r, k, i, lines[i] AS line FROM (SELECT r, k, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), worded AS MATERIALIZED (
  SELECT r, k, i, line, row_number() OVER (PARTITION BY r ORDER BY i) AS pos
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT a.r, a.k, a.pos, a.line || chr(10) || b.line || chr(10) || c.line AS win
  FROM worded a JOIN worded b ON b.r = a.r AND b.pos = a.pos + 1 JOIN worded c ON c.r = a.r AND c.pos = a.pos + 2
), ranked AS (
  SELECT r, pos, k > min(k) OVER (PARTITION BY win) AS smaller, row_number() OVER (PARTITION BY win, r ORDER BY pos) > 1 AS again
  FROM windows
), gone AS MATERIALIZED (
  SELECT DISTINCT r, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE smaller OR again
), spans AS (
  SELECT r, count(*) AS n, sum(fresh) AS s
  FROM (SELECT r, pos, (pos - 1 IS DISTINCT FROM lag(pos) OVER (PARTITION BY r ORDER BY pos))::INT AS fresh FROM gone)
  GROUP BY r
), kept AS (
  SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.i) AS t
  FROM l LEFT JOIN worded ON worded.r = l.r AND worded.i = l.i LEFT JOIN gone ON gone.r = l.r AND gone.pos = worded.pos
  WHERE gone.pos IS NULL GROUP BY l.r
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN spans USING (r) LEFT JOIN kept USING (r)
"""

DECONTAMINATE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), wanted AS MATERIALIZED (
  SELECT DISTINCT item, least(13, len(words)) AS width,
         array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0)
), widths AS (
  SELECT DISTINCT width FROM wanted
), found AS MATERIALIZED (
  SELECT r, i, width, item
  FROM (SELECT r, width, i, array_to_string(words[i : i + width - 1], ' ') AS win
        FROM (SELECT r, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM d, widths WHERE len(words) >= width))
  JOIN wanted USING (width, win)
), hits AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + width)) AS p FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)
), n AS MATERIALIZED (
  SELECT r, count(*) AS size FROM s GROUP BY r
), common AS MATERIALIZED (
  SELECT shingle FROM s GROUP BY shingle HAVING count(*) > 1
), pairs AS (
  SELECT a.r AS a, b.r AS b, count(*) AS shared
  FROM (SELECT * FROM s SEMI JOIN common USING (shingle)) a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r
  GROUP BY a.r, b.r
), links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.r = a JOIN n y ON y.r = b
  WHERE 100 * shared >= 75 * (x.size + y.size - shared)
), reach AS (
  SELECT r AS a, r AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a
)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id FROM d JOIN least USING (r) LEFT JOIN n USING (r)
"""

NEAREST_VECTORS = r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), usable AS MATERIALIZED (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON c.r <> q.r AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score, vec_id NULLS LAST)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

# The edits are found from the last row back: per state (0 nothing, 1 after system, 2 user, 3 assistant) the least (cost, audit) and its lines.
def _best(state: int, after: str) -> str:
    """The best way on from ``state`` before a row, given those after it in ``after`` (a list of four), without turns put in first."""
    to, named = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))[state]
    nexts = {0: "CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 END", 1: "CASE i WHEN 'u' THEN 2 END", 2: "CASE i WHEN 'a' THEN 3 END", 3: "CASE i WHEN 'u' THEN 2 END"}[state]
    extra = "(CASE WHEN truncated THEN 3 ELSE 0 END)"
    return f"""list_sort(list_filter([
        struct_pack(cost := {after}[{state + 1}].cost + 4, audit := 'D' || {after}[{state + 1}].audit, lines := {after}[{state + 1}].lines),
        CASE WHEN NOT gone AND ({nexts}) IS NOT NULL THEN struct_pack(cost := {after}[({nexts}) + 1].cost + {extra},
          audit := 'K' || {after}[({nexts}) + 1].audit, lines := list_prepend(role || ':' || text, {after}[({nexts}) + 1].lines)) END,
        CASE WHEN NOT gone THEN struct_pack(cost := {after}[{to + 1}].cost + 3 + {extra},
          audit := 'R' || {after}[{to + 1}].audit, lines := list_prepend('{named}:' || text, {after}[{to + 1}].lines)) END
      ], lambda x: x IS NOT NULL))[1]"""


def _or_put(state: int, plain: str, put: str) -> str:
    """The better of going on as ``plain`` says and of a turn put in first, after which ``put`` says how to go on."""
    to, named = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))[state]
    return f"""list_sort([{plain}[{state + 1}],
        struct_pack(cost := {put}[{to + 1}].cost + 3, audit := 'I' || {put}[{to + 1}].audit, lines := list_prepend('{named}:', {put}[{to + 1}].lines))])[1]"""


_FOUR = range(4)
CONVERSATION_REPAIR = f"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
      lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, _: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS how
  FROM plain
), damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) FROM hashed WHERE how <> 0)
), placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c, role[1] AS i,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n
  FROM damaged
), told AS MATERIALIZED (
  SELECT *, blank OR again AS gone, NOT blank AND again AS duplicate, NOT blank AND NOT again AND NOT ended AS truncated,
         lag(i) OVER (PARTITION BY c ORDER BY n) || i AS pair
  FROM (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS ended,
               row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 AS again FROM placed)
), walked AS (
  SELECT c, max(n) + 1 AS n, [
      struct_pack(cost := 0, audit := '', lines := []::VARCHAR[]), struct_pack(cost := 6, audit := 'II', lines := ['user:', 'assistant:']),
      struct_pack(cost := 3, audit := 'I', lines := ['assistant:']), struct_pack(cost := 0, audit := '', lines := []::VARCHAR[])] AS best
  FROM told GROUP BY c
  UNION ALL
  SELECT c, n, [{", ".join(_or_put(s, "once", "once") for s in _FOUR)}] FROM (
    SELECT c, n, bare, [{", ".join(_or_put(s, "bare", "bare") for s in _FOUR)}] AS once FROM (
      SELECT told.c, told.n, [{", ".join(_best(s, "walked.best") for s in _FOUR)}] AS bare
      FROM walked JOIN told ON told.c = walked.c AND told.n = walked.n - 1))
), repaired AS (
  SELECT c, best[1].cost::BIGINT AS cost, best[1].audit AS audit, sha256(array_to_string(best[1].lines, chr(10))) AS repaired_sha256
  FROM walked WHERE n = 1
), counted AS (
  SELECT conv_id, c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::BIGINT)::BIGINT AS blank,
         sum(duplicate::BIGINT)::BIGINT AS duplicate, sum(truncated::BIGINT)::BIGINT AS truncated,
         sum((n > 1 AND pair NOT IN ('su', 'ua', 'au'))::BIGINT)::BIGINT AS illegal
  FROM told GROUP BY conv_id, c
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN repaired USING (c)
"""
