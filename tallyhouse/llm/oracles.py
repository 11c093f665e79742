"""The queries that SQL can express, for DuckDB, over whole tables."""


def _repair_sql() -> str:
    """Least (cost, audit, text) per state, one row at a time from the last; the states are the columns s, h, u, a."""

    def edit(state: str, cost: str, letter: str, line: str | None = None) -> str:
        text = f"{state}.text" if line is None else f"{line} || if({state}.text = '', '', chr(10) || {state}.text)"
        return f"{{'cost': {state}.cost + {cost}, 'audit': '{letter}' || {state}.audit, 'text': {text}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    user, assistant, own = "'user:' || r.text", "'assistant:' || r.text", "r.role || ':' || r.text"
    to_user = (edit("p.u", "r.kept + if(r.initial = 'u', 0, 99999)", "K", own), edit("p.u", "r.kept + 3", "R", user))
    to_assistant = (edit("p.a", "r.kept + if(r.initial = 'a', 0, 99999)", "K", own), edit("p.a", "r.kept + 3", "R", assistant))
    system = edit("p.h", "r.kept + if(r.initial = 's', 0, 99999)", "K", own)
    steps = {
        "s": least(edit("p.s", "4", "D"), *to_user, system),
        "h": least(edit("p.h", "4", "D"), *to_user),
        "u": least(edit("p.u", "4", "D"), *to_assistant),
        "a": least(edit("p.a", "4", "D"), *to_user),
    }
    taken = ", ".join(f"{sql} AS {state}" for state, sql in steps.items())
    add_user, add_assistant = edit("u", "3", "I", "'user:'"), edit("a", "3", "I", "'assistant:'")
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    if(c % 2 = 1, xor(c // 2, 3988292384), c // 2))) AS entries
), keyed AS (
  SELECT *, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                           lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations
), drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
           xor(c // 256, entries[(xor(c, b) % 256) + 1])), 4294967295) % 20 AS chance
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, if(chance = 4, 'user', role) AS role,
         CASE chance WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(if(chance = 3, [1, 2], [1])) AS copy
  FROM drawn WHERE chance <> 0
), ordered AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM ordered
), r AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 99999 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS kept FROM judged
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), best AS (
  SELECT conv_id, n + 1 AS i, {{'cost': 0::BIGINT, 'audit': '', 'text': ''}} AS s,
         {{'cost': 6::BIGINT, 'audit': 'II', 'text': 'user:' || chr(10) || 'assistant:'}} AS h,
         {{'cost': 3::BIGINT, 'audit': 'I', 'text': 'assistant:'}} AS u,
         {{'cost': 0::BIGINT, 'audit': '', 'text': ''}} AS a
  FROM counts
  UNION ALL
  SELECT conv_id, i, {least("s", add_user)}, {least("h", add_user)}, u, a
  FROM (
    SELECT conv_id, i, s, h, {least("u", add_assistant)} AS u, {least("a", add_user)} AS a
    FROM (
      SELECT p.conv_id, r.i, {taken}
      FROM best p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i - 1
    )
  )
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s.cost, 0)::BIGINT AS cost,
       coalesce(s.audit, '') AS audit, sha256(coalesce(s.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.i = 1
"""

ORACLES = {
    "op6_quotations": r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), lines AS (
  SELECT r, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m
), levels AS (
  SELECT *, len(regexp_replace(regexp_extract(line, '^ {0,3}((?:> ?)+)', 1), '[^>]', '', 'g')) AS level,
         trim(regexp_replace(lower(regexp_replace(line, '^ {0,3}((?:> ?)+)', '')), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS body
  FROM lines
), bare AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) AS text FROM levels WHERE level = 0 GROUP BY r
), marked AS (
  SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY r ORDER BY i) THEN 0 ELSE 1 END AS first
  FROM levels WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), numbered AS (
  SELECT *, sum(first) OVER (PARTITION BY r ORDER BY i) AS run FROM marked
), passages AS (
  SELECT DISTINCT conv_id, turn, level, string_agg(body, ' ' ORDER BY i) AS passage, list(body ORDER BY i) AS parts
  FROM numbered WHERE body <> '' GROUP BY r, conv_id, turn, level, run
), spans AS (
  SELECT conv_id, turn, level, passage, parts, string_split(passage, ' ') AS words FROM passages
), tokens AS (
  SELECT conv_id, turn, level, passage,
         array_to_string(words[i:i + 4], ' ') AS token
  FROM (SELECT *, unnest(range(1, len(words) - 3)) AS i FROM spans WHERE level > 0 AND len(words) >= 5)
  UNION
  SELECT conv_id, turn, level, passage, part
  FROM (SELECT conv_id, turn, level, passage, unnest(list_append(parts, passage)) AS part FROM spans WHERE level > 0)
  WHERE len(string_split(part, ' ')) < 5
), own AS (
  SELECT DISTINCT conv_id, turn, array_to_string(words[i:i + n - 1], ' ') AS token
  FROM (SELECT s.*, n, unnest(range(1, len(words) - n + 2)) AS i FROM spans s, range(1, 6) AS t(n)
        WHERE level = 0 AND len(words) >= n AND conv_id IN (SELECT conv_id FROM tokens))
), q AS (
  SELECT t.conv_id, t.turn, t.level, t.passage, t.token, max(o.turn) AS before, count(o.turn) AS holders
  FROM tokens t LEFT JOIN own o ON o.conv_id = t.conv_id AND o.token = t.token AND o.turn < t.turn GROUP BY ALL
), counts AS (
  SELECT conv_id, turn, count(*) AS n_quoted, sum(found) AS n_linked
  FROM (SELECT conv_id, turn, level, passage, max(CASE WHEN before IS NULL THEN 0 ELSE 1 END) AS found FROM q GROUP BY ALL)
  GROUP BY ALL
), rare AS (
  SELECT *, min(holders) OVER (PARTITION BY conv_id, turn, passage) AS fewest FROM q WHERE level = 1 AND before IS NOT NULL
), votes AS (
  SELECT conv_id, turn, before, row_number() OVER (PARTITION BY conv_id, turn ORDER BY count(*) DESC, before DESC) AS place
  FROM rare WHERE holders = fewest GROUP BY conv_id, turn, before
), turns AS (
  SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous
  FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
), replies AS (
  SELECT t.conv_id, t.turn, coalesce(v.before, t.previous) AS reply_to
  FROM turns t LEFT JOIN votes v ON v.conv_id = t.conv_id AND v.turn = t.turn AND v.place = 1
), placed AS (
  SELECT conv_id, turn, reply_to, turn AS thread, 0 AS depth FROM replies WHERE reply_to IS NULL
  UNION ALL
  SELECT c.conv_id, c.turn, c.reply_to, p.thread, p.depth + 1
  FROM replies c JOIN placed p ON p.conv_id = c.conv_id AND p.turn = c.reply_to
)
SELECT m.conv_id, m.turn, m.role, coalesce(b.text, '') AS text, p.reply_to, coalesce(p.thread, m.turn) AS thread,
       coalesce(p.depth, 0)::BIGINT AS depth, coalesce(c.n_quoted, 0)::BIGINT AS n_quoted, coalesce(c.n_linked, 0)::BIGINT AS n_linked
FROM m LEFT JOIN bare b ON b.r = m.r
LEFT JOIN placed p ON p.conv_id = m.conv_id AND p.turn = m.turn
LEFT JOIN counts c ON c.conv_id = m.conv_id AND c.turn = m.turn
""",
    "op7_line_frequency": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r
), lines AS (
  SELECT r, source, line, i, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS body
  FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), bodies AS (
  SELECT DISTINCT source, body FROM (SELECT r, source, list(body ORDER BY i) AS body FROM lines GROUP BY r, source)
), totals AS (
  SELECT source, count(*) + max(lineless) AS documents FROM (
    SELECT source, 0 AS lineless FROM bodies
    UNION ALL SELECT DISTINCT source, 0 FROM d WHERE r NOT IN (SELECT r FROM lines)
  ) GROUP BY source
), frequent AS (
  SELECT x.source, x.line FROM (
    SELECT source, line, count(*) AS holders
    FROM (SELECT source, unnest(list_distinct(body)) AS line FROM bodies) GROUP BY source, line
  ) x JOIN totals t ON t.source IS NOT DISTINCT FROM x.source
  WHERE x.holders >= 5 AND x.holders * 100 > t.documents * 5
), removed AS (
  SELECT l.r, sum(len(string_split(l.body, ' '))) AS n FROM lines l
  JOIN frequent f ON f.source IS NOT DISTINCT FROM l.source AND f.line = l.body GROUP BY l.r
), stats AS (
  SELECT d.r, d.doc_id, len(w.words)::BIGINT AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(x.n, 0) AS gone
  FROM d JOIN w ON w.r = d.r LEFT JOIN covered c ON c.r = d.r LEFT JOIN dups u ON u.r = d.r LEFT JOIN removed x ON x.r = d.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (n_words - gone) * 100 >= n_words * 30 AND n_words - gone >= 50 AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats)
""",
    "op9_partenum": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 2)) AS i FROM w WHERE len(words) >= 4)
  UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 3
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS root, doc_id FROM w
  UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) AS least USING (doc_id)
""",
    "op10_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size FROM pages
), q AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS newest FROM p
), r AS (
  SELECT *, size >= 1000 AND page_id <> newest AS revisit FROM q
)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN newest END AS refers_to
FROM r
""",
    "op11_turn_repair": _repair_sql(),
    "op12_term_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT count(*)::BIGINT AS documents, sum(len(terms))::BIGINT AS all_terms FROM d WHERE len(terms) > 0
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), counted AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighted AS (
  SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, totals GROUP BY term, documents
), lengths AS (
  SELECT r, doc_id, 50 + (50 * len(terms) * documents) // all_terms AS m FROM d, totals WHERE len(terms) > 0
), scores AS (
  SELECT a.item_id, l.doc_id, l.r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked a JOIN weighted USING (term) JOIN counted USING (term) JOIN lengths l USING (r)
  GROUP BY a.item_id, l.doc_id, l.r
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
""",
}
