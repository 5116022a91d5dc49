"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

#: White space of the word pattern.
_WORD = r"[^\x20\x09-\x0D]+"


def mixing_sql(powers: dict[str, float], fraction: float, rounds: int = 60) -> str:
    """Raking unrolled: a step a dimension and round, each scaling by target over sum.  Cells in
    falling order of weight over tokens: with the first k whole, the rest share what is missing; the
    first k that leaves no later cell above one is the right one."""
    steps = []
    previous = "start"
    for k in range(rounds):
        for dim in ("source", "lang", "topic"):
            name = f"{dim}_{k}"
            steps.append(f"""{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens,
  c.weight * t.share / sum(c.weight) OVER (PARTITION BY c.{dim}) AS weight
  FROM {previous} c JOIN target_{dim} t ON c.{dim} IS NOT DISTINCT FROM t.value)""")
            previous = name
    targets = ",\n".join(f"""target_{dim} AS MATERIALIZED (SELECT value, raised / sum(raised) OVER () AS share FROM
  (SELECT {dim} AS value, pow(sum(tokens), {power}) AS raised FROM cells GROUP BY {dim}
   HAVING sum(tokens) > 0))""" for dim, power in powers.items())
    return f"""WITH marked AS MATERIALIZED (SELECT doc_id, source, lang,
  CASE WHEN contains(text, ' | ') THEN 'table' WHEN length(text) < 500 THEN 'short'
       WHEN length(text) < 5000 THEN 'medium' ELSE 'long' END AS topic,
  coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS n_tokens,
  '0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS draw FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM marked GROUP BY ALL),
{targets},
start AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS weight FROM cells),
{", ".join(steps)},
ratios AS MATERIALIZED (SELECT *, weight / tokens AS ratio FROM {previous} WHERE tokens > 0),
filled AS (SELECT ratio, ({fraction} * (SELECT sum(tokens) FROM ratios)
  - coalesce(sum(tokens) OVER (ORDER BY ratio DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY ratio DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor FROM ratios),
chance AS (SELECT source, lang, topic, ratio * (SELECT arg_max(factor, ratio) FROM filled WHERE factor * ratio <= 1) AS p
  FROM ratios)
SELECT m.doc_id, m.source, m.lang, m.topic, m.n_tokens::BIGINT AS n_tokens, round(least(1.0, p), 6) AS probability
FROM marked m JOIN chance c ON m.source IS NOT DISTINCT FROM c.source
  AND m.lang IS NOT DISTINCT FROM c.lang AND m.topic IS NOT DISTINCT FROM c.topic
WHERE m.n_tokens > 0 AND ('0x' || substr(md5(m.draw), 1, 13))::BIGINT / 4503599627370496.0 < p"""


CHAT_SQL = r"""WITH last AS (SELECT conv_id, max(turn) AS turn FROM conversations
  WHERE role = 'assistant' GROUP BY conv_id),
reply AS (SELECT c.conv_id, c.turn, c.text FROM conversations c JOIN last USING (conv_id, turn)
  WHERE c.role = 'assistant'),
chosen AS (SELECT conv_id, turn, role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations),
rejected AS (SELECT c.conv_id, c.turn, c.role, c.pos, CASE WHEN mine.turn = c.turn AND c.role = 'assistant'
  THEN coalesce(other.text, '') ELSE c.text END AS text FROM chosen c
  LEFT JOIN reply mine ON mine.conv_id = c.conv_id
  LEFT JOIN reply other ON other.conv_id = xor(c.conv_id, 1)),
prefix AS (SELECT c.conv_id, coalesce(min(CASE WHEN c.text <> r.text OR c.role <> r.role THEN c.pos END) - 1,
  count(*)) AS n FROM chosen c JOIN rejected r USING (conv_id, pos) GROUP BY c.conv_id),
sides AS (SELECT 'chosen' AS side, * FROM chosen UNION ALL BY NAME SELECT 'rejected' AS side, * FROM rejected),
shown AS (SELECT s.*, p.n, '<|' || role || '|>' || chr(10) AS head,
  '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM sides s JOIN prefix p USING (conv_id)),
placed AS (SELECT *, coalesce(sum(length(line)) FILTER (WHERE pos > n) OVER (
  PARTITION BY side, conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM shown),
made AS (SELECT conv_id, side, any_value(n) AS n,
  coalesce(string_agg(line, '' ORDER BY pos) FILTER (WHERE pos <= n), '') AS prompt,
  coalesce(string_agg(line, '' ORDER BY pos) FILTER (WHERE pos > n), '') AS completion,
  coalesce(string_agg((before + length(head))::BIGINT::VARCHAR || '-' || (before + length(line) - 1)::BIGINT::VARCHAR, ','
    ORDER BY pos) FILTER (WHERE pos > n AND role = 'assistant'), '') AS train FROM placed GROUP BY conv_id, side)
SELECT c.conv_id, c.n::INT AS n_prompt_turns, c.prompt, c.completion AS chosen, c.train AS chosen_train,
  r.completion AS rejected, r.train AS rejected_train, c.train <> '' AND r.train <> '' AS usable
FROM made c JOIN made r ON c.conv_id = r.conv_id AND c.side = 'chosen' AND r.side = 'rejected'"""


QUALITY_SQL = rf"""WITH w AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text,
  coalesce(regexp_extract_all(text, '{_WORD}'), []) AS words FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
grams AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM grams),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM keyed) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
  length(array_to_string(words, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
  length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims,
  len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) AS n_stutters,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * n_upper > n_letters
       OR 2 * n_exclaims > n_words OR 2 * n_stutters > n_words
       OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM b"""


#: CRC-32 of the digits of conv_id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: 0::BIGINT)),
      lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"""

TRIE_SQL = rf"""WITH own AS MATERIALIZED (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shared AS (SELECT conv_id, turns, {_CRC} % 4 AS h FROM own),
built AS MATERIALIZED (SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 20),
steps AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built),
marked AS MATERIALIZED (SELECT conv_id, depth, turns[1:depth]::VARCHAR AS path, turns[depth].text AS text,
  turns[1:depth - 1]::VARCHAR AS above, depth = len(turns) AS ends FROM steps),
nodes AS MATERIALIZED (SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(any_value(len(regexp_extract_all(text, '{_WORD}'))), 0) AS words,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM marked GROUP BY depth, path),
kin AS (SELECT n.depth, n.path, count(c.path) AS n_children FROM nodes n
  LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.above = n.path GROUP BY n.depth, n.path),
full_nodes AS MATERIALIZED (SELECT n.*, k.n_children FROM nodes n JOIN kin k USING (depth, path)),
pairs AS (SELECT DISTINCT a.depth, a.path, b.depth AS below_depth, b.path AS below
  FROM marked a JOIN marked b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (SELECT p.depth, p.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
  sum((b.n_convs - 1) * b.words) AS saved_tokens
  FROM pairs p JOIN full_nodes b ON b.depth = p.below_depth AND b.path = p.below GROUP BY p.depth, p.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (depth, path)
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.path = n.above AND n.depth > 0"""


WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d),
t AS (SELECT *, payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN kept END AS refers_to FROM t"""
