"""DuckDB SQL for the queries that SQL can express."""

_OP6 = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS source_id
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[(source_id % 3 + 1)::INT]::DOUBLE AS weight, source_size * 3 AS most FROM totals
), levelled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY most / weight, source_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), goals AS (
  SELECT source, source_size, CASE WHEN level * weight >= most THEN most::DOUBLE ELSE least(most::DOUBLE, weight *
    (SELECT arg_min(level, (most / weight, source_id)) FROM levelled WHERE level * weight < most)) END AS target
  FROM levelled
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, coalesce(sum(s.size) OVER (PARTITION BY s.source
      ORDER BY md5(s.doc_id::VARCHAR), s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (
    (before + size / 2 < target)::INT + (source_size + before + size / 2 < target)::INT
    + (source_size * 2 + before + size / 2 < target)::INT))::BIGINT AS taken
FROM placed
"""

_OP7 = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
"""

_OP8 = r"""
WITH messages AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), escaped AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(role) - length(replace(role, chr(10), ''))
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 12 + 1 + 10 + 1 AS chars,
    CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss
  FROM messages
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

# crc32 byte by byte over a table of remainders; paths are lists of (role, text).
_OP11 = r"""
WITH table_of AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
), turns AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, crcs[xor(c, b) % 256 + 1])), 4294967295) % 9 AS taken
  FROM (SELECT DISTINCT conv_id FROM turns), table_of
), rebuilt AS (
  SELECT i.conv_id, 1 AS own, t.place, t.said FROM ids i JOIN turns t ON t.conv_id = i.base AND t.place <= i.taken
  UNION ALL SELECT i.conv_id, 2, t.place, t.said FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place > i.taken
), sequences AS (
  SELECT i.conv_id, coalesce(list(r.said ORDER BY r.own, r.place) FILTER (r.said IS NOT NULL), []) AS said
  FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY i.conv_id
), nodes AS (
  SELECT depth, said[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(said) = depth), '') AS ends
  FROM (SELECT conv_id, said, unnest(range(len(said) + 1)) AS depth FROM sequences) GROUP BY ALL
), families AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.path[n.depth].text) END AS saves
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
)
SELECT n.conv_id, n.depth, any_value(n.parent_conv_id) AS parent_conv_id, any_value(n.n_convs) AS n_convs,
  any_value(n.n_children) AS n_children, count(*) FILTER (m.n_children = 0) AS n_leaves,
  sum(m.saves)::BIGINT AS saved_tokens, sha256(any_value(n.ends)) AS ends_sha256
FROM families n JOIN families m ON m.depth >= n.depth AND m.path[1:n.depth] = n.path
GROUP BY n.conv_id, n.depth, n.path
"""

_OP12 = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: words[i:i + k - 1])) AS phrase
    FROM pieces, (VALUES (1), (2), (3)) AS sizes(k)) GROUP BY ALL
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), parts AS (
  SELECT lang, phrase, f AS a, cut, phrase[1:cut] AS first, phrase[cut + 1:] AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM counts WHERE k > 1 AND f >= 10)
), cuts AS (
  SELECT p.lang, p.phrase, a, x.f AS l, y.f AS r, cut, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = p.first JOIN counts y ON y.lang = p.lang AND y.phrase = p.rest
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, a, unnest([phrase[1:2], phrase[2:3]]) AS part FROM scored WHERE len(phrase) = 3) GROUP BY ALL
), ranked AS (
  SELECT s.*, array_to_string(s.phrase, ' ') AS words, row_number() OVER (PARTITION BY s.lang
    ORDER BY s.score DESC, s.a DESC, array_to_string(s.phrase, ' ')) AS place
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a
)
SELECT lang, place AS rank, words AS phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE place <= 2000
"""

ORACLES: dict[str, str] = {
    "op6_mixing": _OP6, "op7_exact_dedup": _OP7, "op8_chat_formatting": _OP8, "op11_conversation_trie": _OP11,
    "op12_collocations": _OP12,
}
