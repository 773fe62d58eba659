"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLE: dict[str, str] = {
    "op2_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    role IS NULL AS no_role, text IS NULL AS no_text FROM conversations
  UNION ALL
  SELECT -1, i, role, '<|im_end|><|im_start|>assistant ok', FALSE, FALSE
  FROM (VALUES (0, 'user'), (1, 'assistant')) x(i, role)
), written AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '|', '\|') AS safe_role,
    regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS safe_text FROM turns
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, no_role DESC, role, no_text DESC, text) AS plain,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, no_text DESC, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<|im_start|>' || safe_role || chr(10) || safe_text || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
  FROM written GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(plain) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars
FROM joined
""",
    "op8_substrings": r"""
WITH texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i + 1 : i + 35], ' ')) AS content
  FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - 34, 0))) AS i FROM texts)
), repeated AS (SELECT content FROM windows GROUP BY content HAVING count(*) > 1),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows JOIN repeated USING (content)
), placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM placed ANTI JOIN removed USING (doc_id, place)
  GROUP BY doc_id
), gone AS (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op12_top_k": r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.v, p.v)::BIGINT AS score
  FROM whole q JOIN whole p ON q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20
""",
    "op13_importance": r"""
WITH RECURSIVE crc_step AS (
  SELECT i, i::UBIGINT AS v, 0 AS r FROM range(256) x(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384::UBIGINT, v >> 1) ELSE v >> 1 END, r + 1
  FROM crc_step WHERE r < 8
), crc_table AS (SELECT list(v ORDER BY i) AS entry FROM crc_step WHERE r = 8),
words AS (
  SELECT 'd' AS kind, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), used AS (SELECT kind, doc_id, word, count(*) AS n FROM words GROUP BY ALL),
hashed AS (
  SELECT word, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
    range(octet_length(encode(word))),
    lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INTEGER, 2))::UBIGINT)),
    lambda a, b: xor(entry[(xor(a, b) & 255)::INTEGER + 1], a >> 8))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM used), crc_table
), features AS (SELECT kind, doc_id, bucket, n FROM used JOIN hashed USING (word)),
counted AS (
  SELECT x.i AS bucket,
    coalesce(sum(n) FILTER (WHERE kind = 'd'), 0)::DOUBLE AS s,
    coalesce(sum(n) FILTER (WHERE kind = 'b'), 0)::DOUBLE AS t
  FROM range(10000) x(i) LEFT JOIN features ON bucket = x.i GROUP BY x.i
), totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counted),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM counted, totals
), weights AS (
  SELECT d.doc_id, coalesce(f.n_features, 0)::BIGINT AS n_features,
    coalesce((f.total - ((f.total % f.n_features) + f.n_features) % f.n_features) // f.n_features, 0)::BIGINT AS weight
  FROM documents d LEFT JOIN (
    SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
    FROM features JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id) f USING (doc_id)
), scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln(
    ((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT)::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM weights
), placed AS (
  SELECT *, n_features >= 20 AS eligible,
    row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN eligible AND place <= n * 10 // 100 THEN place END::BIGINT AS rank
FROM placed
""",
}
