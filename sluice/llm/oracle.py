"""DuckDB SQL for the numbered queries that SQL can express."""

# Word sets of 4-word shingles; links by an inverted index; smallest reachable id by recursion.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), edges AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), linked AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""

# Ten-word windows of the items, looked up among those of the documents; shorter items by their own length.
DECONTAMINATION = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM item, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM wanted),
placed AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM doc, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
), hits AS (SELECT doc_id, i, size, item_id FROM placed JOIN wanted USING (size, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

# Payloads by digest; the smallest page of equal large ones answers for the others.
WARC = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

# Every window of 20 words with its earliest place; words under later ones go.
SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
  FROM d, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i)
), first AS (SELECT h, min({'d': doc_id, 'i': i}) AS f FROM win GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM win JOIN first USING (h) WHERE f <> {'d': doc_id, 'i': i})
), word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""

# Product codes by plain full scans: one assignment and one update a round, written out.
_CODES_FIRST = r"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x FROM kept, range(8) AS t(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM part WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
)"""
_CODES_ASSIGN = r""", a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS near
  FROM (SELECT vec_id, p, x, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
        FROM part JOIN c{r} USING (p))
  GROUP BY vec_id, p
)"""
# Floored quotients: // goes towards zero.
_CODES_UPDATE = r""", c{n} AS MATERIALIZED (
  SELECT p, e, coalesce(moved.c, old.c) AS c
  FROM c{r} AS old LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
    FROM (SELECT p, near.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
          FROM a{r}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY 1, 2, 3)
    GROUP BY p, e
  ) AS moved USING (p, e)
)"""
_CODES_LAST = r"""
, coded AS (
  SELECT vec_id, string_agg(lpad(printf('%x', near.e::INT), 2, '0'), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error
  FROM a6 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM c6)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""
CODES = _CODES_FIRST + "".join(_CODES_ASSIGN.format(r=r) + _CODES_UPDATE.format(r=r, n=r + 1) for r in range(6)) + _CODES_ASSIGN.format(r=6) + _CODES_LAST

# Texts with a backslash before each control string, which may have some already; no parser.
CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
  SELECT *, '### ' || CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN upper(role[1]) || role[2:]
                           ELSE coalesce(to_json(role)::VARCHAR, 'null') END || ': '
    || regexp_replace(text, '(\\*(?:### (?:System|User|Assistant|Tool|null|"(?:[ !#-\[\]-~]|\\.)*"): |</turn>))', '\\\1', 'g')
    || chr(10) || '</turn>' || chr(10) AS piece
  FROM said
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, piece) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, piece) FILTER (role = 'assistant'), '') AS learned,
         sum(length(piece))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""

# Damage by a bitwise crc32, then costs still to come from the last row back, and edits from the first on.
# States: nothing yet, after system, user, assistant (1 to 4); nxt is where an insert leads.
REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))),
           4294967295::BIGINT) % 20 AS kind
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)))
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, role[1] AS c FROM hurt
), marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS is_cut
  FROM placed
), row_ AS MATERIALIZED (
  SELECT conv_id, turn, i, c, role, text, is_blank OR is_again AS gone, CASE WHEN is_cut THEN 3 ELSE 0 END AS extra,
         is_blank, NOT is_blank AND is_again AS is_dup, NOT is_blank AND NOT is_again AND is_cut AS is_trunc,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS is_illegal
  FROM marked
), total AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_dup) AS duplicate,
         count(*) FILTER (is_trunc) AS truncated, count(*) FILTER (is_illegal) AS illegal
  FROM row_ GROUP BY conv_id
), back AS (
  SELECT conv_id, n + 1 AS i, 0 AS v1, 6 AS v2, 3 AS v3, 0 AS v4 FROM total
  UNION ALL
  SELECT conv_id, i, least(w1, 3 + w3, 6 + w4), least(w2, 3 + w3, 6 + w4), least(w3, 3 + w4), least(w4, 3 + w3)
  FROM (
    SELECT r.conv_id, r.i,
           CASE WHEN gone THEN 4 + v1 ELSE least(4 + v1, 3 + extra + v3, extra + CASE c WHEN 's' THEN v2 WHEN 'u' THEN v3 ELSE 999 END) END AS w1,
           CASE WHEN gone THEN 4 + v2 ELSE least(4 + v2, 3 + extra + v3, extra + CASE c WHEN 'u' THEN v3 ELSE 999 END) END AS w2,
           CASE WHEN gone THEN 4 + v3 ELSE least(4 + v3, 3 + extra + v4, extra + CASE c WHEN 'a' THEN v4 ELSE 999 END) END AS w3,
           CASE WHEN gone THEN 4 + v4 ELSE least(4 + v4, 3 + extra + v3, extra + CASE c WHEN 'u' THEN v3 ELSE 999 END) END AS w4
    FROM back JOIN row_ r ON r.conv_id = back.conv_id AND r.i = back.i - 1
  )
), cost AS MATERIALIZED (SELECT conv_id, i, [v1, v2, v3, v4] AS v FROM back),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 1 AS s, '' AS audit, []::VARCHAR[] AS made FROM total
  UNION ALL
  SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
         CASE e WHEN 'D' THEN s WHEN 'K' THEN kept ELSE nxt END, audit || e,
         CASE e WHEN 'D' THEN made WHEN 'K' THEN list_append(made, role || ':' || text)
                ELSE list_append(made, CASE nxt WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE e WHEN 'R' THEN text ELSE '' END) END
  FROM (
    SELECT step.*,
           CASE WHEN after.v IS NULL THEN 'I' WHEN 4 + after.v[s] = here.v[s] THEN 'D' WHEN 3 + here.v[nxt] = here.v[s] THEN 'I'
                WHEN NOT gone AND kept > 0 AND extra + after.v[greatest(kept, 1)] = here.v[s] THEN 'K' ELSE 'R' END AS e
    FROM (
      SELECT walk.*, r.role, r.text, gone, extra, CASE s WHEN 3 THEN 4 ELSE 3 END AS nxt,
             CASE WHEN s = 1 AND c = 's' THEN 2 WHEN s <> 3 AND c = 'u' THEN 3 WHEN s = 3 AND c = 'a' THEN 4 ELSE 0 END AS kept
      FROM walk LEFT JOIN row_ r ON r.conv_id = walk.conv_id AND r.i = walk.i
    ) AS step
    JOIN cost AS here ON here.conv_id = step.conv_id AND here.i = step.i
    LEFT JOIN cost AS after ON after.conv_id = step.conv_id AND after.i = step.i + 1
    WHERE after.v IS NOT NULL OR here.v[s] > 0
  )
), done AS (SELECT conv_id, arg_max(audit, length(audit)) AS audit, arg_max(made, length(audit)) AS made FROM walk GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v[1], 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN total USING (conv_id) LEFT JOIN cost ON cost.conv_id = ids.conv_id AND cost.i = 1 LEFT JOIN done ON done.conv_id = ids.conv_id
"""

ORACLE: dict[str, str] = {
    "op1_near_duplicates": NEAR_DUPLICATES,
    "op3_decontamination": DECONTAMINATION,
    "op7_warc": WARC,
    "op8_substring_duplicates": SUBSTRINGS,
    "op11_vector_codes": CODES,
    "op12_chat_formatting": CHAT,
    "op13_conversation_repair": REPAIR,
}
