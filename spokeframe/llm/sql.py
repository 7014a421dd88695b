"""DuckDB SQL with the meaning of the queries that SQL can express."""

# A line with words goes if it is in a run of lines with ten words or more that stands earlier. Each of
# the lines has a word, so of a longer run every line is in a run of at most ten lines with ten words.
LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(ts))) AS line, unnest(ts) AS t
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ts FROM documents)
), counted AS (
  SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM lines
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS p,
         lead(line) OVER (PARTITION BY doc_id ORDER BY line) AS next_line,
         sum(w) OVER (PARTITION BY doc_id ORDER BY line) AS upto
  FROM counted WHERE w > 0
), runs AS (
  SELECT a.doc_id, a.p, b.p AS q, string_agg(x.t, chr(10) ORDER BY x.p) AS said
  FROM worded a
  JOIN worded b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 9 AND b.upto - a.upto + a.w >= 10
  JOIN worded x ON a.doc_id = x.doc_id AND x.p BETWEEN a.p AND b.p
  GROUP BY a.doc_id, a.p, b.p
), later AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY said ORDER BY doc_id, p) AS nth FROM runs)
  WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, q + 1)) AS p FROM later
), deleted AS (
  SELECT g.doc_id, unnest(CASE WHEN n.p IS NULL THEN [w.line]
                               ELSE range(w.line, w.next_line) END) AS line
  FROM gone g JOIN worded w ON w.doc_id = g.doc_id AND w.p = g.p
  LEFT JOIN gone n ON n.doc_id = g.doc_id AND n.p = g.p + 1
), rest AS (
  SELECT c.doc_id, string_agg(c.t, chr(10) ORDER BY c.line) AS text, sum(c.w) AS words
  FROM counted c ANTI JOIN deleted d ON c.doc_id = d.doc_id AND c.line = d.line
  GROUP BY c.doc_id
)
SELECT d.doc_id, d.lang, d.source,
       CASE WHEN c.doc_id IS NULL THEN d.text ELSE r.text END AS text,
       CASE WHEN c.doc_id IS NULL THEN d.n_chars ELSE length(r.text) END AS n_chars
FROM documents d
LEFT JOIN (SELECT DISTINCT doc_id FROM gone) c ON c.doc_id = d.doc_id
LEFT JOIN rest r ON r.doc_id = d.doc_id
WHERE c.doc_id IS NULL OR r.words > 0
"""

MIXING = r"""
WITH keyed AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat('0|', coalesce(doc_id::VARCHAR, ''), '|', coalesce(text, ''))) AS tie,
         CASE WHEN length(text) > 0 THEN 1 + floor(9 * (length(text) - length(
           regexp_replace(text, '[^!-@\[-`{-~]', '', 'g'))) / length(text))::INT ELSE 1 END AS quality
  FROM documents
), drawn AS (
  SELECT *, -ln((('0x' || substr(tie, 1, 13))::BIGINT::DOUBLE + 1) / (4503599627370496.0::DOUBLE + 1))
            / quality AS key
  FROM keyed
), sizes AS (
  SELECT source, sum(size) AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM drawn GROUP BY source
), filling AS (
  SELECT *, 3 * source_size > 0
            AND (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
                   ORDER BY 3 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
                > 3 * source_size * sum(weight) OVER (
                   ORDER BY 3 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            OR source_size = 0 AND sum(source_size) OVER () > 0 AS filled
  FROM sizes
), targets AS (
  SELECT source, source_size, CASE WHEN filled THEN (3 * source_size)::DOUBLE ELSE
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (filled) OVER (), 0))::DOUBLE
    * weight / sum(weight) FILTER (NOT filled) OVER () END AS target
  FROM filling
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM targets
), ordered AS (
  SELECT d.*, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST, d.tie
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun
  FROM drawn d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (epochs + CASE WHEN begun + size / 2 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS safe_role,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS safe_text
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(length('<|turn|><|text|><|end|>') + length(safe_role) + length(safe_text))::BIGINT
         AS formatted_chars
FROM escaped GROUP BY conv_id
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), numbers AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS one,
         ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS other,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS whether,
         ('0x' || substr(h, 25, 8))::BIGINT % 100 AS which
  FROM drawn
), formed AS (
  SELECT *, least(one, other) AS a, greatest(one, other) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR whether >= 90 THEN 'plain'
              WHEN which < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), cut AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix
  FROM formed
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

PERSONAL_DATA = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS tie FROM documents
), kinds(kind, name, pattern) AS (VALUES
  (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'),
  (1, 'ip', '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
  (2, 'card', '[0-9](?:[\x20-]?[0-9])+'),
  (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')
), matched AS (
  SELECT DISTINCT doc_id, tie, kind, string_split_regex(t, pattern) AS gaps,
         regexp_extract_all(t, pattern) AS said
  FROM docs CROSS JOIN kinds WHERE regexp_matches(t, pattern)
), steps AS (
  SELECT doc_id, tie, kind, unnest(range(len(said))) AS k, unnest(said) AS said,
         unnest(gaps[1:len(said)]) AS before, unnest(gaps[2:]) AS after
  FROM matched
), placed AS (
  SELECT *, sum(length(before) + length(said)) OVER (PARTITION BY doc_id, tie, kind ORDER BY k) AS "end",
         regexp_replace(said, '[^0-9]', '', 'g') AS digits
  FROM steps
), base AS (
  SELECT doc_id, tie, kind, ("end" - length(said))::BIGINT AS start, "end"::BIGINT AS "end",
         before, after, kind || ':' || CASE WHEN kind = 0 THEN lower(said) WHEN kind = 1 THEN said
                                            ELSE digits END AS entity
  FROM placed
  WHERE kind = 0
     OR kind = 1 AND list_bool_and([TRY_CAST(p AS HUGEINT) <= 255 FOR p IN string_split(said, '.')])
     OR kind = 2 AND length(digits) BETWEEN 14 AND 19 AND list_sum([
          CASE WHEN i % 2 = 0 THEN substr(digits, length(digits) - i, 1)::INT
               WHEN substr(digits, length(digits) - i, 1)::INT > 4
               THEN substr(digits, length(digits) - i, 1)::INT * 2 - 9
               ELSE substr(digits, length(digits) - i, 1)::INT * 2 END
          FOR i IN range(length(digits))]) % 10 = 0
     OR kind = 3 AND length(digits) BETWEEN 10 AND 15
), pieces AS (
  SELECT doc_id, tie, entity, CASE WHEN length(before) > 120 THEN substr(before, length(before) - 119)
                                   ELSE before END AS piece,
         start - least(length(before), 120) AS begun, length(before) > 120 AS cut_left, FALSE AS cut_right
  FROM base
  UNION ALL
  SELECT doc_id, tie, entity, substr(after, 1, 120), "end", FALSE, length(after) > 120 FROM base
), words AS (
  SELECT *, unnest(range(len(regexp_extract_all(piece, '[^\x20\x09-\x0D]+')))) AS k,
         unnest(regexp_extract_all(piece, '[^\x20\x09-\x0D]+')) AS word,
         unnest(string_split_regex(piece, '[^\x20\x09-\x0D]+')[1:len(
           regexp_extract_all(piece, '[^\x20\x09-\x0D]+'))]) AS gap
  FROM (SELECT row_number() OVER () AS piece_id, * FROM pieces)
), spelled AS (
  SELECT *, sum(length(gap) + length(word)) OVER (PARTITION BY piece_id ORDER BY k) AS word_end,
         regexp_extract(word,
           '^\p{P}*(\p{L}[\p{L}\p{M}]{2,}(?:[''’-][\p{L}\p{M}]+)*)\p{P}*$', 1) AS core
  FROM words
), terms AS (
  SELECT doc_id, tie, entity, lower(core) AS term,
         (begun + word_end - length(word) + instr(word, core) - 1)::BIGINT AS start,
         length(core) AS chars
  FROM spelled
  WHERE core <> '' AND NOT (cut_left AND word_end = length(word)) AND NOT (cut_right AND word_end = 120)
), corpus AS (
  SELECT term, count(*) AS documents FROM (
    SELECT unnest(list_distinct([regexp_extract(w,
             '^\p{P}*(\p{L}[\p{L}\p{M}]{2,}(?:[''’-][\p{L}\p{M}]+)*)\p{P}*$', 1)
             FOR w IN regexp_extract_all(lower(t), '[^\x20\x09-\x0D]+')])) AS term
    FROM docs) WHERE term <> '' GROUP BY term
), pairs AS (
  SELECT term, entity, count(*) AS together
  FROM (SELECT DISTINCT term, entity, doc_id, tie FROM terms)
  GROUP BY term, entity HAVING count(*) >= 2 AND min(tie) < max(tie)
), entities AS (
  SELECT entity, count(*) AS held FROM (SELECT DISTINCT entity, doc_id, tie FROM base) GROUP BY entity
), revealing AS (
  SELECT term, entity, 1 - ln(documents / together) / ln(n / held) AS strength
  FROM pairs JOIN entities USING (entity) JOIN corpus USING (term), (SELECT count(*) AS n FROM docs)
  WHERE n > held
), judged AS (
  SELECT doc_id, tie, start, min(CASE WHEN strength >= 0.95 THEN 4 ELSE 5 END) AS kind,
         start + chars AS "end"
  FROM terms JOIN revealing USING (term, entity) WHERE strength >= 0.8
  GROUP BY doc_id, tie, start, chars
), spans AS (
  SELECT doc_id, tie, start, kind, "end" FROM base UNION ALL SELECT * FROM judged
), written AS (
  SELECT doc_id, tie, string_agg(['email', 'ip', 'card', 'phone', 'removed', 'generalised'][kind + 1]
                                 || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY doc_id, tie
), based AS (
  SELECT doc_id, tie, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip,
         count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
         string_agg(['email', 'ip', 'card', 'phone'][kind + 1] || ':' || start || ':' || "end", ','
                    ORDER BY start, kind) AS base
  FROM base GROUP BY doc_id, tie
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d
LEFT JOIN based b ON b.doc_id IS NOT DISTINCT FROM d.doc_id AND b.tie = d.tie
LEFT JOIN written w ON w.doc_id IS NOT DISTINCT FROM d.doc_id AND w.tie = d.tie
"""
