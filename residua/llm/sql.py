"""SQL for the queries whose rows SQL can express, by brute force."""

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATE_DOCUMENTS = f"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
        FROM documents),
    sets AS (
        SELECT doc_id, CASE
            WHEN len(words) = 0 THEN []
            WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
            ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
        FROM texts),
    classes AS (SELECT shingles, min(doc_id) AS rep, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
    exploded AS (SELECT rep, n, unnest(shingles) AS shingle FROM classes),
    met AS (
        SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
        FROM exploded a JOIN exploded b ON a.shingle = b.shingle AND a.rep <> b.rep GROUP BY a.rep, b.rep),
    linked AS (SELECT a, b FROM met WHERE 100 * shared >= 85 * (na + nb - shared)),
    reached(a, b) AS (
        SELECT rep, rep FROM classes UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a),
    least AS (SELECT a AS rep, min(b) AS component FROM reached GROUP BY a)
    SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
           s.doc_id = coalesce(l.component, s.doc_id) AS kept
    FROM sets s LEFT JOIN classes c ON s.shingles = c.shingles LEFT JOIN least l USING (rep)
"""

REPEATED_PASSAGES = f"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    windows AS (
        SELECT doc_id, p, md5(array_to_string(words[p:p + 34], ' ')) AS content
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM texts)),
    again AS (SELECT content FROM windows GROUP BY content HAVING count(*) > 1),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS place FROM windows JOIN again USING (content)),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
        FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT t.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM texts t LEFT JOIN kept k USING (doc_id)
"""

NEAR_DUPLICATE_VECTORS = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    linked AS (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
    reached(a, b) AS (
        SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a),
    least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
    counted AS (SELECT a AS vec_id, count(*) AS n FROM linked GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN least USING (vec_id)
"""

# The numbers are the defaults of divergence.Rules.
_CLASSES = {0: "a-z", 1: "A-Z", 2: "0-9", 3: r"\x20\x09-\x0D", 4: ".,;:?'\"()\\-"}
_COUNTS = {k: f"length(regexp_replace(text, '[^{c}]', '', 'g'))".replace("?'", "?''") for k, c in _CLASSES.items()}
_COUNTS[6] = r"length(regexp_replace(text, '[\x00-\x7F]', '', 'g'))"
_COUNTS[5] = "length(text) - " + " - ".join(f"({c})" for c in _COUNTS.values())


def _distance(counts: str, references: str) -> str:
    """Jensen-Shannon distance of each document from its language, over rows of bins."""
    return f"""
        SELECT doc_id, sqrt(greatest(least(sum(
                   CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                   + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 1), 0)) AS distance
        FROM (SELECT d.doc_id, coalesce(c.n, 0) / greatest(sum(coalesce(c.n, 0)) OVER (PARTITION BY d.doc_id), 1) AS p,
                     r.n / greatest(sum(r.n) OVER (PARTITION BY d.doc_id), 1) AS q
              FROM texts d JOIN ({references}) r USING (lang) LEFT JOIN ({counts}) c ON c.doc_id = d.doc_id AND c.bin = r.bin)
        GROUP BY doc_id"""


DIVERGENCE_RULES = f"""
    WITH texts AS (
        SELECT *, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
        FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || lang, '') AS lang,
                     regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents)),
    windows AS (
        SELECT doc_id, p, array_to_string(words[p:p + 4], ' ') AS content
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM texts)),
    covered AS (
        SELECT doc_id, count(DISTINCT place) AS n FROM (
            SELECT doc_id, unnest(range(p, p + 5)) AS place
            FROM windows JOIN (SELECT doc_id, content FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, content))
        GROUP BY doc_id),
    lines AS (
        SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines FROM texts),
    chars AS (SELECT doc_id, unnest([{", ".join(_COUNTS[k] for k in range(7))}]) AS n, unnest(range(7)) AS bin FROM texts),
    shares AS (
        SELECT lang, bin, 4096 * n // length(text) AS share FROM chars JOIN texts USING (doc_id) WHERE text <> ''),
    char_reference AS (
        SELECT lang, bin, list(share ORDER BY share)[(count(*) + 1) // 2] AS n FROM shares GROUP BY ALL),
    placed AS (SELECT doc_id, lang, unnest(words) AS word FROM texts),
    counted AS (SELECT lang, word, count(*) AS n FROM placed GROUP BY ALL),
    common AS (
        SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS bin FROM counted
        WHERE length(word) <= 6 AND NOT regexp_matches(word, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]')
        QUALIFY bin <= 32),
    totals AS (SELECT lang, sum(n) AS n FROM counted GROUP BY lang),
    word_reference AS (
        SELECT lang, bin, n FROM common
        UNION ALL SELECT lang, 33, t.n - coalesce((SELECT sum(c.n) FROM common c WHERE c.lang = t.lang), 0) FROM totals t),
    own_words AS (
        SELECT doc_id, coalesce(bin, 33) AS bin, count(*) AS n FROM placed LEFT JOIN common USING (lang, word) GROUP BY ALL),
    char_distance AS ({_distance("SELECT doc_id, bin, n FROM chars", "SELECT * FROM char_reference")}),
    word_distance AS ({_distance("SELECT doc_id, bin, n FROM own_words", "SELECT * FROM word_reference")}),
    base AS (
        SELECT doc_id, lang, length(text) AS n_chars, len(words)::BIGINT AS n_words,
               length(array_to_string(words, ''))::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
        FROM texts JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (
               coalesce(t.n, 0) >= 200 AND (
                   n_chars >= 200 AND coalesce(c.distance, 0) > 0.165
                   OR n_words >= 100 AND coalesce(w.distance, 0) > 0.31)) AS kept
    FROM base LEFT JOIN totals t USING (lang) LEFT JOIN char_distance c USING (doc_id) LEFT JOIN word_distance w USING (doc_id)
"""

_SPACE = r"\x20\x09-\x0D"

FILL_IN_MIDDLE = f"""
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
               regexp_extract_all(coalesce(text, ''), '[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+') AS tokens FROM documents),
    cut AS (
        SELECT *, len(tokens)::BIGINT AS n,
               ('0x' || substr(digest, 1, 8))::BIGINT % (len(tokens) + 1) AS one,
               ('0x' || substr(digest, 9, 8))::BIGINT % (len(tokens) + 1) AS two,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR ('0x' || substr(digest, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
                    WHEN ('0x' || substr(digest, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (
        SELECT *, array_to_string(tokens[1:least(one, two)], '') AS prefix,
               array_to_string(tokens[least(one, two) + 1:greatest(one, two)], '') AS middle,
               array_to_string(tokens[greatest(one, two) + 1:], '') AS suffix FROM cut)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
"""

# The checksum of zip files, byte by byte; keys are ASCII.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),"
    " lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)

# States: nothing yet, s, u, a. ``best`` is the cost in eight digits and the edits so far.
CONVERSATION_REPAIR = f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS mode
        FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations)),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN mode = 4 THEN 'user' ELSE role END AS role,
               CASE mode WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE mode WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM keyed),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
               substr(role, 1, 1) AS initial FROM damaged),
    faulty AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                       WHEN regexp_extract(text, '([^{_SPACE}])[{_SPACE}]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
                       ELSE 'none' END AS fault,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
    inserts(state, next, letters, cost) AS (
        VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 2), (0, 3, 'II', 4),
               (1, 2, 'I', 2), (1, 3, 'II', 4), (2, 3, 'I', 2), (3, 2, 'I', 2)),
    follows(state, initial, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    edits AS (
        SELECT state, next, 'K' AS letters, 0 AS cost, initial FROM follows
        UNION ALL SELECT state, next, 'R', 2, NULL FROM follows WHERE initial <> 's'
        UNION ALL SELECT state, state, 'D', 3, NULL FROM range(4) s(state)),
    steps AS (
        SELECT conv_id, 0::BIGINT AS i, 0 AS state, '00000000' AS best FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT s.conv_id, s.i + 1, e.next,
               min(lpad((substr(s.best, 1, 8)::BIGINT + n.cost + e.cost
                         + CASE WHEN f.fault = 'truncated' AND e.letters <> 'D' THEN 1 ELSE 0 END)::VARCHAR, 8, '0')
                   || substr(s.best, 9) || n.letters || e.letters)
        FROM steps s JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
             JOIN inserts n ON n.state = s.state
             JOIN edits e ON e.state = n.next AND (e.initial IS NULL OR e.initial = f.initial)
                         AND (e.letters = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
        GROUP BY s.conv_id, s.i, e.next),
    solved AS (
        SELECT conv_id, min(lpad((substr(best, 1, 8)::BIGINT + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END)::VARCHAR, 8, '0')
                            || substr(best, 9) || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END) AS best
        FROM steps s WHERE i = (SELECT coalesce(max(f.i), 0) FROM faulty f WHERE f.conv_id IS NOT DISTINCT FROM s.conv_id)
        GROUP BY conv_id),
    letters AS (
        SELECT conv_id, p, audit[p] AS letter,
               count(*) FILTER (audit[p] <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i
        FROM (SELECT conv_id, substr(best, 9) AS audit, unnest(range(1, length(best) - 7)) AS p FROM solved)),
    replayed AS (
        SELECT l.conv_id, l.p, l.letter, f.role, f.text,
               count(*) FILTER (letter IN ('I', 'R') OR letter = 'K' AND f.initial <> 's')
                   OVER (PARTITION BY l.conv_id ORDER BY l.p) AS n
        FROM letters l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND l.letter <> 'I'),
    lines AS (
        SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN n % 2 = 1 THEN 'user' ELSE 'assistant' END
                                   || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS text
        FROM replayed WHERE letter <> 'D' GROUP BY conv_id),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faulty GROUP BY conv_id)
    SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           substr(best, 1, 8)::BIGINT AS cost, substr(best, 9) AS audit, sha256(coalesce(l.text, '')) AS repaired_sha256
    FROM solved s LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
         LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM s.conv_id
"""

REPEATED_BYTES = """
    WITH texts AS (SELECT doc_id, row_number() OVER () AS row, encode(coalesce(text, '')) AS b FROM documents),
    windows AS (
        SELECT row, p, md5(b[p + 1:p + 400]) AS content
        FROM (SELECT row, b, unnest(range(0, octet_length(b) - 399)) AS p FROM texts)),
    again AS (SELECT content FROM windows GROUP BY content HAVING count(*) > 1),
    starts AS (SELECT row, p, lag(p) OVER (PARTITION BY row ORDER BY p) AS before FROM windows JOIN again USING (content)),
    runs AS (
        SELECT row, p, sum(CASE WHEN before IS NULL OR p > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY p) AS run
        FROM starts),
    spans AS (SELECT row, run, min(p) AS start, max(p) + 400 AS stop FROM runs GROUP BY row, run),
    pieces AS (SELECT *, coalesce(lag(stop) OVER (PARTITION BY row ORDER BY start), 0) AS previous FROM spans),
    cut AS (
        SELECT row, count(*) AS n_spans, sum(stop - start) AS n_removed, max(stop) AS last,
               string_agg(hex(b[previous + 1:start]), '' ORDER BY start) AS head
        FROM pieces JOIN texts USING (row) GROUP BY row)
    SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(coalesce(unhex(head || hex(b[last + 1:])), b)) AS kept_sha256
    FROM texts LEFT JOIN cut USING (row)
"""
