"""DuckDB SQL for the queries that SQL can express, from the operators' own parameters."""

from __future__ import annotations

from . import conversation_trie, embedding_links, license_scan, line_chunks, secret_scan, spelling_variants


def _values(rows: list[tuple]) -> str:
    def literal(v) -> str:
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)


def _license_scan() -> str:
    k = license_scan.K
    grams = []
    for number, (label, notice) in enumerate(license_scan.TEMPLATES):
        words = notice.split()
        places = len(words) - k + 1
        grams += [(" ".join(words[i : i + k]), label, number, i, places) for i in range(places)]
    phrases = [(label, phrase, len(phrase.split())) for label, phrase in license_scan.PHRASES]
    return f"""
    WITH texts AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
    words AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM texts),
    grams AS (SELECT doc_id, i, w || ' ' || lead(w) OVER o AS two, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS three
              FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    pairs AS (SELECT doc_id, i, label FROM grams, (VALUES {_values(phrases)}) p(label, phrase, n)
              WHERE phrase = CASE n WHEN 2 THEN two WHEN 3 THEN three END),
    base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
             FROM pairs GROUP BY 1),
    hits AS (SELECT doc_id, i, label, template, place, places
             FROM grams JOIN (VALUES {_values(grams)}) t(gram, label, template, place, places) ON three = gram),
    diagonals AS (SELECT doc_id, template, i - place AS diagonal, min(i) AS a, max(i) AS b FROM hits GROUP BY ALL),
    apart AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {license_scan.GAP}, false) AS apart
              FROM diagonals),
    spans AS (SELECT *, sum(apart::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM apart),
    merged AS (SELECT h.doc_id, h.label, h.template, s.span, count(DISTINCT h.place) / any_value(h.places) AS cover,
                      (max(h.i) + {k} - min(h.i)) / (any_value(h.places) + {k - 1}) AS stretch
               FROM hits h JOIN spans s ON s.doc_id = h.doc_id AND s.template = h.template AND s.diagonal = h.i - h.place
               GROUP BY ALL),
    found AS (SELECT doc_id, max(cover) AS best,
                     list(DISTINCT label) FILTER (cover >= {license_scan.MIN_COVER} AND stretch <= {license_scan.MAX_STRETCH}) AS labels
              FROM merged GROUP BY 1)
    SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
           array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
    FROM texts t LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)"""


def _secret_scan() -> str:
    def matches(kind: str, number: int, pattern: str, value: str) -> str:
        quoted = pattern.replace("'", "''")
        return f"""
        SELECT doc_id, '{kind}' AS kind, {number} AS kind_no, unnest(regexp_extract_all(text, '{quoted}', 0)) AS m,
               unnest(regexp_extract_all(text, '{quoted}', {value})) AS v,
               unnest(string_split_regex(text, '{quoted}')[:-2]) AS before,
               unnest(range(len(regexp_extract_all(text, '{quoted}', 0)))) AS i
        FROM documents WHERE text IS NOT NULL"""

    window = secret_scan.WINDOW
    allowed = " OR ".join(f"regexp_matches(m, '{p}')" for p in secret_scan.ALLOWED)
    threshold = " ".join(f"WHEN regexp_matches(m, '{c.pattern}') THEN {c.threshold}" for c in secret_scan.CLASSES)
    return f"""
    WITH matched AS ({matches("assign", 0, secret_scan.ASSIGN, "2")} UNION ALL {matches("access", 1, secret_scan.ACCESS, "0")}
      UNION ALL {matches("hex", 2, secret_scan.HEX, "0")} UNION ALL {matches("entropy", 3, secret_scan.CANDIDATE, "0")}),
    placed AS (SELECT *, sum(length(before)) OVER o + sum(length(m)) OVER o - length(m) AS a, sum(length(before)) OVER o + sum(length(m)) OVER o AS b
               FROM matched WINDOW o AS (PARTITION BY doc_id, kind ORDER BY i)),
    windows AS (SELECT m, s, unnest(string_split(substr(m, s, {window}), '')) AS c
                FROM (SELECT m, unnest(range(1, length(m) - {window} + 2)) AS s FROM (SELECT DISTINCT m FROM matched WHERE kind = 'entropy'))),
    counts AS (SELECT m, s, c, count(*) AS n FROM windows GROUP BY ALL),
    entropies AS (SELECT m, s, -sum(n / {window} * log2(n / {window})) AS bits FROM counts GROUP BY ALL),
    random AS (SELECT m FROM entropies GROUP BY m HAVING max(bits) >= CASE {threshold} END AND NOT ({allowed})),
    kept AS (SELECT doc_id, kind, kind_no, a::BIGINT AS a, kind || ':' || a::BIGINT || ':' || b::BIGINT AS span FROM placed
             WHERE CASE kind WHEN 'assign' THEN length(v) >= {secret_scan.MIN_ASSIGNED} WHEN 'entropy' THEN m IN (SELECT m FROM random) ELSE true END),
    listed AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                      count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
                      string_agg(span, ',' ORDER BY a, kind_no) FILTER (kind_no < 3) AS base, string_agg(span, ',' ORDER BY a, kind_no) AS spans
               FROM kept GROUP BY 1)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN listed USING (doc_id)"""


def _line_chunks() -> str:
    c = line_chunks
    return f"""
    WITH split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
    lines AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next, ('0x' || substr(md5(line), 1, 15))::BIGINT % {c.MODULUS} AS h FROM split),
    counted AS (SELECT *, count(*) OVER (PARTITION BY line) AS n, CASE WHEN next IS NOT NULL THEN count(*) OVER (PARTITION BY line, next) END AS n_next FROM lines),
    looked AS (SELECT *, lag(n) OVER o AS last_n, lag(n_next) OVER o AS together, lag(h) OVER o AS last_h FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    cuts AS (SELECT *, (coalesce(together, 1) = 1)::INT AS begins,
                    (coalesce(together, 1) = 1 OR together < greatest(last_n, n) OR (h + last_h * {c.FACTOR}) % {c.DIVISOR} = 0)::INT AS cut FROM looked),
    numbered AS (SELECT *, sum(begins) OVER o AS passage, sum(cut) OVER o AS chunk FROM cuts WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    sized AS (SELECT *, sum(len(regexp_extract_all(line, '{c.WORD}'))) OVER (PARTITION BY doc_id, passage) AS words FROM numbered),
    chunks AS (SELECT doc_id, chunk, any_value(words) >= {c.MIN_WORDS} AS long, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS body FROM sized GROUP BY 1, 2),
    marked AS (SELECT *, long AND row_number() OVER (PARTITION BY body, long ORDER BY doc_id, chunk) > 1 AS gone FROM chunks),
    texts AS (SELECT doc_id, sum(lines)::BIGINT AS n_lines, coalesce(sum(lines) FILTER (gone), 0)::BIGINT AS n_removed,
                     coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '') AS text
              FROM marked GROUP BY 1)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, length(t.text) AS n_chars, md5(t.text) AS md5
    FROM documents LEFT JOIN texts t USING (doc_id)"""


def _embedding_links() -> str:
    """All pairs by brute force; the operator finds a pair with a high chance only, so this is for small tables."""
    return f"""
    WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= {embedding_links.MIN_COSINE}),
    reached AS (SELECT vec_id AS u, vec_id AS v FROM vectors UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
    least AS (SELECT u AS vec_id, min(v) AS component_id FROM reached GROUP BY 1),
    counted AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY 1)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN counted USING (vec_id)"""


# The unsigned crc32 of UTF-8 text, byte by byte over a table worked out from the polynomial.
CRC32 = """
    crc_table AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
                  FROM range(256) r(b)),
    crcs AS (SELECT key, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(hex(encode(key))) // 2), lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::BIGINT)),
                                         lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS crc
             FROM (SELECT DISTINCT key FROM keys), crc_table)"""


def _conversation_trie() -> str:
    c = conversation_trie
    return f"""
    WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
                   FROM conversations WHERE conv_id IS NOT NULL),
    keys AS (SELECT DISTINCT conv_id::VARCHAR AS key FROM turns), {CRC32},
    convs AS (SELECT a.conv_id, a.conv_id - a.conv_id % {c.FAMILY} AS head, crc % {c.MAX_BORROWED + 1} AS h, a.n,
                     least(crc % {c.MAX_BORROWED + 1}, coalesce(b.n, 0)) AS borrowed
              FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1) a JOIN crcs ON key = a.conv_id::VARCHAR
              LEFT JOIN (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1) b ON b.conv_id = a.conv_id - a.conv_id % {c.FAMILY}),
    rebuilt AS (SELECT c.conv_id, i AS d, role, text FROM convs c JOIN turns t ON t.conv_id = c.head AND i <= h
                UNION ALL SELECT c.conv_id, i - h + borrowed, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND i > h),
    paths AS (SELECT conv_id, d, strlen(text) AS bytes, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d) AS prefix FROM rebuilt),
    members AS (SELECT conv_id, d, bytes, sha256(prefix) AS node, coalesce(lag(sha256(prefix)) OVER (PARTITION BY conv_id ORDER BY d), '') AS above FROM paths
                UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
    lengths AS (SELECT conv_id, max(d) AS length FROM members GROUP BY 1),
    nodes AS (SELECT node, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saving,
                     sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = length), '')) AS ends_sha256
              FROM members JOIN lengths USING (conv_id) GROUP BY 1),
    children AS (SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY 1),
    below AS (SELECT m.node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum(u.saving)::BIGINT AS saved_tokens
              FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.d <= u.depth LEFT JOIN children c ON c.node = u.node GROUP BY 1)
    SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens, v.ends_sha256
    FROM nodes v JOIN below USING (node) LEFT JOIN children c USING (node) LEFT JOIN nodes p ON p.node = v.above"""


def _spelling_variants() -> str:
    c = spelling_variants
    return f"""
    WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(text, '{c.UPPER}', '{c.LOWER}'), '{c.RUN}')) AS run
                            FROM documents),
    keys AS (SELECT doc || ':' || run AS key FROM runs), {CRC32},
    spelled AS (SELECT CASE WHEN crc % {c.DIVISOR} = 0 THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word
                FROM runs JOIN crcs ON key = doc || ':' || run),
    words AS (SELECT word, count(*) AS n FROM spelled WHERE length(word) >= {c.MIN_LENGTH} GROUP BY 1 HAVING count(*) >= {c.MIN_COUNT}),
    holes AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    left_out AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM holes),
    near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM left_out a JOIN left_out b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
             UNION SELECT l.word, l.n, w.word, w.n FROM left_out l JOIN words w ON w.word = l.head || l.tail
             UNION SELECT w.word, w.n, l.word, l.n FROM left_out l JOIN words w ON w.word = l.head || l.tail),
    best AS (SELECT word, any_value(n) AS n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY 1),
    forms AS (SELECT word, other AS form, other_n AS form_n FROM best WHERE other_n >= {c.RATIO} * n),
    chains AS (SELECT word, word AS reached, 0 AS steps FROM words UNION ALL SELECT ch.word, f.form, steps + 1 FROM chains ch JOIN forms f ON f.word = ch.reached),
    roots AS (SELECT word, arg_max(reached, steps) AS root FROM chains GROUP BY 1)
    SELECT w.word, form, root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
    FROM words w JOIN roots USING (word) LEFT JOIN forms USING (word) LEFT JOIN best USING (word)"""


ORACLE_SQL = {
    "op2_license_scan": _license_scan(),
    "op4_line_chunks": _line_chunks(),
    "op6_secret_scan": _secret_scan(),
    "op7_embedding_links": _embedding_links(),
    "op11_conversation_trie": _conversation_trie(),
    "op12_spelling_variants": _spelling_variants(),
}
