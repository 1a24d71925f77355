"""SQL of the queries, for DuckDB."""

from __future__ import annotations

from scenlens.llm import licenses, line_dedup, mixing, personal_data

SPACE = r"[^\x20\x09-\x0D]+"

OP3 = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, page_id, lower(coalesce(regexp_extract(url, '{line_dedup.HOST}', 2), '')) AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(html, '{line_dedup.HIDDEN}', chr(10), 'g'),
      '{line_dedup.TAG}', chr(10), 'g'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT host, count(*) AS host_pages FROM rows GROUP BY host),
counts AS (
  SELECT host, line, count(DISTINCT r) AS n FROM (SELECT r, host, unnest(lines) AS line FROM rows) GROUP BY host, line),
often AS (
  SELECT host, line FROM counts JOIN totals USING (host)
  WHERE n >= {line_dedup.MIN_PAGES} AND n > host_pages * {line_dedup.RATIO}::DOUBLE),
marked AS (
  SELECT r, p, u.line, o.line IS NOT NULL AS gone
  FROM (SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM rows) u
  LEFT JOIN often o ON o.host = u.host AND o.line = u.line),
texts AS (
  SELECT r, string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone) AS text, count(*) AS n_lines,
    count(*) FILTER (gone) AS n_dropped FROM marked GROUP BY r)
SELECT page_id, host, host_pages, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
  CASE WHEN lines IS NULL THEN NULL ELSE coalesce(text, '') END AS text
FROM rows JOIN totals USING (host) LEFT JOIN texts USING (r)
"""

OP5 = rf"""
WITH facts AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACE}'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '{mixing.SEED}'), 1, 15))::BIGINT AS key
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM facts GROUP BY source),
capped AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS share FROM sizes),
leveled AS (
  SELECT a.source, a.source_size, a.cap, a.weight,
    (a.share - coalesce((SELECT sum(b.cap) FROM capped b WHERE b.cap::DOUBLE / b.weight < a.cap::DOUBLE / a.weight), 0)::DOUBLE)
    / (SELECT sum(b.weight) FROM capped b WHERE b.cap::DOUBLE / b.weight >= a.cap::DOUBLE / a.weight) AS level
  FROM capped a),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM leveled),
placed AS (
  SELECT f.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY f.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM facts f JOIN targets t ON f.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT AS taken
FROM cut
"""

OP4 = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
facts AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM rows),
marked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM facts)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM marked
"""

UPPER, LOWER = licenses.UPPER, licenses.LOWER

OP8 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACE}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b
    ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least_one AS (SELECT a AS doc_id, min(b) AS other FROM reached GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(other, doc_id)) AS kept
FROM sets LEFT JOIN least_one USING (doc_id)
"""


def _template_rows() -> str:
    return ", ".join(f"({i}, '{label}', {w}, {names}::VARCHAR[])" for i, (label, w, names) in enumerate(licenses.TEMPLATES))


def _places(phrase: str) -> str:
    test = " AND ".join(f"coalesce(w[i + {j + 1}] = '{word}', false)" for j, word in enumerate(phrase.split()))
    return f"list_filter(range(0, len(w)), lambda i: {test})"


OP9 = rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{licenses.WORD}') AS w FROM documents),
places AS (SELECT r, doc_id, len(w)::BIGINT AS n_words, {", ".join(f"{_places(p)} AS p{i}" for i, p in enumerate(licenses.PHRASES))} FROM words),
base AS (
  SELECT r, doc_id, n_words, {" || ".join(f"p{i}" for i in range(len(licenses.PHRASES)))} AS p,
    list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(licenses.PHRASES.values()))}],
      lambda x: x IS NOT NULL) AS labels FROM places),
templates(template, label, words, names) AS (VALUES {_template_rows()}),
grams AS (
  SELECT template, place, words[place + 1] AS one, words[place + 2] AS two, CASE WHEN len(words) >= 6 THEN words[place + 3] END AS three
  FROM templates, unnest(range(0, len(words) - CASE WHEN len(words) >= 6 THEN 2 ELSE 1 END)) p(place)),
rolled AS (SELECT r, pos, w[pos + 1] AS one, w[pos + 2] AS two, w[pos + 3] AS three FROM words, unnest(range(0, len(w) - 1)) p(pos)),
diagonals AS (
  SELECT DISTINCT r, template, pos - place AS diagonal
  FROM rolled t JOIN grams g ON t.one = g.one AND t.two = g.two AND (g.three IS NULL OR g.three = t.three)),
merged AS (SELECT a.r, a.template, a.diagonal, b.diagonal AS near FROM diagonals a
  JOIN diagonals b ON a.r = b.r AND a.template = b.template AND b.diagonal BETWEEN a.diagonal AND a.diagonal + 4),
compared AS (
  SELECT r, template, diagonal, place FROM merged JOIN words USING (r) JOIN templates t USING (template), unnest(range(0, len(t.words))) p(place)
  WHERE place + near >= 0 AND w[place + near + 1] = t.words[place + 1]),
scored AS (
  SELECT r, label, CASE WHEN list_has_all(list(words[place + 1]), any_value(names))
    THEN count(DISTINCT place) / len(any_value(words))::DOUBLE ELSE 0 END AS share
  FROM compared JOIN templates USING (template) GROUP BY r, template, label, diagonal),
found AS (SELECT r, list(DISTINCT label) FILTER (share >= 0.75) AS labels, max(share) AS best FROM scored GROUP BY r)
SELECT doc_id, n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word, list_max(p)::BIGINT AS last_word,
  array_to_string(list_sort(b.labels), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(b.labels || coalesce(f.labels, []))), ',') AS labels,
  coalesce(best, 0)::DOUBLE AS score
FROM base b LEFT JOIN found f USING (r)
"""

#: The table of the CRC-32 of bytes, by its rule.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))"""


def crc32(byte_list: str) -> str:
    """The unsigned CRC-32 of a list of bytes, where ``crc_table`` is joined in."""
    return (
        f"xor(list_reduce([4294967295] || {byte_list}, lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"
    )


_KEY = "list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: unicode(x)::BIGINT)"

OP11 = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(_KEY)} % 20 AS kind
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged),
counted AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS seen FROM numbered),
faults AS (
  SELECT *, left(role, 1) AS r, CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  left(lag(role) OVER (PARTITION BY c ORDER BY i), 1) AS before
  FROM counted),
summary AS (
  SELECT c, any_value(conv_id) AS conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c),
inserts(p, k, q, lines) AS (VALUES
  ('', 0, '', []::VARCHAR[]), ('s', 0, 's', []), ('u', 0, 'u', []), ('a', 0, 'a', []),
  ('', 1, 'u', ['user:']), ('s', 1, 'u', ['user:']), ('a', 1, 'u', ['user:']), ('u', 1, 'a', ['assistant:']),
  ('', 2, 'a', ['user:', 'assistant:']), ('s', 2, 'a', ['user:', 'assistant:']), ('a', 2, 'a', ['user:', 'assistant:']),
  ('u', 2, 'u', ['assistant:', 'user:'])),
states AS (
  SELECT c, 0::BIGINT AS i, '' AS p, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM summary
  UNION ALL
  SELECT c, i, p, min(best) FROM (
    SELECT s.c, s.i + 1 AS i,
      CASE e WHEN 'D' THEN q WHEN 'K' THEN r ELSE CASE q WHEN 'u' THEN 'a' ELSE 'u' END END AS p,
      {{'cost': s.best.cost + 5 * k + CASE e WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END
          + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': s.best.audit || repeat('I', k) || e,
        'lines': s.best.lines || n.lines || CASE e WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
          ELSE [CASE q WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text] END}} AS best
    FROM states s JOIN faults f ON f.c = s.c AND f.i = s.i + 1 JOIN inserts n USING (p), (VALUES ('D'), ('K'), ('R')) edits(e)
    WHERE e = 'D' OR (fault IN ('', 'truncated') AND (e = 'R' OR (r = 's' AND q = '') OR (r = 'u' AND q <> 'u') OR (r = 'a' AND q = 'u'))))
  GROUP BY c, i, p),
ends AS (
  SELECT c, min({{'cost': s.best.cost + 5 * k, 'audit': s.best.audit || repeat('I', k), 'lines': s.best.lines || n.lines}}) AS best
  FROM states s JOIN summary USING (c) JOIN inserts n USING (p) WHERE i = summary.n AND (q = 'a' OR q = '') GROUP BY c),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM every e LEFT JOIN summary m ON m.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN ends USING (c)
"""

_BYTES = "flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))"

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run HAVING length(run) >= 6),
hashed AS (
  SELECT run, n, {crc32(_BYTES.format("coalesce(doc_id::VARCHAR, 'null') || ':' || run"))} AS h FROM counted, crc_table),
results AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) r(i)),
pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT p.word, count(*) AS n_near, min({{'minus': -w.n, 'word': near}}) AS least
  FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -least.minus >= 5 * w.n THEN least.word END AS form, CASE WHEN -least.minus >= 5 * w.n THEN -least.minus END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS last, 0 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(last, steps) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "secret": r"\b[0-9a-f]{32,64}\b",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1),
  lambda i: CASE WHEN i % 2 = 1 THEN ({_DIGITS}[-i])::INT ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][({_DIGITS}[-i])::INT + 1] END)) % 10 = 0"""
_MOD97 = """list_reduce([0] || list_transform(string_split(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4), ''),
  lambda x: (CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END)),
  lambda a, d: (a * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) = 1"""
_CHECKS = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(x AS HUGEINT), 999) <= 255))",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"{_MOD97} AND NOT regexp_matches(substr(text, first + length(m) + 1, 1), '[A-Za-z0-9]')",
    "ssn": "left(m, 3) NOT IN ('000', '666') AND left(m, 3) < '900' AND substr(m, 5, 2) <> '00' AND right(m, 4) <> '0000'",
    "secret": "true",
}
_LENGTHS = ", ".join(f"'{k}': {v}" for k, v in personal_data.IBAN_LENGTHS.items())


def _kind(rank: int, kind: str) -> str:
    pattern = _PATTERNS[kind]
    lengths = f"MAP {{{_LENGTHS}}}"
    cut = f"left(m, list_filter(range(1, length(m) + 1), lambda e: length(replace(left(m, e), ' ', '')) = {lengths}[left(m, 2)])[1])"
    words = ", ".join(f"'{w}'" for w in personal_data.WORDS[kind].split())
    against = ", ".join(f"'{w}'" for w in personal_data.AGAINST.split())
    near = personal_data.NEAR
    base = kind in personal_data.BASE_KINDS
    return f"""
  SELECT r, {rank} AS rank, '{kind}' AS kind, first, first + length(m) AS past FROM (
    SELECT r, text, first, m, regexp_extract_all(translate(substr(text, greatest(first - {near}, 0) + 1, least(first, {near}))
      || ' ' || substr(text, first + length(m) + 1, {near}), '{UPPER}', '{LOWER}'), '[a-z]+') AS near
    FROM (SELECT r, text, first, {cut if kind == "iban" else "m"} AS m FROM (
      SELECT r, text, unnest(found) AS m,
        unnest(list_transform(range(1, len(found) + 1), lambda i: coalesce(list_sum(list_transform(parts[1:i], lambda x: length(x))), 0)
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS first
      FROM (SELECT r, text, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS parts FROM docs))))
  WHERE m IS NOT NULL AND {_CHECKS[kind]} AND ({base} OR {personal_data.SCORES[kind]}
    + CASE WHEN list_has_any(near, [{words}]) THEN {personal_data.BOOST} ELSE 0 END
    - CASE WHEN list_has_any(near, [{against}]) THEN {personal_data.PENALTY} ELSE 0 END >= {personal_data.THRESHOLD})"""


OP12 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_kind(i, k) for i, k in enumerate(personal_data.KINDS))}),
listed AS (
  SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in personal_data.BASE_KINDS)},
    string_agg(kind || ':' || first || ':' || past, ',' ORDER BY rank, first) AS spans,
    string_agg(kind || ':' || first || ':' || past, ',' ORDER BY rank, first) FILTER (rank < {len(personal_data.BASE_KINDS)}) AS base
  FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in personal_data.BASE_KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
"""

ORACLES = {
    "op3_site_lines": OP3,
    "op4_warc_revisits": OP4,
    "op5_mix_prefix_cut": OP5,
    "op8_fast_sketches": OP8,
    "op9_license_diagonals": OP9,
    "op11_branch_and_bound": OP11,
    "op12_checked_patterns": OP12,
    "op13_prefix_suffix_tiles": OP13,
}
