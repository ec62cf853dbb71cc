"""DuckDB SQL twins of the operators that SQL can express, over whole tables."""

WORDS = "regexp_extract_all(coalesce({0}, ''), '[^\\x20\\x09-\\x0D]+')"


def jaccard(words: int, percent: int, more: str = "") -> str:
    """Near-duplicate classes by all shared shingles; ``more``: further columns."""
    return """
WITH RECURSIVE w AS (
  SELECT doc_id, """ + WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """ AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < """ + str(words) + """ THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - """ + str(words - 2) + """), lambda i: array_to_string(w[i:i + """ + str(words - 1) + """], ' ')) END) AS s FROM w),
x AS (SELECT doc_id, unnest(s) AS x FROM s),
shared AS (SELECT x FROM x GROUP BY x HAVING count(*) > 1),
y AS (SELECT doc_id, x FROM x SEMI JOIN shared USING (x)),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM y a JOIN y b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
link AS (
  SELECT u, v FROM common JOIN s a ON a.doc_id = u JOIN s b ON b.doc_id = v
  WHERE 100 * n >= """ + str(percent) + """ * (len(a.s) + len(b.s) - n)),
e AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT e.v, r.root FROM reach r JOIN e ON e.u = r.node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id""" + more + """
FROM s JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) r ON r.node = s.doc_id
"""


JACCARD = jaccard(4, 85)
HYPERMINHASH = jaccard(3, 85, ", s.doc_id = r.component_id AS kept")

SUBSTRING = """
WITH w AS (SELECT doc_id, """ + WORDS.format("text") + """ AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
low AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN low USING (h) WHERE doc_id > lo),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_LOWER_WORDS = WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_FIVES = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"
CONTAINED = f"""
WITH d AS (SELECT doc_id, unnest({_FIVES}) AS x FROM (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents)),
q AS (SELECT item_id, {_FIVES} AS s FROM (SELECT item_id, {_LOWER_WORDS} AS w FROM benchmark)),
x AS (SELECT item_id, len(s) AS n, unnest(s) AS x FROM q)
SELECT doc_id, item_id, CAST(any_value(n) AS BIGINT) AS n_item, count(*) AS n_found
FROM d JOIN x USING (x) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)
"""

_BLANK_LINE = "regexp_full_match(x, '[\\x20\\x09-\\x0D]*')"
LINES = f"""
WITH l AS (
  SELECT doc_id, source, p, s[p] AS x
  FROM (SELECT doc_id, source, s, unnest(range(1, len(s) + 1)) AS p
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL))),
bad AS (SELECT x FROM l WHERE NOT {_BLANK_LINE} GROUP BY x HAVING count(DISTINCT source) >= 10),
m AS (SELECT l.*, bad.x IS NOT NULL AS gone FROM l LEFT JOIN bad ON bad.x = l.x),
g AS (
  SELECT doc_id, count(*) FILTER (NOT {_BLANK_LINE}) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(x, chr(10) ORDER BY p) FILTER (NOT gone) AS kept
  FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id)
"""

_START = "^[A-Za-z][A-Za-z0-9+.-]*://"
_TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|msclkid|sid|sessionid|phpsessid|jsessionid)(=|$)"
_ETAG = "'\"' || md5(html) || '\"'"
REVISITS = f"""
WITH rec AS (
  SELECT page_id * 4 AS id, url, 1700000000 + page_id * 37 AS sec, true AS whole,
    CASE WHEN page_id % 11 = 0 THEN 'W/' ELSE '' END || {_ETAG} AS etag,
    'day ' || (page_id % 28 + 1) AS modified, html FROM pages
  UNION ALL
  SELECT page_id * 4 + 1, url, 1700000000 + page_id * 37 + 86400, false,
    CASE WHEN page_id % 15 = 0 THEN '"changed"' ELSE {_ETAG} END, NULL, NULL FROM pages WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 4 + 2, url, 1700000000 + page_id * 37 - 1000, false, {_ETAG}, NULL, NULL
  FROM pages WHERE page_id % 7 = 0
  UNION ALL
  SELECT page_id * 4 + 3, url, 1700000000 + page_id * 37 + 172800, false, NULL,
    CASE WHEN page_id % 20 <> 0 THEN 'day ' || (page_id % 28 + 1) END, NULL FROM pages WHERE page_id % 5 = 0),
u AS (SELECT *, regexp_replace(trim(url), '#(.|\\n)*$', '') AS u FROM rec),
p AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '{_START}(?:[^/?@]*@)?([^/?:]*)', 1)), '^www[.]', '') AS host,
    regexp_replace(regexp_extract(u, '{_START}(?:[^/?@]*@)?[^/?:]*(:[0-9]+)', 1), '^:(80|443)$', '') AS port,
    regexp_replace(regexp_extract(u, '{_START}[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '[?]((.|\\n)*)$', 1), '&'),
      lambda q: q <> '' AND NOT regexp_matches(lower(q), '{_TRACKING}'))), '&') AS query FROM u),
c AS (SELECT *, CASE WHEN regexp_matches(u, '{_START}') THEN
    host || port || path || CASE WHEN query = '' THEN '' ELSE '?' || query END ELSE u END AS canonical FROM p),
l AS (SELECT *, last_value(CASE WHEN whole THEN id END IGNORE NULLS) OVER (
    PARTITION BY canonical ORDER BY sec, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS response_id FROM c),
j AS (
  SELECT l.id, l.canonical, l.response_id, l.etag, l.modified, r.etag AS old_etag, r.modified AS old_modified, r.html,
    CASE WHEN l.response_id IS NULL THEN 'no_response'
      WHEN l.etag IS NOT NULL THEN CASE WHEN regexp_replace(l.etag, '^W/', '') = regexp_replace(r.etag, '^W/', '')
        THEN 'resolved' ELSE 'validator_mismatch' END
      WHEN l.modified IS NOT NULL THEN CASE WHEN l.modified = r.modified THEN 'resolved' ELSE 'validator_mismatch' END
      ELSE 'validator_mismatch' END AS outcome
  FROM l LEFT JOIN rec r ON r.id = l.response_id WHERE NOT l.whole),
h AS (SELECT *, chr(13) || chr(10) AS nl FROM j)
SELECT id AS record_id, canonical AS canonical_url, response_id, outcome,
  CASE WHEN outcome = 'resolved' THEN md5(html) END AS payload_md5,
  CASE WHEN outcome = 'resolved' THEN
    'HTTP/1.1 200 OK' || nl || 'content-type: text/html'
    || CASE WHEN etag IS NULL THEN nl || 'etag: ' || old_etag ELSE '' END
    || CASE WHEN modified IS NULL THEN nl || 'last-modified: ' || old_modified ELSE '' END
    || nl || 'content-length: ' || strlen(html) || nl || 'cache-control: max-age=600'
    || CASE WHEN etag IS NOT NULL THEN nl || 'etag: ' || etag ELSE '' END
    || CASE WHEN modified IS NOT NULL THEN nl || 'last-modified: ' || modified ELSE '' END
  ELSE 'HTTP/1.1 304 Not Modified' || nl || 'Cache-Control: max-age=600' || nl || 'Content-Length: 0' || nl
    || CASE WHEN etag IS NOT NULL THEN 'ETag: ' || etag
       WHEN modified IS NOT NULL THEN 'Last-Modified: ' || modified ELSE 'X-None: 1' END END AS http_headers
FROM h
"""

RANKED = r"""
WITH runs AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
  GROUP BY doc_id, term),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM runs GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM runs GROUP BY term), total),
mass AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM size, total),
wanted AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (term) JOIN runs USING (term) JOIN mass USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

VARIANTS = r"""
WITH RECURSIVE entries AS (
  SELECT list(c ORDER BY i) AS crc_table FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY id, run),
bytes AS (
  SELECT run, times, flatten(list_transform(string_split(id || ':' || run, ''), lambda ch:
    CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)]
         ELSE [CAST(195 AS BIGINT), CAST(unicode(ch) - 64 AS BIGINT)] END)) AS b FROM runs),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, b), lambda c, x:
    xor(c >> 8, crc_table[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, entries),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0
      THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
blanked AS (SELECT word, n, left(word, i - 1) || '*' || substr(word, i + 1) AS p FROM places),
shorter AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS p FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM blanked a JOIN blanked b ON a.p = b.p AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.p
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.p),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n,
         CASE WHEN b.m >= 10 * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.m = b.m) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS here, 0 AS step FROM forms
  UNION ALL
  SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.here WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root
FROM forms f JOIN (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word) r ON r.word = f.word
"""
