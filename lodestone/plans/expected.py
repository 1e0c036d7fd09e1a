"""The registered jobs once more, as plain SQL over the same tables.

Nothing here is shared with the jobs: each text says in SQL what a job must
give, and a check runs both on the same data.
"""

from __future__ import annotations

from lodestone.plans.catalog import PHRASE, SUBSTRING, VECTOR, WORDS

QUERY_VECTOR = "[" + ",".join(repr(x) for x in VECTOR) + "]::DOUBLE[]"
PATH = "'doc_' || doc_id || '.txt'"
WORD = r"'[\p{L}\p{N}]+'"

OPS = """
log AS (
  SELECT 'user_' || user_id || '.txt' AS path,
         CASE WHEN event_type IN ('signup','view') THEN 'A'
              WHEN event_type IN ('click','purchase') THEN 'M' ELSE 'D' END AS op, ts, event_id
  FROM events),
last_op AS (
  SELECT path, op, event_id FROM log
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY ts DESC, event_id DESC) = 1)
"""


def cuts(source: str) -> str:
    """Pieces ``p(k, b, s, e)`` of the blocks ``blk(k, b, t, lo, hi)``: file, block, text, span.

    Offsets count bytes of the whole text ``t``.
    """
    return f"""
src AS ({source}),
ln AS (
  SELECT k, i, strlen(line) + 1 AS w
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS line,
               generate_subscripts(string_split(t, chr(10)), 1) AS i
        FROM (SELECT DISTINCT k, t FROM src))),
le AS (
  SELECT k, list(e ORDER BY e) AS es
  FROM (SELECT k, sum(w) OVER (PARTITION BY k ORDER BY i)::INT AS e FROM ln) GROUP BY k),
blk AS (
  SELECT k, b, lo, hi, hex(encode(t)) AS hx,
         list_append(list_filter(es, lambda x: x > lo AND x < hi), hi) AS es
  FROM src JOIN le USING (k)),
p(k, b, s, e, hi) AS (
  SELECT k, b, lo, lo, hi FROM blk
  UNION ALL
  SELECT q.k, q.b, q.e,
    CASE WHEN q.s = q.e AND q.hi - q.e <= 4096 THEN q.hi ELSE
      coalesce(
        list_min(list_filter(blk.es, lambda x: x >= q.e + 2048 AND x <= q.e + 4096)),
        list_max(list_filter(blk.es, lambda x: x > q.e AND x <= q.e + 4096)),
        CASE WHEN substr(hx, 2 * (q.e + 4096) + 1, 1) NOT IN ('8','9','A','B') THEN q.e + 4096
             WHEN substr(hx, 2 * (q.e + 4095) + 1, 1) NOT IN ('8','9','A','B') THEN q.e + 4095
             WHEN substr(hx, 2 * (q.e + 4094) + 1, 1) NOT IN ('8','9','A','B') THEN q.e + 4094
             ELSE q.e + 4093 END) END,
    q.hi
  FROM p q JOIN blk ON blk.k = q.k AND blk.b = q.b
  WHERE q.e < q.hi)
"""


PARTS = "parts AS (SELECT k, b, s, e FROM p WHERE e > s)"
MERGED = PARTS + """,
grp AS (
  SELECT *, sum(CASE WHEN rn = 1 OR e - s >= 512 THEN 1 ELSE 0 END)
              OVER (PARTITION BY k ORDER BY s) AS g
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s) AS rn FROM parts)),
seg AS (
  SELECT k, g, min(s)::INT AS s, max(e)::INT AS e, arg_min(b, s) AS b
  FROM grp GROUP BY k, g)
"""

# Overlap: last paragraph break, else last newline, else 256 bytes before the
# former end. Offsets come from the hexadecimal form of the text.
OVERLAPPED = """
prev AS (
  SELECT seg.*, lag(e) OVER (PARTITION BY k ORDER BY s) AS pe FROM seg),
txt AS (SELECT DISTINCT k, t, strlen(t)::INT AS n, hex(encode(t)) AS hx FROM src),
win AS (
  SELECT prev.*, t, n, hx, greatest(0, pe - 2048) AS lo,
         list_filter(range(greatest(0, pe - 2048)::BIGINT, (pe - 2)::BIGINT),
                     lambda x: substr(hx, 2 * x + 1, 2) = '0A') AS nl
  FROM prev JOIN txt USING (k)),
ovl AS (
  SELECT k, g, b, t, n, hx, e,
    CASE WHEN pe IS NULL THEN s ELSE least(s, coalesce(
      list_max(list_filter(nl, lambda x: list_contains(nl, x - 1))) + 1,
      list_max(nl) + 1,
      greatest(0, pe - 256)))::INT END AS s
  FROM win)
"""


def points(at: str) -> str:
    """SQL for row and column of a byte offset in ``hx``; newlines are counted."""
    head = f"substr(hx, 1, 2 * {at})"
    plain = f"regexp_replace({head}, '(..)', '\\1 ', 'g')"
    row = f"(length({plain}) - length(replace({plain}, '0A ', '')))// 3"
    col = f"(length({plain}) - CASE WHEN contains({plain}, '0A ') THEN length({plain}) - strpos(reverse({plain}), ' A0') + 1 ELSE 0 END) // 3"
    return f"({row})::INT", f"({col})::INT"


def chunk_report(suffix: str, language: str, kind: str, source: str = "ovl") -> str:
    start_row, start_col = points("s")
    end_row, end_col = points("e")
    return f"""
SELECT sha256(source || '::' || lang || '::' || path || '::' || s || '::' || e) AS id, path,
       '{language}' AS language, {start_row} AS start_row, {start_col} AS start_col,
       {end_row} AS end_row, {end_col} AS end_col, s AS start_bytes, e AS end_bytes,
       '{kind}' AS chunk_kind,
       CASE WHEN contains(t, chr(10)) THEN chr(10) ELSE '' END AS eol
FROM (SELECT *, 'doc_' || k || '.{suffix}' AS path FROM {source}) o
JOIN (SELECT doc_id AS k, source, lang FROM documents) d USING (k)
"""


def documents_as(text: str) -> str:
    return f"SELECT doc_id AS k, 0 AS b, {text} AS t, 0 AS lo, strlen({text})::INT AS hi FROM documents"


PLAIN = documents_as("text")


def lined(text: str, block: str) -> str:
    """Blocks of whole lines: a new one starts at every line for which ``block`` holds."""
    return f"""
SELECT k, b, t, lo, hi FROM (
  SELECT k, any_value(t) AS t, blk AS b, min(e - w)::INT AS lo,
         max(CASE WHEN last THEN e - 1 ELSE e END)::INT AS hi
  FROM (
    SELECT k, t, e, w, last,
           sum(CASE WHEN {block} THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) AS blk
    FROM (
      SELECT k, t, line, i, strlen(line) + 1 AS w,
             sum(strlen(line) + 1) OVER (PARTITION BY k ORDER BY i) AS e, i = m AS last
      FROM (
        SELECT k, t, unnest(string_split(t, chr(10))) AS line,
               generate_subscripts(string_split(t, chr(10)), 1) AS i,
               len(string_split(t, chr(10))) AS m
        FROM (SELECT doc_id AS k, {text} AS t FROM documents))))
  GROUP BY k, blk) WHERE hi > lo"""


SECTIONED = (
    r"replace(regexp_replace(text, '(^|\n)([^ \n]+)', '\1\2:', 'g'), '. ', '.' || chr(10) || '  - ')"
)
JSON_LINES = """('{"t":"' || replace(text, chr(10), '"}' || chr(10) || '{"t":"') || '"}')"""


# Offsets of the newlines of every document, from the lengths of its lines.
NEWLINES = """
line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
newline AS (
  SELECT doc_id, list(pos ORDER BY pos) AS pos FROM (
    SELECT doc_id, (sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS pos FROM line)
  GROUP BY doc_id),
t AS (
  SELECT doc_id AS k, strlen(text)::INT AS n, list_filter(pos, lambda x: x < strlen(text)) AS nl
  FROM documents JOIN newline USING (doc_id))"""


# Text of every chunk. One that starts inside a character shows a replacement
# for each byte left of it; its description starts at the whole character.
CHUNK_TEXT = """
cut AS (
  SELECT ovl.*, source, lang, 'doc_' || k || '.txt' AS path, encode(t) AS raw,
    CASE WHEN substr(hx, 2 * s + 1, 1) NOT IN ('8','9','A','B') OR s >= n THEN 0
         WHEN substr(hx, 2 * s + 3, 1) NOT IN ('8','9','A','B') THEN 1
         WHEN substr(hx, 2 * s + 5, 1) NOT IN ('8','9','A','B') THEN 2 ELSE 3 END AS broken,
    CASE WHEN substr(hx, 2 * s + 1, 1) NOT IN ('8','9','A','B') OR s >= n THEN s
         WHEN substr(hx, 2 * s - 1, 1) NOT IN ('8','9','A','B') THEN s - 1
         WHEN substr(hx, 2 * s - 3, 1) NOT IN ('8','9','A','B') THEN s - 2 ELSE s - 3 END AS whole
  FROM ovl JOIN (SELECT doc_id AS k, source, lang FROM documents) USING (k)),
ch AS (
  SELECT k, sha256(source || '::' || lang || '::' || path || '::' || s || '::' || e) AS id, source AS repo, lang AS branch,
         path, s, e, repeat(chr(65533), broken::INT) || decode(raw[s + broken + 1:e]) AS chunk,
         decode(raw[whole + 1:e]) AS described
  FROM cut)"""


def ranges(soft: int, hard: int, overlap: int) -> str:
    return f"""
WITH RECURSIVE {NEWLINES},
r(k, s, e, nxt) AS (
  SELECT k, -1, -1, 0 FROM t
  UNION ALL
  SELECT k, cur, cut, CASE WHEN cut >= n THEN n WHEN cut - {overlap} <= cur THEN cut ELSE cut - {overlap} END
  FROM (
    SELECT k, n, cur,
      least(cur + {hard}, coalesce(
        CASE WHEN a IS NULL THEN c + 1 WHEN c IS NULL THEN a + 1
             WHEN goal - a <= c - goal THEN a + 1 ELSE c + 1 END, goal)) AS cut
    FROM (
      SELECT t.k, n, nxt AS cur, least(nxt + {soft}, n) AS goal,
        list_max(list_filter(nl, lambda x: x >= greatest(nxt + 1, least(nxt + {soft}, n) - 2048)
                   AND x < least(nxt + {soft}, n) AND x < n - 1)) AS a,
        list_min(list_filter(nl, lambda x: x >= least(nxt + {soft}, n)
                   AND x < least(n - 1, least(nxt + {soft}, n) + 2048))) AS c
      FROM r JOIN t ON t.k = r.k WHERE r.nxt < t.n)))
SELECT 'doc_' || k || '.txt' AS path, s AS start_bytes, e AS end_bytes FROM r WHERE s >= 0"""


MARKED = "replace(replace(text, ' the ', ' must '), ' and ', ' `and` ` of the`')"
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

INDEX = """
idx AS (
  SELECT lpad(d.doc_id::VARCHAR, 12, '0') AS id, source AS repo, lang AS branch,
         'doc_' || d.doc_id || '.txt' AS path, text AS chunk, embedding
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)"""

TOKENS = f"""
tok AS (
  SELECT id, repo, branch, regexp_extract_all(strip_accents(lower(chunk)), {WORD}) AS w FROM idx)"""


def phrases_of(query: str) -> list[list[str]]:
    return [[w for w in p.lower().split("_") if w] for p in query.split()]


def bm25(query: str) -> str:
    """``kw(id, repo, branch, keyword_score)`` of all rows with any phrase."""
    phrases = phrases_of(query)
    values = ", ".join(f"({i}, [{', '.join(repr(w) for w in p)}])" for i, p in enumerate(phrases))
    return f"""{TOKENS},
ph(i, ws) AS (VALUES {values}),
tf AS (
  SELECT id, repo, branch, i, len(w) + 1 AS dl,
         CASE WHEN len(ws) = 1 THEN len(list_filter(w, lambda x: x = ws[1]))
              ELSE len(list_filter(range(1, len(w) - len(ws) + 2), lambda x: w[x] = ws[1] AND list_slice(w, x, x + len(ws) - 1) = ws)) END AS n
  FROM tok, ph),
st AS (SELECT count(*)::DOUBLE AS total, avg(len(w) + 1) AS mean FROM tok),
df AS (SELECT i, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END)::DOUBLE AS df FROM tf GROUP BY i),
kw AS (
  SELECT id, any_value(repo) AS repo, any_value(branch) AS branch,
    sum(CASE WHEN ln((total - df + 0.5) / (df + 0.5)) > 0 THEN ln((total - df + 0.5) / (df + 0.5)) ELSE 1e-6 END
        * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * dl / mean))) AS keyword_score
  FROM tf JOIN df USING (i) CROSS JOIN st WHERE n > 0 GROUP BY id)"""


COSINE = f"coalesce(list_cosine_similarity(embedding::DOUBLE[], {QUERY_VECTOR}), 0.0)"
NEAR = f"vs AS (SELECT idx.*, {COSINE} AS vector_score FROM idx)"


def fused(limit: int, where: str = "true", kw_limit: int | None = None) -> str:
    """RRF over ``kw`` and ``vs``."""
    take = kw_limit or limit * 5
    return f"""
k AS (SELECT id, keyword_score, row_number() OVER (ORDER BY keyword_score DESC, id) AS kp
      FROM kw WHERE {where} ORDER BY kp LIMIT {take}),
v AS (SELECT id, vector_score, row_number() OVER (ORDER BY vector_score DESC, id) AS vp
      FROM vs WHERE {where} ORDER BY vp LIMIT {take}),
m AS (
  SELECT id, coalesce(keyword_score, 0.0) AS keyword_score, coalesce(vector_score, 0.0) AS vector_score,
         CASE WHEN kp IS NULL THEN 1000000 + vp ELSE kp END AS pos
  FROM k FULL OUTER JOIN v USING (id)),
f AS (
  SELECT *, (row_number() OVER (ORDER BY keyword_score DESC, pos) - 1)::INT AS keyword_rank,
            (row_number() OVER (ORDER BY vector_score DESC, pos) - 1)::INT AS vector_rank FROM m),
fused AS (
  SELECT *, 1.0::DOUBLE / (60 + keyword_rank) + 1.0::DOUBLE / (60 + vector_rank) AS score FROM f
  ORDER BY score DESC, pos LIMIT {limit})"""


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


LEXEMES = f"lex AS (SELECT id, regexp_extract_all(lower(chunk), {WORD}) AS w FROM idx)"
# A phrase with a word, or two words, and an exclusion: ``WEB_QUERY`` of the jobs.
COVER = """
hit AS (
  SELECT * FROM lex WHERE
    (len(list_filter(range(1, len(w)), lambda x: w[x] = 'of' AND w[x + 1] = 'the')) > 0
     AND list_contains(w, 'lyin') AND NOT list_contains(w, 'blely'))
    OR (list_contains(w, 'shor') AND list_contains(w, 'onanshat'))),
occ AS (
  SELECT id, term, pos, lag(term) OVER (PARTITION BY id ORDER BY pos) AS pt FROM (
    SELECT id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM hit)),
ends AS (
  SELECT id, pos AS hi, max(CASE WHEN term = 'the' AND pt = 'of' THEN pos - 1 END) OVER o AS p1,
         max(CASE WHEN term = 'lyin' THEN pos END) OVER o AS p2,
         max(CASE WHEN term = 'shor' THEN pos END) OVER o AS p3,
         max(CASE WHEN term = 'onanshat' THEN pos END) OVER o AS p4
  FROM occ WHERE (term = 'the' AND pt = 'of') OR term IN ('lyin', 'shor', 'onanshat')
  WINDOW o AS (PARTITION BY id ORDER BY pos)),
begun AS (
  SELECT id, hi, greatest(coalesce(CASE WHEN p1 < p2 THEN p1 ELSE p2 + 0 * p1 END, 0),
                          coalesce(CASE WHEN p3 < p4 THEN p3 ELSE p4 + 0 * p3 END, 0)) AS lo FROM ends),
covers AS (
  SELECT * FROM (SELECT *, max(lo) OVER (PARTITION BY id ORDER BY hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM begun)
  WHERE lo > coalesce(prior, 0)),
marks AS (
  SELECT DISTINCT id, unnest(CASE WHEN term = 'the' THEN [pos - 1, pos] ELSE [pos] END) AS at
  FROM occ WHERE (term = 'the' AND pt = 'of') OR term IN ('lyin', 'shor', 'onanshat')),
counted AS (
  SELECT c.id, c.hi, c.lo, count(*) AS n FROM covers c JOIN marks m ON m.id = c.id AND m.at BETWEEN c.lo AND c.hi GROUP BY ALL),
cov AS (SELECT id, sum(0.1::DOUBLE / (1 + (hi - lo) - (n - 1))) AS rank FROM counted GROUP BY id)"""

ESCAPED = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


LF = "' || chr(10) || '"
TOML = f"regexp_replace(text, '(^|\\n)([^ \\n]+)', '\\1[\\2]{LF}key =', 'g')"
HEADED = f"regexp_replace(text, '(^|\\n)([^ \\n]+) ?', '\\1{LF}## \\2{LF}{LF}', 'g')"


def markdown() -> str:
    """Headings and the prose below them, packed in order up to 2048 bytes."""
    src = f"""
SELECT k, b, t, lo, CASE WHEN head OR piped THEN least(hi, lo + strlen(first) + 1) ELSE hi END::INT AS hi, head, piped, title FROM (
  SELECT *, first LIKE '## %' AS head, regexp_matches(first, '^\\s*\\|.*\\|\\s*$') AS piped,
         last_value(CASE WHEN first LIKE '## %' THEN trim(rtrim(trim(substr(first, 4)), '#')) END IGNORE NULLS)
           OVER (PARTITION BY k ORDER BY lo) AS title
  FROM (
    SELECT k, blk AS b, any_value(t) AS t, arg_min(line, i) AS first, min(e - w)::INT AS lo,
           max(CASE WHEN last THEN e - 1 ELSE e END)::INT AS hi
    FROM (
      SELECT *, sum(CASE WHEN line LIKE '## %' OR (line <> '' AND before = '') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY k ORDER BY i) AS blk
      FROM (
        SELECT *, strlen(line) + 1 AS w, i = m AS last, lag(line, 1, 'x') OVER (PARTITION BY k ORDER BY i) AS before,
               sum(strlen(line) + 1) OVER (PARTITION BY k ORDER BY i) AS e
        FROM (
          SELECT k, t, unnest(string_split(t, chr(10))) AS line,
                 generate_subscripts(string_split(t, chr(10)), 1) AS i, len(string_split(t, chr(10))) AS m
          FROM (SELECT doc_id AS k, {HEADED} AS t FROM documents))))
    GROUP BY k, blk) WHERE b > 0) WHERE hi > lo"""
    packed = """
pr AS (SELECT k, b, s, e, row_number() OVER (PARTITION BY k ORDER BY s) AS i FROM p WHERE e > s),
pk(k, i, head, no) AS (
  SELECT k, i, s, 1 FROM pr WHERE i = 1
  UNION ALL
  SELECT pr.k, pr.i, CASE WHEN pr.e - pk.head > 2048 THEN pr.s ELSE pk.head END,
         CASE WHEN pr.e - pk.head > 2048 THEN no + 1 ELSE no END
  FROM pk JOIN pr ON pr.k = pk.k AND pr.i = pk.i + 1),
parts AS (SELECT k, arg_min(b, s) AS b, min(s) AS s, max(e) AS e FROM pk JOIN pr USING (k, i) GROUP BY k, no)"""
    slug = r"trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\s-]', '', 'g'), '[\s-]+', '-', 'g'), '-')"
    return f"""
WITH RECURSIVE {cuts(src)}, {MERGED.replace(PARTS, packed)}, {OVERLAPPED},
placed AS (
  SELECT ovl.* REPLACE (CASE WHEN head THEN lo ELSE s END AS s), title, lag(e, 1, 0) OVER (PARTITION BY k ORDER BY e) AS pe
  FROM ovl JOIN (SELECT k, b, lo, head, title FROM src) USING (k, b)),
tabled AS (SELECT DISTINCT placed.k, placed.e FROM placed JOIN src ON src.k = placed.k AND piped AND src.lo >= pe AND src.lo < placed.e)
SELECT o.* REPLACE (CASE WHEN tabled.e IS NULL THEN 'doc' ELSE 'table' END AS chunk_kind), title AS crumb, {slug} AS anchors
FROM ({chunk_report('md', 'markdown', 'doc', 'placed')}) o
JOIN (SELECT k AS o_k, 'doc_' || k || '.md' AS path, s AS start_bytes, e AS end_bytes, title FROM placed) USING (path, start_bytes, end_bytes)
LEFT JOIN tabled ON tabled.k = o_k AND tabled.e = end_bytes"""


def range_chunks(rows: str, language: str) -> str:
    """Chunks of files cut near line ends; ``rows`` gives ``doc_id, text, repo, branch, path``."""
    start_row, start_col = points("s")
    end_row, end_col = points("e")
    cut = ranges(1024, 2048, 102).replace("WITH RECURSIVE", f"WITH RECURSIVE documents AS ({rows}),")
    cut = cut[:cut.rindex("SELECT 'doc_'")]
    return cut + f"""
SELECT sha256(repo || '::' || branch || '::' || path || '::' || s || '::' || e) AS id, path,
       '{language}' AS language, {start_row} AS start_row, {start_col} AS start_col, {end_row} AS end_row,
       {end_col} AS end_col, s AS start_bytes, e AS end_bytes, 'text' AS chunk_kind, NULL::VARCHAR AS eol
FROM (SELECT r.s, r.e, d.repo, d.branch, d.path, hex(encode(d.text)) AS hx
      FROM r JOIN documents d ON d.doc_id = r.k WHERE s >= 0)"""


CLASS = (
    f"'package corpus;{LF}class Doc {{{LF}  int n = 0;{LF}  void run() {{{LF}    say(\"' || "
    f"replace(replace(text, chr(34), chr(39)), chr(10), '\");{LF}  }}{LF}  void run() {{{LF}    say(\"') || "
    f"'\");{LF}  }}{LF}}}{LF}'"
)


def sql_texts() -> dict[str, str]:
    slug = (
        r"trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '^\s+|\s+$', '', 'g')),"
        r" '[^a-z0-9\s-]', '', 'g'), '[\s-]+', '-', 'g'), '-')"
    )
    preview = r"trim(regexp_replace(substr(text, 1, 120), '\s+', ' ', 'g'))"
    sentences = (
        r"list_filter(list_transform(string_split(regexp_replace(" + MARKED
        + r", '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')),"
        r" lambda s: regexp_matches(s, '(?i)(^|[^\p{L}\p{N}_])(shall|must|should|required|use case|scenario)($|[^\p{L}\p{N}_])'))"
    )
    half = "(strlen(text) // 2)"
    start_row, start_col = points(half)
    described = r"trim(regexp_replace(substr(described, 1, 120), '\s+', ' ', 'g'))"
    chunks = f"{cuts(PLAIN)}, {MERGED}, {OVERLAPPED}, {CHUNK_TEXT}"
    texts = {
        "plaintext_chunk_text": f"""
WITH RECURSIVE {chunks}
SELECT path, s AS start_bytes, e AS end_bytes, md5(chunk) AS chunk_md5,
  concat_ws('|', repo, path, s || '-' || e,
    nullif(CASE WHEN length({described}) > 80 THEN substr({described}, 1, 77) || '...' ELSE {described} END, ''), 'doc-chunker-v1') AS signature
FROM ch""",
        "passage_search": f"""
WITH RECURSIVE {chunks},
idx AS (SELECT ch.id, repo, branch, path, chunk, embedding FROM ch LEFT JOIN embeddings ON vec_id = k),
{bm25(WORDS)}, {NEAR}, {fused(20)}
SELECT id, path, s AS start_bytes, e AS end_bytes, {r6('score')} FROM fused JOIN ch USING (id)""",
        "toml_chunks": f"""
WITH RECURSIVE {cuts(lined(TOML, "line <> '' AND line[1] <> ' '"))}, {MERGED}, {OVERLAPPED}
SELECT o.*, CASE WHEN line[1] = '[' AND contains(line, ']') THEN trim(trim(line, '[]'))
                 WHEN contains(line, ':') THEN trim(string_split(line, ':')[1]) ELSE trim(string_split(line, '=')[1]) END AS crumb
FROM ({chunk_report('toml', 'toml', 'toml')}) o
JOIN (SELECT 'doc_' || k || '.toml' AS path, s AS start_bytes, e AS end_bytes, trim(string_split(decode(encode(t)[lo + 1:hi]), chr(10))[1]) AS line
      FROM ovl JOIN (SELECT k, b, lo, hi FROM src) USING (k, b)) USING (path, start_bytes, end_bytes)""",
        "markdown_headings": f"""
WITH src AS ({lined(HEADED, 'true')})
SELECT 'doc_' || k || '.md' AS path, lo AS start_bytes, hi AS end_bytes, trim(rtrim(trim(substr(line, 4)), '#')) AS crumb
FROM (SELECT *, trim(decode(encode(t)[lo + 1:hi]), chr(10)) AS line FROM src) WHERE line LIKE '## %'""",
        "code_chunks": "SELECT *, '' AS signature FROM (" + range_chunks(
            f"SELECT doc_id, {CLASS} AS text, source AS repo, lang AS branch, 'doc_' || doc_id || '.java' AS path FROM main.documents", "java") + ")",
        "html_chunks": range_chunks(
            "SELECT page_id AS doc_id, html AS text, 'web' AS repo, '' AS branch, 'page_' || page_id || '.html' AS path FROM pages", "html"),
        "markdown_chunks": markdown(),
        "files_projection": f"SELECT source AS repo, lang AS branch, {PATH} AS path, strlen(text)::INT AS n_bytes FROM documents",
        "changes_latest": f"WITH {OPS} SELECT path, op, event_id FROM last_op",
        "changes_split_counts": f"""
WITH {OPS}
SELECT CASE WHEN op = 'D' THEN 'delete' ELSE 'process' END AS side, count(*) AS n FROM last_op
WHERE NOT (path LIKE 'user\\_1%' ESCAPE '\\' AND path NOT LIKE 'user\\_12%' ESCAPE '\\') GROUP BY 1""",
        "ignore_filter": """
SELECT path FROM (SELECT source || '/' || lang || '/doc_' || doc_id || '.txt' AS path, * FROM documents)
WHERE NOT ((source LIKE 'src1%' AND doc_id % 10 = 7 AND (source <> 'src3' OR lang <> 'en'))
        OR (source = 'src3' AND lang <> 'en') OR lang = 'fr'
        OR regexp_matches(doc_id::VARCHAR, '^1[0-4].$'))""",
        "binary_filter": """
SELECT doc_id, 10 * (strlen(m) - strlen(replace(m, chr(1), ''))) > strlen(m) AS binary
FROM (SELECT doc_id, replace(text, ' the ', repeat(chr(1), 12)) AS m FROM documents)""",
        "readable_prefix": f"SELECT doc_id, substr(hex(encode(text)), 2 * {half} + 1, 1) NOT IN ('8','9','A','B') AS readable FROM documents",
        "resume_antijoin": f"SELECT {PATH} AS path FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "dispatch_family": """
SELECT family, language, count(*) AS n FROM (
  SELECT CASE doc_id % 13 WHEN 0 THEN 'code' WHEN 1 THEN 'markdown' WHEN 2 THEN 'json' WHEN 3 THEN 'jsonl' WHEN 4 THEN 'yaml'
    WHEN 5 THEN 'toml' WHEN 6 THEN 'csv' WHEN 7 THEN 'tsv' WHEN 8 THEN 'markup' WHEN 9 THEN 'markup' WHEN 10 THEN 'code' ELSE 'text' END AS family,
  CASE doc_id % 13 WHEN 0 THEN 'python' WHEN 1 THEN 'markdown' WHEN 2 THEN 'json' WHEN 3 THEN 'jsonl' WHEN 4 THEN 'yaml'
    WHEN 5 THEN 'toml' WHEN 6 THEN 'csv' WHEN 7 THEN 'tsv' WHEN 8 THEN 'yaml' WHEN 9 THEN 'html' WHEN 10 THEN 'cpp' ELSE 'text' END AS language
  FROM documents) GROUP BY ALL""",
        "plaintext_parts": f"WITH RECURSIVE {cuts(PLAIN)} SELECT 'doc_' || k || '.txt' AS path, s::INT AS start_bytes, e::INT AS end_bytes FROM p WHERE e > s",
        "plaintext_segments": f"WITH RECURSIVE {cuts(PLAIN)}, {MERGED} SELECT 'doc_' || k || '.txt' AS path, s AS start_bytes, e AS end_bytes FROM seg",
        "plaintext_chunks": f"WITH RECURSIVE {cuts(PLAIN)}, {MERGED}, {OVERLAPPED} {chunk_report('txt', 'text', 'text')}",
        "csv_chunks": f"""
WITH RECURSIVE {cuts(documents_as("replace(text, ' ', ',')"))}, {MERGED}, {OVERLAPPED}
SELECT *, ',' AS table_delimiter, 256 AS overlap_bytes FROM ({chunk_report('csv', 'csv', 'table')})""",
        "jsonl_chunks": f"""
WITH RECURSIVE {cuts(lined(JSON_LINES, 'true'))}, {MERGED}, {OVERLAPPED}
SELECT 'doc_' || k || '.jsonl' AS path, 'jsonl' AS language, s AS start_bytes, e AS end_bytes,
       'json' AS chunk_kind, 'line ' || b AS crumb FROM ovl""",
        "json_members": """
WITH t AS (
  SELECT p_partkey, strlen('{"name": "' || p_name || '",')::INT AS a,
         strlen('{"name": "' || p_name || '",' || chr(10) || ' "size": ' || p_size || ',')::INT AS b,
         strlen('{"name": "' || p_name || '",' || chr(10) || ' "size": ' || p_size || ',' || chr(10) || ' "tags": ["' || p_brand || '", "' || p_type || '"]}' || chr(10))::INT AS c
  FROM part)
SELECT p_partkey, 0 AS start_bytes, a AS end_bytes, 'name' AS crumb FROM t
UNION ALL SELECT p_partkey, a + 1, b, 'size' FROM t
UNION ALL SELECT p_partkey, b + 1, c, 'tags' FROM t""",
        "yaml_blocks": f"""
WITH src AS ({lined(SECTIONED, "line <> '' AND line[1] <> ' '")})
SELECT 'doc_' || k || '.yaml' AS path, lo AS start_bytes, hi AS end_bytes,
       trim(string_split(decode(encode(t)[lo + 1:hi]), ':')[1]) AS heading FROM src""",
        "yaml_chunks": f"""
WITH RECURSIVE {cuts(lined(SECTIONED, "line <> '' AND line[1] <> ' '"))}, {MERGED}, {OVERLAPPED}
SELECT 'doc_' || k || '.yaml' AS path, 'yaml' AS language, 'yaml' AS chunk_kind,
       s AS start_bytes, e AS end_bytes, {points("s")[0]} AS start_row, {points("e")[0]} AS end_row,
       trim(string_split(decode(encode(t)[lo + 1:hi]), ':')[1]) AS crumb
FROM ovl JOIN (SELECT k, b, lo, hi FROM src) USING (k, b)""",
        "size_ranges_code": ranges(1024, 2048, 102),
        "size_ranges_bytes": ranges(2048, 4096, 256),
        "nearest_newlines": f"""
WITH {NEWLINES}
SELECT path, h AS target, CASE WHEN a IS NULL THEN c + 1 WHEN c IS NULL THEN a + 1 WHEN h - a <= c - h THEN a + 1 ELSE c + 1 END AS after
FROM (
  SELECT 'doc_' || k || '.txt' AS path, h, list_max(list_filter(nl, lambda x: x >= greatest(1, h - 2048) AND x < h AND x < n - 1)) AS a,
         list_min(list_filter(nl, lambda x: x >= h AND x < least(n - 1, h + 2048))) AS c
  FROM (SELECT *, unnest(range(1024, n, 1024))::INT AS h FROM t))""",
        "middle_points": f"""
SELECT {PATH} AS path, {start_row} AS row, {start_col} AS col, {start_row} AS newlines
FROM (SELECT doc_id, text, hex(encode(text)) AS hx FROM documents)""",
        "requirement_sentences": f"""
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS pos, sentence FROM (
  SELECT doc_id, sentence, min(i) AS i FROM (
    SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS i FROM (SELECT doc_id, {sentences} AS s FROM documents))
  GROUP BY doc_id, sentence)""",
        "code_refs": f"""
SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(list_concat(
  list_filter(list_transform(regexp_extract_all({MARKED}, '`([^`]+)`', 1), lambda s: trim(s, ' ' || chr(10))), lambda s: s <> ''),
  CASE WHEN doc_id % 2 = 0 THEN ['fence:' || lang] ELSE [] END))), '|'), '') AS refs FROM documents""",
        "slugify_titles": f"SELECT page_id, {slug} AS slug FROM pages",
        "document_signatures": f"""
SELECT doc_id, concat_ws('|', CASE WHEN doc_id % 2 = 0 THEN source END, 'doc_' || doc_id, '0-' || strlen(text),
  CASE WHEN doc_id % 3 = 0 THEN lang || '/' || source END,
  nullif(CASE WHEN length({preview}) > 80 THEN substr({preview}, 1, 77) || '...' ELSE {preview} END, ''), 'doc-chunker-v1') AS signature
FROM documents""",
        "line_endings": "SELECT doc_id, CASE WHEN NOT contains(text, chr(10)) THEN '' WHEN doc_id % 2 = 0 THEN chr(13) || chr(10) ELSE chr(10) END AS eol FROM documents",
        "chunk_kinds": f"SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'fence' WHEN len({sentences}) > 0 THEN 'req' ELSE 'doc' END AS kind FROM documents",
        "chunk_ids": "SELECT doc_id, sha256(source || '::' || CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END || '::doc_' || doc_id || '::0::' || strlen(text)) AS id FROM documents",
        "section_headings": r"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (
    SELECT doc_id, string_split(chr(10) || CASE WHEN doc_id % 2 = 0 THEN ' [ a.b ]' ELSE '' END || chr(10)
                                || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' - ' END || text, chr(10)) AS ls FROM documents)),
flush AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS t,
         trim(line, ' ' || chr(9) || chr(13)) <> '' AND line[1] <> ' ' AND left(trim(line, ' ' || chr(9) || chr(13)), 1) <> '#' AS starts
  FROM lines),
named AS (
  SELECT doc_id, i, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS block,
         CASE WHEN t = '' OR t[1] = '#' THEN NULL
              WHEN t[1] = '[' AND contains(t, ']') THEN trim(trim(t, '[]'), ' ' || chr(9))
              WHEN contains(t, ':') THEN trim(string_split(t, ':')[1], ' ' || chr(9))
              WHEN contains(t, '=') THEN trim(string_split(t, '=')[1], ' ' || chr(9))
              WHEN t[1] = '-' THEN CASE WHEN trim(t[2:]) = '' THEN '-' ELSE trim(t[2:], ' ' || chr(9)) END END AS name
  FROM flush),
found AS (SELECT doc_id, block, arg_min(name, i) FILTER (WHERE name IS NOT NULL) AS name FROM named GROUP BY ALL)
SELECT doc_id, block::INT AS block, coalesce(name, '') AS heading FROM found""",
        "vector_topk": f"SELECT lpad(vec_id::VARCHAR, 12, '0') AS id, round({COSINE}, 6) AS vector_score FROM embeddings ORDER BY {COSINE} DESC, id LIMIT 50",
        "vector_topk_many": """
SELECT lpad(q.vec_id::VARCHAR, 12, '0') AS query_id, lpad(r.vec_id::VARCHAR, 12, '0') AS id,
       round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS vector_score
FROM embeddings q, embeddings r WHERE q.vec_id % 50 = 0
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) DESC, r.vec_id) <= 10""",
        "vector_filtered": f"SELECT lpad(vec_id::VARCHAR, 12, '0') AS id, 'label_3' AS repo, round({COSINE}, 6) AS vector_score FROM embeddings WHERE label = 3 ORDER BY {COSINE} DESC, id LIMIT 20",
        "vector_mismatch_zero": f"SELECT lpad(vec_id::VARCHAR, 12, '0') AS id, CASE WHEN vec_id % 5 <= 2 THEN 0.0::DOUBLE ELSE round({COSINE}, 6) END AS vector_score FROM embeddings",
        "cosine_expression": "SELECT lpad(vec_id::VARCHAR, 12, '0') AS id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS score FROM embeddings",
        "vector_bytes": "SELECT lpad(vec_id::VARCHAR, 12, '0') AS id, 4 * len(embedding)::INT AS n_bytes, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings",
        "fts_terms": f"""
WITH {INDEX}, {TOKENS}
SELECT term, count(*) AS df, sum(n)::BIGINT AS cf FROM (SELECT id, term, count(*) AS n FROM (SELECT id, unnest(w) AS term FROM tok) GROUP BY ALL) GROUP BY term""",
        "bm25_topk": f"WITH {INDEX}, {bm25(WORDS)} SELECT id, {r6('keyword_score')} FROM kw ORDER BY kw.keyword_score DESC, id LIMIT 50",
        "bm25_filtered": f"WITH {INDEX}, {bm25(WORDS)} SELECT id, repo, branch, {r6('keyword_score')} FROM kw WHERE repo = 'src8' AND branch = 'en'",
        "bm25_postings": f"WITH {INDEX}, {bm25(WORDS)} SELECT id, {r6('keyword_score')} FROM kw",
        "phrase_match": f"WITH {INDEX}, {bm25(PHRASE)} SELECT id, {r6('keyword_score')} FROM kw",
        "phrase_postings": f"WITH {INDEX}, {bm25(PHRASE)} SELECT id, {r6('keyword_score')} FROM kw",
        "like_match": f"WITH {INDEX} SELECT id, 1.0::DOUBLE AS keyword_score FROM idx WHERE lower(chunk) LIKE '%e_hat%the%'",
        "keyword_fallback": f"WITH {INDEX} SELECT id, 1.0::DOUBLE AS keyword_score FROM idx WHERE contains(lower(chunk), '{SUBSTRING}') ORDER BY id LIMIT 50",
        "text_match_web": f"""
WITH {INDEX}, {LEXEMES}
SELECT id FROM lex WHERE
  (len(list_filter(range(1, len(w)), lambda x: w[x] = 'of' AND w[x + 1] = 'the')) > 0 AND list_contains(w, 'lyin'))
  OR (list_contains(w, 'shor') AND NOT list_contains(w, 'onanshat'))""",
        "cover_density": f"WITH {INDEX}, {LEXEMES}, {COVER} SELECT id, {r6('rank')} FROM cov",
        "hybrid_rrf": f"WITH {INDEX}, {bm25(WORDS)}, {NEAR}, {fused(40)} SELECT id, keyword_rank, vector_rank, {r6('keyword_score', 'vector_score', 'score')} FROM fused",
        "hybrid_rrf_filtered": f"""
WITH {INDEX}, {bm25(WORDS)}, {NEAR}, {fused(4, "branch = 'en'")}
SELECT id, 'en' AS branch, keyword_rank, vector_rank, {r6('keyword_score', 'vector_score', 'score')} FROM fused""",
        "rrf_word_candidates": f"""
WITH {INDEX}, {bm25("onanshat lyin")}, vs AS (SELECT * FROM (SELECT idx.*, {COSINE} AS vector_score FROM idx) WHERE vector_score <> 0), {fused(200, kw_limit=100)}
SELECT id, repo, keyword_rank, vector_rank, {r6('score')} FROM fused JOIN idx USING (id)""",
        "hybrid_weighted": f"""
WITH {INDEX}, {LEXEMES}, {COVER}, {NEAR},
s AS (SELECT vs.id, vector_score, coalesce(rank, 0.0) AS keyword_score, rank IS NOT NULL AS hit FROM vs LEFT JOIN cov USING (id)),
c AS ((SELECT id FROM s ORDER BY vector_score DESC, id LIMIT 100) UNION (SELECT id FROM s WHERE hit ORDER BY keyword_score DESC, id LIMIT 100)),
w AS (SELECT s.*, vector_score * 0.7 + keyword_score * 0.3 AS score FROM s JOIN c USING (id) ORDER BY score DESC, id LIMIT 20)
SELECT id, {r6('keyword_score', 'vector_score', 'score')} FROM w""",
        "hybrid_empty_query": f"WITH {INDEX}, {NEAR}, w AS (SELECT * FROM vs ORDER BY vector_score DESC, id LIMIT 20) SELECT id, {r6('vector_score')}, 0.0::DOUBLE AS keyword_score FROM w",
        "retrieve_topk": f"""
WITH {INDEX}, {bm25(WORDS)}, {NEAR}, {fused(50)}, w AS (SELECT id, score FROM fused ORDER BY score DESC, id LIMIT 10)
SELECT id, path, {r6('score')} FROM w JOIN idx USING (id)""",
        "rerank_lexical": f"""
WITH {INDEX}, {bm25(WORDS)}, {NEAR}, {fused(50)},
j AS (SELECT id, score, list_distinct(w) AS own FROM fused JOIN tok USING (id)),
q AS (SELECT id, score, len(list_intersect(own, {WORDS.split()})) AS n, len(own) AS o FROM j),
w AS (SELECT id, n / (o + 3 - n) AS rerank_score, score FROM q ORDER BY rerank_score DESC, score DESC, id LIMIT 10)
SELECT id, {r6('rerank_score')} FROM w""",
        "render_results": f"""
WITH {INDEX}, c AS (SELECT * REPLACE ('if x < y & "z" > ''w'': ' || chunk AS chunk) FROM idx)
SELECT id, md5('<file path="' || {ESCAPED.format('path')} || '" repo="' || {ESCAPED.format('repo')} || '" branch="' || {ESCAPED.format('branch')} || '">'
  || chr(10) || {ESCAPED.format('chunk')} || chr(10) || '</file>') AS formatted_md5 FROM c""",
        "render_markdown": f"""
WITH {INDEX}, {bm25(WORDS)}, {NEAR}, {fused(50)}, w AS (SELECT id, score FROM fused ORDER BY score DESC, id LIMIT 5)
SELECT string_agg('### ' || path || chr(10) || chr(10) || '```text' || chr(10) || chunk || chr(10) || '```', chr(10) || chr(10) ORDER BY score DESC, id) AS markdown
FROM w JOIN idx USING (id)""",
        "embedding_errors": f"""
WITH {INDEX} SELECT path, 'marker found' AS message, path AS signature FROM idx WHERE contains(chunk, 'onanshat')""",
        "index_metrics": f"""
WITH {INDEX}, {OPS}
SELECT (SELECT count(*) FROM idx WHERE NOT contains(chunk, 'onanshat')) AS processed_chunks,
       (SELECT count(DISTINCT (repo, path)) FROM idx WHERE NOT contains(chunk, 'onanshat')) AS processed_files,
       (SELECT count(*) FROM last_op WHERE op = 'D') AS deleted_files""",
        "upsert_latest": "SELECT conv_id AS id, turn AS seq, role, md5(text) AS body FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1",
        "upsert_merge": """
SELECT lpad(d.doc_id::VARCHAR, 12, '0') AS id, source AS repo, lang AS status FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT lpad(doc_id::VARCHAR, 12, '0'), 'labelled', quality || '-' || toxic FROM labels""",
        "delete_paths": f"""
WITH {INDEX} SELECT id, repo, branch, path FROM idx
WHERE repo = 'src2' OR NOT EXISTS (SELECT 1 FROM labels l WHERE quality = 0 AND lpad(l.doc_id::VARCHAR, 12, '0') = idx.id)""",
        "purge_orphans": f"""
WITH {INDEX}, {TOKENS}, u AS (SELECT id, unnest(w) AS term FROM tok)
SELECT id, count(DISTINCT term) AS terms, count(*) AS words FROM u WHERE id IN (SELECT lpad(doc_id::VARCHAR, 12, '0') FROM labels) GROUP BY id""",
        "indexed_path_set": f"WITH {OPS} SELECT DISTINCT path FROM log WHERE op = 'M'",
        "index_two_branches": f"""
SELECT b AS branch, {PATH} AS path, (strlen(text) + more)::INT AS n_bytes
FROM documents, (VALUES ('main', 0), ('dev', 5)) v(b, more) WHERE strlen(text) + more > 0""",
        "index_failed_model": f"""
SELECT 'main' AS branch, {PATH} AS path, (strlen(text) + CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 10 END)::INT AS n_bytes
FROM documents WHERE doc_id % 3 <> 0 OR text <> ''""",
        "index_merge_state": f"""
WITH {OPS}
SELECT 'main' AS branch, {PATH} AS path, (strlen(text) + CASE WHEN op IS NULL THEN 0 ELSE 1 END)::INT AS n_bytes
FROM documents LEFT JOIN (SELECT replace(path, 'user_', 'doc_') AS changed, op FROM last_op) o ON changed = {PATH}
WHERE op IS DISTINCT FROM 'D' AND (text <> '' OR op IS NOT NULL)""",
        "chunk_coverage": """
SELECT 'doc_' || doc_id || suffix AS path, strlen(text)::INT AS n_bytes, 0::BIGINT AS missing
FROM documents, (VALUES ('.txt'), ('.java')) v(suffix) WHERE text <> ''""",
        "structured_coverage": """
SELECT 'doc_' || doc_id || suffix AS path, 0::BIGINT AS missing
FROM documents, (VALUES ('.json'), ('.broken.json'), ('.two.json'), ('.jsonl'), ('.yaml'), ('.toml'), ('.md'), ('.csv')) v(suffix)
WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
        "stream_late_changes": """
WITH log AS (
  SELECT 'doc_' || user_id || '.txt' AS path, event_type, epoch_us(ts) * 1000 + event_id % 1000 AS seq FROM events),
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY path ORDER BY seq DESC) = 1)
SELECT 'main' AS branch, path, strlen(text || ' at ' || seq)::INT AS n_bytes
FROM last JOIN documents ON path = 'doc_' || doc_id || '.txt'
WHERE event_type IN ('signup', 'view', 'click', 'purchase')""",
        "vector_topk_ann": """
SELECT count(*) AS queries, sum(least(10, (SELECT count(*) FROM embeddings)))::BIGINT AS neighbours, true AS recall_reached
FROM embeddings WHERE vec_id % 50 = 0""",
        "stored_postings_search": f"WITH {INDEX}, {bm25(WORDS)} SELECT id, {r6('keyword_score')} FROM kw ORDER BY keyword_score DESC, id LIMIT 50",
        "postings_after_changes": f"""
WITH base AS ({INDEX.split(' AS (', 1)[1]},
turns AS (
  SELECT base.*, id::BIGINT % 7 AS seven, id::BIGINT % 11 AS eleven FROM base),
idx AS (
  SELECT * EXCLUDE (seven, eleven) REPLACE (CASE WHEN seven < 3 THEN chunk || repeat(' the lyin', (seven + 1)::INT) ELSE chunk END AS chunk)
  FROM turns WHERE NOT (eleven < 3 AND seven <> eleven AND NOT (seven < 3 AND seven > eleven))),
{bm25(WORDS)}
SELECT id, {r6('keyword_score')} FROM kw""",
        "retrieve_many_titles": f"""
WITH {INDEX}, {TOKENS},
lines AS (
  SELECT lpad(d.doc_id::VARCHAR, 12, '0') AS query_id, array_to_string(list_slice(regexp_extract_all(text, '[A-Za-z]+'), 1, 3), ' ') AS query, embedding
  FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id WHERE d.doc_id % 50 = 0),
asked AS (
  SELECT query_id, term, count(*) AS times FROM (
    SELECT query_id, unnest(string_split(lower(query), ' ')) AS term FROM lines WHERE query <> '') GROUP BY ALL),
st AS (SELECT count(*)::DOUBLE AS total, avg(len(w) + 1) AS mean FROM tok),
tf AS (
  SELECT id, term, dl, count(*) AS n FROM (SELECT id, len(w) + 1 AS dl, unnest(w) AS term FROM tok)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY term),
kw AS (
  SELECT query_id, id, sum(times * CASE WHEN ln((total - df + 0.5) / (df + 0.5)) > 0 THEN ln((total - df + 0.5) / (df + 0.5)) ELSE 1e-6 END
        * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * dl / mean))) AS keyword_score
  FROM asked JOIN tf USING (term) JOIN df USING (term) CROSS JOIN st GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY keyword_score DESC, id) AS kp FROM kw QUALIFY kp <= 250),
vs AS (
  SELECT query_id, id, coalesce(list_cosine_similarity(idx.embedding::DOUBLE[], lines.embedding::DOUBLE[]), 0.0) AS vector_score
  FROM lines CROSS JOIN idx WHERE query <> ''),
v AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY vector_score DESC, id) AS vp FROM vs QUALIFY vp <= 250),
m AS (
  SELECT query_id, id, coalesce(keyword_score, 0.0) AS keyword_score, coalesce(vector_score, 0.0) AS vector_score,
         CASE WHEN kp IS NULL THEN 1000000 + vp ELSE kp END AS pos
  FROM k FULL OUTER JOIN v USING (query_id, id)),
f AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY keyword_score DESC, pos) - 1 AS keyword_rank,
            row_number() OVER (PARTITION BY query_id ORDER BY vector_score DESC, pos) - 1 AS vector_rank FROM m),
s AS (
  SELECT *, 1.0::DOUBLE / (60 + keyword_rank) + 1.0::DOUBLE / (60 + vector_rank) AS score FROM f
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY 1.0::DOUBLE / (60 + keyword_rank) + 1.0::DOUBLE / (60 + vector_rank) DESC, pos) <= 50)
SELECT query_id, id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS place, {r6('score')} FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 10""",
        "changed_chunks": f"""
WITH RECURSIVE {OPS}, {cuts(PLAIN + " WHERE doc_id IN (SELECT replace(replace(path, 'user_', ''), '.txt', '')::BIGINT FROM last_op WHERE op <> 'D')")}, {MERGED}, {OVERLAPPED}
SELECT 'doc_' || k || '.txt' AS path, s AS start_bytes, e AS end_bytes FROM ovl""",
    }
    return texts
