"""SQL counterparts of the catalog queries, for an independent engine over the same tables."""

from .catalog import DIMENSION, ENDINGS, FAILS_ON

ORACLE_SQL: dict[str, str] = {}

# Whether an open chunk o takes in the next one, c.
_FITS = "length(o.content) < 200 AND length(o.content) + 1 + length(c.content) <= 500"

# The whitespace that occurs in the texts.
_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _windows(text: str, size: int = 300, overlap: int = 50) -> str:
    stride = size - overlap
    count = f"CASE WHEN length({text}) <= {size} THEN 1 ELSE CAST(ceil((length({text}) - {overlap}) / {stride}.0) AS INT) END"
    return f"list_transform(range(0, {count}), lambda i: substring({text}, CAST(i * {stride} + 1 AS BIGINT), {size}))"


def _title(segment: str, base: str = "''") -> str:
    line = f"{_strip(f'''ltrim(split_part({segment}, chr(10), 1), '# ')''')}"
    return f"substring(CASE WHEN {line} <> '' THEN {line} ELSE {base} END, 1, 10)"


def _plain_chunks(source: str, size: int = 300, overlap: int = 50) -> str:
    """Chunks of texts without headings: `source` gives document_id, title, text."""
    return f"""
SELECT document_id, document_id || '-' || chunk_index AS chunk_id, content, title,
       {_title('content')} AS section, CAST(chunk_index AS INT) AS chunk_index
FROM (
  SELECT document_id, title, unnest(pieces) AS content,
         CAST(unnest(range(0, len(pieces))) AS BIGINT) AS chunk_index
  FROM (
    SELECT document_id, title,
           list_filter(list_transform({_windows('text', size, overlap)}, lambda w: {_strip('w')}), lambda w: w <> '') AS pieces
    FROM ({source})
  )
)"""


_DOCUMENTS = "SELECT CAST(doc_id AS VARCHAR) AS document_id, source AS title, text FROM documents"
_CHUNKS = _plain_chunks(_DOCUMENTS)

_HEADED = """
SELECT CAST(doc_id AS VARCHAR) AS document_id, source AS title,
       '# ' || source || chr(10) || 'in ' || lang || chr(10) || '## Start' || chr(10)
       || replace(text, chr(10), chr(10) || '### ' || lang || ' section' || chr(10)) AS text
FROM documents"""


def _blocks(levels: str) -> str:
    return f"""
SELECT document_id, title, unnest(blocks) AS block, CAST(unnest(range(0, len(blocks))) AS INT) AS block_no
FROM (
  SELECT document_id, title,
         list_transform(string_split(regexp_replace(text, '(?m)^(#{{{levels}}} .*)$', chr(1) || '\\1', 'g'), chr(1))[2:],
                        lambda b: {_strip('b')}) AS blocks
  FROM ({_HEADED})
)"""


_BLOCKS = _blocks("2,6")

def _headed_chunks(blocks: str) -> str:
    """Chunks of blocks that begin with a heading line."""
    return f"""
SELECT document_id, document_id || '-' || chunk_index AS chunk_id, content, title, inherited,
       coalesce(inherited, {_title('content', 'heading')}) AS section, CAST(chunk_index AS INT) AS chunk_index
FROM (
  SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY block_no, i) - 1 AS chunk_index,
         CASE WHEN i = 0 THEN heading END AS inherited
  FROM (
    SELECT document_id, title, block_no, heading, unnest(pieces) AS content, unnest(range(0, len(pieces))) AS i
    FROM (
      SELECT *, CASE WHEN length(block) <= 300 THEN [block]
                     ELSE list_transform({_windows('body')},
                          lambda w, i: CASE WHEN i = 1 THEN '## ' || heading || chr(10) ELSE '' END || {_strip('w')}) END AS pieces
      FROM (
        SELECT *, {_strip("substring(split_part(block, chr(10), 1), length(regexp_extract(block, '^#+ ')) + 1)")} AS heading,
               ltrim(substring(block, length(split_part(block, chr(10), 1)) + 2), {_WS}) AS body
        FROM ({blocks})
      )
    )
  )
)"""


_HEADED_CHUNKS = _headed_chunks(_BLOCKS)


def _sql(name: str, text: str) -> None:
    ORACLE_SQL[name] = text.strip()


# ---------------------------------------------------------------- sources and sinks

_sql("s1_decode_bytes", "SELECT page_id, CAST(length(t) AS INT) AS n_chars, md5(t) AS digest FROM (SELECT page_id, html AS t FROM pages)")
_sql("s2_plain_text", "SELECT doc_id, text AS clean_text FROM documents")
_sql("s5_strict_text", "SELECT doc_id, text AS clean_text FROM documents")
_sql("k1_clean_texts", f"SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') AS document_id, {_strip('text')} AS clean_text FROM documents")
_sql("s6_jsonl_round_trip", _CHUNKS)
_sql("k2_chunk_files", _CHUNKS)
_sql(
    "s7_titles",
    """SELECT d.document_id,
       CASE WHEN d.lang = 'de' THEN d.source
            WHEN d.lang = 'es' OR m.meta IS NULL OR m.meta = '' THEN d.document_id
            ELSE m.meta END AS title
       FROM (SELECT CAST(doc_id AS VARCHAR) AS document_id, lang, source FROM documents) d
       LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS document_id,
                         CASE WHEN quality = 1 THEN 'good ' || toxic ELSE '' END AS meta FROM labels) m
       ON d.document_id = m.document_id""",
)
_sql("s9_table_counts", f"SELECT document_id, count(*) AS rows FROM ({_CHUNKS}) GROUP BY document_id")
_sql(
    "s9_random_sample",
    """SELECT n AS sampled, n AS different, n AS stored, n AS of_known_size
       FROM (SELECT least(3, count(*)) AS n FROM embeddings)""",
)
_sql(
    "k2_jsonl_lines",
    f"""SELECT CAST(to_json(struct_pack(document_id := document_id, chunk_id := chunk_id, content := content,
        metadata := struct_pack(title := title, section := section, chunk_index := chunk_index))) AS VARCHAR) AS line
        FROM ({_CHUNKS})""",
)
_LOST = f"bool_or(contains(content, '{FAILS_ON}')) OVER (PARTITION BY document_id, chunk_index // 16)"
_ERROR = f"'refused text with ''{FAILS_ON}'''"
_ANSWERED = f"SELECT *, CAST(chunk_index // 16 AS INT) AS batch_id, {_LOST} AS lost FROM ({_CHUNKS})"
_sql(
    "k3_dead_letter_texts",
    f"""SELECT document_id, batch_id, '# Failure: ' || {_ERROR} || chr(10)
        || string_agg('[' || chunk_id || '] ' || content || chr(10), '' ORDER BY chunk_index) || chr(10) AS value
        FROM ({_ANSWERED}) WHERE lost GROUP BY document_id, batch_id""",
)
_CALLS = f"""SELECT document_id || '-' || batch_id || '-' || call_no AS call_id, call_no IS NOT DISTINCT FROM refused AS lost, n
             FROM (SELECT *, min(CASE WHEN bad THEN call_no END) OVER (PARTITION BY document_id, batch_id) AS refused
                   FROM (SELECT document_id, batch_id, (chunk_index % 16) // 8 AS call_no, count(*) AS n,
                                bool_or(contains(content, '{FAILS_ON}')) AS bad
                         FROM ({_ANSWERED}) GROUP BY ALL))
             WHERE refused IS NULL OR call_no <= refused"""
_sql(
    "k5_call_log",
    f"""SELECT call_id, 'request' AS kind, CAST(n AS INT) AS n_items, 'digest' AS model,
               CAST({DIMENSION} AS INT) AS dimensions, NULL AS error FROM ({_CALLS})
        UNION ALL
        SELECT call_id, CASE WHEN lost THEN 'error' ELSE 'response' END, CASE WHEN NOT lost THEN CAST(n AS INT) END, NULL, NULL,
               CASE WHEN lost THEN {_ERROR} END FROM ({_CALLS})""",
)
_sql(
    "k6_load_counts",
    f"""SELECT document_id, count(*) AS total, count(*) FILTER (NOT lost) AS succeeded,
        count(*) FILTER (lost) AS failed FROM ({_ANSWERED}) GROUP BY document_id""",
)
_NAMED = """SELECT page_id, url, name, CASE WHEN strpos(substring(name, 2), '.') > 0 AND right(name, 1) <> '.'
            THEN '.' || string_split(name, '.')[-1] ELSE '' END AS suffix
            FROM (SELECT page_id, url, string_split(rtrim(url, '/'), '/')[-1] AS name FROM pages)"""
_sql(
    "x1_dispatch",
    f"""SELECT page_id, suffix, kind,
        CASE WHEN kind IS NULL THEN 'Unsupported file extension: ' || CASE WHEN suffix = '' THEN '<none>' ELSE suffix END END AS error
        FROM (SELECT *, CASE lower(suffix) WHEN '.pdf' THEN 'pdf' WHEN '.html' THEN 'html' WHEN '.htm' THEN 'html'
              WHEN '.md' THEN 'markdown' WHEN '.markdown' THEN 'markdown' END AS kind FROM ({_NAMED}))""",
)
_LISTED = ", ".join(f"'{e}'" for e in ENDINGS)
_PATHS = f"""SELECT *, CASE WHEN strpos(name, '.') > 1 AND right(name, 1) <> '.' THEN '.' || string_split(name, '.')[-1] ELSE '' END AS suffix
             FROM (SELECT page_id, 'x' || page_id || [{_LISTED}][page_id % {len(ENDINGS)} + 1] AS name, url || '/' || name AS path FROM pages)"""
_sql(
    "x1_composed_paths",
    f"""SELECT page_id, suffix, left(name, length(name) - length(suffix)) AS stem, CASE WHEN lower(suffix) = '.pdf' THEN 'pdf'
        WHEN lower(suffix) IN ('.htm', '.html') THEN 'html' WHEN lower(suffix) IN ('.md', '.markdown') THEN 'markdown' END AS kind
        FROM ({_PATHS})""",
)
_sql(
    "x3_rejects",
    f"""SELECT path, 'Unsupported file extension: ' || CASE WHEN suffix = '' THEN '<none>' ELSE suffix END AS error FROM ({_PATHS})
        WHERE lower(suffix) NOT IN ('.pdf', '.htm', '.html', '.md', '.markdown')""",
)
_sql(
    "x2_document_id",
    f"""SELECT page_id, left(name, length(name) - length(suffix)) AS stem, page_id || '.tar' AS document_id
        FROM ({_NAMED})""",
)

# ---------------------------------------------------------------- HTML

# On the given pages everything after the first `<p><b>` stays inside that unclosed
# paragraph, so an article is its heading and one block in which only `<br>` breaks lines.
_REST = "regexp_replace(replace(rest, '<br>', chr(10)), '<[^>]*>', '', 'g')"


def _unescaped(x: str) -> str:
    return f"regexp_replace(replace({x}, '&quot;', chr(34)), '&amp;?', '&', 'g')"


_PAGES = f"""
SELECT page_id, url, '# ' || trim(h1) || CASE WHEN rest <> '' THEN chr(10) || chr(10) || rest ELSE '' END AS text
FROM (
  SELECT page_id, url, {_unescaped('h1')} AS h1, {_strip(_unescaped(_REST))} AS rest
  FROM (SELECT page_id, url, regexp_extract(html, '<h1>((?s:.*?))</h1>', 1) AS h1,
               regexp_extract(html, '</h1>((?s:.*))</article>', 1) AS rest FROM pages)
)"""
_sql("h_clean_pages", f"SELECT page_id, text AS clean_text FROM ({_PAGES})")
_sql(
    "h_lists_and_tables",
    """SELECT doc_id, '# ' || lang || chr(10) || chr(10)
       || array_to_string(list_transform(string_split(text, chr(10)), lambda p, i: (i + 2) || '. ' || p), chr(10))
       || chr(10) || chr(10) || '- top' || chr(10) || chr(10) || '  - ' || source || chr(10) || chr(10)
       || '- end' || chr(10) || '  more' || chr(10) || chr(10)
       || '| ' || rpad('document', 8, ' ') || ' | ' || rpad('chars', w, ' ') || ' |' || chr(10)
       || '| ' || repeat('-', 8) || ' | ' || repeat('-', w) || ' |' || chr(10)
       || '| ' || rpad(CAST(doc_id AS VARCHAR), 8, ' ') || ' | ' || rpad(CAST(n_chars AS VARCHAR), w, ' ') || ' |' || chr(10)
       || '| ' || rpad('only', 8, ' ') || ' | ' || repeat(' ', w) || ' |' || chr(10) || chr(10)
       || '### In ' || lang || chr(10) || chr(10)
       || '```' || chr(10) || 'a' || chr(10) || 'b' || chr(10) || '```' || chr(10) || chr(10)
       || '> one' || chr(10) || '> two' || chr(10) || chr(10)
       || 'see [this](/d/' || doc_id || ')</x>' || chr(10) || chr(10) || '</y>' || chr(10) || chr(10) || 'End' AS clean_text
       FROM (SELECT *, CAST(greatest(5, length(CAST(n_chars AS VARCHAR))) AS INT) AS w FROM documents)""",
)
_sql(
    "h_block_kinds",
    """WITH kinds(kind, level, txt) AS (
         SELECT 'item', 0, p FROM (SELECT unnest(string_split(text, chr(10))) AS p FROM documents)
         UNION ALL SELECT 'item', 0, 'top' FROM documents
         UNION ALL SELECT 'item', 1, source FROM documents
         UNION ALL SELECT 'item', 0, 'end' || chr(10) || 'more' FROM documents
         UNION ALL SELECT 'table', 0, '' FROM documents
         UNION ALL SELECT 'heading', 3, 'In ' || lang FROM documents
         UNION ALL SELECT 'pre', 0, 'a' || chr(10) || 'b' FROM documents
         UNION ALL SELECT 'blockquote', 0, 'one' || chr(10) || 'two' FROM documents
         UNION ALL SELECT 'p', 0, 'see [this](/d/' || doc_id || ')</x>' FROM documents
         UNION ALL SELECT 'a', 0, '</y>' FROM documents
         UNION ALL SELECT 'other', 0, 'End' FROM documents)
       SELECT kind, CAST(level AS INT) AS level, count(*) AS blocks, CAST(sum(length(txt)) AS BIGINT) AS chars
       FROM kinds GROUP BY kind, level""",
)
_sql(
    "h14_title_part",
    """SELECT doc_id, CASE WHEN n_chars > 2000 THEN 'long' ELSE source END AS part,
       CAST(doc_id AS VARCHAR) AS wide_part FROM documents""",
)
_sql("h15_normalise", f"SELECT doc_id, {_strip('text')} AS clean_text FROM documents")
_FLAT = "document_id, chunk_id, content, title, section, chunk_index"
_PAGE_BLOCKS = f"SELECT CAST(page_id AS VARCHAR) AS document_id, url AS title, text AS block, 0 AS block_no FROM ({_PAGES})"
_sql("h_pages_to_chunks", f"SELECT {_FLAT} FROM ({_headed_chunks(_PAGE_BLOCKS)})")

# ---------------------------------------------------------------- PDF layout

_WORDS = """
SELECT doc_id, page_no, word_idx,
       CASE WHEN line % 9 = 8 THEN CAST(pos + 1 AS VARCHAR) ELSE token END AS text,
       CAST(x0 AS DOUBLE) AS x0, CAST(x0 + 40 AS DOUBLE) AS x1, top, top + 8 + pos % 3 AS bottom,
       CASE WHEN line % 10 = 0 THEN 14.0::DOUBLE ELSE 10.0::DOUBLE END AS size, line % 10 = 5 AS bold
FROM (
  SELECT *, side * 400 + pos * 45 + CASE WHEN doc_id % 4 = 2 AND line % 7 = 3 AND pos >= 6 THEN 210 ELSE 60 END AS x0,
         CAST(CASE WHEN r = 0 THEN 50 WHEN r = 239 THEN 950
              ELSE 110 + line * 20 + (line // 6) * 40 + (pos % 2) * 0.03125 END AS DOUBLE) AS top
  FROM (
    SELECT *, k // per_line AS line, k % per_line AS pos
    FROM (
      SELECT doc_id, word_idx, token, CAST(word_idx // 240 + 1 AS INT) AS page_no, word_idx % 240 AS r,
             CASE WHEN doc_id % 2 = 1 THEN (word_idx % 240) // 120 ELSE 0 END AS side,
             CASE WHEN doc_id % 2 = 1 THEN word_idx % 120 ELSE word_idx % 240 END AS k,
             CASE WHEN doc_id % 2 = 1 THEN 6 ELSE 12 END AS per_line
      FROM (SELECT doc_id, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS word_idx
            FROM (SELECT doc_id, string_split(regexp_replace(text, '[ \\n]+', ' ', 'g'), ' ') AS tokens FROM documents))
    )
  )
)"""
_PDF = f"""
WITH words AS ({_WORDS}),
kept_words AS (SELECT * FROM words WHERE text <> '' AND top >= 100 AND bottom <= 900),
measures AS (
  SELECT doc_id, page_no, median(size) AS body_size, 2 * median(bottom - top) AS line_gap
  FROM kept_words GROUP BY doc_id, page_no),
measured AS (SELECT w.*, m.body_size, m.line_gap, round(top, 1) AS line_top
             FROM kept_words w JOIN measures m USING (doc_id, page_no)),
flagged AS (
  SELECT *, CASE WHEN x0 - lag(x1) OVER line > greatest(4 * body_size, 40, least(0.12 * 800, 110)) THEN 1 ELSE 0 END AS starts
  FROM measured WINDOW line AS (PARTITION BY doc_id, page_no, line_top ORDER BY x0, word_idx)),
numbered AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY doc_id, page_no, line_top ORDER BY x0, word_idx
                                   ROWS UNBOUNDED PRECEDING) AS INT) AS segment_no FROM flagged),
raw_segments AS (
  SELECT doc_id, page_no, line_top, segment_no, max(line_gap) AS line_gap, min(x0) AS first_x0,
         median((x0 + x1) / 2) AS centre, string_agg(text, ' ' ORDER BY x0, word_idx) AS raw,
         bool_or(bold OR size >= 1.2 * body_size) AS marked
  FROM numbered GROUP BY doc_id, page_no, line_top, segment_no),
segments AS (
  SELECT * EXCLUDE (raw, marked), CASE WHEN marked THEN trim('## ' || ltrim(raw, '# ')) ELSE raw END AS text FROM raw_segments),
gaps AS (
  SELECT doc_id, page_no, centre, lead(centre) OVER (PARTITION BY doc_id, page_no ORDER BY centre) AS following
  FROM (SELECT DISTINCT doc_id, page_no, centre FROM segments)),
widest AS (
  SELECT doc_id, page_no, (centre + following) / 2 AS boundary FROM gaps WHERE following - centre >= 144
  QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY following - centre DESC, centre) = 1),
placed AS (
  SELECT s.*, w.boundary, CAST(CASE WHEN s.centre > w.boundary THEN 1 ELSE 0 END AS INT) AS column_no
  FROM segments s LEFT JOIN widest w USING (doc_id, page_no)),
judged AS (
  SELECT *, NOT regexp_full_match(text, '[0-9\\s]+|[A-Z]\\.?') AS kept,
         line_top - lag(line_top) OVER col > line_gap AS wide
  FROM placed WINDOW col AS (PARTITION BY doc_id, page_no, column_no ORDER BY line_top, first_x0, segment_no)),
looked AS (
  SELECT *, last_value(CASE WHEN kept THEN text END IGNORE NULLS) OVER before AS last,
         sum(CASE WHEN wide THEN 1 ELSE 0 END) OVER so_far AS n_wide
  FROM judged WINDOW
    before AS (PARTITION BY doc_id, page_no, column_no ORDER BY line_top, first_x0, segment_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    so_far AS (PARTITION BY doc_id, page_no, column_no ORDER BY line_top, first_x0, segment_no ROWS UNBOUNDED PRECEDING)),
compared AS (
  SELECT *, last_value(CASE WHEN kept THEN n_wide END IGNORE NULLS) OVER before AS last_wide
  FROM looked WINDOW
    before AS (PARTITION BY doc_id, page_no, column_no ORDER BY line_top, first_x0, segment_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
joined AS (
  SELECT *, CASE WHEN last IS NULL THEN chr(10) || chr(10)
                 WHEN starts_with(last, '## ') THEN chr(10)
                 WHEN n_wide > last_wide THEN chr(10) || chr(10)
                 WHEN starts_with(text, '## ') OR regexp_matches(last, '[。！?？!；;：:.…0-9]$')
                      OR regexp_matches(text, '^([-*•●·]|[0-9]+[).]|[ivxlcdmIVXLCDM]+\\.)') THEN chr(10)
                 ELSE ' ' END AS joint
  FROM compared),
page_texts AS (
  SELECT doc_id, page_no, trim(coalesce(string_agg(joint || text, '' ORDER BY column_no, line_top, first_x0, segment_no)
                                        FILTER (kept), ''), ' ' || chr(10)) AS page_text
  FROM joined GROUP BY doc_id, page_no)
"""


def _pdf(name: str, select: str) -> None:
    _sql(name, _PDF + select)


_pdf("p1_filtered_words", "SELECT doc_id, page_no, count(*) AS words, CAST(sum(length(text)) AS BIGINT) AS chars FROM kept_words GROUP BY doc_id, page_no")
_pdf("p2_page_measures", "SELECT doc_id, page_no, body_size, line_gap FROM measures")
_pdf("p4_lines", "SELECT doc_id, page_no, line_top, count(*) AS words, CAST(max(segment_no) + 1 AS INT) AS segments FROM numbered GROUP BY doc_id, page_no, line_top")
_pdf("p5_segments", "SELECT doc_id, page_no, line_top, segment_no, first_x0, centre, text FROM segments")
_pdf("p7_columns", "SELECT doc_id, page_no, max(boundary) AS boundary, count(*) FILTER (column_no = 0) AS left_lines, count(*) FILTER (column_no = 1) AS right_lines FROM placed GROUP BY doc_id, page_no")
_pdf("p13_joints", "SELECT doc_id, page_no, column_no, line_top, segment_no, text, kept, joint FROM joined")
_pdf("p15_page_texts", "SELECT doc_id, page_no, page_text FROM page_texts")
_pdf(
    "s4_page_fallback",
    f""", split AS (SELECT doc_id, string_split(regexp_replace(text, '[ \\n]+', ' ', 'g'), ' ') AS tokens FROM documents),
        plain AS (
          SELECT doc_id, page_no, {_strip("array_to_string(tokens[(page_no - 1) * 240 + 1 : page_no * 240], ' ')")} AS plain_text
          FROM (SELECT *, CAST(unnest(range(1, CAST(ceil(len(tokens) / 240.0) AS BIGINT) + 1)) AS INT) AS page_no FROM split))
        SELECT p.doc_id, p.page_no, CASE WHEN p.page_no % 3 = 2 THEN plain_text ELSE coalesce(t.page_text, plain_text) END AS page_text
        FROM plain p LEFT JOIN page_texts t ON t.doc_id = p.doc_id AND t.page_no = p.page_no""",
)
_pdf(
    "p16_documents",
    f""", all_pages AS (
          SELECT w.doc_id, w.page_no, coalesce(t.page_text, d.lang || ' page ' || w.page_no) AS page_text
          FROM (SELECT DISTINCT doc_id, page_no FROM words) w JOIN documents d USING (doc_id)
          LEFT JOIN page_texts t ON t.doc_id = w.doc_id AND t.page_no = w.page_no)
        SELECT doc_id, coalesce(string_agg(page_text, chr(10) || chr(10) ORDER BY page_no) FILTER (page_text <> ''), '')
        AS clean_text FROM all_pages GROUP BY doc_id""",
)

# ---------------------------------------------------------------- chunks

_sql("c1_blocks", f"SELECT document_id, block_no, block FROM ({_BLOCKS})")
_sql("c1_blocks_levels", f"SELECT document_id, block_no, block FROM ({_blocks('1,2')})")
_sql(
    "c3_fixed_chunks",
    f"""SELECT document_id, CAST(unnest(range(0, len(pieces))) AS INT) AS n, unnest(pieces) AS piece
        FROM (SELECT document_id, {_windows('text')} AS pieces FROM ({_DOCUMENTS}))""",
)
_sql("c5_headings", f"SELECT document_id, title AS heading, {_strip('split_part(text, chr(10), 1)')} AS indented_heading FROM ({_HEADED})")
_sql("c6_without_heading", f"SELECT document_id, ltrim(substring(text, strpos(text, chr(10)) + 1), {_WS}) AS body FROM ({_HEADED})")
_sql("c8_chunks", _CHUNKS)
_sql("c8_chunks_headed", f"SELECT {_FLAT} FROM ({_HEADED_CHUNKS})")
_sql(
    "c10_fallback_title",
    f"""SELECT conv_id, turn, {_title(_strip('text'))} AS title, substring(role || ' without text', 1, 10) AS base_title
        FROM conversations""",
)
_sql(
    "c11_service_titles",
    f"""SELECT document_id, chunk_id, content, title, chunk_index,
        CASE WHEN inherited IS NULL AND md5(content)[1] <> '0' THEN md5(content)[1:8] ELSE section END AS section
        FROM ({_HEADED_CHUNKS})""",
)

# ---------------------------------------------------------------- embedding and loading

_BATCHES = f"""SELECT document_id, batch_id, CAST(count(*) AS INT) AS n_chunks, arg_min(chunk_id, chunk_index) AS first_chunk,
               arg_max(chunk_id, chunk_index) AS last_chunk FROM ({_ANSWERED}) GROUP BY document_id, batch_id"""
_sql("e1_batches", _BATCHES)
_sql("e1_stored_batches", _BATCHES)


def _component(i: int) -> str:
    return f"(CAST('0x' || md5('{i}:' || content)[1:6] AS BIGINT) / 8388608.0 - 1)"


_VECTOR = "'[' || " + " || ',' || ".join(f"printf('%.8f', CAST({_component(i)} AS DOUBLE))" for i in range(DIMENSION)) + " || ']'"
_sql("e2_embeddings", f"SELECT chunk_id, {_VECTOR} AS vector FROM ({_CHUNKS})")
_METADATA = "CAST(to_json(struct_pack(title := title, section := section, chunk_index := chunk_index)) AS VARCHAR)"
_EMBEDDING_TEXT = "'[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', CAST(x AS DOUBLE))), ',') || ']'"
_sql(
    "e4_embedding_responses",
    f"""SELECT vec_id // 8 AS call_no, CAST(row_number() OVER (PARTITION BY vec_id // 8 ORDER BY vec_id) - 1 AS INT) AS n,
        CAST(len(embedding) AS INT) AS dimension, {_EMBEDDING_TEXT} AS vector FROM embeddings""",
)
_sql("e5_title_responses", f"SELECT conv_id, turn, {_strip('text')} AS title FROM conversations")
_sql("l1_loaded_chunks", f"SELECT document_id, chunk_id, content, section, {_VECTOR} AS vector FROM ({_ANSWERED}) WHERE NOT lost")
_sql("l1_dead_letters", f"SELECT document_id, batch_id, {_ERROR} AS reason, chunk_id, content FROM ({_ANSWERED}) WHERE lost")
_sql("l2_paired_vectors", f"SELECT chunk_id, md5(content) AS digest, {_VECTOR} AS vector FROM ({_ANSWERED}) WHERE NOT lost")
_LARGER = _plain_chunks(f"{_DOCUMENTS} WHERE doc_id IN (SELECT doc_id FROM labels)", 500, 100)
_sql(
    "u1_upsert",
    f"""SELECT * FROM ({_CHUNKS}) WHERE document_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
        UNION ALL SELECT * FROM ({_LARGER})""",
)
_sql("k4_stored_table", f"SELECT chunk_id, document_id, content, {_VECTOR} AS vector, {_METADATA} AS metadata FROM ({ORACLE_SQL['u1_upsert']})")
_STORED = """SELECT CAST(label AS VARCHAR) AS document_id, len(CASE WHEN vec_id % 5 = 0 THEN embedding[1:63] ELSE embedding END) AS n,
             CASE WHEN vec_id % 7 = 0 THEN '' ELSE CAST(vec_id AS VARCHAR) END AS content,
             CASE WHEN vec_id % 11 = 0 THEN '{' ELSE '{"label":' || label || '}' END AS metadata FROM embeddings"""
_sql(
    "u1_refusals",
    f"""SELECT count(*) AS rows, count(*) FILTER (document_id IS NULL) AS without_document,
        count(*) FILTER (n IS NULL) AS without_embedding, count(*) FILTER (n <> 64) AS wrong_dimension FROM ({_STORED})""",
)
_sql(
    "u2_integrity",
    f"""SELECT document_id, count(*) AS rows, count(*) FILTER (n <> 64) AS wrong_dimension,
        count(*) FILTER (content = '') AS empty_content, count(*) FILTER (NOT json_valid(metadata)) AS invalid_metadata
        FROM ({_STORED}) GROUP BY document_id""",
)
_sql(
    "u5_nearest_vectors",
    """SELECT query, CAST(row_number() OVER near AS INT) AS rank, id, round(cosine, 6) AS cosine FROM (
         SELECT a.vec_id AS query, b.vec_id AS id,
                round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS cosine
         FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
       WINDOW near AS (PARTITION BY query ORDER BY cosine DESC, id) QUALIFY row_number() OVER near <= 10""",
)
_sql(
    "u5_graph_search",
    """SELECT count(*) FILTER (vec_id % 100 = 0) AS queries, count(*) FILTER (vec_id % 100 = 0) * least(10, count(*) - 1) AS answers,
       true AS nine_in_ten, CAST(0 AS BIGINT) AS wrong_cosines FROM embeddings""",
)
_sql(
    "u5_metadata_search",
    f"""WITH c AS ({_CHUNKS}), p AS (SELECT DISTINCT title, section FROM c WHERE CAST(document_id AS BIGINT) % 100 = 0)
        SELECT CAST(to_json(struct_pack(title := title, section := section)) AS VARCHAR) AS pattern, chunk_id FROM c JOIN p USING (title, section)
        UNION ALL SELECT CAST(to_json(struct_pack(title := title)) AS VARCHAR), chunk_id FROM c
        UNION ALL SELECT '{{"chunk_index":3}}', chunk_id FROM c WHERE chunk_index = 3""",
)
_sql(
    "s9_sample_each",
    f"""SELECT document_id, chunk_id, content FROM ({_CHUNKS})
        QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY sha256('7/' || chunk_id), content) <= 3""",
)
_sql(
    "k6_load_report",
    f"""SELECT source, lang, grouping(source, lang) AS grouping, count(DISTINCT document_id) AS documents, count(*) AS chunks,
               CAST(sum(length(content)) AS BIGINT) AS characters
        FROM ({_CHUNKS}) JOIN (SELECT CAST(doc_id AS VARCHAR) AS document_id, source, lang FROM documents) USING (document_id)
        GROUP BY CUBE (source, lang)""",
)
# A row for each document and chunk read: the chunk that is open then, and its number.
_sql(
    "c14_merged_chunks",
    f"""WITH RECURSIVE chunks AS (SELECT {_FLAT} FROM ({_HEADED_CHUNKS})), open AS (
          SELECT document_id, chunk_index AS i, content, title, section, 0 AS n FROM chunks WHERE chunk_index = 0
          UNION ALL
          SELECT o.document_id, c.chunk_index, CASE WHEN {_FITS} THEN o.content || chr(10) || c.content ELSE c.content END,
                 CASE WHEN {_FITS} THEN o.title ELSE c.title END, CASE WHEN {_FITS} THEN o.section ELSE c.section END,
                 CASE WHEN {_FITS} THEN o.n ELSE o.n + 1 END
          FROM open o JOIN chunks c ON c.document_id = o.document_id AND c.chunk_index = o.i + 1)
        SELECT document_id, document_id || '-' || n AS chunk_id, content, title, section, CAST(n AS INT) AS chunk_index
        FROM open QUALIFY row_number() OVER (PARTITION BY document_id, n ORDER BY i DESC) = 1""",
)
_sql("u3_vector_text", f"SELECT vec_id, {_EMBEDDING_TEXT} AS vector FROM embeddings")
_sql(
    "u3_vector_parse",
    f"SELECT vec_id, CAST(len(embedding) AS INT) AS dimension, {_EMBEDDING_TEXT} AS vector FROM embeddings",
)
_sql(
    "u3_double_vectors",
    """SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', CAST(x AS DOUBLE) / 3)), ',') || ']'
       AS vector FROM embeddings""",
)
_sql("u4_metadata_json", f"SELECT chunk_id, {_METADATA} AS metadata FROM ({_CHUNKS})")
_PAGE_CHUNKS = _headed_chunks(_PAGE_BLOCKS.replace("url AS title", "CAST(page_id AS VARCHAR) AS title"))
_sql(
    "i1_ingest",
    f"""SELECT chunk_id, document_id, content, {_VECTOR} AS vector, {_METADATA} AS metadata
        FROM (SELECT *, {_LOST} AS lost FROM ({_PAGE_CHUNKS})) WHERE NOT lost""",
)
_sql(
    "j1_asof_join",
    """SELECT e.event_id, e.user_id, c.event_id AS click_id, c.value AS click_value FROM events e
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1) c
       ON e.user_id = c.user_id AND e.ts >= c.ts""",
)
_MOMENT = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_sql(
    "w1_sliding_windows",
    f"""WITH starts AS (SELECT *, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') - n * INTERVAL 2 HOUR AS w FROM events, range(3) r(n))
        SELECT event_type, {_MOMENT.format("w")} AS window_start, {_MOMENT.format("w + INTERVAL 6 HOUR")} AS window_end,
               count(*) AS events, max(value) AS highest FROM starts GROUP BY event_type, w""",
)
_sql(
    "w2_stream_sessions",
    f"""WITH marked AS (SELECT *, ts - lag(ts) OVER w <= INTERVAL 6 HOUR AS goes_on FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (SELECT *, count_if(goes_on IS NOT TRUE) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM marked)
        SELECT user_id, {_MOMENT.format("min(ts)")} AS session_start, {_MOMENT.format("max(ts) + INTERVAL 6 HOUR")} AS session_end,
               count(*) AS events, min(event_id) AS first_id, max(value) AS highest FROM numbered GROUP BY user_id, n""",
)
_sql(
    "j2_overlapping_intervals",
    f"""WITH words AS ({_WORDS}), placed AS (SELECT doc_id || '/' || page_no AS page, word_idx, "top" AS low, bottom AS high, size FROM words),
        regions AS (SELECT DISTINCT page, low, low + 90 AS high FROM placed WHERE size = 14)
        SELECT r.page, r.low, count(*) AS words, CAST(sum(w.word_idx) AS BIGINT) AS places
        FROM regions r JOIN placed w ON w.page = r.page AND w.low <= r.high AND r.low <= w.high GROUP BY r.page, r.low""",
)
_sql(
    "w3_newest_versions",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
