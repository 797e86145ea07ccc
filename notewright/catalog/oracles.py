"""DuckDB SQL with the expected result of each registered query, written independently of the engine."""

from __future__ import annotations

from notewright.catalog.fixtures import view_sql
from notewright.functions.provenance import ARTICLE_URL, BANK_URL, TRACK_URL


def _with(views: str, body: str) -> str:
    ctes = ", ".join(f"{name} AS ({view_sql(name)})" for name in views.split())
    return f"WITH {ctes}{',' if body.lstrip().startswith('+') else ''} {body.lstrip().lstrip('+')}"


VALID = "id IS NOT NULL AND id <> '' AND note IS NOT NULL"
WHOLE_IDX = "TRY_CAST(idx_raw AS BIGINT)"


def _horner(id_expr: str, n: int) -> str:
    rest = "0::BIGINT"
    for start in (1, 9, 17, 25):
        word = f"('0x' || substr(md5({id_expr}), {start}, 8))::BIGINT"
        rest = f"(({rest} * 4294967296 + {word}) % {n})"
    return f"CAST({rest} AS INTEGER)"


SHARD = _horner("id", 7)

LOOKUP = """
lookup AS (
  SELECT lower(raw_key) AS key, arg_max(TRY_CAST(raw_value AS BIGINT), ord) AS bank_row
  FROM lookup_entries WHERE TRY_CAST(raw_value AS BIGINT) IS NOT NULL GROUP BY 1
)"""

SOURCE = r"""
CASE
  WHEN regexp_full_match(k, 'usmle-\d+') THEN
    '@BANK' || bank_row
  WHEN regexp_full_match(k, 'pmc-\d+-\d+') THEN
    '@ARTICLE' || regexp_extract(k, 'pmc-(\d+)-', 1) || '/'
  WHEN regexp_full_match(k, 'trec-(cds|ct)-\d{4}-\d+') THEN
    '@TRACK' || regexp_extract(k, '-(\d{4})-', 1) || '.html'
END"""
for _name, _address in (("@BANK", BANK_URL), ("@ARTICLE", ARTICLE_URL), ("@TRACK", TRACK_URL)):
    SOURCE = SOURCE.replace(_name, _address)

# Rows of the id family with a running number per text, and which of them remain.
FAMILY = r"""
family AS (
  SELECT ord, id, CAST(substr(id, 7) AS BIGINT) AS num, note,
         CASE WHEN note IS NOT NULL THEN row_number() OVER (PARTITION BY note ORDER BY ord) END AS rn,
         CASE WHEN note IS NOT NULL THEN count(*) OVER (PARTITION BY note) END AS n_ids
  FROM notes WHERE regexp_full_match(id, 'usmle-\d+')
),
kept AS (
  SELECT * FROM family WHERE id NOT IN (SELECT id FROM family WHERE rn > 1)
)"""

BANK = f"""
bank AS (
  SELECT ord, {WHOLE_IDX} AS idx, question FROM qbank
  WHERE {WHOLE_IDX} IS NOT NULL AND question IS NOT NULL
),
cands AS (
  SELECT question, arg_min(idx, ord) AS first_idx, count(*) AS n_candidates FROM bank GROUP BY 1
)"""

MATCHED = (
    FAMILY + "," + BANK + """,
matched AS (
  SELECT kept.*, first_idx, coalesce(n_candidates, 0) AS n_candidates
  FROM kept LEFT JOIN cands ON note = question
)"""
)

# Notes that arrive as JSON lines in two folders; a note left out of its line is empty.
ARRIVED = f"""
lines AS (SELECT ord, id, CASE WHEN ord % 11 = 0 THEN '' ELSE note END AS note FROM notes),
valid AS (
  SELECT 'first' AS run_tag, * FROM lines WHERE ord % 3 = 0 AND {VALID}
  UNION ALL SELECT 'second', * FROM lines WHERE {VALID}
),
fresh AS (
  SELECT * FROM valid WHERE run_tag = 'first' OR id NOT IN (SELECT id FROM valid WHERE run_tag = 'first')
)"""

SYSTEM_PROMPT = """You extract structured fields from a clinical note.

Return ONE valid JSON object and NOTHING ELSE.

Rules:
- Use null if not present/unknown for scalar fields.
- Use [] (empty list) if none for list fields.
- Do not guess. Only extract what is explicitly supported by the note.
- Keep strings concise. No long sentences.
- Limit each list to at most 30 items (choose the most clinically relevant).
- For "sex": one of ['M', 'F'] or null.
- "conditions" is a list of objects: {"name": string, "status": string (one of ['present', 'negated', 'uncertain', 'historical'])}
- "specialties" is a list of string values (one of ['cardiology', 'oncology', 'other']).
"""
PROMPT_HEAD = SYSTEM_PROMPT + "\n\nUser:\nExtract the fields from this clinical note.\n\nNOTE:\n"
PROMPT_TAIL = (
    '\n\nJSON KEYS (must match exactly):\n["age", "sex", "chief_complaint", "conditions", "specialties"]'
    "\n\n\nAssistant:\n"
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


PROMPT = f"{_text(PROMPT_HEAD)} || note || {_text(PROMPT_TAIL)}"
SPACES = (
    r"\t\n\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BREAK = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}])"


def _words(col: str) -> str:
    return f"CAST(len(regexp_extract_all({col}, '[^{SPACES}]+')) AS BIGINT)"


def _lines(col: str) -> str:
    body = f"regexp_replace({col}, '{BREAK}$', '')"
    return f"CAST(len(regexp_extract_all({body}, '{BREAK}')) + 1 AS BIGINT)"


# What each class of reply says, spelled out instead of parsed.
ANSWERS = """
answers AS (
  SELECT doc_id AS ord, doc_id % 10 AS class, n_chars % 100 AS n, lang,
         CASE WHEN doc_id % 2 = 0 THEN 'F' ELSE 'M' END AS g,
         CASE doc_id % 3 WHEN 0 THEN 'present' WHEN 1 THEN 'negated' ELSE 'maybe' END AS st
  FROM documents
)"""


def _fields(readable: str) -> str:
    """The values of a reply, given the classes that can be read and carry the full object."""
    return f"""
      CASE WHEN class IN ({readable}) THEN n WHEN class = 3 THEN 5 WHEN class = 7 THEN 62 END AS age,
      CASE WHEN class IN ({readable}) THEN g END AS sex,
      CASE WHEN class IN ({readable}) THEN lang WHEN class = 3 THEN 'x' END AS condition,
      CASE WHEN class IN ({readable}) THEN st WHEN class = 3 THEN 'present' END AS status"""


def _parsed_fields(readable: str) -> str:
    return _with(
        "notes",
        f"""+{ANSWERS}
        SELECT ord, class IN ({readable}, 3, 7, 8) AS ok, {_fields(readable)},
               CAST(NULL AS VARCHAR) AS second, CAST(CASE WHEN class = 7 THEN 1 END AS BIGINT) AS extra
        FROM answers""",
    )


CONFORMED = """
  CAST(NULL AS VARCHAR) AS chief_complaint,
  CASE WHEN condition IS NULL THEN '[]'
       ELSE '[{"name":"' || condition || '","status":"' || status || '"}]' END AS conditions,
  CASE WHEN sex IS NULL THEN '[]' ELSE '["other"]' END AS specialties"""

WORKERS = """
sums AS (
  SELECT run_tag, min(start_ts) AS s, max(end_ts) AS e, CAST(sum(gen_ms) AS BIGINT) / 1000.0::DOUBLE AS gen,
         CAST(sum(seen) AS BIGINT) AS seen, CAST(sum(written) AS BIGINT) AS written,
         CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(failed) AS BIGINT) AS failed,
         CAST(sum(input_tokens) AS BIGINT) AS i, CAST(sum(output_tokens) AS BIGINT) AS o,
         count(*) AS batches
  FROM batch_log GROUP BY 1
),
timed AS (SELECT *, (epoch_us(e) - epoch_us(s)) / 1e6::DOUBLE AS span FROM sums)"""

MERGED = """
merged AS (
  SELECT count(*) AS replicas, min(s) AS s, max(e) AS e, sum(gen) AS gen, CAST(sum(written) AS BIGINT) AS w,
         CAST(sum(batches) AS BIGINT) AS b, CAST(sum(i) AS BIGINT) AS i, CAST(sum(o) AS BIGINT) AS o,
         (epoch_us(max(e)) - epoch_us(min(s))) / 1e6::DOUBLE AS wall
  FROM timed
)"""


def _div(num: str, den: str) -> str:
    return f"round(CASE WHEN {den} > 0 THEN ({num})::DOUBLE / {den} ELSE 0.0 END, 6)"


TOKEN_RATES = f"""
  i AS input_tokens, o AS output_tokens, i + o AS total_tokens,
  {_div('i', 'gen')} AS input_toks_per_s, {_div('o', 'gen')} AS output_toks_per_s"""

REPLICAS = _with(
    "batch_log",
    f"""+{WORKERS},{MERGED}
    SELECT replicas, epoch_us(s) AS start_us, epoch_us(e) AS end_us, round(wall, 6) AS wall_time_s,
           round(gen, 6) AS gen_time_s, w AS notes_written, {TOKEN_RATES},
           {_div('w', 'wall')} AS notes_per_s, {_div('i + o', 'wall')} AS total_toks_per_s
    FROM merged""",
)

# The place of each document in four files by the remainder of its id, for either format.
PLACES = """
    SELECT fmt, row_number() OVER (PARTITION BY fmt ORDER BY file, doc_id) - 1 AS place, {value} AS {name}
    FROM (SELECT doc_id, CASE WHEN doc_id IS NULL THEN 'e' WHEN doc_id % 97 = 0 THEN 'a' WHEN doc_id % 97 = 1 THEN 'c'
                              WHEN doc_id % 2 = 0 THEN 'b' ELSE 'd' END AS file FROM documents)
    CROSS JOIN (VALUES ('parquet'), ('json')) AS f(fmt)"""

# Records of one value of one facet and two of another.
WANTED = f"""
{ANSWERS},
f AS (SELECT ord, {_fields('0, 1, 2, 6')} FROM answers WHERE class NOT IN (4, 5, 9)),
wanted AS (SELECT * FROM f WHERE sex = 'F' AND status IN ('present', 'maybe'))"""


ORACLES: dict[str, str] = {
    "scan_notes_files": PLACES.format(value="doc_id::VARCHAR", name="id"),
    "scan_bank_files": PLACES.format(value="doc_id::VARCHAR", name="idx_raw"),
    "scan_notes": "SELECT doc_id AS ord, CAST(doc_id AS VARCHAR) AS id, text AS note FROM documents",
    "qbank_scan_counts": _with(
        "qbank",
        f"""SELECT count(*) AS bank_total,
                   count(*) FILTER (WHERE question IS NULL OR {WHOLE_IDX} IS NULL) AS bank_missing_fields
            FROM qbank""",
    ),
    "lookup_table": _with("lookup_entries", f"+{LOOKUP} SELECT key, bank_row FROM lookup"),
    "lookup_report": _with("lookup_entries", f"+{LOOKUP} SELECT key, bank_row FROM lookup"),
    "record_lines": _with(
        "answered_notes",
        f"""SELECT id, 'id,patient_note,source,' || CASE WHEN ord % 10 IN (4, 5, 6, 9)
                     THEN 'extraction_ok,model_output_raw'
                     ELSE 'age,sex,chief_complaint,conditions,specialties,extraction_ok' END AS keys
            FROM answered_notes WHERE {VALID}""",
    ),
    "jsonl_roundtrip": _with("notes", "SELECT * FROM notes"),
    "parquet_roundtrip": _with("notes", "SELECT * FROM notes"),
    "processed_ids_distinct": _with(
        "resume_log", "SELECT DISTINCT trim(line) AS id FROM resume_log WHERE trim(line) <> ''"
    ),
    "union_shards": _with(
        "answered_notes",
        f"""+{ANSWERS}
        SELECT ord, id, CAST(CASE WHEN class IN (0, 1, 2) THEN n WHEN class = 3 THEN 5
                                  WHEN class = 7 THEN 62 END AS BIGINT) AS age,
               class IN (0, 1, 2, 3, 7, 8) AS extraction_ok,
               CASE WHEN class IN (4, 5, 6, 9) THEN raw_output END AS model_output_raw
        FROM answered_notes JOIN answers USING (ord) WHERE {VALID}""",
    ),
    "valid_notes": _with("notes", f"SELECT * FROM notes WHERE {VALID}"),
    "valid_notes_bench": _with(
        "notes",
        """SELECT ord, CASE WHEN id IS NULL OR id = '' THEN 'row-' || ord ELSE id END AS id
           FROM notes WHERE note IS NOT NULL""",
    ),
    "shard_filter": _with("notes", f"SELECT ord, id FROM notes WHERE {VALID} AND {SHARD} = 3"),
    "shard_counts": _with(
        "notes", f"SELECT {SHARD} AS shard, count(*) AS n FROM notes WHERE {VALID} GROUP BY 1"
    ),
    "id_family_filter": _with("notes", f"+{FAMILY} SELECT ord, id, num FROM family"),
    "note_by_id": _with("notes", "SELECT * FROM notes WHERE id = 'usmle-16' ORDER BY ord LIMIT 1"),
    "nonblank_notes": _with(
        "notes", f"SELECT ord, id FROM notes WHERE regexp_matches(note, '[^{SPACES}]')"
    ),
    "failed_extractions": _with(
        "replies", "SELECT ord, raw_output FROM replies WHERE ord % 10 IN (4, 5, 6, 9)"
    ),
    "text_match_first": _with(
        "notes qbank",
        f"""+{FAMILY},{BANK}
        SELECT ord, id, first_idx AS bank_row, coalesce(n_candidates, 0) AS n_candidates
        FROM family LEFT JOIN cands ON note = question""",
    ),
    "resume_anti_join": _with(
        "notes resume_log",
        f"""SELECT * FROM notes
            WHERE {VALID} AND id NOT IN (SELECT trim(line) FROM resume_log)""",
    ),
    "resume_clustered": _with(
        "notes resume_log",
        f"""SELECT * FROM notes
            WHERE {VALID} AND id NOT IN (SELECT trim(line) FROM resume_log)""",
    ),
    "source_url": _with(
        "notes lookup_entries",
        f"""+{LOOKUP},
        keyed AS (SELECT ord, id, lower(trim(id)) AS k FROM notes WHERE {VALID})
        SELECT ord, id, {SOURCE} AS source FROM keyed LEFT JOIN lookup ON k = key""",
    ),
    "dedup_keep_first": _with("notes", f"+{FAMILY} SELECT ord, id FROM kept"),
    "prompt_variants": _with(
        "notes",
        f"""+ prompts AS (SELECT ord, {PROMPT} AS p FROM notes WHERE {VALID})
        SELECT ord, 'words' AS tokenizer, length(p) AS n_chars, {_lines('p')} AS n_lines,
               {_words('p')} AS n_tokens FROM prompts
        UNION ALL
        SELECT ord, 'four_chars', length(p), {_lines('p')}, CAST(ceil(length(p) / 4.0) AS BIGINT)
        FROM prompts""",
    ),
    "duplicate_groups": _with(
        "notes",
        f"""+{FAMILY}
        SELECT sha256(note) AS text_key, id AS first_id, n_ids, note FROM family
        WHERE rn = 1 AND n_ids > 1""",
    ),
    "duplicate_members": _with(
        "notes",
        f"""+{FAMILY}
        SELECT sha256(note) AS text_key, ord // 16384 AS piece, string_agg(id, ',' ORDER BY ord) AS ids
        FROM family WHERE n_ids > 1 GROUP BY 1, 2""",
    ),
    "dropped_duplicates": _with("notes", f"+{FAMILY} SELECT ord, id FROM family WHERE rn > 1"),
    "qbank_candidates": _with(
        "qbank",
        f"""+{BANK}
        SELECT sha256(question) AS text_key, ord // 16384 AS piece,
               string_agg(idx, ',' ORDER BY ord) AS candidates
        FROM bank GROUP BY 1, 2""",
    ),
    "shift_histogram": _with(
        "notes qbank",
        f"""+{MATCHED}
        SELECT num - first_idx AS shift, count(*) AS n FROM matched WHERE n_candidates > 0 GROUP BY 1""",
    ),
    "constant_shift": _with(
        "notes qbank",
        f"""+{MATCHED}
        SELECT CASE WHEN count(DISTINCT num - first_idx) = 1 THEN min(num - first_idx) END AS shift
        FROM matched WHERE n_candidates > 0""",
    ),
    "mapping_summary": _with(
        "notes qbank",
        f"""+{MATCHED}
        SELECT (SELECT count(*) FROM notes) AS notes_total, (SELECT count(*) FROM qbank) AS bank_total,
               (SELECT count(*) FROM qbank) - (SELECT count(*) FROM bank) AS bank_missing_fields,
               count(*) AS family_rows, count(*) FILTER (WHERE n_candidates > 0) AS matched,
               count(*) FILTER (WHERE n_candidates > 1) AS ambiguous,
               count(*) FILTER (WHERE n_candidates = 0) AS missing,
               CASE WHEN count(DISTINCT num - first_idx) = 1 THEN min(num - first_idx) END AS shift
        FROM matched""",
    ),
    "mapping_rows": _with(
        "notes qbank",
        f"""+{MATCHED}
        SELECT id, arg_max(first_idx, ord) AS bank_row FROM matched WHERE n_candidates > 0 GROUP BY 1""",
    ),
    "ambiguous_mappings": _with(
        "notes qbank",
        f"""+{MATCHED}
        SELECT matched.id, bank.ord // 16384 AS piece, string_agg(idx, ',' ORDER BY bank.ord) AS candidates
        FROM matched JOIN bank ON note = question WHERE n_candidates > 1 GROUP BY 1, 2""",
    ),
    "missing_samples": _with(
        "notes qbank",
        f"""+{MATCHED}
        SELECT id, CASE WHEN note IS NULL THEN 'missing description' ELSE 'no matching question' END AS reason
        FROM matched WHERE n_candidates = 0 ORDER BY ord LIMIT 5""",
    ),
    "worker_metrics": _with(
        "batch_log",
        f"""+{WORKERS}
        SELECT run_tag, epoch_us(s) AS start_us, epoch_us(e) AS end_us, round(span, 6) AS duration_s,
               round(gen, 6) AS gen_time_s, seen AS notes_seen, written AS notes_written,
               skipped AS notes_skipped, failed AS notes_failed, {TOKEN_RATES},
               {_div('seen', 'span')} AS notes_per_s, {_div('i + o', 'gen')} AS total_toks_per_s,
               {_div('i', 'seen')} AS avg_input_toks_per_note,
               {_div('o', 'seen')} AS avg_output_toks_per_note
        FROM timed""",
    ),
    "replica_metrics": REPLICAS,
    "metrics_roundtrip": REPLICAS,
    "bench_metrics": _with(
        "batch_log",
        f"""+{WORKERS}
        SELECT run_tag, epoch_us(s) AS start_us, epoch_us(e) AS end_us, round(span, 6) AS total_time_s,
               round(gen, 6) AS gen_time_s, written AS notes, batches, {TOKEN_RATES},
               {_div('written', 'span')} AS notes_per_s, {_div('i + o', 'gen')} AS total_toks_per_s,
               {_div('i', 'written')} AS avg_input_toks_per_note,
               {_div('o', 'written')} AS avg_output_toks_per_note
        FROM timed""",
    ),
    "bench_replica_metrics": _with(
        "batch_log",
        f"""+{WORKERS},{MERGED}
        SELECT replicas, epoch_us(s) AS start_us, epoch_us(e) AS end_us, round(wall, 6) AS wall_time_s,
               round(gen, 6) AS gen_time_s, w AS notes, b AS batches, {TOKEN_RATES},
               {_div('w', 'wall')} AS notes_per_s, {_div('i + o', 'wall')} AS total_toks_per_s
        FROM merged""",
    ),
    "limit_notes": _with("notes", f"SELECT ord, id FROM notes WHERE {VALID} ORDER BY ord LIMIT 500"),
    "limit_per_shard": _with(
        "notes",
        f"""+ sharded AS (SELECT {SHARD} AS shard, ord, id FROM notes WHERE {VALID})
        SELECT * FROM sharded QUALIFY row_number() OVER (PARTITION BY shard ORDER BY ord) <= 40""",
    ),
    "sample_note": _with(
        "notes",
        f"""SELECT * FROM notes WHERE regexp_matches(note, '[^{SPACES}]')
            ORDER BY md5('17:' || coalesce(id, '')), ord LIMIT 1""",
    ),
    "json_salvage": _parsed_fields("0, 1, 2, 6"),
    "structured_parse": _parsed_fields("0, 1, 2"),
    "conform_record": _with(
        "notes",
        f"""+{ANSWERS},
        f AS (SELECT ord, {_fields('0, 1, 2, 6')} FROM answers WHERE class NOT IN (4, 5, 9))
        SELECT ord, age, sex, {CONFORMED} FROM f""",
    ),
    "enriched_records": _with(
        "answered_notes lookup_entries",
        f"""+{ANSWERS},{LOOKUP},
        f AS (
          SELECT id, note, raw_output, lower(trim(id)) AS k, class IN (0, 1, 2, 3, 7, 8) AS ok,
                 {_fields('0, 1, 2')}
          FROM answered_notes JOIN answers USING (ord) WHERE {VALID}
        ),
        c AS (SELECT *, {CONFORMED} FROM f)
        SELECT id, note AS patient_note, {SOURCE} AS source, age, sex, chief_complaint,
               CASE WHEN ok THEN conditions END AS conditions,
               CASE WHEN ok THEN specialties END AS specialties, ok AS extraction_ok,
               CASE WHEN NOT ok THEN raw_output END AS model_output_raw
        FROM c LEFT JOIN lookup ON k = key""",
    ),
    "render_prompt": _with("notes", f"SELECT ord, {PROMPT} AS prompt FROM notes WHERE {VALID}"),
    "prompt_stats": _with(
        "notes",
        f"""+ prompts AS (SELECT ord, {PROMPT} AS p FROM notes WHERE {VALID})
        SELECT ord, length(p) AS n_chars, {_lines('p')} AS n_lines, {_words('p')} AS n_tokens
        FROM prompts""",
    ),
    "token_counts": _with(
        "answered_notes",
        f"""SELECT ord, {_words('note')} AS input_tokens, {_words('raw_output')} AS output_tokens
            FROM answered_notes WHERE {VALID}""",
    ),
    "batch_generate": _with(
        "notes",
        f"""SELECT ord, '{{"age":' || length(note) || '}}' AS raw_output, length(note) AS output_tokens
            FROM notes WHERE {VALID}""",
    ),
    "resume_two_runs": _with(
        "answered_notes lookup_entries",
        f"""+{ANSWERS},{LOOKUP},
        f AS (
          SELECT ord, id, lower(trim(id)) AS k, class IN (0, 1, 2, 3, 7, 8) AS extraction_ok,
                 {_fields('0, 1, 2')}
          FROM answered_notes JOIN answers USING (ord) WHERE {VALID}
        )
        SELECT ord, id, {SOURCE} AS source, age, extraction_ok FROM f LEFT JOIN lookup ON k = key""",
    ),
    "capped_parquet": _with(
        "notes",
        """+sized AS (
          SELECT ord, 8 + coalesce(strlen(id), 0) + coalesce(strlen(note), 0) AS bytes FROM notes
        ), kinds AS (
          SELECT *, CASE WHEN bytes * 8 <= 64000 THEN 's' WHEN bytes * 2 <= 64000 THEN 'm' ELSE 'l' END AS kind
          FROM sized
        ), summed AS (
          SELECT *, sum(bytes) OVER (PARTITION BY kind ORDER BY ord) - bytes AS begun,
                 max(bytes) OVER (PARTITION BY kind) AS most FROM kinds
        ), binned AS (
          SELECT *, CASE kind WHEN 's' THEN begun // (64000 - most) WHEN 'm' THEN begun // 32000 ELSE begun END AS bin
          FROM summed
        )
        SELECT kind || lpad(bin::BIGINT::VARCHAR, 15, '0') AS shard, 1::BIGINT AS n_files, count(*) AS n_records,
               sum(bytes)::BIGINT AS n_bytes, min(ord) AS first_ord, max(ord) AS last_ord, false AS above_cap
        FROM binned GROUP BY kind, bin""",
    ),
    "rolled_shards": _with(
        "notes",
        """+worker AS (
          SELECT *, 'part_w1' AS prefix, 1 AS run FROM notes WHERE ord % 2 = 1
          UNION ALL SELECT *, 'part_w0', 1 FROM notes WHERE ord % 4 = 0
          UNION ALL SELECT *, 'part_w0', 2 FROM notes WHERE ord % 4 = 2 AND id IS NOT NULL
            AND id NOT IN (SELECT trim(id) FROM notes WHERE (ord % 4 = 0 OR ord % 2 = 1) AND trim(id) <> '')
          UNION ALL SELECT *, 'part_w0', 2 FROM notes WHERE ord % 4 = 0 AND id IS NOT NULL
            AND id NOT IN (SELECT trim(id) FROM notes WHERE (ord % 4 = 0 OR ord % 2 = 1) AND trim(id) <> '')
        ), placed AS (
          SELECT *, (row_number() OVER (PARTITION BY prefix, run ORDER BY ord) - 1) // 150 AS k FROM worker
        ), starts AS (
          SELECT prefix, max(k) + 1 AS start FROM placed WHERE run = 1 GROUP BY prefix
        )
        SELECT prefix || '_' || lpad((k + CASE WHEN run = 2 THEN start ELSE 0 END)::VARCHAR, 5, '0') AS shard,
               count(*) AS n_records, min(ord) AS first_ord, max(ord) AS last_ord,
               sum(length(coalesce(note, '')))::BIGINT AS n_chars, count(id) AS n_ids
        FROM placed JOIN starts USING (prefix) GROUP BY 1""",
    ),
    "stateful_json_runs": _with(
        "notes",
        f"""+{ARRIVED} SELECT id, length(note) AS n_chars, length(note) % 7 > 0 AS extraction_ok FROM fresh""",
    ),
    "stream_metrics": _with(
        "notes",
        rf"""+{ARRIVED},
        counts AS (SELECT run_tag, count(*) AS n, count(*) FILTER (WHERE length(note) % 7 = 0) AS failed,
                          sum(len(list_filter(string_split_regex(note, '\s+'), lambda w: w <> ''))) AS words
                   FROM fresh GROUP BY 1),
        came AS (SELECT run_tag, count(*) AS seen FROM valid GROUP BY 1)
        SELECT run_tag, seen AS notes_seen, n AS notes_written, seen - n AS notes_skipped, failed AS notes_failed,
               words::BIGINT AS input_tokens, n AS output_tokens FROM came JOIN counts USING (run_tag)""",
    ),
    # Classes that salvage reads: 0, 1, 2, 6 with all keys but the chief complaint, 3 with age and
    # conditions, 7 with a text age and conditions that are no list, 8 empty.
    "conformance_audit": _with(
        "notes",
        f"""+{ANSWERS},
        r AS (SELECT *, class IN (0, 1, 2, 6) AS whole FROM answers WHERE class NOT IN (4, 5, 9)),
        t AS (
          SELECT count(*) AS n_records, count(*) FILTER (WHERE class = 7) AS c7,
                 count(*) FILTER (WHERE class = 8) AS c8, count(*) FILTER (WHERE whole) AS cw,
                 count(*) FILTER (WHERE whole AND st = 'maybe') AS maybe
          FROM r
        )
        SELECT 'age' AS field, 'scalar' AS kind, n_records, c8 AS n_missing, c7 AS n_type_mismatch,
               CAST(0 AS BIGINT) AS n_out_of_enum, CAST(0 AS BIGINT) AS n_over_limit FROM t
        UNION ALL SELECT 'sex', 'scalar', n_records, n_records - cw, 0, 0, 0 FROM t
        UNION ALL SELECT 'chief_complaint', 'scalar', n_records, n_records, 0, 0, 0 FROM t
        UNION ALL SELECT 'conditions', 'object_list', n_records, c8, c7, maybe, 0 FROM t
        UNION ALL SELECT 'specialties', 'scalar_list', n_records, n_records - cw, 0, 0, 0 FROM t""",
    ),
    "explode_conditions": _with(
        "notes",
        f"""+{ANSWERS},
        f AS (SELECT ord, {_fields('0, 1, 2, 6')} FROM answers WHERE class NOT IN (4, 5, 9))
        SELECT ord, CAST(CASE WHEN condition IS NOT NULL THEN 0 END AS INTEGER) AS pos,
               condition AS name, status FROM f""",
    ),
    "facet_counts": _with(
        "notes",
        f"""+{ANSWERS},
        f AS (SELECT ord, {_fields('0, 1, 2, 6')} FROM answers WHERE class NOT IN (4, 5, 9))
        SELECT 'sex' AS facet, sex AS value, count(*) AS n FROM f WHERE sex IS NOT NULL GROUP BY 2
        UNION ALL
        SELECT 'conditions.status', status, count(*) FROM f WHERE status IS NOT NULL GROUP BY 2
        UNION ALL
        SELECT 'specialties', 'other', count(*) FROM f WHERE sex IS NOT NULL HAVING count(*) > 0""",
    ),
    "facet_filter": _with("notes", f"+{WANTED} SELECT ord FROM wanted"),
    "facet_bitmap_filter": _with("notes", f"+{WANTED} SELECT ord FROM wanted"),
    "facet_drill_down": _with(
        "notes",
        f"""+{WANTED}
        SELECT 'sex' AS facet, sex AS value, count(*) AS n FROM wanted GROUP BY 2
        UNION ALL SELECT 'conditions.status', status, count(*) FROM wanted GROUP BY 2
        UNION ALL SELECT 'specialties', 'other', count(*) FROM wanted HAVING count(*) > 0""",
    ),
    "sketched_quantiles": _with(
        "notes",
        """SELECT share::DOUBLE AS share, (SELECT count(note) FROM notes) AS n, true AS within_error
           FROM (VALUES (0.1), (0.5), (0.9)) AS v(share)""",
    ),
    "sketched_ids": _with("notes", "SELECT count(DISTINCT id) AS n_distinct, true AS within_error FROM notes"),
    "sketched_values": _with(
        "notes",
        f"""+{ANSWERS},
        f AS (SELECT ord, {_fields('0, 1, 2, 6')} FROM answers WHERE class NOT IN (4, 5, 9))
        SELECT status AS value, count(*) AS n FROM f
        WHERE status NOT IN ('present', 'negated', 'uncertain', 'historical') GROUP BY 1""",
    ),
}
