"""The same results in DuckDB SQL, one text per query."""

from __future__ import annotations

from checks.fixtures import DEEP_LINES, FULL_LINES, ITEM_LINES, PEOPLE_LINES, SAME_NAME_LINES
from lacuna.operators.profile import VALUE_FIELDS
from lacuna.plans.layouts import NARROW, NARROW_STRINGS, WIDE

# json_valid is asked in its own step, so that no JSON function sees a bad line.
_PEOPLE = f"""WITH lines AS ({PEOPLE_LINES}),
valid AS MATERIALIZED (SELECT *, json_type(value) AS kind FROM (
  SELECT line_no, file_name, CASE WHEN json_valid(value) THEN value END AS value FROM lines)
  WHERE value IS NOT NULL),
objects AS MATERIALIZED (SELECT line_no, file_name, value FROM valid WHERE kind = 'OBJECT')
"""
_FULL = _PEOPLE.replace(PEOPLE_LINES, FULL_LINES)
_ITEMS = _PEOPLE.replace(PEOPLE_LINES, ITEM_LINES)
_SAME_NAME = _PEOPLE.replace(PEOPLE_LINES, SAME_NAME_LINES)
_EVENTS = f"""WITH objects AS (
  SELECT event_type AS file_name, props AS value FROM events WHERE json_type(props) = 'OBJECT')
"""


def _path(key: str) -> str:
    return f"""'$."{key}"'"""


def _string(key: str, value: str = "value") -> str:
    return f"""CASE WHEN json_type({value}, {_path(key)}) = 'VARCHAR'
        THEN json_extract_string({value}, {_path(key)}) END"""


def _int32(key: str) -> str:
    number = f"CAST(json_extract_string(value, {_path(key)}) AS HUGEINT)"
    return f"""CASE WHEN json_type(value, {_path(key)}) IN ('BIGINT', 'UBIGINT')
        AND {number} <= 9223372036854775807
        THEN CAST(((({number} + 2147483648) % 4294967296 + 4294967296) % 4294967296)
          - 2147483648 AS INTEGER) END"""


def _json(key: str) -> str:
    return f"CAST(json_extract(value, {_path(key)}) AS VARCHAR)"


_KINDS = {
    "": _string,
    "i": _int32,
    "j": _json,
    "d": lambda key: f"CAST({_string(key)} AS DATE)",
}


def _columns(layout: list[str]) -> str:
    parts = [column.partition(":") for column in layout]
    return ", ".join(f'{_KINDS[kind](name)} AS "{name}"' for name, _, kind in parts)


def _at_once(layout: list[str]) -> str:
    """The columns of a layout, with all members of a line extracted in one go."""
    parts = [column.partition(":") for column in layout]
    paths = ", ".join(_path(key) for key, *_ in parts)
    number = "CAST(CAST(m[{i}] AS VARCHAR) AS HUGEINT)"
    kinds = {
        "": "CASE WHEN json_type(m[{i}]) = 'VARCHAR' THEN json_extract_string(m[{i}], '$') END",
        "i": f"""CASE WHEN json_type(m[{{i}}]) IN ('BIGINT', 'UBIGINT')
          THEN CAST((({number} + 2147483648) % 4294967296) - 2147483648 AS INTEGER) END""",
        "j": "CAST(m[{i}] AS VARCHAR)",
    }
    columns = [
        f"{kinds[kind].format(i=i)} AS {key}" for i, (key, _, kind) in enumerate(parts, start=1)
    ]
    return f"""SELECT line_no, {", ".join(columns)}
      FROM (SELECT line_no, json_extract(value, [{paths}]) AS m FROM objects)"""


def _prune_step(text: str) -> str:
    """One level: drop members and elements that are null, "", [] or {}.

    The fixture's strings hold no quotes or brackets next to such tokens.
    """
    void = r'(?:null|""|\[\]|\{\})'
    text = rf"""regexp_replace({text}, '"[^"]*":{void}(,|\}})', '\1', 'g')"""
    for _ in range(2):  # neighbours share a comma
        text = rf"""regexp_replace({text}, '([\[,]){void}([,\]])', '\1\2', 'g')"""
    text = rf"""regexp_replace({text}, '([\[\{{,]),+', '\1', 'g')"""
    return rf"""regexp_replace({text}, ',([\]\}}])', '\1', 'g')"""


def _pruned(text: str) -> str:
    """Six levels, folded over a list so that the SQL stays short."""
    return f"""list_reduce([{text}, '', '', '', '', '', ''], lambda t, i: {_prune_step("t")})"""


def _cleaned(source: str) -> str:
    """line_no, cleaned: members pruned one by one, then put together by key."""
    return f"""{source}, members AS (
      SELECT o.line_no, j.key, {_pruned("CAST(j.value AS VARCHAR)")} AS left_over
      FROM objects o, json_each(o.value) j),
    joined AS (
      SELECT line_no, concat('{{', string_agg('"' || key || '":' || left_over, ',' ORDER BY key), '}}')
        AS cleaned
      FROM members WHERE left_over NOT IN ('null', '""', '[]', '{{}}') GROUP BY line_no),
    others AS (
      SELECT line_no, {_pruned("value")} AS cleaned FROM valid WHERE kind <> 'OBJECT'),
    cleaned AS (
      SELECT o.line_no, joined.cleaned FROM objects o LEFT JOIN joined USING (line_no)
      UNION ALL
      SELECT line_no, CASE WHEN cleaned NOT IN ('null', '""', '[]', '{{}}') THEN cleaned END FROM others)
    """


def _removed(source: str) -> str:
    """line_no, file_name, removed: void nodes of the tree, by their parent."""
    return f"""{source}, nodes AS (
      SELECT v.line_no, t.id, t.parent, t.type, t.atom, CAST(t.value AS VARCHAR) AS text
      FROM valid v, json_tree(v.value) t),
    removed AS (
      SELECT n.line_no, count(*) AS removed FROM nodes n
      LEFT JOIN nodes p ON p.line_no = n.line_no AND p.id = n.parent
      WHERE n.type = 'NULL' OR (n.type = 'VARCHAR' AND n.text = '""')
        OR (n.type = 'ARRAY' AND n.text = '[]')
        OR (n.type = 'OBJECT' AND n.text = '{{}}' AND p.type = 'OBJECT')
      GROUP BY n.line_no),
    counted AS (
      SELECT v.line_no, v.file_name, coalesce(r.removed, 0) AS removed
      FROM valid v LEFT JOIN removed r USING (line_no))
    """


def _fields(source: str) -> str:
    return f"""{source}, fields AS (
      SELECT o.file_name, j.key AS field, j.type AS kind,
        CASE WHEN j.type = 'NULL' THEN 1 ELSE 0 END AS is_null,
        CASE WHEN CAST(j.value AS VARCHAR) IN ('[]', '{{}}') THEN 1 ELSE 0 END AS is_empty
      FROM objects o, json_each(o.value) j)
    """


def _by_field(source: str) -> str:
    return f"""{_fields(source)} SELECT field, count(*) AS present,
      CAST(sum(is_null) AS BIGINT) AS "null", CAST(sum(is_empty) AS BIGINT) AS empty,
      CAST(count(*) - sum(is_null) - sum(is_empty) AS BIGINT) AS non_empty
    FROM fields GROUP BY field"""


_AVERAGES = """*, total_fields / nullif(objects, 0) AS avg_fields,
      null_or_empty / nullif(objects, 0) AS avg_null_or_empty,
      null_or_empty / nullif(total_fields, 0) * 100 AS null_or_empty_pct"""


def _by_file(source: str) -> str:
    return f"""{_fields(source)}, per_file AS (
      SELECT file_name, count(*) AS objects FROM objects GROUP BY file_name),
    sums AS (
      SELECT file_name, count(*) AS total_fields,
        CAST(sum(is_null + is_empty) AS BIGINT) AS null_or_empty
      FROM fields GROUP BY file_name)
    SELECT {_AVERAGES} FROM (
      SELECT file_name, coalesce(objects, 0) AS objects, coalesce(total_fields, 0) AS total_fields,
        coalesce(null_or_empty, 0) AS null_or_empty
      FROM (SELECT DISTINCT file_name FROM lines)
      LEFT JOIN per_file USING (file_name) LEFT JOIN sums USING (file_name))"""


def _counts(source: str, fields=VALUE_FIELDS) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{f}' AS field, {_string(f)} AS value FROM objects" for f in fields
    )
    return f"""{source}, counts AS (
      SELECT field, value, count(*) AS count FROM ({rows}) WHERE value IS NOT NULL
      GROUP BY field, value)"""


_PHONE = r"""(coalesce(regexp_matches({mobile}, '\S'), false)
  OR (json_type(value, '$.phone_numbers') = 'ARRAY' AND EXISTS (
    SELECT 1 FROM (SELECT unnest(json_extract(value, '$.phone_numbers[*]')) AS p)
    WHERE json_type(p) = 'VARCHAR' AND regexp_matches(json_extract_string(p, '$'), '\S'))))""".replace(
    "{mobile}", _string("mobile_phone")
)
_ADDRESS = """SELECT line_no, value, e FROM (
    SELECT line_no, value, unnest(json_extract(value, '$.emails[*]')) AS e FROM objects
    WHERE json_type(value, '$.emails') = 'ARRAY')"""


def _document() -> str:
    quoted = "CAST(to_json({}) AS VARCHAR)"
    return f"""{_counts(_PEOPLE)} SELECT field, value, concat(
      CASE WHEN row_number() OVER (ORDER BY field, value) = 1 THEN '{{' || chr(10) ELSE '' END,
      CASE WHEN row_number() OVER (PARTITION BY field ORDER BY value) = 1
        THEN '  ' || {quoted.format("field")} || ': {{' || chr(10) ELSE '' END,
      '    ', {quoted.format("value")}, ': ', CAST(count AS VARCHAR),
      CASE WHEN row_number() OVER (PARTITION BY field ORDER BY value DESC) > 1 THEN ','
        WHEN row_number() OVER (ORDER BY field DESC, value DESC) = 1
        THEN chr(10) || '  }}' || chr(10) || '}}' ELSE chr(10) || '  }},' END) AS text
    FROM counts"""


_STATUS = """SELECT CAST(json_extract(value, '$.status') AS VARCHAR) AS status, count(*) AS count
  FROM objects WHERE json_type(value, '$.status') NOT IN ('NULL', 'ARRAY', 'OBJECT') GROUP BY 1"""

_CLEAN_REPORT = """SELECT file_name, count(c.line_no) AS rows_processed,
  CAST(coalesce(sum(removed), 0) AS BIGINT) AS fields_removed
  FROM lines LEFT JOIN counted c USING (line_no, file_name) GROUP BY file_name"""

_JUDGED = f"""WITH lines AS ({DEEP_LINES}), judged AS (
    SELECT line_no, file_name, CASE line_no % 97 WHEN 10 THEN 'too_deep' WHEN 11 THEN NULL WHEN 12 THEN 'too_deep'
      ELSE CASE WHEN NOT json_valid(value) THEN 'bad_json'
        WHEN json_type(CASE WHEN json_valid(value) THEN value END) <> 'OBJECT' THEN 'not_object' END END AS reason
    FROM lines WHERE length(trim(value)) > 0)
  """
_REASONS = ", ".join(
    f"count(*) FILTER (WHERE reason = '{r}') AS {r}" for r in ("bad_utf8", "bad_json", "too_deep", "not_object")
)


def _totals(report: str, counters: tuple[str, ...]) -> str:
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in counters)
    return f"""SELECT file_name, grouping(file_name) = 1 AS total, count(*) AS files, {sums}
      FROM ({report}) GROUP BY ROLLUP (file_name)"""


ORACLES: dict[str, str] = {
    "scan_lines": _PEOPLE + "SELECT file_name, value FROM lines",
    "file_rowcount": _PEOPLE + "SELECT file_name, count(*) AS lines FROM lines GROUP BY file_name",
    "nonblank_lines": _PEOPLE + "SELECT line_no, value FROM lines WHERE length(trim(value)) > 0",
    "parse_valid": _PEOPLE + "SELECT line_no, file_name FROM valid",
    "parse_objects": _PEOPLE
    + "SELECT line_no, CAST(len(json_keys(value)) AS BIGINT) AS fields FROM objects",
    "project_wide": _PEOPLE + f"SELECT line_no, {_columns(WIDE)} FROM objects",
    "project_wide_full": _FULL + _at_once(WIDE),
    "project_narrow": _PEOPLE + f"SELECT line_no, {_columns(NARROW)} FROM objects",
    "project_narrow_str": _PEOPLE + f"SELECT line_no, {_columns(NARROW_STRINGS)} FROM objects",
    "project_documents": "SELECT doc_id, text, lang, source, CAST(n_chars AS INTEGER) AS n_chars FROM documents",
    "get_string": _PEOPLE
    + "SELECT line_no, "
    + _columns(["gender", "birth_year", "mobile_phone", "phone_numbers", "status"])
    + " FROM objects",
    "get_int32": _PEOPLE
    + f"SELECT line_no, {_columns(['birth_year:i', 'mobile_phone:i', 'status:i'])} FROM objects",
    "get_json_text": _PEOPLE
    + "SELECT line_no, "
    + _columns(["gender:j", "phone_numbers:j", "emails:j", "skills:j", "experience:j", "version_status:j"])
    + " FROM objects",
    "cast_date": _PEOPLE
    + f"""SELECT line_no, TRY_CAST({_string("job_last_updated")} AS DATE) AS job_last_updated,
      TRY_CAST({_string("gender")} AS DATE) AS gender FROM objects""",
    "clean_records": _cleaned(_PEOPLE) + "SELECT line_no, cleaned FROM cleaned",
    "clean_records_full": _cleaned(_FULL) + "SELECT line_no, cleaned FROM cleaned",
    "clean_known": _cleaned(_PEOPLE) + "SELECT line_no, cleaned FROM cleaned",
    "count_removed_known": _removed(_PEOPLE) + "SELECT line_no, removed FROM counted",
    "clean_known_items": _removed(_cleaned(_ITEMS))
    + "SELECT line_no, cleaned, removed FROM cleaned JOIN counted USING (line_no)",
    "drop_empty_records": _cleaned(_PEOPLE) + "SELECT line_no FROM cleaned WHERE cleaned IS NOT NULL",
    "clean_gz_roundtrip": _cleaned(_PEOPLE)
    + "SELECT file_name, cleaned AS value FROM cleaned JOIN lines USING (line_no) WHERE cleaned IS NOT NULL",
    "clean_pages": "SELECT page_id, nullif(url, '') AS url, nullif(html, '') AS html FROM pages",
    "count_removed": _removed(_PEOPLE) + "SELECT line_no, removed FROM counted",
    "count_removed_full": _removed(_FULL) + "SELECT line_no, removed FROM counted",
    "clean_report": _removed(_PEOPLE) + _CLEAN_REPORT,
    "clean_job": _removed(_FULL) + _CLEAN_REPORT,
    "clean_job_people": _removed(_PEOPLE) + _CLEAN_REPORT,
    "filter_has_phone": _PEOPLE + f"SELECT line_no, value FROM objects WHERE {_PHONE}",
    "filter_has_phone_roundtrip": _PEOPLE + f"SELECT value FROM objects WHERE {_PHONE}",
    "phone_match_rate": _PEOPLE
    + f"""SELECT (SELECT count(*) FROM objects WHERE {_PHONE}) AS matched,
      (SELECT count(*) FROM lines WHERE value <> '') AS total""",
    "filter_email_domain": _PEOPLE
    + f"""SELECT DISTINCT line_no, value FROM ({_ADDRESS})
      WHERE json_type(e, '$.address') = 'VARCHAR'
        AND ends_with(json_extract_string(e, '$.address'), '@google.com')""",
    "filter_skills": _PEOPLE
    + """SELECT line_no, value FROM objects WHERE json_type(value, '$.skills') = 'ARRAY'
      AND list_contains(json_extract_string(value, '$.skills[*]'), 'rust')""",
    "extract_emails": _PEOPLE
    + f"""SELECT line_no, json_extract_string(e, '$.address') AS address FROM ({_ADDRESS})
      WHERE json_type(e, '$.address') = 'VARCHAR'""",
    "profile_fields": _by_field(_PEOPLE),
    "profile_fields_full": _by_field(_FULL),
    "profile_fields_events": _by_field(_EVENTS),
    "value_counts_events": _EVENTS + _STATUS.replace("$.status", "$.k"),
    "profile_by_file": _by_file(_PEOPLE),
    "profile_by_file_full": _by_file(_FULL),
    "profile_overall": f"""SELECT {_AVERAGES} FROM (
      SELECT count(*) AS files, CAST(sum(objects) AS BIGINT) AS objects,
        CAST(sum(total_fields) AS BIGINT) AS total_fields,
        CAST(sum(null_or_empty) AS BIGINT) AS null_or_empty FROM ({_by_file(_PEOPLE)}))""",
    "value_counts": _counts(_PEOPLE) + " SELECT * FROM counts",
    "value_counts_full": _counts(_FULL) + " SELECT * FROM counts",
    "profile_facts_by_value": _counts(_PEOPLE) + " SELECT * FROM counts",
    "value_counts_nested": _PEOPLE
    + """SELECT 'version_status.status' AS field,
        json_extract_string(value, '$.version_status.status') AS value, count(*) AS count
      FROM objects WHERE json_type(value, '$.version_status.status') = 'VARCHAR' GROUP BY ALL""",
    "value_distribution_json": _document(),
    "status_counts": _PEOPLE + _STATUS,
    "convert_report": _PEOPLE
    + """SELECT file_name, count(objects.line_no) AS rows
      FROM lines LEFT JOIN objects USING (line_no, file_name) GROUP BY file_name""",
    "wide_parquet_roundtrip": _PEOPLE + f"SELECT file_name, {_columns(WIDE)} FROM objects",
    "narrow_parquet_roundtrip": _PEOPLE + f"SELECT {_columns(NARROW)} FROM objects",
    "narrow_str_parquet_roundtrip": _PEOPLE + f"SELECT {_columns(NARROW_STRINGS)} FROM objects",
    "file_status": _PEOPLE
    + """SELECT DISTINCT file_name, true AS success FROM lines
      UNION ALL SELECT 'missing', false""",
    "same_name_scan": _SAME_NAME + "SELECT file_name, value FROM lines",
    "same_name_profile": _by_file(_SAME_NAME),
    "same_name_overall": f"""SELECT {_AVERAGES} FROM (
      SELECT count(*) AS files, CAST(sum(objects) AS BIGINT) AS objects,
        CAST(sum(total_fields) AS BIGINT) AS total_fields,
        CAST(sum(null_or_empty) AS BIGINT) AS null_or_empty FROM ({_by_file(_SAME_NAME)}))""",
    "same_name_clean": _cleaned(_SAME_NAME)
    + "SELECT file_name, cleaned AS value FROM cleaned JOIN lines USING (line_no) WHERE cleaned IS NOT NULL",
    "same_name_convert": _SAME_NAME
    + """SELECT replace(file_name, '.gz', '.parquet') AS file_name, count(*) AS rows
      FROM objects GROUP BY file_name""",
    "clean_report_totals": _totals(_removed(_PEOPLE) + _CLEAN_REPORT, ("rows_processed", "fields_removed")),
    "convert_report_totals": _totals(
        _PEOPLE
        + """SELECT concat(file_name, '.parquet') AS file_name, count(objects.line_no) AS rows
          FROM lines LEFT JOIN objects USING (line_no, file_name) GROUP BY file_name""",
        ("rows",),
    ),
    "file_status_totals": _PEOPLE
    + "SELECT count(DISTINCT file_name) AS successful, CAST(1 AS BIGINT) AS failed FROM lines",
    "rejected_lines": _JUDGED + "SELECT line_no, reason FROM judged WHERE reason IS NOT NULL",
    "rejected_values": _JUDGED
    + "SELECT line_no, reason FROM judged WHERE reason IS NOT NULL AND reason <> 'not_object'",
    "reject_report": _JUDGED
    + f"""SELECT file_name, count(*) AS lines, count(*) FILTER (WHERE reason IS NULL) AS kept,
      count(reason) AS rejected, {_REASONS} FROM judged GROUP BY file_name""",
    "clean_job_rejects": _JUDGED
    + """SELECT file_name, count(j.line_no) FILTER (WHERE coalesce(reason, 'not_object') = 'not_object') AS rows_processed,
        count(j.line_no) FILTER (WHERE reason <> 'not_object') AS rejected
      FROM lines LEFT JOIN judged j USING (line_no, file_name) GROUP BY file_name""",
    "convert_job_rejects": _JUDGED
    + "SELECT file_name, reason, count(*) AS count FROM judged WHERE reason IS NOT NULL GROUP BY file_name, reason",
    "incremental_ingest": _PEOPLE + f"SELECT {_columns(NARROW_STRINGS)} FROM objects",
    "incremental_profile": _by_field(_PEOPLE),
    "incremental_compacted": _by_field(_PEOPLE),
    "incremental_files": _SAME_NAME
    + f"SELECT replace(file_name, '.gz', '.parquet') AS file_name, {_columns(NARROW_STRINGS)} FROM objects",
}
