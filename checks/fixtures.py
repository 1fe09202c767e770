"""JSON lines derived from the given tables.

Each text is one SELECT that Spark and DuckDB both run, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.plans.layouts import WIDE
from lacuna.scratch import new_folder
from lacuna.session import prepare
from lacuna.sinks.files import place
from lacuna.sources.ndjson import spread_lines

# One sparse line per customer; nine residues of 97 are bad or odd lines.  One file has
# nothing but bad lines, one nothing but blank ones.
PEOPLE_LINES = """
SELECT c_custkey AS line_no, concat('part-0000', CASE c_custkey % 97 WHEN 2 THEN 'bad' WHEN 6 THEN 'bad'
 WHEN 1 THEN 'blank' WHEN 8 THEN 'blank' ELSE CAST(c_custkey % 4 AS STRING) END) AS file_name,
 CASE c_custkey % 97
  WHEN 1 THEN '' WHEN 2 THEN '{"id":' WHEN 3 THEN '[1,null,"",[],{}]' WHEN 4 THEN 'null'
  WHEN 5 THEN '{}' WHEN 6 THEN '{"a":1} x'
  WHEN 7 THEN '{"a":null,"b":"","c":[],"d":{},"e":{"f":null}}'
  WHEN 8 THEN '   ' WHEN 9 THEN '{"id":"q"}] {}'
  ELSE concat('{"id":"p', CAST(c_custkey AS STRING), '","full_name":"', c_name, '"',
   ',"gender":', CASE c_custkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"male"'
     WHEN 2 THEN '"female"' ELSE '""' END,
   ',"birth_year":', CASE c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '"1980"'
     WHEN 2 THEN '1990.5' WHEN 3 THEN '3000000000'
     ELSE CAST(1950 + c_custkey % 50 AS STRING) END,
   ',"job_title":', CASE WHEN c_custkey % 3 = 0 THEN 'null'
     ELSE concat('"', lower(c_mktsegment), ' lead"') END,
   CASE WHEN c_custkey % 2 = 0
     THEN concat(',"location_country":"country ', CAST(c_nationkey AS STRING), '"') ELSE '' END,
   ',"mobile_phone":', CASE c_custkey % 6 WHEN 0 THEN 'null' WHEN 1 THEN '""'
     WHEN 2 THEN '"  "' WHEN 3 THEN '7' ELSE '"+15550100"' END,
   ',"phone_numbers":', CASE c_custkey % 7 WHEN 0 THEN 'null' WHEN 1 THEN '[]'
     WHEN 2 THEN '[""]' WHEN 3 THEN '[null,"  "]' WHEN 4 THEN '["","+15550199"]'
     WHEN 5 THEN '"n/a"' ELSE '{}' END,
   ',"emails":', CASE c_custkey % 5 WHEN 0 THEN '[]'
     WHEN 1 THEN concat('[{"address":"u', CAST(c_custkey AS STRING), '@google.com","type":null}]')
     WHEN 2 THEN '[{"address":null},{"address":"x@example.com"}]'
     WHEN 3 THEN '["a@google.com"]' ELSE 'null' END,
   ',"skills":', CASE c_custkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN '["rust","sql"]'
     ELSE '["go",""]' END,
   ',"job_last_updated":', CASE c_custkey % 4 WHEN 0 THEN 'null'
     ELSE concat('"2020-0', CAST(1 + c_custkey % 9 AS STRING), '-15"') END,
   ',"experience":', CASE c_custkey % 4
     WHEN 0 THEN '[{"company":{"name":null,"size":""},"title":""}]'
     WHEN 1 THEN '[{"company":{"name":"acme","size":""},"title":null},{}]'
     WHEN 2 THEN '[[],[null,[""]]]' ELSE 'null' END,
   ',"version_status":{"contains":[],"previous_version":"","status":"',
     CASE WHEN c_custkey % 2 = 0 THEN 'updated' ELSE 'unchanged' END, '"}',
   CASE WHEN c_custkey % 11 = 0 THEN ',"version_status.status":"literal"' ELSE '' END,
   ',"status":', CASE c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '"new"'
     WHEN 2 THEN '"active"' WHEN 3 THEN '3' ELSE 'true' END, '}') END AS value
FROM customer
"""

# The same lines in inputs of one name in three folders.
SAME_NAME_LINES = f"""
SELECT line_no, concat('day=', CAST(line_no % 3 AS STRING), '/', file_name, '.gz') AS file_name, value
FROM ({PEOPLE_LINES}) AS named
"""

# The same lines, some of them nested too deep, or as deep as is read.
DEEP_LINES = f"""
SELECT line_no, file_name, CASE line_no % 97
  WHEN 10 THEN concat(repeat('[', 2001), repeat(']', 2001))
  WHEN 11 THEN concat('{{"a":"]]]","b":', repeat('[', 1999), repeat(']', 1999), '}}')
  WHEN 12 THEN concat('{{"a":', repeat('[', 3000)) ELSE value END AS value
FROM ({PEOPLE_LINES}) AS named
"""

# A line per order, all of one shape; about a third of the members are null or empty.
ITEM_LINES = """
SELECT o_orderkey AS line_no, concat('part-0000', CAST(o_orderkey % 5 AS STRING)) AS file_name,
 concat('{"key":', CAST(o_orderkey AS STRING),
  ',"flag":', CASE WHEN o_custkey % 5 = 0 THEN 'null' ELSE concat('"', o_orderpriority, '"') END,
  ',"mode":', CASE WHEN o_orderkey % 3 = 0 THEN '""' ELSE '"m"' END,
  ',"part":{"id":', CAST(o_custkey AS STRING), ',"note":', CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE '"n"' END, '}',
  ',"supplier":', CASE o_custkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '{}' WHEN 2 THEN '{"id":null,"tags":["",null]}'
    ELSE concat('{"id":', CAST(o_custkey AS STRING), ',"tags":["a","","b"]}') END,
  ',"steps":', CASE o_orderkey % 7 WHEN 0 THEN '[]' WHEN 1 THEN '[{"at":1,"by":""},{},null]'
    ELSE '[{"at":null,"by":""},{"by":"x"}]' END, '}') AS value
FROM orders
"""
ITEM_SHAPE = """key bigint, flag string, mode string, part struct<id: bigint, note: string>,
 supplier struct<id: bigint, tags: array<string>>, steps array<struct<at: int, by: string>>"""

# Members with a shape of their own; n is a number as text, b the number itself.
_JOB = """concat('[{"company":{"founded":null,"id":"c', n, '","name":"acme, inc","size":""},',
  '"end_date":null,"location_names":[],"title":{"levels":[],"name":"lead","role":null}},',
  '{"company":null,"end_date":"","location_names":["a","b"],"title":{}}]')"""
_SHAPED = {
    "experience": _JOB,
    "education": _JOB,
    "emails": """concat('[{"address":"u', n, CASE WHEN b % 3 = 0 THEN '@google.com'
      ELSE '@example.com' END, '","type":null},{"address":null}]')""",
    "phone_numbers": """CASE WHEN b % 2 = 0 THEN '[""]' ELSE '["","+1555"]' END""",
    "skills": """CASE b % 3 WHEN 0 THEN '["rust","go"]' ELSE '["","go"]' END""",
    "version_status": """CASE WHEN b % 2 = 0
      THEN '{"contains":[],"previous_version":"","status":"updated"}'
      ELSE '{"contains":[],"previous_version":"x","status":"unchanged"}' END""",
    "gender": """CASE WHEN b % 2 = 0 THEN '"male"' ELSE '"female"' END""",
    "location_country": """concat('"country ', CAST(b % 25 AS STRING), '"')""",
    "location_continent": """concat('"continent ', CAST(b % 6 AS STRING), '"')""",
    "job_last_updated": """concat('"2020-0', CAST(1 + b % 9 AS STRING), '-15"')""",
    "summary": """concat('"says ', chr(92), '"', lower(o_orderpriority), chr(92), '" ', n, '"')""",
}


def _full_lines() -> str:
    """A line per order with all 78 fields, about 65 % of them null or empty.

    One file holds a third of the lines.
    """
    members = []
    for i, column in enumerate(WIDE):
        name, _, kind = column.partition(":")
        plain = {
            "i": "n",
            "j": f"""concat('["{name} ', n, '",null,"",{{"k":[]}}]')""",
            "": f"""concat('"{name} of somebody ', n, '"')""",
        }
        value, void = _SHAPED.get(name, plain[kind]), "'[]'" if kind == "j" else "'null'"
        members.append(
            f"""'{"," if i else "{"}"{name}":', CASE WHEN (r + {29 * i % 100}) % 100 < 60 THEN 'null'
            WHEN (r + {29 * i % 100}) % 100 < 66 THEN {void} ELSE {value} END"""
        )
    return f"""
    SELECT line_no, file_name, concat({", ".join(members)}, '}}') AS value FROM (
      SELECT line_no, file_name, o_orderpriority, b, b % 100 AS r, CAST(b % 1009 AS STRING) AS n
      FROM (SELECT o_orderkey AS line_no, o_orderpriority, o_orderkey * 7 + o_custkey * 13 AS b,
        CASE WHEN o_orderkey % 3 = 0 THEN 'part-00000'
          ELSE concat('part-0000', CAST(1 + o_orderkey % 7 AS STRING)) END AS file_name
        FROM orders) AS numbered) AS drawn"""


FULL_LINES = _full_lines()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def people_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "customer", PEOPLE_LINES)


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "orders", ITEM_LINES)


def same_name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "customer", SAME_NAME_LINES)


def deep_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "customer", DEEP_LINES)


def full_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows of a few bytes become lines of 2,000: a small table would give one task
    # far too much text, so its rows are spread before they grow.
    return _derive(spark, sf_dir, "orders", FULL_LINES, spread=True)


def _derive(
    spark: SparkSession, sf_dir: str, name: str, text: str, spread: bool = False
) -> DataFrame:
    view = f"lacuna_{name}"
    rows = table(spark, sf_dir, name)
    if spread and len(rows.inputFiles()) < spark.sparkContext.defaultParallelism:
        rows = spread_lines(rows)
    rows.createOrReplaceTempView(view)
    lines = spark.sql(text.replace(f"FROM {name}", f"FROM {view}"))
    # The explode makes the long text a column of its own, as it is after a scan;
    # otherwise every use of the column would derive it again.
    return lines.select("line_no", "file_name", F.explode(F.array("value")).alias("value"))


def placed_folder(lines: DataFrame) -> str:
    """The lines as gzip files with the paths that ``file_name`` gives."""
    folder, run = new_folder(lines.sparkSession, "placed"), new_folder(lines.sparkSession, "gz")
    lines.select("file_name", "value").write.partitionBy("file_name").option("compression", "gzip").text(run)
    names = [r.file_name for r in lines.select("file_name").distinct().collect()]
    place(lines.sparkSession, run, folder, names, ".gz")
    return folder


def gz_folder(lines: DataFrame) -> str:
    """The lines as gzip NDJSON files, a folder per file name, in the shared folder."""
    folder = new_folder(lines.sparkSession, "gz")
    (
        lines.select("file_name", "value")
        .write.partitionBy("file_name")
        .option("compression", "gzip")
        .text(folder)
    )
    return folder
