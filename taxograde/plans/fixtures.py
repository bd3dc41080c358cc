"""Fixture views over the driver tables.

The driver's ``documents`` table plays every input of the tool: ``lang`` is the
domain, ``source`` the technology, ``doc_id`` the row order inside a file. Each
view is one SELECT that runs unchanged in Spark SQL and in DuckDB, so the Spark
queries and their DuckDB oracles start from identical rows. All views scan the
whole table.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

# Fixed fixture definitions (identical text in Spark and in the DuckDB oracle).
VIEWS: dict[str, str] = {
    "patents_raw": """
select lang as domain, source as tech_name_raw, doc_id as ord,
  cast(doc_id as varchar(20)) as patent_id,
  case when doc_id % 13 = 0 then null when doc_id % 29 = 0 then 'NA'
       else split_part(text, chr(10), 1) end as title,
  case when doc_id % 26 = 0 then null when doc_id % 58 = 0 then '' else text end as abstract
from documents""",
    "patents": """
select lang as domain, source as tech_name_raw, doc_id as ord,
  cast(doc_id as varchar(20)) as patent_id,
  split_part(text, chr(10), 1) as title, text as abstract
from documents""",
    "mapping_raw": """
select domain, k as ord, concat('src', cast(k as varchar(10))) as tech_name,
  concat('g0', cast(k % 4 as varchar(2)), 's 17/89， H0', cast((k + 1) % 4 as varchar(2)), 'w;;B60') as code_cell
from (select distinct lang as domain, cast(substring(source, 4) as int) as k from documents) d
where domain <> 'es' and k < 10 and k <> 7""",
    "inferred": """
select lang as domain, source as tech_name_raw, doc_id as ord,
  cast(doc_id as varchar(20)) as patent_id,
  case when doc_id % 17 = 0 then cast('' as varchar(64))
       else concat('G0', cast(doc_id % 7 as varchar(2)), 'S',
                   case when doc_id % 3 = 0 then '/89' else '' end, '|',
                   ' h0', cast(doc_id % 11 as varchar(2)), 'W 4/02') end as codes_piped
from documents""",
    "expected_direct": """
select domain, tech_name_raw,
  concat('G0', cast(k % 7 as varchar(2)), 'S/8', case when k % 2 = 0 then '*' else '' end,
         '|H0', cast(k % 5 as varchar(2)), 'W*|H0', cast(k % 6 as varchar(2)), 'W4') as codes_piped
from (select distinct lang as domain, source as tech_name_raw,
             cast(substring(source, 4) as int) as k from documents) d""",
    "checkpoints": """
select domain, tech_name_raw, case when k % 4 = 0 then 'done' else 'failed' end as status
from (select distinct lang as domain, source as tech_name_raw,
             cast(substring(source, 4) as int) as k from documents) d
where k % 2 = 0""",
    "responses": """
select domain, tech_name_raw, ord,
  case when m = 1 then 'oops' when m = 4 then '{"a":1}'
       when m = 2 then concat('```json', chr(10), obj, chr(10), '```')
       when m = 5 then concat('Here it is: ', obj, ' Done.')
       else obj end as raw_text
from (select lang as domain, source as tech_name_raw, doc_id as ord, doc_id % 10 as m,
        concat('{"patent_batches":[{"domain":"', case when doc_id % 10 = 0 then 'xx' else lang end,
               '","tech_name_raw":"', source, '","patents":[{"patent_id":', cast(doc_id as varchar(20)),
               ',"inferred_codes":["G0', cast(doc_id % 7 as varchar(2)), 'S"',
               case when doc_id % 10 = 3 then ',89' else '' end, ']}]}]}') as obj
      from documents) d""",
}

# The technology dimension and the domain order of the fixture hierarchy.
VIEWS["tech"] = """
select distinct lang as domain, source as tech_name_raw from documents"""
VIEWS["domains"] = """
select lang as domain, cast(row_number() over (order by lang) as bigint) as domain_pos
from (select distinct lang from documents) d"""


def _table_view(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A temporary view over one driver table, registered once per session."""
    name = f"tg_{table}_{hashlib.md5(sf_dir.encode()).hexdigest()[:10]}"
    if not spark.catalog.tableExists(name):
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").createOrReplaceTempView(name)
    return name


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame over ``{sf_dir}/documents.parquet``."""
    docs = _table_view(spark, sf_dir, "documents")
    sql = re.sub(r"\bfrom documents\b", f"from {docs}", VIEWS[name])
    return spark.sql(sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ctes(*names: str) -> str:
    """``with a as (...), b as (...)`` for the DuckDB oracle."""
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]}\n)" for n in names) + "\n"
