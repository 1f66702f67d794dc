"""Readers for landed extracts (S1-S4): parquet or JSON files with declared types.

Extracts deliver any type, often text; every column is cast to the type the
refresh expects, and a value that does not cast becomes NULL. Columns not
listed are not read, listed ones that an extract lacks are NULL. The test
tables' fixture is another source of the same frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import RawInputs

PROJECTS = ("record_id bigint, program_type string, store_nbr bigint, proj_def string, project_status string, "
            "state string, city string, contractor string, store_type string, is_active boolean, "
            "date_modified timestamp, actuals decimal(18,2), commitments decimal(18,2), contract decimal(18,2), "
            "contractor_po_amount decimal(18,2), created_date timestamp, complete_date timestamp")
ENRICHMENT = ("proj_def string, entity_id bigint, seq string, store_seq string, scope string, firm string, "
              "comments_a string, comments_b string, ods_updated timestamp")
PO_LINES = ("po_nbr string, project_definition string, store_nbr bigint, item_text string, vendor_name string, "
            "net_amt decimal(18,2), inv_amt decimal(18,2), pur_doc_sts string, document_date timestamp, "
            "ods_updated timestamp")
#: Amounts stay text: the rollup reads them with try_cast.
NODES = ("program_position string, approval_year int, project_no bigint, program_position_desc string, "
         "original_budget string, supplemental_budget string, returned_budget string, current_budget string, "
         "total_actual string, total_commitments string, current_budget_available string, distributed_budget string, "
         "budget_cf_from_previous_fiscal_year string, budget_cf_to_next_fiscal_year string")


def _columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(c.rsplit(" ", 1)) for c in ddl.replace("decimal(18,2)", "money").split(", ")]


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with exactly the declared columns and types."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for name, kind in _columns(ddl):
        kind = "decimal(18,2)" if kind == "money" else kind
        c = F.col(f"`{have[name]}`").try_cast(kind) if name in have else F.lit(None).cast(kind)
        out.append(c.alias(name))
    return df.select(*out)


def read_extract(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """One extract; JSON is read as text columns, so no inference pass runs over it."""
    if fmt == "json":
        return typed(spark.read.schema(", ".join(f"{n} string" for n, _ in _columns(ddl))).json(path), ddl)
    return typed(spark.read.format(fmt).load(path), ddl)


def load_landed(spark: SparkSession, projects: str, enrichment: str, po_lines: str, nodes: str,
                fmt: str = "parquet") -> RawInputs:
    """The inputs of one refresh from landed files."""
    return RawInputs(
        projects=read_extract(spark, projects, PROJECTS, fmt), enrichment=read_extract(spark, enrichment, ENRICHMENT, fmt),
        po_lines=read_extract(spark, po_lines, PO_LINES, fmt), nodes=read_extract(spark, nodes, NODES, fmt))


def read_json_payloads(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One JSON document per file, as (``key``, payload); the key is the file's name without suffix."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias(key), F.col("value").alias("payload"))
