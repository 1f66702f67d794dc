"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written as plain SQL over the driver's views, separately from the Spark
plans: first-wins rules are ROW_NUMBER windows here (``min_by`` aggregates
on the Spark side), so the two formulations check each other. Named CTEs
are assembled on demand with their dependencies.
"""

from __future__ import annotations

from .params import NOT_FOUND_DESCRIPTION, SourceParams

P = SourceParams()
AS_OF = "2001-12-01 12:00:00"
D = "DECIMAL(18,2)"


# Fixed values, written apart from the Spark side: search keys and their columns.
PO_FIELDS = {"po_number": "po_number", "vendor": "vendor", "store": "store", "store_sequence": "store_sequence",
             "city": "city", "state": "state", "sap_def": "proj_def", "status": "project_status",
             "project_id": "project_id", "project_type": "project_type", "scope": "scope",
             "contractor": "general_contractor", "banner": "banner"}
PROJECT_FIELDS = {"project_id": "project_id", "store": "store", "city": "city", "contractor": "general_contractor",
                  "scope": "scope", "sap_def": "proj_def", "banner": "banner", "status": "project_status", "po": None}
# Fixed values, written apart from the Spark side: store types by banner, file types by extension.
BANNER_CODES = {"Main": ("SUP", "WNM", "W/M", "FASHION"), "Club": ("SAM",), "DC": ("FC", "GDC", "GROCERY DC")}
OFFICE = "application/vnd.openxmlformats-officedocument."
FILE_TYPES = {
    "pdf": "application/pdf", "doc": "application/msword", "docx": OFFICE + "wordprocessingml.document",
    "xls": "application/vnd.ms-excel", "xlsx": OFFICE + "spreadsheetml.sheet", "png": "image/png",
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "dwg": "application/acad", "zip": "application/zip",
    "msg": "application/vnd.ms-outlook", "txt": "text/plain", "csv": "text/csv"}
PROJECT_HAYSTACK = ("store", "city", "state", "scope", "general_contractor", "project_id", "store_sequence",
                    "project_type")
PO_HAYSTACK = ("po_number", "vendor", "store", "project_status", "po_status", "scope", "general_contractor",
               "project_type")


def terms(search: str | None) -> list[str]:
    return [t.strip() for t in (search or "").split(";") if t.strip()]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _def6(k: str) -> str:
    return f"lpad(CAST(CASE WHEN {k} % 10 = 9 THEN {k} - 1 ELSE {k} END AS VARCHAR), 6, '0')"


def _case_map(expr: str, mapping: dict[str, str], default_sql: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"COALESCE(CASE {expr} {whens} END, {default_sql})"


_BANNER = ("CASE WHEN store_type IS NULL OR store_type = '' THEN 'Unknown' "
           + " ".join(f"WHEN upper(trim(store_type)) IN ({', '.join(map(q, codes))}) THEN {q(name)}"
                      for name, codes in BANNER_CODES.items()) + " ELSE 'Main' END")
_VENDOR_OK = " OR ".join(f"contains(upper(vendor_name), {q(v.upper())})" for v in P.umbrella_vendors)
_TRACKED = ", ".join(q(k) for k, _ in P.tracked_nodes)
_NODE_LABEL = "CASE node_key " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in P.tracked_nodes) + " END"
_MONEY_OUT = "CAST({} AS DOUBLE)"
_COMMENT_RE = r"(?i)(?:ACME|INSTALLER)\s+PO#?\s*(\d{8})"
_AGE = (f"CAST(trunc((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(COALESCE(po.last_update, po.created_date)))"
        f" / 86400000000.0) AS INTEGER)")
_PO_AGGS = f"""sum(net_amt) AS po_total, sum(inv_amt) AS invoiced_to_date,
       CAST(sum(net_amt) - sum(inv_amt) AS {D}) AS remaining_to_invoice, max(pur_doc_sts) AS po_status,
       min(document_date) AS created_date, max(ods_updated) AS last_update"""
_HAVING = "HAVING sum(net_amt) > 0 OR sum(inv_amt) > 0"


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def mime(name: str) -> str:
    ext = f"CASE WHEN contains({name}, '.') THEN lower(split_part({name}, '.', -1)) ELSE '' END"
    return _case_map(ext, FILE_TYPES, "'application/octet-stream'")


_MEASURES = ["original_budget", "supplemental_budget", "returned_budget", "current_budget", "actuals",
             "open_commitments", "budget_available", "distributed_budget", "budget_cf_from_prev", "budget_cf_to_next"]
_RAW_MEASURES = ["original_budget", "supplemental_budget", "returned_budget", "current_budget", "total_actual",
                 "total_commitments", "current_budget_available", "distributed_budget",
                 "budget_cf_from_previous_fiscal_year", "budget_cf_to_next_fiscal_year"]

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


# ----------------------------------------------------------------- fixtures
cte("cust_span", (), "SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order "
                     "FROM orders GROUP BY o_custkey")
cte("raw_projects", ("cust_span",), f"""
SELECT c.c_custkey AS record_id,
  CASE WHEN c.c_custkey % 7 = 0 THEN 'OTHER ' ELSE 'PROG ' END || c.c_mktsegment AS program_type, c.c_custkey % 97 AS store_nbr,
  'PD-' || {_def6('c.c_custkey')} AS proj_def,
  CASE WHEN c.c_custkey % 6 <= 2 THEN 'Active' WHEN c.c_custkey % 6 = 3 THEN 'Complete'
       WHEN c.c_custkey % 6 = 4 THEN 'On Hold' ELSE 'Cancelled' END AS project_status,
  n.n_name AS state, 'City ' || CAST(c.c_custkey % 41 AS VARCHAR) AS city,
  CASE WHEN c.c_custkey % 4 = 0 THEN '' ELSE 'GC ' || CAST(c.c_custkey % 23 AS VARCHAR) END AS contractor,
  CASE c.c_custkey % 5 WHEN 0 THEN 'SUP' WHEN 1 THEN 'sam ' WHEN 2 THEN 'GDC' WHEN 3 THEN '' ELSE NULL END AS store_type,
  c.c_custkey % 13 <> 0 AS is_active,
  s.last_order AS date_modified,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE CAST(abs(c.c_acctbal) AS {D}) END AS actuals,
  CAST(CASE WHEN c.c_custkey % 3 = 0 THEN 0 ELSE c.c_custkey END AS {D}) AS commitments,
  CAST(c.c_custkey * 10 AS {D}) AS contract, CAST(c.c_custkey * 2 AS {D}) AS contractor_po_amount,
  s.first_order AS created_date,
  CASE WHEN c.c_custkey % 6 = 3 THEN s.last_order ELSE TIMESTAMP '9999-12-31 00:00:00' END AS complete_date
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN cust_span s ON c.c_custkey = s.o_custkey""")
cte("enrichment", (), f"""
SELECT CASE WHEN c_custkey % 20 = 0 THEN 'XD-' ELSE 'PD-' END || {_def6('c_custkey')} AS proj_def,
  c_custkey + 100000 AS entity_id,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey + 1000 AS VARCHAR) END AS seq,
  CAST(c_custkey % 97 AS VARCHAR) || '.' || CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey + 1000 AS VARCHAR) END AS store_seq,
  CASE WHEN c_custkey % 11 = 0 THEN 'Duplicate of earlier' ELSE 'Replace unit ' || CAST(c_custkey AS VARCHAR) END AS scope,
  CASE WHEN c_custkey % 8 = 0 THEN '!Unknown' ELSE 'Firm ' || CAST(c_custkey % 17 AS VARCHAR) END AS firm,
  CASE WHEN c_custkey % 5 = 0 THEN 'see acme po# ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '; installer po '
       || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') || ' ok' END AS comments_a,
  CASE WHEN c_custkey % 2 = 0 THEN 'reviewed' END AS comments_b,
  CASE WHEN c_custkey % 10 <> 3 THEN CAST(DATE '2001-01-01' + CAST(c_custkey % 250 AS INTEGER) AS TIMESTAMP) END AS ods_updated
FROM customer""")
cte("raw_po", (), f"""
SELECT lpad(CAST(l.l_orderkey AS VARCHAR), 8, '0') AS po_nbr,
  CASE WHEN l.l_partkey % 25 = 0 THEN {q(P.umbrella_key)} ELSE 'PD' || {_def6('o.o_custkey')} || '00000' END AS project_definition,
  o.o_custkey % 97 AS store_nbr,
  CASE WHEN l.l_linenumber % 2 = 0 THEN CAST((o.o_custkey + 1) % 120 AS VARCHAR) || {q(P.item_store_suffix)} ELSE 'misc' END AS item_text,
  s.s_name AS vendor_name,
  CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_extendedprice AS {D}) ELSE CAST(0 AS {D}) END AS net_amt,
  CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_extendedprice AS {D}) ELSE CAST(0 AS {D}) END AS inv_amt,
  CASE o.o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' ELSE 'Partially Invoiced' END AS pur_doc_sts,
  o.o_orderdate AS document_date, l.l_shipdate AS ods_updated
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
_price = f"CAST(l.l_extendedprice AS {D})"
_ret = f"CASE WHEN l.l_returnflag = 'R' THEN {_price} ELSE CAST(0 AS {D}) END"
_sup = f"CAST(l.l_quantity * 100 AS {D})"
_cur = f"CAST({_price} + {_sup} - {_ret} AS {D})"
_act = f"CASE WHEN l.l_linestatus = 'F' THEN {_price} ELSE CAST(0 AS {D}) END"
_com = f"CASE WHEN l.l_linestatus = 'O' THEN {_price} ELSE CAST(0 AS {D}) END"
cte("raw_nodes", (), f"""
SELECT CASE WHEN l.l_linenumber = 7 THEN lower(p.p_type) ELSE p.p_type END AS program_position,
  CAST(year(o.o_orderdate) AS INTEGER) AS approval_year, o.o_custkey AS project_no,
  p.p_type || ' node' AS program_position_desc,
  CASE WHEN l.l_linenumber = 6 THEN 'n/a' ELSE CAST({_price} AS VARCHAR) END AS original_budget,
  CAST({_sup} AS VARCHAR) AS supplemental_budget,
  CAST(CAST({_ret} AS {D}) AS VARCHAR) AS returned_budget,
  CAST({_cur} AS VARCHAR) AS current_budget,
  CAST(CAST({_act} AS {D}) AS VARCHAR) AS total_actual,
  CAST(CAST({_com} AS {D}) AS VARCHAR) AS total_commitments,
  CAST(CAST({_cur} - {_act} - {_com} AS {D}) AS VARCHAR) AS current_budget_available,
  CAST(CAST(CASE WHEN l.l_linenumber = 1 THEN {_price} ELSE CAST(0 AS {D}) END AS {D}) AS VARCHAR) AS distributed_budget,
  CAST(CAST(CAST(round(l.l_discount * 100) AS INTEGER) * 10 AS {D}) AS VARCHAR) AS budget_cf_from_previous_fiscal_year,
  CAST(CAST(CAST(round(l.l_tax * 100) AS INTEGER) * 10 AS {D}) AS VARCHAR) AS budget_cf_to_next_fiscal_year
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE upper(p.p_type) IN ({_TRACKED})""")

# ----------------------------------------------------------------- curated
cte("pulled", ("raw_projects", "enrichment"), """
SELECT COALESCE(CAST(e.entity_id AS VARCHAR), CAST(r.record_id AS VARCHAR)) AS project_id,
  r.program_type AS project_type, CAST(r.store_nbr AS VARCHAR) AS store,
  COALESCE(e.seq, CAST(r.record_id AS VARCHAR)) AS sequence,
  COALESCE(e.store_seq, CAST(r.store_nbr AS VARCHAR) || '.' || CAST(r.record_id AS VARCHAR)) AS store_sequence,
  r.city, r.state, r.project_status, r.proj_def, COALESCE(e.scope, '') AS scope,
  CASE WHEN r.contractor <> '' THEN r.contractor END AS general_contractor,
  r.date_modified AS updated_at, r.actuals, r.commitments, r.contract, r.contractor_po_amount,
  r.created_date, r.complete_date, r.store_type, e.comments_a, e.comments_b, r.record_id
FROM raw_projects r LEFT JOIN enrichment e ON r.proj_def = e.proj_def
WHERE upper(r.program_type) LIKE '%PROG%' AND r.is_active""")
cte("prog_keys", ("raw_projects",), """
SELECT DISTINCT proj_def, replace(proj_def, '-', '') || '00000' AS po_key FROM raw_projects
WHERE upper(program_type) LIKE '%PROG%' AND proj_def IS NOT NULL AND proj_def <> ''""")
cte("direct_pos", ("raw_po", "prog_keys"), f"""
SELECT r.po_nbr AS po_number, k.proj_def, r.vendor_name AS vendor, {_PO_AGGS}
FROM raw_po r JOIN prog_keys k ON r.project_definition = k.po_key
GROUP BY r.po_nbr, k.proj_def, r.vendor_name {_HAVING}""")
cte("store_map", ("pulled",), """
SELECT store, proj_def FROM (
  SELECT store, proj_def, row_number() OVER (PARTITION BY store ORDER BY elig DESC,
      CASE WHEN elig THEN updated_at END ASC NULLS FIRST, CASE WHEN elig THEN record_id END DESC,
      CASE WHEN elig THEN project_id END DESC,
      CASE WHEN NOT elig THEN updated_at END DESC NULLS LAST, CASE WHEN NOT elig THEN record_id END ASC,
      CASE WHEN NOT elig THEN project_id END ASC) AS rn
  FROM (SELECT *, (COALESCE(lower(project_status), '') = 'active' AND lower(scope) NOT LIKE '%duplicate%'
                   AND lower(scope) NOT LIKE '%cancelled%') AS elig
        FROM pulled WHERE store IS NOT NULL AND store <> '' AND proj_def IS NOT NULL AND proj_def <> '') x
) y WHERE rn = 1""")
cte("umbrella_raw", ("raw_po",), f"""
SELECT store_nbr, po_nbr AS po_number, vendor_name AS vendor, item_text, {_PO_AGGS}
FROM raw_po WHERE project_definition = {q(P.umbrella_key)} AND ({_VENDOR_OK})
GROUP BY store_nbr, po_nbr, vendor_name, item_text {_HAVING}""")
cte("umbrella_mapped", ("umbrella_raw", "store_map"), f"""
SELECT u.*, m.proj_def FROM (
  SELECT *, COALESCE(NULLIF(regexp_extract(item_text, '(?i)^(\\d+){P.item_store_suffix}', 1), ''),
                     CAST(store_nbr AS VARCHAR)) AS real_store FROM umbrella_raw) u
LEFT JOIN store_map m ON u.real_store = m.store""")
cte("comment_refs", ("pulled",), f"""
SELECT proj_def, updated_at, record_id, project_id,
  unnest(regexp_extract_all(comments_a, '{_COMMENT_RE}', 1)) AS po_number,
  generate_subscripts(regexp_extract_all(comments_a, '{_COMMENT_RE}', 1), 1) AS pos
FROM pulled WHERE trim(COALESCE(comments_a, '')) <> '' AND proj_def IS NOT NULL AND proj_def <> ''""")
cte("comment_map", ("comment_refs",), """
SELECT po_number, proj_def FROM (
  SELECT *, row_number() OVER (PARTITION BY po_number ORDER BY updated_at ASC NULLS FIRST, record_id DESC,
                               project_id DESC, pos DESC) AS rn FROM comment_refs) WHERE rn = 1""")
cte("comment_pos", ("raw_po", "comment_map"), f"""
SELECT r.po_nbr AS po_number, r.vendor_name AS vendor, m.proj_def, {_PO_AGGS}
FROM raw_po r JOIN comment_map m ON r.po_nbr = m.po_number
GROUP BY r.po_nbr, r.vendor_name, m.proj_def {_HAVING}""")
_POCOLS = "po_number, proj_def, vendor, po_total, invoiced_to_date, remaining_to_invoice, po_status, created_date, last_update"
cte("merged", ("direct_pos", "umbrella_mapped", "comment_pos"), f"""
SELECT {_POCOLS}, source_rank, store_nbr, item_text FROM (
  SELECT *, row_number() OVER (PARTITION BY po_number,
      CASE WHEN po_number IS NULL AND source_rank = 1 THEN struct_pack(a := proj_def, b := vendor) END
    ORDER BY source_rank,
      CASE WHEN source_rank = 1 THEN created_date END DESC NULLS LAST,
      CASE WHEN source_rank = 2 THEN store_nbr END ASC NULLS FIRST,
      vendor ASC NULLS FIRST, item_text ASC NULLS FIRST, proj_def ASC NULLS FIRST) AS rn
  FROM (SELECT {_POCOLS}, 1 AS source_rank, CAST(NULL AS BIGINT) AS store_nbr, CAST(NULL AS VARCHAR) AS item_text FROM direct_pos
        UNION ALL SELECT {_POCOLS}, 2, store_nbr, item_text FROM umbrella_mapped WHERE proj_def IS NOT NULL
        UNION ALL SELECT {_POCOLS}, 3, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM comment_pos) u
) WHERE rn = 1 AND (po_number IS NOT NULL OR source_rank = 1
                    OR NOT EXISTS (SELECT 1 FROM direct_pos n WHERE n.po_number IS NULL))""")
cte("po", ("merged",), f"""
SELECT po_number, proj_def, vendor, CAST(NULL AS VARCHAR) AS vendor_email,
  COALESCE(po_total, 0) AS po_total, COALESCE(invoiced_to_date, 0) AS invoiced_to_date,
  COALESCE(remaining_to_invoice, 0) AS remaining_to_invoice, po_status, created_date, last_update FROM merged""")
cte("proj_k2", ("pulled",), """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY updated_at DESC NULLS LAST,
                                            record_id ASC, project_id ASC) AS rn
               FROM pulled WHERE project_type IS NOT NULL) WHERE rn = 1""")
cte("top_vendor", ("po",), """
SELECT proj_def, vendor AS top_vendor FROM (
  SELECT proj_def, vendor, row_number() OVER (PARTITION BY proj_def ORDER BY t DESC, vendor ASC NULLS FIRST) AS rn
  FROM (SELECT proj_def, vendor, sum(po_total) AS t FROM po WHERE proj_def IS NOT NULL GROUP BY proj_def, vendor) v
) WHERE rn = 1""")
cte("projects", ("proj_k2", "top_vendor"), f"""
SELECT p.project_id, p.project_type, p.store, p.sequence, p.store_sequence, p.city, p.state, p.project_status,
  p.proj_def, p.scope,
  CASE WHEN tv.proj_def IS NOT NULL THEN tv.top_vendor ELSE p.general_contractor END AS general_contractor,
  p.store_type, {_BANNER.replace('store_type', 'p.store_type')} AS banner, p.created_date, p.complete_date,
  p.comments_a, p.comments_b, p.updated_at
FROM proj_k2 p LEFT JOIN top_vendor tv ON p.proj_def = tv.proj_def""")
cte("budgets", ("pulled",), f"""
SELECT proj_def, budget_total, budget_open, budget_committed, budget_actuals, updated_at FROM (
  SELECT proj_def,
    CASE WHEN COALESCE(actuals, 0) + COALESCE(commitments, 0) > 0
         THEN CAST(COALESCE(actuals, 0) + COALESCE(commitments, 0) AS {D}) ELSE COALESCE(contract, 0) END AS budget_total,
    COALESCE(commitments, 0) AS budget_open, COALESCE(contractor_po_amount, 0) AS budget_committed,
    COALESCE(actuals, 0) AS budget_actuals, updated_at,
    row_number() OVER (PARTITION BY proj_def ORDER BY updated_at ASC NULLS FIRST, record_id DESC, project_id DESC) AS rn
  FROM pulled WHERE proj_def IS NOT NULL AND proj_def <> '') WHERE rn = 1""")
_node_sums = ",\n  ".join(f"sum(try_cast({r} AS {D})) AS {m}" for r, m in zip(_RAW_MEASURES, _MEASURES))
cte("node_rows", ("raw_nodes",), f"""
SELECT program_position, approval_year, max(program_position_desc) AS description,
  CAST(count(DISTINCT project_no) AS INTEGER) AS project_count,
  {_node_sums}
FROM raw_nodes WHERE upper(program_position) IN ({_TRACKED}) AND approval_year IS NOT NULL
GROUP BY program_position, approval_year""")
_stamp = q(P.refreshed_at + " UTC")
_mcoal = ", ".join(f"COALESCE({m}, 0) AS {m}" for m in _MEASURES)
_mzero = ", ".join(f"CAST(0 AS {D}) AS {m}" for m in _MEASURES)
_tracked_values = ", ".join(f"({q(k)}, {q(v)})" for k, v in P.tracked_nodes)
cte("fund_nodes", ("node_rows",), f"""
SELECT node_key, CAST(COALESCE(approval_year, 0) AS INTEGER) AS approval_year,
  COALESCE({_NODE_LABEL}, node_key) AS node_label, description, {_mcoal},
  CAST(COALESCE(project_count, 0) AS INTEGER) AS project_count, {_stamp} AS last_updated
FROM (SELECT *, upper(program_position) AS node_key,
        row_number() OVER (PARTITION BY upper(program_position), approval_year ORDER BY program_position DESC) AS rn
      FROM node_rows) WHERE rn = 1
UNION ALL
SELECT t.k AS node_key, CAST(y.yr AS INTEGER), t.label, {q(NOT_FOUND_DESCRIPTION)}, {_mzero}, 0, {_stamp}
FROM (VALUES {_tracked_values}) t(k, label)
CROSS JOIN (SELECT DISTINCT COALESCE(approval_year, 0) AS yr FROM node_rows
            UNION SELECT 0 WHERE NOT EXISTS (SELECT 1 FROM node_rows)) y
WHERE t.k NOT IN (SELECT upper(program_position) FROM node_rows)""")

# ----------------------------------------------------------------- PO base
cte("po_joined", ("po", "projects"), """
SELECT o.* EXCLUDE (po_total, invoiced_to_date, remaining_to_invoice),
  o.po_total AS raw_po_total, o.invoiced_to_date AS raw_invoiced, o.remaining_to_invoice AS raw_remaining,
  ifnull(o.po_total, 0) AS po_total, ifnull(o.invoiced_to_date, 0) AS invoiced_to_date,
  ifnull(o.remaining_to_invoice, 0) AS remaining_to_invoice,
  p.* EXCLUDE (proj_def, created_date, updated_at, complete_date)
FROM po o LEFT JOIN projects p USING (proj_def)""")
cte("po_base", ("po_joined",), f"""
SELECT *, (invoiced_to_date > po_total)::INT AS is_over_invoiced, {_AGE} AS days_since_last_invoice,
  give_back_flag * remaining_to_invoice AS give_back_amount
FROM (SELECT *, ifnull(lower(project_status) = 'complete' AND remaining_to_invoice > 0, false)::INT AS give_back_flag
      FROM po_joined) po""")

PO_PRESENT = f"""po_number, vendor, vendor_email, store, sequence, store_sequence, city, state, project_id,
  project_status, po_status, CAST(po_total AS DOUBLE) AS po_total, CAST(invoiced_to_date AS DOUBLE) AS invoiced_to_date,
  CAST(remaining_to_invoice AS DOUBLE) AS remaining_to_invoice, is_over_invoiced, give_back_flag,
  CAST(give_back_amount AS DOUBLE) AS give_back_amount, days_since_last_invoice,
  {ts('created_date')} AS created_date, {ts('last_update')} AS last_update, proj_def, general_contractor,
  project_type, scope"""


def with_prefix(*needed: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """The ``WITH`` clause for ``needed`` (dependencies first) plus ad-hoc
    ``(name, body)`` CTEs appended after them; no final statement."""
    body = sql("", *needed)
    parts = [body.rstrip()] if body.strip() else []
    for name, text in extra:
        parts.append(f"{name} AS ({text})")
    if not parts:
        return ""
    head = parts[0] if parts[0].startswith("WITH ") else "WITH " + parts[0]
    return ",\n".join([head, *parts[1:]])


def sql(final: str, *needed: str) -> str:
    """``WITH`` the needed CTEs (dependencies first) followed by ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {body}\n{final}"


def _fold(col: str) -> str:
    return f"translate({col}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def like(col: str, term: str) -> str:
    """SQLite-style ASCII case-insensitive LIKE '%term%' (no escape char)."""
    return f"{_fold(col)} LIKE {q('%' + term.lower() + '%')}"


__all__ = ["CTES", "cte", "sql", "with_prefix", "like", "PO_PRESENT", "AS_OF", "D", "ts", "mime", "q"]
