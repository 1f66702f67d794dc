"""Write PLANS.md: condensed physical plans of the refresh and headline reports.

usage: python tools/plan_report.py [sf_dir]
For each plan: the operator sequence (after execution, so AQE's final choices
show), the pushed filters and the read schemas of every scan.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from outlay import catalog  # noqa: E402
from outlay.operators import documents as DOC  # noqa: E402
from outlay.operators import fund_nodes as fn  # noqa: E402
from outlay.params import SourceParams  # noqa: E402
from outlay.plans import curated as C  # noqa: E402
from outlay.plans import pos as POS  # noqa: E402
from outlay.plans import projects as PR  # noqa: E402
from outlay.session import checkpoint_dir, get_session  # noqa: E402
from outlay.sources import fixtures  # noqa: E402



def executed(df) -> str:
    """Tree of the plan that ran: the same execution is run, then its final plan is printed."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    out = []
    for line in plan.treeString().splitlines():
        line = re.sub(r"#\d+L?|, \[plan_id=\d+\]|\*\(\d+\) ", "", line).rstrip()
        scan = re.search(r"PushedFilters: (\[.*?\]).*ReadSchema: (.*)", line)
        if scan:
            line = line.split("FileScan")[0] + f"FileScan pushed={scan[1]} read={scan[2]}"
        out.append(line[:150])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    p = SourceParams()
    raw = fixtures.load_raw(spark, sf, p)
    st = C.build_stages(raw, p)
    cur = C.materialize(spark, C.build(raw, p), f"{checkpoint_dir(spark)}/plans-{uuid.uuid4().hex}", raw, p)
    docs = (fixtures.doc_old(spark, sf, p), fixtures.doc_incoming(spark, sf, p), fixtures.doc_attempted(spark, sf))
    plans = {
        "refresh: direct PO rollup (A8, J2)": st.direct,
        "refresh: three-source merge (U1, K1)": st.merged,
        "po_summary_filtered (A13 over J5)": POS.po_summary(cur, catalog.SUMMARY_FILTER),
        "po_page_filtered (R4, O2, O3)": POS.po_page(cur, catalog.PAGE_FILTER),
        "kpi_stats_search (A1, F2, F4, J6)": PR.kpi_stats(cur, catalog.DASH_SEARCH),
        "project_list_search (R2)": PR.project_list(cur, catalog.LIST_FILTER),
        "fund_node_panel (R7)": fn.node_panel(cur.fund_nodes),
        "doc_reconcile (D1)": DOC.reconcile(*docs, p.refreshed_at),
    }
    out = [f"# Physical plans (sf={sf}, local[8], recorded {time.strftime('%Y-%m-%d')})", "",
           "Generated by `python tools/plan_report.py`: trees of the plans that ran, as AQE left them (query stages, "
           "coalesced and split shuffle reads). Reports read the written curated tables.", "",
           "How to read them:", "",
           "- Every scan reads only the columns the plan uses (`ReadSchema`), and report filters on stored",
           "  columns reach the scan (`PushedFilters`, e.g. `po_status = 'Open'`, `banner = 'Main'`).",
           "- Broadcasts come from Spark's size checks or AQE's run-time statistics, never from hints. At this",
           "  scale the dimensions and the written curated tables are small enough; at cluster scale the same",
           "  plans keep SortMergeJoin, and AQE splits skewed partitions.",
           "- Lines are rolled up by `HashAggregate` with the status as a key; the `SortAggregate` above it takes the",
           "  status maximum over what is left. The `min_by(struct, struct)` rules (K1-K7) sort too, but aggregate",
           "  partially before the Exchange, so hot keys are reduced map-side.",
           "- Page queries end in `TakeOrderedAndProject`: each task hands on offset + limit rows; deep pages use the",
           "  keyset query.",
           ""]
    for name, df in plans.items():
        out += [f"## {name}", "", "```", executed(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
