"""Write the physical plans of the key operators to docs/plans.md.

    python tools/plans.py [sf_dir]

Builds the warehouse of ``sf_dir`` (default sf0.01) in a scratch folder and
records ``explain()`` output (pre-execution AQE plans) for the loads, the
gold models, the star queries and the check catalogue.
"""

from __future__ import annotations

import io
import os
import re
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.operators import star  # noqa: E402
from tessera.operators.vault import (  # noqa: E402
    load_hub,
    load_link,
    load_satellite,
    stored_of_extract,
)
from tessera.plans.check_specs import CHECK_SPECS  # noqa: E402
from tessera.plans.models import HUB, LINK, SAT  # noqa: E402
from tessera.plans.pipeline import (  # noqa: E402
    build_warehouse,
    current_state,
    gold_model,
    dealt_by,
    model_tables,
    source_tables,
)
from tessera.operators.checks import model_failures  # noqa: E402
from tessera.session import local_test_session, scratch_root  # noqa: E402
from tessera.sources.driver_tables import DriverTables  # noqa: E402


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    text = re.sub(r"file:/\S+?/(bronze|silver|gold|state)/", r"<wh>/\1/", buf.getvalue())
    return text.strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_test_session("tessera-plans", shuffle_partitions=16)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-plans-"))
    root = tempfile.mkdtemp(prefix="plans-", dir=scratch_root(spark).removeprefix("file:"))
    wh = build_warehouse(spark, sf_dir, root)
    g = lambda n: wh.read("gold", n)
    accounts, transactions = (wh.read("bronze", f"bronze_{n}") for n in ("accounts",
                                                                         "transactions"))

    def needed(stored, spec, ids, bronze=accounts):
        """What a load reads of the stored rows, as ``run_batch`` does."""
        key = getattr(spec, "key_col", None) or spec.dealt_by
        return stored_of_extract(stored, bronze, key, ids)

    hub, link, sat = HUB["hub_account"], LINK["link_customer_account"], SAT["sat_account_details"]
    sat_tx = SAT["sat_transaction_details"]
    hubs, links = (wh.read_before("silver", x.name, 3) for x in (hub, link))
    items = {
        "hub load": load_hub(accounts, hub, needed(hubs, hub, ["account_id"])),
        "link load": load_link(accounts, link, needed(links, link, link.dealt_ids)),
        "satellite load from the current-state snapshot": load_satellite(
            accounts, sat,
            current_state(wh, sat, 3, lambda rows: needed(rows, sat, ["account_id"])),
            latest_only=True),
        "satellite load from history": load_satellite(
            transactions, sat_tx, needed(wh.read("silver", sat_tx.name), sat_tx,
                                         ["transaction_id"], transactions)),
        "dim_account": gold_model(wh, "dim_account"),
        "dim_customer": gold_model(wh, "dim_customer"),
        "fact_transactions": gold_model(wh, "fact_transactions"),
        "spend_by_city_quarter": star.spend_by_city_quarter(
            g("fact_transactions"), g("dim_customer"), g("dim_date")),
        "join_point_in_time": star.transactions_point_in_time(
            g("fact_transactions"), g("dim_customer")),
        "join_point_in_time, bucket=year": star.transactions_point_in_time(
            g("fact_transactions"), g("dim_customer"), bucket="year"),
        "join_point_in_time, merged": star.transactions_point_in_time(
            g("fact_transactions"), g("dim_customer"), merge=True),
        "transactions_star": star.transactions_star(
            g("fact_transactions"), g("dim_customer"), g("dim_account"), g("dim_merchant"),
            g("dim_date")),
        "209 checks (those of fact_transactions; each model's are one query)": model_failures(
            g("fact_transactions"),
            [(i, s) for i, s in enumerate(CHECK_SPECS) if s.model == "fact_transactions"],
            {**model_tables(wh), **source_tables(DriverTables(spark, sf_dir))}, dealt_by(wh)),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/plans.py` on `{os.path.basename(sf_dir)}` "
           "(AQE initial plans; small inputs make Spark pick broadcasts where the "
           "measured size allows — at scale the same plans use sort-merge joins).", ""]
    for title, df in items.items():
        out += [f"## {title}", "", "```", _plan(df), "```", ""]
    target = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                          "docs", "plans.md")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(target, "w") as f:
        f.write("\n".join(out))
    print(target)


if __name__ == "__main__":
    main()
