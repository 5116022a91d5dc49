"""The data-test catalogue: 209 checks over sources, bronze, silver and gold.

Families: key and id uniqueness, not-null, referential integrity (links and
satellites to their hubs, facts to hubs and the calendar), satellite and
link grain, and "exactly one current version" per dimension entity.
"""

from __future__ import annotations

from tessera.operators.checks import CheckSpec
from tessera.plans.models import HUBS, LINKS, SATELLITES

HUB_OF_KEY = {h.key_col: h.name for h in HUBS}


def _unique(model: str, *cols: str) -> list[CheckSpec]:
    return [CheckSpec(model, "unique", (c,)) for c in cols]


def _not_null(model: str, *cols: str) -> list[CheckSpec]:
    return [CheckSpec(model, "not_null", (c,)) for c in cols]


def _rel(model: str, col: str, to: str, field: str | None = None) -> CheckSpec:
    return CheckSpec(model, "relationships", (col,), to=to, field=field or col)


def _combo(model: str, *cols: str, where: str | None = None) -> CheckSpec:
    return CheckSpec(model, "unique_combination", tuple(cols), where=where)


def _build() -> list[CheckSpec]:
    specs: list[CheckSpec] = []
    source_ids = {"customers": "customer_id", "accounts": "account_id", "cards": "card_id",
                  "branches": "branch_id", "loans": "loan_id", "merchants": "merchant_id",
                  "transactions": "transaction_id"}
    # raw sources and bronze
    for src, id_col in source_ids.items():
        specs += _unique(f"source_{src}", id_col) + _not_null(f"source_{src}", id_col)
    for src, id_col in source_ids.items():
        specs += _unique(f"bronze_{src}", id_col) + _not_null(f"bronze_{src}", id_col,
                                                              "record_source")
    # hubs
    for h in HUBS:
        specs += _unique(h.name, h.key_col, h.id_col)
        specs += _not_null(h.name, h.key_col, h.id_col, "load_date")
    # links
    for k in LINKS:
        hub_keys = [hk for hk, _ in k.hubs]
        specs += _unique(k.name, k.link_key)
        specs += _not_null(k.name, k.link_key, *hub_keys, "load_date")
        specs += [_rel(k.name, hk, HUB_OF_KEY[hk]) for hk in hub_keys]
        specs.append(_combo(k.name, *hub_keys))
    # satellites
    for s in SATELLITES:
        specs += _not_null(s.name, s.key_col, "hashdiff", "load_date")
        specs.append(_rel(s.name, s.key_col, HUB_OF_KEY[s.key_col]))
        specs.append(_combo(s.name, s.key_col, "load_date"))
    # gold dimensions
    specs += _unique("dim_date", "date_key") + _not_null("dim_date", "date_key")
    specs += _unique("dim_customer", "customer_key")
    specs += _not_null("dim_customer", "customer_key", "customer_hub_key", "customer_id",
                       "credit_tier", "acquisition_month", "total_account_count",
                       "checking_account_count", "savings_account_count", "total_loan_count",
                       "total_loan_amount", "effective_start_date", "is_current")
    specs.append(_combo("dim_customer", "customer_hub_key", where="is_current"))
    for entity in ["account", "card", "merchant", "branch"]:
        model = f"dim_{entity}"
        specs += _unique(model, f"{entity}_key")
        specs += _not_null(model, f"{entity}_key", f"{entity}_hub_key", f"{entity}_id",
                           "effective_start_date", "is_current")
        specs.append(_combo(model, f"{entity}_hub_key", where="is_current"))
    # facts
    specs += _unique("fact_transactions", "transaction_hub_key")
    specs += _not_null("fact_transactions", "transaction_hub_key", "account_hub_key",
                       "merchant_hub_key", "customer_hub_key", "date_key", "amount_usd")
    specs += [_rel("fact_transactions", "account_hub_key", "hub_account"),
              _rel("fact_transactions", "merchant_hub_key", "hub_merchant"),
              _rel("fact_transactions", "customer_hub_key", "hub_customer"),
              _rel("fact_transactions", "date_key", "dim_date")]
    specs += _unique("fact_loans", "loan_hub_key")
    specs += _not_null("fact_loans", "loan_hub_key", "customer_hub_key", "date_key",
                       "loan_amount", "interest_rate")
    specs += [_rel("fact_loans", "customer_hub_key", "hub_customer"),
              _rel("fact_loans", "date_key", "dim_date")]
    specs += _unique("fact_account_balance", "account_hub_key")
    specs += _not_null("fact_account_balance", "account_hub_key", "customer_hub_key",
                       "date_key", "balance_usd")
    specs += [_rel("fact_account_balance", "customer_hub_key", "hub_customer"),
              _rel("fact_account_balance", "date_key", "dim_date")]
    return specs


CHECK_SPECS: list[CheckSpec] = _build()
