"""The model catalogue: which bronze table feeds which hub, link and
satellite, with which columns, casts and key widths."""

from __future__ import annotations

from tessera.operators.vault import Attr, HubSpec, LinkSpec, SatSpec
from tessera.schemas import ID_WIDTH, SOURCE_SCHEMAS, TRANSACTION_ID_WIDTH

# bronze model name per source, columns = the declared source columns
BRONZE = {src: f"bronze_{src}" for src in SOURCE_SCHEMAS}
BRONZE_COLUMNS = {src: [f.name for f in schema.fields] for src, schema in SOURCE_SCHEMAS.items()}

HUBS = [
    HubSpec("hub_customer", "customers", "customer_id", "customer_hub_key", ID_WIDTH),
    HubSpec("hub_account", "accounts", "account_id", "account_hub_key", ID_WIDTH),
    HubSpec("hub_card", "cards", "card_id", "card_hub_key", ID_WIDTH),
    HubSpec("hub_branch", "branches", "branch_id", "branch_hub_key", ID_WIDTH),
    HubSpec("hub_loan", "loans", "loan_id", "loan_hub_key", ID_WIDTH),
    HubSpec("hub_merchant", "merchants", "merchant_id", "merchant_hub_key", ID_WIDTH),
    HubSpec("hub_transaction", "transactions", "transaction_id", "transaction_hub_key",
            TRANSACTION_ID_WIDTH),
]

LINKS = [
    LinkSpec("link_customer_account", "accounts", "customer_account_link_key",
             (("customer_hub_key", "customer_id"), ("account_hub_key", "account_id"))),
    LinkSpec("link_account_card", "cards", "account_card_link_key",
             (("account_hub_key", "account_id"), ("card_hub_key", "card_id"))),
    LinkSpec("link_customer_loan", "loans", "customer_loan_link_key",
             (("customer_hub_key", "customer_id"), ("loan_hub_key", "loan_id"))),
    LinkSpec("link_account_merchant", "transactions", "transaction_account_merchant_link_key",
             (("transaction_hub_key", "transaction_id"), ("account_hub_key", "account_id"),
              ("merchant_hub_key", "merchant_id")), bucket_key="transaction_hub_key"),
]

SATELLITES = [
    SatSpec("sat_customer_details", "customers", "customer_id", "customer_hub_key", (
        Attr("first_name"), Attr("last_name"), Attr("email"), Attr("city"),
        Attr("credit_score", dtype="int"), Attr("created_date", "created_at", "date")),
        snapshot=True),
    SatSpec("sat_account_details", "accounts", "account_id", "account_hub_key", (
        Attr("account_type"), Attr("balance_usd", dtype="decimal(15,2)"),
        Attr("open_date", dtype="date")),
        snapshot=True),
    SatSpec("sat_card_details", "cards", "card_id", "card_hub_key", (
        Attr("card_type"), Attr("expiration_date", dtype="date"))),
    SatSpec("sat_branch_details", "branches", "branch_id", "branch_hub_key", (
        Attr("branch_name"), Attr("city"), Attr("country"), Attr("manager_name"))),
    SatSpec("sat_loan_details", "loans", "loan_id", "loan_hub_key", (
        Attr("loan_amount", dtype="decimal(15,2)"), Attr("interest_rate", dtype="decimal(5,2)"),
        Attr("start_date", dtype="date"))),
    SatSpec("sat_merchant_details", "merchants", "merchant_id", "merchant_hub_key", (
        Attr("merchant_name"), Attr("city"))),
    SatSpec("sat_transaction_details", "transactions", "transaction_id", "transaction_hub_key", (
        Attr("amount_usd", dtype="decimal(15,2)"),
        Attr("transaction_date", dtype="timestamp_ntz"))),
]

HUB = {h.name: h for h in HUBS}
LINK = {k.name: k for k in LINKS}
SAT = {s.name: s for s in SATELLITES}

SILVER_MODELS = [*HUB, *LINK, *SAT]
GOLD_DIMS = ["dim_date", "dim_branch", "dim_merchant", "dim_card", "dim_account", "dim_customer"]
GOLD_FACTS = ["fact_transactions", "fact_loans", "fact_account_balance"]


def silver_for_source(source: str) -> tuple[list[HubSpec], list[LinkSpec], list[SatSpec]]:
    return ([h for h in HUBS if h.source == source],
            [k for k in LINKS if k.source == source],
            [s for s in SATELLITES if s.source == source])
