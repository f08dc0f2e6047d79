"""Declared input schemas: all nullable, all text unless noted."""

from __future__ import annotations


def _strings(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


RAW_REGISTRY = _strings(
    "email name short_name city org_id activity_code activity_label director address phone phones "
    "website url products_services source target_profile")
COMPANY_DIRECTORY = _strings("email org_id fop_id name phones")
LISTING_COMPANY = _strings("name address phone email")

_PARTY = (
    "name: string, identifier: struct<id: string, legalName: string>, "
    "contactPoint: struct<name: string, email: string, telephone: string>, "
    "address: struct<streetAddress: string, locality: string, region: string>, "
    "signerInfo: struct<name: string, email: string, telephone: string>"
)
PARTY = f"struct<{_PARTY}>"

TENDER = f"""
id string, tenderID string, title string, description string, status string,
value struct<amount: double>,
procuringEntity {PARTY},
items array<struct<description: string, unit: struct<code: string>, classification: struct<id: string>>>,
awards array<struct<status: string, value: struct<amount: double>, suppliers: array<{PARTY}>>>,
bids array<struct<status: string, value: struct<amount: double>, tenderers: array<{PARTY}>>>
"""

CONTRACT = f"""
id string, contractID string, status string, dateSigned string,
value struct<amount: double>, buyer {PARTY}, suppliers array<{PARTY}>
"""

SALES_LINE = """
base string, counterparty string, item string, item_group string, amount decimal(18,2), qty decimal(18,3)
"""
CLIENT = "counterparty string, amount decimal(18,2), ops int, code string, client_group string, bases string"
ECOMMERCE_CUSTOMER = """
customer_id string, firstname string, lastname string, email string, telephone string, newsletter int,
orders_completed int, orders_total decimal(18,2), last_order_date string, date_added string
"""
CONTACT_REGISTER = (
    _strings("code name legal_name org_id tax_id person kind value") + ", pos int")
SNAPSHOT = """
snapshot_id string, source_id string, provider_version string, url string, size_bytes bigint,
record_count bigint, downloaded_at timestamp
"""

# Header spellings accepted for each column of a contact CSV, best first.
CSV_ALIASES = {
    "email": ("email",),
    "org_id": ("edrpou", "код єдрпоу", "єдрпоу"),
    "name": ("name", "назва", "компанія"),
    "phone": ("phones", "phone", "телефон"),
}
