"""Nested tender and contract documents to flat rows, and projections to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules as R
from ..functions import classify as C, email as E, text as T
from .dedup import first_wins


def _text(path) -> Column:
    return T.null_to_empty(path)


def _first_filled(*paths) -> Column:
    """First value that is neither null nor "", else ""."""
    return F.coalesce(*[T.empty_to_null(p) for p in paths], F.lit(""))


def _amount(c) -> Column:
    """Zero counts as missing."""
    return F.nullif(T.col(c), F.lit(0.0))


def _with_ids(tenders: DataFrame) -> DataFrame:
    """Tender id (``tenderID``, else ``id``), category, amount and buyer name; no id, no row."""
    return (
        tenders.withColumn("tender_id", F.coalesce(T.empty_to_null("tenderID"), T.empty_to_null("id")))
        .filter(F.col("tender_id").isNotNull())
        .withColumn("category", C.product_category("title", "description"))
        .withColumn("subject", _text("title"))
        .withColumn("amount", F.coalesce(_amount("value.amount"), F.lit(0.0)))
        .withColumn("buyer_name", _first_filled("procuringEntity.name", "procuringEntity.identifier.legalName"))
        .withColumn("url", F.concat(F.lit(R.TENDER_URL), "tender_id"))
    )


def tender_buyers(tenders: DataFrame, order, rule: R.EmailRule = R.EMAIL_STRICT) -> DataFrame:
    """One row per (tender, buyer id); the first document in ``order`` wins."""
    p = "procuringEntity"
    rows = _with_ids(tenders).select(
        *order, "tender_id", "category", "subject", "amount",
        F.coalesce(T.empty_to_null("status"), F.lit("active")).alias("status"), "buyer_name",
        _text(f"{p}.identifier.id").alias("buyer_id"),
        T.strip(_text(f"{p}.contactPoint.name")).alias("contact"),
        E.valid_or_empty(f"{p}.contactPoint.email", rule).alias("email"),
        T.strip(_text(f"{p}.contactPoint.telephone")).alias("phone"),
        _text(f"{p}.address.locality").alias("city"), _text(f"{p}.address.region").alias("region"), "url",
    )
    return first_wins(rows, ["tender_id", "buyer_id"], order).drop(*order)


def _parties(tenders: DataFrame, order, outer: str, inner: str, amount: Column, rule: R.EmailRule,
             accepted: DataFrame | None) -> DataFrame:
    """Two-level flattening of ``outer`` (awards or bids) and ``inner`` (its parties).

    With ``accepted`` only parties of the tenders it names (``tender_id``) are kept, before any is compared with others; the
    deduplication then runs on the partitioning of that join.
    """
    base = _with_ids(tenders).select(
        *order, "tender_id", "subject", "amount", "buyer_name", "url",
        F.posexplode(outer).alias("_pos", "_outer"))
    party = base.select("*", F.posexplode(f"_outer.{inner}").alias("_ipos", "_p"))
    rows = party.select(
        *order, "_pos", "_ipos", "tender_id", F.col("_outer.status").alias("status"),
        _first_filled("_p.name", "_p.identifier.legalName").alias("party_name"),
        _text("_p.identifier.id").alias("party_id"), amount.alias("party_amount"),
        T.strip(_text("_p.contactPoint.name")).alias("contact"),
        E.valid_or_empty("_p.contactPoint.email", rule).alias("email"),
        T.strip(_text("_p.contactPoint.telephone")).alias("phone"),
        _text("_p.address.locality").alias("city"), "subject", "buyer_name", "url",
    )
    if accepted is not None:
        rows = rows.join(accepted.select("tender_id").distinct(), "tender_id", "left_semi")
    keys = ["tender_id", "party_id", "party_name"]
    return first_wins(rows, keys, [*order, "_pos", "_ipos"]).drop(*order, "_pos", "_ipos")


def tender_winners(tenders: DataFrame, order, rule: R.EmailRule = R.EMAIL_STRICT, accepted: DataFrame | None = None) -> DataFrame:
    """Awards by suppliers; the amount is the award's, else the tender's."""
    amount = F.coalesce(_amount("_outer.value.amount"), "amount")
    return _parties(tenders, order, "awards", "suppliers", amount, rule, accepted)


def tender_bidders(tenders: DataFrame, order, rule: R.EmailRule = R.EMAIL_STRICT, accepted: DataFrame | None = None) -> DataFrame:
    amount = F.coalesce(_amount("_outer.value.amount"), F.lit(0.0))
    return _parties(tenders, order, "bids", "tenderers", amount, rule, accepted)


def tender_row(tenders: DataFrame, drop_empty: bool = True, item_texts: int | None = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One flat row per tender: the first ``item_texts`` item texts (None: all), sorted class codes, buyer fields.

    ``drop_empty`` is the text-search form (empty item texts and codes left out, wider fallbacks,
    full-match address); without it the class-code form. ``keep`` names input columns carried along.
    """
    p = "procuringEntity"
    items = F.col("items")
    shown = items if item_texts is None else F.slice(items, 1, item_texts)
    texts = F.transform(shown, lambda i: _text(i["description"]))
    codes = F.array_sort(F.array_distinct(F.transform(items, lambda i: _text(i["classification"]["id"]))))
    if drop_empty:
        texts = F.filter(texts, lambda d: d != "")
        codes = F.filter(codes, lambda c: c != "")
        tid, buyer, rule = _first_filled("tenderID", "id"), _first_filled(f"{p}.name", f"{p}.identifier.legalName"), R.EMAIL_FULL
        url = F.when(tid != "", F.concat(F.lit(R.TENDER_URL), tid)).otherwise("")
    else:
        tid, buyer, rule = _text("id"), _text(f"{p}.name"), R.EMAIL_PREFIX
        url = F.concat(F.lit(R.TENDER_URL), tid)
    email = T.strip(_text(f"{p}.contactPoint.email"))
    return tenders.select(
        tid.alias("tender_id"),
        _first_filled(F.array_join(texts, "; "), "title").alias("subject"),
        T.null_to_empty(F.array_join(codes, ", ")).alias("class_codes"),
        F.coalesce("value.amount", F.lit(0.0)).alias("amount"),
        _text("status").alias("status"), buyer.alias("buyer_name"),
        _text(f"{p}.identifier.id").alias("buyer_id"),
        F.when(E.email_ok(email, rule), email).otherwise("").alias("email"),
        T.strip(_text(f"{p}.contactPoint.telephone")).alias("phone"),
        _text(f"{p}.address.locality").alias("city"), _text(f"{p}.address.region").alias("region"),
        url.alias("url"), *keep,
    )


def contract_row(contracts: DataFrame, rule: R.EmailRule = R.EMAIL_FULL, keep: tuple[str, ...] = ()) -> DataFrame:
    """Buyer fields, first supplier, amount and signing day of each contract (unfiltered).

    ``keep`` names input columns carried along.
    """
    cid = _first_filled("contractID", "id")
    email = T.strip(_text("buyer.contactPoint.email"))
    supplier = F.get("suppliers", F.lit(0))
    return contracts.select(
        cid.alias("contract_id"), F.substring(_text("dateSigned"), 1, 10).alias("signed"),
        F.coalesce("value.amount", F.lit(0.0)).alias("amount"),
        _text(supplier["name"]).alias("supplier_name"),
        _text(supplier["identifier"]["id"]).alias("supplier_id"),
        _first_filled("buyer.name", "buyer.identifier.legalName").alias("buyer_name"),
        _text("buyer.identifier.id").alias("buyer_id"),
        F.when(E.email_ok(email, rule), email).otherwise("").alias("email"),
        T.strip(_text("buyer.contactPoint.telephone")).alias("phone"),
        _text("buyer.address.locality").alias("city"), _text("buyer.address.region").alias("region"),
        _text("status").alias("status"),
        F.when(cid != "", F.concat(F.lit(R.CONTRACT_URL), cid)).otherwise("").alias("url"), *keep,
    )


def supplier_contact_row(contracts: DataFrame, rule: R.EmailRule = R.EMAIL_FULL, keep: tuple[str, ...] = (), named: bool = True) -> DataFrame:
    """Contacts of the first supplier, signer before contact point; with ``named`` nameless ones are dropped.

    ``keep`` names input columns carried along.
    """
    s = contracts.withColumn("_s", F.get("suppliers", F.lit(0)))
    email = E.normalise(_first_filled("_s.signerInfo.email", "_s.contactPoint.email"))
    parts = [_text("_s.address.streetAddress"), _text("_s.address.locality"), _text("_s.address.region")]
    address = F.btrim(F.concat(parts[0], F.lit(", "), parts[1], F.lit(", "), parts[2]), F.lit(", "))
    rows = s.select(
        _first_filled("_s.name", "_s.identifier.legalName").alias("supplier_name"),
        _text("_s.identifier.id").alias("supplier_id"),
        _first_filled("_s.signerInfo.name", "_s.contactPoint.name").alias("signer"),
        F.when(E.email_ok(email, rule), email).otherwise("").alias("email"),
        T.strip(_first_filled("_s.signerInfo.telephone", "_s.contactPoint.telephone")).alias("phone"),
        parts[1].alias("city"), parts[2].alias("region"), address.alias("address"),
        _first_filled("contractID", "id").alias("contract_id"),
        F.coalesce("value.amount", F.lit(0.0)).alias("amount"),
        F.substring(_text("dateSigned"), 1, 10).alias("signed"), *keep,
    )
    return rows.filter("supplier_name <> ''") if named else rows


def customer_profile(customers: DataFrame) -> DataFrame:
    full = T.strip(F.concat(_text("firstname"), F.lit(" "), _text("lastname")))
    news = F.when(F.col("newsletter") == 1, R.SUBSCRIBED).when(F.col("newsletter") == 0, R.NOT_SUBSCRIBED)
    return customers.select(
        "customer_id", full.alias("full_name"), "email", F.col("telephone").alias("phone"),
        news.alias("newsletter"), "orders_completed", "orders_total", "last_order_date", "date_added",
    ).orderBy(F.desc_nulls_last("orders_total"), "customer_id")


#: Presentation names of the client table.
CLIENT_NAMES = {
    "amount": "total_revenue", "ops": "operations", "code": "erp_code", "client_group": "counterparty_group",
    "bases": "source_bases",
}


def client_rename_sorted(clients: DataFrame, names: dict[str, str] = CLIENT_NAMES, by: str = "amount",
                         tiebreak: str = "counterparty") -> DataFrame:
    return clients.orderBy(F.desc_nulls_last(by), tiebreak).withColumnsRenamed(names)


def lead_projection(raw: DataFrame, spec: dict) -> DataFrame:
    """Raw record to the lead schema.

    ``spec`` maps each output column to a Column, to a column name, or to (column name, default)
    where the default stands in for a missing value.
    """
    def build(value):
        if isinstance(value, tuple):
            return F.coalesce(F.col(value[0]), F.lit(value[1]))
        return T.null_to_empty(value) if isinstance(value, str) else value

    return raw.select(*[build(v).alias(name) for name, v in spec.items()])


def column_superset(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both inputs with the ordered union of their columns, null where one has none."""
    names = list(dict.fromkeys(a.columns + b.columns))
    types = {f.name: f.dataType for df in (b, a) for f in df.schema.fields}

    def widen(df):
        return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(types[n]).alias(n) for n in names])

    return widen(a), widen(b)
