"""Lookup joins.

No side is ever forced to broadcast: Spark does so by itself when the measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise. Rows whose key is null and
keys named as hot are spread over ``salts`` reducers; hot keys nobody named are split at run time by
adaptive skew handling, which can do so because every lookup side is unique per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules as R
from ..functions import email as E, text as T
from ..functions.priority import has
from .dedup import first_wins

SALTS = 64

#: Public mail providers: the domains most likely to hold a large share of all addresses.
HOT_DOMAINS = ("gmail.com", "ukr.net", "i.ua", "meta.ua", "outlook.com", "hotmail.com")


def lookup_join(
    df: DataFrame, lookup: DataFrame, key: Column, lookup_key: str, values: dict[str, str],
    hot: tuple[str, ...] = (), salts: int = SALTS, salt_by: tuple[str, ...] = (),
) -> DataFrame:
    """Left join on a string key onto ``lookup``, which must be unique per ``lookup_key``.

    ``values`` maps lookup columns to their names in the result. The salt comes from a hash of
    ``salt_by`` (columns that tell rows apart), so a recomputed task places every row where the lost
    one did. Without it the number and time columns are used, which every table here has as ids; wide
    text and nested columns are never read for it.
    """
    salt_by = salt_by or _narrow(df)
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("string")
    mark = F.lit("\u0000")
    placed = F.when(key.isNull(), F.concat(mark, salt))
    if hot:
        placed = placed.when(key.isin(*hot), F.concat(key, mark, salt))
    left = df.withColumn("_key", placed.otherwise(key))

    right_key = F.col(lookup_key)
    right = lookup.select(right_key.alias("_rkey"), *[F.col(c).alias(n) for c, n in values.items()])
    if hot:
        copies = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.concat("_rkey", mark, s.cast("string")))
        right = right.withColumn(
            "_rkey", F.explode(F.when(F.col("_rkey").isin(*hot), copies).otherwise(F.array("_rkey"))))
    return left.join(right, left["_key"] == right["_rkey"], "left").drop("_key", "_rkey")


def _narrow(df: DataFrame) -> tuple[str, ...]:
    """Fixed-width columns, or the first plain column where there is none."""
    plain = [(c, t) for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "variant"))]
    return tuple(c for c, t in plain if t not in ("string", "binary")) or (plain[0][0],)


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list[str]:
    """Keys holding at least ``share`` of all rows: never more than ``1 / share`` of them.

    Runs one pre-aggregated count; its result can be passed as ``hot`` to the joins here.
    """
    counts = df.groupBy(key).count().filter(F.col(key).isNotNull())
    total = df.count()
    return [r[0] for r in counts.filter(F.col("count") >= max(1, share * total)).collect()]


# ------------------------------------------------------------------------------- plain joins
def counterparty_contacts(counterparties: DataFrame, register: DataFrame, key: str) -> DataFrame:
    """Every counterparty with each of its contact lines, or with nulls when it has none.

    Written as an inner join plus the counterparties without lines: an outer join could neither
    split a counterparty that owns a large share of the lines nor stream the lines past a small
    counterparty table.
    """
    with_lines = counterparties.join(register, key)
    without = counterparties.join(register.select(key).distinct(), key, "left_anti")
    return with_lines.unionByName(without, allowMissingColumns=True)


def verified_lookup(verified: DataFrame, name_col: str, columns, order) -> DataFrame:
    """Normalised name (``_name``) to the ``columns`` of the first verified row with it."""
    present = [c for c in columns if c in verified.columns]
    keyed = verified.withColumn("_name", T.norm_name(name_col))
    rows = keyed.select("_name", *present, *[c for c in order if c not in present])
    return first_wins(rows, ["_name"], order).select("_name", *present)


def attach_lookup(base: DataFrame, lookup: DataFrame, name_col: str) -> DataFrame:
    """Columns of a :func:`verified_lookup` by normalised name.

    A blank name matches a blank name, so "" is a likely hot key and is salted.
    """
    return lookup_join(base, lookup, T.norm_name(name_col), "_name", {c: c for c in lookup.columns[1:]}, hot=("",))


def attach_verified(base: DataFrame, verified: DataFrame, name_col: str, columns, order,
                    verified_name: str | None = None) -> DataFrame:
    """Verified columns by normalised name; the first verified row per name wins."""
    return attach_lookup(base, verified_lookup(verified, verified_name or name_col, columns, order), name_col)


def client_sales_left(clients: DataFrame, summary: DataFrame, key: str = "counterparty") -> DataFrame:
    """Clients with their sales summary; revenue falls back to the client's own amount."""
    return clients.join(summary, key, "left").withColumn(
        "revenue", F.coalesce(F.col("sales_amount"), F.col("amount")))


def tenders_semi(parties: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    return parties.join(accepted.select(key).distinct(), key, "left_semi")


def new_only(incoming: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return incoming.filter(has(key)).join(seen.select(key).distinct(), key, "left_anti")


def label_dim(df: DataFrame, labels, key: str, out: str = "label") -> DataFrame:
    """Code to label, the code itself where there is none.

    A dict is a rule list and becomes an expression; a DataFrame (code, label) becomes a join.
    """
    if isinstance(labels, dict):
        pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
        return df.withColumn(out, F.coalesce(F.try_element_at(pairs, F.col(key)), F.col(key)))
    code, label = labels.columns[:2]
    unique = labels.groupBy(code).agg(F.min(label).alias(label))
    joined = lookup_join(df, unique, F.col(key), code, {label: "_label"})
    return joined.withColumn(out, F.coalesce("_label", key)).drop("_label")


# ------------------------------------------------------------------------------- contact lookups
def _lookup(sources: DataFrame, key: Column, order, rule: R.EmailRule, min_len: int) -> DataFrame:
    usable = sources.withColumn("key", key).filter(
        (F.length("key") >= min_len) & E.email_ok("email", rule))
    best = first_wins(usable, ["key"], order)
    return best.select("key", E.normalise("email").alias("email"), "source")


def build_lookup_first_wins(sources: DataFrame, key: Column, order, rule=R.EMAIL_LOOSE_8, min_len=1) -> DataFrame:
    """key -> (email, source): the first source in rank order with a valid address wins."""
    return _lookup(sources, key, [F.asc(c) for c in order], rule, min_len)


def build_lookup_last_wins(sources: DataFrame, key: Column, order, rule=R.EMAIL_LOOSE_8, min_len=1) -> DataFrame:
    """key -> (email, source): a later source overwrites an earlier one."""
    return _lookup(sources, key, [F.desc(c) for c in order], rule, min_len)


def tiered_probe(keys: DataFrame, lookups: list[DataFrame]) -> DataFrame:
    """For rows of one key per tier (null: none), the values of the first tier whose lookup knows its key.

    ``keys`` has an ``_id`` that tells its rows apart and one column per lookup, named ``_0``, ``_1``, ...; each lookup has a
    unique ``key`` and the same further columns. All tiers are one join: the keys of a row become narrow rows
    (id, tier, key) that meet the union of the lookups, and the least tier found is taken per id.
    """
    values = [c for c in lookups[0].columns if c != "key"]
    tiers = F.array(*[F.struct(F.lit(n).alias("tier"), F.col(f"_{n}").alias("key")) for n in range(len(lookups))])
    probes = keys.select("_id", F.inline(F.filter(tiers, lambda t: t["key"].isNotNull())))
    known = reduce(DataFrame.unionByName, [t.select(F.lit(n).alias("tier"), "key", *values) for n, t in enumerate(lookups)])
    hits = probes.join(known, ["tier", "key"])
    return hits.groupBy("_id").agg(F.min(F.struct("tier", *values)).alias("_hit")).select("_id", "_hit.*")


def tiered_contact_match(df: DataFrame, by_id: DataFrame, by_name: DataFrame, by_phone: DataFrame,
                         rule: R.EmailRule = R.EMAIL_LOOSE_8) -> DataFrame:
    """Existing valid address, else by id, else by company name, else by phone.

    Rows with a valid address take part in no lookup. Of the others only their distinct combinations of keys are looked
    up, however many rows share one; the table itself meets the answers in one join. Adds ``found_email``,
    ``email_source`` and ``match_type``.
    """
    valid = E.email_ok("email", rule)
    tiers = [(by_id, T.clean_id("org_id"), 1), (by_name, T.clean_company("name"), 4), (by_phone, T.phone_last9("phone"), 9)]
    keyed = df.withColumns({f"_{n}": F.when(~valid & (F.length(key) >= least), key) for n, (_, key, least) in enumerate(tiers)})
    keys = [f"_{n}" for n in range(len(tiers))]
    # a combination as one string; no key holds the separator, as all are cleaned
    absent = F.lit("\u0001")
    combined = F.concat_ws("\u0002", *[F.coalesce(k, absent) for k in keys])
    keyed = keyed.withColumn("_id", F.when(F.coalesce(*keys).isNotNull(), combined))
    asked = keyed.select("_id", *keys).filter(F.col("_id").isNotNull()).distinct()
    answers = tiered_probe(asked, [lookup.select("key", "email", "source") for lookup, _, _ in tiers])
    out = lookup_join(keyed, answers, F.col("_id"), "_id", {"tier": "_tier", "email": "_email", "source": "_source"}, salt_by=_narrow(df))
    match = F.when(valid, R.MATCH_EXISTING[1])
    for n, label in enumerate((R.MATCH_ID, R.MATCH_NAME, R.MATCH_PHONE)):
        match = match.when(F.col("_tier") == n, label)
    return out.select(
        *df.columns,
        F.when(valid, T.strip("email")).otherwise(F.coalesce("_email", F.lit(""))).alias("found_email"),
        F.when(valid, R.MATCH_EXISTING[0]).when(F.col("_tier").isNotNull(), F.concat(F.lit(R.MATCH_PREFIX), "_source")).otherwise("").alias("email_source"),
        match.otherwise("").alias("match_type"),
    )


def match_multi_phone(df: DataFrame, row_id: str, phones: str, by_phone: DataFrame, out: str = "phone_email") -> DataFrame:
    """The first number of a delimited list that the lookup knows gives the address."""
    chunks = df.select(row_id, F.posexplode(F.split(T.null_to_empty(phones), "[;,/]")).alias("pos", "chunk"))
    keyed = chunks.select(row_id, "pos", T.phone_last9("chunk").alias("key")).filter("key <> ''")
    hits = keyed.join(by_phone.select("key", "email"), "key")
    best = hits.groupBy(row_id).agg(F.min_by("email", "pos").alias(out))
    return df.join(best, row_id, "left")


def domain_status(df: DataFrame, email: str, statuses: DataFrame, rule: R.EmailRule = R.EMAIL_LOOSE_8,
                  out: str = "active", hot=HOT_DOMAINS) -> DataFrame:
    """Adds whether the domain of a valid address answers; unknown domains count as not."""
    known = statuses.groupBy("domain").agg(F.max("active").alias("active"))
    key = F.when(E.email_ok(email, rule), E.domain_of(E.normalise(email)))
    joined = lookup_join(df, known, key, "domain", {"active": "_known"}, hot=hot)
    return joined.withColumn(out, F.coalesce("_known", F.lit(False))).drop("_known")


def first_valid_from_registry(registry: DataFrame, rule: R.EmailRule = R.EMAIL_SUFFIX_ONLY,
                              min_len: int = 6) -> DataFrame:
    """Per zero-stripped id the first valid address, registries in rank order, items in order."""
    usable = registry.withColumn("org_id", T.strip_zeros("org_id")).filter(
        (F.length("org_id") >= min_len) & E.email_ok("email", rule))
    best = first_wins(usable, ["org_id"], ["registry_rank", "pos"])
    return best.select("org_id", T.strip("email").alias("email"), "registry")


def fill_from_registry(df: DataFrame, registry: DataFrame, email: str = "email", source: str = "email_source",
                       status: str = "mx_status") -> DataFrame:
    """Fills address, source and status of rows without an address; others keep theirs."""
    blank = T.blank_to_null(email).isNull()
    key = F.when(blank, F.nullif(T.strip_zeros("org_id"), F.lit("")))
    joined = lookup_join(df, registry, key, "org_id", {"email": "_reg_email", "registry": "_reg_source"})
    hit = F.col("_reg_email").isNotNull()
    return joined.select(
        *[c for c in df.columns if c not in (email, source, status)],
        F.when(hit, F.col("_reg_email")).otherwise(T.null_to_empty(email)).alias(email),
        F.when(hit, F.col("_reg_source")).otherwise(T.null_to_empty(source)).alias(source),
        F.when(hit, F.lit(R.MX_ACTIVE_LABEL)).otherwise(T.null_to_empty(status)).alias(status),
    )


def fill_missing_only(df: DataFrame, pages: DataFrame, preset: str = "first", email: str = "email",
                      phone: str = "phone", min_len: int = 8, order=None, phones: int | None = 2) -> DataFrame:
    """Fills a missing address or phone from the directory page found for the row's key.

    ``pages`` holds (key, html): one page per key, or several of which the first by ``order``
    counts. ``preset`` "first" takes the first address in
    page order and treats only an address with "@" and a phone longer than 5 as present;
    "sorted" takes the alphabetically first and treats any non-blank value as present. Of a page's
    phones the ``phones`` smallest are taken (None: all). Only pages whose key misses something are read.
    """
    cur_email, cur_phone = T.strip(T.null_to_empty(email)), T.strip(T.null_to_empty(phone))
    has_email = ~cur_email.isin("", "nan")
    has_phone = ~cur_phone.isin("", "nan")
    if preset == "first":
        has_email = has_email & cur_email.contains("@")
        has_phone = has_phone & (F.length(cur_phone) > 5)
    key = F.when(~(has_email & has_phone), T.lookup_key("org_id", "name", min_len))
    if preset == "first":
        found = T.extract_emails("html")
    else:
        found = F.array_sort(T.extract_emails("html", R.IGNORE_TOKENS_DOMAIN, "domain"))
    every = F.array_sort(F.array_distinct(T.extract_phones("html")))
    taken = every if phones is None else F.slice(every, 1, phones)
    missing = df.select(key.alias("key")).filter("key is not null").distinct()
    pages = pages.join(missing, "key", "left_semi")
    pages = first_wins(pages, ["key"], order) if order else pages
    contacts = pages.select(
        "key", F.get(found, F.lit(0)).alias("page_email"), F.array_join(taken, ", ").alias("page_phone"))
    joined = lookup_join(df, contacts, key, "key", {"page_email": "_page_email", "page_phone": "_page_phone"})
    return joined.select(
        *[c for c in df.columns if c not in (email, phone)],
        F.when(has_email | F.col("_page_email").isNull(), F.col(email)).otherwise(F.col("_page_email")).alias(email),
        F.when(has_phone | ~has("_page_phone"), F.col(phone)).otherwise(F.col("_page_phone")).alias(phone),
    )


# ------------------------------------------------------------------------------- overlays
def apply_reclass(main: DataFrame, excluded: DataFrame, overlay: DataFrame, row_id: str = "row_id"):
    """Lays (row id -> new status, reason) over main, then splits it again.

    Returns the kept rows and all excluded ones (old and new, bag semantics).
    """
    fresh = overlay.select(row_id, F.col("status").alias("_status"), F.col("reason").alias("_reason"))
    merged = (
        main.join(fresh, row_id, "left")
        .withColumn("status", F.coalesce("_status", "status"))
        .withColumn("reason", F.coalesce("_reason", "reason"))
        .drop("_status", "_reason")
    )
    kept = merged.filter(F.col("status").isin(R.PARTNER_OK, R.PARTNER_CHECK))
    return kept, excluded.unionByName(merged.filter(F.col("status") == R.PARTNER_REJECT))


def apply_invalid(df: DataFrame, verdicts: DataFrame, row_id: str = "row_id", email: str = "email"):
    """Blanks failed addresses and sets their reason; also returns the rejects with the original."""
    failed = verdicts.filter(~F.col("ok")).select(row_id, F.col("verdict").alias("_verdict"))
    joined = df.join(failed, row_id, "left")
    bad = F.col("_verdict").isNotNull()
    cleaned = (
        joined.withColumn(email, F.when(bad, "").otherwise(F.col(email)))
        .withColumn("reason", F.when(bad, F.col("_verdict")).otherwise(F.col("reason")))
        .drop("_verdict")
    )
    rejects = joined.filter(bad).select("name", email, F.col("_verdict").alias("reason"))
    return cleaned, rejects
