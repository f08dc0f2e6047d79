"""Personal data by weak supervision.

1. Patterns find the base spans (e-mail, IP address, payment card, phone) and looser candidates: spelled-out
   e-mail addresses, IPv6 addresses, phone and card numbers in other notations.
2. Seven labelers (patterns, checksum, a gazetteer of top-level domains, one of calling codes, card issuers and reserved
   addresses, two on the words before, format) vote +1, -1 or not
   at all on every span.
3. Expectation-maximisation over the counts of vote patterns (at most 3^7 rows) estimates how reliable each
   labeler is and how likely each vote pattern means personal data.
4. Those probabilities are soft labels for the final classifier, naive Bayes over features of the span itself
   (kind, shape, number of digits, what stands before). It decides which candidates are added.

Base spans are always kept. Everything is built-in functions; the text is scanned once, its spans are
written to the shared folder and both training and the result read them from there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

KINDS = ("email", "ip", "card", "phone")

# --- fixed values: base patterns -------------------------------------------------------------------
# Written so that the engine neither recurses nor tries every start inside one long run: a run of local-part
# characters is entered at its start or where the last match ended, and all repeats are possessive.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"

# --- fixed values: candidate patterns --------------------------------------------------------------
SPELLED = (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]++"
           r"(?: ?[\[(]dot[\])] ?| dot )[A-Za-z]{2,12}(?![A-Za-z0-9])")
NUMBERS = (r"(?<![0-9A-Za-z.:+@_=/#-])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
           r"|\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}"
           r"|[0-9]{4}(?:[./][0-9]{4}){3})(?![0-9A-Za-z@_:/-])")

# --- fixed values: gazetteers and context words ------------------------------------------------------
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "int", "mil", "info", "biz", "name", "io", "co", "me", "eu", "de", "fr",
               "es", "it", "nl", "be", "at", "ch", "uk", "ie", "pl", "cz", "pt", "se", "no", "dk", "fi", "ua", "us", "ca",
               "mx", "br", "ar", "cl", "au", "nz", "jp", "cn", "in", "kr", "za", "tr", "gr", "ro", "hu", "test", "example")
#: Country calling codes with the least and most digits that follow them.
CALLING_CODES = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9),
    "36": (8, 9), "39": (6, 11), "40": (9, 9), "41": (9, 9), "43": (7, 13), "44": (9, 10), "45": (8, 8), "46": (7, 10), "47": (8, 8),
    "48": (9, 9), "49": (6, 11), "51": (8, 9), "52": (10, 10), "53": (6, 8), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (8, 10),
    "58": (10, 10), "60": (8, 10), "61": (9, 9), "62": (8, 12), "63": (8, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10),
    "82": (8, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10), "94": (9, 9), "98": (10, 10),
    "212": (9, 9), "213": (8, 9), "216": (8, 8), "234": (8, 10), "254": (9, 9), "351": (9, 9), "352": (6, 9), "353": (7, 9), "354": (7, 7),
    "355": (8, 9), "356": (8, 8), "357": (8, 8), "358": (6, 10), "359": (8, 9), "370": (8, 8), "371": (8, 8), "372": (7, 8), "373": (8, 8),
    "375": (9, 9), "380": (9, 9), "381": (8, 9), "385": (8, 9), "386": (8, 8), "387": (8, 8), "389": (8, 8), "420": (9, 9), "421": (9, 9),
    "852": (8, 8), "886": (8, 9), "966": (9, 9), "971": (8, 9), "972": (8, 9), "995": (9, 9)}
#: Card number ranges of the issuers: leading digits and the numbers of digits that follow them.
ISSUERS = (("4", "12,15,18"), ("5[1-5]", "14"), ("222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720", "12"), ("3[47]", "13"), ("30[0-5]", "11"),
           ("3[689]", "12"), ("352[89]|35[3-8][0-9]", "12"), ("6011", "12,15"), ("64[4-9]", "13"), ("65", "14"), ("62", "14,15,16,17"),
           ("5018|5020|5038|5893|6304|6759|676[1-3]", "8,9,10,11,12,13,14,15"))
#: Address ranges that belong to nobody in public: private, loopback, link-local, documentation, benchmarks, multicast and above.
RESERVED = (r"^0*(?:0|10|127|22[4-9]|2[34][0-9]|25[0-5])\.|^0*169\.0*254\.|^0*172\.0*(?:1[6-9]|2[0-9]|3[01])\.|^0*192\.0*168\."
            r"|^0*192\.0+\.0*2\.|^0*198\.0*(?:18|19)\.|^0*198\.0*51\.0*100\.|^0*203\.0+\.0*113\.")
FOR_WORDS = r"(?i)(?:tel|telefon|telefono|téléphone|phone|mobile|cell|call|fax|e-?mail|mail|contact|reach|write|card|visa|mastercard|account|ip|address|host|server|client)[^A-Za-z0-9]*$"
AGAINST_WORDS = r"(?i)(?:(?:version|isbn|issn|order|invoice|ref|no\.|section|page|license|licence|build|part|serial|doi)[^A-Za-z0-9]*|[=#\"])$"

CALLABLE = "^(?:" + "|".join(f"{code}[0-9]{{{low},{high}}}" for code, (low, high) in CALLING_CODES.items()) + ")$"
ISSUED = "^(?:" + "|".join(f"(?:{head})[0-9]{{{n}}}" for head, rest in ISSUERS for n in rest.split(",")) + ")$"
SPAN = "struct<s:int,kind:int,e:int,hit:string,before:string>"
LABELERS = 7
EM_ROUNDS = 30
SLOTS = 64
BLOCK = 64
PIECE_BITS = 8


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _scan(values: Column, join, zero: int, levels: int = 2) -> Column:
    """For every entry of an int array, all entries before it joined (an associative ``join``, ``zero`` its neutral value).

    A fold that appends copies all it has, so blocks of :data:`BLOCK` entries are folded, then the blocks' totals:
    the copying stays a small multiple of the entries, also for hundreds of thousands of them.
    """
    def fold(xs: Column) -> Column:
        start = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    if not levels:
        return fold(values)["out"]

    def joined(blocks: Column) -> Column:
        return F.flatten(F.zip_with(blocks["out"], _scan(blocks["at"], join, zero, levels - 1), lambda out, at: F.transform(out, lambda x: join(at, x))))

    def in_blocks(xs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        return F.when(F.size(xs) <= BLOCK, fold(xs)["out"]).otherwise(
            _let(F.transform(numbers, lambda i: fold(F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)))), joined))

    return _let(values, in_blocks)


def _found(text: Column, pattern: str, kind, test=None) -> Column:
    """Array of spans of the pattern's matches that pass ``test``: code points, end exclusive.

    The text between the matches comes from a split, the matches from an extract, in step; offsets
    are the running sum of both lengths.
    """
    def spans(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0)))
        placed = F.zip_with(pairs, _scan(sizes, lambda a, b: a + b, 0), lambda x, at: F.struct(
            (at + F.length(x["gap"])).alias("s"), x["gap"].alias("gap"), x["hit"].alias("hit")))
        passed = F.filter(placed, lambda x: x["hit"].isNotNull() & (test(x["hit"]) if test else F.lit(True)))
        return F.transform(passed, lambda x: F.struct(
            x["s"].alias("s"), (kind(x["hit"]) if callable(kind) else F.lit(kind)).alias("kind"), (x["s"] + F.length(x["hit"])).alias("e"),
            x["hit"].alias("hit"), F.right(x["gap"], F.lit(24)).alias("before")))

    return _let(F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                           lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))), spans)


def _apart(more: Column, base: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``, by start.

    In the order of starts, a span overlaps a base span if one before it ends after its start or one behind it starts
    before its end; equal starts are seen from both sides.
    """
    def tagged(spans: Column, fixed: bool) -> Column:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(fixed).alias("fixed"), x.alias("span")))

    def free(both: Column) -> Column:
        far = 2**31 - 1
        reach = _scan(F.transform(both, lambda x: F.when(x["fixed"], x["span"]["e"]).otherwise(0)), F.greatest, 0)
        ahead = F.reverse(_scan(F.transform(F.reverse(both), lambda x: F.when(x["fixed"], -x["s"]).otherwise(-far)), F.greatest, -far))
        left = F.zip_with(both, reach, lambda x, end: F.struct(x["span"].alias("span"), (~x["fixed"] & (end <= x["s"])).alias("free")))
        right = F.zip_with(left, ahead, lambda x, start: F.struct(x["span"].alias("span"), (x["free"] & (-start >= x["span"]["e"])).alias("free")))
        return F.transform(F.filter(right, lambda x: x["free"]), lambda x: x["span"])

    return _let(F.array_sort(F.concat(tagged(base, True), tagged(more, False))), free)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_base`` and ``_more``: arrays of base spans by start, then kind, and of candidates beside them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    digit = text.rlike("[0-9]")

    def when(test: Column, spans: Column) -> Column:
        return F.when(test, spans).otherwise(none)

    email = when(F.contains(text, F.lit("@")), _found(text, EMAIL, 0))
    ip = when(digit & F.contains(text, F.lit(".")), _found(text, IP, 1, lambda hit: hit.rlike(IP_PARTS)))
    card = when(digit, _found(text, CARD, 2, lambda hit: _between(F.length(_digits(hit)), 12, 19) & F.call_function("luhn_check", _digits(hit))))
    phone = when(F.contains(text, F.lit("+")), _found(text, PHONE, 3, lambda hit: _between(F.length(_digits(hit)), 9, 15)))
    spelled = when(text.rlike("(?i)dot"), _found(text, SPELLED, 0))
    numbers = when(digit, _found(text, NUMBERS, lambda hit: F.when(F.contains(hit, F.lit(":")), 1).when(
        F.length(_digits(hit)) == 16, 2).otherwise(3)))
    out = docs.withColumn("_base", F.array_sort(F.concat(email, ip, card, phone))).withColumn("_more", F.concat(spelled, numbers))
    return out.withColumn("_more", F.when((F.size("_more") == 0) | (F.size("_base") == 0), F.col("_more")).otherwise(
        _apart(F.col("_more"), F.col("_base"))))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(x: Column) -> Column:
    """Array of the labelers' votes on a span."""
    hit, kind, before = x["hit"], x["kind"], x["before"]
    digits = _digits(hit)
    n = F.length(digits)
    known = F.lower(F.regexp_extract(F.substring_index(F.substring_index(hit, ".", -1), " ", -1), "^[A-Za-z0-9-]+", 0)).isin(*TOP_DOMAINS)
    called = F.when(hit.startswith("+"), digits.rlike(CALLABLE)).otherwise(digits.rlike("^[2-9][0-9]{9}$|" + CALLABLE[1:]))
    reserved = hit.rlike(RESERVED)
    never = F.lit(False)
    return F.array(
        _vote(hit.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$|^[0-9]+(?:\.[0-9]+){3}$|^\+[0-9]|^[0-9][0-9 -]+$"), never),
        F.when((kind == 2) | ((kind == 3) & (n >= 12)), _vote(F.call_function("luhn_check", digits), F.lit(kind == 2))).otherwise(0),
        F.when(kind == 0, _vote(known, ~known)).otherwise(0),
        F.when(kind == 3, _vote(called, ~called)).when(kind == 2, _vote(digits.rlike(ISSUED), ~digits.rlike(ISSUED))).when(
            (kind == 1) & F.contains(hit, F.lit(".")), _vote(~reserved, reserved)).otherwise(0),
        _vote(before.rlike(FOR_WORDS), never),
        _vote(never, before.rlike(AGAINST_WORDS)),
        F.when(kind == 0, 0).otherwise(_vote((kind == 1) | (n == 10) | (n == 11) | (n == 16), digits.rlike(r"^(.)\1*$"))))


def features(x: Column) -> Column:
    """Array of the slots of a span's features, one below :data:`SLOTS` per feature."""
    shape = F.regexp_replace(F.regexp_replace(x["hit"], "[0-9]+", "9"), "[A-Za-z]+", "a")
    before = F.when(x["before"].rlike(FOR_WORDS), 1).when(x["before"].rlike(AGAINST_WORDS), 2).when(
        x["before"] == "", 3).when(x["before"].rlike(r"[\s(]$"), 4).otherwise(5)
    return F.array(
        x["kind"], F.pmod(F.xxhash64(x["kind"], shape), F.lit(SLOTS)).cast("int"),
        F.least(F.length(_digits(x["hit"])), F.lit(SLOTS - 1)), before)


def reliabilities(counts: DataFrame) -> tuple[float, list[float], list[float]]:
    """EM over (``votes``, ``n``): prior and each labeler's share of +1 among its votes on true and on other spans.

    ``counts`` has at most 3^labelers rows; they are folded in one row by built-in array functions. Without
    any span the starting values come back: prior 0.5, 0.8 and 0.2.
    """
    logit = ("ln(s.prior / (1 - s.prior)) + aggregate(sequence(0, {last}), 0D, (a, j) -> a + case p.votes[j] "
             "when 1 then ln(s.yes[j] / s.no[j]) when -1 then ln((1 - s.yes[j]) / (1 - s.no[j])) else 0D end)")
    post = ("transform(pats, p -> named_struct('n', p.n, 'votes', p.votes, 'r', 1 / (1 + exp(-(" + logit + ")))))").format(last=LABELERS - 1)

    def share(weight: str, plus: float) -> str:
        return (f"transform(sequence(0, {LABELERS - 1}), j -> "
                f"aggregate(q, {plus}D, (a, x) -> a + if(x.votes[j] = 1, x.n * {weight}, 0D)) / "
                f"aggregate(q, 10D, (a, x) -> a + if(x.votes[j] <> 0, x.n * {weight}, 0D)))")

    new = ("named_struct('prior', aggregate(q, 1D, (a, x) -> a + x.n * x.r) / aggregate(q, 2D, (a, x) -> a + x.n), "
           f"'yes', {share('x.r', 8)}, 'no', {share('(1 - x.r)', 2)})")
    start = (f"named_struct('prior', 0.5D, 'yes', array_repeat(0.8D, {LABELERS}), 'no', array_repeat(0.2D, {LABELERS}))")
    fold = f"aggregate(sequence(1, {EM_ROUNDS}), {start}, (s, i) -> transform(array({post}), q -> {new})[0])"
    got = counts.select(F.struct("votes", F.col("n").cast("double").alias("n")).alias("p")).agg(
        F.array_sort(F.collect_list("p")).alias("pats")).select(F.expr(fold).alias("m")).first()["m"]
    return got["prior"], list(got["yes"]), list(got["no"])


def train(found: DataFrame) -> tuple[float, list[list[float]]]:
    """Intercept and the weight of every (feature, slot), from the spans of all documents."""
    spans = found.select(F.explode(F.concat("_base", "_more")).alias("x")).select(votes(F.col("x")).alias("votes"), features(F.col("x")).alias("slots"))
    counted = spans.groupBy("votes", "slots").agg(F.count("*").alias("n"))
    prior, yes, no = reliabilities(counted.groupBy("votes").agg(F.sum("n").alias("n")))
    score = F.lit(math.log(prior / (1 - prior)))
    for j in range(LABELERS):
        v = F.col("votes")[j]
        score = score + F.when(v == 1, math.log(yes[j] / no[j])).when(v == -1, math.log((1 - yes[j]) / (1 - no[j]))).otherwise(0.0)
    soft = counted.withColumn("r", 1 / (1 + F.exp(-score)))
    rows = (
        soft.select("n", "r", F.posexplode("slots").alias("f", "slot")).groupBy("f", "slot")
        .agg(F.sum(F.col("n") * F.col("r")).alias("yes"), F.sum(F.col("n") * (1 - F.col("r"))).alias("no"))
        .collect())  # at most features x SLOTS rows
    total_yes = sum(r["yes"] for r in rows if r["f"] == 0)
    total_no = sum(r["no"] for r in rows if r["f"] == 0)
    share = (total_yes + 1) / (total_yes + total_no + 2)
    intercept = math.log(share / (1 - share))
    weights = [[0.0] * SLOTS for _ in range(4)]  # a slot never seen says nothing
    for r in rows:
        weights[r["f"]][r["slot"]] = math.log((r["yes"] + share) / (r["no"] + 1 - share)) - intercept
    return intercept, weights


def classified(found: DataFrame) -> DataFrame:
    """Adds ``_added``: the candidates that the trained classifier takes for personal data."""
    intercept, weights = train(found)
    tables = [F.array(*map(F.lit, w)) for w in weights]

    def accepted(x: Column) -> Column:
        slots = features(x)
        score = F.lit(intercept)
        for f, weight in enumerate(tables):
            score = score + F.element_at(weight, slots[f] + 1)
        return score > 0

    return found.withColumn("_added", F.when(F.size("_more") == 0, F.col("_more")).otherwise(F.filter("_more", accepted)))


def _joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base counts, digest of the base spans, all spans, ``n_added``.

    Null and empty texts have no spans (the digest is that of the empty string). Rows are treated one by
    one, so equal ids or texts do no harm; other columns are ignored. An empty table gives no rows.
    """
    found = stored(with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).drop("text"), "pii-spans")
    out = classified(found)

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda x: x["kind"] == kind)).cast("long")

    return out.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("_base", "_added"))).alias("spans"), F.size("_added").cast("long").alias("n_added"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every found span replaced by its kind in brackets; overlapping spans become one.

    The length column, where there is one, is brought up to date. Null texts stay null.
    """
    out = classified(stored(with_spans(docs, text_col), "pii-documents"))
    text, name = F.col(text_col), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(pieces: Column, at: Column, n: Column) -> Column:
        """``n`` characters from ``at`` (from 0), read from the pieces that hold them."""
        first = F.shiftright(at, PIECE_BITS)
        held = F.slice(pieces, first + 1, F.shiftright(at + n + 2**PIECE_BITS - 1, PIECE_BITS) - first)
        return F.substring(F.array_join(held, ""), at - F.shiftleft(first, PIECE_BITS) + 1, n)

    def rewritten(x: Column) -> Column:
        pieces, spans = x["pieces"], x["spans"]
        done = _scan(spans["e"], F.greatest, 0)
        shown = F.filter(F.zip_with(spans, done, lambda s, at: F.struct(s["s"].alias("s"), s["kind"].alias("kind"), at.alias("at"))), lambda s: s["s"] >= s["at"])
        end = F.array_max(spans["e"])
        return F.concat(
            F.array_join(F.transform(shown, lambda s: F.concat(piece(pieces, s["at"], s["s"] - s["at"]), F.element_at(name, s["kind"] + 1))), ""),
            piece(pieces, end, x["n"] - end))

    # a substring of a long text walks from its start, so the text is cut into pieces once
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{2**PIECE_BITS}}}+"), F.lit(0))
    rebuilt = _let(F.struct(cut.alias("pieces"), F.array_sort(F.concat("_base", "_added")).alias("spans"), F.length(text).alias("n")), rewritten)
    clean = F.when(text.isNull() | (F.size("_base") + F.size("_added") == 0), text).otherwise(rebuilt)
    out = out.withColumn(text_col, clean)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(text.isNull(), F.col(length_col)).otherwise(F.length(text)).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
