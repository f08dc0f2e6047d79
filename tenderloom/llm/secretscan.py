"""Secrets in texts: fixed patterns, and strings beside sensitive words that nothing around them explains.

1. One scan of every text finds the base spans (assignments, access keys, hexadecimal runs), further candidates (long
   strings of letters and digits soon after a sensitive word) and the words that stand near sensitive words.
2. Those words are counted over all documents; the most frequent ones form the identifier dictionary.
3. A candidate's novelty is what it adds to a zstandard frame that is primed with a dictionary of these identifiers and
   of the text around the candidate, in bytes added per byte. What names, paths or repeats of the surroundings
   explain compresses; what does not is reported.

Base spans are always kept. The text is read once; documents without candidates are not carried further.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

KINDS = ("assign", "access", "hex")

# --- fixed values: base patterns ---------------------------------------------------------------------
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# --- fixed values: candidates ------------------------------------------------------------------------
SENSITIVE = re.compile(r"(?ai)(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api|auth|authorization|bearer|basic|credentials?|cred|private|signing|"
                       r"signature|session|cookie|login|access|account|client|encryption|(?:[a-z]+_|api|access|secret|private|public)?key)(?![a-z])")
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "api", "auth", "bearer", "basic", "cred", "private", "sign", "session", "cookie", "login", "access", "account",
                   "client", "encryption", "key")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
IDENTIFIER = re.compile(r"(?<![A-Za-z0-9+/_])[A-Za-z_]{4,40}(?![A-Za-z0-9+/_])")

#: Characters before a candidate that may hold its sensitive word, and around a sensitive word that give identifiers.
BEFORE, NEAR = 48, 120
#: Characters of the surroundings on either side, entries of the identifier dictionary, least novelty that is reported.
AROUND, WORDS, NOVELTY = 1024, 4096, 0.85

_IN_HEX = bytes(48 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_IN_CANDIDATE = bytes(48 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 32 for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans by start, then kind."""
    out = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if b"0" * LEAST_HEX in text.encode("utf-8", "surrogatepass").translate(_IN_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _kind(hit: str) -> int:
    if re.fullmatch(r"[0-9a-fA-F]{32,}", hit):
        return 2
    return 1 if re.fullmatch(r"A[A-Z]{3}[A-Z0-9]{12,}", hit) else 0


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Strings of letters and digits with a sensitive word shortly before them in the line, beside the base spans."""
    lowered = text.lower()
    if not any(w in lowered for w in SENSITIVE_WORDS) or b"0" * 16 not in text.encode("utf-8", "surrogatepass").translate(_IN_CANDIDATE):
        return []
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        s, e, hit = m.start(), m.end(), m[0]
        while at < len(base) and base[at][0] < e:
            reach = max(reach, base[at][2])
            at += 1
        if reach > s or len(re.findall("[0-9]", hit)) < 2 or len(re.findall("[A-Za-z]", hit)) < 2:
            continue
        before = text[max(0, s - BEFORE):s].rpartition("\n")[2]
        if not before.endswith("://") and SENSITIVE.search(before):
            out.append((s, _kind(hit), e))
    return out


def identifiers(text: str) -> set[str]:
    """Words near the sensitive words of a text."""
    lowered = text.lower()
    if not any(w in lowered for w in SENSITIVE_WORDS):
        return set()
    out: set[str] = set()
    upto = 0
    for m in SENSITIVE.finditer(text):
        start, end = max(upto, m.start() - NEAR), m.end() + NEAR
        if start < end:
            out.update(IDENTIFIER.findall(text, start, end))
            upto = end
    return out


def novelty(text: str, start: int, end: int, words: str = "", around: int = AROUND) -> float:
    """Bytes that ``text[start:end]`` adds to a frame primed with the words and its surroundings, per byte of its own.

    All of it is lower-cased, as identifiers keep their words but not their case; a random string stays random. Other
    places of the same string in the surroundings are blanked: a secret is not explained by its repeats.
    """
    hit = text[start:end].lower()
    near = (text[max(0, start - around):start] + " " + text[end:end + around]).lower().replace(hit, " ")
    return _added_bytes(hit, words.lower() + "\n" + near) / max(1, len(hit.encode("utf-8", "surrogatepass")))


def _added_bytes(hit: str, dictionary: str) -> int:
    import zstandard

    raw = dictionary.encode("utf-8", "surrogatepass")
    data = hit.encode("utf-8", "surrogatepass")
    primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None
    settings = zstandard.ZstdCompressionParameters.from_level(
        6, source_size=len(data), dict_size=len(raw), format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    packed = zstandard.ZstdCompressor(dict_data=primed, compression_params=settings)
    return max(0, len(packed.compress(data)) - _empty_frame())


@lru_cache(1)
def _empty_frame() -> int:
    import zstandard

    settings = zstandard.ZstdCompressionParameters.from_level(
        6, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    return len(zstandard.ZstdCompressor(compression_params=settings).compress(b""))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, counts, ``base`` (joined), ``more`` (start, kind, end of candidates in one array), ``words``, ``text`` where there is a candidate."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base string, more array<int>, words array<string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                base = base_spans(text)
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), _joined(base), [x for c in candidates(text, base) for x in c], sorted(identifiers(text))))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "more", "words"])

    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("x", scan("text"))
    return found.select("doc_id", "x.*", F.when(F.size("x.more") > 0, F.col("text")).alias("text"))


def identifier_dictionary(found: DataFrame, words: int = WORDS) -> str:
    """The words that stand near sensitive words in most documents, the most frequent last; at most ``words`` of 40 letters."""
    counted = found.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    top = counted.orderBy(F.col("docs").desc(), "word").limit(words).collect()
    return "\n".join(r["word"] for r in reversed(top))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NOVELTY, around: int = AROUND, words: int = WORDS) -> DataFrame:
    """One row per document: id, base counts, digest of the base spans, all spans, ``n_added``.

    Spans are code points of the whole match, end exclusive. Null and empty texts have no spans (the digest is that of the
    empty string). Rows are treated one by one, so equal ids or texts do no harm; other columns are ignored; an
    empty table gives no rows. Two candidates never overlap, nor does a candidate overlap a base span. An added span
    is ``hex`` if it is hexadecimal of 32 digits or more, ``access`` in the form of an access key, else ``assign``.
    """
    found = stored(scanned(docs, id_col, text_col), "secret-spans")
    dictionary = identifier_dictionary(found.filter(F.size("words") > 0), words)

    @F.pandas_udf("spans string, n_added long")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for base, more, text in batches:
            rows = []
            for b, m, t in zip(base, more, text):
                added = [] if t is None else [
                    (s, k, e) for s, k, e in zip(*(map(int, m[i::3]) for i in range(3))) if novelty(t, s, e, dictionary, around) >= least]
                if added:
                    named = [x.split(":") for x in b.split(",") if x]
                    b = _joined(sorted(added + [(int(s), KINDS.index(k), int(e)) for k, s, e in named]))
                rows.append((b, len(added)))
            yield pd.DataFrame(rows, columns=["spans", "n_added"])

    out = found.withColumn("x", judged("base", "more", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base"), 256).alias("base_sha256"), "x.spans", "x.n_added")
