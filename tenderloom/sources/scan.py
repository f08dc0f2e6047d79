"""Table scans. Each returns a lazy DataFrame with an explicit schema."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from . import schemas as S
from ..functions import text as T
from ..operators.joins import label_dim
from .sink import read_sheet


def scan_jsonl(spark: SparkSession, path, schema: str) -> DataFrame:
    """JSON lines; malformed lines are dropped, blank ones skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def scan_jsonl_strict_per_file(spark: SparkSession, path, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good records, and the number of rejected lines per file.

    Only the bad line is lost, not the rest of its file: files are read in parallel pieces, so
    "after the bad line" has no meaning, and a counted loss is better than a silent one.
    """
    lines = spark.read.text(path).filter(F.length(T.strip("value")) > 0)
    shape = f"{schema}, _corrupt_record string"
    parsed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.from_json("value", shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    good = parsed.filter(F.col("r._corrupt_record").isNull()).select("r.*").drop("_corrupt_record")
    rejects = parsed.filter(F.col("r._corrupt_record").isNotNull()).groupBy("file").agg(F.count("*").alias("rejected"))
    return good, rejects


def scan_tagged_by_filename(spark: SparkSession, path, schema: str, labels) -> DataFrame:
    """JSON lines of files (or folders of part files) named ``kved_<code>.jsonl``.

    Code and label come from that name; the code may have "_" or "." between its parts.
    """
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"kved_([^/]+?)\.jsonl", 1)
    tagged = df.withColumn("activity_code", F.translate(stem, "_", "."))
    return label_dim(tagged, labels, "activity_code", "activity_label")


def scan_csv(spark: SparkSession, path, schema: str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, sep=sep, multiLine=False, enforceSchema=False)


def scan_csv_sep(spark: SparkSession, path, schema: str, sep: str = ";") -> DataFrame:
    return scan_csv(spark, path, schema, sep)


def _file_path():
    """The path of the file a row came from, with its URL escapes undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def csv_headers(spark: SparkSession, root: str) -> list[tuple[list[str], list[str]]]:
    """Column names and files of every distinct header line below ``root``, found in one distributed pass.

    The pass reads all lines; only file names and header lines reach the driver, as in any file listing.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(root)
    first = lines.filter(F.col("_metadata.file_block_start") == 0).select(
        _file_path().alias("file"), "value", F.monotonically_increasing_id().alias("n")
    ).groupBy("file").agg(F.min_by("value", "n").alias("header"))
    groups = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    return [(next(csv.reader([r.header.lstrip("\ufeff")]), []), list(r.files)) for r in groups]


def scan_csv_aliased(spark: SparkSession, root: str, aliases=S.CSV_ALIASES, label: str = "Email Catalog",
                     headers: list[tuple[list[str], list[str]]] | None = None) -> DataFrame:
    """All CSV files below ``root`` as (email, org_id, name, phone, source).

    Header spellings are matched without regard to case; files without an e-mail column are
    skipped; the source names the parent folder. Files with equal headers share one scan. ``headers`` declares
    the groups (column names, files, folders or globs), so that nothing is read to find them; by default
    :func:`csv_headers` does.
    """
    parts = []
    for columns, files in csv_headers(spark, root) if headers is None else headers:
        names = [h.strip().lstrip("\ufeff") for h in columns]
        lower = {n.lower(): i for i, n in enumerate(names)}
        picked = {out: next((lower[a] for a in options if a in lower), None) for out, options in aliases.items()}
        if picked["email"] is None:
            continue
        schema = StructType()
        for i in range(len(names)):
            schema.add(f"c{i}", "string")
        folder = F.element_at(F.split(_file_path(), "/"), -2)
        parts.append(spark.read.csv(files, schema=schema, header=True).select(
            *[T.null_to_empty(f"c{i}").alias(out) if i is not None else F.lit("").alias(out) for out, i in picked.items()],
            F.concat(F.lit(f"{label} ("), folder, F.lit(")")).alias("source")))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*aliases, "source")))
    return reduce(DataFrame.unionByName, parts)


def scan_sheets(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    """Named tables of one published set, every value as text, null as ""."""
    tables = {n: read_sheet(spark, root, n) for n in names}
    return {n: df.select(*[T.null_to_empty(F.col(c).cast("string")).alias(c) for c in df.columns])
            for n, df in tables.items()}


def merge_page_parts(spark: SparkSession, root: str, schema: str = S.LISTING_COMPANY) -> DataFrame:
    """Per-page parts (files or folders named ``page_<n>.csv``) as one table with their page number."""
    df = spark.read.option("recursiveFileLookup", "true").csv(root, schema=schema, header=True)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"page_(\d+)\.csv", 1).try_cast("int")
    return df.withColumn("page", number).filter("page is not null")


def scan_tender_json(spark: SparkSession, path, schema: str = S.TENDER) -> DataFrame:
    """Nested tender or contract documents, one per line."""
    return scan_jsonl(spark, path, schema)
