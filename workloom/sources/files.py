"""Files: raw CSV of several encodings, catalogues, download plans, Parquet, resumable checkpoints."""

from __future__ import annotations

import codecs
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.functions import scalars as S
from workloom.operators.postings import unit_groups
from workloom.runtime import cut, exists

#: Columns that a raw monthly file must have.
REQUIRED = ("Job Title", "NOC21 Code", "NOC21 Code Name", "Vacancy Count", "First Posting Date", "Salary Minimum", "Salary Maximum", "Salary Per", "Province/Territory", "City", "NOC 2016 Code", "NOC 2016 Code Name")
#: Columns of the occupation master, and of the raw postings.
MASTER = ("Level", "Code - NOC 2021 V1.0", "Class title")
POSTINGS = ("job_id", "company_name", "title", "description", "formatted_experience_level")
CATALOGUE = "result struct<resources:array<struct<url:string,format:string>>>"


@dataclass(frozen=True)
class Format:
    encoding: str
    separator: str
    #: Whether the file must be read as one piece.
    multi_line: bool


def _head(spark: SparkSession, path: str, n: int = 4096) -> bytes:
    """The first bytes of a file of any file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def sniff(spark: SparkSession, path: str) -> Format:
    """Format of a file: UTF-16 by its mark, else UTF-8 if all of it decodes, else Latin-1; tab or comma by the header.

    The driver reads the head only; the workers judge the rest, line by line. A file is read as one piece only
    where it must be: UTF-16, and lines with an odd number of quotes, as a record goes on behind such a line.
    """
    head = _head(spark, path)
    if not head:
        raise ValueError(f"{path} is empty")
    if head[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        encoding, multi_line = "UTF-16", True
    else:
        quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
        valid, multi_line = spark.read.text(path).agg(F.bool_and(F.is_valid_utf8("value")), F.bool_or(quotes % 2 == 1)).first()
        encoding = "UTF-8" if valid in (True, None) else "ISO-8859-1"
    first = head[: len(head) // 2 * 2].decode("utf-16" if encoding == "UTF-16" else "latin-1", "ignore").splitlines()[:1]
    tabbed = bool(first) and first[0].count("\t") > first[0].count(",")
    return Format(encoding, "\t" if tabbed else ",", bool(multi_line))


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED, fmt: Format | None = None) -> DataFrame:
    """A raw CSV file as text columns; text that counts as null is null. An error names missing columns."""
    found = fmt or sniff(spark, path)
    df = spark.read.csv(path, header=True, sep=found.separator, encoding=found.encoding, multiLine=found.multi_line, quote='"', escape='"', inferSchema=False)
    df = df.toDF(*(c.lstrip("\ufeff").strip() for c in df.columns))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*(S.scanned(F.col(f"`{c}`")).alias(c) for c in df.columns))


def validate(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED) -> dict:
    """path, ok, encoding, separator, rows, error of a raw file; error names what failed: the file, its content, its columns or its rows."""
    result = {"path": path, "ok": False, "encoding": None, "separator": None, "rows": None, "error": None}
    if not exists(spark, path):
        return result | {"error": "no such file"}
    try:
        fmt = sniff(spark, path)
        rows = read_csv(spark, path, required, fmt).count()
    except Exception as error:
        return result | {"error": str(error)[:500]}
    return result | {"ok": rows > 0, "encoding": fmt.encoding, "separator": fmt.separator, "rows": rows, "error": None if rows else "no rows"}


def read_occupations(spark: SparkSession, path: str) -> DataFrame:
    """noc21_code, noc21_name of the unit groups of an occupation master file."""
    master = read_csv(spark, path, MASTER)
    level, code, name = (F.col(f"`{c}`") for c in MASTER)
    return unit_groups(master.select(S.number(level).cast("int").alias("level"), code.alias("code"), name.alias("name")))


def read_postings(spark: SparkSession, path: str, required: tuple[str, ...] = POSTINGS) -> DataFrame:
    """The raw postings file with job_id as a number; descriptions may have line breaks inside quotes."""
    df = read_csv(spark, path, required)
    return df.withColumn("job_id", F.col("job_id").try_cast("bigint"))


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """One table of the frames, by the names of their columns; columns that a frame lacks are null."""
    if not frames:
        raise ValueError("no files")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def read_months(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One table of the monthly files (year_month: path), by year_month."""
    return union_frames([read_csv(spark, path).withColumn("year_month", F.lit(month)) for month, path in sorted(paths.items())])


def write_months(df: DataFrame, path: str) -> None:
    """Writes df in a folder for each year_month, so that readers of a month read its files only."""
    df.write.mode("overwrite").partitionBy("year_month").parquet(path)


def catalogue_urls(catalogue: DataFrame, column: str = "value") -> DataFrame:
    """ord, url: the English CSV addresses of catalogues in JSON, in their order."""
    read = catalogue.select(F.from_json(column, CATALOGUE).alias("c"))
    each = read.select(F.posexplode("c.result.resources.url").alias("ord", "url"))
    return each.where(F.endswith("url", F.lit(".csv")) & S.is_english_address(F.col("url")))


def months_of(urls: DataFrame) -> DataFrame:
    """year_month, url: the last address of each month; addresses without a month are an error."""
    known = urls.withColumn("year_month", S.year_month(F.col("url")))
    checked = known.withColumn("year_month", F.coalesce("year_month", F.raise_error(F.concat(F.lit("no month in "), F.col("url"))).cast("string")))
    return checked.groupBy("year_month").agg(F.max_by("url", "ord").alias("url"))


def download_plan(months: DataFrame, present: DataFrame) -> DataFrame:
    """The months whose file isn't there yet (present: year_month)."""
    return months.join(present.select("year_month").distinct(), "year_month", "left_anti")


def read_checkpoints(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt) of JSON checkpoint files: rows with their file, and the files that can't be read."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    read = spark.read.schema(wide).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt").withColumn("file", F.input_file_name())
    read = cut(read)  # Spark doesn't let a query use the corrupt column of the files alone
    return read.where("_corrupt is null").drop("_corrupt"), read.where("_corrupt is not null").select("file").distinct()
