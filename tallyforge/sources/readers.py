"""Readers and sinks: cell grids, scan logs, frozen lists, registry answers, text files, manifests, keyed state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyforge.functions import text as T
from tallyforge.operators.relational import asc, first_by

GRID = "file string, sheet string, row_no long, col_no long, value string, number_format string"


class GridSource(DataSource):
    """``spark.read.format("tally_grid").option("paths", "a.csv;b.xlsx")``: every cell as text. Workbooks need openpyxl (IO1)."""

    @classmethod
    def name(cls) -> str:
        return "tally_grid"

    def schema(self) -> str:
        return GRID

    def reader(self, schema) -> DataSourceReader:
        return _GridReader(self.options)


class _GridReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(";") if p]
        self.separator = options.get("sep", ",")

    def partitions(self):
        return [InputPartition(p) for p in self.paths] or [InputPartition("")]

    def read(self, partition):
        path = partition.value
        if not path:
            return
        if path.lower().endswith((".xlsx", ".xlsm")):
            import openpyxl

            book = openpyxl.load_workbook(path, read_only=True, data_only=True)
            for sheet in book.worksheets:
                for i, row in enumerate(sheet.iter_rows()):
                    for j, cell in enumerate(row):
                        if cell.value is not None:
                            yield path, sheet.title, i, j, str(cell.value), cell.number_format
            return
        import csv

        with open(path, encoding="utf-8-sig", newline="") as lines:
            for i, row in enumerate(csv.reader(lines, delimiter=self.separator)):
                for j, value in enumerate(row):
                    if value != "":
                        yield path, "", i, j, value, None


def register_sources(spark: SparkSession) -> None:
    spark.dataSource.register(GridSource)


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """``;``-separated scans; the last of each item wins (IO10)."""
    raw = spark.read.csv(path, header=True, sep=";", encoding="UTF-8", schema="item_code string, gtin string, nature string, scanned_at string", mode="PERMISSIVE")
    return last_scan(raw.withColumn("ordinal", F.monotonically_increasing_id()))


def last_scan(scans: DataFrame) -> DataFrame:
    """Last scan of each item by time, then ordinal."""
    last = scans.where("item_code is not null").groupBy("item_code").agg(F.max_by(F.struct("gtin", "nature", "scanned_at"), F.struct("scanned_at", "ordinal")).alias("s"))
    return last.select("item_code", "s.*")


def frozen_list(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A frozen list as text; its separator is found in the first line (IO8, IO9)."""
    first = spark.read.text(path).limit(1).first()
    head = first.value if first else ""
    sep = max([";", ",", "\t", "|"], key=head.count)
    return spark.read.csv(path, header=True, sep=sep).select(*columns).distinct()


def resolved(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their own names, found by any of their aliases; a missing one is an error that tells what is there (SC47, IO11, IO12)."""
    have = {c.strip().lower(): c for c in df.columns}
    out = []
    for name, others in aliases.items():
        found = next((have[a.lower()] for a in [name, *others] if a.lower() in have), None)
        if found is None:
            raise ValueError(f"no column for {name}; there are {', '.join(df.columns)}")
        out.append(F.col(f"`{found}`").alias(name))
    return df.select(*out)


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or an empty one of the schema if there is none (IO6)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def code_list(grid: DataFrame, code_col: int, item_col: int) -> DataFrame:
    """First code of 8 to 14 digits of each item in a sheet (IO7)."""
    cell = lambda c: F.max(F.when(F.col("col_no") == c, F.col("value")))
    rows = grid.groupBy("file", "sheet", "row_no").agg(T.item_code(cell(item_col)).alias("item_code"), cell(code_col).alias("gtin"))
    return first_by(rows.where(F.col("gtin").rlike(r"^\d{8,14}$")), ["item_code"], asc("file", "sheet", "row_no")).select("item_code", "gtin")


DEVICE = "primaryDi string, reference string, tradeName string, deviceName string, manufacturerName string, manufacturerSrn string"


def registry_answers(raw: DataFrame, ignored_above: int = 100_000) -> DataFrame:
    """Answers of a device registry (query, body as JSON text) with status and devices; totals that show an ignored filter give none (IO13 to IO17)."""
    body = F.from_json("body", f"totalElements long, content array<struct<{DEVICE.replace(' string', ':string')}>>")
    parsed = raw.withColumn("_b", body)
    total = F.coalesce("_b.totalElements", F.lit(0))
    devices = F.when(total > ignored_above, None).otherwise(F.col("_b.content"))
    status = F.when(F.col("_b").isNull() | F.col("_b.totalElements").isNull(), "failed").when((total > ignored_above) | (F.coalesce(F.size(devices), F.lit(0)) <= 0), "absent").otherwise("found")
    from tallyforge.functions.gtin import checked_unit

    codes = F.filter(F.transform(devices, lambda d: checked_unit(d["primaryDi"])), lambda c: c.isNotNull())
    return parsed.select("query", status.alias("status"), total.alias("total"), devices.alias("devices"), F.get(codes, F.lit(0)).alias("first_code"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: file, line_no, line (IO18)."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split("value", "\r?\n").alias("lines"))
    return whole.select("file", F.posexplode("lines").alias("line_no", "line"))


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """First 16 hex digits of SHA-256, time and size of files (IO33)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.substring(F.sha2("content", 256), 1, 16).alias("fingerprint"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def write_version(df: DataFrame, folder: str, name: str, rows_expected: int | None = None) -> int:
    """Writes the next version of a table and commits it to the manifest beside it; returns the version (IO21, IO22, IO26, SP7, EV7)."""
    spark = df.sparkSession
    version = next_version(spark, folder, name)
    path = f"{folder}/{name}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    n = spark.read.parquet(path).count()
    if rows_expected is not None and n != rows_expected:
        raise ValueError(f"{path} has {n} rows, {rows_expected} expected")
    spark.createDataFrame([(name, version, path, n)], MANIFEST).withColumn("committed_at", F.current_timestamp()).write.mode("append").parquet(f"{folder}/_manifest")
    return version


MANIFEST = "name string, version int, path string, n_rows long"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return table_or_empty(spark, f"{folder}/_manifest", MANIFEST + ", committed_at timestamp")


def next_version(spark: SparkSession, folder: str, name: str) -> int:
    """Highest version and one (IO26)."""
    return manifest(spark, folder).where(F.col("name") == name).agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("v")).first().v


def latest_version(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table of the highest committed version, by number (IO23 to IO25, IO27, IO28)."""
    found = manifest(spark, folder).where(F.col("name") == name).agg(F.max_by("path", "version").alias("path")).first()
    if found is None or found.path is None:
        raise FileNotFoundError(f"no version of {name} in {folder}")
    return spark.read.parquet(found.path)


def replace_partitions(df: DataFrame, path: str, key: str) -> None:
    """Rows of the keys in df replace those in the table; other keys stay (IO20's index)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
