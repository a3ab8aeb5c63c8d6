"""Lists and records in files. Order is told by file and line, never by partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.strings import strip
from ..schemas import BRAND


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


#: Splits whose line counts are sent to all tasks, at some 100 bytes each; for more, the lines move to them.
SPLITS = 100_000


def numbered(df: DataFrame, number: str) -> DataFrame:
    """df, read from files as it is, with the number (from 1) of each row in its file.

    A file's splits are read by several tasks. Each split's rows are counted, and the counts of a file's earlier splits
    added up give where the split begins; in a split, rows come in the order of the file.
    """
    rows = df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__row"))
    splits = rows.groupBy("__path", "__at").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__path").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("__path", "__at", (before - F.col("__first") + 1).alias("__less"))
    few = len(df.inputFiles()) + rows.rdd.getNumPartitions() <= SPLITS
    return rows.join(F.broadcast(splits) if few else splits, ["__path", "__at"]).select(*df.columns, (F.col("__row") + F.col("__less")).alias(number))


def numbered_lines(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """file, line_no (from 1) and value of every line, blank ones included. Lines end with \\n or \\r\\n."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], "file string, line_no long, value string")
    lines = spark.read.text(path, lineSep="\n")
    own = numbered(lines.select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", "\r$", "").alias("value"), "_metadata"), "line_no")
    return own.select("file", "line_no", "value")


def domain_set(spark: SparkSession, path: str) -> DataFrame:
    """The distinct lower-cased domains of a list; none if it is missing. Order doesn't count, so lines are splittable."""
    if not exists(spark, path):
        return spark.createDataFrame([], "domain string")
    return spark.read.text(path).select(F.lower(strip(F.col("value"))).alias("domain")).where("domain != ''").distinct()


def domain_lines(spark: SparkSession, path: str, limit: int | None = None, missing_ok: bool = False) -> DataFrame:
    """line_no and value of the lines that aren't blank, stripped; with a limit, of the first of them."""
    own = numbered_lines(spark, path, missing_ok).select("line_no", strip(F.col("value")).alias("value")).where("value != ''")
    return own.orderBy("line_no").limit(limit) if limit else own


def records(spark: SparkSession, path: str, schema: str, keep_malformed: bool = False) -> DataFrame:
    """JSON lines. Malformed ones are dropped, or kept with `malformed` set and their text in `raw`; file and line_no tell
    the order. Blank lines go."""
    own = numbered_lines(spark, path).where(strip(F.col("value")) != "")
    x = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = own.select("file", "line_no", F.col("value").alias("raw"), x.alias("x")).select("file", "line_no", "raw", "x.*").withColumn("malformed", F.col("_corrupt").isNotNull()).drop("_corrupt")
    return out if keep_malformed else out.where(~F.col("malformed")).drop("malformed", "raw")


def brands(spark: SparkSession, path: str) -> DataFrame:
    """brand_no and BRAND's columns of a catalog: lists of brands by category, in file order. Keys that begin with _, and
    what isn't a list, are skipped."""
    text = spark.read.text(path, wholetext=True).select("value")
    keys = F.filter(F.json_object_keys("value"), lambda k: ~k.startswith("_"))
    one = "name string, official_domains array<string>, aliases array<string>, sector string"
    each = text.select(F.posexplode(keys).alias("c", "category"), "value").withColumn("value", F.from_json("value", "map<string, string>"))
    own = each.select("c", "category", F.get(F.array(F.try_element_at("value", F.col("category"))), F.lit(0)).alias("json")).where(F.col("json").startswith("["))
    rows = own.select("c", "category", F.posexplode(F.from_json("json", f"array<struct<{one.replace(' string', ': string').replace(' array', ': array')}>>")).alias("b", "x")).select("c", "b", "category", "x.*")
    number = (F.col("c") * 1_000_000 + F.col("b")).cast("long")
    return rows.select(number.alias("brand_no"), *(x.split()[0] for x in BRAND.split(", ")))


def label_of(file: Column) -> Column:
    """The list that a file's name tells."""
    return F.when(F.contains(file, F.lit("black")), "black").when(F.contains(file, F.lit("white")), "white").otherwise("unknown")


def raw_pages(spark: SparkSession, path: str, schema: str, source: str | None = None, cleaned: bool = True) -> DataFrame:
    """Records of the .jsonl files in a folder, with their file and line; of one source's files, or without cleaned ones."""
    own = records(spark, f"{path.rstrip('/')}/*.jsonl", schema, keep_malformed=True).withColumn("list", label_of(F.col("file")))
    if not cleaned:
        own = own.where(~F.contains("file", F.lit("_cleaned")))
    return own if source is None else own.where(F.col("list") == source)
