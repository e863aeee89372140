"""Landing of source files: every value as text, missing tokens blanked, names in lower case, lineage added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.convert import text_list
from riskmart.sources import quoted
from riskmart.spec import LOAD_SEQ, NA_TOKENS

_LINE, _FILE = "_line", "_file"


def land(source: DataFrame, loaded_at: str, source_file: str | None = None) -> DataFrame:
    """Raw layer of a source whose columns are all text.

    `_load_seq` passes through, and so does `_source_file` unless a name is given. One load time per run, so that a
    rerun compares equal.
    """
    named = source.toDF(*[c.lower() for c in source.columns])
    kept = {LOAD_SEQ, "_source_file"}
    blanked = [f"case when `{c}` is null or `{c}` in ({text_list(NA_TOKENS)}) then '' else `{c}` end as `{c}`"
               for c in named.columns if c not in kept]
    file_name = f"'{source_file}' as _source_file" if source_file else "_source_file"
    position = [LOAD_SEQ] if LOAD_SEQ in named.columns else []
    return named.selectExpr(*blanked, f"'{loaded_at}' as _loaded_at", file_name, *position)


def land_csv(spark: SparkSession, path: str, loaded_at: str, multi_line: bool = False) -> DataFrame:
    """Raw layer of CSV files with a header, whatever their columns are.

    Only the first line is read to learn the names; a file whose header differs fails the read instead of shifting
    columns. A line with more fields than the header fails the read as well, and the error has the whole line: an
    unquoted separator would shift every later column. Missing fields at the end of a line are empty. `_load_seq` orders rows by file, then position: file path, start of the split, running number within it.
    Files are split among tasks; with `multi_line` (line breaks inside quotes) as well, see `quoted`, which reads the
    files once more, for their quotes.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "encoding": "UTF-8",
               "columnNameOfCorruptRecord": _LINE}
    names = spark.read.options(**options).csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in [*names, _LINE])
    if multi_line:
        rows = _records(spark, path, names, schema, options)
    else:
        rows = spark.read.options(**options, enforceSchema=False).schema(schema).csv(path).select(
            "*", F.col("_metadata.file_name").alias(_FILE), F.struct(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row")).alias(LOAD_SEQ))
    # Spark gives the line of every row with another number of fields; separators outside quotes tell which have more.
    bare = F.regexp_replace(_LINE, '"(?:[^"]|"")*"', "")
    surplus = F.length(bare) - F.length(F.translate(bare, ",", "")) >= len(names)
    source_file = F.when(surplus, F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(_LINE)))).otherwise(
        F.col(_FILE))
    return land(rows.select(*[f"`{n}`" for n in names], source_file.alias("_source_file"), LOAD_SEQ), loaded_at)


def _records(spark: SparkSession, path: str, names: list[str], schema: str, options: dict) -> DataFrame:
    """Parsed records of files with line breaks inside quotes; the first record of each file must be the header."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    parsed = quoted.records(spark, path).withColumn("_row", F.from_csv("record", schema, options))
    same = F.lit(True)
    for n in names:
        same &= F.lower(F.coalesce(F.col("_row")[n], F.lit(""))) == n.lower()
    is_header = (F.col("block") == 0) & (F.col("row") == 0)
    problem = F.raise_error(F.concat(F.lit("the header differs: "), "file", F.lit(": "), "record")).cast("boolean")
    data = parsed.where(F.when(is_header, F.when(same, False).otherwise(problem)).otherwise(True))
    return data.select("_row.*", F.regexp_extract("file", "[^/]*$", 0).alias(_FILE),
                       F.struct("file", "block", "row").alias(LOAD_SEQ))


class CountMismatch(ValueError):
    """Rows stored differ from rows read."""


def check_count(expected: int, stored: int, table: str) -> int:
    """Stored row count, or an error when it differs from the source."""
    if expected != stored:
        raise CountMismatch(f"{table}: {stored:,} rows stored, {expected:,} rows read")
    return stored


def row_count_check(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Source count, stored count and verdict as one row."""
    counts = source.agg(F.count(F.lit(1)).alias("source_rows")).unionByName(
        stored.agg(F.count(F.lit(1)).alias("stored_rows")), allowMissingColumns=True)
    return counts.agg(F.max("source_rows").alias("source_rows"), F.max("stored_rows").alias("stored_rows")).withColumn(
        "status", F.when(F.col("source_rows") == F.col("stored_rows"), "PASS").otherwise("FAIL"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. Only the keys are shuffled."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(repeated: DataFrame, table: str, stored_at: str = "") -> None:
    """Error when there are repeated keys: how many, where they are stored, and the first of them in order."""
    keys = [c for c in repeated.columns if c != "copies"]
    count = repeated.count()
    if count:
        first = repeated.orderBy(*keys).first()
        raise ValueError(f"{table}: {count} repeated keys{f' (all in {stored_at})' if stored_at else ''}, "
                         f"first {first['copies']} rows for {[first[k] for k in keys]}")
