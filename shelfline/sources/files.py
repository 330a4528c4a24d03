"""Raw CSV extracts in, CSV and JSON lines out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.parsing import day, number, typed
from shelfline.operators.rules import OVERLONG, POSITION
from shelfline.schemas import NULL_TOKENS, TABLES

FALLBACK_CHARSET = "windows-1251"
#: of intermediates, which are written once and read a few times
COMPRESSION = "zstd"
_BROKEN = "_broken_line"
_CSV = {"quote": '"', "escape": '"'}


def _fields(line: Column) -> Column:
    """Number of fields of a raw line; commas inside quotes do not count."""
    bare = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line as its bytes, with its place: file, where its split begins, order within the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("bytes"), F.expr("is_valid_utf8(value)").alias("valid"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def _bare(line: Column) -> Column:
    """A line without the carriage return before its line break."""
    return F.regexp_replace(line, "\r$", "")


def _records(lines: DataFrame) -> DataFrame:
    """Lines put together where a quoted field runs over several of them.

    A line begins a record if an even number of quotes stands before it in its file. Quotes are counted
    within each split, by as many tasks as there are splits; the parity with which a split begins, and the
    record a split's first lines may still belong to, follow from one row per split. The line breaks within
    a record are kept as they are in the file.
    """
    quotes = F.octet_length("bytes") - F.octet_length(F.expr("replace(cast(bytes as string), '\"', '')"))
    split = Window.partitionBy("file", "block")
    before = split.orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    marked = lines.withColumn("odd", F.coalesce(F.sum(quotes).over(before), F.lit(0)) % 2).withColumn("quotes", quotes)
    splits = marked.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("odd_quotes"), F.count_if(F.col("odd") == 0).alias("even_starts"),
        F.count_if(F.col("odd") == 1).alias("odd_starts"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("entry", F.coalesce(F.sum("odd_quotes").over(earlier), F.lit(0)) % 2).withColumn(
        "starts", F.when(F.col("entry") == 0, F.col("even_starts")).otherwise(F.col("odd_starts")))
    open_record = F.last(F.when(F.col("starts") > 0, F.struct(F.col("block").alias("block"), F.col("starts").alias("n"))), True)
    splits = splits.select("file", "block", "entry", open_record.over(earlier).alias("open"))
    joined = marked.join(splits, ["file", "block"])
    begins = F.when((F.col("odd") + F.col("entry")) % 2 == 0, 1).otherwise(0)
    number = F.sum(begins).over(split.orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    own = F.struct("block", F.col("number").cast("bigint").alias("n"))
    numbered = joined.withColumn("number", number).withColumn("record", F.when(F.col("number") > 0, own).otherwise(F.coalesce("open", own)))
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "bytes")))
    whole = numbered.groupBy("file", "record").agg(parts.alias("parts"), F.bool_and("valid").alias("valid"))
    first = F.element_at("parts", 1)
    joined_bytes = F.aggregate(F.slice("parts", 2, F.size("parts")), first["bytes"], lambda acc, p: F.concat(
        acc, F.lit("\n").cast("binary"), p["bytes"]))
    return whole.select(joined_bytes.alias("bytes"), "valid", "file", first["block"].alias("block"), first["row"].alias("row"))


def _layouts(records: DataFrame) -> DataFrame:
    """One row per file: its header line as bytes, and whether all of it is UTF-8."""
    place = F.when(F.trim(F.expr("cast(bytes as string)")) != "", F.struct("block", "row"))
    return records.groupBy("file").agg(F.min_by("bytes", place).alias("header"), F.bool_and("valid").alias("utf8"),
                                       F.min(place).alias("header_place")).where(F.col("header").isNotNull())


def _decoded(value: Column, utf8: Column, charset: str | None) -> Column:
    read = value.cast("string") if charset in (None, "UTF-8") else F.decode(value, charset)
    if charset is None:
        read = F.when(utf8, read).otherwise(F.decode(value, FALLBACK_CHARSET))
    return _bare(F.regexp_replace(read, "^\ufeff", ""))


def _split(line: Column, width: int) -> Column:
    """The fields of one record as an array; missing ones are NULL."""
    parsed = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)), {**_CSV, "mode": "PERMISSIVE", "multiLine": "true"})
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def _one_layout(spark: SparkSession, path: str | list[str], charset: str, names: list[str]) -> DataFrame:
    """Files that share header and charset, read by the CSV source."""
    if charset != "UTF-8":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # lets the reader decode it at all
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BROKEN]])
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    raw = (spark.read.options(**_CSV).option("header", True).option("encoding", charset).schema(schema)
           .option("columnPruning", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN).csv(path))
    # the reader refuses a query that needs the raw line only, so a field is named as well: a hash is never below the least integer
    overlong = (_fields(F.col(_BROKEN)) > len(names)) & (F.hash(names[0]) >= -(2 ** 31))
    return raw.select(place.alias(POSITION), *names, F.coalesce(overlong, F.lit(False)).alias(OVERLONG),
                      F.col(_BROKEN).alias("line"))


def _by_file(records: DataFrame, layouts: DataFrame, charset: str | None, names: list[str], width: int) -> DataFrame:
    """Every record read by the header and charset of its own file, which a join brings to it."""
    own = layouts.select("file", "utf8", "header_place", _split(_decoded(F.col("header"), F.col("utf8"), charset), width).alias("header"))
    joined = records.join(own, "file").where(F.struct("block", "row") != F.col("header_place")).select(
        F.struct("file", "block", "row").alias(POSITION), "header", _decoded(F.col("bytes"), F.col("utf8"), charset).alias("line"))
    joined = joined.where(F.trim("line") != "").select("*", _split(F.col("line"), width).alias("fields"))
    known = F.size(F.array_compact("header"))
    return joined.select(
        POSITION, *[F.get("fields", F.array_position("header", n).cast("int") - 1).alias(n) for n in names],
        (_fields(F.col("line")) > known).alias(OVERLONG), "line")


def _raw(spark: SparkSession, path: str | list[str], multiline: bool, charset: str | None = None) -> tuple[DataFrame, list[str]]:
    """All rows as text with position, mark of over-long lines and raw line, and the column names.

    What reaches the driver are the distinct headers, not the files. If all files share header and charset
    the CSV source reads them; otherwise, or where records may run over lines, every record is read by the
    layout of its file.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    lines = _lines(spark, path)
    records = _records(lines) if multiline else lines
    layouts = _layouts(records)
    header = _decoded(F.col("header"), F.col("utf8"), charset)
    kinds = layouts.select(header.alias("header"), F.col("utf8") | F.lit(charset is not None)).distinct().collect()
    headers = sorted({r.header for r in kinds})
    if not headers:
        raise ValueError(f"no header in {path}")
    width = max(h.count(",") + 1 for h in headers)
    split = spark.createDataFrame([(h,) for h in headers], "header string").select(_split(F.col("header"), width).alias("names"))
    names = list(dict.fromkeys(n for r in split.collect() for n in r.names if n is not None))
    if len(kinds) == 1 and not multiline:
        return _one_layout(spark, path, charset or ("UTF-8" if kinds[0][1] else FALLBACK_CHARSET), names), names
    return _by_file(records, layouts, charset, names, width), names


def read_csv(spark: SparkSession, path: str | list[str], multiline: bool = False, charset: str | None = None,
             flag_overlong: bool = False) -> DataFrame:
    """Every column as text, with its position in the files.

    Each file is read by its own header and charset (UTF-8 where all its lines are, else the fallback);
    columns a file lacks are NULL. Missing-value tokens are NULL, a short line ends in NULLs, a line with
    more fields than its header is left out (see `overlong_lines`), or kept and marked for the quality
    report. A quoted line break needs `multiline`; files are split between tasks all the same.
    """
    raw, names = _raw(spark, path, multiline, charset)
    columns = [POSITION, *[F.when(~F.col(n).isin(NULL_TOKENS), F.col(n)).alias(n) for n in names]]
    return raw.select(*columns, OVERLONG) if flag_overlong else raw.where(~F.col(OVERLONG)).select(*columns)


def overlong_lines(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The lines `read_csv` leaves out, as they stand in the file."""
    raw, _ = _raw(spark, path, multiline)
    return raw.where(OVERLONG).select("line")


def cast_types(df: DataFrame, table: str) -> DataFrame:
    """Text columns in the types of the table; what cannot be read is NULL, other columns stay."""
    kinds = {f.name: f.dataType for f in TABLES[table]}

    def cast(name: str) -> Column:
        kind = kinds.get(name)
        if isinstance(kind, T.DateType):
            return day(F.col(name)).alias(name)
        if isinstance(kind, T.NumericType):
            return typed(F.col(name), number(F.col(name)), kind).alias(name)
        return F.col(name)

    return df.select(*[cast(c) for c in df.columns])


def written(df: DataFrame, path: str) -> DataFrame:
    """Written as Parquet and read back: computed once, and safe from a lost executor after that. Intermediates take
    the least disk."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def split_history_update(df: DataFrame, folder: str, name: str, cutoff: dt.date, column: str = "date") -> dict[str, str]:
    """Rows before the cutoff day as history, rows of that day as update; either may be just a header."""
    paths = {part: f"{folder}/{name}_{part}" for part in ("history", "update")}
    write_csv(df.where(F.col(column) < F.lit(cutoff)), paths["history"])
    write_csv(df.where(F.col(column) == F.lit(cutoff)), paths["update"])
    return paths


def append_log(log: DataFrame, path: str) -> None:
    """Adds records as JSON lines; earlier ones are never rewritten."""
    log.write.mode("append").option("ignoreNullFields", False).json(path)
