"""Raw sources as delimited text with a header line in every file.

The files of a source may differ in their columns and in the order of these: files with the same header are read together, and their
rows are united by column name, with NULL where a file does not have a column. Nothing is inferred, so no value changes.

A line is rejected if it does not have the cells that the header of its file names. Rejected lines are no rows; ``rejected_lines`` gives
them as they stand, with the reason. Lines are records: a cell holds no line break. Blank lines and repeated header lines are
nothing at all.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.schemas import SNAPSHOT
from lendlake.sources.scratch import shuffles_dropped

TOO_MANY, TOO_FEW, UNCLOSED, UNREADABLE = "too many cells", "too few cells", "unclosed quote", "unreadable"
# A cell in quotes, with the separator before it; quotes within are doubled or follow a backslash.
QUOTED = r'(^|,)[ \t]*"(?:[^"\\]|\\.|"")*"'
OPEN_QUOTE = r'(^|,)[ \t]*"'
REJECTED = "_rejected_line"
ROWS_PER_PACKED_FILE = 250_000
HEADERS_AT_ONCE = 16


def _line(text: Column) -> Column:
    """Without the end of line of other systems and a byte order mark; the pattern is looked for where one of them stands."""
    marked = F.startswith(text, F.lit("\ufeff")) | F.contains(text, F.lit("\r"))
    return F.when(marked, F.regexp_replace(text, "^\ufeff|\r$", "")).otherwise(text)


FILE = "_metadata.file_path as file"


def read_lines(spark: SparkSession, paths: str | list[str], *more: str) -> DataFrame:
    """line, after ``more``, such as its file. Each of them costs time on every row."""
    return spark.read.text(paths).selectExpr(*more, "value as line").withColumn("line", _line(F.col("line")))


def first_line(spark: SparkSession, file: str) -> str | None:
    """First line of a file that is not blank, without a byte order mark; it is read from the file's beginning, packed or not."""
    java, path = spark._jvm.java, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    opened = spark._jvm.org.apache.spark.sql.execution.datasources.CodecStreams.createInputStream(spark._jsc.hadoopConfiguration(), path)
    lines = java.io.BufferedReader(java.io.InputStreamReader(opened, "UTF-8"))
    try:
        line = lines.readLine()
        if line is not None:  # the reader of the lines takes one off, ``_line`` another
            line = line.removeprefix("\ufeff").removeprefix("\ufeff")
        while line is not None and not line.strip(" "):
            line = lines.readLine()
            line = line and line.removeprefix("\ufeff")
        return line
    finally:
        lines.close()


def file_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of each header, from the first lines; the driver holds the list of files anyway. No other line is read for it, sorted or spilled."""
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: first_line(spark, file), files))
    found: dict[str, list[str]] = {}
    for header, file in sorted((h, f) for h, f in zip(headers, files, strict=True) if h is not None):
        found.setdefault(header, []).append(file)
    return found


def column_names(header: str) -> list[str]:
    names = [name.strip() for name in next(csv.reader([header]))]
    if len({name.lower() for name in names}) < len(names) or not all(names):
        raise ValueError(f"a header names a column twice or not at all: {header}")
    return names


def is_plain(line: Column) -> Column:
    """Whether the separator alone cuts the line into its cells: no quote, and none of the marks that the CSV reader gives a meaning."""
    marks = [F.contains(line, F.lit(mark)) for mark in ('"', "\\")] + [F.startswith(line, F.lit("\0"))]
    return ~(marks[0] | marks[1] | marks[2])


def fault(line: Column, cells: int, plain_cells: Column) -> Column:
    """Why a line has not ``cells`` cells, NULL if it has; patterns run only on lines with a quote. ``plain_cells`` are those of a plain line."""
    quoted = F.contains(line, F.lit('"'))
    rest = F.when(quoted, F.regexp_replace(line, QUOTED, "$1")).otherwise(line)
    counted = F.length(rest) - F.length(F.replace(rest, F.lit(","), F.lit(""))) + 1
    found = F.when(plain_cells.isNotNull(), F.size(plain_cells)).otherwise(counted)
    return (
        F.when(quoted & F.regexp_like(rest, F.lit(OPEN_QUOTE)), UNCLOSED)
        .when(found != cells, F.when(found > cells, TOO_MANY).otherwise(TOO_FEW))
    )


def parsed(spark: SparkSession, path: str, *more: str) -> list[tuple[list[str], DataFrame]]:
    """For each header its columns, and the lines of its files: ``more``, line, reason, and the cells in ``row``.

    The cells are exploded from an array of one: filters on them stay above, so that a line is parsed once and not once for each use.
    A plain line is cut at its separators, which takes a third of the time of the CSV reader; the others go through it.
    """
    out = []
    for header, files in file_headers(spark, path).items():
        names = column_names(header)
        schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*names, REJECTED])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
        lines = read_lines(spark, files, *more).where((F.trim("line") != "") & (F.col("line") != header))
        cut = F.when(is_plain(F.col("line")), F.split("line", ",", -1)) if len(names) > 1 else F.lit(None).cast("array<string>")
        checked = lines.withColumn("plain", cut).withColumn("fault", fault(F.col("line"), len(names), F.col("plain")))
        given = [F.nullif(F.get("plain", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)]
        plain_row = F.struct(*given, F.lit(None).cast("string").alias(REJECTED))
        read = F.when(F.col("plain").isNotNull(), plain_row).otherwise(F.from_csv("line", F.lit(schema), options))
        row = F.when(F.col("fault").isNull(), read)
        cells = checked.select("*", F.explode(F.array(row)).alias("row"))
        unread = F.when(F.col(f"row.{REJECTED}").isNotNull(), UNREADABLE)
        out.append((names, cells.withColumn("reason", F.coalesce("fault", unread)).drop("fault", "plain")))
    return out


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """One raw source: the columns of all headers, text as it stands, a typed snapshot date.

    A snapshot date that is no date is NULL; ``bronze.rejected_counts`` counts such rows. A folder without any line has
    no columns but that date.
    """
    parts = [rows.where("reason is null").select(*[F.col(f"row.`{n}`").alias(n) for n in names]) for names, rows in parsed(spark, path)]
    united = parts[0] if parts else spark.createDataFrame([], f"{SNAPSHOT} string")
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    if SNAPSHOT not in united.columns:
        united = united.withColumn(SNAPSHOT, F.lit(None).cast("string"))
    return united.withColumn(SNAPSHOT, F.col(SNAPSHOT).try_cast("date"))


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, reason and line of every line that is no row."""
    united = spark.createDataFrame([], "file string, reason string, line string")
    for _, rows in parsed(spark, path, FILE):
        united = united.unionByName(rows.where("reason is not null").select("file", "reason", "line"))
    return united


def write_source(df: DataFrame, path: str, mode: str = "overwrite", packed: bool = False) -> None:
    """Text copy of a source; an empty string reads back as a missing value.

    ``packed`` files take less than half of the disk. One of them is read by a single task, so they are cut by rows.
    """
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_PER_PACKED_FILE} if packed else {}
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).options(**options).csv(path, header=True)


def write_lines(lines: DataFrame, header: str, path: str, mode: str = "overwrite") -> None:
    """The one text column of ``lines`` as it stands, below a header line in every file."""
    plain = {"header": True, "quote": "", "sep": "\x01", "escapeQuotes": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.toDF(header).write.mode(mode).options(**plain).csv(path)
