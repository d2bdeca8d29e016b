"""Source scans and table sinks.

Reads end in the declared schema, by column name; what would be lost on the way is an error. Writes are
full refreshes, like the original tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .publish import Counters, prepare, publish, publish_table, switch
from .schemas import raw_schema


def read_source(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet",
                table: str | None = None, schema: T.StructType | None = None,
                optional: Iterable[str] = (), money_type: str = "decimal(38,0)",
                where: Column | None = None, **options) -> DataFrame:
    """Scan one raw source ('events', 'licenses', 'transactions') from files or a catalog table.

    Columns are matched by name, without regard to case, and cast to the declared types; money has
    ``money_type`` from the read on. A column that is absent and not ``optional``, and a value that its
    type cannot hold, is an error, never a NULL. Headered text takes its columns from the header
    (:func:`load_text` sets bad rows aside instead).

    ``where``: a condition on the stored columns, also those that the source does not declare, such as the
    month that :func:`store_by_month` partitions by; the scan prunes partitions by it.
    """
    schema = schema or raw_schema(name, money_type)
    if table is not None:
        stored = spark.read.table(table)
        return conform(stored if where is None else stored.filter(where), schema, optional)
    if path is None:
        raise ValueError("give a path or a table")
    reader = spark.read.format(fmt).option("mode", "FAILFAST")
    if fmt == "csv":
        reader = reader.option("header", "true")  # all columns as text, named by the header
    elif fmt == "json":
        reader = reader.option("primitivesAsString", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    stored = reader.load(path)
    return conform(stored if where is None else stored.filter(where), schema, optional)


def conform(df: DataFrame, schema: T.StructType, optional: Iterable[str] = ()) -> DataFrame:
    """The declared columns in order and of the declared types; ``optional`` ones may be absent (NULL)."""
    present = _present(df.columns, schema, optional)

    def column(f: T.StructField) -> Column:
        if f.name.lower() not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        name = present[f.name.lower()]
        return _cast(F.col(f"`{name}`"), df.schema[name].dataType, f).alias(f.name)

    return df.select([column(f) for f in schema.fields])


def _present(columns: Iterable[str], schema: T.StructType, optional: Iterable[str]) -> dict[str, str]:
    """Stored name by lower-case name; declared columns that are absent and not ``optional`` are an error."""
    present: dict[str, str] = {}
    for c in columns:
        if present.setdefault(c.lower(), c) != c:
            raise ValueError(f"columns {present[c.lower()]} and {c} differ in case only")
    may_lack = {c.lower() for c in optional}
    lacking = [f.name for f in schema.fields if f.name.lower() not in present and f.name.lower() not in may_lack]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return present


def _converted(c: Column, source: T.DataType, f: T.StructField) -> Column:
    """``c`` as the declared type, NULL where it does not fit."""
    if isinstance(f.dataType, T.StringType) and isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
        # A key that came as a number: 100884.0 is '100884'; a fraction is no key.
        whole = c.try_cast("decimal(38,0)")
        return F.when(whole.cast("double") == c.cast("double"), whole.cast("string"))
    return c.try_cast(f.dataType)


def _misfit(c: Column, f: T.StructField) -> Column:
    return F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), c.cast("string"))


def _cast(c: Column, source: T.DataType, f: T.StructField) -> Column:
    """``c`` as the declared type; a value that does not fit is an error."""
    if source == f.dataType or isinstance(source, T.NullType):
        return c.cast(f.dataType)
    out = _converted(c, source, f)
    return F.when(c.isNull() | out.isNotNull(), out).otherwise(F.raise_error(_misfit(c, f)).cast(f.dataType))


def load_text(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None,
              optional: Iterable[str] = (), money_type: str = "decimal(38,0)", sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Headered text files as (good, rejected); every line that is not a header or empty is in one of them.

    Columns are matched by the header's names, without regard to case. A line with another number of cells
    than the header, or with a cell that its declared type cannot hold, is rejected: ``rejected`` has its file,
    its raw text and the reasons, all of them. A repeated header (one a file) is no row. Cells may be quoted,
    but hold no line breaks.
    """
    rows, columns = _lines(spark, path, schema or raw_schema(name, money_type), optional, sep)
    return rows.filter(F.col("reason") == "").select(*columns), rows.filter(F.col("reason") != "").select(*REJECTED)


REJECTED = ("file", "raw", "reason")


def _lines(spark: SparkSession, path: str, schema: T.StructType, optional: Iterable[str], sep: str) -> tuple[DataFrame, list[Column]]:
    """The lines with their cells and the reason to reject them (or an empty one), and the declared columns."""
    header = spark.read.option("header", "true").option("sep", sep).csv(path).columns
    present = _present(header, schema, optional)
    bad = "_malformed"
    while bad in header:
        bad += "_"
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw")) \
        .filter(F.trim("raw") != "")
    # Exploded, so that a line is parsed once: a filter below which a plain column is parsed would parse it anew for each cell.
    parsed = lines.withColumn("c", F.explode(F.array(F.from_csv("raw", ", ".join(f"`{c}` string" for c in [*header, bad]), {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}))))
    cell = lambda c: F.col("c").getField(c)
    is_header = F.lit(True)
    for c in header:
        is_header = is_header & cell(c).eqNullSafe(F.lit(c))
    reasons = [F.when(cell(bad).isNotNull(), F.lit("cells: another number than the header's"))]
    values, columns = {}, []
    for i, f in enumerate(schema.fields):
        if f.name.lower() not in present:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = cell(present[f.name.lower()])
        values[f"value_{i}"] = _converted(c, T.StringType(), f)
        columns.append(F.col(f"value_{i}").alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(cell(bad).isNull() & c.isNotNull() & F.col(f"value_{i}").isNull(), _misfit(c, f)))
    return parsed.filter(~is_header).withColumns(values) \
        .withColumn("reason", F.array_join(F.array(*reasons), "; ")), columns


def publish_text(spark: SparkSession, name: str, path: str, good: str, rejected: str, schema: T.StructType | None = None,
                 optional: Iterable[str] = (), money_type: str = "decimal(38,0)", sep: str = ",") -> dict[str, int]:
    """Loads headered text into two published folders (see :func:`.publish`); returns their rows and the lines read.

    The rows of both must add up to the lines before either becomes current, so none is lost; all are counted
    while they are written.
    """
    rows, columns = _lines(spark, path, schema or raw_schema(name, money_type), optional, sep)
    counters = Counters()
    ok = counters.count(rows, "lines").filter(F.col("reason") == "").select(*columns)
    bad = rows.filter(F.col("reason") != "").select(*REJECTED)
    new_good, new_bad = prepare(counters.count(ok, "good"), good), prepare(counters.count(bad, "rejected"), rejected)
    n = counters.get()
    if n["good"] + n["rejected"] != n["lines"]:
        raise ValueError(f"{path}: {n['lines']} lines, but {n['good']} good and {n['rejected']} rejected")
    switch(spark, rejected, new_bad)
    switch(spark, good, new_good)
    return n


MONTH = "event_month"


def store_by_month(df: DataFrame, table: str, time_col: str = "event_time", path: str | None = None) -> None:
    """Full refresh of a catalog table partitioned by the month of ``time_col`` (column ``event_month``, a NULL
    time in its own partition); each month's rows are dealt to tasks by hash, so a hot month makes several files."""
    spark = df.sparkSession
    month = F.date_format(F.col(time_col), "yyyy-MM")
    out = df.withColumn(MONTH, month)
    if path is None:
        publish_table(out, table, partition_by=[MONTH])
        return
    folder = publish(out, path, partition_by=[MONTH])
    spark.read.option("basePath", folder).parquet(folder).createOrReplaceTempView(table)


def in_window(as_of, days: int, time_col: str = "event_time") -> Column:
    """Condition for the last ``days`` days up to and including ``as_of`` on a table of :func:`store_by_month`: the
    months prune its partitions, the times cut their edges."""
    day = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    first = day - _dt.timedelta(days=days - 1)
    at = F.to_date(F.col(time_col))
    return F.col(MONTH).between(f"{first:%Y-%m}", f"{day:%Y-%m}") & at.between(F.lit(first), F.lit(day))


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite a path or a catalog table in place. Between the deletion and the end of the write there is no
    table; :mod:`.publish` refreshes without that gap."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is not None:
        writer.saveAsTable(table)
    elif path is not None:
        writer.save(path)
    else:
        raise ValueError("give a path or a table")
