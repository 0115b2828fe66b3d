"""Writers: tables, JDBC, CSV, report folders, caches, and table definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.files import sql_name


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None, batch: int = 5000) -> None:
    """``mode``: append, replace, or truncate (empties the table but keeps its definition)."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch), "stringtype": "unspecified", **(properties or {})}
    writer = df.write.format("jdbc").options(**options)
    if mode == "truncate":
        writer.option("truncate", "true").mode("overwrite").save()
    else:
        writer.mode({"append": "append", "replace": "overwrite"}[mode]).save()


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that holds ``n`` once it was written: no second scan."""
    seen = Observation("rows")
    return df.observe(seen, F.count("*").alias("n")), seen


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> int:
    """Returns the number of rows written."""
    out, seen = counted(df)
    writer = out.write.mode("overwrite" if mode in ("replace", "truncate") else mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return int(seen.get["n"])


def append_whole(df: DataFrame, folder: str, load: str) -> int:
    """Add one load (a file's rows, say) to a folder of loads, all or nothing; a load of the same name is replaced.

    Rows are staged in a folder that readers do not see and come into sight by one rename.  Returns their number.
    """
    spark = df.sparkSession
    base, name = folder.rstrip("/"), sql_name(load)
    n = write_parquet(df, f"{base}/_staged-{name}", "replace")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    staged, target = path(f"{base}/_staged-{name}"), path(f"{base}/load={name}")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(target, True)
    if not system.rename(staged, target):
        raise OSError(f"could not rename {staged.toString()} to {target.toString()}")
    return n


def write_table(df: DataFrame, table: str, mode: str = "append", partition_by: list[str] | None = None, bucket_by: tuple[int, str] | None = None) -> None:
    writer = df.write.mode("overwrite" if mode in ("replace", "truncate") else mode).format("parquet")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.bucketBy(*bucket_by).sortBy(bucket_by[1]) if bucket_by else writer).saveAsTable(table)


def append_checked(df: DataFrame, table: str, types: dict[str, str], dry_run: bool = False) -> DataFrame:
    """Cast to the given types and append to a table that must exist; a dry run only returns what it would write."""
    out = df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    if not dry_run:
        if not df.sparkSession.catalog.tableExists(table):
            raise ValueError(f"no such table: {table}")
        out.write.mode("append").insertInto(table) if out.columns == df.sparkSession.table(table).columns else out.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)
    return out


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_report(sheets: dict[str, DataFrame], path: str, form: str = "parquet") -> list[str]:
    """One folder per sheet: matched, unmatched, summary and so on."""
    targets = []
    for name, df in sheets.items():
        target = f"{path.rstrip('/')}/{sql_name(name)}"
        df.write.mode("overwrite").format(form).options(**({"header": "true"} if form == "csv" else {})).save(target)
        targets.append(target)
    return targets


def with_highlight(df: DataFrame, rules: dict[str, str], name: str = "highlight") -> DataFrame:
    """The colour that a row would have in a workbook: that of the first SQL condition that holds."""
    return df.withColumn(name, F.coalesce(*[F.when(F.expr(cond), F.lit(colour)) for colour, cond in rules.items()]))


def prefixed(ours: DataFrame, theirs: DataFrame, pairs: DataFrame, our_columns: list[str], their_columns: list[str]) -> DataFrame:
    """Matched pairs (our_id, cust_id) with only the columns that took part, as OUR_ and CUST_ columns."""
    a = ours.select("our_id", *[F.col(c).alias(f"OUR_{c}") for c in our_columns])
    b = theirs.select("cust_id", *[F.col(c).alias(f"CUST_{c}") for c in their_columns])
    return pairs.join(a, "our_id").join(b, "cust_id")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def text_table_ddl(table: str, header: list[str]) -> str:
    """Definition of a table of text columns; headers that become one name are an error."""
    names = [sql_name(h) for h in header]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns share a name after cleaning: {', '.join(twice)}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'`{n}` STRING' for n in names)}) USING parquet"


def create_text_table(spark: SparkSession, table: str, header: list[str]) -> None:
    spark.sql(text_table_ddl(table, header))


def result_view(base: DataFrame, result: DataFrame, key: str, name: str) -> DataFrame:
    """Temporary view of the base with the result's columns."""
    joined = base.join(result, key, "left")
    joined.createOrReplaceTempView(name)
    return joined


def cached_by_key(rows: DataFrame, cache_path: str, key: str, work, parts: str | None = None) -> DataFrame:
    """Rows with results; only keys that the cache lacks are worked on, and new results are appended.

    ``work`` takes the missing rows and returns key and result columns; rows that it
    leaves out (failures) are not kept.
    """
    spark = rows.sparkSession
    try:
        known = spark.read.parquet(cache_path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        known = None
    missing = rows if known is None else rows.join(known.select(key), key, "left_anti")
    writer = work(missing.dropDuplicates([key])).write.mode("append")
    (writer.partitionBy(parts) if parts else writer).parquet(cache_path)
    return rows.join(spark.read.parquet(cache_path), key)


def cached_in_batches(rows: DataFrame, cache_path: str, key: str, work, batches: int) -> DataFrame:
    """``cached_by_key`` in batches of keys, each committed before the next begins, so a broken run loses one batch at most."""
    for i in range(batches):
        done = cached_by_key(rows.where(F.pmod(F.xxhash64(key), F.lit(batches)) == i), cache_path, key, work)
    return rows.join(done.sparkSession.read.parquet(cache_path), key)
