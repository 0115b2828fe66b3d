"""Metadata-driven ingestion: feed list, file choice, transform steps, alignment, load and log."""

from __future__ import annotations

import datetime as dt
import fnmatch
import logging
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import fixed

log = logging.getLogger(__name__)

# ---- column transforms ----------------------------------------------------------------


def _present(c: Column) -> Column:
    """Trimmed text; null for '' and NULL."""
    t = F.trim(c.cast("string"))
    return F.when((t != "") & (F.upper(t) != "NULL"), t)


def clean_date(c: Column) -> Column:
    """Timestamp or date text of several formats as 'yyyy-MM-dd[ HH:mm:ss]'; null if none fits."""
    t = _present(c)
    ts = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in fixed.TIMESTAMP_FORMATS])
    day = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in fixed.DATE_FORMATS])
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.date_format(day, "yyyy-MM-dd"))


def month_start(c: Column) -> Column:
    """First day of the month named by the first six digits (yyyymm); null if they name none."""
    digits = F.regexp_replace(F.trim(c.cast("string")), r"\D+", "")
    six = F.when(F.char_length(digits) >= 6, F.substring(digits, 1, 6))
    return F.try_to_timestamp(F.concat(six, F.lit("01")), F.lit("yyyyMMdd")).cast("date")


def clean_numeric(c: Column) -> Column:
    """Number text: brackets and a trailing minus become a leading minus, commas and spaces go; stays text."""
    t = F.regexp_replace(_present(c), fixed.NUMBER_IN_BRACKETS, "-$1")
    return F.regexp_replace(F.regexp_replace(t, fixed.NUMBER_MARKS, ""), fixed.TRAILING_MINUS, "-$1")


def clean_identifier(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), fixed.NUMBER_MARKS, ""), fixed.DECIMAL_ZEROS, "")


# ---- the step language: "step; step:col|col; step:src->dst" ----------------------------

Step = Callable[[DataFrame, str], DataFrame]


def _on_columns(make: Callable[[Column], Column], name: str) -> Step:
    def run(df: DataFrame, arg: str) -> DataFrame:
        wanted = [c.strip() for c in arg.split("|") if c.strip()]
        for missing in (c for c in wanted if c not in df.columns):
            log.warning("%s: no column %s", name, missing)
        return df.withColumns({c: make(F.col(c)) for c in wanted if c in df.columns})

    return run


def _trim_all(df: DataFrame, _: str) -> DataFrame:
    return df.select([F.trim(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def _identifiers(df: DataFrame, _: str) -> DataFrame:
    return df.withColumns({c: clean_identifier(F.col(c)) for c in fixed.IDENTIFIERS if c in df.columns})


def _month(df: DataFrame, arg: str) -> DataFrame:
    source, _, target = (p.strip() for p in arg.partition("->"))
    if source not in df.columns:
        log.warning("month_parse: no column %s", source)
        return df
    return df.withColumn(target or source, month_start(F.col(source)))


def _valid_months(df: DataFrame, _: str) -> DataFrame:
    if "per_year" not in df.columns:
        log.warning("drop_invalid_months: no column per_year")
        return df
    return df.where(F.col("per_year").isNotNull())


STEPS: dict[str, Step] = {
    "trim_all": _trim_all,
    "po_fix": _identifiers,
    "date_parse": _on_columns(clean_date, "date_parse"),
    "month_parse": _month,
    "numeric_clean": _on_columns(clean_numeric, "numeric_clean"),
    "drop_invalid_months": _valid_months,
}


def apply_steps(df: DataFrame, text: str | None) -> DataFrame:
    """Fold the steps of a step text over ``df``; unknown steps are skipped with a warning."""
    for part in (p.strip() for p in (text or "").split(";")):
        name, _, arg = part.partition(":")
        if not part:
            continue
        if name.strip() in STEPS:
            df = STEPS[name.strip()](df, arg.strip())
        else:
            log.warning("unknown step: %s", part)
    return df


# ---- shape ----------------------------------------------------------------------------


def apply_header(df: DataFrame, header: list[str]) -> DataFrame:
    """Name columns by a list, cut to its length or filled up with nulls."""
    if not header:
        return df
    old = df.columns
    return df.select(*[(F.col(f"`{old[i]}`") if i < len(old) else F.lit(None).cast("string")).alias(n) for i, n in enumerate(header)])


def check_width(df: DataFrame, header: list[str]) -> None:
    expected = [h for h in header if h.lower() != "load_current_timestamp"]
    if len(df.columns) != len(expected):
        raise ValueError(f"expected {len(expected)} columns, found {len(df.columns)}; first row: {df.first()}")


def align(df: DataFrame, target: list[str]) -> DataFrame:
    """Columns of the target in its order and spelling, matched without case; absent ones are null strings."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(own[t.lower()]) if t.lower() in own else F.lit(None).cast("string")).alias(t) for t in target])


def as_strings(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def add_audit(df: DataFrame, column: str | None, at: dt.datetime) -> DataFrame:
    return df.withColumn(column, F.lit(at).cast("timestamp")) if column else df


def filter_text(df: DataFrame, where: str | None) -> DataFrame:
    """A filter written as text; '', FULL, 0 and NONE mean none."""
    return df if (where or "").strip().upper() in ("", "FULL", "0", "NONE") else df.where(where)


def project(df: DataFrame, mapping: dict[str, str], constants: dict[str, str] | None = None, numbers: list[str] | None = None) -> DataFrame:
    """Target columns from source columns, constants, and null where the source lacks one; number columns are cast where they can be."""
    own = {c.lower(): c for c in df.columns}

    def number(c: Column) -> Column:
        t = F.lower(F.trim(c.cast("string")))
        return F.when(t.isin("true", "yes", "y"), 1.0).when(t.isin("false", "no", "n"), 0.0).otherwise(t.try_cast("double"))

    def one(target: str, source: str) -> Column:
        c = F.col(f"`{own[source.lower()]}`").cast("string") if source.lower() in own else F.lit(None).cast("string")
        return (number(c) if target in (numbers or []) else c).alias(target)

    fixed_columns = [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    return df.select(*[one(t, s) for t, s in mapping.items()], *fixed_columns)


def drop_corrupt_labels(df: DataFrame, column: str, most: int = 40) -> DataFrame:
    return df.where(F.char_length(column) <= most)


# ---- files ----------------------------------------------------------------------------


class FileStore(Protocol):
    """Where feeds come from; a local folder or a remote server behind the same two calls."""

    def list(self, folder: str) -> list[str]: ...

    def path(self, folder: str, name: str) -> str: ...


@dataclass
class HadoopStore:
    """Files of any file system that the cluster reads."""

    spark: SparkSession

    def list(self, folder: str) -> list[str]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        system = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isFile())

    def path(self, folder: str, name: str) -> str:
        return f"{folder.rstrip('/')}/{name}"


@dataclass
class FtpStore:
    """Files of an FTP server, over TLS by default; a file is fetched once to a staging folder that the cluster reads."""

    spark: SparkSession
    host: str
    user: str
    password: str
    staging: str
    secure: bool = True

    def _connect(self):  # noqa: ANN202
        import ftplib

        server = (ftplib.FTP_TLS if self.secure else ftplib.FTP)(self.host, self.user, self.password)
        if self.secure:
            server.prot_p()
        return server

    def list(self, folder: str) -> list[str]:
        with self._connect() as server:
            return sorted(n.rsplit("/", 1)[-1] for n in server.nlst(folder or "."))

    def fetch(self, folder: str, names: list[str]) -> dict[str, str]:
        """First phase of a load: fetch files; paths by name.  The server is not needed after it."""
        return {name: self.path(folder, name) for name in names}

    def path(self, folder: str, name: str) -> str:
        jvm = self.spark.sparkContext._jvm
        target = f"{self.staging.rstrip('/')}/{name}"
        where = jvm.org.apache.hadoop.fs.Path(target)
        out = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
        try:
            with self._connect() as server:
                server.retrbinary(f"RETR {folder.rstrip('/')}/{name}", lambda block: out.write(bytearray(block)))
        finally:
            out.close()
        return target


def pick_latest(names: list[str], pattern: str) -> str | None:
    """The last name, in order, that fits a glob, else that equals the pattern without case, else that fits it as a regex."""
    for fits in (
        lambda n: fnmatch.fnmatch(n.lower(), pattern.lower()),
        lambda n: n.lower() == pattern.lower(),
        lambda n: _searches(pattern, n),
    ):
        found = sorted(n for n in names if fits(n))
        if found:
            return found[-1]
    return None


def _searches(pattern: str, name: str) -> bool:
    try:
        return re.search(pattern, name, re.I) is not None
    except re.error:
        return False


def choose_files(names: list[str], wanted: list[str] | None = None, suffix: str = ".csv") -> tuple[list[str], list[str]]:
    """Files to load and those that are missing: the wanted names if any, else all with the suffix."""
    if wanted:
        have = set(names)
        return [n for n in wanted if n in have], [n for n in wanted if n not in have]
    return [n for n in names if n.lower().endswith(suffix)], []


def headerless(meta: dict) -> bool:
    """Whether a feed's file has no header row: it names its columns itself and is not marked as having one."""
    return bool((meta.get("HEADER") or "").strip()) and (meta.get("HAS_HEADER") or "").strip().upper() not in ("1", "Y", "YES", "TRUE")


def delimiter_of(meta: dict) -> str:
    text = meta.get("MULTI_DELIMITER") or meta.get("FILE_DELIMITER") or ","
    return {"TAB": "\t", "\\T": "\t", "PIPE": "|", "COMMA": ","}.get(text.upper(), text)


def read_source(spark: SparkSession, path: str, meta: dict) -> DataFrame:
    """A feed's file as strings; a delimiter of several characters is split literally, missing parts are null."""
    sep = delimiter_of(meta)
    if len(sep) > 1 and headerless(meta):
        n = len([h for h in meta["HEADER"].split(",") if h.strip()])
        parts = F.split("value", re.escape(sep))
        return spark.read.text(path).select(*[F.get(parts, F.lit(i)).alias(f"_c{i}") for i in range(n)])
    return spark.read.csv(path, sep=sep, header=not headerless(meta), inferSchema=False)


def load_metadata(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Feeds that are switched on, trimmed, by priority (bad ones last)."""
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
    trimmed = raw.select([F.trim(F.col(c)).alias(c.strip().upper()) for c in raw.columns])
    return active_feeds(trimmed)


def active_feeds(meta: DataFrame) -> DataFrame:
    priority = F.coalesce(F.col("PRIORITY").try_cast("int"), F.lit(9999))
    on = F.coalesce(F.col("LOAD_FREQUENCY"), F.lit("1")) != "0"
    return meta.where(on).withColumn("PRIORITY_NO", priority).orderBy("PRIORITY_NO", "SOURCE_TABLE_NAME")


# ---- run ------------------------------------------------------------------------------

LOG_SCHEMA = "run_ts timestamp, feed string, file string, status string, n_rows long, message string"
MOST_MESSAGE = 8000


@dataclass
class RunLog:
    """Events of a run; writing them never breaks the run."""

    spark: SparkSession
    path: str | None = None
    events: list[tuple] = field(default_factory=list)

    def add(self, feed: str, file: str | None, status: str, n_rows: int = 0, message: str = "") -> None:
        event = (dt.datetime.now(dt.UTC).replace(tzinfo=None), feed, file, status, n_rows, message[:MOST_MESSAGE])
        self.events.append(event)
        if self.path:
            try:
                self.spark.createDataFrame([event], LOG_SCHEMA).write.mode("append").parquet(self.path)
            except Exception:
                log.exception("the run log could not be written")

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.events, LOG_SCHEMA)


def run_summary(events: DataFrame) -> DataFrame:
    """(feed, status, n_rows, message): the last event of each feed of a run log, SKIPPED feeds included."""
    last = events.groupBy("feed").agg(F.max_by(F.struct("status", "n_rows", "message"), F.struct("run_ts", F.when(F.col("status") == "STARTED", 0).otherwise(1))).alias("x"))
    return last.select("feed", "x.*")


def summary_mail(summary: DataFrame, sender: str, receivers: list[str], subject: str = "Feed run"):  # noqa: ANN201
    """A mail of a run's summary: counts by status in the subject, a table in text and HTML."""
    from email.message import EmailMessage
    from html import escape

    rows = summary.orderBy("feed").collect()
    counts: dict[str, int] = {}
    for r in rows:
        counts[r.status] = counts.get(r.status, 0) + 1
    mail = EmailMessage()
    mail["From"], mail["To"] = sender, ", ".join(receivers)
    mail["Subject"] = f"{subject}: " + ", ".join(f"{n} {s}" for s, n in sorted(counts.items()))
    mail.set_content("\n".join(f"{r.feed}\t{r.status}\t{r.n_rows}\t{r.message}" for r in rows))
    cells = "".join("<tr>" + "".join(f"<td>{escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
    mail.add_alternative(f"<table><tr><th>feed</th><th>status</th><th>rows</th><th>message</th></tr>{cells}</table>", subtype="html")
    return mail


def send_mail(mail, host: str, port: int = 25) -> None:  # noqa: ANN001
    import smtplib

    with smtplib.SMTP(host, port) as server:
        server.send_message(mail)


def run_hook(spark: SparkSession, text: str | None) -> bool:
    """Run a SQL text; '', TRUE, FALSE and NULL mean none."""
    if (text or "").strip().upper() in ("", "TRUE", "FALSE", "NULL"):
        return False
    spark.sql(text)
    return True


def build_feed(spark: SparkSession, path: str, meta: dict, target: list[str] | None = None, at: dt.datetime | None = None) -> DataFrame:
    """The plan of one feed: read, header, strings, steps, filter, audit column, alignment."""
    header = [h.strip() for h in (meta.get("HEADER") or "").replace("\n", ",").split(",") if h.strip()]
    df = as_strings(apply_header(read_source(spark, path, meta), header))
    df = filter_text(apply_steps(df, meta.get("TRANSFORMS")), meta.get("WHERE"))
    df = add_audit(df, meta.get("AUDIT_TS_COL"), at or dt.datetime.now(dt.UTC).replace(tzinfo=None))
    return align(df, target) if target else df


def run_feeds(spark: SparkSession, feeds: list[dict], store: FileStore, sink: Callable[[DataFrame, dict], int], run_log: RunLog, targets: dict[str, list[str]] | None = None) -> DataFrame:
    """Load feeds in order; a feed that fails is logged and the others go on.  Rows are counted by the sink, so files are read once."""
    for meta in feeds:
        name, file = meta.get("SOURCE_TABLE_NAME") or "?", None
        try:
            if str(meta.get("LOAD_FREQUENCY") or "1") == "0":
                run_log.add(name, None, "SKIPPED")
                continue
            if (meta.get("READER_TYPE") or "").upper() in ("POST_SQL_ONLY", "FUNC", "PROC"):
                ran = run_hook(spark, meta.get("SQL_TEXT") or meta.get("POST_SQL"))
                run_log.add(name, None, "SUCCESS" if ran else "SKIPPED")
                continue
            run_hook(spark, meta.get("PRE_SQL"))
            folder = meta.get("LOCAL_PATH") or meta.get("REMOTE_DIR") or ""
            file = pick_latest(store.list(folder), meta.get("LATEST_REGEX") or "*")
            if file is None:
                raise FileNotFoundError(f"no file in {folder} fits {meta.get('LATEST_REGEX')}")
            run_log.add(name, file, "STARTED")
            n = sink(build_feed(spark, store.path(folder, file), meta, (targets or {}).get(name)), meta)
            run_hook(spark, meta.get("POST_SQL"))
            run_log.add(name, file, "SUCCESS", n)
        except Exception as e:
            run_log.add(name, file, "FAILED", 0, str(e))
    return run_log.frame()
