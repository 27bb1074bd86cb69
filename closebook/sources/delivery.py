"""Statement export, report files per client, and the log of deliveries."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from itertools import batched, groupby
from typing import Any
from urllib.parse import unquote
from uuid import uuid4

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.operators import reports
from closebook.operators.skew import HOT_ROWS, dealt, place_by_key
from closebook.operators.statement import order_statement
from closebook.session import COMPACT, Scratch, delete, hadoop_path

# What can happen to an attempt. At the same time the last one counts.
FAILED, SENT, CONFIRMED = STATES = ("FAILED", "SENT", "CONFIRMED")
# States after which a statement is not sent again.
DELIVERED = (SENT, CONFIRMED)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("StatementId", T.StringType()),
        T.StructField("CustomerId", T.StringType()),
        T.StructField("DeliveryStatus", T.StringType()),
        T.StructField("AttemptedAt", T.TimestampType()),
        T.StructField("Attempt", T.IntegerType()),
        T.StructField("EventId", T.StringType()),
        T.StructField("PositionPeriod", T.DateType()),
    ]
)
KEY = ["StatementId", "PositionPeriod"]
EVENT = [name for name in LOG_SCHEMA.names if name != "EventId"]
# With a file or more per client, tasks put theirs in place themselves; else the driver moves one after the other. A task that
# is repeated writes files of the same names.
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def export_statements(statement: DataFrame, folder: str, period: date, derived: Sequence[str] = ()) -> str:
    """Write the ordered statement as sharded CSV files below a folder named after the closed month.

    For ``derived`` columns see :func:`order_statement`.
    """
    target = f"{folder.rstrip('/')}/{period:%Y-%m-%d}"
    order_statement(statement, derived).write.mode("overwrite").options(header=True, sep=",").csv(target)
    return target


def export_per_client(statement: DataFrame, folder: str, period: date, hot_rows: int = HOT_ROWS) -> str:
    """Write the closed month's statements, one folder per client below the month's folder.

    A client's rows come from one task and make one file; a client with more than ``hot_rows`` rows
    is split over several.
    """
    target = f"{folder.rstrip('/')}/period={period:%Y-%m-%d}"
    closed = statement.filter(F.col("PositionPeriod") == F.lit(period)).withColumn("client_id", F.col("CustomerId"))
    with Scratch(statement.sparkSession) as scratch:  # the rows are read twice: to count, then to write
        rows = scratch.keep(closed, "closed-month")
        placed = place_by_key(rows, ["client_id"], by=["StatementId", "CustodianLedgerRef"], min_rows=hot_rows)
        ordered = placed.sortWithinPartitions("client_id", "Symbol")
        local = _local(statement.sparkSession, target)
        if local is None:
            ordered.write.mode("overwrite").partitionBy("client_id").options(header=True, **MANY_FILES).csv(target)
            return target
        fs, folder = hadoop_path(statement.sparkSession, target)
        delete(statement.sparkSession, target)
        fs.mkdirs(folder)
        files = _write_lines(ordered, "client_id", statement.columns, {}, _in_client_folders(local))
        found, expected = files.agg(F.sum("Rows")).first()[0] or 0, rows.count()
        if found != expected:
            raise RuntimeError(f"{found} of {expected} rows were written below {target}")
        fs.create(hadoop_path(statement.sparkSession, target, "_SUCCESS")[1]).close()
    return target


# Files that tasks write themselves, where a file system is mounted. Spark's writer needs some 20 ms of a core for a small file there,
# as Hadoop starts a program to set the permissions of each file and of its checksums.

WRITTEN = "File string, Rows bigint, Bytes bigint, Sha256 string"


def _local(spark: SparkSession, folder: str) -> str | None:
    """The folder as a path for tasks, or None if it lies in a store that only Spark's readers and writers reach."""
    fs, path = hadoop_path(spark, folder)
    return path.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _write_lines(rows: DataFrame, key: str, columns: Sequence[str], options: Mapping[str, str], place: Callable[[str | None], str]) -> DataFrame:
    """Rows, which come sorted by a key, as CSV files with a header: one for each run of a key in a task, where ``place`` says.

    Writing happens when the result is read: one row per file, with size and SHA-256 of what is stored. A line is what Spark's
    own CSV writer makes of the row. A file gets its name when it is complete, so a task that is repeated replaces its files.
    """
    names = F.struct(*[F.lit(name).alias(f"c{n}") for n, name in enumerate(columns)])
    header = rows.sparkSession.range(1).select(F.to_csv(names, dict(options))).first()[0]
    lines = rows.select(key, F.to_csv(F.struct(*[F.col(f"`{name}`") for name in columns]), dict(options)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for some in batched((_write_file(place(k), header, (line for _, line in run)) for k, run in groupby(pairs, lambda pair: pair[0] or None)), 1000):
            yield pa.RecordBatch.from_pylist(list(some), schema=pa.schema([("File", pa.string()), ("Rows", pa.int64()), ("Bytes", pa.int64()), ("Sha256", pa.string())]))

    return lines.mapInArrow(write, WRITTEN)


def _write_file(path: str, header: str, lines: Iterable[str]) -> dict[str, Any]:
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{uuid4().hex}")
    try:
        with open(hidden, "w", encoding="utf-8", newline="") as file:
            file.write(f"{header}\n")
            count = sum(file.write(f"{line}\n") > 0 for line in lines)
        os.replace(hidden, path)
    finally:
        if os.path.exists(hidden):
            os.remove(hidden)
    with open(path, "rb") as file:
        return {"File": name, "Rows": count, "Bytes": os.fstat(file.fileno()).st_size, "Sha256": hashlib.file_digest(file, "sha256").hexdigest()}


def _in_client_folders(folder: str) -> Callable[[str | None], str]:
    """Where a client's file goes that a task writes: folders are named as Spark names those of a partition column."""
    run = uuid4().hex

    def place(client: str | None) -> str:
        safe = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda found: f"%{ord(found[0]):02X}", client or "__HIVE_DEFAULT_PARTITION__")
        return f"{folder}/client_id={safe}/part-{TaskContext.get().partitionId():05d}-{run}.csv"

    return place


# Report files.

FILE_ROWS = 200_000  # of a client's report in one file, about
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "CustomerId string, File string, Rows bigint, Bytes bigint, Sha256 string"
MOVES = 16  # files that are moved at once
_CLIENT, _FILE, _PART = "_client", "_file", "_part"


def destination(config: Mapping[str, Any], root: str, period: date) -> str:
    """The folder of a report's files: the configured path, with the period filled in, below ``root``."""
    path = config["delivery"]["destination_path"].replace("{period}", f"{period:%Y-%m-%d}")
    return f"{root.rstrip('/')}/{path.strip('/')}"


def file_name(config: Mapping[str, Any], client: Column, part: Column, period: date) -> Column:
    """The configured file name with client and period filled in; further parts get their number before the extension.

    Characters of a client identifier that a file name should not hold are percent-encoded.
    """
    text = config["delivery"]["filename_template"].replace("{period}", f"{period:%Y-%m-%d}")
    before, _, after = text.partition("{client_id}")
    stem, dot, extension = after.rpartition(".")
    if not dot:
        stem, extension = extension, ""
    safe = F.replace(F.url_encode(client), F.lit("*"), F.lit("%2A"))
    number = F.when(part > 1, F.concat(F.lit("."), part.cast("string"))).otherwise("")
    return F.concat(F.lit(before), safe, F.lit(stem), number, F.lit(dot + extension))


def deliver_report(config: Mapping[str, Any], source: DataFrame, root: str, period: date, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write a report as a CSV file per client, in the place and under the name its configuration gives, and return the manifest.

    ``source`` holds the report's columns, ``CustomerId`` and ``PositionPeriod``; rows of other months
    stay out. The client travels beside the report's own columns and is in no file. A client with many
    rows gets a further file for about every ``file_rows`` of them (``name.2.csv`` and so on), each with a
    header and in the report's order. Rows without a client cannot be delivered and raise before anything is written.

    What an earlier run left in the folder goes first. Tasks write the files; in a store that only Spark's writer reaches, it
    writes to a staging folder inside and the driver, which handles their names only, moves each file to its own. The
    manifest (client, file, rows, bytes, SHA-256 of the file) is made last, from the files as stored, so a folder that
    has one is complete, and a run that stopped is simply repeated.
    """
    wanted = config["delivery"]
    if wanted.get("format", "csv") != "csv":
        raise ValueError(f"unknown delivery format {wanted['format']!r}")
    if "{client_id}" not in wanted["filename_template"]:
        raise ValueError("the file name must hold {client_id}")
    spark = source.sparkSession
    target = destination(config, root, period)
    staging = f"{target}/_staging"
    closed = source.filter(F.col("PositionPeriod") == F.lit(period))
    with Scratch(spark) as scratch:
        rows = scratch.keep(reports.rows(config, closed, carried={"CustomerId": _CLIENT}), "report")
        columns = [name for name in rows.columns if name != _CLIENT]
        if not rows.filter(F.col(_CLIENT).isNull()).isEmpty():
            raise ValueError("the report has rows without a client")
        named = _in_parts(rows, columns, file_rows).withColumn(_FILE, file_name(config, F.col(_CLIENT), F.col(_PART), period))
        sort = [name for name in reports.SORT_COLUMNS if name in columns]
        order = [F.col(f"`{name}`") for name in [*sort, *[name for name in columns if name not in sort]]]
        # Amounts as plain digits: a writer left alone turns very small ones into powers of ten.
        plain = [F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in rows.schema if f.name != _CLIENT]
        # As many tasks as there are shuffle partitions, however few rows: with many small files creating them takes the time.
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // file_rows))
        placed = named.repartition(tasks, _FILE).sortWithinPartitions(_FILE, *order).select(_FILE, *plain)
        delete(spark, target)
        local = _local(spark, target)
        if local is None:
            placed.write.partitionBy(_FILE).options(header=True, escape='"', **MANY_FILES).csv(staging)
            _move_files(spark, staging, target)
            delete(spark, staging)
            found = _digests(spark, target)
        else:
            written = _write_lines(placed, _FILE, columns, {"escape": '"'}, lambda name: f"{local}/{name}")
            found = scratch.keep(written, "files").select("File", "Bytes", "Sha256")
        counts = named.groupBy(F.col(_FILE).alias("File"), F.col(_CLIENT).alias("CustomerId")).agg(F.count(F.lit(1)).alias("Rows"))
        manifest = scratch.keep(counts.join(found, "File", "full"), "manifest")
        if not manifest.filter("Rows IS NULL OR Sha256 IS NULL").isEmpty():
            raise RuntimeError(f"files and rows of the report differ below {target}")
        manifest.select("CustomerId", "File", "Rows", "Bytes", "Sha256").write.parquet(f"{target}/{MANIFEST}")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{target}/{MANIFEST}")


def _in_parts(rows: DataFrame, columns: list[str], file_rows: int) -> DataFrame:
    """Rows with the number of the file of their client they go to; only clients with several files are dealt by a hash."""
    files = F.ceil(F.col("n") / file_rows).cast("int")
    large = rows.groupBy(_CLIENT).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > file_rows).select(_CLIENT, files.alias("_files"))
    # Fewer than rows / file_rows clients, and Spark may still choose another join by their size.
    dealt = rows.join(large, _CLIENT, "left")
    part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in columns]), F.col("_files")).cast("int") + 1
    return dealt.withColumn(_PART, F.coalesce(part, F.lit(1))).drop("_files")


def _move_files(spark: SparkSession, staging: str, target: str) -> None:
    """Give every file of a staging folder the name of the folder that Spark wrote it to."""
    fs, root = hadoop_path(spark, staging)
    if not fs.exists(root):
        return
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    into = hadoop_path(spark, target)[1]

    def move(part: str) -> None:
        folder = part.rsplit("/", 2)[1]
        name = unquote(folder.removeprefix(f"{_FILE}="))
        if not fs.rename(paths(part), paths(into, name)):
            raise RuntimeError(f"could not move {part} to {name}")

    found, parts = fs.listFiles(root, True), []
    while found.hasNext():
        part = found.next().getPath().toString()
        if f"/{_FILE}=" in part and part.rsplit("/", 1)[1].startswith("part-"):
            parts.append(part)
    if len({part.rsplit("/", 1)[0] for part in parts}) < len(parts):
        raise RuntimeError(f"several parts of one report file below {staging}")
    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(move, parts))


def _digests(spark: SparkSession, target: str) -> DataFrame:
    """Name, size and SHA-256 of the files of a folder, read by tasks; files are bounded by their rows."""
    fs, path = hadoop_path(spark, target)
    shape = "File string, Bytes bigint, Sha256 string"
    if not fs.exists(path) or not any(s.isFile() for s in fs.listStatus(path)):
        return spark.createDataFrame([], shape)
    files = spark.read.format("binaryFile").load(target)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("File"), F.col("length").alias("Bytes"), F.sha2("content", 256).alias("Sha256"))


# The log of deliveries: events are only ever added. Identifiers are most of its bytes. That of an event follows from other columns,
# so it is made last, when rows are where they are written, and nothing is joined by it.

NO_STATEMENT = "\0"  # stands for a missing StatementId where rows are dealt by it


def _event_id(attempt: Column, status: Column) -> Column:
    return F.sha2(F.concat_ws("|", "StatementId", F.col("PositionPeriod").cast("string"), attempt.cast("string"), status), 256)


def _events(like: DataFrame, path: str) -> DataFrame:
    """All events below ``path``, some perhaps twice, which changes neither a state nor what is pending."""
    spark = like.sparkSession
    fs, folder = hadoop_path(spark, path)
    if not fs.exists(folder):
        return spark.createDataFrame([], LOG_SCHEMA).limit(0)  # of which Spark knows that it is empty
    found = spark.read.schema(LOG_SCHEMA).parquet(path)
    attempt = F.coalesce("Attempt", F.lit(1))  # events from before attempts were numbered
    known = found.withColumn("EventId", F.coalesce("EventId", _event_id(attempt, F.col("DeliveryStatus")))).withColumn("Attempt", attempt)
    return known


def read_log(like: DataFrame, path: str) -> DataFrame:
    """All events below ``path``, each once: an append that crashed and was repeated may have left some twice."""
    return dealt(_events(like, path), KEY).dropDuplicates([*KEY, "Attempt", "DeliveryStatus"])


def current_state(log: DataFrame, *more: Column) -> DataFrame:
    """One row per statement: its latest status with time and attempt, and the number of events.

    Of events at the same time the one further on counts: failed, sent, confirmed. ``more`` aggregates follow.
    """
    rank = F.lit(0)
    for number, state in enumerate(STATES, start=1):
        rank = F.when(F.col("DeliveryStatus") == state, number).otherwise(rank)
    last = F.max_by(F.struct("CustomerId", "DeliveryStatus", "AttemptedAt", "Attempt"), F.struct("AttemptedAt", rank, "Attempt"))
    state = log.groupBy(*KEY).agg(last.alias("last"), F.count(F.lit(1)).alias("Events"), *more)
    return state.select(*KEY, "last.*", "Events", *[F.col(name) for name in state.columns if name not in (*KEY, "last", "Events")])


def _pending(statement: DataFrame, log: DataFrame, run_ts: Column, status: str, outcomes: DataFrame | None) -> DataFrame:
    """The events of :func:`pending_deliveries` without their identifiers; statements, log and outcomes are dealt by StatementId, each once."""
    at = run_ts.cast("timestamp")
    key = F.coalesce("StatementId", F.lit(NO_STATEMENT)).alias("_statement")
    attempts = statement.select(key, "CustomerId", "PositionPeriod").dropDuplicates(["_statement"])
    # The month is part of the identifier; joining on it as well lets the log be read by partition.
    by = ["_statement", "PositionPeriod"]
    done = F.max(F.coalesce(F.col("DeliveryStatus").isin(*DELIVERED) | (F.col("AttemptedAt") == at), F.lit(False)))
    logged = dealt(log.select(key, "PositionPeriod", "Attempt", "DeliveryStatus", "AttemptedAt"), ["_statement"])
    known = logged.groupBy(*by).agg(F.max("Attempt").alias("_last"), done.alias("_done"))
    new = attempts.join(known, by, "left").filter("_done IS NULL OR NOT _done")
    result = F.lit(status)
    if outcomes is not None:
        went = outcomes.select(key, "Delivered").groupBy("_statement").agg(F.bool_and("Delivered").alias("_delivered"))
        # Outcomes without a statement say nothing about one.
        went = went.filter(F.col("_statement") != NO_STATEMENT)
        new = new.join(went, "_statement", "left")
        result = F.when(~F.col("_delivered"), FAILED).otherwise(status)
    new = new.withColumn("DeliveryStatus", result).withColumn("Attempt", F.coalesce(F.col("_last") + 1, F.lit(1)))
    return new.withColumns({"StatementId": F.when(F.col("_statement") != NO_STATEMENT, F.col("_statement")), "AttemptedAt": at}).select(*EVENT)


def _identified(events: DataFrame) -> DataFrame:
    return events.withColumn("EventId", _event_id(F.col("Attempt"), F.col("DeliveryStatus"))).select(*LOG_SCHEMA.names)


def pending_deliveries(statement: DataFrame, log: DataFrame, run_ts: Column, status: str = SENT, outcomes: DataFrame | None = None) -> DataFrame:
    """The next attempt of every statement that no earlier one has delivered, one event per StatementId.

    ``outcomes`` (StatementId, Delivered) says how attempts went: FAILED where it is false, else ``status``.
    A failed attempt stands in the way of no later one, but a run, known by ``run_ts``, attempts a
    statement once: repeating it adds nothing to what it has logged.
    """
    return _identified(_pending(statement, log, run_ts, status, outcomes))


def _confirmed(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """The events of :func:`confirmations` without their identifiers, none that the log holds; log and receipts are dealt by StatementId, each once."""
    first = receipts.groupBy("StatementId").agg(F.min("ReceivedAt").alias("_received"))
    before = F.collect_set(F.when(F.col("DeliveryStatus") == CONFIRMED, F.col("Attempt"))).alias("_confirmed")
    state = current_state(dealt(log.drop("EventId"), ["StatementId"]), before)
    sent = state.filter((F.col("DeliveryStatus") == SENT) & ~F.array_contains("_confirmed", F.col("Attempt"))).join(first, "StatementId")
    at = F.greatest("AttemptedAt", F.col("_received").cast("timestamp"))
    return sent.withColumns({"AttemptedAt": at, "DeliveryStatus": F.lit(CONFIRMED)}).select(*EVENT)


def confirmations(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """CONFIRMED events for statements whose last state is SENT and that ``receipts`` (StatementId, ReceivedAt) names.

    The first receipt counts; its time is not earlier than the attempt it confirms, whatever the other side's clock says.
    """
    return _identified(_confirmed(log, receipts))


def unexpected_receipts(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipts for statements that were never sent, or whose last attempt failed."""
    sent = current_state(log).filter(F.col("DeliveryStatus").isin(*DELIVERED))
    return receipts.join(sent.select("StatementId"), "StatementId", "left_anti")


def _append(events: DataFrame, path: str) -> None:
    """Add events that the log does not hold yet."""
    placed = _identified(events.hint("rebalance", "PositionPeriod"))
    placed.write.mode("append").option("compression", COMPACT).partitionBy("PositionPeriod").parquet(path)


def record_deliveries(
    statement: DataFrame, path: str, run_ts: Column, status: str = SENT, outcomes: DataFrame | None = None
) -> None:
    """Log the pending deliveries; see :func:`pending_deliveries`. A run that crashed while it appended is repeated as it was.

    What is pending has a higher attempt than all events of its statement, so none of it is in the log.
    """
    _append(_pending(statement, _events(statement, path), run_ts, status, outcomes), path)


def confirm_deliveries(receipts: DataFrame, path: str) -> None:
    """Log the confirmations that ``receipts`` give; repeating the call adds nothing."""
    _append(_confirmed(_events(receipts, path), receipts), path)
