"""Inbox folders as a file stream; every micro-batch is one run of the folder jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.config import FOLDER_RANK, JobConfig
from ledgerflow.functions import as_moment
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import ERROR_COLUMNS, ERROR_MESSAGE, conform
from ledgerflow.operators.filters import clean, rejected
from ledgerflow.operators.joins import lookup, mark_existing, narrow
from ledgerflow.operators.keys import stable
from ledgerflow.operators.relational import union_all
from ledgerflow.operators.validate import Rule, flag_repeats, validate
from ledgerflow.plans.run import ATTACHMENTS, error_return, run_folder
from ledgerflow.plans.state import Layers, commit, load_counters
from ledgerflow.plans.tables import Tables
from ledgerflow.sources.attachments import extend_listing
from ledgerflow.sources.rowset import (
    OPTIONS,
    PROVENANCE,
    UNREAD,
    literal_path,
    plain_path,
    read_open_rowset,
    route,
    text_schema,
    whole_files,
    with_line_id,
    with_provenance,
)
from ledgerflow.sources.sinks import append_batch, write_error_files


def intake_stream(
    spark: SparkSession,
    path: str,
    columns: Iterable[str],
    archive: str | None = None,
    max_files: int | None = None,
    once_within: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows of newly arrived rowset files.

    Served files are moved to `archive`. `once_within` is (time column, delay): exact
    copies within that delay are passed on once; off by default.
    """
    reader = (
        spark.readStream.format("xml")
        .options(**OPTIONS)
        .schema(text_schema(columns))
        .option("pathGlobFilter", "*.xml")
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = with_provenance(reader.load(f"{path}/*"))
    if once_within:
        moment, delay = once_within
        rows = rows.withColumn("Arrived", F.col(moment).try_cast("timestamp"))
        rows = rows.withWatermark("Arrived", delay).dropDuplicatesWithinWatermark(
            [c for c in rows.columns if c not in PROVENANCE]
        )
    return rows


FILES = "path string, modificationTime timestamp, length long, content binary"


def arrivals(
    spark: SparkSession, path: str, archive: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Newly arrived files, one row each; their contents are not read.

    For `serve_files`, which reads the files of a micro-batch itself and so knows all their
    attributes, and the files that gave no row. `max_files` bounds a micro-batch.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("pathGlobFilter", "*.xml")
        .option("maxFilesPerTrigger", max_files)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(f"{path}/*").select(
        F.col("path").alias("File_Path"), F.col("modificationTime").alias("Arrived"), F.col("length").alias("Bytes")
    )


def file_ledger(files: DataFrame, rows: DataFrame, whole: DataFrame) -> DataFrame:
    """What became of each file: its rows, its records that cannot be read, and the outcome.

    `whole` names the files that are not cut off; of those that are, what can be read is served.
    """
    counts = rows.groupBy(plain_path("File_Path", encoded=True).alias("_path")).agg(
        F.count_if(~F.col(UNREAD)).alias("N_Rows"), F.count_if(UNREAD).alias("N_Unread")
    )
    named = files.withColumn("_path", plain_path("File_Path"))
    found = lookup(named, counts, ["_path"], {"N_Rows": "N_Rows", "N_Unread": "N_Unread"}, own_shuffle=True)
    counted = found.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("N_Rows", "N_Unread")})
    ended = whole.select(plain_path("File_Path", encoded=True).alias("_path"))
    counted = lookup(counted, ended, ["_path"], {}, "_whole", own_shuffle=True)
    folder = F.element_at(F.split("_path", "/"), -2)
    outcome = (
        F.when(~folder.isin(*FOLDER_RANK), "unknown folder")
        .when(~F.col("_whole"), "cut off")
        .when(F.col("N_Unread") > 0, "unreadable records")
        .when(F.col("N_Rows") == 0, "no rows")
        .otherwise("served")
    )
    return counted.withColumns({"Folder_Name": folder, "Outcome": outcome}).drop("_path", "_whole")


def quarantined(ledger: DataFrame) -> DataFrame:
    """The files that are cut off, have no rows, or records that cannot be read, as error rows."""
    bad = ledger.filter(F.col("Outcome").isin("cut off", "no rows", "unreadable records"))
    why = (
        F.when(F.col("Outcome") == "no rows", "File holds no rows")
        .when(F.col("Outcome") == "cut off", "File is cut off")
        .otherwise(F.concat("N_Unread", F.lit(" record(s) of the file cannot be read")))
    )
    return bad.select(
        "Folder_Name", "File_Path", F.lit(None).cast("string").alias("Comp_Serial"),
        F.lit("File_Path").alias(ERROR_COLUMNS), why.alias(ERROR_MESSAGE),
    )


def serve_files(
    batch: DataFrame,
    batch_id: int,
    columns: Iterable[str],
    load: Callable[[int], Tables],
    out: str,
    now: Callable[[], AsOf],
    config: JobConfig = JobConfig(),
) -> None:
    """As `serve_batch`, for a micro-batch of `arrivals`.

    The batch's ledger goes to `ledger/batch_id=<n>`; files that gave no row, and files
    with records that cannot be read, are in the error output.
    """
    spark = batch.sparkSession
    files = stable(batch)
    # One name a file, `max_files` at most.
    paths = [literal_path(r[0]) for r in files.select("File_Path").collect()]
    if not paths:
        return
    rows = with_line_id(read_open_rowset(spark, paths, columns))
    ledger = stable(file_ledger(files, rows, whole_files(spark, paths)))
    append_batch(ledger, f"{out}/ledger", batch_id)
    good = rows.filter(~F.col(UNREAD)).drop(UNREAD)
    _serve(good, batch_id, load, out, now, config, {"(files)": quarantined(ledger)})


def serve_batch(
    batch: DataFrame,
    batch_id: int,
    load: Callable[[int], Tables],
    out: str,
    now: Callable[[], AsOf],
    config: JobConfig = JobConfig(),
) -> None:
    """Run the folders of one micro-batch in their fixed order and write the outcome.

    `load` gets the batch id and gives the tables as the batches before left them,
    such as `lambda n: load_state(spark, out, n)`. What the batch appended and the
    rows it changed go to partitions named after it, which a replay overwrites, so a
    replay starts from the same state and repeats nothing. Rows from a folder without
    a job are returned as errors. With `config.copy_days`, so are copies of rows that were
    served within that time, by this batch or one before.
    """
    _serve(with_line_id(batch), batch_id, load, out, now, config, {})


def _serve(
    rows: DataFrame,
    batch_id: int,
    load: Callable[[int], Tables],
    out: str,
    now: Callable[[], AsOf],
    config: JobConfig,
    outcome: dict[str, DataFrame],
) -> None:
    spark, as_of = rows.sparkSession, now()
    known = F.col("Folder_Rank").isNotNull()
    # At most as many names as there are inbox folders.
    present = {r[0] for r in rows.filter(known).select("Folder_Name").distinct().collect()}
    stray = rows.filter(~known)
    if not stray.isEmpty():
        outcome["(unknown folder)"] = validate(
            conform(stray, []),
            [Rule("Folder_Name", "Folder_Name is not an inbox folder", F.lit(True))],
        )
    tables = dict(load(batch_id))
    if config.attachment_folder:
        tables[ATTACHMENTS] = extend_listing(spark, f"{out}/attachments", config.attachment_folder, batch_id)
    # The keys in use are not looked for again: the batch before left the next free ones.
    layers = Layers(tables, load_counters(spark, out, batch_id))
    if config.copy_days is not None:
        since = as_moment(as_of) - F.expr(f"INTERVAL {int(config.copy_days)} DAYS")
        judged = stable(refuse_copies(rows.filter(known), served_digests(spark, out, batch_id, since)))
        outcome["(copies)"] = rejected(judged).drop(DIGEST)
        fresh = clean(judged).drop(ERROR_COLUMNS, ERROR_MESSAGE)
        rows = fresh.drop(DIGEST)
    for folder, part in route(rows).items():
        if folder not in present:
            continue
        own = part.drop("Folder_Name")
        result = run_folder(folder, own, layers.tables(), as_of, config, layers.counters)
        outcome[folder] = result.results
        layers.push(result)
    changes = {name: [top] for name, top in layers.changed.items()}
    commit({"appends": layers.added, "changes": changes}, out, batch_id, (spark, layers.counters))
    if config.copy_days is not None:
        done = [clean(outcome[f]).select("Line_ID") for f in present]
        if done:
            served = fresh.join(union_all(*done).distinct(), "Line_ID", "left_semi")
            append_batch(served.select(DIGEST, as_moment(as_of).alias("Served")).distinct(), f"{out}/digests", batch_id)
    if outcome:
        errors, _ = error_return(outcome)
        write_error_files(errors, f"{out}/errors/batch_id={batch_id}", mode="overwrite")


# The digest of a submitted row: all its values, not where they came from.
DIGEST = "_digest"


def digest(rows: DataFrame) -> Column:
    named = sorted(c for c in rows.columns if c not in (*PROVENANCE, "Line_ID", "Arrived"))
    return F.sha2(F.to_json(F.struct("Folder_Name", *[F.col(f"`{c}`") for c in named])), 256)


def served_digests(spark: SparkSession, out: str, before_batch: int, since: Column) -> DataFrame:
    """The digests of rows that the batches before served since then."""
    shape = f"{DIGEST} string, Served timestamp_ntz, batch_id int"
    try:
        kept = spark.read.schema(shape).parquet(f"{out}/digests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{DIGEST} string")
    return kept.filter((F.col("batch_id") < before_batch) & (F.col("Served") >= since)).select(DIGEST)


def refuse_copies(rows: DataFrame, served: DataFrame) -> DataFrame:
    """The rows with their digest; copies of served rows, and of rows before them, are flagged."""
    keyed = conform(rows, []).withColumn(DIGEST, digest(rows))
    marked = mark_existing(keyed, narrow(served, keyed, [DIGEST]), [DIGEST], "_served")
    judged = validate(marked, [Rule("Line_ID", "This row was already served", F.col("_served"))]).drop("_served")
    return flag_repeats(judged, [DIGEST], "Line_ID", "Line_ID", "This row was already given")


def start_intake(
    stream: DataFrame,
    checkpoint: str,
    handler: Callable[[DataFrame, int], None],
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; `available_now` serves what is there and ends."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handler)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime="1 second").start()
