"""Gold load: match by name, cast, turn bad rows away, then write.

A row is turned away when a required value is missing, a value does not fit its column's
type, or a text is too long; the rest of the load goes on. Rows turned away are kept with
their reasons and original values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.operators.facts import last_per_key
from cartmill.schemas import FACT_ORDERS, LOAD_ORDER, TABLES, Table
from cartmill.schemas import Column as Spec
from cartmill.session import shuffles_dropped
from cartmill.sources import silver, versions
from cartmill.sources.lake import Lake

RESULT_SCHEMA = "table_name string, staged bigint, loaded bigint, rejected bigint, superseded bigint"
REJECT_SCHEMA = "reasons array<string>, source_row string, file string, row bigint"
FILE_SCHEMA = (
    "file string, status string, staged bigint, loaded bigint, rejected bigint, superseded bigint, "
    "first_error string, first_error_row bigint"
)


@dataclass(frozen=True)
class _Field:
    """One target column, as SQL over the source's columns."""

    name: str
    value: str
    fits: tuple[str, ...]  # all true for a good row
    faults: tuple[tuple[str, str], ...]  # reason, condition; what `fits` rules out


def _field(spec: Spec, names: dict[str, str], types: dict[str, T.DataType]) -> _Field:
    kind = spec.storage_type.simpleString()
    needed = spec.required or spec.always_read
    if spec.name not in names:
        value = f"CAST({spec.default or 'NULL'} AS {kind})"
        if not spec.required or spec.default:
            return _Field(spec.name, value, (), ())
        return _Field(spec.name, value, ("false",), ((f"{spec.name}: no such column", "true"),))
    source = f"`{names[spec.name]}`"
    same = types[spec.name] == spec.storage_type
    value = source if same else f"try_cast({source} AS {kind})"
    fits, faults = [], []
    if needed:
        # One test for both a missing and an unfit value: Spark computes it for every row.
        fits.append(f"{value} IS NOT NULL")
        faults.append((f"{spec.name}: missing", f"{source} IS NULL"))
    elif not same:
        fits.append(f"({source} IS NULL OR {value} IS NOT NULL)")
    if not same:
        faults.append((f"{spec.name}: not {kind}", f"{source} IS NOT NULL AND {value} IS NULL"))
    if spec.max_length:
        short = f"char_length({value}) <= {spec.max_length}"
        fits.append(short if needed else f"({value} IS NULL OR {short})")
        long = f"char_length({value}) > {spec.max_length}"
        faults.append((f"{spec.name}: longer than {spec.max_length}", long))
    return _Field(spec.name, value, tuple(fits), tuple(faults))


def _fields(rows: DataFrame, table: Table) -> list[_Field]:
    """Columns are matched by name in any case; the rest of the source is ignored."""
    names = {f.name.lower(): f.name for f in rows.schema.fields}
    types = {f.name.lower(): f.dataType for f in rows.schema.fields}
    return [_field(spec, names, types) for spec in table.fed_columns]


#: Silver columns that the load reads besides the table's own: what was wrong with a value
#: that silver could not keep, and the element as it came.
FAULTS, RAW = "_faults", "_raw"
#: Columns that say where a staged row is stored; they are no part of it.
FILE, ROW, TIE = "_file", "_row", "_tie"


def placed(stored: DataFrame) -> DataFrame:
    """Stored rows with their file and their place in it."""
    return stored.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)
    )


def fits(rows: DataFrame, table: Table) -> str:
    """SQL: the row is complete, every value fits, and silver found no fault."""
    tests = [test for f in _fields(rows, table) for test in f.fits]
    if FAULTS in rows.columns:
        tests.append(f"coalesce(size({FAULTS}), 0) = 0")
    return " AND ".join(tests) or "true"


def accepted(rows: DataFrame, table: Table, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows that fit, in target types and order, and the source columns in `keep`."""
    targets = [f"{f.value} AS {f.name}" for f in _fields(rows, table)]
    return rows.where(fits(rows, table)).selectExpr(*targets, *keep)


def rejected(rows: DataFrame, table: Table) -> DataFrame:
    """Rows that do not fit, with every reason and the source row as JSON.

    Where silver has a fault for a column (`name: what`), it is the reason, and that the
    column is missing is not. The source row has the element as it came, where silver kept it.
    `file` and `row` say where it is stored, where the rows come from files (see placed).
    """
    found = ", ".join(
        f"CASE WHEN {fault} THEN '{reason}' END" for f in _fields(rows, table) for reason, fault in f.faults
    )
    reasons = f"array_compact(array({found}))"
    if FAULTS in rows.columns:
        reasons = f"""concat(coalesce({FAULTS}, array()), filter({reasons}, r -> NOT exists(
            coalesce({FAULTS}, array()), f -> r = concat(split_part(f, ':', 1), ': missing'))))"""
    source = ", ".join(f"`{c}`" for c in rows.columns if c not in (FAULTS, FILE, ROW, TIE))
    file, row = (FILE, ROW) if FILE in rows.columns else ("CAST(NULL AS STRING)", "CAST(NULL AS BIGINT)")
    return rows.where(f"NOT coalesce({fits(rows, table)}, false)").selectExpr(
        f"{reasons} AS reasons", f"to_json(struct({source})) AS source_row", f"{file} AS file", f"{row} AS row"
    )


def gold_rows(
    rows: DataFrame, table: Table, recency: tuple[str, ...] = (), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows that fit; of several with one declared key, the last in the feed that fits."""
    fitting = accepted(rows, table, keep=(*recency, *keep))
    if not recency:
        return fitting
    return last_per_key(fitting, table.key, recency).drop(*recency)


def _count(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _write_rejects(
    rows: DataFrame, lake: Lake, table: Table, run_date: date, batch: str, any_bad: bool = True
) -> int:
    """Keep what was turned away. Where all rows were loaded the rows are not read again,
    but what an earlier run of the same date left is cleared all the same."""
    bad = rejected(rows, table) if any_bad else rejected(rows, table).where("false")
    return keep_rejects(bad, lake, table.name, run_date, batch)


def keep_rejects(bad: DataFrame, lake: Lake, name: str, run_date: date, batch: str = "run") -> int:
    """Replace one load's rejects; returns how many there are."""
    bad, seen = _count(bad, f"rejected_{name}")
    path = lake.load_folder(name, run_date, batch, lake.rejects(name))
    bad.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return seen.get["rows"]


def file_results(staged: DataFrame, bad: DataFrame | None = None, kept: DataFrame | None = None) -> DataFrame:
    """What became of each file's rows, as FILE_SCHEMA; a file without rows has none.

    `staged` is placed; its rows are counted from file footers. `bad` are the rejects kept of it
    and `kept` the rows that gold took, with their file, where some were superseded; without
    them there are none. The first error is the first reason of the first row turned away.
    """
    files = staged.groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("staged"))
    if bad is None:
        files = files.withColumns(
            {"rejected": F.lit(0).cast("bigint"), "first_error": F.lit(None).cast("string"), "first_error_row": F.lit(None).cast("bigint")}
        )
    else:
        errors = bad.groupBy("file").agg(
            F.count("*").alias("rejected"),
            F.min_by(F.col("reasons")[0], "row").alias("first_error"),
            F.min("row").alias("first_error_row"),
        )
        files = files.join(errors, "file", "left").fillna(0, ["rejected"])
    if kept is None:
        files = files.withColumn("loaded", F.col("staged") - F.col("rejected"))
    else:
        taken = kept.groupBy("file").agg(F.count("*").alias("loaded"))
        files = files.join(taken, "file", "left").fillna(0, ["loaded"])
    return files.select(
        "file",
        F.when(F.col("rejected") == 0, "loaded")
        .when(F.col("rejected") < F.col("staged"), "partly loaded")
        .otherwise("failed")
        .alias("status"),
        "staged",
        "loaded",
        "rejected",
        (F.col("staged") - F.col("loaded") - F.col("rejected")).alias("superseded"),
        "first_error",
        "first_error_row",
    )


def _write_file_results(
    staged: DataFrame, lake: Lake, table: Table, run_date: date, batch: str, bad: int, kept: DataFrame | None = None
) -> None:
    """Replace one load's results by file. Rejects are read back from where they were kept."""
    rejects = None
    if bad:
        folder = lake.load_folder(table.name, run_date, batch, lake.rejects(table.name))
        rejects = staged.sparkSession.read.schema(REJECT_SCHEMA).parquet(folder)
    path = lake.load_folder(table.name, run_date, batch, lake.file_results(table.name))
    file_results(staged, rejects, kept).write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_file_results(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Results of every load of a table, by file: FILE_SCHEMA with run_date and batch."""
    schema = f"{FILE_SCHEMA}, run_date date, batch string"
    return spark.read.schema(schema).parquet(lake.file_results(name))


def load_dimension(spark: SparkSession, lake: Lake, name: str, run_date: date, published: bool = True) -> tuple:
    """Full refresh of one dimension from one run date's silver table.

    Readers see the old rows until the new ones are all there (versions). With `published`, what
    is published shows them from then on; else `follow` is left to the caller.
    """
    table, recency = TABLES[name], silver.RECENCY.get(name, ())
    staged = placed(silver.read(spark, lake, name, run_date))
    good, seen = _count(gold_rows(staged, table, recency), f"loaded_{name}")
    versions.replace(good, lake.gold(name))
    loaded = seen.get["rows"]
    total = staged.count()  # from Parquet footers
    bad = _write_rejects(staged, lake, table, run_date, "run", any_bad=loaded < total)
    # Which file a superseded row came from is only asked where there is one.
    kept = gold_rows(staged, table, recency, keep=(f"{FILE} AS file",)) if loaded + bad < total else None
    _write_file_results(staged, lake, table, run_date, "run", bad, kept)
    if published:
        follow(spark, lake, name)
    return name, total, loaded, bad, total - loaded - bad


#: A unit of line keys: room for 1,024 writing tasks of 2^33 rows each.
TASK_BITS = 33
UNIT_TASKS = 1 << 10
UNIT = UNIT_TASKS << TASK_BITS


def _claim(spark: SparkSession, path: str) -> bool:
    """Create a file only if it is absent; False where somebody else has."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(at.getParent())
    if system.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then; this is one step.
        return spark._jvm.java.io.File(at.toUri().getPath()).createNewFile()
    try:
        system.create(at, False).close()
    except Exception:
        if system.exists(at):
            return False
        raise
    return True


def _units(spark: SparkSession, lake: Lake) -> list[int]:
    """Units claimed so far."""
    at = spark._jvm.org.apache.hadoop.fs.Path(lake.ledger)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    names = [s.getPath().getName() for s in system.listStatus(at)]
    return [int(n.removeprefix("unit-")) for n in names if n.startswith("unit-")]


@dataclass(frozen=True)
class Lease:
    """Line keys from first on, below end, that no other load has."""

    first: int
    end: int

    def check(self, last: int | None) -> None:
        """Rows are keyed by task: more tasks than the lease has room for would run into others' keys."""
        if last is not None and last >= self.end:
            raise RuntimeError(f"line key {last} is beyond the lease's end {self.end}")


def lease_keys(spark: SparkSession, lake: Lake, tasks: int | None = None) -> Lease:
    """Claim consecutive units with room for so many writing tasks (the shuffles' number by default).

    A unit is a file that is created only if absent, so loads may run at the same time. Where
    another load takes a unit in between, the units so far stay unused and the claim goes on
    behind it. A lake without units, but with lines, begins above the highest key stored.
    """
    if tasks is None:
        first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 0
        tasks = max(int(first), int(spark.conf.get("spark.sql.shuffle.partitions")))
    needed = -(-tasks // UNIT_TASKS)
    known = _units(spark, lake)
    if known:
        at = max(known) + 1
    else:
        stored = None
        if has_loads(spark, lake, "*"):
            stored = read_gold(spark, lake, FACT_ORDERS.name).agg(F.max("order_line_id")).first()[0]
        at = 0 if stored is None else stored // UNIT + 1
    begin = at
    while at < begin + needed:
        if not _claim(spark, f"{lake.ledger}/unit-{at:09d}"):
            begin = at + 1
        at += 1
    return Lease(begin * UNIT, at * UNIT)


def line_key(first: int) -> Column:
    """first, and on: unique within the load, not gap-free. A task takes up 2^33 numbers, so
    a lake has room for 2^30 writing tasks in all."""
    return F.lit(first).cast("bigint") + F.monotonically_increasing_id()


def tie() -> Column:
    """A spread that depends only on where a row is stored, for splitting hot keys."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def clustered(rows: DataFrame, table: Table, tie_column: str, folders: bool = True) -> DataFrame:
    """Range-partitioned by folder and clustering columns, so that file statistics skip.

    The folders' columns go first, so a task writes into few of them however many there are
    (without `folders` there is one, and they aren't compared); the tie column goes last: a
    single hot day and product is cut into several ranges instead of filling one task.
    """
    first = [c.name for c in table.partition_by] if folders else []
    ranged = rows.repartitionByRange(*first, *table.cluster_by, tie_column)
    return ranged.sortWithinPartitions(*first, *table.cluster_by).drop(tie_column)


def _fact_rows(staged: DataFrame, first_key: int, batch: str, folders: bool = True) -> DataFrame:
    """Accepted, laid out and keyed fact rows; `staged` has run_date and _tie. Without `folders` all
    rows are of one run date."""
    table = FACT_ORDERS
    good = accepted(staged.withColumn("batch", F.lit(batch)), table, keep=("run_date", "batch", "_tie"))
    # Keys are given after the shuffle, in the task that writes them: a lost upstream
    # task can be run again without changing where any row goes.
    return clustered(good, table, "_tie", folders).select(
        line_key(first_key).alias("order_line_id"),
        *[c.name for c in table.fed_columns],
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
        "run_date",
        "batch",
    )


def write_fact(
    spark: SparkSession, staged: DataFrame, lake: Lake, batch: str, run_date: date | None = None, replace: bool = False
) -> int:
    """Write one load's rows. With `replace` the whole table is replaced; with a run_date that
    load's own folder is, also by nothing where no row is accepted; else the (run_date, batch)
    folders the load writes, so repeating it changes nothing else."""
    lease = lease_keys(spark, lake)
    seen = Observation(f"loaded_{batch}")
    good = _fact_rows(staged, lease.first, batch, folders=run_date is None).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max("order_line_id").alias("last")
    )
    folders = [c.name for c in FACT_ORDERS.partition_by]
    out = good.write.mode("overwrite").option("compression", "snappy")
    with shuffles_dropped(spark):
        if replace or run_date is None:
            out = out.partitionBy(*folders).option("partitionOverwriteMode", "static" if replace else "dynamic")
            out.parquet(lake.gold(FACT_ORDERS.name))
        else:
            good.drop(*folders).write.mode("overwrite").option("compression", "snappy").parquet(
                lake.load_folder(FACT_ORDERS.name, run_date, batch)
            )
    found = seen.get
    lease.check(found["last"])
    follow(spark, lake, FACT_ORDERS.name)
    return found["rows"]


def follow(spark: SparkSession, lake: Lake, *names: str) -> None:
    """Make what is published show these tables' new files: the views of the session, which
    hold folders and listings, and the catalog's tables."""
    for name in names:
        if name == FACT_ORDERS.name:
            if _catalog_location(spark, name) == _qualified(spark, lake.gold(name)):
                spark.sql(f"MSCK REPAIR TABLE {_catalog_name(spark, name)} SYNC PARTITIONS")
        elif name in TABLES:
            _relocate(spark, lake, name)
    root, publisher, views = PUBLISHED.get(_session(spark), (None, None, ()))
    if root != lake.root:
        return
    if any(name != FACT_ORDERS.name for name in names):
        publisher()
    else:
        for view in views:
            spark.catalog.refreshTable(view)


def _relocate(spark: SparkSession, lake: Lake, name: str) -> None:
    """Point the catalog's table at the current version, where it is over this lake."""
    at, now = _catalog_location(spark, name), _qualified(spark, gold_folder(spark, lake, name))
    if at is not None and at != now and at.startswith(_qualified(spark, lake.gold(name))):
        spark.sql(f"ALTER TABLE {_catalog_name(spark, name)} SET LOCATION '{now}'")
        spark.catalog.refreshTable(_catalog_name(spark, name))


def _session(spark: SparkSession) -> str:
    return spark._jsparkSession.sessionUUID()


def follow_loads(spark: SparkSession, lake: Lake, views: list[str], publisher: Callable[[], object]) -> None:
    """Keep views of the session up to date with loads of this lake: `publisher` defines them."""
    PUBLISHED[_session(spark)] = lake.root, publisher, tuple(views)


def has_loads(spark: SparkSession, lake: Lake, batch: str) -> bool:
    """Whether the fact has folders of loads whose batch matches a glob pattern."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.gold(FACT_ORDERS.name)}/run_date=*/batch={batch}")
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at))


#: By session: the lake that its views show, how they are defined, and their names.
PUBLISHED: dict[str, tuple[str, Callable[[], object], tuple[str, ...]]] = {}
#: How fact rows come in: see load_fact; the last is streaming.append.
FACT_MODES = ("snapshot", "replace_run", "append_new_files")


def load_fact(
    spark: SparkSession, lake: Lake, run_date: date, mode: str = "snapshot"
) -> tuple:
    """Load one run date's order lines.

    snapshot     the feed is a full extract: the fact is replaced, or every loaded day
                 would count all orders again
    replace_run  the feed holds new orders only: run dates add up, and a rerun replaces
                 just its own
    (streaming.append is the third way: every silver file once.)
    """
    if mode not in FACT_MODES[:2]:
        raise ValueError(f"{mode} is none of {FACT_MODES[:2]}")
    if mode == "replace_run" and has_loads(spark, lake, "stream-*"):
        raise ValueError("the fact holds lines loaded file by file, which this would add again")
    stored = silver.read(spark, lake, FACT_ORDERS.name, run_date)
    staged = stored.select("*", F.lit(run_date).alias("run_date"), tie().alias(TIE))
    loaded = write_fact(spark, staged, lake, "run", run_date, mode == "snapshot")
    stored = placed(stored)
    total = stored.count()
    bad = _write_rejects(stored, lake, FACT_ORDERS, run_date, "run", any_bad=loaded < total)
    _write_file_results(stored, lake, FACT_ORDERS, run_date, "run", bad)
    return FACT_ORDERS.name, total, loaded, bad, 0


def load_all(
    spark: SparkSession, lake: Lake, run_date: date, fact_mode: str = "snapshot", **options: str
) -> DataFrame:
    """Dimensions, then the fact; one result row per table.

    A mode that isn't known is refused before anything is written. `options` go to the
    streaming load (streaming.append) where the mode is append_new_files.
    """
    if fact_mode not in FACT_MODES:
        raise ValueError(f"{fact_mode} is none of {FACT_MODES}")
    dimensions = [t.name for t in LOAD_ORDER[:-1]]
    results = [load_dimension(spark, lake, name, run_date, published=False) for name in dimensions]
    follow(spark, lake, *dimensions)
    if fact_mode == "append_new_files":
        from cartmill.streaming.append import append_new_files

        results.append(append_new_files(spark, lake, **options))
    else:
        results.append(load_fact(spark, lake, run_date, fact_mode))
    return spark.createDataFrame(results, RESULT_SCHEMA)


def append_rows(rows: DataFrame, lake: Lake, name: str, run_date: date, load: int = 0) -> tuple:
    """Insert a DataFrame's rows into a gold table, with the same checks.

    Fact rows go to a folder of their own numbered `load`, laid out as every load's are;
    using a number again fails instead of adding the rows twice. Dimension rows are added as
    they are: a key that is there already is there twice then, which the audits report.
    """
    spark, table = rows.sparkSession, TABLES[name]
    batch = f"rows-{load:05d}"
    if table is FACT_ORDERS:
        lease = lease_keys(spark, lake)
        # Not from files, so there is no place in a file to break ties by: the row's own values do.
        values = [F.col(f"`{c}`").cast("string") for c in rows.columns]
        staged = rows.withColumns({"run_date": F.lit(run_date), "_tie": F.xxhash64(*values)})
        good = _fact_rows(staged, lease.first, batch, folders=False).drop("run_date", "batch")
        path, mode = lake.load_folder(name, run_date, batch), "errorifexists"
        last = F.max("order_line_id")
    else:
        good, path, mode, last = accepted(rows, table), gold_folder(spark, lake, name), "append", F.max(F.lit(None).cast("bigint"))
    seen = Observation(f"rows_{name}")
    good = good.observe(seen, F.count(F.lit(1)).alias("rows"), last.alias("last"))
    with shuffles_dropped(spark):
        good.write.mode(mode).option("compression", "snappy").parquet(path)
    if table is FACT_ORDERS:
        lease.check(seen.get["last"])
    bad = _write_rejects(rows, lake, table, run_date, batch)
    follow(spark, lake, name)
    return name, seen.get["rows"], bad


def gold_folder(spark: SparkSession, lake: Lake, name: str) -> str:
    """Where a gold table's rows are now: dimensions have versions, the fact a folder a load."""
    return lake.gold(name) if name == FACT_ORDERS.name else versions.current(spark, lake.gold(name))


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name].schema).parquet(gold_folder(spark, lake, name))


def read_rejects(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    schema = f"{REJECT_SCHEMA}, run_date date, batch string"
    return spark.read.schema(schema).parquet(lake.rejects(name))


def _catalog_name(spark: SparkSession, name: str) -> str:
    """The catalog's table, also where a view of the session has its name."""
    return f"spark_catalog.`{spark.catalog.currentDatabase()}`.`{name}`"


def _qualified(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _catalog_location(spark: SparkSession, name: str) -> str | None:
    full = _catalog_name(spark, name)
    if not spark.catalog.tableExists(full):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").collect()
    return _qualified(spark, rows[0]["data_type"]) if rows else None


def create_tables(spark: SparkSession, lake: Lake, suffix: str = "") -> list[str]:
    """Register the gold tables in the session catalog over their folders, with the folders
    of the fact that are there. A table of that name over another lake is let go of (its
    files stay)."""
    names = []
    for table in LOAD_ORDER:
        name = f"{table.name}{suffix}"
        full, at = _catalog_name(spark, name), _catalog_location(spark, name)
        folder = gold_folder(spark, lake, table.name)
        if at is not None and at != _qualified(spark, folder):
            spark.sql(f"DROP TABLE {full}")
        spark.sql(table.create_sql(full, folder))
        if table.partition_by:
            folder = spark._jvm.org.apache.hadoop.fs.Path(lake.gold(table.name))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
            spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
        names.append(name)
    return names
