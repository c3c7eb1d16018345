"""Session set-up, lineage cutting and size checks shared by all operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_SHIPPED: set[str] = set()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cratelight") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Sends this package's source to the Python workers, once per application; Spark serves the archive from the driver."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="cratelight-source-")) / "cratelight_source.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can write to: the one the cluster names, else (local mode only) a fresh one."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cratelight-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, unique to this call."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files, so lost executors cost no replay."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: read as often as wanted, computed once, and of a size Spark knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Bucketed:
    """``df`` written once to the shared folder, clustered by ``columns``: joins and groupings on just these need no shuffle of it.

    Used as a context; the catalog's entry goes at its end, so what is read from ``table`` has to be stored before. Where rows are few
    and large, ``moved=False`` writes them without a shuffle too: a task then adds a file to each bucket that it has rows of.
    """

    def __init__(self, df: DataFrame, name: str, columns: list[str], moved: bool = True):
        self.spark, self.name = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartition(buckets, *columns) if moved else df
        writer = rows.write.option("path", scratch_path(self.spark, name))
        writer.bucketBy(buckets, *columns).sortBy(*columns).format("parquet").saveAsTable(self.name)

    @property
    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def __enter__(self) -> "Bucketed":
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def bounded_rows(df: DataFrame, max_rows: int) -> list[Row] | None:
    """The rows of ``df`` when there are at most ``max_rows``, else None; reads ``max_rows + 1`` rows at most."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def bounded_local(df: DataFrame, max_rows: int) -> DataFrame | None:
    """``df`` as a local relation when it has at most ``max_rows`` rows, else None.

    A frame that passes has a proven bound and may be broadcast.
    """
    rows = bounded_rows(df, max_rows)
    return None if rows is None else df.sparkSession.createDataFrame(rows, df.schema)
