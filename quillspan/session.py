"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TUNED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


SPREAD_BYTES = 1 << 30


def build_session(app: str = "quillspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `conf` entries (dots as `__`) override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names a shared folder in `spark.checkpoint.dir`; it is used as it is.  Only
    where neither that setting nor a folder set by the caller exists and the session runs on
    this machine alone (tests), a folder below the system's temporary one is set, and removed
    when Python ends; a cluster without a shared folder is an error.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="quillspan-checkpoints-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Rows written to the checkpoint folder and read back: computed once, kept if executors are lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """A small scan of fewer partitions than the session has cores, dealt out over them; any other as it is.

    For work per row that outweighs moving the row: a table of one small file would
    otherwise keep one core busy.  What the planner takes to be over `SPREAD_BYTES` is never
    moved, whatever the cluster's size: such a scan has tasks enough.  Rows and results
    are the same either way.  Pass the columns you need only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    return df.repartition(cores) if plan.toRdd().getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers of the session, once.

    Needless where the package is installed on the executors; elsewhere (a checkout that
    only the driver has on its path) the workers could not import it.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quillspan-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "quillspan_src.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, Path("quillspan") / source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
