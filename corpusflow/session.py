"""Session settings and the shared working folder."""

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. All are ordinary Spark SQL settings;
# partition counts and sizes are left to the cluster and to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange later on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # stream state on disk rather than on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app="corpusflow", master=None, **extra):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _setting(spark, key):
    value = spark.conf.get(key, None)
    return value or spark.sparkContext.getConf().get(key, None)


_LOCAL: dict[str, str] = {}  # working folder of a single-machine session, by application


def prepare(spark):
    """What an application does once: send the package to the workers, name a folder.

    Executors get the package as a zip file through Spark. Only a session on one
    machine without ``spark.checkpoint.dir`` gets a folder of its own, removed at exit.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app in _LOCAL:
        return
    scratch = tempfile.mkdtemp(prefix="corpusflow-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    _LOCAL[app] = scratch if context.master.startswith("local") and "-cluster" not in context.master else ""
    package = Path(__file__).resolve().parent
    archive = Path(scratch) / "corpusflow.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))


def work_folder(spark, name):
    """A fresh folder for one job's files, below the folder all executors share.

    The shared folder is the one named by ``spark.checkpoint.dir``.
    """
    root = _setting(spark, "spark.checkpoint.dir") or _LOCAL.get(spark.sparkContext.applicationId)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def sized(df: DataFrame, name: str = "side") -> DataFrame:
    """Write an aggregated join side to the shared folder and read it back.

    Catalyst then knows its size and decides itself between a broadcast, which
    leaves the other side's wide rows where they are, and a shuffled join. The
    written table also ends the lineage, so losing an executor later does not
    repeat the work. Runs a job.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
