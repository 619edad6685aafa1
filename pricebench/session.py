"""Sessions, and the shared folder in which long plans are cut."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; the cluster's own resource settings stay untouched.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "pricebench", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors can reach.

    A machine-local folder is only made up for a local master; on a cluster a missing
    setting is an error, since a lost executor would take such a folder with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pricebench-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits checkpoint, so that hundreds of rounds do not hang on one lineage."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the table to the shared folder and go on from the files.

    Parquet rather than ``checkpoint()``, so that later reads still prune columns.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
