"""Session settings and the shared folder for tables written between jobs."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name="bike-share", master=None, **settings):
    """A session with adaptive execution on and a fixed zone.

    Extra settings are passed as keywords with ``__`` for dots, for example
    ``spark__driver__memory="16g"``. Master and memory stay with the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def choose_root(configured, master):
    """The folder that intermediate tables go below.

    A machine-local temporary folder is chosen only where driver and executors are one process;
    on a cluster each machine would write to a disk of its own, so there it is an error.
    """
    if configured:
        return configured.rstrip("/")
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="spokeframe-")
    raise ValueError(
        "spark.checkpoint.dir is not set: name a folder there that driver and executors share")


def shared_folder(spark):
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``).

    All paths of an application lie in one folder, which is removed when the application ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    root = choose_root(configured, context.master)
    if not configured:
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    top = f"{root}/tables-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(top)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{top}/{uuid.uuid4().hex}"


def through_table(df):
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, lets several readers share one computation, outlives lost executors, and
    gives Spark the table's true size to choose joins by.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
