"""Session settings and the shared work folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "parcelframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC times; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def package_on_workers() -> None:
    """Lets Python workers import this package from the driver's place; clusters that ship it otherwise ignore that."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = SparkSession.active().sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)


_IN_USE: dict[str, list[str]] = {}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a local session gets a temporary folder; executors on other machines would not see it.
    ``release`` deletes what was handed out.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="parcelframe-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/parcelframe/{purpose}-{uuid.uuid4().hex}"
    _IN_USE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Deletes the work folders of this application; tables that still read them must be finished. Returns their number."""
    paths = _IN_USE.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` has given, once no plan that is still to run reads them."""
    for table in tables:
        _IN_USE.get(table.sparkSession.sparkContext.applicationId, []).remove(table.work_path)
        _delete(table.sparkSession, table.work_path)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read back.

    This cuts the lineage, and the planner then knows the size: it broadcasts the table only while it
    is below the session's own limit, and joins it by sorting otherwise.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.work_path = path
    return table
