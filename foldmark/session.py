"""Session settings and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "foldmark", shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster, submit with the cluster's own settings instead; nothing in
    the package depends on these values.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for sessions that were not submitted with it and run from any folder."""
    package = Path(__file__).resolve().parent
    place = Path(tempfile.mkdtemp(prefix="foldmark-package-")) / "foldmark-package.zip"
    with zipfile.ZipFile(place, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(place))


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables a job writes and reads back.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (local runs, tests) is a temporary folder made, and used from then on.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="foldmark-")
    return _own_folder


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A new, unused path inside the shared folder."""
    return f"{shared_folder(spark)}/{stem}-{uuid.uuid4().hex}"


#: Rows that one task groups or sorts, at two to six hundred bytes of memory each.
ROWS_PER_TASK = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks to deal ``rows`` out into: the session's shuffle partitions, or more where each would hold too many rows.

    For shuffles with a stated number of tasks, so that what one of them holds
    does not grow with the input, however many partitions the session names.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def written(df: DataFrame, stem: str) -> DataFrame:
    """Write a table to the shared folder and go on from the files.

    For tables a job reads more than once; it also cuts the lineage, so that a
    lost executor does not bring back the work in front of it.
    """
    path = fresh_path(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
