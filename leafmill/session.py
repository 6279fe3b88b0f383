"""Session, table and intermediate-result helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "leafmill", cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests, the bench and the command line; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context, so that they needn't have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_leafmill_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="leafmill-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "leafmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.join("leafmill", os.path.relpath(full, home)))
    sc.addPyFile(path)
    sc._leafmill_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet test tables; the scan stays open to pushdown and pruning."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is missing in a local run a temporary folder is made; it is
    removed when the driver ends. On a cluster the setting has to be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(sc, "_leafmill_shared", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc._leafmill_shared = own
    return f"file://{own}"


_made: list[str] = []


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new name in the shared folder, remembered for :func:`drop_intermediates`."""
    _made.append(f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}")
    return _made[-1]


def drop_intermediates(spark: SparkSession) -> None:
    """Remove all intermediate tables of this session; frames that read them are done with then."""
    while _made:
        drop_path(spark, _made.pop())


#: Rows of at most that many ids are sent to all executors: some 100 MB there.
SENT_ROWS = 4_000_000


def sent_if_small(ids: DataFrame) -> DataFrame:
    """A written table of one id column, marked for a broadcast if its counted rows are few enough; a shuffle join serves else."""
    return F.broadcast(ids) if ids.count() <= SENT_ROWS else ids


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables made within, once what is read from them has been written or collected."""
    before = len(_made)
    try:
        yield
    finally:
        while len(_made) > before:
            drop_path(spark, _made.pop())


def drop_table(df: DataFrame) -> None:
    """Remove one intermediate table that nothing reads any more."""
    path = df._leafmill_path
    if path in _made:
        _made.remove(path)
        drop_path(df.sparkSession, path)


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and lets later steps read only
    the columns they need.
    """
    path = scratch_path(df.sparkSession, what)
    ship_package(df.sparkSession)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._leafmill_path = path
    return back


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any Hadoop file system, if it is there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder that is on a local or mounted file system; nothing for other file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.toUri().getPath() if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file" else None


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened by underscores until no input column is called so (case-insensitively)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def tokenizer_folder() -> str:
    """Where the public vocabularies lie; ``LEAFMILL_TOKENIZERS`` names another place."""
    return os.environ.get("LEAFMILL_TOKENIZERS", "/opt/tokenizers")
