"""Where jobs may put intermediate tables.

Written tables must live in a folder every executor can reach. The cluster
names that folder in ``spark.checkpoint.dir``; we read it from the session and
only create our own in local mode (tests, single machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


#: By application: the folder made for it, and the tables written below its shared folder.
_LOCAL_DIRS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def _application(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    In local mode, when unset, a fresh folder is created once per session
    and registered as the context's checkpoint directory (the setting itself
    cannot change at run time). On a cluster an unset value is an error: a
    machine-local folder would be lost with its executor.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        base = _LOCAL_DIRS.get(_application(spark))
    if not base:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder for intermediate tables"
            )
        base = tempfile.mkdtemp(prefix="fieldatlas-")
        if sc is not None:
            sc.setCheckpointDir(base)
        _LOCAL_DIRS[_application(spark)] = base
    return base.rstrip("/")


def importable_on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it.

    Needed where the repository is on a path all hosts share but not
    installed; an installed package, or one sent with ``--py-files``, is found
    anyway and an entry for a missing folder does no harm.
    """
    sc = _context(spark)
    if sc is not None:
        home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if home not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def short_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most ``rows`` rows in an Arrow batch from here on, in this session.

    Spark's default of 10 000 is meant for short rows; with whole documents a
    batch is held several times over, by the task and by its Python worker.
    A smaller setting of the session stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000") or 10000)
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def default_parallelism(spark: SparkSession, fallback: int = 8) -> int:
    """Cores of the cluster as Spark reports them."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", str(fallback)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique table path below the shared folder, until :func:`release_tables`."""
    path = f"{shared_dir(spark)}/fieldatlas/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(_application(spark), []).append(path)
    return path


def release_tables(spark: SparkSession, *paths: str) -> int:
    """Removes the given scratch tables, or all that this application has written.

    Results that still read them can no longer be computed, so call it when
    a result has been written or collected. Returns the number of tables removed.
    """
    held = _WRITTEN.get(_application(spark), [])
    chosen = [p for p in held if not paths or p in paths]
    jvm = spark.sparkContext._jvm
    for p in chosen:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        held.remove(p)
    return len(chosen)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation)
    and lets several branches of a later plan share one computation. Unlike
    an eager ``checkpoint()``, the input is computed only once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
