"""One configuration object for paths, label, features and units.

No host names live in library code: every location is a parameter, and the
shared scratch folder comes from the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The feature order of the reference's housing data set, its
# label and its units (label in $100,000; monitor in $1,000; response in $1).
HOUSING_FEATURES = (
    "MedInc",
    "HouseAge",
    "AveRooms",
    "AveBedrms",
    "Population",
    "AveOccup",
    "Latitude",
    "Longitude",
)
HOUSING_LABEL = "target"
LABEL_UNIT_DOLLARS = 100000.0
MONITOR_UNIT_FACTOR = 100.0  # $100,000 -> $1,000

# Model parameters of the reference forest.
FOREST_TREES = 100
FOREST_DEPTH = 10
SEED = 42
# Part of the model, as a forest's draws depend on both: partitions of the
# training rows and the node-statistics budget (MB). Fixed parameters, not
# read from the session or the heap; raise the partitions for large tables.
FOREST_PARTITIONS = 32
FOREST_STATS_MB = 64
TEST_FRACTION = 0.2
LAST_N = 100
LAST_N_DEFAULT = 50


@dataclass(frozen=True)
class Settings:
    """Names and parameters shared by the jobs.

    ``features`` are in model order; ``label`` is the regression target.
    ``key`` names a column (or columns) that identifies a row; it drives the
    reproducible splits and the fixed input order before a forest fit.
    """

    features: tuple[str, ...] = HOUSING_FEATURES
    label: str = HOUSING_LABEL
    key: tuple[str, ...] = ()
    seed: int = SEED
    test_fraction: float = TEST_FRACTION
    num_trees: int = FOREST_TREES
    max_depth: int = FOREST_DEPTH
    last_n: int = LAST_N
    model_paths: tuple[str, ...] = field(default_factory=tuple)

    def with_(self, **kw) -> "Settings":
        values = {f: getattr(self, f) for f in self.__dataclass_fields__}
        values.update(kw)
        return Settings(**values)


def get_session(master: str | None = None, app: str = "tabrail", **conf) -> SparkSession:
    """Session with AQE on and the UI off; caller conf wins.

    ``spark.checkpoint.dir`` is set only when the cluster does not name one
    (local tests); on a cluster the shared folder comes from its own conf.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    defaults.update(conf)
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    _ensure_checkpoint_dir(spark)
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        # A folder of this machine serves local runs alone: on a cluster each
        # executor would write to its own disk.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tabrail-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the session (``spark.checkpoint.dir``)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    ckpt = _ensure_checkpoint_dir(spark)
    return ckpt.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run's outputs."""
    root = shared_root(spark)
    return f"{root}/tabrail/{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for an intermediate table. It is deleted when the ``scratch``
    block around the call ends, or else when the driver's file system closes."""
    path = work_dir(spark, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of a frame that several readers need, stored once: a scan
    takes the place of the joins behind it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """Delete the intermediate tables that are made inside the block at its
    end. Frames that read them must have been written or collected by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            drop_dir(spark, path)
