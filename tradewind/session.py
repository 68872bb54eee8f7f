"""Session settings the transforms rely on, and the shared folder for durable state."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to apply to a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where a later aggregate could have reused the join's
    # partitioning: one more exchange is cheaper than one task with a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the runtime settings; ``settings`` use ``__`` for the dots in a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def durable_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and stream state, which every executor must be able to reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder; a cluster without it is an error, because state on one machine is
    lost with the machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back.

    Later steps start from the files, so their plans stay short and a lost executor costs no
    recomputation. ``DataFrame.checkpoint`` would compute ``df`` twice.
    """
    path = f"{durable_folder(df.sparkSession)}/tables/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame) -> DataFrame:
    """Like ``stored``, but what ``df`` has shuffled is deleted as soon as it is written.

    Otherwise these files stay until the driver happens to collect its garbage.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = conf.get(name, None)
    conf.set(name, "true")
    try:
        return stored(df)
    finally:
        conf.unset(name) if usual is None else conf.set(name, usual)


def forget_shuffles(df: DataFrame) -> None:
    """Delete what ``df`` has shuffled, once nothing computes it any more.

    For a micro-batch, whose files ``stored_alone`` cannot name: a stream keeps them until a batch or two later.
    """
    cleaner = df.sparkSession.sparkContext._jsc.sc().cleaner()
    todo, seen = [df._jdf.queryExecution().toRdd()], set()
    while todo:
        rdd = todo.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        dependencies = rdd.dependencies()
        for i in range(dependencies.size()):
            dependency = dependencies.apply(i)
            if dependency.getClass().getSimpleName() == "ShuffleDependency" and cleaner.isDefined():
                cleaner.get().doCleanupShuffle(dependency.shuffleId(), True)
            todo.append(dependency.rdd())
