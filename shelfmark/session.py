"""Session settings and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime settings every plan in this package relies on. Sizes (shuffle
# partitions, memory, broadcast threshold) stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # fact-to-dimension joins meet hot keys: let AQE split them even when the
    # split costs one more exchange above the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the session's own, or a temporary one in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="shelfmark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def pinned(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the checkpoint folder.

    For values that must not be drawn again on a retry or a second read
    (row numbers, range boundaries); survives the loss of executors.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows as a plan of known size (an RDD of rows has none)."""
    fields = T._parse_datatype_string(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


# rows a derived dimension may have to be shipped whole to every executor
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when its size is known to be small.

    A frame Catalyst already estimates below the broadcast threshold is left to
    Catalyst. Otherwise (typically an aggregate over a large table, whose size
    Catalyst cannot guess) the rows are pinned and counted; above ``max_rows``
    they come back unmarked and the join shuffles.
    """
    threshold = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold))
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate <= limit:
        return df
    rows = pinned(df)
    return F.broadcast(rows) if rows.count() <= max_rows else rows
