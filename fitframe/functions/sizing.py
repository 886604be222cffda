"""Size-checked materialisation of fitted state and of join sides.

A fitted state (rare-label list, target-encoding table, category list) is
usually tiny, but its size grows with the cardinality of a column, not with a
constant.  ``materialize_state`` computes it once into the shared checkpoint
folder and measures it, in rows and bytes: a small state becomes a local
relation, a medium one is broadcast from its checkpoint, a large one is joined
with a shuffle (AQE splits skewed keys).  Nothing stays cached on executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

MAX_LOCAL_ROWS = 5_000
MAX_LOCAL_BYTES = 4 << 20
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
ROWS_PER_FIT_TASK = 20_000


def row_bytes(df: DataFrame):
    """Bytes of a row: 8 for each column and the length of texts."""
    total = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    return total


class SizedFrame:
    """A materialised state table with its exact rows and bytes."""

    def __init__(self, df: DataFrame, rows: int, local: bool, size: int | None = None):
        self.df = df
        self.rows = rows
        self.local = local
        self.size = size

    @property
    def small(self) -> bool:
        """Within the bounds of a broadcast."""
        if self.size is None:
            self.size = self.df.agg(F.coalesce(F.sum(row_bytes(self.df)), F.lit(0))).first()[0]
        return self.rows <= MAX_BROADCAST_ROWS and self.size <= MAX_BROADCAST_BYTES

    def for_join(self) -> DataFrame:
        """Broadcast only when the measured size is within the bounds."""
        return F.broadcast(self.df) if self.small else self.df


def measure(df: DataFrame) -> SizedFrame:
    """A frame that is stored already, with its rows and bytes."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return SizedFrame(df, n, False, size)


def stored_for_fits(df: DataFrame, rows_per_task: int = ROWS_PER_FIT_TASK) -> tuple[DataFrame, int]:
    """The rows stored once in the shared folder, and their number.  Iterative
    fits run a job per step, each with a task per partition: a small table gets
    no more partitions than its rows need, a large one keeps its own."""
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    n = stored.count()
    return stored.coalesce(max(1, -(-n // rows_per_task))), n


def materialize_state(df: DataFrame, max_local_rows: int = MAX_LOCAL_ROWS) -> SizedFrame:
    """Run the state's aggregation once, into ``spark.checkpoint.dir`` (lineage
    cut, survives executor loss), and measure it.  Up to ``max_local_rows``
    rows and MAX_LOCAL_BYTES it comes back as a local relation, whose exact
    size Catalyst knows."""
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    sized = measure(stored)
    if sized.rows <= max_local_rows and sized.size <= MAX_LOCAL_BYTES:
        return SizedFrame(df.sparkSession.createDataFrame(stored.collect(), df.schema), sized.rows, True, sized.size)
    return sized
