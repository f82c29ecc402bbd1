"""Tables that a multi-step operator reads again and again: written once to
the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..sources.io import scratch_path

_open: ContextVar[Scratch | None] = ContextVar("open_scratch", default=None)


def pinned(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a written table: it cuts the lineage and survives
    the loss of executors. Inside a ``Scratch`` it lasts as long as that."""
    path = scratch_path(df.sparkSession, name)
    holder = _open.get()
    if holder is not None:
        holder.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Deletes the tables pinned inside its ``with`` block when the block is
    left, also by an error. What is to outlive it goes through ``keep``, which
    writes it: nothing that was deleted is in its lineage. A kept table belongs
    to the enclosing ``Scratch`` if there is one, else to the caller."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        self._token = _open.set(self)
        return self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        outer = self._token.old_value
        token = _open.set(outer if isinstance(outer, Scratch) else None)
        try:
            return pinned(df, name)
        finally:
            _open.reset(token)

    def __exit__(self, *error) -> None:
        _open.reset(self._token)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
