"""Stored intermediates that go when the result that needed them is stored."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from marketgrain.session import materialize

_open: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored by ``stored`` or named to ``discard`` inside is removed at the end, also after an error."""
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield
    finally:
        _open.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(path: str) -> str:
    """Have a folder of this run removed with the other intermediates; outside of ``scratch`` it stays."""
    if (paths := _open.get()) is not None:
        paths.append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; an intermediate of the surrounding ``scratch``."""
    out = materialize(df, label)
    if files := out.inputFiles():
        discard(files[0].rpartition("/")[0])
    return out
