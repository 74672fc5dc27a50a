"""What several operators share: the shared folder, stored intermediate tables, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import Broadcast, SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED_DIR = "spark.checkpoint.dir"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that the session names in ``SHARED_DIR``.

    Where the setting is unset, a local session gets a folder of its own; a cluster must set it.
    """
    shared = spark.conf.get(SHARED_DIR, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set(SHARED_DIR, shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, and a lost
    executor loses nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: ContextVar[list[Broadcast] | None] = ContextVar("held", default=None)


def broadcast(context: SparkContext, value: object) -> Broadcast:
    """``context.broadcast``, noted for a surrounding ``released``."""
    made = context.broadcast(value)
    held = _held.get()
    if held is not None:
        held.append(made)
    return made


@contextmanager
def released() -> Iterator[None]:
    """Destroys the broadcasts made inside on leaving. What needs them must be stored by then."""
    held: list[Broadcast] = []
    token = _held.set(held)
    try:
        yield
    finally:
        _held.reset(token)
        for made in held:
            made.destroy()


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the rows of an Arrow batch for this session, so that a batch of whole texts takes
    little memory in the executor and in its Python workers. Results do not depend on it."""
    now = int(spark.conf.get(ARROW_ROWS))
    if now <= 0 or now > rows:
        spark.conf.set(ARROW_ROWS, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column = "text") -> Column:
    """Tells rows of one id but different texts apart; equal rows share it."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def id_remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus
