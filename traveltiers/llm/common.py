"""Helpers shared by the training-data operators.

Words are runs of characters other than space and U+0009..U+000D. Operators read
only the columns they name and work on internal aliases, so further columns of an
input, whatever their names, neither reach nor disturb them.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from traveltiers.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: What str.split() takes for white space and the word rule does not.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Rows of an Arrow batch; bounds a task's memory with long texts.
BATCH_ROWS = 512


def words(text: str | None) -> list[str]:
    """The words of a text; none for null."""
    if not text:
        return []
    return WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files. Vectored reads are off: each of their threads keeps a buffer outside the heap as large as the largest column of a row group that it has read."""
    return spark.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application, so that workers import it and keep what their modules remember."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # read by the driver alone, which serves it
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(out))
    _shipped.add(sc.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; lost executors cost nothing upstream."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def restart(df: DataFrame) -> DataFrame:
    """``cut`` that also forgets the sizes guessed for ``df``.

    A checkpoint keeps the guess, and a join's guess is the product of its sides. In a loop over its own
    result its digits grow exponentially, and the driver's time and memory with them. Joins are planned for large
    sides then, and made smaller by the sizes that are measured.
    """
    kept = cut(df)._jdf
    session = df.sparkSession
    return DataFrame(session._jsparkSession.internalCreateDataFrame(kept.queryExecution().logical().rdd(), kept.schema(), False), session)


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many (narrow) rows for the actions inside."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(rows))
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a schema in DDL; made on the driver."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema))


_remembered: list[tuple[str, dict]] = []


def remember(owner: str, cache: dict) -> None:
    """Declare what a module keeps between the tasks of a worker; it is given up when another module's tasks come."""
    _remembered.append((owner, cache))


def tidy(owner: str) -> None:
    """At the start of a task of ``owner``: drop what other modules remember, and give back to the system what earlier tasks have freed."""
    for name, cache in _remembered:
        if name != owner:
            cache.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


class Columns(Mapping):
    """The columns of a batch, as lists when they are asked for. ``cols | {...}`` and ``rest()`` pass the others on as they came."""

    def __init__(self, batch: pa.RecordBatch):
        self._raw = dict(zip(batch.schema.names, batch.columns))
        self._lists: dict[str, list] = {}

    def __getitem__(self, name: str) -> list:
        if name not in self._lists:
            self._lists[name] = self._raw[name].to_pylist()
        return self._lists[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._raw)

    def __len__(self) -> int:
        return len(self._raw)

    def rest(self) -> dict:
        """All columns as they came."""
        return dict(self._raw)

    def __or__(self, more: Mapping) -> dict:
        return self._raw | dict(more)


def _column(x, kind: pa.DataType) -> pa.Array:
    if isinstance(x, pa.Array):
        return x if x.type == kind else x.cast(kind)
    return pa.array(x, kind)


def map_batches(df: DataFrame, fn: Callable[[Columns], dict], schema: str, state: Callable | None = None) -> DataFrame:
    """``fn`` over Arrow batches: its columns in, a dict of column -> values (or Arrow arrays) out.

    ``state`` makes, once a task, an object that ``fn`` gets as its second argument. Batches hold BATCH_ROWS rows at most.
    """
    spark = df.sparkSession
    ship(spark)
    arrow, owner = arrow_schema(schema), fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(owner)
        own = state() if state else None
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                cols = Columns(whole.slice(at, BATCH_ROWS))
                out = fn(cols, own) if state else fn(cols)
                yield pa.RecordBatch.from_arrays([_column(out[f.name], f.type) for f in arrow], schema=arrow)

    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(limit)) > BATCH_ROWS or int(spark.conf.get(limit)) <= 0:
        spark.conf.set(limit, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)
