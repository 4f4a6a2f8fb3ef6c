"""What the operators of this subpackage share: session settings, the shared folder, rows beside clashing names, fitting."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes in one Arrow batch at most (one row may be larger): a batch fits beside a small heap.
ARROW_ROWS, ARROW_BYTES = 512, 16 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches that suit whole documents; smaller ones that are set already stay."""
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name).removesuffix("b")
        if not now.isdigit() or int(now) == 0 or int(now) > most:
            spark.conf.set(name, str(most))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="facetforge-"))
    return context.getCheckpointDir().rstrip("/")


#: The tables stored inside the innermost `cleared` of this thread.
inside: ContextVar[list[Stored] | None] = ContextVar("inside", default=None)


class Stored:
    """A table written to the shared folder: its lineage ends there, so a lost executor costs no recomputation."""

    def __init__(self, df: DataFrame, label: str, lasting: bool = False):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.parquet(self.path)
        if not lasting:
            self.remember()

    def remember(self) -> None:
        """Leaves the table to the `cleared` around it, if there is one."""
        if (tables := inside.get()) is not None:
            tables.append(self)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def cleared() -> Iterator[None]:
    """Drops the tables that were stored inside, by this thread alone: others may run pipelines of their own beside it.
    An operator's result may read its tables, so it is written first:

    with cleared():
        operator(docs).write.parquet(...)
    """
    tables: list[Stored] = []
    around = inside.set(tables)
    try:
        yield
    finally:
        inside.reset(around)
        for table in tables:
            table.drop()


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """Each row as the struct `row`, and the operator's own columns: no name of the documents can clash with theirs."""
    return docs.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in own.items()))


def with_row(rows: DataFrame, **kinds: str) -> T.StructType:
    """The schema of `row` and further columns, by their types' names."""
    made = [T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items()]
    return T.StructType([T.StructField("row", rows.schema["row"].dataType), *made])


def unpacked(rows: DataFrame, **own: Column) -> DataFrame:
    """The documents' columns again, then the operator's own; of the documents' those with names of its own are replaced."""
    names = {n.lower() for n in own}
    kept = [F.col("row").getField(c).alias(c) for c in rows.schema["row"].dataType.names if c.lower() not in names]
    return rows.select(*kept, *(c.alias(n) for n, c in own.items()))


def fitted(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """What `fit` makes of a bounded sample, in one task of an executor: the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(pa.Table.from_batches(held)))], pa.binary())], ["model"])

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else None
