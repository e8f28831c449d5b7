"""Helpers shared by the operators: column picking, shared tables, packed document blocks.

Large inputs move through Spark as *blocks*: a task packs some MB of documents into one row (an Arrow
IPC stream, zstd). An operator that must compare documents with one another lets every block send its
distinct keys, packed per hash bucket, to bucket tasks and gets the answers back in the order sent. So a
key that a third of all documents hold costs one entry per block, never one per document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.session import ensure_checkpoint_dir

BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "block long, n_bytes long, packed binary"
BUCKET_KEYS = 1 << 20


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns cast to the given types; other columns, also ones that differ only in case, go."""
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{_place(names, n)}").cast(t).alias(n) for n, t in types.items()])


def _place(names: list[str], name: str) -> int:
    if name in names:
        return names.index(name)
    low = [n.lower() for n in names]
    if name.lower() not in low:
        raise ValueError(f"no column {name!r} among {names}")
    return low.index(name.lower())


def replace_column(names: list[str], name: str) -> int:
    """Position of ``name`` among ``names``."""
    return _place(names, name)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by_block(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, bucketed by ``block``: later joins on ``block`` leave these large rows where they are."""
    spark = df.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", shared_path(spark, name)).bucketBy(n, "block").format("parquet").saveAsTable(table)
    return spark.table(table)


def table_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def read_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def packer(text_col: str, block_bytes: int = BLOCK_BYTES):
    """For mapInArrow: rows gathered into blocks of about ``block_bytes`` of text (one very long text may
    make a larger block of its own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(pid << 32) + seq], pa.int64()), "n_bytes": pa.array([size], pa.int64()),
                "packed": pa.array([table_bytes(table)], pa.binary())})

        for batch in batches:
            lens = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text_col))), 0).to_pylist()
            at = 0
            for i, n in enumerate(lens):
                size += n + 16
                if size >= block_bytes:
                    held.append(batch.slice(at, i + 1 - at))
                    at = i + 1
                    yield flush()
                    seq, held, size = seq + 1, [], 0
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield flush()

    return run


def pack(df: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the rows of ``df``. Block numbers come from the partition, so store the result once."""
    return df.mapInArrow(packer(text_col, block_bytes), BLOCK_SCHEMA)


def release() -> None:
    """Give freed memory back to the system: Python workers live on between tasks, beside the executor's JVM."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bucket_count(spark: SparkSession, keys: int) -> int:
    """Buckets for ``keys`` packed keys: the session's shuffle partitions, more when buckets would grow large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // BUCKET_KEYS))
