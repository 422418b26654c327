"""What the operators of this subpackage share: the shared folder, written tables, inputs."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weft import share_code

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: What one Arrow batch between Spark and Python holds at most (a single longer text aside).
BATCH_ROWS, BATCH_BYTES = 4000, 8 << 20

_own_folder: str | None = None
#: Name and emptying of what modules keep between tasks of a worker.
caches: dict[str, Callable] = {}


def ready(spark: SparkSession) -> None:
    """Sets up the session: workers find this package, and batches are bounded in rows and bytes."""
    share_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def empty_caches(keep: str | None = None) -> None:
    for name, empty in caches.items():
        if name != keep:
            empty()


def give_back() -> None:
    """Returns freed memory to the system: Spark keeps workers between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def lean(rows: Callable, keep: str | None = None) -> Callable:
    """``rows`` for mapInArrow, such that a worker holds no caches of other operators (all but
    ``keep``) while it runs and gives back what it freed at its end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_caches(keep)
        try:
            yield from rows(batches)
        finally:
            give_back()

    return run


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where that is unset (tests, one machine) a temporary folder is made once.
    """
    global _own_folder
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="weft-")
    return f"file://{_own_folder}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/weft-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts the lineage, and a lost
    executor costs no recomputation of what lies before it."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._weft_path = path
    return made


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made; what still reads them must itself be written."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(df._weft_path)
        path.getFileSystem(conf).delete(path, True)


def joined(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the corpus: both are sorted, neither is broadcast,
    however small it looks now. Adaptive execution may split the larger side's hot keys."""
    return left.join(right.hint("merge"), on, how)


def drop_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished, unreferenced plans now
    rather than at some later garbage collection of the driver."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id long and text string of ``docs``; columns of other names are left out.

    Columns of these types are taken as they are: plans over an alias and over its column
    don't count as equal, and Spark would not reuse the shuffle of one for the other.
    """
    kinds = dict(docs.dtypes)
    return docs.select(*(F.col(c) if kinds[c] == kind else F.col(c).cast(kind).alias(c) for c, kind in (("doc_id", "bigint"), ("text", "string"))))


def id_remainder(doc_id, divisor: int):
    """crc32 of the id as text, modulo ``divisor``: the folds of held-out rows."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


def marked(docs: DataFrame, more: list[str] = []) -> DataFrame:  # noqa: B006
    """doc_id, text (null: empty), mark (tells apart texts under one id) and the columns ``more``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"), *more)


def as_bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def packed_texts(docs: DataFrame, more: list[str] = []) -> DataFrame:  # noqa: B006
    """doc_id, mark, the compressed text and the columns ``more``, for shuffles; ``docs`` as ``marked`` gives it."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(1)
        for batch in batches:
            packed = pa.array([compressor.compress(d) for d in as_bytes(batch.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, *batch.columns[3:]], names=["doc_id", "mark", "packed", *more])

    schema = StructType.fromDDL("doc_id long, mark long, packed binary")
    for c in more:
        schema = schema.add(c, docs.schema[c].dataType)
    return docs.select("doc_id", "mark", "text", *more).mapInArrow(lean(rows), schema)


def unpack(column: pa.Array) -> list[bytes]:
    decompressor = zstandard.ZstdDecompressor()
    return [decompressor.decompress(x) for x in column.to_pylist()]


def as_texts(data: list[bytes]) -> pa.Array:
    """Bytes as a string array; what isn't valid UTF-8 is only hashed, never decoded."""
    return pa.array(data, pa.large_binary()).view(pa.large_string())


def whole_groups(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows of equal ``column``, by which the batches are sorted: as
    many groups at a time as a batch ends, so at most one batch and one group are held."""
    held: list[pa.RecordBatch] = []  # the group that the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(column)
        same = pc.equal(key, key[-1])
        last = pc.index(same, True).as_py()
        if held and (last or held[-1].column(column)[-1].as_py() != key[0].as_py()):
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)]).combine_chunks()
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def with_text(docs: DataFrame, columns: list[str], text: str) -> tuple[DataFrame, int]:
    """``columns`` of ``docs`` with the text, and its place among them. A text that is one of
    ``columns`` isn't sent to Python a second time."""
    if text in columns and dict(docs.dtypes)[text] == "string":
        return docs.select(*columns), columns.index(text)
    return docs.select(*columns, F.col(text).cast("string").alias("_text")), len(columns)
