"""What the operators of this subpackage share: reading, Arrow batches, word spans, hashes, scratch tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 2 << 20
#: Rows of a batch that are worked on, and sent on, at a time.
SLICE = 512

U64 = np.uint64
_SCRATCH: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or "file://" + os.path.join(tempfile.gettempdir(), "loomspan-scratch")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _SCRATCH:
        atexit.register(drop_scratch)
    _SCRATCH.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch() -> None:
    """Delete the tables that stored() has written; results that still read them must be written before."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may have ended; the folder is scratch space
            return


def carried(df: DataFrame) -> DataFrame:
    """Each row as one struct _row, so that columns added later clash with none of its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def with_columns(df: DataFrame, fn: Callable[[pa.Array], dict[str, pa.Array]], kinds: str, text: str = "text") -> DataFrame:
    """The rows of df as _row, and the columns that fn makes of each batch of whole texts (null: empty)."""
    extra = T._parse_datatype_string(kinds)
    schema = T.StructType([T.StructField("_row", carried(df).schema[0].dataType, False), *extra.fields])
    names = extra.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).type.get_field_index(text)
            for k in range(0, batch.num_rows, SLICE):
                row = batch.column(0).slice(k, SLICE)
                got = fn(pc.fill_null(row.field(at), ""))
                yield pa.RecordBatch.from_arrays([row, *(got[n] for n in names)], ["_row", *names])

    return carried(df).mapInArrow(run, schema)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of strings without nulls, and where each begins (one more: the end)."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = col.buffers()
    starts = np.frombuffer(at, np.int64)[col.offset : col.offset + len(col) + 1]
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def passes(starts: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together, each text whole."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_GOLD = U64(0x9E3779B97F4A7C15)
#: What is left of eight bytes if only so many count.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hashes of spans of bytes: eight bytes at a time go through the scrambling with what came before.

    Spans of one length of at most eight bytes never share a hash, and no sum
    relates the hashes of longer ones, unlike those of polynomials.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = end - begin
    out = mix(mix(size.astype(U64) + U64(seed * int(_GOLD) % (1 << 64))) ^ (eight[begin] & _FIRST[np.minimum(size, 8)]))
    left = np.flatnonzero(size > 8)
    k = 8
    while len(left):
        rest = size[left] - k
        out[left] = mix(out[left] * _GOLD ^ (eight[begin[left] + k] & _FIRST[np.minimum(rest, 8)]))
        left = left[rest > 8]
        k += 8
    return out


def spans_of(is_word: np.ndarray, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of word bytes that crosses no text, and the number of words before each text (one more: all)."""
    n = len(data)
    word = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    before = np.zeros(n, bool)
    before[1:] = word[:-1]
    before &= ~edge[:n]
    begin = np.flatnonzero(word & ~before)
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    after &= ~edge[1:]
    end = np.flatnonzero(word & ~after) + 1
    return begin, end, np.searchsorted(begin, starts)


#: Bytes outside [\x20\x09-\x0D].
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def running_sums(sizes: Column, block: int = 256) -> Column:
    """The sum up to and with each element of an array of integers, by built-in functions.

    An array grows by copies, so it is made in blocks: the cost is that of n *
    (n / block**2 + block) elements copied, not of n * n.
    """
    grown = lambda values, first: F.aggregate(values, F.array(first), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))
    zero = F.lit(0)

    def of(x: Column) -> Column:
        blocks = F.transform(F.sequence(zero, F.floor((F.size(x) - 1) / block).cast("int")), lambda b: F.slice(x, b * block + 1, F.lit(block)))
        return let(blocks, lambda bs: let(grown(F.transform(bs, lambda b: F.aggregate(b, zero, lambda a, v: a + v)), zero), lambda before: F.flatten(
            F.transform(bs, lambda b, i: F.slice(grown(b, F.element_at(before, i + 1)), F.lit(2), F.lit(block))))))

    return let(sizes, lambda x: F.when(F.size(x) > 0, of(x)).otherwise(F.array().cast("array<int>")))
