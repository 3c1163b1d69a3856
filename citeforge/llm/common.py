"""Shared folder, staged tables and byte-level helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Rows and bytes of an Arrow batch: bytes are what bounds a batch of texts, which may be megabytes long.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20
_left: dict[str, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once; the same values for all operators, as lazy plans read them when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lanes(spark: SparkSession) -> int:
    """Partitions for few rows that mean much work, which AQE must not merge; grows with the cluster and with what is set for shuffles."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_id(text: Column) -> Column:
    """16 bytes of the SHA-256 of a text (null: empty): names a text whatever its row's id is."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder, in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="citeforge-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def free_name(columns: list[str], name: str) -> str:
    """name, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    _left[path] = out
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing lazy depends on any more."""
    for df in tables:
        if path := getattr(df, "_staged_path", None):
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
            _left.pop(path, None)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs that are done go when the driver collects its garbage, which it may not do for long: now."""
    spark._jvm.System.gc()


def tables_now() -> set[str]:
    return set(_left)


def sweep(*but: DataFrame, since: set[str]) -> None:
    """Deletes the staged tables made since tables_now() gave ``since``, but not those given: for callers that have written what they wanted."""
    kept = since | {getattr(df, "_staged_path", None) for df in but}
    discard(*[df for path, df in list(_left.items()) if path not in kept])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (xor-shift and multiply rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for b in (_BASE, _INV):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of (symbol + 1) * base**j over j < i; span_hash() reads off the hash of any stretch."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + U64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches [start, end), equal for equal bytes wherever they lie."""
    _, down = powers(len(s))
    return mix64((s[end] - s[start]) * down[start] + (end - start).astype(np.uint64))


def grams(s: np.ndarray, n: int, gram: int) -> np.ndarray:
    """Hashes of all stretches of ``gram`` of n symbols, in one pass of slices; not those of span_hash()."""
    _, down = powers(n + 1)
    x = s[gram : n + 1] - s[: n - gram + 1]
    x *= down[: n - gram + 1]
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    return x


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_PART = 1 << 20


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words (runs without ASCII white space) begin and end."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _WHITE[data], [True])).astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in their order; read in parts that end between words."""
    out, at, rest = [], 0, b""
    while at < len(raw) or rest:
        part, at = rest + raw[at : at + _PART], at + _PART
        data, rest = np.frombuffer(part, np.uint8), b""
        if at < len(raw):  # the last word may go on
            blanks = np.flatnonzero(_WHITE[data])
            end = int(blanks[-1]) + 1 if len(blanks) else 0
            data, rest = data[:end], part[end:]
        out.append(span_hash(prefix_hash(data), *word_edges(data)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)
