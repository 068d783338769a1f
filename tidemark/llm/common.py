"""Shared folders, flat word arrays, row identities and connected components for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import scratch_dir

BLOCK_BYTES = 1 << 20  # texts are processed in blocks of about this size, or one text at a time


# --- shared storage ----------------------------------------------------------------------------------------------


class Workspace:
    """Intermediate tables of one call, in the folder that driver and executors share.  Writing one cuts the lineage: what
    lost executors held is read again, not computed again.  (A checkpoint would do the same, but keeps the planner's size
    estimate, which joins multiply step by step.)

    On leaving, all tables are deleted but those kept, as results that are still to be read; these go when the
    application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.made = spark, f"{scratch_dir(spark)}/tidemark-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.root)

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _delete(self, path: str) -> None:
        fs, p = self._path(path)
        fs.delete(p, True)

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        conf, key = self.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(key, "false")
        conf.set(key, "true")  # what was shuffled for the table goes as soon as it is written
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(key, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tidemark_path = path
        return out

    def write(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return self._write(df, f"{self.root}/{self.made}")

    def drop(self, *written: DataFrame) -> None:
        """Delete tables of this workspace before its end."""
        for df in written:
            self._delete(df._tidemark_path)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a result that outlives the workspace."""
        self.made += 1
        path = f"{self.root}-kept/{self.made}"
        out = self._write(df, path)
        fs, p = self._path(f"{self.root}-kept")
        fs.deleteOnExit(p)
        return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(c: Column, mod: int) -> Column:
    """crc32 of a number written as text, modulo; a null counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


# --- texts as flat arrays ----------------------------------------------------------------------------------------


def arrow_map(df: DataFrame, columns: list[Column], each, schema: str) -> DataFrame:
    """``each(batch, number of the first row in the partition, partition) -> batch`` over blocks of rows."""
    out_schema = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for block in blocks(batch):
                got = each(block, done, part)
                done += block.num_rows
                if got is not None and got.num_rows:
                    yield got

    return df.select(*columns).mapInArrow(run, out_schema)


def blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about BLOCK_BYTES of text, whole rows each."""
    if batch.num_rows == 0:
        return
    size = lengths(batch.column(batch.schema.get_field_index(column)))
    cum, at = np.cumsum(size), 0
    while at < len(size):
        base = cum[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(cum, base + BLOCK_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def lengths(arr: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(arr), 0)).astype(np.int64)


def flat_text(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, n + 1 offsets); a null is an empty text."""
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    return data, off - off[0]


def _alnum_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for b in range(256):
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            t[b] = b
        elif 65 <= b <= 90:
            t[b] = b + 32
    return t


#: Byte to lower-case byte of a word, 0 for separators: ASCII letters and digits and anything beyond ASCII.
ALNUM = _alnum_table()
_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_VALUE[0] = 0
_PLACE = _rng.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Words:
    """Words of a block of texts: byte ranges, text of each word, first word of each text, and 64-bit hashes."""

    def __init__(self, arr: pa.Array, table: np.ndarray = ALNUM):
        self.data, self.offsets = flat_text(arr)
        self.mapped = table[self.data]
        inside = self.mapped != 0
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before &= ~edge[:n]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        #: first[i] is the number of words before text i; first has n + 1 entries
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, np.uint64)
        size = self.end - self.start
        at = np.cumsum(size) - size
        pos = np.arange(int(size.sum())) - np.repeat(at, size)
        value = _BYTE_VALUE[self.mapped[pos + np.repeat(self.start, size)]] * _PLACE[pos & 4095]
        return mix(np.add.reduceat(value, at) + size.astype(np.uint64))

    def text(self, i: int, j: int) -> str:
        """Words i to j (exclusive) of the block, joined by blanks."""
        m = self.mapped
        return b" ".join([m[s:e].tobytes() for s, e in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)]).decode("utf-8", "replace")

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words of the block; those that cross texts are for the caller to leave out."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x100000001B3) + mix(h[i : i + n], i + 1)
    return mix(out)


def list_array(flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)


# --- connected components ----------------------------------------------------------------------------------------


def connected_components(work: Workspace, edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each component, for the nodes of the edges.

    Each round points every node at its least neighbour or itself (an aggregation of the edges), shortens the pointers
    to their ends, and contracts the edges along them.  A node's pointer is an edge, so what is connected stays connected until
    no edge is left; star-shaped inputs shrink to next to nothing in the first round.
    """
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col("a") < F.col("b")).distinct()
    e, roots = work.write(e), None
    for _ in range(max_rounds):
        both = e.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p")).select("p.*")
        near = work.write(both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("to")))
        while True:  # shorten pointers to their ends, doubling each time, so that chains fold at once
            up = near.select(F.col("node").alias("to"), F.col("to").alias("above"))
            jumped = work.write(near.join(up, "to", "left").select("node", F.coalesce("above", "to").alias("to"), (F.coalesce("above", "to") != F.col("to")).alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            work.drop(near)
            near = jumped
            if not moved:
                break
        to = near.select("node", "to")
        if roots is None:
            new = to.withColumnRenamed("to", "root")
        else:
            new = roots.join(to.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        new = work.write(new)
        of_a, of_b = to.select(F.col("node").alias("a"), F.col("to").alias("ra")), to.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        left = e.join(of_a, "a").join(of_b, "b").where(F.col("ra") != F.col("rb"))
        left = work.write(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        work.drop(e, near, *([roots] if roots is not None else []))
        e, roots = left, new
        if e.isEmpty():
            work.drop(e)
            return roots
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
