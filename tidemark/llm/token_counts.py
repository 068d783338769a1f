"""Token counts of documents in flat, unindexed token files.

A token file is nothing but token ids, each document followed by an end-of-document id.  A file is read as blocks of
fixed size.  Each block is searched for the id at once (a vectorised comparison); what leaves a block is a row with the
places of the separators.  Documents that span blocks are stitched by a prefix scan over the block rows: a prefix sum
gives each block's first token and first document number, a prefix maximum the last separator before it.  The scan has
two levels (blocks within a group of ``GROUP``, then groups), so a file of any length is never scanned by one task.

Files are tables of blocks, ``stream long, block long, tokens binary``, as ``write_token_blocks`` writes and
``blocks_of_files`` makes of raw files in any store that Spark reads.  Ids are little-endian, two bytes where the
vocabulary fits, else four.

Defined results: an empty document has 0 tokens; two separators in a row enclose an empty document; tokens after the last
separator of a stream are a last, unterminated document; an empty stream has none; null texts are empty documents; very long
documents span as many blocks as they need; rows that repeat a document each get a row; an empty table has no rows; other
columns are not read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, list_array

BLOCK_TOKENS = 65536
GROUP = 1024
END_OF_DOCUMENT = 50256
BLOCKS = "stream long, block long, tokens binary"


def token_width(path: str | None = None, end: int = END_OF_DOCUMENT) -> int:
    """Bytes of an id: two where all ids of the vocabulary and the separator fit."""
    from tidemark.llm.bpe import default_vocabulary

    with open(path or default_vocabulary(), encoding="utf-8") as f:
        spec = json.load(f)
    top = max([end, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return 2 if top < 1 << 16 else 4


KINDS = {2: "<u2", 4: "<u4"}


def write_token_blocks(
    work: Workspace, docs: DataFrame, vocabulary: str | None = None, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS, width: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(blocks, order): the texts as flat token files, one stream a partition, and (stream, ordinal, doc_id), the order
    in which documents were written.  Texts are ordinary text: a special token's name in one is no separator.  An id that
    ``width`` bytes cannot hold is an error."""
    from tidemark.llm.bpe import shared_bpe, vocabulary_broadcast
    from tidemark.llm.common import blocks as text_blocks

    vocab = vocabulary_broadcast(docs.sparkSession, vocabulary)

    def packed(tokens: np.ndarray) -> bytes:
        if len(tokens) and not 0 <= tokens.min() <= tokens.max() < 1 << (8 * width):
            raise ValueError(f"token id {tokens.max()} does not fit {width} bytes")
        return tokens.astype(KINDS[width]).tobytes()

    def run(batches):
        from pyspark import TaskContext

        bpe, stream = shared_bpe(vocab.value, special_tokens=False), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        n_held = block = ordinal = 0

        def row(tokens: np.ndarray):
            return pa.RecordBatch.from_arrays(
                [pa.array([stream], pa.int64()), pa.array([block], pa.int64()), pa.array([packed(tokens)], pa.binary()), pa.array([ordinal - len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int64()))],
                ["stream", "block", "tokens", "first", "doc_ids"],
            )

        for batch in batches:
            for part in text_blocks(batch):
                for doc, tokens in zip(part.column(0).to_pylist(), bpe.encode_batch([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    held += [tokens, np.array([end], np.int32)]
                    n_held += len(tokens) + 1
                    ids.append(doc)
                    ordinal += 1
                if n_held >= block_tokens:
                    flat = np.concatenate(held)
                    whole = n_held // block_tokens
                    for i in range(whole):
                        yield row(flat[i * block_tokens : (i + 1) * block_tokens])
                        block += 1
                        ids = []
                    held, n_held = [flat[whole * block_tokens :]], n_held - whole * block_tokens
        if n_held or ids:
            yield row(np.concatenate(held) if held else np.empty(0, np.int32))

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    written = work.write(docs.select(*cols).mapInArrow(run, f"{BLOCKS}, first long, doc_ids array<long>"))
    order = written.select("stream", "first", F.posexplode("doc_ids").alias("i", "doc_id")).select("stream", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return written.select("stream", "block", "tokens"), order


def blocks_of_files(spark: SparkSession, path: str, block_bytes: int = 2 * BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw token files, read by Spark; a stream for each file, named by a hash of its path."""
    files = spark.read.format("binaryFile").load(path)
    n = F.greatest(F.ceil(F.col("length") / block_bytes), F.lit(1))
    each = files.select(F.xxhash64("path").alias("stream"), "content", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("block"))
    return each.select("stream", "block", F.substring("content", (F.col("block") * block_bytes + 1).cast("int"), F.lit(block_bytes)).alias("tokens"))


def scan_blocks(blocks: DataFrame, end: int = END_OF_DOCUMENT, width: int = 2) -> DataFrame:
    """(stream, block, n, ends): number of tokens, and the places of the separators in the block."""
    kind = KINDS[width]

    def run(batches):
        for batch in batches:
            places, sizes, n = [], [], []
            for tokens in batch.column(2):
                t = np.frombuffer(tokens.as_py() or b"", kind)
                at = np.flatnonzero(t == end)
                places.append(at.astype(np.int32))
                sizes.append(len(at))
                n.append(len(t))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), list_array(pa.array(np.concatenate(places) if places else np.empty(0, np.int32)), np.array(sizes, np.int64))], ["stream", "block", "n", "ends"])

    return blocks.select("stream", "block", "tokens").mapInArrow(run, "stream long, block long, n long, ends array<int>")


def _before(value: Column, how, w) -> Column:
    return how(value).over(w.rowsBetween(Window.unboundedPreceding, -1))


def document_lengths(work: Workspace, scanned: DataFrame) -> DataFrame:
    """(stream, ordinal, start, n_tokens, terminated): the documents of each stream, from the scanned blocks."""
    b = work.write(scanned.withColumn("g", F.floor(F.col("block") / GROUP)).withColumn("k", F.size("ends").cast("long")))
    # Places of separators count from the stream's start; at the group level from the group's start, added later.
    w = Window.partitionBy("stream", "g").orderBy("block")
    local = b.withColumns({"at": F.coalesce(_before(F.col("n"), F.sum, w), F.lit(0)), "docs": F.coalesce(_before(F.col("k"), F.sum, w), F.lit(0))})
    local = local.withColumn("last", F.when(F.col("k") > 0, F.col("at") + F.element_at("ends", -1)))
    local = local.withColumn("seen", _before(F.col("last"), F.max, w))
    groups = local.groupBy("stream", "g").agg(F.sum("n").alias("gn"), F.sum("k").alias("gk"), F.max("last").alias("glast"), F.max("block").alias("top"))
    v = Window.partitionBy("stream").orderBy("g")
    groups = groups.withColumns({"gat": F.coalesce(_before(F.col("gn"), F.sum, v), F.lit(0)), "gdocs": F.coalesce(_before(F.col("gk"), F.sum, v), F.lit(0))})
    groups = groups.withColumn("gseen", _before(F.col("gat") + F.col("glast"), F.max, v)).withColumn("final", F.max("top").over(Window.partitionBy("stream")))
    j = local.join(groups.select("stream", "g", "gat", "gdocs", "gseen", "final"), ["stream", "g"])
    start = F.coalesce(F.col("gat") + F.col("seen"), F.col("gseen"), F.lit(-1)) + 1  # where the open document begins
    j = j.select("stream", "block", "final", "k", (F.col("gat") + F.col("at")).alias("at"), (F.col("gdocs") + F.col("docs")).alias("first"), start.alias("open"), "n", "ends")
    closed = j.select("stream", "first", "at", "open", "ends", F.posexplode("ends").alias("i", "e"))
    begin = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("at") + F.get("ends", F.col("i") - 1) + 1)
    closed = closed.select("stream", (F.col("first") + F.col("i")).alias("ordinal"), begin.alias("start"), (F.col("at") + F.col("e") - begin).alias("n_tokens"), F.lit(True).alias("terminated"))
    last = F.when(F.col("k") > 0, F.col("at") + F.element_at("ends", -1) + 1).otherwise(F.col("open"))
    rest = j.where(F.col("block") == F.col("final")).select("stream", (F.col("first") + F.col("k")).alias("ordinal"), last.alias("start"), (F.col("at") + F.col("n") - last).alias("n_tokens"), F.lit(False).alias("terminated"))
    return closed.unionByName(rest.where(F.col("n_tokens") > 0))


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, stream, ordinal, start: written as flat files, then counted from these."""
    with Workspace(docs.sparkSession) as work:
        width = token_width(vocabulary)
        blocks, order = write_token_blocks(work, docs, vocabulary, width=width)
        lengths = document_lengths(work, scan_blocks(blocks, width=width))
        return work.keep(order.join(lengths, ["stream", "ordinal"]).select("doc_id", "n_tokens", "stream", "ordinal", "start"))
