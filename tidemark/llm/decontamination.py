"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words (a shorter item is one window).  A window occurs in a text
if all its words stand there in its order, that is, with containment 1.  For that threshold the necessary prefix of a
window, its shingles ordered by rarity in the corpus, is the single rarest shingle.  So:

1. count the windows' shingles in the corpus; a window with a shingle that the corpus lacks is gone;
2. join the texts' shingles with each window's rarest one (a Bloom filter of fixed size keeps other shingles out of the
   shuffle; it is no larger for larger benchmarks, it only lets more through);
3. positional and length bounds: the window must lie inside the text;
4. exact verification of all words of the window.

Rows are told apart by a number of their own, and only rows with a candidate shingle take part in the joins.

Defined results: a null or wordless text has no words and no hits; a null or wordless item has no windows; an item
without an id is ignored; equal items are each reported; rows that repeat a document each get their own result; very long
texts are read whole, one at a time; no documents give no rows, an empty benchmark no hits; other columns are not read,
and ``drop_contaminated`` keeps them whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, Workspace, arrow_map, list_array, shingle_hashes

WINDOW = 10
SHINGLE = 3
BLOOM_BITS = 24  # 2 MB


def _item_shingles(benchmark: DataFrame, window: int) -> DataFrame:
    """A row for each shingle of each window: item, window text, its length, the shingle's offset and hash."""

    def each(batch: pa.RecordBatch, _row: int, _part: int):
        ids = batch.column(0).to_pylist()
        w = Words(batch.column(1))
        h = w.hashes()
        out = []
        for i, item in enumerate(ids):
            a, n = int(w.first[i]), int(w.count[i])
            if item is None or not n:
                continue
            size = min(window, n)
            k = min(SHINGLE, size)
            s = shingle_hashes(h[a : a + n], k).astype(np.int64)
            for p in range(n - size + 1):
                words = w.text(a + p, a + p + size)
                out += [(item, words, size, k, o, int(s[p + o])) for o in range(size - k + 1)]
        if out:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["item_id", "words", "n", "k", "offset", "h"]).cast(
                pa.schema([("item_id", pa.int64()), ("words", pa.string()), ("n", pa.int32()), ("k", pa.int32()), ("offset", pa.int32()), ("h", pa.int64())])
            )

    cols = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")]
    return arrow_map(benchmark, cols, each, "item_id long, words string, n int, k int, offset int, h long")


def _bloom(hashes: DataFrame):
    """Bitmap over the top bits of the hashes: at most 2^BLOOM_BITS bits, whatever the number of hashes."""
    bit = hashes.select(F.shiftrightunsigned("h", 64 - BLOOM_BITS).alias("bit"))
    words = bit.selectExpr("shiftright(bit, 5) AS w", "shiftleft(1L, CAST(bit % 32 AS INT)) AS b")
    bits = np.zeros(1 << (BLOOM_BITS - 5), np.uint32)
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).toLocalIterator():  # bounded by the bitmap's size
        bits[r["w"]] = r["b"]
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _probe(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = (h >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)
    return (bits[bit >> 5] >> (bit & 31).astype(np.uint32)) & np.uint32(1) != 0


def _text_shingles(w: Words, h: np.ndarray, sizes: list[int], bits: np.ndarray):
    """(position of the first word, hash) of the shingles that pass the filter, inside one text each."""
    last = np.repeat(w.first[1:], w.count)  # end of the text of each word
    for k in sizes:
        s = shingle_hashes(h, k)
        ok = _probe(bits, s)
        ok &= np.arange(len(s)) + k <= last[: len(s)]
        at = np.flatnonzero(ok)
        yield at, s[at].astype(np.int64)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key."""
    with Workspace(docs.sparkSession) as work:
        return work.keep(_decontaminated(work, docs, benchmark, window))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in whose own text no window of an item occurs, all columns kept."""
    found = decontaminate(docs, benchmark, window).where("contaminated")
    gone = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
    return docs.join(gone, same, "left_anti")


def _decontaminated(work: Workspace, docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    shingles = work.write(_item_shingles(benchmark, window))
    sizes = sorted(r[0] for r in shingles.select("k").distinct().collect()) or [SHINGLE]  # at most SHINGLE values
    bloom = _bloom(shingles.select("h"))

    def count(batch: pa.RecordBatch, _row: int, _part: int):
        w = Words(batch.column(0))
        found = [s for _, s in _text_shingles(w, w.hashes(), sizes, bloom.value)]
        h, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], ["h", "n"])

    text = F.col("text").cast("string").alias("text")
    counts = arrow_map(docs, [text], count, "h long, n long").groupBy("h").agg(F.sum("n").alias("df"))
    # The necessary prefix of each window: its rarest shingle.  A shingle that the corpus lacks rules the window out.
    windows = (
        shingles.join(counts, "h", "left")
        .groupBy("item_id", "words", "n")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "h")).alias("p"))
        .where(F.col("p.df") > 0)
        .select("item_id", "words", "n", F.col("p.offset").alias("offset"), F.col("p.h").alias("h"))
    )
    windows = work.write(windows)
    prefix = _bloom(windows.select("h"))

    def probe(batch: pa.RecordBatch, row: int, part: int):
        w = Words(batch.column(1))
        h = w.hashes()
        pos, key, around, begin, doc = [], [], [], [], []
        owner = w.doc_of_word()
        for at, s in _text_shingles(w, h, sizes, prefix.value):
            for a, x in zip(at.tolist(), s.tolist(), strict=True):
                d = owner[a]
                lo, hi = max(int(w.first[d]), a - window + 1), min(int(w.first[d + 1]), a + window)
                doc.append(d)
                pos.append(a - int(w.first[d]))
                key.append(x)
                begin.append(lo - int(w.first[d]))
                around.append(w.text(lo, hi))
        order = np.argsort(np.asarray(doc, np.int64), kind="stable")
        sizes_ = np.bincount(np.asarray(doc, np.int64), minlength=batch.num_rows)
        hits = pa.StructArray.from_arrays(
            [pa.array(np.asarray(key, np.int64)[order]), pa.array(np.asarray(pos, np.int32)[order]), pa.array(np.asarray(begin, np.int32)[order]), pa.array([around[i] for i in order], pa.string())],
            ["h", "pos", "begin", "around"],
        )
        rows = (np.int64(part) << np.int64(40)) + row + np.arange(batch.num_rows)
        return pa.RecordBatch.from_arrays([pa.array(rows), batch.column(0), batch.column(2), pa.array(w.count.astype(np.int64)), list_array(hits, sizes_)], ["row", "doc_id", "text_key", "n_words", "hits"])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), text, F.xxhash64(F.col("text").cast("string")).alias("text_key")]
    hit = work.write(arrow_map(docs, columns, probe, "row long, doc_id long, text_key long, n_words long, hits array<struct<h:long,pos:int,begin:int,around:string>>"))
    one = hit.select("row", "n_words", F.explode("hits").alias("x")).select("row", "n_words", "x.*")
    start = F.col("pos") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    exact = F.array_join(F.slice(F.split("around", " "), F.greatest(start - F.col("begin") + 1, F.lit(1)), F.col("n")), " ") == F.col("words")
    found = one.join(windows, "h").where(inside & exact).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(start.alias("s"), (start + F.col("n")).alias("e")))).alias("spans"), F.collect_set("item_id").alias("items")
    )
    none = F.array()
    per_row = hit.drop("hits").join(found, "row", "left").withColumns({"spans": F.coalesce("spans", none.cast("array<struct<s:int,e:int>>")), "items": F.coalesce("items", none.cast("array<long>"))})
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("c"), F.lit(0).alias("e")),
        lambda a, x: F.struct((a["c"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["e"]))).alias("c"), F.greatest(a["e"], x["e"]).alias("e")),
        lambda a: a["c"],
    )
    ids = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    return per_row.select(
        "doc_id", "text_key", "n_words", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH i AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw USING (n, words)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
