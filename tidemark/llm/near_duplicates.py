"""Near duplicates by Order MinHash, verified by banded alignment.

A text's k-mers (``K`` consecutive words, numbered by occurrence, so that repeats count) are hashed; each of ``SKETCHES``
sketches takes the ``L`` least and keeps them in text order.  The probability that two texts share a sketch grows with
their edit similarity, not only with the overlap of their k-mers.  Texts of up to ``SHORT`` words, and those that may be
similar to one, also have sketches of k-mers of ``SHORT_K`` words.  Candidates share a sketch; a pair is a link where the
word edit distance, computed in a band, is at most (1 - ``SIMILARITY``) of the longer text.  ``SKETCHES`` is chosen for pairs
near that bound; the README gives the recall measured against all pairs.

Work is kept near linear in the rows, for groups of any size:

- texts with equal words are one class representative from the start, by partial aggregation;
- a bucket (texts that share a sketch) compares its members with one hub rather than with each other; then, in buckets
  of at most ``SMALL`` texts, all pairs that the links so far do not connect.  That is at most ``SMALL`` rows a member, and
  no pair that shares such a bucket is left out;
- larger buckets that are still of several components compare their members with ``HUBS`` further hubs.  Of what is then
  still of several components, the members outside the largest one meet all others: both sides are dealt to blocks of
  about ``BLOCK`` by hash, and each pair of blocks is a task of its own, whatever the bucket's size.  A pair is left where two
  bounds that no link exceeds (lengths, and counts of words by hash in ``BINS`` bins) allow it, in the first such bucket that
  has both texts; then it is aligned.  So no pair that shares a sketch is left out, and rows grow with members times
  blocks;
- words travel as 32-bit hashes, and only those of texts in candidate pairs.

Rows are told apart by a number of their own, never by their id, so rows that repeat an id with another text are rows
like any others.

Defined results: a null text is a class of its own; texts without words are one class where they are equal byte for
byte; a text of one word has one k-mer, the word; very long texts are compared whole; ``class_id`` is the least id of the class, null where none of its rows has one; an empty table has no rows;
other columns, whatever their names, are not read.  ``keep`` marks the rows of least id of each class (of an id with several
texts in one class the one of least text hash); rows that are equal in id and text are one document and share their fate.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, Workspace, arrow_map, connected_components, list_array, mix, shingle_hashes

K = 5
L = 2
SKETCHES = 72
SHORT, SHORT_K, SHORT_SKETCHES = 64, 2, 24  # in texts of so few words a single edit may hit most k-mers of five
SIMILARITY = 0.8
HUBS = 1
SMALL = 64  # at most so many texts of a bucket are all compared with each other
BLOCK = 1024  # members of larger buckets are compared in blocks of about so many
BINS, COARSE = 512, 64  # bins of a quick bound: an edit moves the counts of two of them by one
CHUNK = 64
POSITION = 24  # low bits of a hash that hold a k-mer's place among those of its block


# --- sketches ----------------------------------------------------------------------------------------------------


def kmers(w: Words, h: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-mer, text of each): k-mers of all texts in order; a shorter text has one, of all its words."""
    s = shingle_hashes(h, k)
    last = np.repeat(w.first[1:], w.count)
    ok = np.arange(len(s)) + k <= last[: len(s)]
    at = np.flatnonzero(ok)
    owner = w.doc_of_word()[at]
    out = s[at]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        whole = np.array([np.bitwise_xor.reduce(mix(h[w.first[d] : w.first[d + 1]] + np.arange(w.count[d], dtype=np.uint64))) for d in short], np.uint64)
        order = np.argsort(np.concatenate([owner, short]), kind="stable")
        out, owner = np.concatenate([out, mix(whole)])[order], np.concatenate([owner, short])[order]
    return out, owner


def label_occurrences(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that also tell the first, second, ... occurrence of a k-mer in its text."""
    key = mix(h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    new = np.append(True, sorted_[1:] != sorted_[:-1])
    begin = np.flatnonzero(new)
    number = np.arange(len(h)) - np.repeat(begin, np.diff(np.append(begin, len(h))))
    occurrence = np.empty(len(h), np.uint64)
    occurrence[order] = number.astype(np.uint64)
    return mix(h + occurrence * np.uint64(0xD6E8FEB86659FD93))


def order_minhash(h: np.ndarray, owner: np.ndarray, sketches: int = SKETCHES, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have k-mers, their sketches): the two least k-mers under each hash function, in text order.

    The hash functions multiply the (already mixed) k-mer hashes by odd numbers; the k-mer's place stands in the low bits,
    so that the minimum tells where it is."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    one = np.diff(np.append(first, len(h))) == 1
    at = np.arange(len(h), dtype=np.uint64)
    low = np.uint64((1 << max(POSITION, len(h).bit_length())) - 1)
    high = ~low
    out = np.empty((len(first), sketches), np.uint64)
    x = np.empty(len(h), np.uint64)
    for s in range(sketches):
        np.multiply(h, _FACTORS[s % len(_FACTORS)], out=x)
        x &= high
        x |= at
        p1 = (np.minimum.reduceat(x, first) & low).astype(np.int64)
        x[p1] = np.uint64(2**64 - 1)
        p2 = (np.minimum.reduceat(x, first) & low).astype(np.int64)
        p2[one] = p1[one]
        a, b = np.minimum(p1, p2), np.maximum(p1, p2)
        out[:, s] = mix(h[a] * np.uint64(3) + mix(h[b], 77), s + 101 + salt)
    return owner[first], out


_FACTORS = np.random.Generator(np.random.PCG64(8)).integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _words32(w: Words, h: np.ndarray) -> list[bytes]:
    """Words of each text as 32-bit hashes."""
    short = (h >> np.uint64(32)).astype(np.uint32)
    return [short[w.first[i] : w.first[i + 1]].tobytes() for i in range(len(w.count))]


SKETCHED = "row long, doc_id long, text_key long, c1 long, c2 long, n_words long, sketch array<long>, words binary"


def _sketch(batch: pa.RecordBatch, row: int, part: int) -> pa.RecordBatch:
    w = Words(batch.column(1))
    h = w.hashes()
    n = batch.num_rows
    code = h.astype(np.uint64)
    c1, c2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    some = np.flatnonzero(w.count)
    if len(some):
        place = (np.arange(len(h)) - np.repeat(w.first[:-1], w.count)).astype(np.uint64)
        for c, salt in ((c1, 11), (c2, 12)):
            c[some] = mix(np.add.reduceat(mix(code + place * np.uint64(0xA24BAED4963EE407), salt), w.first[some]) + w.count[some].astype(np.uint64), salt)
    for i in np.flatnonzero(w.count == 0):
        d = hashlib.md5(w.data[w.offsets[i] : w.offsets[i + 1]].tobytes()).digest()
        c1[i], c2[i] = np.frombuffer(d, np.uint64)
    sk, sizes = np.zeros((n, SKETCHES + SHORT_SKETCHES), np.uint64), np.zeros(n, np.int64)
    for k, sketches, of in ((K, SKETCHES, w.count > SHORT), (SHORT_K, SHORT_SKETCHES, (w.count > 0) & (w.count <= SHORT / SIMILARITY))):
        if of.any():
            km, owner = kmers(w, h, k)
            mine = of[owner]
            km, owner = km[mine], owner[mine]
            texts, found = order_minhash(label_occurrences(km, owner), owner, sketches, 1000 * k)
            sk[texts[:, None], sizes[texts][:, None] + np.arange(sketches)] = found
            sizes[texts] += sketches
    sk = sk[np.arange(sk.shape[1]) < sizes[:, None]]
    rows = (np.int64(part) << np.int64(40)) + row + np.arange(n)
    columns = [pa.array(rows), batch.column(0), batch.column(2), *[pa.array(c.astype(np.int64)) for c in (c1, c2, w.count)]]
    columns += [list_array(pa.array(sk.astype(np.int64)), sizes), pa.array(_words32(w, h), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "text_key", "c1", "c2", "n_words", "sketch", "words"])


# --- alignment ---------------------------------------------------------------------------------------------------


def edit_distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two sequences, or limit + 1 where it is greater; common ends are cut first."""
    n = min(len(a), len(b))
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    if n:
        same = a[:n] == b[:n]
        head = n if same.all() else int(np.argmin(same))
        a, b = a[head:], b[head:]
        n = min(len(a), len(b))
        if n:
            same = a[::-1][:n] == b[::-1][:n]
            tail = n if same.all() else int(np.argmin(same))
            if tail:
                a, b = a[:-tail], b[:-tail]
    if not len(a) or not len(b):
        return min(limit + 1, max(len(a), len(b)))
    return min(limit + 1, _banded(a.tolist(), b.tolist(), limit))


def _banded(a: list[int], b: list[int], band: int) -> int:
    """Edit distance where it is at most ``band``, else something greater: the cells within ``band`` of the diagonal, a column
    at a time, as bits of two numbers that tell where a cell is one more or one less than the one above it.

    The window of rows moves along every ``CHUNK`` columns.  Below and above it cells count as one more a step, which no
    true cell exceeds; a path through them is longer than the band, so results within it are exact."""
    m, where = len(a), {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    low, high = 0, min(m, band + CHUNK)
    full = (1 << high) - 1
    more, less, value = full, 0, high  # value: of the window's last row in this column
    for begin in range(0, len(b), CHUNK):
        if begin:
            top, bottom = min(m, begin + band + CHUNK), max(0, begin - band)
            more |= ((1 << (top - high)) - 1) << (high - low)
            value += top - high
            more, less = more >> (bottom - low), less >> (bottom - low)
            low, high = bottom, top
            full = (1 << (high - low)) - 1
        last = 1 << (high - low - 1)
        for x in b[begin : begin + CHUNK]:
            match = where.get(x, 0) >> low & full
            same = (((match & more) + more) ^ more) | match | less
            up, down = less | (full & ~(same | more)), same & more
            if up & last:
                value += 1
            elif down & last:
                value -= 1
            up, down = (up << 1) | 1, down << 1
            more, less = (down | ~(same | up)) & full, same & up & full
    return value


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether edit distance <= (1 - similarity) * longer length."""
    longer = max(len(a), len(b))
    if not longer:
        return True
    limit = int((1 - similarity) * longer + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    # An edit moves the counts of two words by one at most, and those of four pairs of words.
    if np.abs(np.bincount(a & (BINS - 1), minlength=BINS) - np.bincount(b & (BINS - 1), minlength=BINS)).sum() > 2 * limit:
        return False
    x, y = ((v[1:] * 31 + v[:-1]) & (4 * BINS - 1) for v in (a, b))
    if np.abs(np.bincount(x, minlength=4 * BINS) - np.bincount(y, minlength=4 * BINS)).sum() > 4 * limit:
        return False
    return edit_distance_within(a, b, limit) <= limit


# --- the join ----------------------------------------------------------------------------------------------------


def _numbers(words: bytes) -> np.ndarray:
    return np.frombuffer(words, np.uint32).astype(np.int64)


def verify(pairs: DataFrame, words: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of representatives whose texts, given as (rep, words), are similar.  Hubs are on the side ``a``; the
    words of the side ``b`` come last, so that the pairs of one hub are spread over tasks when they are aligned."""
    both = pairs.join(words.select(F.col("rep").alias("a"), F.col("words").alias("wa")), "a").join(
        words.select(F.col("rep").alias("b"), F.col("words").alias("wb")), "b"
    )

    def check(batches):
        for b in batches:
            ok = [similar(_numbers(x), _numbers(y), similarity) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], ["a", "b"])

    return both.select("a", "b", "wa", "wb").mapInArrow(check, "a long, b long")


def _join_components(work: Workspace, labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after further edges: those of the edges between roots, and the old labels by them."""
    la, lb = labels.select(F.col("node").alias("a"), F.col("root").alias("ra")), labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    between = edges.join(la, "a", "left").join(lb, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct()
    upper = connected_components(work, between).select(F.col("node").alias("root"), F.col("root").alias("above"))
    moved = labels.join(upper, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    fresh = upper.join(labels.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("above").alias("root"))
    return work.write(moved.unionByName(fresh))


def _with_roots(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.select("bucket", "k", "rep", "n_words").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def _mixed(member: DataFrame) -> DataFrame:
    """The members of buckets that are of several components."""
    span = member.groupBy("bucket").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where(F.col("r1") < F.col("r2"))
    return member.join(span.select("bucket"), "bucket", "left_semi")


def _part(block: int):
    """Which part of its bucket a member is in: parts have about ``block`` members, so a hot bucket is many keys."""
    return F.pmod(F.xxhash64("rep"), F.ceil(F.col("k") / block)).cast("int")


def _with_hubs(member: DataFrame, turn: int, block: int) -> DataFrame:
    """Members that are not in the component of their bucket's hub, with it: (rep, n_words, a, na)."""
    hub = F.min(F.struct(F.xxhash64("bucket", "rep", F.lit(turn)).alias("o"), "rep", "n_words", "root")).alias("hub")
    hubs = member.groupBy("bucket").agg(hub, F.max("k").alias("k"), F.min("root").alias("r1"), F.max("root").alias("r2")).where(F.col("r1") < F.col("r2"))
    parts = F.explode(F.sequence(F.lit(0), F.ceil(F.col("k") / block).cast("int") - 1)).alias("part")
    hubs = hubs.select("bucket", parts, F.col("hub.rep").alias("a"), F.col("hub.n_words").alias("na"), F.col("hub.root").alias("ra"))
    return member.withColumn("part", _part(block)).join(hubs, ["bucket", "part"]).where(F.col("root") != F.col("ra")).select("rep", "n_words", "a", "na")


def _all_pairs(member: DataFrame) -> DataFrame:
    """Pairs of members of different components, of buckets of bounded size: (rep, n_words, a, na)."""
    other = member.select("bucket", F.col("rep").alias("a"), F.col("n_words").alias("na"), F.col("root").alias("ra"))
    return member.join(other, "bucket").where((F.col("a") < F.col("rep")) & (F.col("root") != F.col("ra"))).select("rep", "n_words", "a", "na")


def bag(words: np.ndarray) -> np.ndarray:
    """Numbers of words by hash, up to 255 each: an edit moves two of them by one at most."""
    return np.minimum(np.bincount(words & (BINS - 1), minlength=BINS), 255).astype(np.uint8)


def _earlier(bucket: int, buckets: list[list[int]]) -> np.ndarray:
    """(row, bucket): which of the buckets before this one each row is in, of those that several rows are in."""
    owner = np.repeat(np.arange(len(buckets)), [len(x) for x in buckets])
    flat = np.array([y for x in buckets for y in x], np.int64)
    owner, flat = owner[flat < bucket], flat[flat < bucket]
    names, of, n = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1
    ok = n[of] > 1
    out = np.zeros((len(buckets), int((n > 1).sum())), bool)
    out[owner[ok], place[of[ok]]] = True
    return out


def close_pairs(root: np.ndarray, outside: np.ndarray, size: np.ndarray, bags: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row marked ``outside`` and another one of another component that lengths and bags do not exclude.  Pairs
    that are in an earlier bucket together are left to that one."""
    fine = bags.astype(np.int16)
    coarse = fine.reshape(len(fine), BINS // COARSE, COARSE).sum(1)
    order = np.argsort(size, kind="stable")
    sizes, left, right = size[order], [], []
    for i in np.flatnonzero(outside).tolist():
        near = order[np.searchsorted(sizes, SIMILARITY * size[i] - 1e-6) : np.searchsorted(sizes, size[i] / SIMILARITY + 1e-6, "right")]
        near = near[(root[near] != root[i]) & (~outside[near] | (near > i))]
        limit = 2 * np.floor((1 - SIMILARITY) * np.maximum(size[near], size[i]) + 1e-9)
        for kind in (coarse, fine):
            ok = np.abs(kind[near] - kind[i]).sum(1) <= limit
            near, limit = near[ok], limit[ok]
        if len(near):
            near = near[~earlier[near][:, earlier[i]].any(1)]
            left.append(np.full(len(near), i))
            right.append(near)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.int64), np.empty(0, np.int64))


def _block_pairs(work: Workspace, member: DataFrame, words: DataFrame, block: int) -> DataFrame:
    """As ``_all_pairs``, of buckets of any size, without the pairs that lengths or bags exclude."""

    def with_bag(batches):
        for b in batches:
            bags = [bag(_numbers(x)).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bags, pa.binary()), b.column(2)], ["rep", "bag", "buckets"])

    def compare(group: pa.Table) -> pa.Table:
        rep, root, size, outside = (group.column(c).to_numpy() for c in ("rep", "root", "n_words", "outside"))
        rows = np.argsort(~outside, kind="stable")
        rows = rows[np.unique(rep[rows], return_index=True)[1]]  # a member may be there as row and as column
        rep, root, size, outside = rep[rows], root[rows], size[rows], outside[rows]
        i = j = np.empty(0, np.int64)
        if outside.any():
            group = group.select(["bucket", "bag", "buckets"]).take(pa.array(rows))
            bags = np.frombuffer(b"".join(group.column("bag").to_pylist()), np.uint8).reshape(len(rep), BINS)
            i, j = close_pairs(root, outside, size, bags, _earlier(group.column("bucket")[0].as_py(), group.column("buckets").to_pylist()))
        return pa.table({"rep": rep[i], "n_words": size[i], "a": rep[j], "na": size[j]})

    counts = member.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("x"), F.sum("n").alias("k"), F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    shape = largest.select("bucket", F.col("x.root").alias("main"), F.ceil(F.col("k") / block).cast("int").alias("m"), F.ceil((F.col("k") - F.col("x.n")) / block).cast("int").alias("s"))
    dealt = work.write(member.drop("k").join(shape, "bucket").withColumn("outside", F.col("root") != F.col("main")))
    part = F.pmod(F.xxhash64("rep"), F.col("m")).cast("int")
    row = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("s")).cast("int")
    # Every member is the column of all rows of blocks; those outside are the row of all columns too.
    as_column = dealt.select("bucket", "rep", "n_words", "root", F.lit(False).alias("outside"), F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("i"), part.alias("j"))
    as_row = dealt.where("outside").select("bucket", "rep", "n_words", "root", "outside", row.alias("i"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
    # Texts that share several such buckets meet in the first of them.
    among = dealt.groupBy("rep").agg(F.collect_set("bucket").alias("buckets"))
    bags = work.write(words.join(among, "rep").select("rep", "words", "buckets").mapInArrow(with_bag, "rep long, bag binary, buckets array<long>"))
    met = as_column.unionByName(as_row).join(bags, "rep")
    return met.groupBy("bucket", "i", "j").applyInArrow(compare, "rep long, n_words long, a long, na long")


def _canonical(pairs: DataFrame) -> DataFrame:
    """(a, b) of texts whose lengths may be similar; the one of least hash is first, as hubs are."""
    pairs = pairs.where(F.least("n_words", "na") >= SIMILARITY * F.greatest("n_words", "na") - 1e-9)
    first = F.xxhash64("a") < F.xxhash64("rep")
    return pairs.select(F.when(first, F.col("a")).otherwise(F.col("rep")).alias("a"), F.when(first, F.col("rep")).otherwise(F.col("a")).alias("b")).distinct()


def _classes(work: Workspace, docs: DataFrame, small: int, block: int) -> DataFrame:
    text = F.col("text").cast("string")
    columns = [F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key")]
    sketched = work.write(arrow_map(docs.where(F.col("text").isNotNull()), columns, _sketch, SKETCHED))
    equal = work.write(sketched.groupBy("c1", "c2").agg(F.min("row").alias("rep")))
    own = sketched.join(equal.select(F.col("rep").alias("row")), "row", "left_semi").select(F.col("row").alias("rep"), "n_words", "sketch", "words")
    bands = own.select("rep", "n_words", F.explode(F.array_distinct("sketch")).alias("bucket"))
    # Buckets of two or more, once for all steps.  At first hubs are the same in all buckets, so that the members of a
    # group meet few of them; later each bucket has its own.
    hub = F.min(F.struct(F.xxhash64("rep").alias("o"), "rep", "n_words")).alias("hub")
    several = bands.groupBy("bucket").agg(hub, F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).select("bucket", "k", F.col("hub.rep").alias("a"), F.col("hub.n_words").alias("na"))
    shared = work.write(bands.join(several, "bucket"))
    words = work.write(own.select("rep", "words").join(shared.select("rep").distinct(), "rep", "left_semi"))
    found = labels = tried = None
    for step in range(2 + HUBS):
        large = shared.where(F.col("k") > small)
        if step == 0:
            pairs = shared.where(F.col("rep") != F.col("a")).select("rep", "n_words", "a", "na")
        elif step <= HUBS:
            pairs = _with_hubs(_with_roots(large, labels), step, block)
            if step == 1:
                pairs = pairs.unionByName(_all_pairs(_mixed(_with_roots(shared.where(F.col("k").between(3, small)), labels))))
        else:
            pairs = _block_pairs(work, _with_roots(large, labels), words, block)  # leaves out buckets of one component itself
        pairs = _canonical(pairs)
        pairs = work.write(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty() and step == 0:
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
        good = work.write(verify(pairs, words))
        found = good if found is None else found.unionByName(good)
        if labels is None:
            labels = connected_components(work, good)
        elif not good.isEmpty():
            labels = _join_components(work, labels, good)
    members = sketched.select("row", "doc_id", "text_key", "c1", "c2").join(equal, ["c1", "c2"])
    if found is None:
        rooted = members.withColumns({"root": F.col("rep"), "n_links": F.lit(0).cast("long")})
    else:
        links = found.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
        rooted = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        rooted = rooted.join(links, "rep", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    classes = rooted.groupBy("root").agg(first, F.count(F.lit(1)).alias("class_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return rooted.join(classes, "root").select("doc_id", "text_key", F.col("first.doc_id").alias("class_id"), "class_size", "n_links", kept.alias("keep"))


def near_duplicates(docs: DataFrame, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, class_id, class_size, n_links (verified links of its representative), keep, text_key."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    one = F.lit(1).cast("long")
    nulls = docs.where(F.col("text").isNull()).select(
        doc_id, F.lit(None).cast("long").alias("text_key"), doc_id.alias("class_id"), one.alias("class_size"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("keep")
    )
    with Workspace(docs.sparkSession) as work:
        return work.keep(_classes(work, docs, small, block)).unionByName(nulls)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that duplicate a kept one, all columns kept: see ``keep`` above.  Each row is
    judged by its own text, whatever other rows have its id."""
    verdict = near_duplicates(docs)
    gone = verdict.where(~F.col("keep")).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
    return docs.join(gone, same, "left_anti")
