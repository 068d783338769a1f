"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

Texts are split into pre-tokens by the vocabulary's pattern.  Words not met before in the partition are encoded
together: the symbols of all of them lie in one flat array; each round looks every adjacent pair up by binary search
over the sorted pair keys, finds the least rank within each word (a segmented minimum), and merges all its occurrences
in that word, left to right and without overlap.  A merged symbol can only be part of later-ranked pairs, so merging all
occurrences of the least pair at once gives what merging them one by one gives.  A word of more than ``LONG`` bytes (a blob
without blanks) would need a round for every merge rank in it; its pairs wait in a queue by rank instead, which takes n log n
steps.  The encodings of short words are kept in a bounded cache.

Special tokens that stand in a text are encoded as such, as the tokenizers library does by default;
``special_tokens=False`` treats them as ordinary text.  Decoding looks ids up in one flat byte table.

Defined results: a null text is an empty text; it has no ids and decodes to the empty text; ids outside of the
vocabulary are skipped in decoding; bytes that are not UTF-8 decode to U+FFFD, as in the library; very long texts are encoded
whole; rows that repeat a document each get a row; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

#: Pre-token pattern of byte-level BPE; a fixed value of the vocabulary's format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_WORDS = 150_000
CACHE_WORD_CHARS = 40
LONG = 1000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level BPE files write for bytes: printable ones stand for themselves, the others for the
    letters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


class Bpe:
    """Vocabulary, merge ranks as sorted pair keys, and a word cache."""

    def __init__(self, spec: dict, special_tokens: bool = True, cache_words: int = CACHE_WORDS):
        import regex

        letters = _byte_letters()
        model = spec["model"]
        vocab = model["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        pieces = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.piece_sizes = np.array([len(p) for p in pieces], np.int64)
        self.piece_starts = np.concatenate([[0], np.cumsum(self.piece_sizes)])[:-1]
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_ids = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        keys, merged = [], []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            keys.append((vocab[a] << 32) | vocab[b])
            merged.append(vocab[a + b])
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.pattern = regex.compile(PATTERN)
        self.splitter = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if special_tokens and self.special else None
        self.cache: dict[str, np.ndarray] = {}
        self.pairs: dict[int, tuple[int, int]] | None = None
        self.cache_words = cache_words

    def merge_rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in one array, number of ids of each word)."""
        size = np.array([len(w) for w in words], np.int64)
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        done_ids, done_word = [], []
        top = len(self.keys)
        while len(sym) > 1:
            key = (sym[:-1] << 32) | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), top - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], top)
            rank = np.append(rank, top)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            counts = np.diff(np.append(first, len(sym)))
            least = np.repeat(least, counts)
            active = least < top
            if not active.all():  # words that no pair can merge are finished
                done_ids.append(sym[~active])
                done_word.append(word[~active])
                sym, word, rank, least, at = sym[active], word[active], rank[active], least[active], np.append(at, 0)[active]
                if not len(sym):
                    break
            else:
                at = np.append(at, 0)
            hit = rank == least
            # Of a run of overlapping occurrences (x x x) every second one counts, from the left.
            where = np.flatnonzero(hit)
            new_run = np.append(True, np.diff(where) != 1)
            run_start = np.repeat(np.flatnonzero(new_run), np.diff(np.append(np.flatnonzero(new_run), len(where))))
            where = where[(np.arange(len(where)) - run_start) % 2 == 0]
            sym[where] = self.merged[at[where]]
            keep = np.ones(len(sym), bool)
            keep[where + 1] = False
            sym, word = sym[keep], word[keep]
        done_ids.append(sym)
        done_word.append(word)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: pairs in order of rank, then place, over a linked list of symbols."""
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))
        sym = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n, get = len(sym), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(p[0], i) for i in range(n - 1) if (p := get((sym[i] << 32) | sym[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if sym[i] < 0 or j >= n:
                continue
            pair = get((sym[i] << 32) | sym[j])
            if pair is None or pair[0] != rank:  # one of its symbols was merged before
                continue
            sym[i], sym[j], after[i] = pair[1], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := get((sym[i] << 32) | sym[after[i]])) is not None:
                    heapq.heappush(queue, (p[0], i))
            if before[i] >= 0 and (p := get((sym[before[i]] << 32) | sym[i])) is not None:
                heapq.heappush(queue, (p[0], before[i]))
        out = np.array(sym, np.int64)
        return out[out >= 0]

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens, where they count, are single pre-tokens."""
        if self.splitter is None or not any(s in text for s in self.special):
            return self.pattern.findall(text)
        out, at = [], 0
        for m in self.splitter.finditer(text):
            out += self.pattern.findall(text[at : m.start()])
            out.append("\0special" + m[0])
            at = m.end()
        return out + self.pattern.findall(text[at:])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [self.pretokens(t) for t in texts]
        cache = self.cache
        new = list({w for words in split for w in set(words) if w not in cache})
        local: dict[str, np.ndarray] = {}
        plain = []
        for w in new:
            if not w.startswith("\0special"):
                if len(w) > LONG // 4 and len(b := w.encode()) > LONG:
                    local[w] = self.merge_long(b).astype(np.int32)
                else:
                    plain.append(w)
        if plain:
            ids, counts = self.merge_rounds([w.encode() for w in plain])
            ends = np.cumsum(counts).tolist()
            ids = ids.astype(np.int32)
            begin = 0
            for w, end in zip(plain, ends, strict=True):
                local[w] = ids[begin:end]
                begin = end
        for w in new:
            if w.startswith("\0special"):
                local[w] = np.array([self.special[w[len("\0special") :]]], np.int32)
        table = {w: cache[w] if w in cache else local[w] for words in split for w in set(words)}
        for w, x in local.items():  # the first words met are the common ones
            if len(cache) >= self.cache_words:
                break
            if len(w) <= CACHE_WORD_CHARS:
                cache[w] = x.copy()
        get = table.__getitem__
        return [np.concatenate(list(map(get, words))) if words else np.empty(0, np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.piece_sizes))]
        size = self.piece_sizes[ids]
        total = int(size.sum())
        at = np.repeat(self.piece_starts[ids] - (np.cumsum(size) - size), size) + np.arange(total)
        return self.piece_bytes[at].tobytes().decode("utf-8", "replace")


def load(path: str, special_tokens: bool = True) -> Bpe:
    with open(path, encoding="utf-8") as f:
        return Bpe(json.load(f), special_tokens)


_loaded: dict = {}


def shared_bpe(spec_json: str, special_tokens: bool = True) -> Bpe:
    """One encoder a worker process and vocabulary."""
    key = (hashlib.md5(spec_json.encode()).digest(), special_tokens)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(json.loads(spec_json), special_tokens)
    return _loaded[key]


def vocabulary_broadcast(spark, path: str | None = None):
    """The vocabulary file's text, about 1.6 MB; a vocabulary does not grow with the data."""
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _text_column():
    return F.col("text").cast("string").alias("text")


def encode(docs: DataFrame, path: str | None = None, special_tokens: bool = True) -> DataFrame:
    """(doc_id, ids array<int>) for every row."""
    vocab = vocabulary_broadcast(docs.sparkSession, path)

    def each(batch: pa.RecordBatch, _row: int, _part: int):
        from tidemark.llm.common import list_array

        ids = shared_bpe(vocab.value, special_tokens).encode_batch([t or "" for t in batch.column(1).to_pylist()])
        flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
        return pa.RecordBatch.from_arrays([batch.column(0), list_array(flat, np.array([len(x) for x in ids], np.int64))], ["doc_id", "ids"])

    return arrow_map(docs, [F.col("doc_id").cast("long").alias("doc_id"), _text_column()], each, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    vocab = vocabulary_broadcast(encoded.sparkSession, path)

    def run(batches):
        bpe = shared_bpe(vocab.value)
        for b in batches:
            texts = [bpe.decode(np.asarray(x, np.int64)) if x is not None else "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_decode_digest(docs: DataFrame, path: str | None = None, keep_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids."""
    vocab = vocabulary_broadcast(docs.sparkSession, path)

    def each(batch: pa.RecordBatch, _row: int, _part: int):
        bpe = shared_bpe(vocab.value)
        n, a, b = [], [], []
        for ids in bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()]):
            n.append(len(ids))
            a.append(hashlib.sha256(str(ids.tolist())[1:-1].replace(" ", "").encode()).hexdigest())
            b.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(docs, [F.col("doc_id").cast("long").alias("doc_id"), _text_column()], each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
