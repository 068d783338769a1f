"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels.

A sentence's probability is a logistic function of its words and their four- and five-byte beginnings (so that inflected
forms share evidence).  A document is toxic if any sentence is: p = 1 - prod(1 - p_sentence).  Only document labels are
needed to learn; the sentences that make a document toxic come out of it.

Learning uses at most ``MAX_PER_CLASS`` labelled documents of each class, those of least id hash, with their whole texts;
that sample is gathered on the driver, and its size does not grow with the data.  Scoring is one pass over the documents
without a shuffle.  Labels, language, source and id are never inputs of a score.

Defined results: a null, empty or wordless text has no sentences and scores 0; without labelled documents of both
classes every score is 0; contradictory labels of one id count as toxic; rows that repeat a document each get a row; very
long texts are scored whole; an empty table has no rows; other columns, whatever their names, are not read, and kept by
``drop_toxic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, arrow_map, crc_mod, mix

MAX_PER_CLASS = 2500
MIN_DOCUMENTS = 4  # toxic documents of the sample that must have a feature
THRESHOLD = 0.7
PREFIXES = (4, 5)
MIN_ODDS = 3.0  # how much more frequent it must be in toxic ones
STEPS, RATE, SHRINK = 300, 0.5, 3e-4
START_BIAS = -7.0
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


@dataclass
class Model:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float


def word_features(w: Words, h: np.ndarray) -> list[np.ndarray]:
    """Hashes of words and of their beginnings, each an array over the block's words."""
    out = [mix(h, 1)]
    first = w.start
    for k in PREFIXES:
        code = np.zeros(len(first), np.uint64)
        size = w.end - first
        for i in range(k):
            inside = np.minimum(first + i, max(0, len(w.mapped) - 1))
            byte = np.where(i < size, w.mapped[inside], 0).astype(np.uint64)
            code = code * np.uint64(257) + byte
        out.append(mix(code, 10 + k))
    return out


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(sentence number of each word, first word of each sentence), numbers running over the block."""
    if not len(w.start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.cumsum(_END[w.data])
    mark = ends[w.start]
    owner = w.doc_of_word()
    new = np.append(True, (mark[1:] != mark[:-1]) | (owner[1:] != owner[:-1]))
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _features_of(texts: pa.Array):
    w = Words(texts)
    h = w.hashes()
    number, first = sentences(w)
    keys = word_features(w, h)
    return w, np.concatenate(keys), np.tile(number, len(keys)), first


def learn(texts: list[str], labels: np.ndarray) -> Model:
    """Fit by full-batch Adagrad on the noisy-or likelihood, with soft thresholding of the weights."""
    labels = np.asarray(labels)
    if not len(texts) or labels.min() == labels.max():
        return Model(np.empty(0, np.uint64), np.empty(0), -np.inf)
    y = labels.astype(float)
    positive, negative = y.sum(), (1 - y).sum()

    def parts(size: int = 64):
        """(first text, features, sentence of each, text of each sentence) of a few texts at a time, to keep memory low."""
        for i in range(0, len(texts), size):
            w, k, s, first = _features_of(pa.array(texts[i : i + size], pa.string()))
            yield i, k, s, w.doc_of_word()[first] + i

    def once_a_text(k, s, d):
        """Features of each text, each once, with the texts."""
        order = np.lexsort((d[s], k))
        k, t = k[order], d[s][order]
        new = np.append(True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])) if len(k) else np.empty(0, bool)
        return k[new], t[new]

    # Screening: features of enough toxic texts, then those much more frequent in toxic texts than in others.
    found = []
    for _, k, s, d in parts():
        k, t = once_a_text(k, s, d)
        found.append(k[y[t] > 0])
    names, in_positive = np.unique(np.concatenate(found), return_counts=True)
    del found
    names, in_positive = names[in_positive >= MIN_DOCUMENTS], in_positive[in_positive >= MIN_DOCUMENTS]

    def places(k):
        """(which of ``k`` are names, their places)."""
        if not len(names):
            return np.zeros(len(k), bool), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(names, k), len(names) - 1)
        hit = names[at] == k
        return hit, at[hit]

    in_negative = np.zeros(len(names))
    for _, k, s, d in parts():
        k, t = once_a_text(k, s, d)
        in_negative += np.bincount(places(k[y[t] == 0])[1], minlength=len(names))
    odds = ((in_positive + 0.5) / (positive + 1)) / ((in_negative + 0.5) / (negative + 1))
    names = names[odds >= MIN_ODDS]
    feature, sentence, doc, n = [], [], [], 0
    for _, k, s, d in parts():
        hit, at = places(k)
        feature.append(at)
        sentence.append(s[hit] + n)
        doc.append(d)
        n += len(d)
    feature, sentence, doc = np.concatenate(feature), np.concatenate(sentence), np.concatenate(doc)
    both = np.unique(feature.astype(np.int64) * n + sentence)  # a feature counts once a sentence
    feature, sentence = both // n, both % n
    # Sentences without a feature all have the bias as their logit; they are only counted.
    held, sentence = np.unique(sentence, return_inverse=True)
    owner, m = doc[held], len(held)
    bare = np.bincount(doc, minlength=len(texts)) - np.bincount(owner, minlength=len(texts))
    weight, bias = np.zeros(len(names)), START_BIAS
    g2, b2 = np.full(len(names), 1e-4), 1e-4
    for _ in range(STEPS):
        z = bias + np.bincount(sentence, weight[feature], minlength=m)
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(owner, np.logaddexp(0, z), minlength=len(texts)) + bare * np.logaddexp(0, bias)
        away = np.exp(-total)
        slope = np.where(y > 0, -away / np.maximum(1e-9, 1 - away), 1.0)
        grad = p * slope[owner]
        gw = np.bincount(feature, grad[sentence], minlength=len(names)) / positive
        gb = (grad.sum() + (slope * bare).sum() / (1 + np.exp(-bias))) / positive
        g2 += gw * gw
        b2 += gb * gb
        step = RATE / np.sqrt(g2)
        weight = weight - step * gw
        weight = np.sign(weight) * np.maximum(0, np.abs(weight) - step * SHRINK)
        bias -= 0.3 * gb / np.sqrt(b2)
    some = weight != 0
    return Model(names[some], weight[some], float(bias))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> tuple[list[str], np.ndarray]:
    """Texts and labels of the learning sample; never rows whose id's crc32 is 1 modulo 3."""
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("y"))
        .where(crc_mod(F.col("id"), 3) != 1)
    )
    chosen = [marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * per_class rows
    d = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = d.join(ids, "id").dropDuplicates(["id"]).select("id", "text", "y").collect()  # bounded by the sample
    rows.sort(key=lambda r: r["id"])
    return [r["text"] for r in rows], np.array([r["y"] for r in rows], np.int64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, n_sentences, worst_sentence (its number, the first is 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the learning sample

    def each(batch: pa.RecordBatch, _row: int, _part: int):
        n = batch.num_rows
        w, keys, number, first = _features_of(batch.column(1))
        z = _once(shared.value, keys, number, len(first))
        doc = w.doc_of_word()[first] if len(first) else np.empty(0, np.int64)
        p = -np.expm1(-np.bincount(doc, np.logaddexp(0, z), minlength=n))
        count = np.bincount(doc, minlength=n)
        worst = np.full(n, -1)
        if len(first):
            begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            top = np.maximum.reduceat(z, begin)
            is_top = np.flatnonzero(z == np.repeat(top, np.diff(np.append(begin, len(doc)))))
            _, at = np.unique(doc[is_top], return_index=True)
            worst[doc[begin]] = is_top[at] - begin
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(count.astype(np.int64)), pa.array(worst.astype(np.int64))],
            ["doc_id", "held_out", "score", "predicted", "n_sentences", "worst_sentence"],
        )

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out")]
    return arrow_map(docs, cols, each, "doc_id long, held_out boolean, score double, predicted int, n_sentences long, worst_sentence long")


def _once(model: Model, keys: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    """Logits where a feature counts once a sentence, as in learning."""
    z = np.full(n, model.bias)
    if len(model.keys) and len(keys):
        at = np.minimum(np.searchsorted(model.keys, keys), len(model.keys) - 1)
        hit = model.keys[at] == keys
        pair = np.unique(at[hit].astype(np.int64) * n + sentence[hit])
        z += np.bincount(pair % n, model.weights[pair // n], minlength=n)
    return z


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(*sample(docs, labels)))


def offending_sentences(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, begin, end, probability, text) of the sentences that are toxic by themselves; begin and end
    are byte positions."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batch: pa.RecordBatch, _row: int, _part: int):
        w, keys, number, first = _features_of(batch.column(1))
        if not len(first):
            return None
        p = 1 / (1 + np.exp(-_once(shared.value, keys, number, len(first))))
        doc = w.doc_of_word()[first]
        nth = np.arange(len(first)) - np.searchsorted(doc, doc)
        last = np.append(first[1:], len(w.start)) - 1
        ids, out = batch.column(0).to_pylist(), []
        for i in np.flatnonzero(p >= at_least).tolist():
            a, b, base = int(w.start[first[i]]), int(w.end[last[i]]), int(w.offsets[doc[i]])
            out.append((ids[doc[i]], int(nth[i]), a - base, b - base, float(p[i]), w.data[a:b].tobytes().decode("utf-8", "replace")))
        if out:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "sentence", "begin", "end", "probability", "text"])

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return arrow_map(docs, cols, each, "doc_id long, sentence long, begin long, end long, probability double, text string")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept, in one pass without a shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(learn(*sample(docs, labels)))
    names = docs.columns
    text_at = names.index("text")

    def run(batches):
        from tidemark.llm.common import blocks

        for batch in batches:
            for b in blocks(batch):
                w, keys, number, first = _features_of(b.column(text_at))
                z = _once(model.value, keys, number, len(first))
                doc = w.doc_of_word()[first] if len(first) else np.empty(0, np.int64)
                p = -np.expm1(-np.bincount(doc, np.logaddexp(0, z), minlength=b.num_rows))
                yield b.filter(pa.array(p < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
