"""Complete-document log-likelihood under a gated recurrent language model in numpy.

Words are counted over all training texts.  The ``HEAD`` most frequent ones are the model's vocabulary; their softmax is
factored into classes of like frequency, P(word) = P(class | state) P(word | class, state).  One further class holds all
other words; within it a word has its smoothed share of their training counts, with one place for words never seen.  So
the probabilities of all words, seen or not, sum to one.

Training: the counts and every output bias come from all training texts, and so do the recurrent weights, by truncated
backpropagation (windows of ``WINDOW`` words, state carried across the windows of a piece, no tail left out).  There is a round for each of
``RATES``; a hash of its content tells the round that learns from a text, so that all together are one pass over all training
texts, repeated ones included.  In a round each partition trains a copy of the model over its texts; the copies and the model before (as
``PRIOR`` words) are averaged by their words, summed in groups of ``GROUP`` so that no task holds more than that many, and the
driver one.  Partitions are joined where they would have fewer than ``LEAST_TOKENS`` words.

Scoring: texts of a block run side by side in slots, each slot one text after another, the state carried across windows
and reset at a new text.  Counts of words outside the broadcast dictionary (``COUNTED`` most frequent words) are looked
up by a shuffle join on the word, so no vocabulary is ever gathered; such words are too rare to be skewed.

Defined results: a null text is empty, its one token is the end; rows that repeat a document each get a row; very long texts
are scored whole; without training texts every word is unknown and the model is the base; an empty table has no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import copy
import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, crc_mod, flat_text, list_array

HEAD = 4096
COUNTED = 60_000
CLASSES = 48
HIDDEN = 24
WINDOW = 24
SCORE_WINDOW = 64
RATES = (0.01, 0.004)  # of each round
LEAST_STEPS = 60  # a task with few texts passes over them until it has made so many steps
TRAIN_TOKENS = 400_000  # words that a task holds at a time
LEAST_TOKENS = 250_000  # words of a round that a task has on average, where there are so many
PRIOR = 30_000  # words that the model before a round counts for in the average, so that few texts change little
GROUP = 16
STREAMS = 128
PIECE = 256
SLOTS = 192
FLUSH = 200_000
END = b""  # stands for the end of a text; no word is empty
LOG10 = np.log(10)


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, lower case for A to Z: runs of anything but blank, tab, line feed, vertical tab, form feed and
    carriage return, which are what bytes.split() splits at."""
    return text.lower().split()


def _texts(arr: pa.Array) -> list[bytes]:
    data, off = flat_text(arr)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(crc_mod(F.col("doc_id"), 5) != 1)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows, with the ends under the empty word; tasks send sums of up to FLUSH distinct words."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.column(0).slice(i, 256)
                for t in _texts(part):
                    counts.update(words_of(t))
                counts[END] += len(part)
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


# --- the model ---------------------------------------------------------------------------------------------------


def sigmoid(x):
    y = np.negative(x)
    np.exp(y, out=y)
    y += 1
    return np.divide(1, y, out=y)


class Gru:
    """Gated recurrent unit with class-factored output.  ``word_class`` and ``word_rank`` give the class of each of the
    vocabulary's words and its place there; the last class, of the words outside the vocabulary, has no output layer."""

    def __init__(self, counts: np.ndarray, rare: float, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 5):
        n = len(counts)
        share = np.cumsum(np.sqrt(counts)) / np.sqrt(counts).sum()
        self.word_class = np.minimum((share * classes).astype(np.int64), classes - 1)
        self.word_class = np.unique(self.word_class, return_inverse=True)[1]
        self.classes = int(self.word_class.max()) + 1
        self.rare_class = self.classes
        first = np.searchsorted(self.word_class, np.arange(self.classes + 1))
        self.first = first
        rng = np.random.default_rng(seed)
        h, f = hidden, np.float32
        total = counts.sum() + rare + 1.0
        mass = np.append(np.add.reduceat(counts, first[:-1]), rare + 0.5) / total
        within = np.log(counts / np.repeat(np.add.reduceat(counts, first[:-1]), np.diff(first)))
        self.p = {
            "x": rng.normal(0, 0.3, (n + 1, 3 * h)).astype(f),  # input part of the gates, for each word and for "other"
            "u": rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(f),
            "b": np.zeros(3 * h, f),
            "cw": np.zeros((h, self.classes + 1), f), "cb": np.log(mass).astype(f),
            "ww": np.zeros((h, n), f), "wb": within.astype(f),
        }
        self.h = h
        self.p["b"][:h] = -1.0  # at first states change slowly

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.append(self.word_class, self.rare_class)[ids]

    def step(self, x: np.ndarray, state: np.ndarray):
        """x: input part of the gates.  Gates z (update), r (reset), candidate c."""
        h, u = self.h, self.p["u"]
        zr = sigmoid(x[:, : 2 * h] + state @ u[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        rs = r * state
        c = np.tanh(x[:, 2 * h :] + rs @ u[:, 2 * h :])
        return state + z * (c - state), z, r, rs, c

    def log_prob(self, states: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target id under its state; for words outside, of their class."""
        p, k = self.p, self.class_of(target)
        a = states @ p["cw"]
        a += p["cb"]
        rows = np.arange(len(k))
        out = a[rows, k] - _logsumexp(a)
        # Rows in order of class, so that each class is a slice.
        order = np.argsort(k.astype(np.int16), kind="stable")
        bounds = np.searchsorted(k[order], np.arange(self.classes + 1)).tolist()
        by_class, sorted_target, within = states[order], target[order], np.zeros_like(out)
        for c, (a, b) in enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)):
            lo, hi = bounds[c], bounds[c + 1]
            if hi > lo and b - a > 1:
                y = by_class[lo:hi] @ p["ww"][:, a:b]
                y += p["wb"][a:b]
                within[lo:hi] = y[rows[: hi - lo], sorted_target[lo:hi] - a] - _logsumexp(y)
        out[order] += within
        return out

    def train_window(self, ids: np.ndarray, targets: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """Loss and gradients over one window (time, stream), state carried in and out; gradients stop at its start.  Places
        of target -1 do not count.  The gradient of the input part is (rows, their gradients): most words are not in a window."""
        p, h, steps = self.p, self.h, len(ids)
        trace, states = [], []
        keep, x = ~fresh[:, :, None], p["x"][ids] + p["b"]
        for t in range(steps):
            state = state * keep[t]
            new, z, r, rs, c = self.step(x[t], state)
            trace.append((state, z, r, rs, c))
            states.append(new)
            state = new
        flat, target = np.concatenate(states), targets.reshape(-1)
        used = target >= 0
        k, n = self.class_of(target), len(flat)
        rows_all = np.arange(n)
        g = {name: np.zeros_like(p[name]) for name in ("ww", "wb")}
        e = flat @ p["cw"]
        e += p["cb"]
        e -= e.max(1, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(1, keepdims=True)
        loss = -np.log(e[rows_all, k] + 1e-20)[used].sum()
        e[rows_all, k] -= 1
        e[~used] = 0
        g["cw"], g["cb"] = flat.T @ e, e.sum(0)
        dflat = e @ p["cw"].T
        # Rows in order of class, so that each class is a slice.
        order = np.argsort(k.astype(np.int16), kind="stable")
        bounds = np.searchsorted(k[order], np.arange(self.classes + 1)).tolist()
        by_class, sorted_target, back = flat[order], target[order], np.zeros_like(dflat)
        for c, (i, j) in enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)):
            lo, hi = bounds[c], bounds[c + 1]
            if hi > lo and j - i > 1:
                s, w = by_class[lo:hi], p["ww"][:, i:j]
                y = s @ w
                y += p["wb"][i:j]
                y -= y.max(1, keepdims=True)
                np.exp(y, out=y)
                y /= y.sum(1, keepdims=True)
                at = rows_all[: hi - lo], sorted_target[lo:hi] - i
                loss -= np.log(y[at] + 1e-20).sum()
                y[at] -= 1
                g["ww"][:, i:j], g["wb"][i:j] = s.T @ y, y.sum(0)
                back[lo:hi] = y @ w.T
        dflat[order] += back
        ds = dflat.reshape(steps, -1, h)
        carry = np.zeros_like(state)
        u_zr, u_c = np.ascontiguousarray(p["u"][:, : 2 * h].T), np.ascontiguousarray(p["u"][:, 2 * h :].T)
        d_in = np.empty((steps, len(carry), 3 * h), flat.dtype)
        for t in range(steps - 1, -1, -1):
            before, z, r, rs, c = trace[t]
            d = ds[t] + carry
            dx = d_in[t]
            dc = np.multiply(d * z, 1 - c * c, out=dx[:, 2 * h :])
            drs = dc @ u_c
            np.multiply(d * (c - before), z * (1 - z), out=dx[:, :h])
            np.multiply(drs * before, r * (1 - r), out=dx[:, h : 2 * h])
            carry = (d * (1 - z) + drs * r + dx[:, : 2 * h] @ u_zr) * keep[t]
        inputs = d_in.reshape(-1, 3 * h)
        befores, resets = (np.concatenate([x[i] for x in trace]) for i in (0, 3))
        g["u"] = np.concatenate([befores.T @ inputs[:, : 2 * h], resets.T @ inputs[:, 2 * h :]], 1)
        g["b"] = inputs.sum(0)
        word = ids.reshape(-1)
        order = np.argsort(word.astype(np.int16) if len(p["x"]) < 1 << 15 else word, kind="stable")
        first = np.flatnonzero(np.append(True, word[order][1:] != word[order][:-1]))
        g["x"] = word[order][first], np.add.reduceat(inputs[order], first, axis=0)
        return loss, g, state

    def score(self, texts: list[np.ndarray], end: int) -> np.ndarray:
        """Natural log probability of each text, its words outside the vocabulary counted by their class."""
        ids, targets, fresh, owner = side_by_side(texts, end, SLOTS)
        out = np.zeros(len(texts))
        table = self.p["x"] + self.p["b"]
        state = np.zeros((ids.shape[1], self.h), np.float32)
        live_at = (targets >= 0).sum(1)
        for t in range(0, len(ids), SCORE_WINDOW):
            live = int(live_at[t])
            states, some = [], []
            state = state[:live]
            for i in range(t, min(t + SCORE_WINDOW, len(ids))):
                n = int(live_at[i])
                if not n:
                    break
                state = state[:n]
                if fresh[i, :n].any():
                    state = state * ~fresh[i, :n][:, None]
                state = self.step(table[ids[i, :n]], state)[0]
                states.append(state)
                some.append(n)
            mask = np.concatenate([targets[t + i, :n] for i, n in enumerate(some)])
            who = np.concatenate([owner[t + i, :n] for i, n in enumerate(some)])
            out += np.bincount(who, self.log_prob(np.concatenate(states), mask), minlength=len(texts))
        return out


class Trainer:
    """Adam over windows of texts, side by side in streams; texts are ids with the end at the end."""

    def __init__(self, model: Gru, rate: float):
        self.model, self.rate, self.step, self.seen = model, rate, 0, 0
        self.m, self.v = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))

    def fit(self, texts: list[np.ndarray], end: int, streams: int = STREAMS) -> None:
        """One pass over all words of the texts, in pieces of up to PIECE words so that no long text runs on alone; a later piece
        starts from the word before it."""
        if not texts:
            return
        model = self.model
        pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
        before = [int(t[i - 1]) if i else end for t in texts for i in range(0, len(t), PIECE)]
        ids, targets, fresh, _ = side_by_side(pieces, end, streams, before)
        state = np.zeros((ids.shape[1], model.h), np.float32)
        for t in range(0, len(ids), WINDOW):
            window = slice(t, t + WINDOW)
            live = int((targets[t] >= 0).sum())  # slots are in order of length
            _, g, state = model.train_window(ids[window, :live], targets[window, :live], fresh[window, :live], state[:live])
            n = int((targets[window, :live] >= 0).sum())
            self.seen, self.step = self.seen + n, self.step + 1
            for k, x in model.p.items():
                rows, d = g[k] if k == "x" else (slice(None), g[k])
                d = np.clip(d / n, -0.1, 0.1)
                m, v = self.m[k][rows], self.v[k][rows]
                m += 0.1 * (d - m)
                d *= d
                d -= v
                d *= 0.003
                v += d
                if k == "x":  # the others are views
                    self.m[k][rows], self.v[k][rows] = m, v
                np.multiply(v, 1 / (1 - 0.997**self.step), out=d)
                np.sqrt(d, out=d)
                d += 1e-7
                np.divide(m, d, out=d)
                d *= self.rate / (1 - 0.9**self.step)
                x[rows] -= d


def _logsumexp(a: np.ndarray) -> np.ndarray:
    top = a.max(1)
    e = a - top[:, None]
    return top + np.log(np.exp(e, out=e).sum(1))


def side_by_side(texts: list[np.ndarray], end: int, slots: int, before: list[int] | None = None):
    """(ids, targets, fresh, owner), each (time, slot): texts dealt to slots, the longest first to the emptiest slot;
    slots in order of length, so that those in use are always the first ones.  Unused places have target -1.  A text's
    first word comes after the one in ``before``, else after an end."""
    slots = max(1, min(slots, len(texts)))
    sizes = [len(t) for t in texts]
    heap = [(0, s) for s in range(slots)]
    dealt: list[list[int]] = [[] for _ in range(slots)]
    for i in sorted(range(len(texts)), key=lambda i: -sizes[i]):
        load, s = heapq.heappop(heap)
        dealt[s].append(i)
        heapq.heappush(heap, (load + sizes[i], s))
    dealt.sort(key=lambda x: -sum(sizes[i] for i in x))
    steps = max(sum(sizes[i] for i in x) for x in dealt)
    ids, targets = np.full((steps, slots), end, np.int32), np.full((steps, slots), -1, np.int32)
    fresh, owner = np.zeros((steps, slots), bool), np.zeros((steps, slots), np.int32)
    for s, list_ in enumerate(dealt):
        at = 0
        for i in list_:
            to = at + sizes[i]
            targets[at:to, s] = texts[i]
            ids[at + 1 : to, s] = texts[i][:-1]
            ids[at, s] = before[i] if before else end
            fresh[at, s] = True
            owner[at:to, s] = i
            at = to
    return ids, targets, fresh, owner


# --- fitting and scoring over a table ----------------------------------------------------------------------------


class Scorer:
    """What scoring needs in each task; its size is bounded by HEAD, COUNTED and the model's dimensions."""

    def __init__(self, model: Gru, ids: dict[bytes, int], counts: dict[bytes, int], n: int, v: int, n_rare: int, v_rare: int):
        self.model, self.ids, self.counts = model, ids, counts
        self.n, self.v, self.n_rare, self.v_rare = n, v, n_rare, v_rare
        self.base_total = np.log10(n + 0.5 * (v + 1))
        self.rare_total = np.log10(n_rare + 0.5 * (v_rare + 1))
        self.other = len(ids)


def _train(work: Workspace, texts: DataFrame, model: Gru, ids: dict[bytes, int], rate: float) -> Gru:
    """The average of the models that the partitions train from ``model``, each over its own texts."""
    shared = texts.sparkSession.sparkContext.broadcast((model, ids))

    def run(batches):
        from pyspark import TaskContext

        start, known = shared.value
        trainer, held, n = Trainer(copy.deepcopy(start), rate), [], 0
        for batch in batches:
            for t in _texts(batch.column(0)):
                held.append(_ids(t, known))
                n += len(held[-1])
                if n >= TRAIN_TOKENS:
                    trainer.fit(held, known[END])
                    held, n = [], 0
        trainer.fit(held, known[END])
        while held and trainer.step < LEAST_STEPS:
            trainer.fit(held, known[END])
        if trainer.seen:
            flat = np.concatenate([v.ravel() for v in trainer.model.p.values()]).astype(np.float64) * trainer.seen
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([trainer.seen], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["part", "n", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in group.column("sums"))
        return pa.table({"part": group.column("part")[:1], "n": pa.array([sum(group.column("n").to_pylist())], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, n long, sums binary"
    sums = work.write(texts.select("text").mapInArrow(run, schema))
    while (rows := sums.count()) > 1:
        sums = work.write(sums.groupBy(F.pmod(F.xxhash64("part"), F.lit(rows // GROUP + 1 if rows > GROUP else 1))).applyInArrow(add, schema))
    row = sums.first()
    if row:
        total, n, at = np.frombuffer(row["sums"]), row["n"], 0
        model = copy.deepcopy(model)
        for k, v in model.p.items():
            model.p[k] = ((total[at : at + v.size] + PRIOR * v.ravel()) / (n + PRIOR)).astype(v.dtype).reshape(v.shape)
            at += v.size
    shared.unpersist()
    return model


def fit(work: Workspace, docs: DataFrame) -> tuple[Scorer, DataFrame]:
    """(scorer, counts of the words outside the scorer's dictionary)."""
    training = _training(docs)
    vocab = work.write(count_words(training))
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = vocab.orderBy(F.desc("c"), "word").limit(COUNTED).collect()  # bounded
    rows = [(bytes(r["word"]), r["c"]) for r in top]
    head = rows[:HEAD]
    if not any(w == END for w, _ in head):
        ends = [(w, c) for w, c in rows if w == END] or [(END, 0.5)]
        head = [*head[: HEAD - 1], *ends]
    ids = {w: i for i, (w, _) in enumerate(head)}
    counts = np.array([c for _, c in head], float)
    n_rare, v_rare = n - sum(c for w, c in head if c >= 1), v - sum(1 for w, c in head if c >= 1)
    model = Gru(counts, n_rare)
    text = F.col("text").cast("string").alias("text")
    texts = training.where(F.col("text").isNotNull()).select(text).coalesce(max(1, n // (LEAST_TOKENS * len(RATES))))
    for i, rate in enumerate(RATES):
        model = _train(work, texts.where(F.pmod(F.xxhash64("text"), F.lit(len(RATES))) == i), model, ids, rate)
    known = {w: c for w, c in rows}
    tail = vocab.join(F.broadcast(vocab.sparkSession.createDataFrame([(w,) for w in known], "word binary")), "word", "left_anti") if len(rows) == COUNTED else vocab.limit(0)
    return Scorer(model, ids, known, n, v, n_rare, v_rare), tail


def _ids(text: bytes, ids: dict[bytes, int]) -> np.ndarray:
    other = len(ids)
    return np.array([ids.get(w, other) for w in words_of(text)] + [ids[END]], np.int32)


ROWS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, n_tail long, tail array<struct<word:binary,n:int>>"


def score(work: Workspace, docs: DataFrame, scorer: Scorer, tail: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        from pyspark import TaskContext

        s = shared.value
        part, done = TaskContext.get().partitionId(), 0
        ids, model, other = s.ids, s.model, s.other
        end = ids[END]
        # Each counted word's place, and by place its logs and its id; words not counted have the last place.
        place = {w: i for i, w in enumerate(s.counts)}
        none = len(place)
        logs = np.log10(np.array([*s.counts.values()], float) + 0.5)
        base_log = np.append(logs - s.base_total, 0.0)
        id_of = np.array([*(ids.get(w, other) for w in place), other], np.int32)
        rare_log = np.where(id_of == other, np.append(logs - s.rare_total, 0.0), 0.0)
        end_base, end_known = (base_log[place[END]], 1) if END in place else (np.log10(0.5) - s.base_total, 0)
        from tidemark.llm import common

        for batch in batches:
            for block in _big_blocks(batch):
                texts, n_tokens, n_known, base, rare, words, tfs, sizes = [], [], [], [], [], [], [], []
                for t in _texts(block.column(1)):
                    w = words_of(t)
                    at = np.array([place.get(x, none) for x in w], np.int32)
                    texts.append(np.append(id_of[at], np.int32(end)))
                    missing = np.flatnonzero(at == none).tolist()
                    unknown = Counter([w[i] for i in missing])
                    base.append(float(base_log[at].sum()) + end_base)
                    rare.append(float(rare_log[at].sum()))
                    n_tokens.append(len(w) + 1)
                    n_known.append(len(w) - len(missing) + end_known)
                    words += unknown.keys()
                    tfs += unknown.values()
                    sizes.append(len(unknown))
                score_ = model.score(texts, end) / LOG10 + np.array(rare)
                rows = (np.int64(part) << np.int64(40)) + done + np.arange(block.num_rows)
                done += block.num_rows
                tails = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(tfs, pa.int32())], ["word", "n"])
                tail_n = np.array([sum(tfs[a:b]) for a, b in zip(np.cumsum([0, *sizes[:-1]]), np.cumsum(sizes), strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), block.column(0), block.column(2), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                     pa.array(score_), pa.array(tail_n), common.list_array(tails, np.array(sizes))],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "n_tail", "tail"],
                )

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (crc_mod(F.col("doc_id"), 5) == 1).alias("held_out")]
    rows = work.write(docs.select(*cols).mapInArrow(run, ROWS))
    each = rows.select("row", F.explode("tail").alias("x")).select("row", "x.word", "x.n")
    # Words found among the counts; the others get the place for words never seen.
    met = each.join(tail, "word").select("row", "n", "c")
    sums = met.groupBy("row").agg(F.sum("n").alias("met"), F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("logs"))
    n_unseen = F.col("n_tail") - F.coalesce("met", F.lit(0))
    logs = F.coalesce("logs", F.lit(0.0)) + n_unseen * float(np.log10(0.5))
    return rows.drop("tail").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"), F.lit(scorer.n).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tail") * float(scorer.base_total)).alias("base_score"), (F.col("model") + logs - F.col("n_tail") * float(scorer.rare_total)).alias("score"),
    )


def _big_blocks(batch: pa.RecordBatch, size: int = 3 << 20):
    from tidemark.llm.common import lengths

    n = lengths(batch.column(1))
    cum, at = np.cumsum(n), 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(cum, (cum[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    with Workspace(docs.sparkSession) as work:
        return work.keep(score(work, docs, *fit(work, docs)))
