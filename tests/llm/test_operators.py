"""Operators on odd rows, on empty tables and with extra columns, and against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import bpe, decontamination, language_model, near_duplicates, quality, sharding, substring_dedup, token_counts, tool_calls, toxicity
from tidemark.llm.common import Words, Workspace, connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, words string, bucket int, g string, n int"
RNG = random.Random(4)
VOCAB = ["".join(RNG.choice("abcdeéo") for _ in range(RNG.randrange(2, 7))) for _ in range(600)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), 1, "w", 2, "g", 3) for i, t, lang, src in rows], SCHEMA)


BASE = prose(120)
PASSAGE = prose(70)
ITEM = prose(14)
ODD = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE + " " + prose(3), None, "a"), (4, None, "en", None), (5, "", "en", "a"),
    (6, " \n\t ", "en", "a"), (7, "one", "en", "a"), (8, "One!", "de", "b"), (None, BASE, "en", "a"), (None, None, None, None), (9, prose(2500), "en", "a"),
    (10, prose(30) + " " + PASSAGE + " " + prose(30), "en", "a"), (11, prose(40) + "\n" + PASSAGE + "\n" + prose(25), "en", "a"),
    (12, prose(40) + " " + re.sub("[a-z]", lambda m: m[0].upper(), ITEM) + ". " + prose(20), "en", "a"), (13, "a\na\na\n" + "x y z " * 40, "en", "a"), (14, "", "en", "a"), (15, "日本 é <|endoftext|> 'll  x\n\n", "en", "a"),
    (16, "#$%&| " * 60, "en", "a"),
]
BENCH = [(1, ITEM), (2, None), (3, ""), (4, "one"), (5, prose(12)), (None, ITEM), (6, ITEM)]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def test_words_match_a_regular_expression():
    texts = [t for _, t, _, _ in ODD] + ["", "ABC-def_9é", "x" * 9000]
    w = Words(pa.array(texts))
    assert [w.text(w.first[i], w.first[i + 1]).split() for i in range(len(texts))] == [words_of(t) for t in texts]
    h = w.hashes()
    names = [x for t in texts for x in words_of(t)]
    assert len(set(zip(names, h.tolist(), strict=True))) == len(set(names)) == len(set(h.tolist()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (5, 5)]
    with Workspace(spark) as work:
        got = {r["node"]: r["root"] for r in connected_components(work, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


def test_components_of_a_long_path_in_random_order(spark):
    ids = list(range(3000))
    random.Random(1).shuffle(ids)
    with Workspace(spark) as work:
        got = connected_components(work, spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long"))
        assert got.count() == 3000 and got.where("root <> 0").count() == 0


# --- quality -----------------------------------------------------------------------------------------------------


def brute_statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    tri, hit = collections.Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if tri[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_statistics_and_outliers(spark, odd, empty):
    rows = {}
    for r in quality.quality(odd).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, rows.values())) == len(ODD)
    for i, t, _, _ in ODD:
        if i is not None:
            r = rows[i][0]
            got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert got == brute_statistics(t)
            assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
    assert quality.quality(empty).count() == 0
    many = [(i, prose(100), "en", "a") for i in range(300)] + [(1000 + i, "#&%| ".join(prose(90).split()), "en", "a") for i in range(20)]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs_of(spark, many)).collect()}
    assert not any(kept[1000 + i] for i in range(20)) and sum(kept[i] for i in range(300)) >= 295
    small = quality.quality(docs_of(spark, many[:30]), min_group=100).where("kept").count()
    assert small == 30


def brute_mcd(rows, floor):
    """Concentration from the two starts, with the operator's bins, in numpy."""
    x = np.array(rows, float)
    starts = []
    q1, q2, q3 = (np.array([sorted(c)[math.ceil(q * len(c)) - 1] for c in x.T]) for q in (0.25, 0.5, 0.75))
    starts.append((q2, np.diag(((q3 - q1) / 1.349) ** 2 + floor**2)))
    starts.append((x.mean(0), np.cov(x.T, bias=True) + np.diag(floor**2)))
    best = None
    for m, c in starts:
        for _ in range(quality.MAX_STEPS):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            bins = np.floor(16 * np.log2(d + 0.001))
            order = np.sort(bins)
            y = x[bins <= order[math.ceil(len(x) * quality.SUBSET) - 1]]
            new = y.mean(0), np.cov(y.T, bias=True) * quality.CONSISTENCY + np.diag(floor**2)
            done = abs(np.linalg.slogdet(new[1])[1] - np.linalg.slogdet(c)[1]) < 2e-9
            m, c = new
            if done:
                break
        det = np.linalg.slogdet(c)[1]
        if best is None or det < best[0]:
            best = det, np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    return best[1]


def test_quality_verdict_equals_numpy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stats = [r for r in quality.features(quality.statistics(docs)).collect() if r["n_words"] >= 50 and 100 * r["n_repeat_words"] <= 50 * r["n_words"]]
    got, groups = {r["doc_id"]: r for r in quality.quality(docs, min_group=30).where("not base_failed").collect()}, collections.defaultdict(list)
    for r in stats:
        groups[r["lang"], r["source"]].append(r)
    n = 0
    for rows in groups.values():
        if len(rows) >= 30:
            want = brute_mcd([[r[f] for f in quality.FEATURES] for r in rows], np.array(quality.FLOOR, float))
            for r, d in zip(rows, want, strict=True):
                assert abs(got[r["doc_id"]]["d2"] - d) < 1e-2 + 1e-3 * d and got[r["doc_id"]]["kept"] == (got[r["doc_id"]]["d2"] <= quality.CUTOFF)
                n += 1
    assert n > 200


# --- sharding ----------------------------------------------------------------------------------------------------


def test_sharding(odd, empty):
    got = sharding.place(odd).collect()
    assert len(got) == len(ODD) and {r["doc_id"] for r in got} == {i for i, *_ in ODD}
    table = sharding.fill(sharding.SHARDS)
    for r in got:
        slot = int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])
    counts = collections.Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 64
    fewer = sharding.fill(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer, strict=True)) / len(table)
    assert moved < 0.1
    assert sharding.place(empty).count() == 0
    for bad in ((("a", "a"), 7), ((), 7), (("a",), 8)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


# --- decontamination ---------------------------------------------------------------------------------------------


def brute_decontaminate(docs, bench):
    out = []
    for i, t, *_ in docs:
        w, hit, items = words_of(t), set(), set()
        for item, text in bench:
            x = words_of(text)
            k = min(10, len(x))
            windows = {tuple(x[p : p + k]) for p in range(len(x) - k + 1)} if k else set()
            for p in range(len(w) - k + 1):
                if k and item is not None and tuple(w[p : p + k]) in windows:
                    hit |= set(range(p, p + k))
                    items.add(str(item))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination(spark, odd, empty):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted((tuple(r) for r in decontamination.decontaminate(odd, bench).select(cols).collect()), key=repr)
    assert got == brute_decontaminate(ODD, BENCH) and sum(r[-1] for r in got) >= 3
    assert decontamination.decontaminate(empty, bench).count() == 0
    assert not any(r["contaminated"] for r in decontamination.decontaminate(odd, bench.limit(0)).collect())


# --- language model ----------------------------------------------------------------------------------------------


def test_language_model(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(language_model, "COUNTED", 50)
    monkeypatch.setattr(language_model, "HEAD", 20)
    got = language_model.language_model_scores(odd).collect()
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]) for i, t, *_ in ODD]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c = collections.Counter(x for i, w in tokens if not held(i) for x in w)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for i, w in tokens)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert language_model.language_model_scores(empty).count() == 0


def test_language_model_probabilities_sum_to_one_and_gradients():
    rng = np.random.default_rng(0)
    m = language_model.Gru(np.array([50.0, 30, 20, 10, 5, 5, 3]), 40.0, hidden=6, classes=3)
    m.p = {k: x.astype(np.float64) + rng.normal(0, 0.2, x.shape) for k, x in m.p.items()}
    states = rng.normal(0, 1, (4, 6))
    total = sum(np.exp(m.log_prob(states, np.full(4, w))) for w in range(8))
    assert np.allclose(total, 1)
    ids, targets = rng.integers(0, 8, (5, 3)), rng.integers(0, 8, (5, 3))
    fresh = np.zeros((5, 3), bool)
    fresh[2, 1] = True
    start = rng.normal(0, 1, (3, 6))
    targets[3:, 2] = -1  # past the end of a stream
    _, g, _ = m.train_window(ids, targets, fresh, start)
    rows, values = g["x"]
    g["x"] = np.zeros_like(m.p["x"])
    g["x"][rows] = values
    for name in m.p:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in m.p[name].shape)
            old, d = m.p[name][at], 1e-5
            m.p[name][at] = old + d
            up = m.train_window(ids, targets, fresh, start)[0]
            m.p[name][at] = old - d
            down = m.train_window(ids, targets, fresh, start)[0]
            m.p[name][at] = old
            assert abs((up - down) / (2 * d) - g[name][at]) < 1e-4 * max(1, abs(g[name][at])), name
    texts = [rng.integers(0, 8, n) for n in (1, 5, 200, 30)]
    alone = [m.score([t], 0)[0] for t in texts]
    assert np.allclose(m.score(texts, 0), alone)  # slots and windows do not matter


def test_language_model_beats_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in language_model.language_model_scores(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


# --- tool calls --------------------------------------------------------------------------------------------------


def test_tool_calls(spark):
    calls = [
        (1, "a", 1, "f", '{"y": {"b":1, "a":[2]}, "x": 1}', []), (1, "b", 2, "f", '{"x":"no"}', ["a"]), (1, "c", 3, "g", "{}", ["zz"]), (1, "d", 4, "f", "nonsense", None),
        (2, "p", 1, "f", '{"x":1}', ["q"]), (2, "q", 2, "f", '{"x":1,"w":2}', []), (3, "u", 1, "f", '{"x":1}', ["v"]), (3, "v", 2, "f", '{"x":1}', ["u"]),
        (4, "r", 5, "f", '{"x":1}', []), (4, "r", 2, "f", '{"x":2}', []), (None, "k", 1, "f", '{"x":1}', []), (5, None, 1, "f", None, []),
    ]
    results = [(1, "a", 2, "ok"), (1, "b", 3, None), (2, "p", 9, "p1"), (2, "p", 8, "p0"), (9, "lost", 1, "x"), (None, "k", 1, "n")]
    schemas = [("f", "x", "BIGINT", True), ("f", "y", "OBJECT", False)]
    frames = [spark.createDataFrame(x, s) for x, s in ((calls, tool_calls.CALLS), (results, tool_calls.RESULTS), (schemas, tool_calls.SCHEMAS))]
    got = {}
    for r in tool_calls.link(*frames).collect():
        got.setdefault((r["conv_id"], r["call_id"]), []).append(r)
    one = lambda *k: got[k][0]
    assert one(1, "a")["valid"] and one(1, "a")["canonical"] == '{"arguments":{"x":1,"y":{"a":[2],"b":1}},"id":"a","name":"f","result":"ok"}'
    assert one(1, "b")["errors"] == "wrong type of x" and one(1, "a")["topo"] < one(1, "b")["topo"]
    assert one(1, "c")["errors"] == "unknown tool; unanswered; dangling dependency"
    assert one(1, "d")["errors"] == "arguments are not a JSON object; unanswered"
    assert one(2, "q")["topo"] < one(2, "p")["topo"] and "unknown w" in one(2, "q")["errors"]
    assert "repeated result" in one(2, "p")["errors"] and '"result":"p0"' in one(2, "p")["canonical"]
    assert one(3, "u")["topo"] is None and "cycle" in one(3, "u")["errors"]
    assert one(4, "r")["n_calls"] == 2 and '"x":2' in one(4, "r")["canonical"]
    assert one(9, "lost")["errors"] == "orphan result" and len(got[None, "k"]) == 2
    none = [f.limit(0) for f in frames]
    assert tool_calls.link(*none).count() == 0
    c = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "é\n"), (1, 2, "assistant", "r"), (None, 1, "user", None), (2, 0, None, "x")], "conv_id long, turn long, role string, text string")
    assert tool_calls.link(*tool_calls.from_conversations(c)).count() == 3


# --- BPE and token counts ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def test_bpe_equals_the_library(odd, empty, library):
    want = sorted(
        (str(i), len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest())
        for i, t, *_ in ODD for e in [library.encode(t or "", add_special_tokens=False).ids]
    )
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in bpe.encode_decode_digest(odd).collect()) == want
    assert bpe.encode_decode_digest(empty).count() == 0
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(odd)).collect()}
    assert all(back[i] == (t or "") for i, t, *_ in ODD if i is not None)


def test_bpe_random_texts(library):
    rng, encoder = random.Random(3), bpe.load(bpe.default_vocabulary())
    encoder.cache_words = 40
    letters = "ab'st  \n\t.,é日1½🤖<|endoftext|>_#-\x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(1500)] + ["a" * 300, "<|endoftext|>" * 3, "'s's 'LL''d"]
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        got = encoder.encode_batch(part)
        assert [x.tolist() for x in got] == want
        assert [encoder.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_bpe_of_long_words(library):
    rng, encoder = random.Random(4), bpe.load(bpe.default_vocabulary())
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "éü日a"):
        text = "".join(rng.choice(letters) for _ in range(6000))
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode_batch([text])[0].tolist() == want and encoder.merge_long(text.encode()).tolist() == encoder.merge_rounds([text.encode()])[0].tolist() == want


def test_token_counts(odd, empty, library, monkeypatch):
    monkeypatch.setattr(token_counts, "GROUP", 3)
    work = Workspace(odd.sparkSession)
    blocks, order = token_counts.write_token_blocks(work, odd, block_tokens=64, width=4)
    got = order.join(token_counts.document_lengths(work, token_counts.scan_blocks(blocks, width=4)), ["stream", "ordinal"])
    library.encode_special_tokens = True
    want = sorted((str(i), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ODD)
    library.encode_special_tokens = False
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got.collect()) == want
    assert token_counts.token_counts(empty).count() == 0


def test_token_counts_of_raw_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    want = []
    for k in range(3):
        sizes = rng.integers(0, 40, 30)
        flat = np.concatenate([np.append(rng.integers(0, 9, n), 50256) for n in sizes] + [np.arange(k)])
        flat.astype("<u2").tofile(tmp_path / f"{k}.bin")
        want += sizes.tolist() + ([k] if k else [])
    (tmp_path / "none.bin").write_bytes(b"")
    blocks = token_counts.blocks_of_files(spark, str(tmp_path), block_bytes=22)
    got = token_counts.document_lengths(Workspace(spark), token_counts.scan_blocks(blocks)).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(want) and sum(not r["terminated"] for r in got) == 2


# --- near duplicates ---------------------------------------------------------------------------------------------


def edit(w, rng, share):
    out = []
    for x in w:
        if rng.random() < share:
            out += rng.choice([[], [rng.choice(VOCAB)], [x, rng.choice(VOCAB)]])
        else:
            out.append(x)
    return out


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[j - 1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_alignment():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
        b = edit(a, rng, 0.15)
        b = [x if isinstance(x, int) else rng.randrange(4) for x in b] or [1]
        x, y, d = np.array(a, np.int64), np.array(b, np.int64), distance(a, b)
        limit = rng.randrange(30)
        assert near_duplicates.edit_distance_within(x, y, limit) == min(d, limit + 1)
        assert near_duplicates.similar(x, y) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))
    for n in (90, 300, 700):  # the window moves
        for share in (0.02, 0.15, 0.4):
            a = [rng.randrange(60) for _ in range(n)]
            b = [x if isinstance(x, int) else rng.randrange(60) for x in edit(a, rng, share)]
            x, y, d = np.array(a, np.int64), np.array(b, np.int64), distance(a, b)
            for limit in (d - 1, d, d + 1, 3 * d, n):
                assert near_duplicates.edit_distance_within(x, y, limit) == min(d, limit + 1)
            assert near_duplicates.similar(x, y) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_near_duplicates(spark, odd, empty):
    rng = random.Random(2)
    rows, group = [], {}
    for g in range(8):
        w = prose(150, rng).split()
        for k in range(6):
            i = g * 10 + k
            rows.append((i, " ".join(w if k < 2 else edit(w, rng, 0.04)), "en", "a"))
            group[i] = g * 10
    rows += [(1000 + i, prose(120, rng), "en", "a") for i in range(20)]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == {**group, **{1000 + i: 1000 + i for i in range(20)}}
    rows = near_duplicates.near_duplicates(odd).collect()
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert len(rows) == len(ODD) and got[1] == got[2] == got[3] == 1 and got[4] == 4 and got[5] == got[14] == 5 and got[6] == 6 and got[7] == got[8] == 7
    assert near_duplicates.near_duplicates(empty).count() == 0
    kept = near_duplicates.keep_one(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {None, 1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 15, 16}


def sketches_of(texts):
    n = len(texts)
    made = near_duplicates._sketch(pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts), pa.array(range(n))], ["doc_id", "text", "text_key"]), 0, 0)
    return [set(x) for x in made.to_pydict()["sketch"]]


def roots(n, links):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = sorted((top(i), top(j)))
        root[b] = a
    return [top(i) for i in range(n)]


def similar_words(a, b):
    return near_duplicates.similar(*(np.array([hash(x) for x in w]) for w in (a, b)))


def test_near_duplicates_lose_no_link_of_a_bucket(spark):
    rng = random.Random(12)
    passage = prose(90, rng).split()
    rows = []
    for g in range(18):
        w = passage[:60] + prose(60, rng).split() if g % 2 else passage + prose(25, rng).split()
        rows += [(g * 3 + k, " ".join(edit(w, rng, 0.07 * k)), "en", "a") for k in range(3)]
    sketch, words = sketches_of([r[1] for r in rows]), [r[1].lower().split() for r in rows]
    want = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if sketch[i] & sketch[j] and similar_words(words[i], words[j])])
    docs = docs_of(spark, rows)
    assert len(set(want)) < len(rows)
    for more in ({}, {"small": 4, "block": 7}):  # all pairs of buckets; hubs, then blocks
        got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(docs, **more).collect()}
        assert [got[i] for i in range(len(rows))] == want


@pytest.mark.parametrize("n", [12, 30, 40, 60, 150, 400])
def test_recall_of_sketches_against_all_pairs(n):
    """Pairs that alignment finds to be links, near the bound above all, mostly share a sketch."""
    rng = random.Random(n)
    texts, linked = [], 0
    pairs = []
    while linked < 150:
        w = prose(n, rng).split()
        v = edit(w, rng, rng.choice([0.08, 0.12, 0.15, 0.18]))
        if w != v and v and similar_words(w, v):
            pairs.append((len(texts), len(texts) + 1))
            texts += [" ".join(w), " ".join(v)]
            linked += 1
    sketch = sketches_of(texts)
    assert sum(bool(sketch[i] & sketch[j]) for i, j in pairs) >= 0.9 * len(pairs)


def test_near_duplicates_of_rows_that_repeat_an_id(spark):
    rng = random.Random(77)
    a, b, c = prose(80, rng), prose(90, rng), prose(30, rng)
    rows = [(1, a), (2, b), (2, c), (3, c + " x"), (None, a), (5, b + " y"), (None, c + " zz")]
    docs = docs_of(spark, [(i, t, "en", "a") for i, t in rows])
    got = sorted((str(r["doc_id"]), r["class_id"], r["class_size"], r["keep"]) for r in near_duplicates.near_duplicates(docs).collect())
    assert got == [("1", 1, 2, True), ("2", 2, 2, True), ("2", 2, 3, True), ("3", 2, 3, False), ("5", 2, 2, False), ("None", 1, 2, False), ("None", 2, 3, False)]
    assert sorted(r["text"] for r in near_duplicates.keep_one(docs).collect()) == sorted([a, b, c])


def test_near_duplicates_lose_no_link_of_a_large_bucket(spark):
    # 90 pairs of texts share a passage, and with it large buckets; the other words of a pair differ by scattered edits.
    rng = random.Random(31)
    passage, rows, want = prose(60, rng).split(), [], {}
    for g in range(90):
        rest = prose(30, rng).split()
        for k in range(2):
            words = [rng.choice(VOCAB) if k and i % 4 == 0 else x for i, x in enumerate(rest)]
            rows.append((g * 2 + k, " ".join(passage + words), "en", "a"))
            want[g * 2 + k] = g * 2
    docs = docs_of(spark, rows)
    for more in ({}, {"block": 40}):
        got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(docs, **more).collect()}
        assert got == want


# --- toxicity ----------------------------------------------------------------------------------------------------


def toxic_rows(n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        sentences = [prose(12, rng) for _ in range(rng.randrange(1, 8))]
        y = int(rng.random() < 0.3)
        if y:
            sentences[rng.randrange(len(sentences))] += " zzvile" + rng.choice(["", "ab", "cd"]) + " zzbad"
        rows.append((i, ". ".join(sentences), "en", "a"))
        labels.append((i, y, y))
    return rows, labels


def test_toxicity(spark, odd, empty):
    rows, labels = toxic_rows()
    docs, marked = docs_of(spark, rows), spark.createDataFrame([*labels, (None, 1, 1), (1, None, None), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, marked).collect()}
    right = [got[i]["predicted"] == y for i, _, y in labels if got[i]["held_out"]]
    assert sum(right) / len(right) > 0.97 and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in labels)
    model = toxicity.learn(*toxicity.sample(docs, marked))
    for r in toxicity.offending_sentences(docs, model).collect():
        assert "zz" in r["text"]
    kept = toxicity.drop_toxic(docs, marked)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i in got if not got[i]["predicted"]}
    rows = toxicity.toxicity(odd, marked).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows) and all(r["score"] == 0 for r in rows if r["doc_id"] in (4, 5, 6))
    assert toxicity.toxicity(empty, marked).count() == 0
    assert all(r["score"] == 0 for r in toxicity.toxicity(odd, marked.limit(0)).collect())


# --- substring dedup ---------------------------------------------------------------------------------------------


def test_repeated_passages(spark, odd, empty):
    got = [r for r in substring_dedup.repeated_passages(odd).collect() if r["doc_id"] in (10, 11)]
    assert [(r["doc_id"], r["start_word"], r["n_words"], r["cluster_doc"], r["keep"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [(10, 30, 70, 10, True), (11, 40, 70, 10, False)]
    out = {r["doc_id"]: r for r in substring_dedup.remove_passages(odd).where("doc_id in (10, 11)").collect()}
    assert len(words_of(out[11]["text"])) == 65 and len(words_of(out[10]["text"])) == 130 and out[11]["n_chars"] == len(out[11]["text"])
    changed = substring_dedup.remove_passages(odd)
    assert changed.columns == odd.columns and changed.count() == len(ODD)
    assert substring_dedup.repeated_passages(empty).count() == 0 and substring_dedup.remove_passages(empty).count() == 0


def test_repeated_passages_recall(spark):
    rng = random.Random(8)
    passages = [prose(rng.randrange(51, 120), rng) for _ in range(30)]
    rows, holders = [], set()
    for i in range(240):
        parts = [prose(rng.randrange(20, 90), rng)]
        if i < 120:
            parts += [passages[i % 30], prose(rng.randrange(20, 90), rng)]
            holders.add(i)
        rows.append((i, rng.choice([" ", "\n"]).join(parts), "en", "a"))
    docs = docs_of(spark, rows)
    got = {r["doc_id"] for r in substring_dedup.repeated_passages(docs).collect()}
    assert len(got & holders) >= 0.97 * len(holders) and not got - holders
    left = [words_of(r["text"]) for r in substring_dedup.remove_passages(docs).collect()]
    seen = collections.Counter(x for w in left for x in {tuple(w[i : i + 51]) for i in range(len(w) - 50)})
    assert sum(n > 1 for n in seen.values()) <= 20


def test_repeated_passages_of_frequent_short_lines(spark):
    rng = random.Random(21)
    rows, want = [], set()
    for g in range(60):
        lines = [prose(rng.randrange(22, 36), rng) for _ in range(3)]
        for k, line in enumerate(lines):
            rows.append((g * 3 + k, "\n".join([prose(40, rng), line, prose(40, rng)]), "en", "a"))
        for k in range(2):
            rows.append((1000 + g * 2 + k, "\n".join([prose(40, rng), *lines[: 2 + g % 2], prose(40, rng)]), "en", "a"))
        if sum(len(x.split()) for x in lines[: 2 + g % 2]) > 50:
            want |= {1000 + g * 2, 1001 + g * 2}
    got = {r["doc_id"]: r["keep"] for r in substring_dedup.repeated_passages(docs_of(spark, rows)).collect()}
    assert len(want) > 80 and set(got) == want and all(got[i] == (i % 2 == 0) for i in want)


def test_spans_are_never_cut_out_of_another_text(spark):
    rng = random.Random(5)
    passage = prose(80, rng)
    rows = [(1, prose(30, rng) + " " + passage), (2, passage + " " + prose(20, rng)), (2, "short text"), (2, "short text"), (3, "one two " + passage), (None, passage)]
    got = sorted(r["text"] for r in substring_dedup.remove_passages(docs_of(spark, [(i, t, "en", "a") for i, t in rows])).collect())
    left = rows[1][1][len(passage):].split()
    assert [x.split() for x in got if x.split() == left] == [left] and got.count("short text") == 2 and "one two " in got and rows[0][1] in got and passage in got


# --- the pipeline ------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    rows, labels = toxic_rows(150)
    rows += [(1000 + i, *x[1:]) for i, x in enumerate(ODD)]
    rows.append((2000, PASSAGE + " " + ITEM, "en", "a"))
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == 4 or out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen.append({r["doc_id"]: r for r in docs.collect()})
    bad = {i for i, _, y in labels if y}
    assert len(bad & set(seen[0])) <= 3 and len(seen[0]) >= len(rows) - len(bad) - 2
    assert 1000 in seen[1] and 1001 not in seen[1] and 1003 not in seen[1]
    assert set(seen[2]) == set(seen[1]) and sum(PASSAGE.split()[30] in (r["text"] or "") and PASSAGE in (r["text"] or "").replace("\n", " ") for r in seen[2].values()) == 1
    assert 1014 not in seen[3] and 2000 not in seen[3]
    want = {i: hashlib.sha256((r["text"] or "").encode()).hexdigest() for i, r in seen[3].items()}
    assert {i: r["decoded_sha256"] for i, r in seen[4].items()} == want
    ran = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert ran == {i: r["ids_sha256"] for i, r in seen[4].items()}


def test_queries_with_sql_match(spark):
    import duckdb

    from tidemark.llm.queries import oracle_sql, queries

    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in oracle_sql().items():
        df = queries()[name](spark, sf)
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        assert sorted(cols) == sorted(df.columns), name
        want = sorted(repr([r[cols.index(c)] for c in sorted(cols)]) for r in cur.fetchall())
        assert sorted(repr([r[c] for c in sorted(cols)]) for r in df.collect()) == want, name


def test_language_model_learns_from_every_training_text(spark, monkeypatch):
    """Each training text, in full, is learned from in one of the rounds; repeated ones as often as they are there."""
    rows = [(i, f"word{i % 97} " * (i % 9 + 1) + f"only{i}") for i in range(300)] + [(1000 + i, "the same text") for i in range(20)]
    rows += [(2000, " ".join(f"long{i % 700}" for i in range(3000))), (2001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen, train = [], language_model._train

    def spy(work, texts, model, ids, rate):
        seen.extend(r["text"] for r in texts.collect())
        return train(work, texts, model, ids, rate)

    monkeypatch.setattr(language_model, "_train", spy)
    language_model.language_model_scores(docs).collect()
    assert sorted(seen) == sorted(t for i, t in rows if t is not None and zlib.crc32(str(i).encode()) % 5 != 1)


def test_training_takes_whole_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(language_model, "PIECE", 4)
    trainer = language_model.Trainer(language_model.Gru(np.array([50.0, 30, 20, 10]), 4.0, hidden=4, classes=2), 0.01)
    texts = [np.array([1, 2, 3, 1, 2, 3, 1, 2, 0]), np.array([3, 0])]
    trainer.fit(texts, 0)
    assert trainer.seen == 11
    ids, targets, fresh, _ = language_model.side_by_side([texts[0][:4], texts[0][4:8]], 0, 2, [0, 1])
    assert (ids[0].tolist(), ids[1].tolist(), targets[0].tolist(), fresh.sum()) == ([0, 1], [1, 2], [1, 2], 2)


def test_edited_repeats_neither_of_which_is_the_first_holder(spark):
    """Documents 1 to 6 hold pieces of a passage, too short to be repeats of it, and are the first holders of its keys; the
    passage itself is in two later documents, with a word changed in every 40."""
    rng = random.Random(11)
    words = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]
    passage = words(120)
    edited = [*passage]
    for i in (38, 79):
        edited[i] = "changed"
    rows = [(i + 1, " ".join([*words(30), *passage[a : a + 40], *words(30)])) for i, a in enumerate(range(0, 81, 16))]
    rows += [(20, " ".join([*words(50), *passage, *words(50)])), (30, " ".join([*words(70), *edited, *words(50)]))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["cluster_doc"], r["keep"]) for r in got) == [(20, 20, True), (30, 20, False)]
    assert {r["start_word"] for r in got} == {50, 70} and all(r["n_words"] >= 115 for r in got)


def test_runs_near_the_start_of_a_text_are_all_kept(spark):
    """Two runs that both reach back to the first word are told apart."""
    rng = random.Random(12)
    words = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]
    line, passage = words(16), words(70)
    rows = [(9, " ".join([*line, *words(30), *passage, *words(60)])), (1, " ".join([*words(80), *line, *words(80)])), (10, " ".join([*words(60), *passage]))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start_word"], r["n_words"]) for r in got) == [(9, 46, 70), (10, 60, 70)]


def test_block_pairs_leave_out_buckets_of_one_component(spark):
    """Without a join beforehand that keeps the members of mixed buckets."""
    rows = [(1, 9, i, 50, 100) for i in range(9)] + [(2, 9, i, 50, 100 + (i == 4)) for i in range(9)]
    member = spark.createDataFrame(rows, "bucket long, k long, rep long, n_words long, root long")
    words = spark.createDataFrame([(i, np.arange(50, dtype=np.uint32).tobytes()) for i in range(9)], "rep long, words binary")
    with Workspace(spark) as work:
        got = near_duplicates._block_pairs(work, member, words, 3).collect()
    pairs = {(min(r["rep"], r["a"]), max(r["rep"], r["a"])) for r in got}
    assert pairs == {(min(i, 4), max(i, 4)) for i in range(9) if i != 4}


def test_documents_that_share_a_line_only_are_not_paired(spark, monkeypatch):
    """A line of fewer words than a passage, in many documents, makes no pair of them: nothing around it repeats."""
    rng = random.Random(13)
    words = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]
    line, rows, pairs, across = words(45), [], [], substring_dedup._across
    for i in range(60):
        rows.append((i, " ".join([*words(60), *line, *words(60)])))

    def spy(*args):
        got = across(*args)
        pairs.append(got.count())
        return got

    monkeypatch.setattr(substring_dedup, "_across", spy)
    assert substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    assert sum(pairs) <= 60


def test_training_looks_inputs_up_once_a_window():
    """One lookup of a window's inputs, and results as of one window at a time and word by word."""
    rng = np.random.default_rng(5)
    model = language_model.Gru(np.array([50.0, 30, 20, 10, 5]), 9.0, hidden=6, classes=3)

    class Counted(np.ndarray):
        lookups = 0

        def __getitem__(self, at):
            Counted.lookups += 1
            return np.asarray(super().__getitem__(at))

    ids, fresh = rng.integers(0, 5, (7, 4)), np.zeros((7, 4), bool)
    plain = model.train_window(ids, ids, fresh, np.zeros((4, 6), np.float32))
    model.p["x"] = model.p["x"].view(Counted)
    counted = model.train_window(ids, ids, fresh, np.zeros((4, 6), np.float32))
    assert Counted.lookups == 1 and plain[0] == counted[0] and np.array_equal(plain[2], counted[2])
