"""Training-data operators against brute force, and their defined results for odd inputs."""

import collections
import hashlib
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm import additive_ann, bloom_lm, bpe_tree, chat, fuzzy_lines, langid, packing, rare_digest, simhash_trie, suffix_blocks, suffix_dedup
from panelforge.llm.components import connected_components

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (5, "<|endoftext|> It's 2024! Ünḯ ΣΑΣ"), (6, "x" * 5000), (7, "1 2 3 !!"), (8, "\n\n \n")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "other") for i, t in ODD], "doc_id long, text string, score string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# ---- op1 ----


def test_perspectives(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo"), (1, 2, "bob", "yo"), (2, 0, "system", "x"), (None, 0, "c", "z"), (3, None, None, None)]
    out = chat.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    by = {(r["conv_id"], r["perspective"]): r for r in out}
    assert set(by) == {(1, "ann"), (1, "bob"), (None, "c"), (3, "unknown")}
    r = by[1, "ann"]
    assert r["rendered"] == "<|im_start|>system\nS<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\nyo<|im_end|>\n"
    assert [r["rendered"][s["start"] : s["end"]] for s in r["spans"]] == ["hi<|im_end|>"]
    assert (r["n_turns"], r["n_rows"]) == (3, 4)


def test_perspective_chunks_follow_each_other(spark):
    rows = [(1, t, "ab"[t % 2], f"t{t}") for t in range(10)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r["perspective"]: r["rendered"] for r in chat.rotate_perspectives(df).collect()}
    parts = chat.rotate_perspectives(df, chunk_turns=3).orderBy("chunk").collect()
    for p, text in whole.items():
        own = [r for r in parts if r["perspective"] == p]
        assert "".join(r["rendered"] for r in own) == text
        assert all(text[r["chunk_offset"] :].startswith(r["rendered"]) for r in own)


def test_perspectives_of_nothing_and_without_python(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.rotate_perspectives(df)
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_perspectives_of_a_turn_of_many_rows(spark):
    """The rows of one crowded turn are dealt over parts, whose offsets follow each other."""
    rows = [(1, 7, f"s{i % 3}", f"text {i}") for i in range(9000)] + [(1, 300, "s1", "late")]
    out = chat.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for speaker in ("s0", "s1", "s2"):
        own = sorted((r for r in out if r["perspective"] == speaker), key=lambda r: (r["chunk"], r["part"]))
        assert sum(r["n_turns"] for r in own) == 9001 and len(own) == 4
        at = 0
        for r in own:
            assert r["chunk_offset"] == at
            at += len(r["rendered"])


# ---- op2 ----


def brute_passages(texts, length=400):
    count = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        depth = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                depth[i] += 1
                depth[i + length] -= 1
        gone = np.cumsum(depth)[:-1] > 0
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def passage_texts():
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    shared = [word(n) for n in (380, 420, 455, 900)]
    texts = [None, "", "short", "a" * 1500, ("ab" * 700) + "c", "xyz" * 200]
    for _ in range(60):
        texts.append(word(rng.integers(0, 300)) + shared[rng.integers(0, 4)] + word(rng.integers(0, 300)) + shared[rng.integers(0, 4)] + word(rng.integers(0, 99)))
    texts += texts[10:14]
    return texts


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 3000, "block_bytes": 4000, "block_pieces": 4}])
def test_passages_equal_brute_force(spark, options):
    texts = passage_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r for r in suffix_dedup.dedup_passages(df, **options).collect()}
    want = brute_passages([(t or "").encode() for t in texts])
    assert len(out) == len(texts)
    for i, w in enumerate(want):
        r = out[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == w, i
    assert out[0]["text"] is None and out[2]["text"] == "short"


def test_passages_of_nothing(spark, empty):
    out = suffix_dedup.dedup_passages(empty)
    assert out.count() == 0 and out.columns[: len(empty.columns)] == empty.columns


def test_passages_of_a_hot_group(spark):
    """Near copies of one text, whose anchors are dealt over several blocks."""
    rng = np.random.default_rng(8)
    base = "".join(rng.choice(list("abcdefgh "), 1500))
    texts = []
    for _ in range(120):
        at = sorted(rng.choice(1500, 3, replace=False))
        texts.append(base[: at[0]] + "X" * int(rng.integers(0, 3)) + base[at[0] : at[1]] + str(rng.integers(0, 10**6)) + base[at[1] :])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in suffix_dedup.dedup_passages(df, chunk_bytes=20_000, block_pieces=8).collect()}
    for i, w in enumerate(brute_passages([t.encode() for t in texts])):
        assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"], out[i]["kept_sha256"]) == w, i


def test_block_sort_is_a_suffix_sort():
    rng = np.random.default_rng(1)
    size = 13 * 120
    text = np.zeros(size + 600, dtype=np.uint8)
    text[:size] = np.tile(rng.integers(97, 99, 260).astype(np.uint8), 6)
    starts = np.arange(0, size - 400)
    order = suffix_blocks.sort_block(text, size, starts, np.zeros(len(starts), dtype=np.int64))
    keys = [bytes(text[s : s + 400]) for s in starts[order]]
    assert keys == sorted(keys)
    same = suffix_blocks.equal_runs(text, starts[order], np.zeros(len(starts), dtype=np.int64), 400)
    assert same.tolist() == [False, *(a == b for a, b in zip(keys, keys[1:]))]


# ---- op3 ----


def test_neighbours(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = additive_ann.nearest(frame).toPandas()
    data = frame.toPandas()
    ids, v = data.vec_id.to_numpy(), np.stack(data.embedding).astype(float)
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = (v * v[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        got = out[out.query_id == q].sort_values("rank")
        hits, total = hits + len(set(best) & set(got.vec_id)), total + 20
        assert got["rank"].tolist() == list(range(1, 21))
        assert got.score.is_monotonic_decreasing
    assert hits / total >= 0.9


def test_recall_where_blocks_exceed_what_is_reranked(spark):
    """20,000 vectors in blocks of 4,096, of which 200 are scored exactly."""
    rng = np.random.default_rng(12)
    v = (rng.normal(size=(20_000, 24)) * rng.uniform(0.5, 2.0, (20_000, 1))).astype(np.float32)
    rows = [pa.array(np.arange(20_000)), pa.FixedSizeListArray.from_arrays(pa.array(v.reshape(-1)), 24).cast(pa.list_(pa.float32()))]
    frame = spark.createDataFrame(pa.Table.from_arrays(rows, names=["vec_id", "embedding"]))
    out = additive_ann.nearest(frame, rerank=200, row_chunk=4096, query_every=100).toPandas()
    v = v.astype(float)
    hits = 0
    for q in range(0, 20_000, 100):
        s = v @ v[q]
        s[q] = -np.inf
        hits += len(set(np.argpartition(-s, 20)[:20].tolist()) & set(out.vec_id[out.query_id == q].tolist()))
    assert len(out) == 4000 and hits / 4000 >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, None), (6, [1.0]), (7, [None, 1.0]), (20, [-1.0, 0.0]), (0, [1.0, 0.0]), (None, [1.0, 1.0])]
    out = additive_ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out)
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (20, 1, 0, -1.0), (20, 2, 1, -2.0)]
    assert additive_ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- op4 ----


def test_digests(spark, docs):
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    out = {r["doc_id"]: r for r in rare_digest.digests(docs).collect()}
    assert len(out) == len(rows)
    for i, (doc, text) in enumerate(rows):
        follow = rows[(i + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 4] + follow[: len(text) // 4]
        r = out[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        next_print = out[rows[(i + 1) % len(rows)][0]]["fingerprint"]
        assert r["near_next"] == rare_digest.likeness(rare_digest.parse_digest(r["fingerprint"]), rare_digest.parse_digest(next_print))
    by_text = {}
    for doc, text in rows:
        assert by_text.setdefault(text, out[doc]["fingerprint"]) == out[doc]["fingerprint"]
    assert np.mean([r["near_edited"] for r in out.values()]) > 0.6 > 0.2 > np.mean([r["near_next"] for r in out.values()])


def brute_digests(texts):
    """Digest of each text, and the likeness of two, with dictionaries and sets."""
    worth = [0] + [round(float(c * np.log2(c)) * (1 << 20)) for c in range(1, 65)]

    def steps(data):
        out = []
        for i in range(len(data) - 63):
            total = sum(worth[c] for c in collections.Counter(data[i : i + 64]).values())
            out.append(min(max((worth[64] - total) * 1023 // worth[64], 0), 1023))
        return out

    known = {t: steps(t) for t in set(texts)}
    times = collections.Counter()
    for t in texts:
        times.update(known[t])
    rank = {b: r for r, b in enumerate(sorted(range(1024), key=lambda b: (times[b], b)))}

    def marks(data):
        if not data:
            return []
        if len(data) < 64:
            return [int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")]
        keys = [(rank[b], i) for i, b in enumerate(known.get(data) or steps(data))]
        runs = [keys[i : i + 64] for i in range(max(1, len(keys) - 63))]
        count = collections.Counter(min(run)[1] for run in runs)
        chosen = sorted(i for i, n in count.items() if n >= 16) or [min(count, key=lambda i: (-count[i], i))]
        out = []
        for i in chosen:
            value = 0
            for k in range(8):
                value = (value ^ int.from_bytes(data[i + 8 * k : i + 8 * k + 8], "little")) * 0x9E3779B97F4A7C15 % (1 << 64)
                value ^= value >> 29
            out.append(value)
        return out

    def digest(data):
        values = marks(data)
        chain = [values[i : i + 160] for i in range(0, len(values), 160)]
        return [{h >> 12 * k & 2047 for h in part for k in range(5)} for part in chain], len(chain[-1]) if chain else 0

    def text_of(chain, last):
        return f"{last:03d}:" + "".join(np.packbits([b in bits for b in range(2048)]).tobytes().hex() for bits in chain)

    def like(a, b):
        if a == b:
            return 1.0
        if not a[0] or not b[0]:
            return 0.0
        one = lambda p, q: max(0.0, min(1.0, (len(p & q) - len(p) * len(q) / 2048) / max(min(len(p), len(q)) - len(p) * len(q) / 2048, 1e-9)))
        way = lambda x, y: sum(max(one(p, q) for q in y) for p in x) / len(x)
        x, y = a[0], b[0]
        return min(1.0, (way(x, y) + way(y, x)) / 2) if len(x) == len(y) else way(x, y) if len(x) < len(y) else way(y, x)

    return digest, text_of, like


def test_digests_equal_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    digest, text_of, like = brute_digests([r["text"].encode() for r in rows])
    out = {r["doc_id"]: r for r in rare_digest.digests(docs).collect()}
    for i in range(0, len(rows), 7):
        text, follow = rows[i]["text"], rows[(i + 1) % len(rows)]["text"]
        edited = text[: len(text) - len(text) // 4] + follow[: len(text) // 4]
        own, changed, after = (digest(t.encode()) for t in (text, edited, follow))
        r = out[rows[i]["doc_id"]]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (text_of(*own), text_of(*changed))
        assert (r["near_edited"], r["near_next"]) == (pytest.approx(like(own, changed), abs=1e-6), pytest.approx(like(own, after), abs=1e-6))


def test_digests_of_odd_texts(spark, odd, empty):
    out = rare_digest.digests(odd).collect()
    assert len(out) == len(ODD) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert rare_digest.digests(empty).count() == 0


def test_window_entropy():
    data = np.random.default_rng(0).integers(97, 110, 500).astype(np.uint8)
    for i, step in enumerate(rare_digest.entropy_bins(data)[::50]):
        p = np.bincount(data[50 * i : 50 * i + 64]) / 64
        p = p[p > 0]
        assert abs(-(p * np.log2(p)).sum() / 6 * 1023 - step) <= 1.01


def test_pieces_of_a_chunk_take_little_memory():
    """Arrays are made for a few documents at a time; what is found does not hang on how many."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 4000, dtype=np.uint8).tobytes() for _ in range(500)]
    tracemalloc.start()
    pieces = suffix_dedup.chunk_pieces(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    assert all((a == b).all() for a, b in zip(pieces, suffix_dedup.chunk_pieces(texts, 1 << 30)))


# ---- op5 ----


def test_model_scores(spark, docs):
    out = {r["doc_id"]: r for r in bloom_lm.score_documents(docs, chunk_tokens=20_000).collect()}
    words = {r["doc_id"]: [*r["text"].encode().lower().split(), None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    count = {}
    for i, ws in words.items():
        for w in ws if not held[i] else ():
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, ws in words.items():
        base = sum(np.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in ws)
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"], r["n_known"]) == (held[i], len(ws), n, sum(w in count for w in ws))
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    assert sum(r["score"] for r in out.values() if r["held_out"]) > sum(r["base_score"] for r in out.values() if r["held_out"])


def brute_model(words, held, base, prior):
    """log10 probability of each text by exact dictionaries of levels."""
    level = lambda c: 0 if not c else 1 + int(np.floor(np.log(c) / np.log(base) + 1e-9))
    least = lambda k: 0 if not k else int(np.ceil(base ** (k - 1) - 1e-6))
    most = lambda k: max(int(np.ceil(base**k - 1e-6)) - 1, 0)
    one, two = collections.Counter(), collections.Counter()
    for i, ws in words.items():
        if not held[i]:
            one.update(ws)
            two.update(zip([None, *ws], ws))
    mass = sum(least(level(c)) for c in one.values())
    out = {}
    for i, ws in words.items():
        total = 0.0
        for v, w in zip([None, *ws], ws):
            c, u = most(level(one[v])), most(level(one[w]))
            joint = min(least(level(two[v, w])), c, u)
            total += np.log10((joint + prior * (least(level(one[w])) + 1) / (mass + len(one) + 1)) / (c + prior))
        out[i] = total
    return out


def test_model_equals_exact_counts(spark, docs):
    """Scores against exact counts, with so many bits that the filter has next to no false positive; both ways to probe."""
    words = {r["doc_id"]: [*r["text"].encode().lower().split(), None] for r in docs.collect()}
    want = brute_model(words, {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}, 1.5, 300.0)
    for limit in (1 << 26, 0):
        out = bloom_lm.score_documents(docs, chunk_tokens=20_000, bits_per_key=80, probes=16, broadcast_bytes=limit).collect()
        assert {r["doc_id"]: pytest.approx(r["score"], rel=1e-9) for r in out} == want
    one = {r["doc_id"]: r["score"] for r in bloom_lm.score_documents(docs).collect()}
    assert {r["doc_id"]: r["score"] for r in bloom_lm.score_documents(docs, broadcast_bytes=0).collect()} == pytest.approx(one, rel=1e-12)


def test_model_goes_one_way_at_all_sizes(spark, docs, monkeypatch):
    """Small corpora had their filter broadcast, so that shuffles grew by a step where it became too large for that."""
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("broadcast"))
    assert bloom_lm.score_documents(docs, chunk_tokens=20_000).count() == docs.count()
    # each chunk deals its bigrams once, for the counts and the levels
    batch = pa.RecordBatch.from_pydict({"chunk": [0], "n_tokens": [[3]], "held": [[True]], "words": [np.sort(np.array([5, 9, bloom_lm.END], dtype=np.uint64)).tobytes()], "tokens": [bloom_lm.pack_ids(np.array([0, 1, 2]))]})
    rows = [r for b in bloom_lm._dealt_bigrams(4)([batch]) for r in b.to_pylist()]
    assert sum(len(r["keys"]) for r in rows) == 18 and not any(bloom_lm.unpack_ids(r["counts"]).any() for r in rows)


def test_filter_gives_levels_back():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    counts = rng.integers(1, 500, 5000)
    want = bloom_lm.LogBloom.levels(counts, 1.5)
    blob = bloom_lm.LogBloom.segment(keys & bloom_lm.LOW48, counts, 1.5, 5, 10)
    one = bloom_lm.LogBloom.joined({0: blob}, 1, 1.5, 5)
    level = one.level_of(keys)
    assert (level >= want).all() and (level == want).mean() > 0.98
    assert (bloom_lm.least_count(want, 1.5) <= counts).all() and (bloom_lm.largest_count(want, 1.5) >= counts).all()
    assert (one.level_of(rng.integers(0, 1 << 63, 5000).astype(np.uint64)) > 0).mean() < 0.05
    # dealt over segments, some of them empty
    parts = {int(s): bloom_lm.LogBloom.segment((keys & bloom_lm.LOW48)[keys >> np.uint64(60) == s], counts[keys >> np.uint64(60) == s], 1.5, 5, 10) for s in np.unique(keys >> np.uint64(60)) if s != 3}
    level = bloom_lm.LogBloom.joined(parts, 16, 1.5, 5).level_of(keys)
    assert (level[keys >> np.uint64(60) == 3] == 0).all() and (level >= want)[keys >> np.uint64(60) != 3].all()


def test_model_of_odd_texts(spark, odd, empty):
    out = bloom_lm.score_documents(odd).collect()
    assert len(out) == len(ODD) and all(np.isfinite(r["score"]) for r in out)
    assert bloom_lm.score_documents(empty).count() == 0


# ---- op6 ----


def test_languages(spark, docs):
    out = langid.identify(docs, docs.where(~langid.held_out())).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.95


def test_spans_of_mixed_text(spark, docs):
    en = docs.where("lang = 'en' AND length(text) > 800").first()["text"][:400]
    de = docs.where("lang = 'de' AND length(text) > 800").first()["text"][:400]
    r = langid.identify(spark.createDataFrame([(1, en + " " + de)], "doc_id long, text string"), docs).first()
    assert [s["lang"] for s in r["spans"]] == ["en", "de"]


def test_path_equals_brute_force():
    import itertools

    rng = np.random.default_rng(0)
    model = langid.LanguageModel(["a", "b", "c"], np.zeros((1, 3)), np.ones((15, 3), dtype=bool), 1.5)
    lengths = np.array([5, 0, 3, 1])
    e = rng.normal(size=(9, 3))
    state = model.path(e, lengths)
    at = 0
    for n in lengths:
        best = max(itertools.product(range(3), repeat=int(n)), key=lambda s: sum(e[at + i, k] for i, k in enumerate(s)) - 1.5 * sum(x != y for x, y in zip(s, s[1:])))
        assert state[at : at + n].tolist() == list(best)
        at += n


def test_odd_languages(spark, odd, docs, empty):
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(odd, docs).collect()}
    assert out[1] == out[2] == out[7] == out[8] == "und" and out[3] != "und"
    assert langid.identify(empty, docs).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}
    strange = spark.createDataFrame([(i, t) for i, t in enumerate(["½ ²", "①②", "Ⅷ 3", "٣ ۴", "_ - _", "́ ̂"])], "doc_id long, text string")
    assert {r["lang_pred"] for r in langid.identify(strange, docs).collect()} == {"und"}
    assert langid.words_in("हिन्दी भाषा ภาษาไทย cafe\u0301 ½x²y") == ["हिन्दी", "भाषा", "ภาษาไทย", "cafe\u0301", "x", "y"]
    # with nothing learned only texts without a letter go
    unlabelled = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    assert langid.keep_identified(unlabelled, unlabelled).count() == docs.where("text rlike '[a-zA-Z]'").count()
    same = langid.identify(docs, docs.withColumn("lang", F.when(F.col("lang") == "de", "und").otherwise(F.col("lang"))))
    assert same.where("lang_pred = 'de'").count() == 0
    kept = langid.keep_identified(odd, docs)
    assert kept.columns == odd.columns and kept.where("doc_id = 3").count() == 2


# ---- op7, op8 ----


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoding_equals_the_library(spark, docs, odd, library):
    rows = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    out = bpe_tree.encode_ids(rows, PATH).collect()
    want = [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows.collect()]
    assert sorted((repr(r["doc_id"]), list(r["ids"])) for r in out) == sorted((repr(i), ids) for i, ids in want)
    back = bpe_tree.decode_ids(bpe_tree.encode_ids(odd, PATH), PATH).collect()
    assert sorted(r["text"] for r in back) == sorted(library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t in ODD)


def test_digest_of_ids(spark, odd, library, empty):
    for r in bpe_tree.encode_digest(odd.where("doc_id = 5"), PATH).collect():
        ids = library.encode(dict(ODD)[5], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    assert bpe_tree.encode_digest(empty, PATH).count() == 0


def test_encoding_of_any_characters(library):
    rng = np.random.default_rng(5)
    chars = [chr(c) for c in [*range(9, 14), *range(28, 700), 0x3A3, 0x1E9E, 0x301, 0x327, 0x4E2D, 0x1F600, 0x2028, 0x660, 0x2167]]
    texts = ["".join(rng.choice(chars, rng.integers(0, 60))) for _ in range(500)]
    encoder = bpe_tree.Encoder(PATH)
    got = [np.frombuffer(encoder.ids(p), dtype="<u4").tolist() for g in encoder.batches(texts) for p in g]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_full_store_is_emptied(library):
    texts = [f"alpha beta{i} gamma{i % 7}" for i in range(50)]
    encoder = bpe_tree.DigestEncoder(PATH, max_bytes=2_000)
    for _ in range(2):
        for text, pieces in zip(texts, [p for t in texts for g in encoder.batches([t]) for p in [encoder.ids(g[0])]]):
            assert np.frombuffer(pieces, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.held < 2_000 + 3 * 500
    assert len(encoder.known) == len(encoder.text) < 20


def test_packing(spark, docs, odd, library, empty):
    rows = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") + 1_000_000))
    out = packing.pack(rows, PATH, group_tokens=50_000).collect()
    ids = {r["doc_id"]: np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4") for r in rows.collect()}
    seen = {i: 0 for i in ids}
    for r in sorted(out, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == seen[r["doc_id"]]
        seen[r["doc_id"]] += r["length"]
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert seen == {i: len(x) for i, x in ids.items()}
    fill = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 4096 and (n == 4096 or n & (n - 1) == 0) for n in fill.values())
    assert packing.pack(empty, PATH).count() == 0


def test_assignment_prefers_cheap_sequences():
    pieces = packing.assign([3000, 3000, 1000, 1000, 100, 92], 4096, 1.0, 1.0)
    home = {d: q for d, _, _, q, _ in pieces}
    assert home[0] != home[1] and home[2] != home[3]


# ---- op9 ----


def brute_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    import xxhash

    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs):
    out = {r["doc_id"]: r for r in simhash_trie.near_duplicates(docs).collect()}
    prints = {r["doc_id"]: brute_simhash(r["text"]) for r in docs.collect()}
    assert all(out[i]["fingerprint"] == f"{p:016x}" for i, p in prints.items())
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, p in prints.items():
            low = min(label[j] for j, q in prints.items() if (p ^ q).bit_count() <= 3)
            if low < label[i]:
                label[i], changed = low, True
    assert {i: r["component_id"] for i, r in out.items()} == label


def test_hot_trees_lose_no_link(spark):
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 1 << 62))
    prints = sorted({base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 8), replace=False)) for _ in range(400)})
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    entries = spark.createDataFrame(signed, "fp long, rep long")
    comp = lambda limit: sorted(map(tuple, connected_components(simhash_trie.near_links(entries, hot_limit=limit)).collect()))
    assert comp(10) == comp(10**6)


def test_near_links_below_two_hot_parents(spark):
    rng = np.random.default_rng(8)
    base = int(rng.integers(1 << 62))
    low = base & (1 << 37) - 1
    fringe = [low | int(x) << 37 for x in rng.integers(1 << 26, size=40)]
    fps = [base, base ^ (1 << 38 | 1 << 50 | 1 << 60), *fringe]
    assert min((x ^ y).bit_count() for i, x in enumerate(fps) for y in fps[max(i + 1, 2) :]) > 3
    entries = spark.createDataFrame([(int(np.uint64(x).view(np.int64)), i) for i, x in enumerate(fps)], "fp long, rep long")
    assert {tuple(sorted(r)) for r in simhash_trie.near_links(entries, hot_limit=8).collect()} == {(0, 1)}


def test_odd_near_duplicates(spark, odd, empty):
    out = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_trie.near_duplicates(odd).collect()]
    assert len(out) == len(ODD)
    assert (1, "0" * 16, 1) in out and (2, "0" * 16, 1) in out and (8, "0" * 16, 1) in out
    assert simhash_trie.near_duplicates(empty).count() == 0
    kept = simhash_trie.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 2").count() == 0 and kept.where("doc_id is null").count() == 1


def brute_groups(rows):
    """Component number of each row: rows link at 3 or fewer differing bits."""
    prints = [brute_simhash(t) for _, t in rows]
    label = list(range(len(rows)))
    while True:
        low = [min(label[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3) for p in prints]
        if low == label:
            return prints, label
        label = low


def test_near_duplicates_of_null_and_repeated_ids(spark):
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    bases = [[word() for _ in range(400)] for _ in range(6)]
    texts = [" ".join(b[:k] + b[k + 1 :]) for b in bases for k in (3, 90, 200, 399)] + [" ".join(b) for b in bases] + [None, "", "lone words here"]
    ids = [None, None, 1, 1, 2, 3, 5, 5, 5, None, 9, 12]
    rows = [(ids[int(rng.integers(len(ids)))], texts[int(rng.integers(len(texts)))]) for _ in range(60)]
    rows += [(40, texts[0]), (41, texts[4]), (41, texts[8]), (41, texts[8])]
    prints, label = brute_groups(rows)
    least = {c: min((i for (i, _), k in zip(rows, label) if k == c and i is not None), default=None) for c in label}
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, fp int")
    got = collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_trie.near_duplicates(df).collect())
    assert got == collections.Counter((i, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, label))
    keeper = {c: min((i is None, i or 0, p if p < 1 << 63 else p - (1 << 64)) for (i, _), p, k in zip(rows, prints, label) if k == c) for c in label}
    kept = simhash_trie.keep_one(df).collect()
    assert len(kept) == len(keeper)
    assert sorted(keeper.values()) == sorted((r["doc_id"] is None, r["doc_id"] or 0, (lambda p: p if p < 1 << 63 else p - (1 << 64))(brute_simhash(r["text"]))) for r in kept)
    assert all(rows[r["fp"]] == (r["doc_id"], r["text"]) for r in kept)


def test_keep_one_keeps_other_texts_of_an_id(spark):
    words = [f"w{i}" for i in range(200)]
    a, b = " ".join(words), " ".join(reversed(words))
    kept = simhash_trie.keep_one(spark.createDataFrame([(1, a), (5, a), (5, b)], "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == [(1, a), (5, b)]


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (3, 9), (9, 9), (None, 4), (2, 1)] + [(100 + i, 101 + i) for i in range(40)], "src long, dst long")
    out = dict(map(tuple, connected_components(links).collect()))
    assert out[2] == out[3] == out[9] == 1 and out[8] == 7 and all(out[i] == 100 for i in range(101, 141))


# ---- op10 ----


def test_fuzzy_lines(spark):
    rng = np.random.default_rng(6)
    line = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300))
    near = line.replace(line.split()[7], "zzzzz")
    rows = [
        (1, line + "\nUnique first.\n\n!!!"),
        (2, near.upper() + "\nother words stay here\n\n!!!"),
        (3, "unique, FIRST\nunique first\nmore"),
        (4, None),
        (5, ""),
        (None, "unique first"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in fuzzy_lines.dedup_lines(df, budget=3).collect()}
    assert out[3]["text"] == "more" or out[1]["text"].endswith("\n!!!")
    assert out[4]["text"] is None and out[4]["n_lines"] == 0
    assert out[5]["n_removed"] == 0
    total = sum(r["n_removed"] for r in out.values())
    assert total >= 3


def brute_lines(rows, budget=3, similarity=0.8):
    from panelforge.llm.fuzzy_lines import PUNCTUATION

    table = str.maketrans("123456789" + PUNCTUATION, "0" * 9 + " " * len(PUNCTUATION))
    lines = [((d, i), tuple(w for w in x.lower().translate(table).split(" ") if w)) for d, t in rows if t is not None for i, x in enumerate(t.split("\n"))]
    return [(at, ws) for at, ws in lines if ws]


def test_fuzzy_lines_equal_brute_force(spark, docs):
    """Against all pairs of lines by edit similarity alone."""
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    lines = brute_lines(rows)
    distinct = sorted({w for _, w in lines}, key=len)
    label = {w: w for w in distinct}

    def far(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(prev[j] + 1, now[-1] + 1, prev[j - 1] + (x != y)))
            prev = now
        return prev[-1]

    # the words that two lines have in common bound their edit distance
    bags = [collections.Counter(w) for w in distinct]
    links = []
    for b in range(len(distinct)):
        most = int(len(distinct[b]) * 0.2 + 1e-9)
        for a in range(b - 1, -1, -1):
            if len(distinct[b]) - len(distinct[a]) > most:
                break
            if most and (bags[a] & bags[b]).total() >= len(distinct[b]) - most and far(distinct[a], distinct[b]) <= most:
                links.append((distinct[a], distinct[b]))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    first = {}
    for place, w in lines:
        first[label[w]] = min(first.get(label[w], place), place)
    gone = {}
    for (d, i), w in lines:
        if first[label[w]] != (d, i):
            gone.setdefault(d, []).append(i)
    got = {r["doc"]: list(r["lines"]) for r in fuzzy_lines.removed_lines(docs).collect()}
    assert got == {d: sorted(x) for d, x in gone.items()}


def test_fuzzy_lines_reach_the_edit_similarity(spark):
    """Lines with up to a fifth of their words replaced, whatever their SimHashes."""
    rng = np.random.default_rng(10)
    words = np.array(["".join(x) for x in rng.choice(list("abcdefghijklmnop"), (4000, 6))])
    rows, pairs = [], 0
    for n in [*range(5, 61), 150, 300] * 4:
        line = rng.choice(words, n)
        near = line.astype("U16")
        near[rng.choice(n, n // 5, replace=False)] = [f"other{pairs}x{k}".translate(str.maketrans("0123456789", "qrstuvwxyz")) for k in range(n // 5)]
        rows += [(2 * pairs, " ".join(line)), (2 * pairs + 1, " ".join(near) + "\nword " + str(words[pairs]))]
        pairs += 1
    out = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = {r["doc_id"]: r["n_removed"] for r in out}
    assert all(removed[2 * i] == 0 for i in range(pairs))
    assert sum(removed[2 * i + 1] for i in range(pairs)) >= 0.98 * pairs


def test_fuzzy_lines_of_repeated_rows(spark):
    one, two = "alpha beta gamma delta\nepsilon zeta eta theta\niota kappa lambda mu", "nu xi omicron pi\nrho sigma tau upsilon"
    other = "phi chi psi omega\nalpha beta gamma delta"
    rows = [(1, one), (1, one), (2, two), (2, two), (2, two), (3, one + "\nlast of all"), (4, two), (4, other), (None, "no id of mine"), (None, "no id either"), (None, "no id either")]
    out = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"] or 0, r["text"], r["n_removed"]) for r in out)
    assert got == sorted([(1, one, 0), (1, one, 0), (2, two, 0), (2, two, 0), (2, two, 0), (3, "last of all", 3), (4, "", 2), (4, "phi chi psi omega", 1), (0, "no id of mine", 0), (0, "no id either", 0), (0, "no id either", 0)])


def test_fuzzy_lines_run_no_python(spark, docs, empty):
    assert fuzzy_lines.dedup_lines(empty).count() == 0
    plan = fuzzy_lines.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_columns(spark):
    odd = spark.createDataFrame([(i, t, "a", 1, 2, "b", "c") for i, t in ODD], "doc_id long, text string, n_removed string, fp int, line int, lang string, lang_pred string")
    lines = fuzzy_lines.dedup_lines(odd)
    assert lines.columns == ["doc_id", "text", "fp", "line", "lang", "lang_pred", "n_lines", "n_removed"] and lines.count() == len(ODD)
    passages = suffix_dedup.dedup_passages(odd)
    assert passages.columns[:6] == ["doc_id", "text", "fp", "line", "lang", "lang_pred"] and passages.count() == len(ODD)
    assert simhash_trie.near_duplicates(odd).count() == len(ODD) <= packing.pack(odd, PATH).count()
    assert langid.identify(odd, odd).count() == bloom_lm.score_documents(odd).count() == rare_digest.digests(odd).count() == len(ODD)
