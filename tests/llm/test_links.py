"""Cross-tokenizer alignment against token-by-token brute force."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from panelforge.llm import fuzzy_lines, token_links

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (5, "<|endoftext|> It's </s> 2024!  Ünḯ"), (6, "x" * 5000), (7, "mark ▁ inside"), (8, "▁"), (9, "\n\n \t\x1c\x85"),
    (10, "中𐍈 👍🏽 é"), (11, " "), (12, " " * 333), (13, "tail   "), (15, "a\n  b \t c\x1c  d\u3000 e\n"), (14, "word " * 4000),
]


def brute(texts):
    """Contract columns of each text, token by token."""
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    byte = token_links.byte_tokens(A)
    out, corpus = [], collections.Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        piece = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
        if b"".join(byte[i] for i in a) != whole or b"".join(piece) != whole:
            out.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(byte[i]) for i in a]).tolist(), np.cumsum(list(map(len, piece))).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end), ends_b.index(end)
            groups.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
            links.append((a[x], b[y]))
            i, j = x + 1, y + 1
        corpus.update(links)
        out.append((len(a), len(b), groups, links))
    best = collections.Counter()
    for (_, y), n in corpus.items():
        best[y] = max(best[y], n)
    done = []
    for r in out:
        if r is None:
            done.append((0, 0, 0, 0, 0, 0, ""))
        else:
            na, nb, groups, links = r
            done.append((na, nb, len(groups), len(links), sum(corpus[k] == best[k[1]] for k in links), sum(corpus[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return done


def test_diagonal_groups():
    rng = random.Random(4)
    for _ in range(2000):
        n, p = rng.randint(1, 200), rng.choice([0.1, 0.5, 0.9, 0.99])
        a, b = (sorted({n, *[x for x in range(1, n) if rng.random() < q]}) for q in (p, rng.choice([p, 1])))
        last_a, last_b = token_links.diagonal_groups(np.array(a), np.array(b))
        common = sorted(set(a) & set(b))
        assert [a[i] for i in last_a] == [b[i] for i in last_b] == common


def test_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.unionByName(spark.createDataFrame(ODD, "doc_id long, text string"))
    listed = [(r["doc_id"], r["text"]) for r in rows.collect()]
    want = sorted((repr(i), *r) for (i, _), r in zip(listed, brute([t for _, t in listed])))
    out = token_links.align_corpus(rows.selectExpr("doc_id", "text", "1 AS n_a", "'x' AS pairs"), A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((repr(r[0]), *r[1:]) for r in out.collect()) == want
    assert sum(w[4] > 0 for w in want) > 200


def test_texts_of_any_characters():
    rng = random.Random(5)
    chars = [chr(c) for c in [*range(0, 700), 0x2581, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x301, *[0x20] * 60, *[0x0A, 0x09, 0x0D] * 5, *map(ord, "aeintrs" * 20)]]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 50))) for _ in range(800)] + ["".join(rng.choice("aeint rs") for _ in range(200)) for _ in range(200)]
    aligner = token_links.Aligner(A, B)
    for found, want in zip(aligner.align(texts), brute(texts)):
        assert (found is None) == (want[-1] == "")
        if found:
            assert (len(found[0]), len(found[1]), len(found[2])) == want[:3]
            assert hashlib.sha256(aligner.groups_text(*found).encode()).hexdigest() == want[-1]
            aligner.links(*found)
            codes = found[0][found[2]].astype(np.int64) << 20 | found[1][found[3]]
            assert (aligner.table[np.searchsorted(aligner.table, codes)] == codes).all()


def test_short_and_long_units_by_either_encoder():
    rng = random.Random(6)
    units = token_links.Units(A, B)
    texts = [" " + "".join(rng.choice("abé,.'1\t\n\x1c中") for _ in range(rng.randint(1, 40))) for _ in range(2000)] + [" " + "ab" * 3000, " " * 5000, " " * 1999 + "x", " a\u3000\x85b", " it's", " 12345 678", " ²½"]
    assert units.short is not None
    ids, ends = units.encode_bytes(texts)
    units.short = None
    again, stops = units.encode_bytes(texts)
    assert ids.tolist() == again.tolist() and ends.tolist() == stops.tolist()


def test_full_stores_are_emptied():
    units = token_links.Units(A, B, max_bytes=3_000)
    for k in range(40):
        units.learn([f"w{k}", " same", f" v{k % 9}"])
        assert units.held < 3_000 + 3 * 400
    assert len(units.known) < 20


def test_nothing(spark):
    assert token_links.align_corpus(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    bare = spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string")
    assert sorted(r[1:] for r in token_links.align_corpus(bare, A, B).collect()) == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_near_lines_of_a_crowded_block_are_linked(spark):
    # 40 pairs in one block, near their twin alone; the second half of each line is the same in all lines
    pairs, common = 40, "".join(chr(0x9000 + i) for i in range(8))
    rows = []
    for k in range(pairs):
        own = [chr(0x3400 + 12 * k + i) for i in range(12)]
        rows += [(2 * k, 0, 20, "".join(own) + common), (2 * k + 1, 0, 20, "".join(own[:5] + ["z"] + own[6:]) + common)]
    texts = spark.createDataFrame(rows, "id long, sim long, total int, norm string")
    for n in (2 * pairs, 3):  # by rare words, and all with all
        shared = texts.selectExpr("1L AS key", "id", "0L AS low", f"{n}L AS n")
        got = {(r.id, r.component) for r in fuzzy_lines.line_groups(shared, texts, 24, 0.8).collect()}
        assert got == {(2 * k + 1, 2 * k) for k in range(pairs)}


def test_near_copies_of_a_block_meet_once(spark):
    # 60 near copies whose least line is another text, and 60 texts that share half of their words with them and one another
    rng = random.Random(9)
    word = lambda: chr(0x3400 + rng.randrange(6000))
    common, tail = [word() for _ in range(20)], [word() for _ in range(20)]
    lines = [[*common, *(word() for _ in range(20))]]
    for _ in range(60):
        lines.append([*common, *tail])
        lines[-1][rng.randrange(40)] = word()
    lines += [[*common, *(word() for _ in range(20))] for _ in range(60)]
    texts = spark.createDataFrame([(i, 0, 40, "".join(x)) for i, x in enumerate(lines)], "id long, sim long, total int, norm string")
    near = fuzzy_lines._may_be_near(24, 0.8)
    shared = texts.selectExpr("explode(array(1L, 2L)) AS key", "id", "0L AS low", f"{len(lines)}L AS n")
    # what another block has linked needs no comparison
    shared = shared.unionByName(texts.where("id between 1 and 60").selectExpr("3L AS key", "id", "1L AS low", "60L AS n"))
    links = texts.where("id between 2 and 60").selectExpr("1L AS a", "id AS b")
    rows = fuzzy_lines.mixed_blocks(shared, fuzzy_lines.first_groups(links)).join(fuzzy_lines.signs(texts), "id")
    assert {r.key for r in rows.select("key").distinct().collect()} == {1, 2}
    assert fuzzy_lines._pairs_with_rest(rows, ["key"], near).count() == 0
    got = {(r.id, r.component) for r in fuzzy_lines.line_groups(shared, texts, 24, 0.8).collect()}
    assert got == {(i, 1) for i in range(2, 61)}


def test_switched_bits_lose_no_near_pair(spark):
    rng = random.Random(10)
    rows = []
    for k in range(300):
        a = [chr(0x3400 + rng.randrange(1 << rng.randint(2, 12))) for _ in range(rng.randint(5, 90))]
        b = list(a)
        for _ in range(int(len(a) * 0.2 + 1e-9)):
            at, do = rng.randrange(len(b)), rng.randrange(3)
            b[at : at + (do != 1)] = [] if do == 0 and len(b) > 1 else [chr(0x3400 + rng.randrange(4096))]
        rows += [(2 * k, 0, len(a), "".join(a)), (2 * k + 1, 0, len(b), "".join(b))]
    texts = spark.createDataFrame(rows, "id long, sim long, total int, norm string")
    told = fuzzy_lines.signs(texts)
    pairs = fuzzy_lines._side(told.where("id % 2 = 0"), "a", "x", *fuzzy_lines.SIGNS).join(fuzzy_lines._side(told.where("id % 2 = 1").selectExpr("id - 1 AS a", "*").drop("id").withColumnRenamed("a", "id"), "a", "y", *fuzzy_lines.SIGNS), "a")
    passed = {r.a for r in pairs.where(fuzzy_lines._may_be_near(24, 0.8)).collect()}
    norms = {r[0]: r[3] for r in rows}
    both = spark.createDataFrame([(k, norms[k], norms[k + 1]) for k in range(0, 600, 2)], "a long, x string, y string")
    want = {r.a for r in both.where("levenshtein(x, y) <= floor(greatest(length(x), length(y)) * 0.2 + 1e-9)").collect()}
    assert len(want) > 200 and want <= passed
    # lines that share half of their words do not pass
    half = [(i, 0, 30, "".join(chr(0x3400 + (j if j < 15 else 100 * i + j)) for j in range(30))) for i in range(1, 21)]
    told = fuzzy_lines.signs(spark.createDataFrame(half, texts.schema))
    crossed = fuzzy_lines._side(told, "a", "x", *fuzzy_lines.SIGNS).crossJoin(fuzzy_lines._side(told, "b", "y", *fuzzy_lines.SIGNS)).where("a < b")
    assert crossed.where(fuzzy_lines._may_be_near(24, 0.8)).count() == 0
