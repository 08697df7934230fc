"""SentencePiece rounds against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from panelforge.llm import piece_rounds

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "a", "▁", "x▁ y", "</s><s> <unk> <0x41>", "\0\n\t\r", "中𐍈é👍🏽", " " * 37 + "the", "in" * 900, "ab ab  ab   ab\n", "é" * 7000, "word " * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(encoder, texts):
    return [[int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)] for g in encoder.batches(texts) for raw in map(encoder.ids, g)]


def test_texts_of_any_characters(library):
    rng = random.Random(1)
    chars = [chr(c) for c in [*range(0, 700), 0x2581, 0x4E2D, 0x1F600, 0x301, *[0x20] * 9, *map(ord, "aeintrs")]]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(rng.choice("abcdefghinorstu") for _ in range(rng.randint(1, 300))) for _ in range(1000)]
    texts += [" " * k + x for k in range(70) for x in ("", "t", "▁", "\n")] + [c * 3000 for c in "a-=\0é"] + [" " * 30000 + "x"]
    assert ids_of(piece_rounds.PieceEncoder(PATH), texts) == library.encode(texts)


def test_long_word(library):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghinorstu") for _ in range(60_000))
    assert ids_of(piece_rounds.PieceEncoder(PATH), [text]) == [library.encode(text)]


def test_store_is_emptied(library):
    texts = [f"alpha beta{i} gamma{i % 7}" for i in range(60)]
    encoder = piece_rounds.DigestPieces(PATH, max_bytes=4_000)
    for text in texts:
        for words in next(encoder.batches([text])):
            assert b"".join(encoder.known[w][0] for w in words).decode().split() == [str(i) for i in library.encode(text)]
        assert encoder.held < 4_000 + 3 * 600
    assert len(encoder.known) < 20


def test_decoding_of_any_ids(library):
    rng = random.Random(3)
    vocab = piece_rounds.pieces_of(PATH)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 3, 300, *range(100, 300), *range(259, 400), 28705]) for _ in range(rng.randint(0, 12))]
        assert piece_rounds.decode(vocab, ids) == library.decode(ids)


def test_frames(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None if i == 3 else i % 5, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = docs.unionByName(odd)
    texts = [(r["doc_id"], r["text"] or "") for r in rows.collect()]
    want = sorted((repr(i), library.encode(t) + [2], library.decode(library.encode(t) + [2])) for i, t in texts)
    coded = piece_rounds.encode_pieces(rows, PATH)
    assert sorted((repr(r["doc_id"]), list(r["ids"])) for r in coded.collect()) == [w[:2] for w in want]
    back = piece_rounds.decode_pieces(coded, PATH).collect()
    assert sorted((repr(r["doc_id"]), r["text"]) for r in back) == sorted((i, t) for i, _, t in want)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = piece_rounds.piece_digest(rows.selectExpr("doc_id", "text", "1 AS n_tokens", "2 AS ids_sha256"), PATH)
    assert sorted((repr(r[0]), *r[1:]) for r in digests.collect()) == sorted((i, len(ids), sha(" ".join(map(str, ids))), sha(t)) for i, ids, t in want)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert piece_rounds.piece_digest(empty, PATH).count() == piece_rounds.encode_pieces(empty, PATH).count() == 0
    bare = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [list(r["ids"]) for r in piece_rounds.encode_pieces(bare, PATH, end=False).collect()] == [[]]
