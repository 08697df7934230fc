"""BPE encoding with a segment tree over adjacent pair ranks.

Each distinct word is a row of a batch. A leaf of the row's tree holds ``rank * width + position`` of the pair that
starts at that position, so the root is the leftmost pair of the lowest rank. A merge rewrites at most three leaves
and their ancestors. Rows drop out when no mergeable pair is left. All rows of a batch advance together in numpy.

Null texts are empty texts, and these have no tokens. Rows are independent: ties, repeated rows and null ids pass
through unchanged, and an empty table gives no rows. Very long words only enlarge the tree of their own batch.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.scratch import text_slices

#: Pattern of the vocabulary file's splitter, with its white space spelled out.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
#: The same pattern for texts up to U+024F, where the standard library's engine is twice as fast.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
LATIN_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
BEYOND_LATIN = re.compile("[^\0-\u024f]")
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], dtype=np.int64)
        self.final = np.array([ids[s + suffix] for s in symbols], dtype=np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([(ids[a] << 20) | ids[b] for a, b in merges], dtype=np.int64)
        made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the merge table of each pair and whether it is there."""
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_rows(vocab: Vocabulary, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``ids``: rows of symbols padded to a power of two; merged in place, -1 where a symbol was absorbed."""
    rows, width = ids.shape
    tree = np.full((rows, 2 * width), NONE, dtype=np.int64)
    column = np.arange(width)
    after = np.broadcast_to(column + 1, ids.shape).copy()
    before = np.broadcast_to(column - 1, ids.shape).copy()
    r, c = np.nonzero(column[None, :-1] + 1 < count[:, None]) if width > 1 else (np.empty(0, int), np.empty(0, int))
    at, known = vocab.pairs(ids[r, c], ids[r, c + 1])
    r, c, at = r[known], c[known], at[known]
    tree[r, width + c] = vocab.rank[at] * width + c
    level = width
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half

    def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + width
        tree[row, node] = value
        for _ in range(width.bit_length() - 1):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def pair_value(row: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Leaf value of the pair that starts at ``leaf``."""
        follow = after[row, leaf]
        inside = follow < count[row]
        at, known = vocab.pairs(ids[row, leaf], ids[row, np.where(inside, follow, leaf)])
        return np.where(inside & known, vocab.rank[at] * width + leaf, NONE)

    live = np.flatnonzero(tree[:, 1] != NONE) if width > 1 else np.empty(0, int)
    while len(live):
        leaf = tree[live, 1] % width
        gone = after[live, leaf]
        at, _ = vocab.pairs(ids[live, leaf], ids[live, gone])
        ids[live, leaf] = vocab.made[at]
        ids[live, gone] = -1
        beyond = after[live, gone]
        after[live, leaf] = beyond
        linked = beyond < count[live]
        before[live[linked], beyond[linked]] = leaf[linked]
        put(live, gone, np.full(len(live), NONE))
        put(live, leaf, pair_value(live, leaf))
        prior = before[live, leaf]
        led = prior >= 0
        put(live[led], prior[led], pair_value(live[led], prior[led]))
        live = live[tree[live, 1] != NONE]
    return ids


class Encoder:
    """Texts to ids, word by word, with a store of words met before that is emptied beyond ``max_bytes``.

    ``WORD_BYTES`` are counted for each word besides its own and its ids'."""

    WORD_BYTES = 200

    def __init__(self, path: str, max_bytes: int = 48 << 20, batch_cells: int = 1 << 20):
        self.vocab, self.max_bytes, self.batch_cells = vocabulary(path), max_bytes, batch_cells
        self.held = 0
        self.known: dict = {}  # piece -> its ids as little-endian unsigned 32-bit integers

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def split(self, text: str) -> list[str]:
        text = self.normal(text)
        return (PIECES if BEYOND_LATIN.search(text) else LATIN_PIECES).findall(text)

    def pieces(self, text: str) -> list:
        """Words of a text in order; special tokens as their ids."""
        if self.vocab.cut is None or not any(s in text for s in self.vocab.special):
            return self.split(text)
        out: list = []
        for part in self.vocab.cut.split(text):
            out += [self.vocab.special[part]] if part in self.vocab.special else self.split(part)
        return out

    def learn(self, words: Iterable) -> None:
        """Encode the words that are not in the store yet."""
        fresh = set(words).difference(self.known)
        for special in fresh.intersection(self.vocab.special.values()):
            self.known[special] = special.to_bytes(4, "little")
        fresh = [w for w in fresh if isinstance(w, str)]
        coded = [w.encode() for w in fresh]
        order = np.argsort(np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)), kind="stable").tolist()
        fresh, coded = [fresh[i] for i in order], [coded[i] for i in order]
        start = 0
        while start < len(coded):
            width = 1 << (len(coded[start]) - 1).bit_length()
            stop = start
            while stop < len(coded) and len(coded[stop]) <= width and (stop == start or (stop - start + 1) * width <= self.batch_cells):
                stop += 1
            self._encode(fresh[start:stop], coded[start:stop], width)
            start = stop

    def _encode(self, words: list[str], coded: list[bytes], width: int) -> None:
        count = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        raw = np.frombuffer(b"".join(coded), dtype=np.uint8)
        ids = np.full((len(coded), width), -1, dtype=np.int64)
        inside = np.arange(width)[None, :] < count[:, None]
        ids[inside] = self.vocab.inner[raw]
        rows, last = np.arange(len(coded)), count - 1
        ids[rows, last] = self.vocab.final[raw[np.cumsum(count) - 1]]
        merge_rows(self.vocab, ids, count)
        kept = ids >= 0
        flat, ends = ids[kept].astype("<u4").tobytes(), 4 * np.cumsum(kept.sum(axis=1))
        first = 0
        for word, end in zip(words, ends.tolist()):
            self.known[word] = flat[first:end]
            first = end
        self.held += len(raw) + len(flat) + self.WORD_BYTES * len(words)

    def ids(self, pieces: list) -> bytes:
        """Id bytes of a text whose pieces are in the store."""
        return b"".join(map(self.known.__getitem__, pieces))

    def batches(self, texts: list[str], chars: int = 1 << 20) -> Iterator[list[list]]:
        """Pieces of a few texts at a time, all their words in the store."""
        group: list[list] = []
        size = 0
        for text in texts:
            group.append(self.pieces(text))
            size += len(text)
            if size >= chars:
                self._ready(group)
                yield group
                group, size = [], 0
        if group:
            self._ready(group)
            yield group

    def clear(self) -> None:
        self.known.clear()
        self.held = 0

    def _ready(self, group: list[list]) -> None:
        if self.held > self.max_bytes:
            self.clear()
        self.learn(set().union(*group))


class DigestEncoder(Encoder):
    """Encoder that also stores the decoded text of each piece, so that a document is two joins."""

    WORD_BYTES = 400

    def __init__(self, path: str, **limits):
        super().__init__(path, **limits)
        self.text: dict = {}

    def clear(self) -> None:
        super().clear()
        self.text.clear()

    def learn(self, words: Iterable) -> None:
        fresh = set(words).difference(self.known)
        super().learn(fresh)
        token = self.vocab.token.__getitem__
        for word in fresh:
            self.text[word] = " ".join(map(token, np.frombuffer(self.known[word], dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def encoder_of(kind: type, path: str) -> Encoder:
    """The worker's encoder: its store of words outlives a task."""
    return kind(path)


def encode_ids(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int> of each whole text."""

    def run(batches):
        encoder = encoder_of(Encoder, tokenizer)
        for batch in batches:
            for first, texts in text_slices(batch, 1):
                ids = [encoder.ids(pieces) for group in encoder.batches([t or "" for t in texts]) for pieces in group]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(ends), flat)], names=[id_col, "ids"])

    source = docs.select(id_col, text_col)
    return source.mapInArrow(run, f"{_field(docs, id_col)}, ids array<int>")


def decode_ids(frame: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, text: the tokens of ``ids_col`` joined by blanks, as the vocabulary file has no decoder; null ids: empty."""

    def run(batches):
        token = vocabulary(tokenizer).token
        for batch in batches:
            texts = [" ".join([token[i] for i in ids or ()]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return frame.select(id_col, ids_col).mapInArrow(run, f"{_field(frame, id_col)}, text string")


def encode_digest(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256 of each whole text, without writing the ids."""

    def run(batches):
        encoder = encoder_of(DigestEncoder, tokenizer)
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for _, texts in text_slices(batch, 1):
                for pieces in (p for group in encoder.batches([t or "" for t in texts]) for p in group):
                    raw = encoder.ids(pieces)
                    count.append(len(raw) // 4)
                    ids_sha.append(hashlib.sha256(raw).hexdigest())
                    text_sha.append(hashlib.sha256(" ".join(map(encoder.text.__getitem__, pieces)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(id_col, F.col(text_col))
    return source.mapInArrow(run, f"{_field(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _field(docs: DataFrame, name: str) -> str:
    return f"`{name}` {docs.schema[name].dataType.simpleString()}"
