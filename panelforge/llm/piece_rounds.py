"""SentencePiece BPE in rounds over flat numpy arrays.

A text becomes a leading blank and its characters, blanks written as U+2581. No piece of the vocabulary has that mark
behind another character, so the text falls into words before each mark that does not follow one, and words are
encoded apart. The symbols of all new words lie in one array. A round takes the least pair rank of each word
(``minimum.reduceat``), merges the leftmost of its pairs and those of the same rank that do not overlap, and drops the
absorbed symbols; words without a pair leave the arrays. Ranks are computed once for each pair that arises.

Where a merge could make a pair of the same or a lower rank (``careful`` ranks) the library would go on there before the
next place, so only the first place of each part of a word is merged in a round; parts meet where no piece of that rank
or a lower one holds the two characters. Runs of blanks all have one rank and grow from the left
to the longest piece, so longer runs are cut beforehand into runs of that length.

Defined cases: null texts are empty texts, which have the end id only (or no id without it) and decode to nothing.
Characters without a piece become their UTF-8 bytes. Rows are independent: repeated rows, ties and null ids pass
through, other columns of the input are left out, an empty table gives no rows. Very long words only take more rounds.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from panelforge.llm.bpe_tree import _field, encoder_of
from panelforge.llm.scratch import text_slices

MARK = "▁"
#: Shown for the unknown piece where a model names no other text.
UNKNOWN = " ⁇ "
NONE = np.iinfo(np.int32).max


class Pieces:
    """Ids, pair ranks and texts of a BPE model with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.unknown, self.end = model.unk_id(), model.eos_id()
        self.hidden = np.array([model.is_control(i) for i in range(n)])
        is_byte = np.array([model.is_byte(i) for i in range(n)])
        self.byte_of = np.full(n, -1, dtype=np.int64)
        self.byte_of[is_byte] = [int(self.piece[i][3:5], 16) for i in np.flatnonzero(is_byte)]
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.byte_ids[self.byte_of[is_byte]] = np.flatnonzero(is_byte)
        plain = [i for i in range(n) if not (self.hidden[i] or is_byte[i] or i == self.unknown)]
        ids = {self.piece[i]: i for i in plain}
        self.char = {p: i for p, i in ids.items() if len(p) == 1}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("pieces with blanks behind other characters are not supported")
        # equal scores are equal ranks
        scores = np.unique([-model.get_score(i) for i in plain])
        rank = {i: int(np.searchsorted(scores, -model.get_score(i))) for i in plain}
        pairs = [(ids[p[:k]], ids[p[k:]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        self.width = n
        keys = np.array([a * n + b for a, b, _ in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.made = np.array([pairs[i][2] for i in order], dtype=np.int32)
        self.rank = np.array([rank[pairs[i][2]] for i in order], dtype=np.int32)
        # ranks of pieces that are part of a piece of the same or a lower rank
        self.careful = np.zeros(len(scores) + 1, dtype=bool)
        for a, b, i in pairs:
            for part in (a, b):
                if len(self.piece[part]) > 1 and rank[i] <= rank[part]:
                    self.careful[rank[part]] = True
        # least rank of a piece that holds two characters next to each other
        inner: dict[int, int] = {}
        for p, i in ids.items():
            for a, b in zip(p, p[1:]):
                key = ord(a) << 21 | ord(b)
                inner[key] = min(inner.get(key, NONE), rank[i])
        self.inner = np.array(sorted(inner), dtype=np.int64)
        self.inner_rank = np.array([inner[k] for k in self.inner.tolist()], dtype=np.int32)
        # runs of blanks grow from the left if they have the last rank alone, and fill the longest piece one after the other
        longest = max(len(p) for p in ids if not p.strip(MARK))
        last = {rank[i] for p, i in ids.items() if not p.strip(MARK)} == {len(scores) - 1}
        lone = last and all(p.strip(MARK) == "" for p, i in ids.items() if rank[i] == len(scores) - 1)
        cut = f"{MARK}{{{longest}}}(?={MARK})|" if lone and self._fills(longest) else ""
        self.words = re.compile(f"{cut}{MARK}*[^{MARK}]+|{MARK}+")
        # UTF-8 text of each piece, blanks in place of marks
        self.bytes = [b"" if self.hidden[i] else bytes([self.byte_of[i]]) if is_byte[i] else p.replace(MARK, " ").encode() for i, p in enumerate(self.piece)]

    def _fills(self, longest: int) -> bool:
        """Whether each run of more than ``longest`` blanks begins with that piece and goes on like the rest alone."""
        sizes = np.arange(1, 2 * longest + 1)
        word = np.repeat(sizes, sizes)
        points = np.full(len(word), ord(MARK), dtype=np.uint32)
        ids, word = merge_rounds(self, np.full(len(word), self.char[MARK], dtype=np.int32), word, self.walls(points, word))
        runs = {k: [len(self.piece[i]) for i in ids[word == k].tolist()] for k in sizes.tolist()}
        return all(runs[longest + k] == [longest, *runs[k]] for k in range(1, longest + 1))

    def walls(self, points: np.ndarray, word: np.ndarray) -> np.ndarray:
        """For each character the least rank of a piece that joins it to the one before; ``NONE``: no piece, or another word."""
        key = points[:-1].astype(np.int64) << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.inner, key), len(self.inner) - 1)
        joined = (self.inner[at] == key) & (word[1:] == word[:-1])
        return np.r_[np.int32(NONE), np.where(joined, self.inner_rank[at], NONE)].astype(np.int32)

    @functools.cached_property
    def decimal(self) -> list[bytes]:
        """Each id's decimal digits and a blank."""
        return [f"{i} ".encode() for i in range(self.width)]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, ``NONE`` where it makes no piece, and that piece."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.rank[at], NONE).astype(np.int32), np.where(known, self.made[at], -1).astype(np.int32)


@functools.lru_cache(maxsize=4)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def merge_rounds(vocab: Pieces, ids: np.ndarray, word: np.ndarray, wall: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (below 0: without a piece) of words, given by their ascending numbers, to ids after all merges and their words.

    ``wall``: the least rank of a piece that holds the two characters where a symbol and the one before it meet."""
    done_ids, done_at, done_word = [], [], []
    place = np.arange(len(ids))
    rank, made = np.full(len(ids), NONE, dtype=np.int32), np.full(len(ids), -1, dtype=np.int32)

    def renew(at: np.ndarray) -> None:
        """Ranks of the pairs that start at ``at``."""
        inside = at + 1 < len(ids)
        inside[inside] = word[at[inside]] == word[at[inside] + 1]
        rank[at[~inside]] = NONE
        at = at[inside]
        rank[at], made[at] = vocab.pairs(ids[at], ids[at + 1])

    renew(np.arange(len(ids)))
    while len(ids):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        counts = np.diff(np.r_[first, len(ids)])
        least = np.minimum.reduceat(rank, first)
        live = least != NONE
        if not live.all():
            out = ~np.repeat(live, counts)
            done_ids.append(ids[out]), done_at.append(place[out]), done_word.append(word[out])
            keep = ~out
            ids, word, place, rank, made, wall = ids[keep], word[keep], place[keep], rank[keep], made[keep], wall[keep]
            least, counts = least[live], counts[live]
            if not len(ids):
                break
        at = np.flatnonzero(rank == np.repeat(least, counts))
        # of neighbours that overlap every second one, counted from the left of their run
        run = np.r_[True, (at[1:] != at[:-1] + 1)]
        head = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - head) % 2 == 0]
        free = ~vocab.careful[rank[at]]
        if not free.all():
            # the first place of each part of a word that no merge of this rank or a lower one can leave
            free[0] = True
            free[1:] |= np.maximum.reduceat(wall, at + 1)[:-1] > rank[at[1:]]
            at = at[free]
        ids[at] = made[at]
        keep = np.ones(len(ids), dtype=bool)
        keep[at + 1] = False
        moved = np.cumsum(keep) - 1
        ids, word, place, rank, made, wall = ids[keep], word[keep], place[keep], rank[keep], made[keep], wall[keep]
        stale = np.zeros(len(ids) + 1, dtype=bool)
        stale[moved[at]] = stale[moved[at] - 1] = True  # the last place stands for what is before the first
        renew(np.flatnonzero(stale[:-1]))
    if not done_ids:
        return ids, word
    order = np.argsort(np.concatenate(done_at), kind="stable")
    return np.concatenate(done_ids)[order], np.concatenate(done_word)[order]


class PieceEncoder:
    """Texts to ids, word by word, with a store of words met before that is emptied beyond ``max_bytes``.

    ``WORD_BYTES`` are counted for each word besides its own and its ids'."""

    WORD_BYTES = 200

    def __init__(self, path: str, max_bytes: int = 48 << 20):
        self.vocab, self.max_bytes, self.held = pieces_of(path), max_bytes, 0
        self.known: dict = {}

    def split(self, text: str) -> list[str]:
        """Words of a text in order."""
        return self.vocab.words.findall(MARK + text.replace(" ", MARK)) if text else []

    def entries(self, ids: np.ndarray, ends: list[int]) -> list:
        """What the store keeps of each word: its ids as little-endian unsigned 32-bit integers."""
        raw = ids.astype("<u4").tobytes()
        self.held += len(raw)
        return [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word's end."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        wall = self.vocab.walls(points, word)
        chars, which = np.unique(points, return_inverse=True)
        # characters without a piece get numbers below zero, which are in no pair
        first = np.array([self.vocab.char.get(chr(c), -1 - k) for k, c in enumerate(chars)], dtype=np.int64)
        # characters that no piece joins begin a word of their own
        part, whole = np.cumsum(wall == NONE) - 1, word[wall == NONE]
        ids, part = merge_rounds(self.vocab, first[which].astype(np.int32), part, wall)
        word = whole[part]
        lost = ids < 0
        if lost.any():
            coded = [list(chr(c).encode("utf-8", "replace")) for c in chars]
            sizes = np.ones(len(ids), dtype=np.int64)
            sizes[lost] = np.array(list(map(len, coded)), dtype=np.int64)[-1 - ids[lost]]
            flat = self.vocab.byte_ids[np.array([b for k in -1 - ids[lost] for b in coded[k]], dtype=np.int64)]
            spread = np.repeat(ids, sizes)
            spread[spread < 0] = flat
            ids, word = spread, np.repeat(word, sizes)
        return ids, np.cumsum(np.bincount(word, minlength=len(words)))

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not in the store yet."""
        fresh = list(set(words).difference(self.known))
        if not fresh:
            return
        ids, ends = self.encode_words(fresh)
        self.known.update(zip(fresh, self.entries(ids, ends.tolist())))
        self.held += sum(map(len, fresh)) + self.WORD_BYTES * len(fresh)

    def batches(self, texts: list[str], chars: int = 1 << 20) -> Iterator[list[list[str]]]:
        """Words of a few texts at a time, all of them in the store."""
        group: list[list[str]] = []
        size = 0
        for text in [*texts, None]:
            if group and (text is None or size >= chars):
                if self.held > self.max_bytes:
                    self.known.clear()
                    self.held = 0
                self.learn(set().union(*group))
                yield group
                group, size = [], 0
            if text is not None:
                group.append(self.split(text))
                size += len(text)

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))


class DigestPieces(PieceEncoder):
    """Keeps a word's decimal ids, each with a blank behind it, their number and their text."""

    WORD_BYTES = 400

    def entries(self, ids: np.ndarray, ends: list[int]) -> list:
        listed = ids.tolist()
        decimal, text = self.vocab.decimal, self.vocab.bytes
        spans = zip([0, *ends], ends)
        out = [(b"".join([decimal[i] for i in listed[a:b]]), b - a, b"".join([text[i] for i in listed[a:b]])) for a, b in spans]
        self.held += sum([len(d) + len(t) for d, _, t in out])
        return out


def decode(vocab: Pieces, ids: Iterable[int]) -> str:
    """Text of ids as the library decodes them: the first piece's blank goes, broken UTF-8 becomes U+FFFD."""
    parts: list[str] = []
    held = bytearray()
    opened = False
    for i in ids:
        if vocab.byte_of[i] >= 0:
            held.append(vocab.byte_of[i])
            continue
        if held:
            parts.append(_bytes_text(held))
            held, opened = bytearray(), True
        if vocab.hidden[i]:
            continue
        text = UNKNOWN if i == vocab.unknown else vocab.piece[i].replace(MARK, " ")
        if not opened and text.startswith(" ") and i != vocab.unknown:
            text = text[1:]
        opened = True
        parts.append(text)
    return "".join(parts) + _bytes_text(held)


def _bytes_text(raw: bytes | bytearray) -> str:
    """UTF-8 text in which each byte that is in no character becomes U+FFFD."""
    return bytes(raw).decode("utf-8", "surrogateescape").translate(_LOST) if raw else ""


_LOST = {0xDC00 + b: "�" for b in range(128, 256)}


def encode_pieces(docs: DataFrame, model: str, end: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int> of each whole text, with the end id behind them if ``end``."""

    def run(batches):
        encoder = encoder_of(PieceEncoder, model)
        tail = encoder.vocab.end.to_bytes(4, "little") if end else b""
        for batch in batches:
            for first, texts in text_slices(batch, 1):
                ids = [encoder.ids(words) + tail for group in encoder.batches([t or "" for t in texts]) for words in group]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(ends), flat)], names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{_field(docs, id_col)}, ids array<int>")


def decode_pieces(frame: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, text of the ids of ``ids_col``; null ids: empty."""

    def run(batches):
        vocab = pieces_of(model)
        for batch in batches:
            texts = [decode(vocab, ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return frame.select(id_col, ids_col).mapInArrow(run, f"{_field(frame, id_col)}, text string")


def piece_digest(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256 of each whole text with the end id, without writing the ids.

    The words of an encoded text hold whole characters, so their decoded texts are joined; the leading blank goes."""

    def run(batches):
        encoder = encoder_of(DigestPieces, model)
        known, tail = encoder.known, str(encoder.vocab.end).encode()
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for _, texts in text_slices(batch, 1):
                for words in (w for group in encoder.batches([t or "" for t in texts]) for w in group):
                    found = [known[w] for w in words]
                    count.append(1 + sum([f[1] for f in found]))
                    ids_sha.append(hashlib.sha256(b"".join([f[0] for f in found]) + tail).hexdigest())
                    text_sha.append(hashlib.sha256(b"".join([f[2] for f in found])[1:]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{_field(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
