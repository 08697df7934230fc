"""Alignment of two tokenizers' tokens by diagonal run skipping, and how often their tokens are linked in a corpus.

Both tokenizers cut the bytes of a blank and the text. Where tokens of both end at one byte, a group ends. The two
arrays of ends are walked together: at the current shift between their indices slices of 1, 2, 4, ... ends are compared,
so a stretch of one-to-one groups is jumped at the cost of its logarithm in comparisons; where ends differ the group is
resolved by stepping the side that lags until both meet, and the shift changes by what it took.

A group's last tokens end together and are its link. One of two linked tokens' bytes is the end of the other's, so the
pairs that can be linked follow from the vocabularies (``link_table``, some hundred thousand). Corpus counts are arrays
over this table: added up in each task, summed by Spark, and returned to the tasks as one bounded broadcast.

Defined cases: null and empty texts, and texts whose tokens' bytes are not those of a blank and the text (those that
hold U+2581), have no tokens: zeros and an empty ``groups_sha256``, and no links. Repeated rows and ids count as often
as they occur; null ids pass through; other columns of the input are left out; an empty table gives no rows. Texts are
encoded whole, by units between blanks, with a store of units that is bounded in bytes.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm.bpe_tree import _field, byte_symbols
from panelforge.llm.piece_rounds import MARK, PieceEncoder, pieces_of
from panelforge.llm.scratch import materialize, text_slices

#: Units of a text, in which no token of either side begins before and ends behind: both vocabularies cut between a
#: character that is no white space and a blank. The plain pattern serves texts without other white space before a blank.
UNITS = re.compile(" *[^ ]+| +")
MIXED_SPACE, BETWEEN = re.compile(r"[^\S ] "), re.compile(r"(?<=\S)(?= )")
#: Fixed value: the splitter's pattern of byte-level vocabularies; and the length from which texts go to the file's library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 2_000


@functools.lru_cache(maxsize=4)
def byte_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary file; special tokens stand for none."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    special = {t["id"] for t in spec["added_tokens"]}
    out = [b""] * (1 + max([*spec["model"]["vocab"].values(), *special]))
    for token, i in spec["model"]["vocab"].items():
        if i not in special:
            out[i] = bytes(map(byte_of.__getitem__, token))
    return out


@functools.lru_cache(maxsize=4)
def short_encoder(path: str) -> tiktoken.Encoding | None:
    """The vocabulary file's own tokens and merges in an encoder that is faster for short texts; None if its ids are not in the order of its merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    merges = ("".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"])
    ids = [model["vocab"][m] for m in merges]
    tokens = byte_tokens(path)
    if sorted(ids) != ids or ids != list(range(256, 256 + len(ids))) or sorted(map(len, tokens[:256])) != [1] * 256:
        return None
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens) if t}, special_tokens={})


@functools.lru_cache(maxsize=4)
def link_table(bytes_path: str, pieces_path: str) -> np.ndarray:
    """Sorted codes (A id << 20 | B id) of all pairs of tokens of which one ends with the other."""
    sides = byte_tokens(bytes_path), pieces_of(pieces_path).bytes
    named: list[dict[bytes, list[int]]] = [{}, {}]
    for side, names in zip(sides, named):
        for i, b in enumerate(side):
            if b:
                names.setdefault(b, []).append(i)
    pairs = set()
    for i, b in enumerate(sides[0]):
        pairs.update((i, j) for k in range(len(b)) for j in named[1].get(b[k:], ()))
    for j, b in enumerate(sides[1]):
        pairs.update((i, j) for k in range(len(b)) for i in named[0].get(b[k:], ()))
    return np.array(sorted(i << 20 | j for i, j in pairs), dtype=np.int64)


def diagonal_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group the index of its last token on either side. Ends are ascending longs with the same last one."""
    a, b = ends_a.tolist(), ends_b.tolist()
    raw_a, raw_b = ends_a.tobytes(), ends_b.tobytes()  # slices of these compare at the speed of memory
    stretches: list[tuple[int, int, int]] = []  # index of the first group's last A token, shift to B's, groups
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            # one-to-one groups at the shift j - i
            begin, size, shift = i, 4, j - i
            i += 1
            while found := raw_a[8 * i : 8 * (i + size)]:
                if found != raw_b[8 * (i + shift) : 8 * (i + shift + size)]:
                    break
                i += len(found) >> 3
                size += size
            while size > 1 and i < n:
                size >>= 1
                found = raw_a[8 * i : 8 * (i + size)]
                if found == raw_b[8 * (i + shift) : 8 * (i + shift + size)]:
                    i += len(found) >> 3
            stretches.append((begin, shift, i - begin))
            j = i + shift
        else:
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            stretches.append((i, j - i, 1))
            i += 1
            j += 1
    if not stretches:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin, shift, count = np.array(stretches, dtype=np.int64).T
    last_a = np.arange(count.sum()) + np.repeat(begin - np.r_[0, np.cumsum(count)[:-1]], count)
    return last_a, last_a + np.repeat(shift, count)


class Units:
    """A store of units' ids on both sides, emptied beyond ``max_bytes``; ``lost``: units whose tokens' bytes are not theirs."""

    UNIT_BYTES = 300

    def __init__(self, bytes_path: str, pieces_path: str, max_bytes: int = 128 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread; more would only contend for the executor's cores
        self.short = short_encoder(bytes_path)
        self.library = Tokenizer.from_file(bytes_path)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        self.rounds = PieceEncoder(pieces_path)
        self.bytes = byte_tokens(bytes_path), self.rounds.vocab.bytes
        self.sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in self.bytes]
        self.max_bytes, self.held, self.known, self.lost = max_bytes, 0, {}, set()

    def split(self, text: str) -> list[str]:
        text = " " + text
        return BETWEEN.split(text) if MIXED_SPACE.search(text) else UNITS.findall(text)

    def encode_bytes(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after the other, and where each unit's end."""
        if self.short:
            # the pattern's look-ahead gives up on very long runs of white space
            coded = [self.short.encode_ordinary(u) if len(u) < LONG else self.library.encode(u, add_special_tokens=False).ids for u in units]
        else:
            coded = [x.ids for x in self.library.encode_batch(units, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(coded), np.int64), np.cumsum(list(map(len, coded)))

    def encode_pieces(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [self.rounds.vocab.words.findall(u.replace(" ", MARK)) for u in units]
        ids, ends = self.rounds.encode_words(list(itertools.chain.from_iterable(words)))
        return ids, ends[np.cumsum(list(map(len, words))) - 1]

    def learn(self, units: Iterable[str]) -> None:
        """Encode the units that are not in the store yet."""
        if self.held > self.max_bytes:
            self.known.clear()
            self.lost.clear()
            self.held = 0
        fresh = list(set(units).difference(self.known))
        if not fresh:
            return
        plain = [u.encode() for u in fresh]
        self.held += self.UNIT_BYTES * len(fresh) + sum(map(len, plain))
        coded = []
        for (ids, ends), token, sizes in zip((self.encode_bytes(fresh), self.encode_pieces(fresh)), self.bytes, self.sizes):
            raw, stops = ids.astype("<i4").tobytes(), ends.tolist()
            coded.append([raw[4 * i : 4 * k] for i, k in zip([0, *stops], stops)])
            self.held += len(raw)
            lengths = np.diff(np.r_[0, np.cumsum(sizes[ids])][np.r_[0, ends]])
            if lengths.tolist() != list(map(len, plain)) or b"".join(map(token.__getitem__, ids.tolist())) != b"".join(plain):
                self.lost.update(u for u, c, p in zip(fresh, coded[-1], plain) if b"".join(map(token.__getitem__, np.frombuffer(c, dtype="<i4").tolist())) != p)
        self.known.update(zip(fresh, zip(*coded)))

    def tokens(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids and ends of a text's tokens on both sides."""
        if self.lost and not self.lost.isdisjoint(units):
            return None
        ids = [np.frombuffer(b"".join(side), dtype="<i4") for side in zip(*map(self.known.__getitem__, units))]
        return [(i, np.cumsum(sizes[i])) for i, sizes in zip(ids, self.sizes)]


class Aligner:
    """Groups and links of texts, for one pair of vocabularies."""

    def __init__(self, bytes_path: str, pieces_path: str):
        self.units = Units(bytes_path, pieces_path)
        self.table = link_table(bytes_path, pieces_path)
        # each id's decimal digits, followed by what stands behind it inside a group, behind A's last and behind B's last
        n_a, n_b = map(len, self.units.bytes)
        self.texts = [np.array([f"{i}{end}" for i in range(n)], dtype=object) for n, end in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";"))]

    def align(self, texts: list[str]) -> Iterable[tuple | None]:
        """(A ids, B ids, last A index and last B index of each group) of each text, None without tokens."""
        split = [None if MARK in t or not t else self.units.split(t) for t in texts]
        self.units.learn(set().union(*filter(None, split)))
        for units in split:
            sides = self.units.tokens(units) if units else None
            yield (sides[0][0], sides[1][0], *diagonal_groups(sides[0][1], sides[1][1])) if sides else None

    def groups_text(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """Decimal ids as ``a1,a2|b1;a3|b2,b3``."""
        out = np.empty(len(a) + len(b), dtype=object)
        ends = last_a + 1, last_b + 1
        # a token stands behind its own side's and the other side's of the groups before; B's also behind A's of its group
        for ids, own, other, first in ((a, ends[0], np.r_[0, ends[1]], 0), (b, ends[1], ends[0], 2)):
            text = self.texts[first][ids]
            text[own - 1] = self.texts[first + 1][ids[own - 1]]
            before = np.repeat(other[: len(own)], np.diff(np.r_[0, own]))
            out[np.arange(len(ids)) + before] = text
        return "".join(out.tolist())[:-1]

    def links(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the link table and how often each occurs."""
        codes, counts = np.unique(a[last_a].astype(np.int64) << 20 | b[last_b], return_counts=True)
        return np.searchsorted(self.table, codes).astype(np.int32), counts.astype(np.int32)


@functools.lru_cache(maxsize=2)
def aligner_of(bytes_path: str, pieces_path: str) -> Aligner:
    return Aligner(bytes_path, pieces_path)


def aligned(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_a, n_b, n_groups, groups_sha256, pairs (places in the link table) and times (of each in the text)."""

    def run(batches):
        aligner = aligner_of(bytes_path, pieces_path)
        for batch in batches:
            for first, texts in text_slices(batch, 1):
                n_a, n_b, n_groups, shas, pairs, times = [], [], [], [], [], []
                for found in aligner.align([t or "" for t in texts]):
                    n_a.append(len(found[0]) if found else 0)
                    n_b.append(len(found[1]) if found else 0)
                    n_groups.append(len(found[2]) if found else 0)
                    shas.append(hashlib.sha256(aligner.groups_text(*found).encode()).hexdigest() if found else "")
                    at, count = aligner.links(*found) if found else (np.empty(0, np.int32), np.empty(0, np.int32))
                    pairs.append(at)
                    times.append(count)
                offsets = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (pairs, times)]
                plain = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *plain, pa.array(shas, pa.string()), *lists], names=[id_col, "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{_field(docs, id_col)}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<int>, times array<int>")


def link_counts(found: DataFrame, size: int) -> DataFrame:
    """pair, n: how often each place of the link table is linked in all texts; a task sends each place once at most."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            pairs, times = (batch.column(k).flatten().to_numpy() for k in (0, 1))
            np.add.at(total, pairs, times)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    return found.select("pairs", "times").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def counted(found: DataFrame, counts: np.ndarray, best: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """``found`` with n_links, n_best and count_sum in place of its links."""
    shared = found.sparkSession.sparkContext.broadcast((counts, best))

    def run(batches):
        counts, best = shared.value
        for batch in batches:
            offsets = batch.column(5).offsets.to_numpy().astype(np.int64)
            pairs, times = batch.column(5).flatten().to_numpy(), batch.column(6).flatten().to_numpy().astype(np.int64)
            sums = [np.diff(np.r_[0, np.cumsum(x)][offsets - offsets[0]]) for x in (times, times * best[pairs], times * counts[pairs])]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(4)], *map(pa.array, sums), batch.column(4)], names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return found.mapInArrow(run, f"{_field(found, id_col)}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align_corpus(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text.

    What returns to the driver and is broadcast is one number for each pair of tokens that can be linked at all."""
    table = link_table(bytes_path, pieces_path)
    found = materialize(aligned(docs, bytes_path, pieces_path, id_col, text_col))
    sums = link_counts(found, len(table)).toPandas()
    counts = np.zeros(len(table), dtype=np.int64)
    counts[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    highest = np.zeros(1 << 20, dtype=np.int64)
    np.maximum.at(highest, table & 0xFFFFF, counts)
    return counted(found, counts, counts == highest[table & 0xFFFFF], id_col)
