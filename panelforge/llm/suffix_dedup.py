"""Removal of passages that repeat: blockwise suffix sorting with a difference cover.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts elsewhere, in the same document or another.

Suffixes are put into buckets that equal strings share: each start is named by the rightmost least hash of the
``GRAM``-byte strings among its next ``CHOICES`` places (its anchor), and neighbouring starts with one anchor make a
piece. Two counts over the whole corpus settle most pieces without sorting: a piece that occurs twice repeats
throughout, and a piece whose anchor occurs once cannot repeat. One copy of each remaining piece goes to the block of
its anchor, where the suffixes are sorted, one bucket (anchor and distance to it) at a time, with long ties resolved
by precomputed ranks of a difference cover; neighbours that agree in ``LENGTH`` bytes repeat.

Blocks are bounded: an anchor with more than ``block_pieces`` pieces is dealt over several by the hash of the piece,
which then exchange one fingerprint for each of their distinct strings. (Dealing by the distance to the anchor would need
no exchange, but would send 400 bytes for each piece and range: 80 KB for a piece of 201 starts, against 5 KB at most of
fingerprints.) Counts and fingerprints travel in packed arrays, one for each chunk or block and segment of the hashes, so
that neither rows nor groups grow with the copies of a passage.

Defined results: null text is empty text (it comes back as null); a text shorter than ``LENGTH`` loses nothing;
repeated rows are documents of their own, so their long passages go. Where a removal cuts a character, the kept text
leaves the rest of it out, while kept_sha256 is over the kept bytes. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.bloom_lm import _deal, mix
from panelforge.llm.scratch import materialize, returning, tasks
from panelforge.llm.suffix_blocks import V, equal_runs, sort_block

LENGTH, GRAM = 400, 200
CHOICES = LENGTH - GRAM + 1
FACTOR = 0x9E3779B97F4A7C15
PLACE_BITS = 30
PLACE = np.uint64((1 << PLACE_BITS) - 1)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTOR))


class Hasher:
    """Hashes of any substring of ``data`` from running sums."""

    def __init__(self, data: np.ndarray):
        up, down = (np.full(len(data) + 1, x, dtype=np.uint64) for x in (FACTOR, pow(FACTOR, -1, 1 << 64)))
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        self.down = np.cumprod(down, out=down)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[:-1], out=self.sums[1:])

    def between(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def every(self, length: int) -> np.ndarray:
        return mix((self.sums[length:] - self.sums[:-length]) * self.down[: len(self.sums) - length])


def pieces_of(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """anchor hash, piece hash, first start, last start, anchor place: the pieces of documents laid end to end."""
    none = np.empty(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    hasher = Hasher(data)
    keys = hasher.every(GRAM)
    places = np.arange(len(keys), dtype=np.uint64)
    # the least hash wins, the rightmost of equal ones
    keys = keys & ~PLACE | PLACE - places
    least, width = keys, 1
    while 2 * width <= CHOICES:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (CHOICES - width)], least[CHOICES - width :])
    anchor = (PLACE - (least & PLACE)).astype(np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= ends)
    if not len(starts):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    own = anchor[starts]
    begin = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)])
    low, high, at = starts[begin], starts[np.r_[begin[1:], len(starts)] - 1], own[begin]
    name = hasher.between(at, at + GRAM)
    piece = mix(hasher.between(low, high + LENGTH) + mix(((at - low) << 32 | (high - low)).astype(np.uint64)))
    return name, piece, low, high, at


def unpack(blob: bytes, text_col: str) -> tuple[pa.RecordBatch, list[bytes]]:
    batch = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all().combine_chunks().to_batches()[0]
    return batch, [(t or "").encode() for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]


def chunk_pieces(texts: list[bytes], block: int = 1 << 18):
    """Pieces of a chunk, places counted over the chunk; computed a few documents at a time."""
    out, group, size, base = [], [], 0, 0
    for i, text in enumerate(texts):
        group.append(text)
        size += len(text)
        if size >= block or i + 1 == len(texts):
            name, piece, low, high, at = pieces_of(np.frombuffer(b"".join(group), dtype=np.uint8), np.array([len(t) for t in group]))
            out.append((name, piece, low + base, high + base, at + base))
            base += size
            group, size = [], 0
    return tuple(np.concatenate(x) for x in zip(*out))


def chunked(docs: DataFrame, chunk_bytes: int, text_col: str) -> DataFrame:
    """chunk, blob: all columns of some documents, compressed."""
    at = docs.columns.index(text_col)

    def run(batches):
        first, number, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size
            table = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table.combine_chunks())
            blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([first + number - 1]), pa.array([blob], pa.binary())], names=["chunk", "blob"])

        for batch in batches:
            lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0))
            cut = 0
            total = size + np.cumsum(lengths)
            while cut < batch.num_rows:
                stop = min(batch.num_rows, int(np.searchsorted(total, chunk_bytes)) + 1)
                held.append(batch.slice(cut, stop - cut))
                size = int(total[stop - 1])
                if size >= chunk_bytes:
                    yield flush()
                    total = total - total[stop - 1]
                cut = stop
        if held:
            yield flush()

    return docs.mapInArrow(returning(run), "chunk long, blob binary")


def _rows(rows: list[tuple], names: list[str], kinds: dict) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(columns, names)], names=names)


_BLOBS = {n: pa.binary() for n in ("keys", "more", "codes", "text", "fp")}


def _counted_keys(bits: int, text_col: str):
    """(kind, chunk, segment, keys, more): each chunk's distinct anchors (kind 0) with a piece of each and how many
    pieces it has, and its distinct pieces (kind 1) with their number."""

    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name, piece, *_ = chunk_pieces(unpack(blob, text_col)[1])
                pieces, first, times = np.unique(piece, return_index=True, return_counts=True)
                names, place, kinds = np.unique(name[first], return_index=True, return_counts=True)
                rows = []
                for kind, keys, more in ((0, names, [pieces[place], kinds.astype("<i4")]), (1, pieces, [times.astype("<i4")])):
                    segment, cut = _deal(keys, bits)
                    for s, a, b in zip(segment.tolist(), cut, cut[1:]):
                        rows.append((kind, chunk, s, keys[a:b].tobytes(), b"".join(x[a:b].tobytes() for x in more)))
                yield _rows(rows, ["kind", "chunk", "segment", "keys", "more"], _BLOBS)

    return run


def _codes(table: pa.Table) -> pa.Table:
    """A byte for each key of each chunk. Anchors: 0 with one distinct piece in all, else 1 + log2 of the pieces.
    Pieces: 0 if met once, 1 for the chunk that stands for a repeated piece, 2 for the others."""
    kind, segment = table.column("kind")[0].as_py(), table.column("segment")[0].as_py()
    keys = [np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]
    chunk = table.column("chunk").to_numpy()
    cut = np.cumsum([0, *map(len, keys)])
    flat = np.concatenate(keys)
    more = table.column("more").to_pylist()
    found, place = np.unique(flat, return_inverse=True)
    if kind == 0:
        pieces = np.concatenate([np.frombuffer(x[: 8 * len(k)], dtype=np.uint64) for x, k in zip(more, keys)])
        kinds = np.concatenate([np.frombuffer(x[8 * len(k) :], dtype="<i4") for x, k in zip(more, keys)])
        low, high = np.full(len(found), np.iinfo(np.uint64).max, dtype=np.uint64), np.zeros(len(found), dtype=np.uint64)
        np.minimum.at(low, place, pieces)
        np.maximum.at(high, place, pieces)
        several = np.bincount(place, weights=kinds, minlength=len(found))
        most = np.zeros(len(found), dtype=np.int64)
        np.maximum.at(most, place, kinds)
        code = np.where((low != high) | (most > 1), 1 + np.log2(several).astype(np.int64), 0)[place]
    else:
        times = np.concatenate([np.frombuffer(x, dtype="<i4") for x in more])
        total = np.bincount(place, weights=times, minlength=len(found))
        owner = np.full(len(found), np.iinfo(np.int64).max)
        row_chunk = np.repeat(chunk, np.diff(cut))
        np.minimum.at(owner, place, row_chunk)
        code = np.where(total[place] < 2, 0, np.where(owner[place] == row_chunk, 1, 2))
    code = code.astype(np.uint8)
    rows = [(kind, int(c), segment, code[a:b].tobytes()) for c, a, b in zip(chunk, cut, cut[1:])]
    return pa.Table.from_batches([_rows(rows, ["kind", "chunk", "segment", "codes"], _BLOBS)])


def _joined_codes(parts: list[dict], kind: int) -> np.ndarray:
    own = sorted((p["segment"], p["codes"]) for p in parts if p["kind"] == kind)
    return np.frombuffer(b"".join(c for _, c in own), dtype=np.uint8)


def _open_pieces(text_col: str, block_pieces: int):
    """One copy of each piece that must be sorted, with its chunk and number there."""

    def run(batches):
        for batch in batches:
            for chunk, blob, parts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "blob", "parts"))):
                texts = unpack(blob, text_col)[1]
                name, piece, low, high, at = chunk_pieces(texts)
                _, first, place = np.unique(piece, return_index=True, return_inverse=True)
                anchors = np.unique(name, return_inverse=True)[1]
                code, state = _joined_codes(parts, 0)[anchors], _joined_codes(parts, 1)[place]
                leads = np.zeros(len(name), dtype=bool)
                leads[first] = True
                data = b"".join(texts)
                take = np.flatnonzero((code > 0) & ((state == 0) | (state == 1) & leads))
                over = np.maximum(code.astype(np.int64) - 1 - (block_pieces.bit_length() - 1), 0)
                salt = (mix(piece) & ((np.uint64(1) << over.astype(np.uint64)) - np.uint64(1))).astype(np.int64)
                rows = [
                    (int(name[i].view(np.int64)), int(salt[i]), int(over[i]), chunk, int(i), int(at[i] - low[i]), bool(state[i] == 0), data[low[i] : high[i] + LENGTH])
                    for i in take
                ]
                for a in range(0, max(len(rows), 1), 4096):
                    yield _rows(rows[a : a + 4096], ["anchor", "salt", "over", "chunk", "number", "lead", "single", "text"], {**_BLOBS, "single": pa.bool_()})

    return run


#: A distinct string of a block: its fingerprint, where it starts, and whether that start is to be told if others have it.
STRING = np.dtype([("fp", "<u8"), ("chunk", "<i8"), ("number", "<i4"), ("start", "<i4"), ("open", "<u1")])


def spans_of(owner: np.ndarray, offset: np.ndarray) -> list[tuple[int, list[int]]]:
    """(owner, [a, b, ...]): runs of neighbouring offsets of each owner; both arrays sorted together."""
    if not len(owner):
        return []
    cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])
    low, high = offset[cut], offset[np.r_[cut[1:], len(offset)] - 1] + 1
    edges = np.stack([low, high], axis=1).reshape(-1)
    first = np.flatnonzero(np.r_[True, np.diff(owner[cut]) != 0])
    return [(int(owner[cut[a]]), edges[2 * a : 2 * b].tolist()) for a, b in zip(first, np.r_[first[1:], len(cut)])]


def sort_pieces(rows: dict) -> tuple[list[tuple], np.ndarray]:
    """(chunk, number, runs) of the pieces of some whole blocks, and the distinct strings of anchors that several blocks share.

    ``runs`` are ranges [a, b) of starts that repeat inside the block."""
    texts = rows["text"]
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(np.r_[0, -(-size // V) * V])
    total = int(begin[-1])
    text = np.zeros(total + LENGTH + 64, dtype=np.uint8)
    for b, t in zip(begin.tolist(), texts):
        text[b : b + len(t)] = np.frombuffer(t, dtype=np.uint8)
    n_starts = size - LENGTH + 1
    owner = np.repeat(np.arange(len(size)), n_starts)
    offset = np.arange(n_starts.sum()) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
    starts = begin[:-1][owner] + offset
    anchor, salt = np.array(rows["anchor"], dtype=np.int64), np.array(rows["salt"], dtype=np.int64)
    lead = np.array(rows["lead"], dtype=np.int64)
    block = np.cumsum(np.r_[False, (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])])
    bucket = block[owner] * (1 << 20) + (lead[owner] - offset)
    order = sort_block(text, total, starts, bucket)
    same = equal_runs(text, starts[order], bucket[order], LENGTH)
    repeated = np.zeros(len(starts), dtype=bool)
    repeated[order[same]] = True
    repeated[order[np.flatnonzero(same) - 1]] = True

    single = np.array(rows["single"], dtype=bool)
    told = np.flatnonzero(repeated & single[owner])
    runs = [(rows["chunk"][i], rows["number"][i], r) for i, r in spans_of(owner[told], offset[told])]
    lone = order[np.flatnonzero(~same & (np.array(rows["over"])[owner[order]] > 0))]
    strings = np.empty(len(lone), dtype=STRING)
    if len(lone):
        own, at = owner[lone], starts[lone]
        strings["fp"] = mix(Hasher(text).between(at, at + LENGTH) + mix(anchor[own].view(np.uint64) + (lead[own] - offset[lone]).astype(np.uint64)))
        strings["chunk"], strings["number"] = np.array(rows["chunk"], dtype=np.int64)[own], np.array(rows["number"])[own]
        strings["start"], strings["open"] = offset[lone], single[own] & ~repeated[lone]
    return runs, strings


def shared_strings(table: pa.Table) -> pa.Table:
    """(chunk, number, runs): the starts to be told whose string several blocks have, from one segment of fingerprints."""
    rows = np.concatenate([np.frombuffer(x, dtype=STRING) for x in table.column("strings").to_pylist()])
    _, place, times = np.unique(rows["fp"], return_inverse=True, return_counts=True)
    rows = rows[(times[place] > 1) & (rows["open"] == 1)]
    rows = rows[np.lexsort((rows["start"], rows["number"], rows["chunk"]))]
    _, owner = np.unique(rows[["chunk", "number"]], return_inverse=True)
    first = np.searchsorted(owner, np.arange(owner.max(initial=-1) + 1))
    out = [(int(rows["chunk"][first[i]]), int(rows["number"][first[i]]), r) for i, r in spans_of(owner, rows["start"].astype(np.int64))]
    return pa.Table.from_batches([_rows(out, ["chunk", "number", "runs"], {"runs": pa.list_(pa.int32())})])


_SORTED = "chunk long, number long, runs array<int>, segment long, strings binary"


def _sort_blocks(block_bytes: int, bits: int):
    def run(batches):
        columns = ["anchor", "salt", "over", "chunk", "number", "lead", "single", "text"]
        kinds = {"runs": pa.list_(pa.int32()), "strings": pa.binary()}
        held: dict[str, list] = {c: [] for c in columns}
        size = 0

        def table(part: dict) -> pa.RecordBatch:
            runs, strings = sort_pieces(part)
            rows = [(*r, None, None) for r in runs]
            strings = strings[np.argsort(strings["fp"])]
            segment, cut = _deal(strings["fp"], bits)
            rows += [(None, None, None, s, strings[a:b].tobytes()) for s, a, b in zip(segment.tolist(), cut, cut[1:])]
            return _rows(rows, ["chunk", "number", "runs", "segment", "strings"], kinds)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if size >= block_bytes and (row[0], row[1]) != (held["anchor"][-1], held["salt"][-1]):
                    yield table(held)
                    held, size = {c: [] for c in columns}, 0
                for c, x in zip(columns, row):
                    held[c].append(x)
                size += len(row[-1])
        if held["text"]:
            yield table(held)

    return run


def dedup_passages(docs: DataFrame, text_col: str = "text", chunk_bytes: int = 1 << 23, block_bytes: int = 1 << 21, block_pieces: int = 512) -> DataFrame:
    """``docs`` with the kept text, and n_bytes, n_removed, n_spans, kept_sha256 in place of any columns of these names."""
    spark = docs.sparkSession
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept_sha256")
    chunks = materialize(chunked(docs, chunk_bytes, text_col))
    bits = max(6, int(np.ceil(np.log2(max(chunks.count() / 8, 1)))))
    keys = chunks.mapInArrow(returning(_counted_keys(bits, text_col)), "kind long, chunk long, segment long, keys binary, more binary")
    codes = materialize(keys.groupBy("kind", "segment").applyInArrow(_codes, "kind long, chunk long, segment long, codes binary"))
    parts = codes.groupBy("chunk").agg(F.collect_list(F.struct("kind", "segment", "codes")).alias("parts"))

    schema = "anchor long, salt long, over long, chunk long, number long, lead long, single boolean, text binary"
    pieces = chunks.join(parts, "chunk").mapInArrow(returning(_open_pieces(text_col, block_pieces)), schema)
    blocks = pieces.repartition(tasks(spark), "anchor", "salt").sortWithinPartitions("anchor", "salt")
    found = materialize(blocks.mapInArrow(returning(_sort_blocks(block_bytes, bits)), _SORTED))
    across = found.where("strings is not null").groupBy("segment").applyInArrow(shared_strings, "chunk long, number long, runs array<int>")
    runs = found.where("runs is not null").select("chunk", "number", "runs").unionByName(across)
    runs = runs.groupBy("chunk").agg(F.collect_list(F.struct("number", "runs")).alias("runs"))
    done = parts.join(runs, "chunk", "left")

    names = docs.columns
    at = names.index(text_col)

    def cut(batches):
        for batch in batches:
            for blob, parts_now, runs_now in zip(*(batch.column(c).to_pylist() for c in ("blob", "parts", "runs"))):
                rows, texts = unpack(blob, text_col)
                _, piece, low, high, _ = chunk_pieces(texts)
                state = _joined_codes(parts_now, 1)[np.unique(piece, return_inverse=True)[1]] if len(piece) else np.empty(0, np.uint8)
                data = np.frombuffer(b"".join(texts), dtype=np.uint8)
                depth = np.zeros(len(data) + 1, dtype=np.int32)
                full = state > 0
                np.add.at(depth, low[full], 1)
                np.add.at(depth, high[full] + LENGTH, -1)
                for r in runs_now or ():
                    for a, b in zip(r["runs"][::2], r["runs"][1::2]):
                        depth[low[r["number"]] + a] += 1
                        depth[low[r["number"]] + b - 1 + LENGTH] -= 1
                gone = np.cumsum(depth, out=depth)[:-1] > 0
                ends = np.cumsum([len(t) for t in texts])
                kept, count, spans, sha = [], [], [], []
                for t, end in zip(texts, ends.tolist()):
                    own = gone[end - len(t) : end]
                    n = int(own.sum())
                    left = data[end - len(t) : end][~own].tobytes() if n else t
                    count.append(n)
                    spans.append(int((own[1:] & ~own[:-1]).sum() + own[0]) if n else 0)
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left.decode("utf-8", "ignore"))
                text = pa.array([k if v else None for k, v in zip(kept, rows.column(at).is_valid().to_pylist())], pa.string())
                columns = [text if i == at else c for i, c in enumerate(rows.columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(t) for t in texts], pa.int64()), pa.array(count, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)], names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    # a chunk of short texts has no pieces and so no codes
    ready = chunks.join(done, "chunk", "left").select("blob", "parts", "runs")
    schema = T.StructType(list(docs.schema.fields))  # adding to docs.schema would change docs
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    return ready.mapInArrow(returning(cut), schema)
