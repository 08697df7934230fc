"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

A count c of an n-gram is stored as level 1 + floor(log_base(c)): the n-gram is inserted once for each level up to its
own, so repeated membership probes, level after level until one fails, give the level back. Every n-gram that was
counted is stored. The probability of a word w after v is (B + prior * P1) / (C + prior), where B is the least count of
the bigram's level, C the largest count of the context's level and P1 = (U + 1) / (Z + V + 1) with U the least count of
the word's level and Z the sum of U over the vocabulary; so probabilities never sum to more than one, but for the
filter's false positives. A context that was never met has C = 0, which leaves P1.

The filter is dealt into segments by the leading bits of an n-gram's hash; a task builds whole segments, each of as many
bits as its n-grams need. The filter stays on the cluster, whatever its size: the task that builds a segment also probes
it for the n-grams of every chunk, which were dealt there with their counts, and the levels come back. On request a filter
of at most ``broadcast_bytes`` is broadcast to the workers instead; scores are the same either way. All counts are taken
over all training documents.

Texts are tokenised once into chunks of about ``chunk_tokens`` tokens with a local dictionary; from then on only packed
arrays are shuffled: each chunk's word and bigram counts dealt by hash, and the words' totals back to their chunk.

Defined results: null text is empty text, whose only token is the end; a null id counts as training (its remainder is
not 2). Repeated rows are scored, and counted, as often as they come. An empty table gives no rows. With no training
row N and V are 0, and every token has the same base probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.langid import held_out
from panelforge.llm.scratch import materialize, text_slices

#: Hash of the end token: that of a text which no word can have.
END = xxhash.xxh64_intdigest(b" ")
LOW48 = np.uint64((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def bigram_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def pack_ids(ids: np.ndarray) -> bytes:
    """Local word ids as compressed byte planes."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_ids(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


# ---- the log-frequency filter ----


class LogBloom:
    """Segments of a filter by leading hash bits, end to end in ``flat``; segment s begins at byte ``first[s]``."""

    def __init__(self, flat: np.ndarray, first: np.ndarray, base: float, probes: int):
        self.flat, self.first, self.base, self.probes = flat, first, base, probes

    @staticmethod
    def joined(blobs: dict[int, bytes], segments: int, base: float, probes: int) -> LogBloom:
        sizes = [len(blobs.get(s, b"")) for s in range(segments)]
        flat = np.frombuffer(b"".join(blobs.get(s, b"") for s in range(segments)), dtype=np.uint8)
        return LogBloom(flat, np.cumsum([0, *sizes]), base, probes)

    @staticmethod
    def positions(keys: np.ndarray, level: int, probes: int, bits: np.ndarray) -> Iterator[np.ndarray]:
        first = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
        step = mix(first ^ np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
        for i in range(probes):
            yield ((first + np.uint64(i) * step) % bits).astype(np.int64)

    @staticmethod
    def levels(counts: np.ndarray, base: float) -> np.ndarray:
        return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9), 0).astype(np.int64)

    @classmethod
    def segment(cls, keys: np.ndarray, counts: np.ndarray, base: float, probes: int, bits_per_key: int) -> bytes:
        """One segment that holds the given n-grams."""
        level = cls.levels(counts, base)
        size = max(8, -(-int(level.sum()) * bits_per_key // 8))
        out = np.zeros(8 * size, dtype=bool)
        for j in range(1, int(level.max(initial=0)) + 1):
            for at in cls.positions(keys[level >= j], j, probes, np.uint64(8 * size)):
                out[at] = True
        return np.packbits(out, bitorder="little").tobytes()

    def level_of(self, hashes: np.ndarray) -> np.ndarray:
        """Stored level of each n-gram, found by probing level after level."""
        bits = (len(self.first) - 1).bit_length() - 1
        segment = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        begin, size = self.first[segment], np.diff(self.first)[segment]
        level, live, keys = np.zeros(len(hashes), np.int64), np.flatnonzero(size), hashes & LOW48
        while len(live):
            at_level = int(level[live[0]]) + 1
            held = np.arange(len(live))
            for at in self.positions(keys[live], at_level, self.probes, (8 * size[live]).astype(np.uint64)):
                at = at[held]
                byte = self.flat[begin[live[held]] + (at >> 3)]
                held = held[(byte >> (at & 7).astype(np.uint8)) & 1 == 1]
                if not len(held):
                    break
            live = live[held]
            level[live] = at_level
        return level


def least_count(level: np.ndarray, base: float) -> np.ndarray:
    return np.where(level > 0, np.ceil(base ** (level - 1.0) - 1e-6), 0.0)


def largest_count(level: np.ndarray, base: float) -> np.ndarray:
    return np.maximum(np.ceil(base ** level.astype(float) - 1e-6) - 1, 0.0)


# ---- chunks of tokenised text ----

CHUNK = "chunk long, n_tokens array<int>, held array<boolean>, words binary, counts binary, tokens binary"


def tokenised(docs: DataFrame, chunk_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """One row per chunk: its documents, its dictionary (hashes in ascending order, training counts), its tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        first, number = TaskContext.get().partitionId() << 32, 0
        ids, held, sizes, parts, known = [], [], [], [], {b" ": 0}

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, held, sizes, parts, known
            tokens = np.concatenate(parts)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), dtype=np.uint64, count=len(known))
            order = np.argsort(hashes)
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            tokens = place[tokens]
            counts = np.bincount(tokens[~np.repeat(np.array(held), sizes)], minlength=len(order))
            row = [[first + number], [ids], [sizes], [held], [hashes[order].tobytes()], [counts.astype("<i4").tobytes()], [pack_ids(tokens)]]
            types = [pa.int64(), pa.list_(id_type), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary()]
            number += 1
            ids, held, sizes, parts, known = [], [], [], [], {b" ": 0}
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names=["chunk", "ids", "n_tokens", "held", "words", "counts", "tokens"])

        def add(group: list[list[bytes]]) -> None:
            fresh = set().union(*group).difference(known)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            place = known.__getitem__
            for words in group:
                parts.append(np.fromiter(map(place, words), dtype=np.int32, count=len(words)))
                sizes.append(len(words))

        total = 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            batch_ids, batch_held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for start, texts in text_slices(batch, 1):
                group = [[*(t or "").encode().lower().split(), b" "] for t in texts]
                add(group)
                ids += batch_ids[start : start + len(texts)]
                held += batch_held[start : start + len(texts)]
                total += sum(map(len, group))
                if total >= chunk_tokens:
                    yield flush()
                    total = 0
        if ids:
            yield flush()

    rows = docs.select(id_col, text_col, held_out(id_col, 7).alias("held"))
    return rows.mapInArrow(run, CHUNK.replace("chunk long,", f"chunk long, ids array<{kind}>,"))


def _deal(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment numbers that occur in ascending ``hashes`` and where each begins."""
    segment = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    begin = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(segment) else np.empty(0, np.int64)
    return segment[begin], np.r_[begin, len(segment)]


def _each(batch: pa.RecordBatch) -> Iterator[list]:
    """Rows one at a time, as a row holds a whole chunk."""
    for i in range(batch.num_rows):
        yield [column[i].as_py() for column in batch.columns]


def _dealt_words(bits: int):
    def run(batches):
        for batch in batches:
            for chunk, words, counts in _each(batch):
                hashes, counts = np.frombuffer(words, dtype=np.uint64), np.frombuffer(counts, dtype="<i4")
                segment, cut = _deal(hashes, bits)
                rows = [(chunk, s, hashes[a:b].tobytes(), counts[a:b].tobytes()) for s, a, b in zip(segment.tolist(), cut, cut[1:])]
                yield _batch(rows, ["chunk", "segment", "hashes", "counts"])

    return run


def _dealt_bigrams(bits: int):
    """(chunk, segment, keys, counts): each chunk's distinct bigrams and how often its training documents have them."""

    def run(batches):
        for batch in batches:
            for chunk, n_tokens, held, words, tokens in _each(batch):
                found, place = np.unique(_bigrams_of(words, tokens)[3], return_inverse=True)
                counts = np.bincount(place[~np.repeat(np.array(held, dtype=bool), n_tokens)], minlength=len(found))
                segment, cut = _deal(found, bits)
                rows = [(chunk, s, _bytes48(found[a:b]), pack_ids(counts[a:b])) for s, a, b in zip(segment.tolist(), cut, cut[1:])]
                yield _batch(rows, ["chunk", "segment", "keys", "counts"])

    return run


def _bytes48(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from48(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {n: pa.int64() for n in ("chunk", "segment", "n", "n_sum", "mass")}
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.binary())) for c, n in zip(columns, names)], names=names)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their sums, and for each input its place among them."""
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights=counts, minlength=len(found)).astype(np.int64), place


def _word_totals(base: float, probes: int, bits_per_key: int):
    """Totals and filter levels of each chunk's words of one segment; the row without a chunk has the segment's sums."""

    def run(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, dtype=np.uint64) for x in table.column("hashes").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, dtype="<i4") for x in table.column("counts").to_pylist()])
        found, total, place = _summed(np.concatenate(hashes), counts)
        segment = table.column("segment")[0].as_py()
        seen = total > 0
        bloom = LogBloom.joined({0: LogBloom.segment(found[seen] & LOW48, total[seen], base, probes, bits_per_key)}, 1, base, probes)
        level = bloom.level_of(found)
        cut = np.cumsum([0, *map(len, hashes)])
        each, level_each = total[place].astype("<i8"), level[place].astype(np.uint8)
        rows = [(c, segment, each[a:b].tobytes(), level_each[a:b].tobytes(), 0, 0, 0) for c, a, b in zip(table.column("chunk").to_pylist(), cut, cut[1:])]
        rows.append((None, segment, None, None, int(seen.sum()), int(total.sum()), int(least_count(LogBloom.levels(total, base), base).sum())))
        return pa.Table.from_batches([_batch(rows, ["chunk", "segment", "totals", "levels", "n", "n_sum", "mass"])])

    return run


def _bigram_levels(base: float, probes: int, bits_per_key: int, whole: bool):
    """Filter levels of each chunk's bigrams of one segment; if ``whole``, the row without a chunk has the segment itself."""

    def run(table: pa.Table) -> pa.Table:
        keys = [_from48(x) for x in table.column("keys").to_pylist()]
        found, total, place = _summed(np.concatenate(keys), np.concatenate([unpack_ids(x) for x in table.column("counts").to_pylist()]))
        segment, seen = table.column("segment")[0].as_py(), total > 0
        bits = LogBloom.segment(found[seen], total[seen], base, probes, bits_per_key)
        level = LogBloom.joined({0: bits}, 1, base, probes).level_of(found).astype(np.uint8)[place]
        cut = np.cumsum([0, *map(len, keys)])
        rows = [(c, segment, level[a:b].tobytes(), None) for c, a, b in zip(table.column("chunk").to_pylist(), cut, cut[1:])]
        if whole:
            rows.append((None, segment, None, bits))
        return pa.Table.from_batches([_batch(rows, ["chunk", "segment", "levels", "bits"])])

    return run


def _bigrams_of(words: bytes, tokens: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, tokens, the token before each (the end before the first), and hashes of the bigrams."""
    hashes, tokens = np.frombuffer(words, dtype=np.uint64), unpack_ids(tokens)
    before = np.r_[np.searchsorted(hashes, np.uint64(END)), tokens[:-1]]
    return hashes, tokens, before, bigram_hash(hashes[before], hashes[tokens])


def score_documents(
    docs: DataFrame,
    chunk_tokens: int = 1 << 19,
    broadcast_bytes: int = 0,
    bits_per_key: int = 10,
    base: float = 1.5,
    probes: int = 5,
    prior: float = 300.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = materialize(tokenised(docs, chunk_tokens, id_col, text_col))
    bits = max(8, int(np.ceil(np.log2(max(chunks.count() / 8, 1)))))

    words = chunks.select("chunk", "words", "counts").mapInArrow(_dealt_words(bits), "chunk long, segment long, hashes binary, counts binary")
    words = words.groupBy("segment").applyInArrow(_word_totals(base, probes, bits_per_key), "chunk long, segment long, totals binary, levels binary, n long, n_sum long, mass long")
    words = materialize(words)
    size = words.where("chunk is null").agg(F.sum("n").alias("v"), F.sum("n_sum").alias("n"), F.sum("mass").alias("mass")).first()
    n_train, n_words, mass = (int(size[c] or 0) for c in ("n", "v", "mass"))

    pairs = chunks.select("chunk", "n_tokens", "held", "words", "tokens").mapInArrow(_dealt_bigrams(bits), "chunk long, segment long, keys binary, counts binary")
    pairs = pairs.groupBy("segment").applyInArrow(_bigram_levels(base, probes, bits_per_key, broadcast_bytes > 0), "chunk long, segment long, levels binary, bits binary")
    pairs = materialize(pairs)
    parts = words.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("segment", "totals", "levels")).alias("parts"))
    joined = chunks.select("chunk", "ids", "n_tokens", "held", "words", "tokens").join(parts, "chunk")
    segments = pairs.where("chunk is null")
    if broadcast_bytes and (segments.agg(F.sum(F.length("bits"))).first()[0] or 0) <= broadcast_bytes:
        shared = spark.sparkContext.broadcast(LogBloom.joined({r["segment"]: r["bits"] for r in segments.toLocalIterator()}, 1 << bits, base, probes))
        joined = joined.withColumn("joint", F.lit(None).cast("array<struct<segment:bigint,levels:binary>>"))
    else:
        shared = None
        told = pairs.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("segment", "levels")).alias("joint"))
        joined = joined.join(told, "chunk")
    floor = np.log10(n_train + n_words + 1.0)

    def gathered(segments: list[dict], name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(x[name] for x in sorted(segments, key=lambda x: x["segment"])), dtype=kind)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                totals, level = gathered(row["parts"], "totals", "<i8"), gathered(row["parts"], "levels", np.uint8).astype(np.int64)
                hashes, tokens, before, pair = _bigrams_of(row["words"], row["tokens"])
                sizes = np.array(row["n_tokens"], dtype=np.int64)
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                found, place = np.unique(pair, return_inverse=True)
                pair_level = shared.value.level_of(found) if shared else gathered(row["joint"], "levels", np.uint8).astype(np.int64)
                single = (least_count(level, base) + 1) / (mass + n_words + 1.0)
                most = largest_count(level, base)
                # a bigram is never more frequent than its parts
                joint = np.minimum(least_count(pair_level, base)[place], np.minimum(most[before], most[tokens]))
                chance = (joint + prior * single[tokens]) / (most[before] + prior)
                known = (totals > 0)[tokens]
                add = lambda x: np.add.reduceat(x, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(row["held"]), pa.array(sizes), pa.array(add(known.astype(np.int64))), pa.array(np.full(len(sizes), n_train)), pa.array(add((np.log10(totals + 1.0) - floor)[tokens])), pa.array(add(np.log10(chance)))],
                    names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return joined.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
