"""Similarity digests of improbable features.

Every window of ``WINDOW`` bytes is a feature; its entropy, in ``BINS`` steps, is rare or common over the whole corpus.
Windows are ranked by that rarity. Within each run of ``RUN`` neighbouring windows the rarest (leftmost of ties) is
marked; windows marked ``least_marks`` times or more are the text's improbable features. Their hashes go, in order of
place, into a chain of Bloom filters of ``BLOOM_BITS`` bits with ``PER_BLOOM`` features each; the digest is the chain in
hexadecimal after the number of features of its last filter.

Likeness of two digests: for each filter of the shorter chain the best normalised bit overlap with a filter of the
other one (0 at what chance gives, 1 where one's bits hold the other's), averaged over its filters. Equal digests have
likeness 1, a digest without features has likeness 0 to any other.

Defined results: null text is empty text; a text shorter than a window is one feature, an empty one none. Repeated ids
follow each other by text. A null id comes before all others. Long texts are read whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.scratch import tasks

WINDOW, RUN, BINS = 64, 64, 1024
BLOOM_BITS, PER_BLOOM, PROBES = 2048, 160, 5
SCALE = 1 << 20
#: Steps of c * log2(c) from c - 1 to c, in fixed point, so that sums are exact.
_F = np.array([0.0, *(c * np.log2(c) for c in range(1, WINDOW + 2))])
GAIN = np.r_[0, np.round(_F[1:] * SCALE).astype(np.int64) - np.round(_F[:-1] * SCALE).astype(np.int64)]
MULTIPLIER = 0x9E3779B97F4A7C15


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Entropy step of each window of ``data`` (uint8), from counts that move along with the window."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.int32)
    ahead, behind = np.ones(len(data), dtype=np.uint8), np.ones(len(data), dtype=np.uint8)
    for k in range(1, WINDOW):
        same = (data[:-k] == data[k:]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    # what the window loses at its first byte and gains behind its last
    out, into = GAIN[ahead[: n - 1]], GAIN[behind[WINDOW:]]
    first = np.bincount(data[:WINDOW])
    start = np.round(_F[first] * SCALE).astype(np.int64).sum()
    total = np.cumsum(np.r_[start, into - out])
    # total is WINDOW * (6 - entropy) in fixed point
    full = int(round(_F[WINDOW] * SCALE))
    return np.clip((full - total) * (BINS - 1) // full, 0, BINS - 1).astype(np.int32)


def sliding_least(keys: np.ndarray, run: int) -> np.ndarray:
    """Least of each ``run`` neighbours (fewer keys: of all), by doubling."""
    if len(keys) <= run:
        return keys.min(keepdims=True) if len(keys) else keys
    least, width = keys, 1
    while 2 * width <= run:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = run - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def features(data: np.ndarray, rank: np.ndarray, least_marks: int) -> np.ndarray:
    """Hashes of a text's improbable windows, in order of place."""
    if len(data) < WINDOW:
        return np.array([int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little")], dtype=np.uint64) if len(data) else np.empty(0, np.uint64)
    keys = rank[entropy_bins(data)].astype(np.int64) << 40 | np.arange(len(data) - WINDOW + 1)
    marked, marks = np.unique(sliding_least(keys, RUN) & ((1 << 40) - 1), return_counts=True)
    at = marked[marks >= least_marks]
    if not len(at):
        at = marked[np.argsort(-marks, kind="stable")[:1]]
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at].copy().view("<u8")
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(words.shape[1]):
        value = (value ^ words[:, k]) * np.uint64(MULTIPLIER)
        value ^= value >> np.uint64(29)
    return value


def digest(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Chain of Bloom filters (rows of bits) and the number of features in the last."""
    if not len(hashes):
        return np.zeros((0, BLOOM_BITS), dtype=bool), 0
    chain = np.zeros((-(-len(hashes) // PER_BLOOM), BLOOM_BITS), dtype=bool)
    row = np.arange(len(hashes)) // PER_BLOOM
    for k in range(PROBES):
        chain[row, (hashes >> np.uint64(12 * k) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)] = True
    return chain, len(hashes) - PER_BLOOM * (len(chain) - 1)


def digest_text(chain: np.ndarray, last: int) -> str:
    return f"{last:03d}:" + np.packbits(chain, axis=1).tobytes().hex()


def parse_digest(text: str) -> tuple[np.ndarray, int]:
    last, bits = text.split(":")
    raw = np.frombuffer(bytes.fromhex(bits), dtype=np.uint8).reshape(-1, BLOOM_BITS // 8)
    return np.unpackbits(raw, axis=1).astype(bool), int(last)


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> float:
    """Normalised bit overlap of two digests, 0 to 1, the same both ways."""
    (x, x_last), (y, y_last) = a, b
    if x.shape == y.shape and x_last == y_last and (x == y).all():
        return 1.0
    if not len(x) or not len(y):
        return 0.0

    def one_way(p: np.ndarray, q: np.ndarray) -> float:
        own, other = p.sum(axis=1).astype(float), q.sum(axis=1).astype(float)
        common = p.astype(np.float32) @ q.astype(np.float32).T
        most = np.minimum(own[:, None], other[None, :])
        chance = own[:, None] * other[None, :] / BLOOM_BITS
        score = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0)
        return float(score.max(axis=1).mean())

    if len(x) == len(y):
        return min(1.0, (one_way(x, y) + one_way(y, x)) / 2)
    return one_way(x, y) if len(x) < len(y) else one_way(y, x)


def rarity_ranks(docs: DataFrame, text_col: str) -> np.ndarray:
    """Rank of each entropy step by its frequency over all windows of all texts, rarest first, ties to the lower step."""

    def run(batches):
        count = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                count += np.bincount(entropy_bins(np.frombuffer((text or "").encode(), dtype=np.uint8)), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(count)], names=["bin", "n"])

    rows = docs.select(text_col).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(BINS, dtype=np.int64)
    for r in rows:
        count[r["bin"]] = r["n"]
    rank = np.empty(BINS, dtype=np.int64)
    rank[np.lexsort((np.arange(BINS), count))] = np.arange(BINS)
    return rank


def with_next(docs: DataFrame, blocks: int, id_col: str, text_col: str) -> DataFrame:
    """(block, lead, id, text) with each block of neighbouring ids in order; the row after a block's last comes again at its end
    as ``lead``, so that no task needs another's rows. The last document is followed by the first."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = sorted(set(rows.where("id is not null").approxQuantile("id", [k / blocks for k in range(1, blocks)], 0.2 / blocks))) if blocks > 1 else []
    block = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("id"))) if cuts else F.lit(0)
    rows = rows.withColumn("block", F.when(F.col("id").isNull(), 0).otherwise(block))
    # the first document of each block: one row for each block
    first = rows.groupBy("block").agg(F.min(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"))).alias("f")).orderBy("block").collect()
    if not first:
        return rows.withColumn("lead", F.lit(False))
    before = {b["block"]: first[i - 1]["block"] for i, b in enumerate(first)}
    table = F.create_map(*[x for r in first for x in (F.lit(r["block"]), F.struct(F.lit(r["f"]["k"]).alias("k"), F.lit(r["f"]["h"]).alias("h"), F.lit(before[r["block"]]).alias("to")))])
    own = table[F.col("block")]
    is_first = (F.coalesce("id", F.lit(-(1 << 63))) == own["k"]) & (F.xxhash64("text") == own["h"])
    copies = F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("lead")), F.when(is_first, F.struct(own["to"].alias("block"), F.lit(True).alias("lead"))))
    spread = rows.withColumn("copy", F.explode(F.array_compact(copies))).select("copy.block", "copy.lead", "id", "text")
    return spread


def digests(docs: DataFrame, least_marks: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rank = spark.sparkContext.broadcast(rarity_ranks(docs, text_col))
    blocks = tasks(spark)
    order = with_next(docs, blocks, id_col, text_col)
    order = order.repartition(blocks, "block").sortWithinPartitions("block", "lead", "id", F.xxhash64("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        ranks = rank.value
        marks = lambda text: digest(features(np.frombuffer(text.encode(), dtype=np.uint8), ranks, least_marks))
        held = None
        out: list[tuple] = []

        def close(doc, text, own, follow_text, follow):
            quarter = len(text) // 4
            edited = text[: len(text) - quarter] + follow_text[:quarter]
            changed = marks(edited)
            return doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), digest_text(*own), digest_text(*changed), likeness(own, changed), likeness(own, follow)

        def table() -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            columns = list(zip(*out)) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            id_type = batch.schema.field("id").type
            for block, lead, doc, text in zip(*(batch.column(c).to_pylist() for c in ("block", "lead", "id", "text"))):
                if lead and (held is None or held[0] != block or held[4]):
                    continue  # copies of a block's first row beyond one
                own = marks(text)
                if held is not None and held[0] == block:
                    out.append(close(held[1], held[2], held[3], text, own))
                held = (block, doc, text, own, lead)
            yield table()
            out = []

    return order.mapInArrow(run, f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
