"""Cost-balanced packing of tokenised documents into fixed-length sequences.

The cost of a piece of n tokens is ``linear * n + quadratic * n**2`` (feed-forward and attention work). Each task packs
groups of about ``group_tokens`` tokens, taken from its own rows, so nothing is shuffled and no group grows with the
input. In a group a document gives as many whole sequences as it can; the rests go, longest first, to the sequence of
lowest cost that still has room. Where none has, the rest is cut over the cheapest open sequences. Capacities are
``length`` each, and powers of two for what is left of the group, so that no sequence needs padding.

Null texts are empty texts: their only id is the end token; an empty table gives no rows. Equal, repeated and null ids are documents of their own.
Sequence ids combine the task's number and a counter; a repeated task gives the same ids to the same rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from panelforge.llm.bpe_tree import Encoder, _field, encoder_of
from panelforge.llm.scratch import returning, text_slices

COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def capacities(total: int, length: int) -> list[int]:
    """Sequences that hold ``total`` tokens exactly: whole ones, then powers of two for the rest."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(sizes: list[int], length: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, tokens, sequence, offset) pieces of documents of the given sizes."""
    pieces, rests, n_full = [], [], 0
    for doc, size in enumerate(sizes):
        whole = size // length
        for k in range(whole):
            pieces.append((doc, k * length, length, n_full, 0))
            n_full += 1
        if size % length:
            rests.append((size % length, doc, whole * length))
    room = np.array(capacities(sum(r[0] for r in rests), length), dtype=np.int64)
    fill, cost = np.zeros(len(room), dtype=np.int64), np.zeros(len(room))
    for size, doc, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        while size:
            fits = room >= size
            which = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            part = min(size, int(room[which]))
            pieces.append((doc, start, part, n_full + which, int(fill[which])))
            cost[which] += linear * part + quadratic * part * part
            fill[which] += part
            room[which] -= part
            start, size = start + part, size - part
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    end_id: int = 2,
    linear: float = 1.0,
    quadratic: float = 1 / 4096,
    group_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches):
        encoder = encoder_of(Encoder, tokenizer)
        first = TaskContext.get().partitionId() << 40
        held_ids: list = []
        held: list[bytes] = []
        n_held = 0
        end = end_id.to_bytes(4, "little")

        def flush():
            nonlocal first, held_ids, held, n_held
            pieces = assign([len(x) // 4 for x in held], length, linear, quadratic)
            crc = [zlib.crc32(held[d][4 * s : 4 * (s + n)]) for d, s, n, _, _ in pieces]
            d, s, n, q, o = (list(x) for x in zip(*pieces))
            table = pa.RecordBatch.from_arrays(
                [pa.array([held_ids[i] for i in d], kind), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array([len(held[i]) // 4 for i in d], pa.int64()), pa.array([first + i for i in q], pa.int64()), pa.array(o, pa.int64())],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            first += max(q) + 1
            held_ids, held, n_held = [], [], 0
            return table

        for batch in batches:
            kind = batch.schema.field(0).type
            ids, at = batch.column(0).to_pylist(), 0
            for _, texts in text_slices(batch, 1):
                for pieces in (p for group in encoder.batches([t or "" for t in texts]) for p in group):
                    held.append(encoder.ids(pieces) + end)
                    held_ids.append(ids[at])
                    at += 1
                    n_held += len(held[-1]) // 4
                    if n_held >= group_tokens:
                        yield flush()
        if held:
            yield flush()

    return docs.select(id_col, text_col).mapInArrow(returning(run), f"{_field(docs, id_col)}, {COLUMNS}")
