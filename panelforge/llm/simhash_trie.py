"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints: one bit per position, set if it is set in over half of the shingles' XXH64 values. Two fingerprints link
at ``budget`` or fewer differing bits. Equal fingerprints are one entry from the start.

The trie's pairs are dealt out by parts: with ``budget`` + 1 parts of the bits, linked fingerprints agree on one part
at least, so each part gives a forest whose trees share that part and meet nowhere else. A tree above ``hot_limit``
entries is parted again by its free bits, which keeps every pair (each still agrees on one of the new parts), so no
tree grows with the largest group of near copies until nearly all bits agree. Inside a task the trees are sorted arrays; a frontier of
node pairs goes down bit by bit, adds the bits that differ, and drops a pair once it exceeds the budget. A tree gives
a spanning forest of its links, never all pairs; components are then joined over all trees. What bounds the trees of
the last level is that their entries are distinct and differ in few free bits: 27 at the third.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelforge.llm.bpe_tree import _field
from panelforge.llm.components import connected_components
from panelforge.llm.scratch import discard, materialize, returning, tasks, text_slices

BITS = 64


def simhash(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint; no word: 0; fewer words than a shingle: the whole sequence is the only one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[shingle - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts, stops)], np.uint64, len(stops))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, fp: the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            values = np.array([simhash(t, shingle) for _, texts in text_slices(batch, 1) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(returning(run), f"{_field(docs, id_col)}, fp long")


def parts(mask: int, n: int) -> list[int]:
    """``mask`` plus each of ``n`` near-equal runs of the bits it leaves free."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = np.linspace(0, len(free), n + 1).round().astype(int)
    return [mask | sum(1 << b for b in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Each row once for every new mask of its own mask; rows without a mask yet have mask 0."""
    table = F.create_map(*[x for m, new in masks.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in new]))])
    spread = rows.select("fp", "rep", F.explode(table[F.col("mask")]).alias("mask"))
    return spread.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))


def trie_links(group: np.ndarray, fps: np.ndarray, budget: int, flush: int = 1 << 21) -> np.ndarray:
    """Label per entry: the least index joined to it inside its group. Entries are sorted by (group, fp)."""
    label = np.arange(len(fps))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def unite() -> None:
        if not found:
            return
        a, b = (np.concatenate(x) for x in zip(*found))
        found.clear()
        while True:
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                return
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while (label != (up := label[label])).any():
                label[:] = up

    def settle(al, ah, bl, bh, err):
        """Node pairs of single leaves are decided; those with more go on."""
        single = (ah - al == 1) & (bh - bl == 1)
        pair = single & (al != bl)
        a, b = al[pair], bl[pair]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= budget
        if near.any():
            found.append((a[near], b[near]))
            if sum(len(x[0]) for x in found) > flush:
                unite()
        go = ~single
        return al[go], ah[go], bl[go], bh[go], err[go]

    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
    last = np.r_[first[1:], len(group)]
    al, ah, err = first, last, np.zeros(len(first), dtype=np.int64)
    al, ah, bl, bh, err = settle(al, ah, al, ah, err)
    for bit in reversed(range(BITS)):
        if not len(al):
            break
        ones = np.r_[0, np.cumsum(fps >> np.uint64(bit) & np.uint64(1), dtype=np.int64)]
        am, bm = ah - (ones[ah] - ones[al]), bh - (ones[bh] - ones[bl])
        own = al == bl
        nodes = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1), *[tuple(x[~own] for x in (am, ah, bl, bm, err + 1))]]
        al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*nodes))
        keep = (ah > al) & (bh > bl) & (err <= budget)
        al, ah, bl, bh, err = settle(al[keep], ah[keep], bl[keep], bh[keep], err[keep])
    unite()
    return label


def _join_trees(budget: int, chunk: int = 1 << 18):
    def links(frame: pd.DataFrame) -> pa.RecordBatch:
        fps = frame["fp"].to_numpy().view(np.uint64)
        mask, part = frame["mask"].to_numpy(), frame["part"].to_numpy()
        group = np.cumsum(np.r_[False, (mask[1:] != mask[:-1]) | (part[1:] != part[:-1])])
        order = np.lexsort((fps, group))
        rep, group, fps = frame["rep"].to_numpy()[order], group[order], fps[order]
        # two hot parents can deal a row into the same tree; a leaf that holds it twice would never be single
        fresh = np.r_[True, (group[1:] != group[:-1]) | (fps[1:] != fps[:-1])]
        kept = np.flatnonzero(fresh)
        label = kept[trie_links(group[kept], fps[kept], budget)][np.cumsum(fresh) - 1]
        at = np.flatnonzero(rep != rep[label])
        return pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[label[at]])], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch.to_pandas())
            if sum(map(len, held)) >= chunk:
                frame = pd.concat(held, ignore_index=True)
                end = frame.iloc[-1]
                rest = (frame["mask"] == end["mask"]) & (frame["part"] == end["part"])
                held = [frame[rest]]
                if not rest.all():
                    yield links(frame[~rest])
        if held:
            yield links(pd.concat(held, ignore_index=True))

    return run


def near_links(entries: DataFrame, budget: int = 3, hot_limit: int = 2048, levels: int = 3) -> DataFrame:
    """(src, dst): spanning links between the ``rep`` ids of distinct fingerprints (fp long, rep long)."""
    masks = {0: parts(0, budget + 1)}
    rows = _dealt(entries.withColumn("mask", F.lit(0).cast("long")), masks)
    ready = []
    for level in range(levels):
        if level + 1 == levels:
            ready.append(rows)
            break
        hot = rows.groupBy("mask", "part").count().where(F.col("count") > hot_limit).select("mask", "part")
        hot = materialize(hot)
        if hot.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(hot, ["mask", "part"], "left_anti"))
        masks = {m: parts(m, budget + 1) for new in masks.values() for m in new}
        rows = _dealt(rows.join(hot, ["mask", "part"], "left_semi"), masks)
    dealt = ready[0].select("mask", "part", "fp", "rep")
    for more in ready[1:]:
        dealt = dealt.unionByName(more.select("mask", "part", "fp", "rep"))
    n = tasks(entries.sparkSession)
    dealt = dealt.repartition(n, "mask", "part").sortWithinPartitions("mask", "part", "fp")
    return dealt.mapInArrow(returning(_join_trees(budget)), "src long, dst long")


def _groups(marks: DataFrame, budget: int) -> DataFrame:
    """fp, low (least (no id, id, fp) of the rows whose fingerprints are linked to it) of the distinct fingerprints.

    A fingerprint stands for itself in the links, so rows without an id link and bridge like any other."""
    entries = materialize(marks.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("least")))
    joined = connected_components(near_links(entries.select("fp", F.col("fp").alias("rep")), budget))
    linked = entries.join(joined.select(F.col("id").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = linked.groupBy("component").agg(F.min("least").alias("low"))
    return linked.join(lows, "component").select("fp", "low")


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, fingerprint (16 hex digits), component_id: the least id linked to the document, itself included.

    Null and blank texts have fingerprint zero and link like any other. Ids are longs; a null id takes part with its
    text but names no component, so the component of rows that all lack an id is null. Repeated rows, and different
    texts of one id, come back as often as they came, each with the component of its own text. Very long texts are read
    whole. Other columns of the input are left out.
    """
    marks = materialize(fingerprints(docs, shingle, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), "fp"))
    named = _groups(marks, budget).select("fp", F.col("low.id").alias("component_id"))
    out = marks.join(named, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def with_fingerprint(docs: DataFrame, shingle: int, text_col: str, name: str) -> DataFrame:
    """``docs`` with its texts' fingerprints as a signed long."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            values = np.array([simhash(t, shingle) for _, texts in text_slices(batch, place) for t in texts], dtype=np.uint64)
            yield batch.append_column(name, pa.array(values.view(np.int64)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def keep_one(docs: DataFrame, shingle: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of each group of near duplicates that has the least id; rows without an id come last.

    Rows are told apart by id and text: of an id that occurs with several texts only the texts that another row stands
    for go, and of rows with equal id and fingerprint one stays."""
    marks = materialize(fingerprints(docs, shingle, id_col, text_col).select(F.col(id_col).alias("id"), "fp"))
    groups = _groups(marks, budget)
    kept = materialize(groups.select("low").distinct().select("low.id", "low.fp"))
    gone = marks.join(groups, "fp").where("NOT (id <=> low.id AND fp = low.fp)").select("id").distinct()
    unsure = materialize(marks.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").select("id"))
    if unsure.isEmpty():
        return docs.join(gone.withColumnRenamed("id", id_col), id_col, "left_anti").select(*docs.columns)
    by_id = lambda df: docs[id_col].eqNullSafe(df["id"])
    sure = docs.join(unsure, by_id(unsure), "left_anti")
    sure = sure.join(gone.withColumnRenamed("id", "_gone"), sure[id_col] == F.col("_gone"), "left_anti")
    rest = with_fingerprint(docs.join(unsure, by_id(unsure), "left_semi"), shingle, text_col, "_fp").dropDuplicates([id_col, "_fp"])
    rest = rest.join(kept.select(F.col("id").alias("_id"), F.col("fp").alias("_of")), rest[id_col].eqNullSafe(F.col("_id")) & (F.col("_fp") == F.col("_of")), "left_semi")
    return sure.select(*docs.columns).unionByName(rest.select(*docs.columns))
