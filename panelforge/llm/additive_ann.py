"""Nearest neighbours by largest inner product over additively quantised vectors.

A vector is approximated by the sum of one full-dimensional word from each of ``books`` codebooks. The books are
fitted to residuals in turn on at most ``train_rows`` vectors, chosen by a hash of their ids; every vector is then
encoded by a beam search over the books. A query's inner products with all words form a lookup table, so the score of a
coded vector is a sum of ``books`` entries. Sums of words are shorter than what they stand for and lean away from it, so
each row stores the ratio of its squared norm to its inner product with its sum of words, and the score is multiplied by
it. The ``rerank`` best of each block are scored again on the original vectors in double precision.

Queries meet all rows in blocks of about ``query_chunk`` queries by ``row_chunk`` rows: both are written once, and the task
of a pair of their splits reads them, so that what is shuffled, broadcast or sent to the driver does not grow with the
number of pairs. (Cells of the first codebook would prune next to nothing here: on 51,282 unit vectors of
64 dimensions a query needs 128 of 256 cells to hold 0.92 of its 20 nearest.) Only the codebooks are broadcast; their size
is fixed.

Vectors that are null, empty, zero, of another length than most or that hold null or non-finite components take no
part; neither do rows without an id. Rows that repeat an id and a vector count once; a query skips every row of its
own id. Ties go to the smaller id. An empty table gives no rows; with fewer candidates than ``k`` all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.scratch import materialize, tasks

#: Rows that a task holds before it gives them out, 24 bytes each.
_HELD = 1 << 21


def valid_vectors(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id long, v array of the rows that take part, once each."""
    rows = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates(["id", "v"])


def fit_codebooks(sample: np.ndarray, books: int, words: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """books x words x dimensions, each book fitted by k-means to what the earlier ones leave."""
    rng = np.random.default_rng(seed)
    rest = sample.astype(np.float64).copy()
    out = np.zeros((books, words, sample.shape[1]))
    for m in range(books):
        centres = rest[rng.choice(len(rest), words, replace=len(rest) < words)] if len(rest) else out[m]
        for _ in range(rounds if len(rest) else 0):
            near = np.argmin((centres**2).sum(1) - 2 * rest @ centres.T, axis=1)
            count = np.bincount(near, minlength=words)
            total = np.zeros_like(centres)
            np.add.at(total, near, rest)
            centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
        near = np.argmin((centres**2).sum(1) - 2 * rest @ centres.T, axis=1) if len(rest) else []
        rest = rest - centres[near] if len(rest) else rest
        out[m] = centres
    return out


def encode(vectors: np.ndarray, books: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes by beam search, and the stored norms: squared norm over the inner product with the sum of words."""
    n, d = vectors.shape
    m, words, _ = books.shape
    rest = vectors[:, None, :]
    codes = np.zeros((n, 1, 0), dtype=np.uint8)
    for k in range(m):
        width = rest.shape[1]
        error = (rest**2).sum(2)[:, :, None] + (books[k] ** 2).sum(1) - 2 * (rest.reshape(-1, d) @ books[k].T).reshape(n, width, words)
        flat = error.reshape(n, -1)
        keep = min(beam, flat.shape[1])
        best = np.argpartition(flat, keep - 1, axis=1)[:, :keep] if keep < flat.shape[1] else np.tile(np.arange(keep), (n, 1))
        parent, word = best // words, best % words
        rows = np.arange(n)[:, None]
        rest = rest[rows, parent] - books[k][word]
        codes = np.concatenate([codes[rows, parent], word[:, :, None].astype(np.uint8)], axis=2)
    left = np.sqrt((rest**2).sum(2))
    pick = np.argmin(left, axis=1)
    own = codes[np.arange(n), pick]
    square = (vectors**2).sum(1)
    along = square - (vectors * rest[np.arange(n), pick]).sum(1)
    return own, np.where(along > 0, square / np.where(along > 0, along, 1.0), 1.0)


def _coded_chunks(size: int, books: np.ndarray, beam: int, dims: int):
    """Rows in order of their id to chunk rows of a number, ids, vectors, codes and stored norms."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32

        def pack(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            codes, norms = encode(vectors, books, beam)
            blobs = [ids.tobytes(), vectors.astype("<f8").tobytes(), codes.tobytes(), norms.astype("<f8").tobytes()]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([number - 1]), *[pa.array([b], pa.binary()) for b in blobs]], names=["chunk", "ids", "vectors", "codes", "norms"])

        ids, vectors = np.empty(0, np.int64), np.empty((0, dims))
        for batch in batches:
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            vectors = np.concatenate([vectors, batch.column(1).flatten().to_numpy().reshape(-1, dims).astype(np.float64)])
            while len(ids) >= size:
                yield pack(ids[:size], vectors[:size])
                ids, vectors = ids[size:], vectors[size:]
        if len(ids):
            yield pack(ids, vectors)

    return run


def best_of_block(query_ids, queries, ids, vectors, codes, norms, books, k: int, rerank: int):
    """Rows (query, id, score) of the ``k`` best of one block for each query; ids ascend within the block."""
    flat = books.reshape(-1, books.shape[2])
    tables = queries @ flat.T
    places = codes.astype(np.int64) + np.arange(books.shape[0]) * books.shape[1]
    out_q, out_i, out_s = [], [], []
    for q in range(len(query_ids)):
        score = tables[q][places].sum(axis=1) * norms
        if len(ids) > rerank:
            # all that tie with the last place are reranked too
            near = np.flatnonzero(score >= np.partition(score, len(ids) - rerank)[len(ids) - rerank])
        else:
            near = np.arange(len(ids))
        near = near[ids[near] != query_ids[q]]
        exact = (vectors[near] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[near], -exact))[:k]
        out_q.append(np.full(len(best), query_ids[q]))
        out_i.append(ids[near[best]])
        out_s.append(exact[best])
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def keep_best(query_ids, ids, scores, k: int):
    """The ``k`` best rows of each query, by score and then id."""
    order = np.lexsort((ids, -scores, query_ids))
    query_ids, ids, scores = query_ids[order], ids[order], scores[order]
    first = np.flatnonzero(np.diff(query_ids, prepend=query_ids[:1] - 1))
    keep = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order))) < k
    return query_ids[keep], ids[keep], scores[keep]


def _found(rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["query_id", "vec_id", "score"])


def _sample(rows: DataFrame, total: int, size: int):
    """The vectors of the first ``size`` rows by a hash of their ids; of a large table only rows with small hashes are sorted."""
    keyed = rows.select(F.xxhash64("id").alias("h"), "id", "v")
    first = lambda some: some.orderBy("h", "id").limit(size).repartition(1).toPandas()  # noqa: E731  # one result, not one a task, goes to the driver
    drawn = first(keyed.where(F.col("h") < -(2**63) + 2**65 * size // total) if total > 4 * size else keyed)
    if len(drawn) < min(size, total):  # many rows share few ids
        drawn = first(keyed)
    return drawn.sort_values(["h", "id"], kind="stable")["v"]


def nearest(
    frame: DataFrame,
    k: int = 20,
    query_every: int = 20,
    books: int = 12,
    words: int = 256,
    beam: int = 4,
    rerank: int = 640,
    train_rows: int = 8192,
    row_chunk: int = 8192,
    query_chunk: int = 512,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row whose id ``query_every`` divides."""
    spark = frame.sparkSession
    rows = valid_vectors(frame, id_col, vector_col)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("count"), F.count(F.when(F.col("id") % query_every == 0, 1)).alias("asked")).orderBy(F.desc("count"), "d").first()
    dims = lengths["d"] if lengths else 1
    rows = rows.where(F.size("v") == dims)
    drawn = _sample(rows, lengths["count"] if lengths else 0, train_rows)
    sample = np.stack(drawn.to_list()) if len(drawn) else np.empty((0, dims))
    shared = spark.sparkContext.broadcast(fit_codebooks(sample, books, words))

    n = tasks(spark)
    ordered = rows.repartition(n, "id", "v").sortWithinPartitions("id")
    coded = materialize(ordered.mapInArrow(lambda batches: _coded_chunks(row_chunk, shared.value, beam, dims)(batches), "chunk long, ids binary, vectors binary, codes binary, norms binary"))
    blocks = max(1, -(-(lengths["asked"] if lengths else 0) // query_chunk))
    asked = rows.where(F.col("id") % query_every == 0).withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    asked = materialize(asked.groupBy("block").agg(F.collect_list("id").alias("q_ids"), F.flatten(F.collect_list("v")).alias("q_vectors")))
    # every block of queries meets every chunk of rows once, read by the task of the pair: neither is shuffled or broadcast
    pairs = coded.hint("shuffle_replicate_nl").crossJoin(asked)

    def score(batches):
        books_now, best, held = shared.value, {}, 0
        for batch in batches:
            for r in range(batch.num_rows):
                one = {c: batch.column(c)[r] for c in batch.schema.names}
                ids = np.frombuffer(one["ids"].as_py(), dtype=np.int64)
                vectors = np.frombuffer(one["vectors"].as_py(), dtype="<f8").reshape(-1, dims)
                codes = np.frombuffer(one["codes"].as_py(), dtype=np.uint8).reshape(len(ids), -1)
                norms = np.frombuffer(one["norms"].as_py(), dtype="<f8")
                q_ids = one["q_ids"].values.to_numpy()
                queries = one["q_vectors"].values.to_numpy().reshape(-1, dims).astype(np.float64)
                new, block = best_of_block(q_ids, queries, ids, vectors, codes, norms, books_now, k, rerank), one["block"].as_py()
                # a task gives a query's best of all chunks that it meets, not those of each
                old = best.get(block, ())
                best[block] = keep_best(*(np.concatenate(both) for both in zip(old, new)), k) if old else new
                held += len(best[block][0]) - (len(old[0]) if old else 0)
                if held >= _HELD:
                    yield from map(_found, best.values())
                    best, held = {}, 0
        yield from map(_found, best.values())

    found = pairs.mapInArrow(score, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
