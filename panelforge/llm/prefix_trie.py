"""Prefix trie of conversations from padded matrices of turn ids.

A turn is 24 bytes: 16 of the digest of its role and text and 8 of its text's length. A conversation's path is its turns
one after the other, so that paths compare like sequences of turns. Spark deals (path, conv_id) into range shards of
bounded size; a shard is a task's. Inside, turns become dense ids in padded matrices of 64 columns, one for each 64
turns and only of conversations that long, which ``numpy.lexsort`` orders from the last matrix to the first. Row by row
the columns that differ from the row above are accumulated by OR into change masks: where one is set a node starts.
One ``reduceat`` over all (depth, row) cells gives the nodes' members, children, leaves and tokens.

A shard's nodes are whole but for those on the paths of its first and last row, which may go on in the next shard. These
open nodes are told by the digest of their path and recombined by sums and minima, less what was counted twice: a
node that does not start in a shard but before it, and a last row that is no leaf as a later shard goes on with it.

Texts leave the first stage as digests. A shard holds about ``shard_cells`` turns, however common a conversation or a
first turn is; one conversation's path (24 bytes a turn) is one value.

Defined cases: null role or text is empty; null turn comes first; rows with equal turn are ordered by role, then by
digest; repeated rows are repeated turns; rows without a conv_id are of no conversation. Other columns of the input are
not read. An empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.scratch import materialize, tasks

#: Bytes of a turn in a path, those of them that name it, and columns of a matrix.
TURN, NAME, WIDTH = 24, 16, 64
#: Bytes of conv_ids that travel in one row when the members that end at a node lie in several shards.
PIECE = 8192
#: Parts over which the parents that many shards share are repeated for the join with their children.
SALT = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def own_paths(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, path (hex) of each conversation."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.char_length(by).cast("string"), F.lit(":"), by, said), 256), 1, 2 * NAME)
    size = F.lpad(F.hex(F.octet_length(said).cast("long")), 2 * (TURN - NAME), "0")
    named = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), by.alias("role"), F.concat(digest, F.lower(size)).alias("name")).alias("one"))
    return named.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list("one"))["name"], "").alias("path"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """conv_id, path (bytes): each conversation's own turns behind its first h, led by the first h of conv_id - conv_id % 5."""
    size = 2 * TURN
    heads = paths.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.substring("path", 1, 8 * size).alias("head"))
    own = paths.select("conv_id", "path", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int").alias("h"))
    led = own.join(heads, "base", "left")
    path = F.concat(F.coalesce(F.expr(f"substring(head, 1, h * {size})"), F.lit("")), F.expr(f"substring(path, h * {size} + 1)"))
    return led.select("conv_id", F.unhex(path).alias("path"))


def _keys(path: bytes) -> list[str]:
    """A digest for each prefix, the root's first."""
    state = hashlib.sha256()
    out = [state.hexdigest()[:32]]
    for k in range(0, len(path), TURN):
        state.update(path[k : k + TURN])
        out.append(state.hexdigest()[:32])
    return out


def sorted_rows(ids: np.ndarray, sizes: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by (turns, conv_id), and a flag for each turn in that order: whether the row differs from the one above
    in this turn or one before it. ``ids``: the rows' turns as positive numbers, one row after the other; ``sizes``: turns a row."""
    begin = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    tiles = max(1, -(-int(sizes.max()) // WIDTH))

    def matrix(rows: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
        column = tile * WIDTH + np.arange(min(WIDTH, int(sizes[rows].max()) - tile * WIDTH) or 1)
        inside = column[None, :] < sizes[rows][:, None]
        padded = np.zeros(inside.shape, dtype=ids.dtype)
        padded[inside] = ids[(begin[rows][:, None] + column[None, :])[inside]]
        return padded, inside

    rank = np.empty(len(sizes), dtype=np.int64)
    rank[np.argsort(conv, kind="stable")] = np.arange(len(sizes))
    for tile in reversed(range(tiles)):
        rows = np.flatnonzero(sizes > tile * WIDTH) if tile else np.arange(len(sizes))
        padded, _ = matrix(rows, tile)
        order = np.lexsort((rank[rows], *padded.T[::-1]))
        rank[rows[order]] = len(sizes) + np.arange(len(rows))  # behind the rows that end before
    order = np.argsort(rank, kind="stable")
    sizes, begin = sizes[order], begin[order]

    changed = np.zeros(int(sizes.sum()), dtype=bool)
    target = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    carry = np.zeros(len(sizes), dtype=bool)
    carry[0] = True
    for tile in range(tiles):
        rows = np.flatnonzero(sizes > tile * WIDTH)
        if not len(rows):
            break
        padded, inside = matrix(rows, tile)
        mask = np.ones(padded.shape, dtype=bool)
        follows = np.flatnonzero(rows[1:] == rows[:-1] + 1) + 1
        mask[follows] = padded[follows] != padded[follows - 1]
        mask[:, 0] |= carry[rows]
        mask = np.logical_or.accumulate(mask, axis=1)
        carry[rows] = mask[:, -1]
        column = tile * WIDTH + np.arange(padded.shape[1])
        changed[(target[rows][:, None] + column[None, :])[inside]] = mask[inside]
    return order, changed


class Shard:
    """Nodes of the conversations of one range shard."""

    def __init__(self, conv: np.ndarray, paths: list[bytes]):
        sizes = np.fromiter(map(len, paths), np.int64, len(paths)) // TURN
        raw = np.frombuffer(b"".join(paths), dtype=np.uint8).reshape(-1, TURN)
        high, low, weight = (np.ascontiguousarray(raw[:, k : k + 8]).view(">u8").ravel() for k in (0, 8, 16))
        by_name = np.lexsort((low, high))
        fresh = np.r_[True, (high[by_name][1:] != high[by_name][:-1]) | (low[by_name][1:] != low[by_name][:-1])][: len(by_name)]
        ids = np.empty(len(by_name), dtype=np.int32)
        ids[by_name] = np.cumsum(fresh)
        order, changed = sorted_rows(ids, sizes, conv)
        own = np.r_[0, np.cumsum(sizes)]
        self.first, self.last = paths[order[0]], paths[order[-1]]
        self.conv, self.sizes = conv[order], sizes[order]
        n = len(order)

        # a cell for each row and depth, the root's at depth 0; those of a row follow each other
        cells = self.sizes + 1
        end = np.cumsum(cells)
        begin = end - cells
        row = np.repeat(np.arange(n), cells)
        depth = np.arange(end[-1]) - begin[row]
        turns = depth > 0
        starts = np.zeros(len(row), dtype=bool)
        starts[turns] = changed
        starts[0] = True
        weights = np.zeros(len(row), dtype=np.int64)
        weights[turns] = weight.astype(np.int64)[np.repeat(own[:-1][order], self.sizes) + depth[turns] - 1]
        self.weight_first, self.weight_last = weights[: end[0]], weights[begin[-1] :]

        repeated = np.where(starts, 0, weights)
        total = np.cumsum(repeated)
        saved = total[end[row] - 1] - total + repeated
        child = np.r_[starts[1:], False]
        child[end - 1] = False
        final = depth == self.sizes[row]
        # a row is a leaf if the next one leaves its path: differs from it in a turn that both have
        go_on = np.zeros(n, dtype=bool)
        more = np.flatnonzero(self.sizes[1:] >= self.sizes[:-1])
        go_on[more] = ~starts[begin[more + 1] + self.sizes[more]]
        leaf = (~go_on)[row]

        by_depth = np.argsort(depth, kind="stable")
        at = np.flatnonzero(starts[by_depth])
        add = lambda x: np.add.reduceat(x[by_depth].astype(np.int64), at)
        self.start = by_depth[at]
        self.depth = depth[self.start]
        self.n_convs, self.n_children, self.n_leaves, self.saved, self.n_ends = add(np.ones(len(row))), add(child), add(leaf), add(saved), add(final)
        self.conv_id = np.minimum.reduceat(self.conv[row][by_depth], at)
        node = np.empty(len(row), dtype=np.int64)
        node[by_depth] = np.cumsum(starts[by_depth]) - 1
        self.parent = np.where(self.depth > 0, node[self.start - 1], -1)
        self.row = row[self.start]
        self.first_nodes, self.last_nodes = node[: end[0]], node[begin[-1] :]

    def ends(self, node: int) -> list[int]:
        """conv_ids of the members that end at the node, ascending."""
        first = self.row[node]
        return self.conv[first : first + self.n_ends[node]].tolist()

    def rows(self, shard: int) -> list[dict]:
        """Whole nodes (kind 0), open nodes (1) and the conv_ids that end at open nodes (2)."""
        names = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved")
        columns = list(zip(*(getattr(self, c).tolist() for c in names)))
        keys = dict(zip(self.last_nodes.tolist(), _keys(self.last)))
        paths = {k: (False, True, w) for k, w in zip(self.last_nodes.tolist(), self.weight_last.tolist())}
        for k, key, w in zip(self.first_nodes.tolist(), _keys(self.first), self.weight_first.tolist()):
            keys[k], paths[k] = key, (True, k in paths, w)
        out = []
        conv_ids, parents = self.conv_id.tolist(), self.parent.tolist()
        for k, values in enumerate(columns):
            r = dict(zip(names, values)) | {"shard": shard}
            if k in keys:
                on_first, on_last, weight = paths[k]
                r |= {"kind": 1, "key": keys[k], "parent_key": keys.get(parents[k]), "on_first": on_first, "on_last": on_last, "weight": weight, "at_end": k == self.last_nodes[-1]}
                text = ",".join(map(str, self.ends(k)))
                out += [{"kind": 2, "key": keys[k], "shard": shard, "piece": i, "ids": text[i : i + PIECE]} for i in range(0, len(text), PIECE)]
            else:
                inner = parents[k] not in keys
                sha = hashlib.sha256(",".join(map(str, self.ends(k))).encode()).hexdigest() if self.n_ends[k] else NOTHING
                r |= {"kind": 0, "ends_sha256": sha, "parent_conv_id": conv_ids[parents[k]] if inner else None, "parent_key": None if inner else keys[parents[k]]}
            out.append(r)
        return out


FOUND = "kind int, shard int, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends_sha256 string, on_first boolean, on_last boolean, at_end boolean, weight long, piece long, ids string"


def shard_nodes(paths: DataFrame, shard_cells: int) -> DataFrame:
    """Rows of ``Shard.rows`` over range shards of (path, conv_id)."""
    size = paths.agg(F.sum(F.octet_length("path") + TURN)).first()[0] or 0
    n = max(tasks(paths.sparkSession), -(-size // (TURN * shard_cells)))
    schema = pa.schema([(name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[kind]) for name, kind in (c.split() for c in FOUND.split(", "))])

    def run(batches):
        held = list(batches)
        conv = np.concatenate([b.column(0).to_numpy() for b in held]) if held else []
        if len(conv):
            rows = Shard(conv, [p for b in held for p in b.column(1).to_pylist()]).rows(TaskContext.get().partitionId())
            for k in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_pylist(rows[k : k + 20_000], schema=schema)

    return paths.select("conv_id", "path").repartitionByRange(n, "path", "conv_id").mapInArrow(run, FOUND)


def ends_digests(found: DataFrame) -> DataFrame:
    """key, ends_sha256 of the open nodes at which members end; a digest reads its pieces one after the other."""

    def run(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for key, piece, ids in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if key != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                elif piece == 0:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], names=["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    pieces = found.where("kind = 2").select("key", "shard", "piece", "ids")
    return pieces.repartition(tasks(found.sparkSession), "key").sortWithinPartitions("key", "shard", "piece").mapInArrow(run, "key string, ends_sha256 string")


def open_nodes(found: DataFrame) -> DataFrame:
    """Open nodes of all shards, recombined: key and the columns of a node."""
    rows = found.where("kind = 1")
    spans = rows.groupBy("key").agg(F.min("shard").alias("low"), F.max("shard").alias("high"))
    rows = rows.join(spans, "key")
    # turns that a shard's first row shares with earlier shards, and whether later ones go on with its last row
    shared = rows.groupBy("shard").agg(
        F.max(F.when(F.col("on_first") & (F.col("low") < F.col("shard")), F.col("depth"))).alias("shared"),
        F.max(F.when(F.col("at_end") & (F.col("high") > F.col("shard")), 1)).alias("goes_on"),
    )
    rows = rows.join(shared, "shard")
    again = F.col("on_first") & (F.col("depth") <= F.col("shared"))
    below = F.sum(F.when(again, F.col("weight"))).over(Window.partitionBy("shard").orderBy(F.col("depth").desc(), "on_first").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    flag = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    rows = rows.withColumn("saved", F.col("saved") + F.when(again, below).otherwise(0))
    rows = rows.withColumn("n_children", F.col("n_children") - flag(F.col("on_first") & (F.col("depth") < F.col("shared"))))
    rows = rows.withColumn("n_leaves", F.col("n_leaves") - flag(F.col("on_last") & F.col("goes_on").isNotNull()))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    joined = rows.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.first("parent_key").alias("parent_key"), *sums)
    return joined.join(ends_digests(found), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))


def prefix_trie(turns: DataFrame, shard_cells: int = 400_000, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node of the rebuilt conversations."""
    found = materialize(shard_nodes(materialize(rebuilt(own_paths(turns, conv, turn, role, text))), shard_cells))
    tops = materialize(open_nodes(found))
    own = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    lone = found.where("kind = 0 and parent_key is null").select(*own, "parent_conv_id")
    hung = found.where("kind = 0 and parent_key is not null").select(*own, "parent_key").unionByName(tops.select(*own, "parent_key"))
    parents = tops.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("part"))
    hung = hung.withColumn("part", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALT)).cast("int")).join(parents, ["parent_key", "part"], "left")
    return lone.unionByName(hung.select(*own, "parent_conv_id")).select(*_long("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


#: Contract columns by DuckDB: digests of all prefixes, and subtrees by the smallest members' paths. CRC-32 by its bitwise rule.
ORACLE_SQL = """
WITH crc_table AS (
    SELECT list(c ORDER BY b) AS t
    FROM (SELECT b, list_reduce(list_prepend(b, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(0, 256)) AS b))
),
own AS (
    SELECT conv_id, list({'role': r, 'text': x} ORDER BY turn NULLS FIRST, r, sha256(CAST(length(r) AS VARCHAR) || ':' || r || x)) AS turns
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
    GROUP BY conv_id
),
led AS (
    SELECT o.conv_id, o.turns, coalesce(b.turns, []) AS base,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(o.conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))), lambda c, s: xor(t.t[(xor(c, s) & 255) + 1], c >> 8)), 4294967295) % 9 AS h
    FROM own o CROSS JOIN crc_table t LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
),
rebuilt AS (SELECT conv_id, list_concat(base[1:h], turns[h + 1:]) AS turns FROM led),
prefixes AS (
    SELECT conv_id, d AS depth, len(turns) = d AS final, sha256(CAST(turns[1:d] AS VARCHAR) || CAST(list_transform(turns[1:d], lambda t: strlen(t['role']) || ',' || strlen(t['text'])) AS VARCHAR)) AS k, coalesce(strlen(turns[d]['text']), 0) AS w
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w, sha256(coalesce(string_agg(CASE WHEN final THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, k
),
above AS (SELECT n.depth AS low, n.k AS low_k, n.n_convs, n.w, p.depth, p.k FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
parents AS (SELECT a.low, a.low_k, n.conv_id AS parent_conv_id, n.depth, n.k FROM above a JOIN nodes n ON n.depth = a.depth AND n.k = a.k WHERE a.depth = a.low - 1),
children AS (SELECT depth, k, count(*) AS n FROM parents GROUP BY depth, k),
trees AS (
    SELECT a.depth, a.k, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((a.n_convs - 1) * a.w) AS saved_tokens
    FROM above a LEFT JOIN children c ON c.depth = a.low AND c.k = a.low_k GROUP BY a.depth, a.k
)
SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN trees t ON t.depth = n.depth AND t.k = n.k
LEFT JOIN parents p ON p.low = n.depth AND p.low_k = n.k
LEFT JOIN children c ON c.depth = n.depth AND c.k = n.k
"""
