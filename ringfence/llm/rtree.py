"""Hard negatives by inner product over STR-packed R-trees.

Vectors are dealt to shards by sort-tile-recursive: slabs of the coordinate that varies
most, each cut into tiles of the next one.  Inside a shard an R-tree is packed the same
way (label, then the coordinates that vary most); a node keeps the minimum bounding box
of its rows.  Against an anchor, each coordinate of a box gives an interval of products,
their sums bound the score of every row inside.  A best-first queue opens boxes by their
upper bound, a few at a time, and prunes a box that lies outside the score window, or
strictly below the kth best so far (a box equal to it is opened where it holds a smaller
id).

``mine`` runs three searches of this kind, each on Spark by shard: an anchor's positives
in its own shard (which gives a bound), then in the other shards whose box reaches that
bound, then the negatives of all its positives' windows in the shards that reach one.

The tiles' cuts are fitted on about ``FIT`` vectors (chosen by the hash of their id; at
most twice that), which decides where a vector is stored and never whether it is found:
boxes are of all rows, and results are exact.  A tile with more than ``SHARD`` rows, also
of one repeated vector, is dealt over several shards.  Anchors are routed with the table
of shard boxes, sent to the tasks only up to ``BOXES`` shards; beyond that every anchor
goes to every shard and the root boxes prune.  More than ``PIECE`` anchors of a shard
are split over tasks.

Cases: rows with a null id, label or vector, or with a null or non-finite component take
no part; vectors of unlike lengths have no inner product and never meet; rows alike
in id, label and vector count once; rows that share an id alone count each, ties of
score and id go by label, then by the hash of the row; a score is exact, also where it
passes 2^53, and one outside of 64 bits is an error as in Spark's own arithmetic; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import stable, written

_INF = float("inf")
SHARD, LEAF, FANOUT = 16384, 64, 16
FIT, BOXES, PIECE = 20_000, 4096, 16384
#: Anchors of a shard that share the scores of an opened leaf.
BLOCK = 64


def usable(rows: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label, v, key): distinct rows that take part, each component x as floor(scale * x)."""
    x = F.col("embedding")
    whole = F.transform(x.cast("array<double>"), lambda c: F.when(F.abs(c * scale) < 2.0**52, F.floor(c * scale).cast("double")).otherwise(c * scale))
    fine = F.forall(x.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    out = rows.where(F.col("vec_id").isNotNull() & label.isNotNull() & x.isNotNull()).where(fine)
    out = out.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("v"))
    return out.withColumn("key", F.xxhash64("vec_id", "label", "v")).dropDuplicates(["vec_id", "label", "v"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(values) // max(len(column), 1))


# --- shards ---------------------------------------------------------------------------

def fit(sample: np.ndarray, shards: int) -> dict:
    """Cuts of two levels: slabs of the coordinate of largest variance, tiles of the next."""
    if shards < 2 or len(sample) < 2 or not sample.shape[1]:
        return {"first": 0, "second": 0, "cuts": np.empty(0), "tiles": [np.empty(0)]}
    order = np.argsort(-sample.var(axis=0), kind="stable")
    first, second = int(order[0]), int(order[min(1, len(order) - 1)])
    slabs = int(np.ceil(np.sqrt(shards)))
    part = lambda values, n: np.unique(np.quantile(values, np.arange(1, n) / n, method="lower")) if len(values) else np.empty(0)
    cuts = part(sample[:, first], slabs)
    at = np.searchsorted(cuts, sample[:, first], "left")
    return {"first": first, "second": second, "cuts": cuts, "tiles": [part(sample[at == i, second], -(-shards // slabs)) for i in range(len(cuts) + 1)]}


def tile_of(v: np.ndarray, cut: dict) -> np.ndarray:
    if not v.shape[1]:
        return np.zeros(len(v), np.int32)
    slab = np.searchsorted(cut["cuts"], v[:, cut["first"]], "left")
    out = np.zeros(len(v), np.int32)
    width = 1 + max(map(len, cut["tiles"]))
    for i, tiles in enumerate(cut["tiles"]):
        here = slab == i
        out[here] = i * width + np.searchsorted(tiles, v[here, cut["second"]], "left")
    return out


def sharded(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """``vectors`` with ``dim`` and ``shard``: (dim, tile, chunk of it), numbered by a hash; written to the shared folder."""
    vectors = written(vectors.withColumn("dim", F.size("v")), "rtree-vectors")
    counts = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().orderBy(F.desc("count")).limit(BOXES).collect()}
    total = sum(counts.values())
    share = int(min(1.0, FIT / max(total, 1)) * (1 << 30))
    some = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share).select("dim", "v").limit(2 * FIT).collect()
    own = {d: [r["v"] for r in some if r["dim"] == d] for d in counts}
    cut = {d: fit(np.array(own[d], float).reshape(len(own[d]), d), -(-n // shard)) for d, n in counts.items()}

    @F.arrow_udf("int")
    def tile(dims: pa.Array, vs: pa.Array) -> pa.Array:
        dim, out = dims.to_numpy(), np.zeros(len(dims), np.int32)
        for d in np.unique(dim).tolist():
            here = np.flatnonzero(dim == d)
            if d in cut:
                out[here] = tile_of(_matrix(vs.take(pa.array(here))), cut[d])
        return pa.array(out)

    tiled = vectors.withColumn("tile", tile("dim", "v"))
    size = tiled.groupBy("dim", "tile").agg(F.ceil(F.count("*") / shard).cast("int").alias("chunks"))
    out = tiled.join(size, ["dim", "tile"]).withColumn("shard", F.xxhash64("dim", "tile", F.pmod("key", "chunks")))
    return written(out.select("shard", "dim", "vec_id", "label", "v", "key"), "rtree-shards")


_BOX = "shard long, dim int, low array<double>, high array<double>"


def boxes(shards: DataFrame) -> DataFrame:
    """The minimum bounding box of each shard: of each batch first, then of these."""
    def run(batches):
        for batch in batches:
            shard, dim = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = []
            for s in np.unique(shard).tolist():
                here = np.flatnonzero(shard == s)
                v = _matrix(batch.column(2).take(pa.array(here)))
                rows.append((s, int(dim[here[0]]), v.min(axis=0).tolist(), v.max(axis=0).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                                                 ["shard", "dim", "low", "high"])
    each = shards.select("shard", "dim", "v").mapInArrow(run, _BOX)
    part = F.posexplode_outer(F.arrays_zip("low", "high")).alias("i", "x")
    flat = each.select("shard", "dim", part).groupBy("shard", "dim", "i").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    listed = F.array_sort(F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", "low", "high"))))
    return flat.groupBy("shard", "dim").agg(listed.alias("b")).select(
        "shard", "dim", F.col("b.low").alias("low"), F.col("b.high").alias("high"))


# --- the tree -------------------------------------------------------------------------

def _pack(v: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """STR order of the rows: label first, then the coordinates that vary most, a level of slabs each."""
    n = len(v)
    pages = -(-n // leaf)
    depth = min(v.shape[1] + 1, max(1, int(np.ceil(np.log2(max(pages, 2))))))
    by = [labels, *(v[:, c] for c in np.argsort(-v.astype(float).var(axis=0), kind="stable")[:depth - 1])]

    def tiles(index: np.ndarray, level: int) -> list[np.ndarray]:
        index = index[np.argsort(by[level][index], kind="stable")]
        here = -(-len(index) // leaf)
        if level == len(by) - 1 or here <= 1:
            return [index]
        slabs = int(np.ceil(here ** (1 / (len(by) - level))))
        step = leaf * -(-here // slabs)
        return [t for i in range(0, len(index), step) for t in tiles(index[i:i + step], level + 1)]
    return np.concatenate(tiles(np.arange(n), 0))


class Tree:
    """R-tree over the rows of one shard; nodes of all levels in one set of arrays, the root last."""

    def __init__(self, ids, labels, keys, v, leaf: int = LEAF, fanout: int = FANOUT):
        order = _pack(v, labels, leaf)
        self.ids, self.labels, self.keys, self.v = ids[order], labels[order], keys[order], v[order]
        self.leaf, n = leaf, len(order)
        self.leaves = -(-n // leaf)
        starts = np.arange(0, n, leaf)
        levels = [[f.reduceat(x, starts, axis=0) for f, x in ((np.minimum, self.v), (np.maximum, self.v), (np.minimum, self.labels),
                                                             (np.maximum, self.labels), (np.minimum, self.ids))]]
        self.children, offset = [], 0  # of inner nodes: (first, end) in the arrays
        while len(levels[-1][0]) > 1:
            below = levels[-1]
            at = np.arange(0, len(below[0]), fanout)
            self.children += [(offset + a, offset + min(a + fanout, len(below[0]))) for a in at.tolist()]
            offset += len(below[0])
            levels.append([f.reduceat(x, at, axis=0) for f, x in zip((np.minimum, np.maximum, np.minimum, np.maximum, np.minimum), below)])
        self.low, self.high, self.label_low, self.label_high, self.least = (np.concatenate(x) for x in zip(*levels))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each node's box (columns) with each row of ``q``."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, label, key, same, windows, low, high, score):
        """For each window (least, most, k): its k best (-score, id, label, key) of the rows with the anchor's label, or of the others.

        ``low`` and ``high`` are the anchor's bounds of all nodes, ``score(leaf)`` its scores of some leaves' rows.
        """
        here = (self.label_low <= label) & (label <= self.label_high) if same else (self.label_low != label) | (self.label_high != label)
        out = []
        for least, most, k in windows:
            best: list[tuple] = []  # ascending
            need = here & (high >= least) & (low <= most)
            top = np.minimum(high, most)
            queue, width = np.flatnonzero(need[-1:]) + len(need) - 1, 4
            while len(queue):  # best bound first, a few boxes at a time
                if len(best) == k:
                    # what is left is strictly below the kth, or equal to it with larger ids alone
                    kth = -best[-1][0]
                    queue = queue[(top[queue] > kth) | (top[queue] == kth) & (self.least[queue] <= best[-1][1])]
                now, queue = queue[:width], queue[width:]
                width = min(4 * width, 256)
                inner, leaf = now[now >= self.leaves], now[now < self.leaves]
                if len(leaf):
                    row = (leaf[:, None] * self.leaf + np.arange(self.leaf)).ravel()
                    s = score(leaf)
                    good = (row < len(self.ids)) & (s >= (max(least, -best[-1][0]) if len(best) == k else least)) & (s <= most)
                    row, s = row[good], s[good]
                    good = (self.labels[row] == label) == same
                    if same:
                        good &= self.keys[row] != key
                    row, s = row[good], s[good]
                    if len(row) > k:  # the kth score and what equals it
                        good = s >= np.sort(s)[-k]
                        row, s = row[good], s[good]
                        if len(row) > k:
                            first = np.lexsort((self.keys[row], self.labels[row], self.ids[row], -s))[:k]
                            row, s = row[first], s[first]
                    if len(row):
                        new = zip((-s).tolist(), self.ids[row].tolist(), self.labels[row].tolist(), self.keys[row].tolist())
                        best = sorted([*best, *new])[:k]
                if len(inner):
                    kids = np.concatenate([np.arange(*self.children[i - self.leaves]) for i in inner.tolist()])
                    queue = np.concatenate([queue, kids[need[kids]]])
                    queue = queue[np.argsort(-top[queue], kind="stable")]
            out.append(best)
        return out


class Scores:
    """Scores of a block of anchors: a leaf's are computed for the whole block when the first anchor opens it."""

    def __init__(self, tree: Tree, q: np.ndarray):
        self.tree, self.q = tree, q.T
        self.table = np.zeros((len(q), tree.leaves, tree.leaf), q.dtype)
        self.done = np.zeros(tree.leaves, bool)

    def of(self, anchor: int):
        def score(leaf: np.ndarray) -> np.ndarray:
            for i in leaf[~self.done[leaf]].tolist():
                rows = self.tree.v[i * self.tree.leaf:(i + 1) * self.tree.leaf]
                self.table[:, i, :len(rows)] = (rows @ self.q).T
                self.done[i] = True
            return self.table[anchor, leaf].ravel()
        return score


_ASK = "shard long, kind int, vec_id long, label long, v array<double>, key long, windows array<struct<tag:int,least:long,most:long>>"
_FOUND = "a_key long, tag int, vec_id long, label long, key long, score long"


def _whole(x: np.ndarray, exact: bool) -> np.ndarray:
    """Doubles, or Python's integers where a product may pass 2^53."""
    return x if exact else np.array([[int(c) for c in r] for r in x], object).reshape(x.shape)


def _ends(window: dict) -> tuple:
    """A window's least and most score; null is open."""
    return -_INF if window["least"] is None else window["least"], _INF if window["most"] is None else window["most"]


def _run(same: bool, k: int):
    """Rows sorted by (shard, kind): a shard's vectors (kind 0) make its tree, its anchors (kind 1) search it."""
    def run(batches):
        now, rows, tree, most = None, [], None, 0.0

        def grown():
            """The tree of the rows held: made once, when the shard's first anchors come."""
            v = np.concatenate([r[3] for r in rows])
            return Tree(*(np.concatenate([r[j] for r in rows]) for j in range(3)), v), float(np.abs(v).max(initial=0))

        for batch in batches:
            shard, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edge = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
            out = []
            for a, b in zip(np.append(0, edge).tolist(), np.append(edge, len(shard)).tolist()):
                if a == b:
                    continue
                if shard[a] != now:
                    now, rows, tree = shard[a], [], None
                part = batch.slice(a, b - a)
                ids, label, key = (part.column(j).to_numpy() for j in (2, 3, 5))
                v = _matrix(part.column(4))
                if kind[a] == 0:
                    rows.append((ids, label, key, v))
                    continue
                if not rows:
                    continue
                if tree is None:
                    tree, most = grown()
                for at in range(0, len(v), BLOCK):
                    q = v[at:at + BLOCK]
                    exact = most * float(np.abs(q).max(initial=0)) * max(1, q.shape[1]) < 2.0**53
                    use = tree if exact else Tree(tree.ids, tree.labels, tree.keys, _whole(tree.v, False))
                    q = _whole(q, exact)
                    low, high = use.bounds(q)
                    scores = Scores(use, q)
                    for i in range(len(q)):
                        asked = part.column(6)[at + i].as_py()
                        got = use.search(label[at + i], key[at + i], same, [(*_ends(w), k) for w in asked], low[i], high[i], scores.of(i))
                        out.extend((int(key[at + i]), w["tag"], x[1], x[2], x[3], int(-x[0])) for w, best in zip(asked, got) for x in best)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.int64()] * 4))],
                                                 [x.split()[0] for x in _FOUND.split(", ")])
    return run


def _searched(shards: DataFrame, asked: DataFrame, same: bool, k: int, anchors: int) -> DataFrame:
    """``asked`` (shard, vec_id, label, v, key, windows) against the rows of their shards."""
    pieces = max(1, -(-anchors // PIECE))
    piece = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    empty = F.lit(None).cast("array<struct<tag:int,least:long,most:long>>")
    names = ["shard", "kind", "vec_id", "label", "v", "key", "windows"]
    held = shards.withColumn("p", piece).withColumn("kind", F.lit(0)).withColumn("windows", empty)
    both = held.select("p", *names).unionByName(
        asked.withColumn("p", F.pmod("key", F.lit(pieces)).cast("int")).withColumn("kind", F.lit(1)).select("p", *names))
    # a shard's piece is a stream of its own
    return (both.withColumn("shard", F.xxhash64("shard", "p")).drop("p").repartition("shard").sortWithinPartitions("shard", "kind")
            .mapInArrow(_run(same, k), _FOUND))


def _routed(queries: DataFrame, box: DataFrame) -> DataFrame:
    """``queries`` (dim, v, windows, ...) with each shard whose box reaches one of their windows."""
    if box.limit(BOXES + 1).count() > BOXES:
        return queries.join(box.select("shard", "dim"), "dim")
    table: dict[int, list] = {}
    for r in box.collect():
        table.setdefault(r["dim"], []).append((r["shard"], r["low"], r["high"]))
    table = {d: (np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float).reshape(len(rows), -1), np.array([r[2] for r in rows], float).reshape(len(rows), -1))
             for d, rows in table.items()}

    @F.arrow_udf("array<long>")
    def reached(dims: pa.Array, vs: pa.Array, windows: pa.Array) -> pa.Array:
        dim, out = dims.to_numpy(), [[] for _ in range(len(dims))]
        for d in np.unique(dim).tolist():
            if d not in table:
                continue
            here = np.flatnonzero(dim == d)
            shard, low, high = table[d]
            for at in here.tolist():
                q = np.array(vs[at].as_py(), float)
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                least, most = low @ up + high @ down, high @ up + low @ down
                slack = 1e-9 * (np.abs(least) + np.abs(most))  # these sums may round where scores pass 2^53
                hit = np.zeros(len(shard), bool)
                for w in windows[at].as_py():
                    a, b = _ends(w)
                    hit |= (most + slack >= a) & (least - slack <= b)
                out[at] = shard[hit].tolist()
        return pa.array(out, pa.list_(pa.int64()))

    return queries.withColumn("shard", F.explode(reached("dim", "v", "windows")))


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group of at most ``k`` rows a shard."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "label", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         shard: int = SHARD) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (from ``usable``) that satisfy ``anchor``.

    An anchor's positives are its ``positives`` best other rows of its label; for each,
    the ``negatives`` best rows of other labels whose score is ``low`` to ``high``
    hundredths of the positive's: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    shards = sharded(vectors, shard)
    box = stable(boxes(shards))
    asking = written(shards.where(anchor), "rtree-anchors")
    n = asking.count()
    window = lambda least, most, tag: F.struct(F.lit(tag).cast("int").alias("tag"), least.cast("long").alias("least"), most.cast("long").alias("most"))
    everything = asking.withColumn("windows", F.array(window(F.lit(None), F.lit(None), 0)))
    home = written(_searched(shards, everything, True, positives, n), "rtree-home")
    bound = home.groupBy("a_key").agg(F.when(F.count("*") >= positives, F.min("score")).alias("bound"))
    ask = (asking.withColumnRenamed("shard", "home").join(bound, F.col("a_key") == F.col("key"), "left")
           .withColumn("windows", F.array(window(F.col("bound"), F.lit(None), 0))))
    away = _routed(ask.select("home", "dim", "vec_id", "label", "v", "key", "windows"), box).where("shard <> home")
    near = home.unionByName(_searched(shards, away, True, positives, n))
    chosen = written(_best(near, ["a_key"], positives).select("a_key", F.col("rank").alias("tag"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "rtree-positives")
    p = F.col("positive_score")
    # whole scores s with low * p <= 100 * s <= high * p; none where p is negative
    down = lambda share: F.expr(f"(positive_score div 100) * {share} + ((positive_score % 100) * {share}) div 100")
    least = down(low) + F.when((p % 100) * low % 100 > 0, 1).otherwise(0)
    asked = (chosen.where("positive_score >= 0").groupBy("a_key")
             .agg(F.sort_array(F.collect_list(F.struct("tag", least.cast("long").alias("least"), down(high).cast("long").alias("most")))).alias("windows")))
    ask = asking.select("dim", "vec_id", "label", "v", "key").join(asked, F.col("a_key") == F.col("key"))
    found = _searched(shards, _routed(ask.drop("a_key"), box), False, negatives, n)
    best = _best(found, ["a_key", "tag"], negatives)
    return (best.select("a_key", "tag", F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(chosen, ["a_key", "tag"]).join(asking.select(F.col("key").alias("a_key"), F.col("vec_id").alias("anchor_id")), "a_key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
