"""Conversation prefix trie, built as burst tries.

``sequences`` turns rows into one row per conversation: the 128-bit ids of its turns
(SHA-256 of role and text, cut) and their byte counts, never the texts.  Equal
sequences are one row with a count, the smallest conversation and the hash of their
conversations.  ``build`` makes the trie over them:

* *Bursting.*  All sequences start in one container under the root.  A container of
  more than ``LIMIT`` sequences is oversized: its top becomes a trie head and its
  sequences move to the containers of their next turn id.  A round does this for
  ``HOP`` turns at once, with counts per prefix that are aggregated before the
  shuffle, so a first turn that all conversations share is a key of few rows.
* *Sweeping.*  The containers left, each of at most ``LIMIT`` sequences, are sorted and
  swept with a stack: neighbours' common prefix tells which nodes end.
* *Heads.*  Each container's top and each head add to all heads above them, in one
  aggregation by head.

Bounds: a container's sequences and one conversation's turn ids are held by a task (24
bytes a turn); the number of rounds is the depth at which more than ``LIMIT`` distinct
sequences still share a prefix, over ``HOP``.  The hash over a node's conversations
is by its definition computed in order, so one task streams the ids of equal
conversations; it holds none of them.

Cases: null role and text are empty; turns are ordered by turn (null first), role, text;
repeated rows are turns each; a null conversation id takes no part; empty sequences end
at the root; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import stable, written

LIMIT, HOP = 1024, 8
#: Bytes of a turn id, and of a byte count.
ID, SIZE = 16, 8

_EMPTY = hashlib.sha256().hexdigest()
_SEQUENCE = "conv_id long, ids binary, sizes binary"


def _id(role: bytes, text: bytes) -> bytes:
    return hashlib.sha256(b"%d:" % len(role) + role + text).digest()[:ID]


def sequences(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): ``ids`` and ``sizes``, packed in turn order."""
    def run(batches):
        now, ids, sizes = None, [], []

        def row():
            return [now], [b"".join(ids)], [np.array(sizes, ">i8").tobytes()]

        for batch in batches:
            out = ([], [], [])
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(1).cast("binary").to_pylist(),
                                        batch.column(2).cast("binary").to_pylist()):
                if conv != now:
                    if now is not None:
                        for a, b in zip(out, row()):
                            a.extend(b)
                    now, ids, sizes = conv, [], []
                ids.append(_id(role, text))
                sizes.append(len(text))
            if out[0]:
                yield _batch(_SEQUENCE, out)
        if now is not None:
            yield _batch(_SEQUENCE, row())

    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    ordered = (rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return ordered.select("conv_id", "role", "text").mapInArrow(run, _SEQUENCE)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batch(schema: str, columns) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def spliced(seqs: DataFrame, base: Column, turns: Column) -> DataFrame:
    """Each sequence with its first ``turns`` turns replaced by those of the sequence whose conv_id is ``base`` (by none where it is absent)."""
    part = lambda name, width: F.coalesce(F.expr(f"substring(__{name}, 1, __h * {width})"), F.lit(b""))
    rest = lambda name, width: F.expr(f"substring({name}, __h * {width} + 1, length({name}))")
    own = seqs.withColumn("__base", base).withColumn("__h", turns.cast("int"))
    head = seqs.select(F.col("conv_id").alias("__base"), F.col("ids").alias("__ids"), F.col("sizes").alias("__sizes"))
    asked = own.select("__base", "__h").groupBy("__base").agg(F.max("__h").alias("__most"))
    cut = (head.join(asked, "__base")
           .select("__base", F.expr(f"substring(__ids, 1, __most * {ID})").alias("__ids"), F.expr(f"substring(__sizes, 1, __most * {SIZE})").alias("__sizes")))
    return own.join(cut, "__base", "left").select(
        "conv_id", F.concat(part("ids", ID), rest("ids", ID)).alias("ids"),
        F.concat(part("sizes", SIZE), rest("sizes", SIZE)).alias("sizes"))


_KIND = "ids binary, sizes binary, keys binary, depth int, n long, low long, ends string"


def kinds(seqs: DataFrame) -> DataFrame:
    """One row per distinct sequence: how many conversations have it, the smallest, their hash, and ``keys``: an id for each of its prefixes."""
    def run(batches):
        now, held, n, low, digest = None, None, 0, 0, None

        def row():
            ids, sizes = held
            key, keys = b"", []
            for i in range(0, len(ids), ID):
                key = hashlib.sha256(key + ids[i:i + ID]).digest()[:ID]
                keys.append(key)
            return ids, sizes, b"".join(keys), len(keys), n, low, digest.hexdigest()

        for batch in batches:
            out = []
            for key, conv, ids, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        out.append(row())
                    now, held, n, low, digest = key, (ids, sizes), 0, conv, hashlib.sha256()
                digest.update(b"%d" % conv if n == 0 else b",%d" % conv)
                n += 1
            if out:
                yield _batch(_KIND, list(zip(*out)))
        if now is not None:
            yield _batch(_KIND, list(zip(row())))

    keyed = seqs.select(F.sha2("ids", 256).alias("key"), "conv_id", "ids", "sizes")
    return keyed.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, _KIND)


def _key(depth: Column) -> Column:
    """The prefix id of a depth; the root's is empty."""
    return F.when(depth == 0, F.lit(b"")).otherwise(F.substring(F.col("keys"), (depth - 1) * ID + 1, F.lit(ID)))


def _size(depth: Column) -> Column:
    """Bytes of the text of a depth's turn; 0 for the root."""
    raw = F.substring(F.col("sizes"), (depth - 1) * SIZE + 1, F.lit(SIZE))
    return F.when(depth == 0, F.lit(0)).otherwise(F.conv(F.hex(raw), 16, 10)).cast("long")


def burst(rows: DataFrame, limit: int = LIMIT, hop: int = HOP) -> tuple[DataFrame, DataFrame]:
    """(sequences with ``at``, the depth of their container's top; heads).  A sequence that ends at a head has ``at`` = depth + 1."""
    open_, settled, heads = rows.withColumn("at", F.lit(0)), None, None
    while True:
        levels = F.explode(F.sequence(F.col("at"), F.least(F.col("depth"), F.col("at") + hop - 1)))
        each = open_.select("*", levels.alias("d")).withColumn("key", _key(F.col("d")))
        mine = (each.groupBy("d", "key").agg(
            F.count("*").alias("kinds"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max(_size(F.col("d"))).alias("size"),
            F.max(F.when(F.col("d") == F.col("depth"), F.col("ends"))).alias("ends"),
            F.min(F.expr(f"substring(keys, 1, d * {ID})")).alias("path")).where(F.col("kinds") > limit))
        mine = stable(mine.select(F.col("d").alias("depth"), "key", "n", "low", "size", "ends", "path"))
        heads = mine if heads is None else heads.unionByName(mine)
        if mine.isEmpty():
            return (open_ if settled is None else settled.unionByName(open_)), heads
        # prefixes above the limit are the first ones of a sequence, without a gap
        passed = (each.select(F.sha2("ids", 256).alias("id"), "d", "key").join(mine.select(F.col("depth").alias("d"), "key"), ["d", "key"])
                  .groupBy("id").agg(F.max("d").alias("last")))
        moved = stable(open_.withColumn("id", F.sha2("ids", 256)).join(passed, "id", "left").drop("id")
                       .withColumn("more", F.coalesce(F.col("last") == F.col("at") + hop - 1, F.lit(False)))
                       .withColumn("at", F.coalesce(F.col("last") + 1, F.col("at"))).drop("last"))
        done = moved.where("not more or at > depth").drop("more")
        settled = done if settled is None else settled.unionByName(done)
        open_ = moved.where("more and at <= depth").drop("more")


_NODE = "top int, path binary, parent long, conv_id long, depth int, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _sweep(batches):
    """Rows sorted by (container, ids) -> nodes; a container's top has ``top`` 1, no parent yet and its path."""
    def close(node, out, above):
        """``node`` is complete: its children's rows go out, its own waits for the node above."""
        size = node["size"]
        for row in node["rows"]:
            row[2] = node["low"]
            out.append(row)
        leaves = node["leaves"] or 1
        saved = node["saved"] + (node["n"] - 1) * size
        row = [int(above is None), node["path"] if above is None else None, None, node["low"], node["depth"], node["n"], node["children"], leaves, saved, node["ends"]]
        if above is None:
            out.append(row)
            return
        above["rows"].append(row)
        above["n"] += node["n"]
        above["low"] = min(above["low"], node["low"])
        above["children"] += 1
        above["leaves"] += leaves
        above["saved"] += saved

    stack, last, now = [], b"", None

    def pop(depth, out):
        """Closes the nodes of the stack below ``depth``."""
        while stack and stack[-1]["depth"] > depth:
            node = stack.pop()
            close(node, out, stack[-1] if stack else None)

    for batch in batches:
        out = []
        for key, at, ids, sizes, keys, n, low, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if (at, key) != now:
                pop(-1, out)
                now, last = (at, key), b""
            same = min(len(last), len(ids)) // ID
            if stack:
                a, b = np.frombuffer(last, "V16", same), np.frombuffer(ids, "V16", same)
                differ = np.flatnonzero(a != b)
                same = int(differ[0]) if len(differ) else same
                pop(max(same, at), out)
            size = np.frombuffer(sizes, ">i8")
            # a node's numbers are of what is closed below it and of the sequences that end at it
            for depth in range(stack[-1]["depth"] + 1 if stack else at, len(size) + 1):
                stack.append({"depth": depth, "size": int(size[depth - 1]) if depth else 0, "n": 0, "low": low, "ends": _EMPTY, "children": 0,
                              "leaves": 0, "saved": 0, "rows": [], "path": keys[:at * ID] if depth == at else None})
            end = stack[-1]
            end["n"], end["low"], end["ends"] = end["n"] + n, min(end["low"], low), ends
            last = ids
        if out:
            yield _batch(_NODE, list(zip(*out)))
    out = []
    pop(-1, out)
    if out:
        yield _batch(_NODE, list(zip(*out)))


def build(seqs: DataFrame, limit: int = LIMIT, hop: int = HOP) -> DataFrame:
    """One row per node of the trie over ``seqs`` (conv_id, ids, sizes).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (of the subtree), ``ends_sha256``.
    """
    rows, heads = burst(written(kinds(seqs), "trie-kinds"), limit, hop)
    inside = rows.where("at <= depth").withColumn("key", _key(F.col("at")))
    nodes = written(inside.select("key", "at", "ids", "sizes", "keys", "n", "low", "ends").repartition("key", "at")
                    .sortWithinPartitions("at", "key", "ids").mapInArrow(_sweep, _NODE), "trie-nodes")
    deep = nodes.where("top = 0").select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    tops = nodes.where("top = 1")
    # what each top and head adds to the heads above (a head: to itself too); depth of a path = its ids
    adds = (tops.select(F.col("path").alias("keys"), (F.col("depth") - 1).alias("to"), "n_leaves", "saved_tokens", F.lit(1).alias("child"))
            .unionByName(heads.select(F.col("path").alias("keys"), F.col("depth").alias("to"), F.lit(0).cast("long").alias("n_leaves"),
                                      ((F.col("n") - 1) * F.col("size")).alias("saved_tokens"), F.lit(0).alias("child")))
            .unionByName(heads.select(F.col("path").alias("keys"), (F.col("depth") - 1).alias("to"), F.lit(0).cast("long").alias("n_leaves"),
                                      F.lit(0).cast("long").alias("saved_tokens"), F.lit(1).alias("child"))))
    sums = (adds.where("to >= 0").select("*", F.explode(F.sequence(F.lit(0), F.col("to"))).alias("d"))
            .groupBy("d", _key(F.col("d")).alias("key"))
            .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
                 F.sum(F.when(F.col("d") == F.col("to"), F.col("child")).otherwise(0)).cast("long").alias("n_children")))
    low = heads.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("above"), F.col("low").alias("parent_conv_id"))

    def under(df: DataFrame) -> DataFrame:
        """``df`` (keys, depth) with the smallest member of the head right above, null for the root."""
        return df.withColumn("above", F.when(F.col("depth") > 0, _key(F.col("depth") - 1))).join(low, ["depth", "above"], "left")

    columns = deep.columns
    top = under(tops.withColumnRenamed("path", "keys")).select(*columns)
    upper = (under(heads.withColumnRenamed("path", "keys")).join(sums.withColumnRenamed("d", "depth"), ["depth", "key"])
             .withColumn("conv_id", F.col("low")).withColumn("n_convs", F.col("n"))
             .withColumn("ends_sha256", F.coalesce("ends", F.lit(_EMPTY))).select(*columns))
    return deep.unionByName(top).unionByName(upper).withColumn("depth", F.col("depth").cast("long"))
