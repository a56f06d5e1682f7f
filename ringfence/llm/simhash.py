"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves.  If two fingerprints differ in at
most three bits, one half differs in at most one.  Each half is indexed under its
32 one-wildcard variants (one bit cleared, its place noted), so two halves that
differ in at most one bit share a variant: an equality join on the variant finds
every candidate, and the bit distance of the whole fingerprints verifies it.

Only distinct fingerprints are indexed.  A variant's fingerprints are linked by a
spanning forest, not by all pairs.  A variant with more than ``BLOCK`` fingerprints
is dealt out over pairs of blocks, each of bounded size, which compares every pair
of it all the same.

Cases: null text counts as empty; a text without words has fingerprint zero; equal
fingerprints always share a component; repeated rows and repeated ids are each
returned; a null id never names a component that has another id; an empty table
gives an empty table; other columns are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, stable
from .text import body, encode

SHINGLE, BITS, SEED = 3, 3, 42
#: Fingerprints of one variant that one task compares in one piece.
BLOCK = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: the majority of the XXH64 values of its word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    gap = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    ends = np.append(gap, len(joined))
    starts = np.append(0, gap + 1)
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:len(starts) - k + 1].tolist(), ends[k - 1:].tolist())],
                      dtype=np.uint64)
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    major = 2 * bits.sum(axis=0, dtype=np.int64) > len(values)
    return int(np.packbits(major, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with a signed 64-bit column ``name``."""
    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t, shingle) for t in encode(texts)), np.uint64, len(texts))
        return pa.array(out.view(np.int64))
    return docs.withColumn(name, fp(body(text)))


def _forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that span the links among ``values``: breadth first, each value is reached once."""
    left = np.ones(len(values), bool)
    out = []
    for i in range(len(values)):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            at = todo.pop()
            near = np.flatnonzero(left & (np.bitwise_count(values ^ values[at]) <= bits))
            left[near] = False
            out.extend((int(values[at]), int(values[j])) for j in near)
            todo.extend(near.tolist())
    return out


def _links(key: np.ndarray, value: np.ndarray, bits: int):
    """Spanning links inside each run of equal keys."""
    edge = np.flatnonzero(key[1:] != key[:-1]) + 1
    first = np.append(0, edge)
    size = np.diff(np.append(first, len(key)))
    two = first[size == 2]
    near = two[np.bitwise_count(value[two] ^ value[two + 1]) <= bits]
    a, b = [value[near]], [value[near + 1]]
    for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
        if found := _forest(value[at:at + n], bits):
            x = np.array(found, np.int64)
            a.append(x[:, 0])
            b.append(x[:, 1])
    return np.concatenate(a), np.concatenate(b)


def _search(bits: int, block: int | None):
    """Arrow batches sorted by key -> (kind, a, b): kind 0 a link, kind 1 a (key, value) of a key with over ``block`` values."""
    def run(batches):
        held_k, held_v = np.empty(0, np.int64), np.empty(0, np.int64)
        large = None

        def pack(kind, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], ["kind", "a", "b"])

        def split(key, value, end):
            """What of the held rows can be settled; the last key's rows wait for more unless ``end``."""
            nonlocal large, held_k, held_v
            if large is not None:
                n = int(np.searchsorted(key, large, "right"))
                if n:
                    yield pack(1, key[:n], value[:n])
                key, value = key[n:], value[n:]
                if len(key):
                    large = None
            cut = len(key) if end or not len(key) else int(np.searchsorted(key, key[-1], "left"))
            if cut:
                k, v = key[:cut], value[:cut]
                if block is not None:
                    _, index, size = np.unique(k, return_inverse=True, return_counts=True)
                    big = size[index] > block
                    if big.any():
                        yield pack(1, k[big], v[big])
                        k, v = k[~big], v[~big]
                if len(k):
                    yield pack(0, *_links(k, v, bits))
            held_k, held_v = key[cut:], value[cut:]
            if block is not None and len(held_k) > block:
                large = held_k[0]
                yield pack(1, held_k, held_v)
                held_k, held_v = held_k[:0], held_v[:0]

        for batch in batches:
            yield from split(np.concatenate([held_k, batch.column(0).to_numpy()]), np.concatenate([held_v, batch.column(1).to_numpy()]), False)
        yield from split(held_k, held_v, True)
    return run


_FOUND = "kind int, a long, b long"


def links(values: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) that span all links among the distinct 64-bit column ``fp`` of ``values``.  Holds for ``bits`` up to 3."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with one wildcard each serve distances from 0 to 3")
    v = F.col("v")
    half = F.when(v < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned(F.col("fp"), 32))
    one = F.expr("shiftleft(1L, cast(v % 32 as int))")
    keyed = (values.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
             .select(F.expr("shiftleft(cast(v as bigint), 32)").bitwiseOR(half.bitwiseAND(F.bitwise_not(one))).alias("k"), "fp"))
    found = stable(keyed.repartition("k").sortWithinPartitions("k", "fp").mapInArrow(_search(bits, block), _FOUND).distinct())
    near, rest = found.where("kind = 0").select("a", "b"), found.where("kind = 1")
    size = rest.groupBy("a").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("g"))
    mine = F.pmod(F.xxhash64("b"), F.col("g")).cast("int")
    other = F.col("o")
    dealt = (rest.join(size, "a").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
             .select(F.xxhash64("a", F.least(mine, other), F.greatest(mine, other)).alias("k"), F.col("b").alias("fp")))
    more = dealt.repartition("k").sortWithinPartitions("k", "fp").mapInArrow(_search(bits, None), _FOUND)
    return near.unionByName(more.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp``, ``root`` (the component) and ``component_id`` (its smallest id)."""
    prints = stable(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "fp", shingle)
                    .select("doc_id", "fp"))
    kinds = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    root = kinds.join(components(links(kinds.select("fp"), bits, block)).withColumnRenamed("node", "fp"), "fp", "left")
    root = root.withColumn("root", F.coalesce("root", "fp"))
    named = root.join(root.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` less its near duplicates: of each component the row with the smallest id stays, and one of them if that id repeats."""
    found = stable(near_duplicates(docs, doc_id, text, shingle, bits))
    low = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    odd = found.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("__odd"))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__odd"))
    single = low.select(F.col("doc_id").alias("__odd")).join(odd, "__odd", "left_anti").where("__odd is not null")
    own = [F.col(f"`{x}`") for x in docs.columns]
    winner = low.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), F.col("component_id").alias("__low")).distinct()
    # ids that several rows share, or none: only for these rows the fingerprint tells which of them is meant
    shared = (with_fingerprint(docs.join(odd, same, "left_semi"), text, "__fp", shingle).join(winner, "__fp")
              .where(F.col(f"`{doc_id}`").eqNullSafe(F.col("__low"))).dropDuplicates(["__root"]))
    return (docs.join(single, F.col(f"`{doc_id}`") == F.col("__odd"), "left_semi").select(*own)
            .unionByName(shared.select(*own)))
