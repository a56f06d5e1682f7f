"""Token ids in Arrow files of equal-length sequences.

``write`` encodes documents in ascending id order into one part per range of ids.
A part is an Arrow IPC file whose record batches hold fixed-size lists: ``ids``
(16-bit where the vocabulary allows, else 32-bit) and ``mask`` (false where the
last sequence is padded).  Nothing is compressed, so a memory-mapped part gives any
sequence as a view (``Sequences``).  Documents run on across sequences; a side file
of the part has each document's id, first token and token count.  Parts are written
under a name of the attempt and moved into place, so a repeated task writes the
same part again and no reader sees half of one.

Encoding is exact: a text is cut only where white space follows something else,
which the tokenizer's own splitting never crosses, and each distinct piece is
encoded once per worker while it stays in a table of bounded size.

Cases: null text counts as empty and gives the end id alone; null ids come first;
rows with equal ids follow each other in the order of a hash of their texts;
repeated rows are written each; texts of any length are encoded whole; no rows give
no parts; other columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .graph import stable
from .text import _VALUE, _mix, _powers, body

LENGTH, ROWS, PIECES = 1024, 256, 2_000_000

def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space."""
    out = (data == 32) | ((data >= 9) & (data <= 13))
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        one = data[lead]
        two, three = (data[np.minimum(lead + i, len(data) - 1)] for i in (1, 2))
        short = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        long = (one == 0xE1) & (two == 0x9A) & (three == 0x80) | (one == 0xE3) & (two == 0x80) & (three == 0x80)
        long |= (one == 0xE2) & (two == 0x80) & ((three >= 0x80) & (three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
        long |= (one == 0xE2) & (two == 0x81) & (three == 0x9F)
        for at, width in ((lead[short], 2), (lead[long], 3)):
            for i in range(width):
                out[at + i] = True
    return out


class Encoder:
    """Texts to packed ids, each distinct piece (white space and the word after it) encoded once.

    Pieces are found and hashed in numpy and looked up by 64-bit hash among the worker's
    at most ``PIECES`` known ones; no object is made for a piece that is known.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.kind = Tokenizer.from_file(path), np.dtype(kind)
        # hashes ascending, and for each its ids' place and number in ``flat``
        self.hash, self.at, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, self.kind)

    def _known(self, raw: bytes, start: np.ndarray, end: np.ndarray, hashed: np.ndarray, first: np.ndarray):
        """(hash, at, size, flat) with the pieces of ``hashed`` (distinct, ascending; ``first`` occurrences) among them."""
        place = np.searchsorted(self.hash, hashed)
        new = np.append(self.hash, np.uint64(0))[place] != hashed
        new |= place == len(self.hash)
        if not new.any():
            return self.hash, self.at, self.size, self.flat
        pieces = [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())]
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.append(self.flat, np.fromiter(itertools.chain.from_iterable(ids), self.kind, int(size.sum())))
        at = len(self.flat) + np.cumsum(size) - size
        out = (np.insert(self.hash, place[new], hashed[new]), np.insert(self.at, place[new], at), np.insert(self.size, place[new], size), flat)
        if len(out[0]) <= PIECES:  # a full table keeps what came first, which frequent pieces do
            self.hash, self.at, self.size, self.flat = out
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        raws = [t.encode() for t in texts]
        raw = b"".join(raws)
        if not raw:
            return [b""] * len(texts)
        data = np.frombuffer(raw, np.uint8)
        bound = np.append(0, np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws))))
        space = _spaces(data)
        head = space & ~np.append(False, space[:-1])
        head[bound[:-1][bound[:-1] < bound[1:]]] = True
        start = np.flatnonzero(head)
        end = np.append(start[1:], len(data))
        power, inverse = _powers(len(data))
        total = np.append(np.uint64(0), np.cumsum(_VALUE[data] * power, dtype=np.uint64))
        hashed, first, kind = np.unique(_mix((total[end] - total[start]) * inverse[start]), return_index=True, return_inverse=True)
        known, at, size, flat = self._known(raw, start, end, hashed, first)
        place = np.searchsorted(known, hashed)
        n, off = size[place][kind], at[place][kind]
        done = np.append(0, np.cumsum(n))
        ids = flat[np.repeat(off - done[:-1], n) + np.arange(done[-1])]
        cut = done[np.searchsorted(start, bound)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The worker's own encoder: it lives as long as the worker."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]


def _schema(kind: str, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(kind)), length)), ("mask", pa.list_(pa.bool_(), length))])


_SIDE = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])


def _batch(ids: np.ndarray, real: int, length: int, schema: pa.Schema) -> pa.RecordBatch:
    full = np.zeros(-(-len(ids) // length) * length, ids.dtype)
    full[:len(ids)] = ids
    mask = pa.array(np.arange(len(full)) < real)
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(full), length),
                                       pa.FixedSizeListArray.from_arrays(mask, length)], schema=schema)


def _write_part(batches, folder: str, name: str, tokenizer: str, kind: str, end_id: int, length: int):
    """Writes one part from Arrow batches of (doc_id, text); its documents and tokens."""
    fs, root = pafs.FileSystem.from_uri(folder)
    end, schema = np.array([end_id], kind).tobytes(), _schema(kind, length)
    code, piece, size = encoder(tokenizer, kind), length * ROWS, np.dtype(kind).itemsize
    held, n_held, total, docs = [], 0, 0, 0
    temporary = {x: f"{root}/_{uuid.uuid4().hex}.{x}" for x in ("seq", "doc")}
    with fs.open_output_stream(temporary["seq"]) as out, fs.open_output_stream(temporary["doc"]) as side, \
            pa.ipc.new_file(out, schema) as seq, pa.ipc.new_file(side, _SIDE) as index:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = []
            at = 0
            while at < len(texts):  # a few MB of text at a time
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) <= 1 << 21):
                    chars += len(texts[to])
                    to += 1
                for got in code(texts[at:to]):
                    held.append(got + end)
                    counts.append(len(held[-1]) // size)
                    n_held += counts[-1]
                if n_held >= piece:
                    ids = np.frombuffer(b"".join(held), kind)
                    for a in range(0, len(ids) - piece + 1, piece):
                        seq.write_batch(_batch(ids[a:a + piece], piece, length, schema))
                    rest = ids[len(ids) // piece * piece:]
                    held, n_held = [rest.tobytes()], len(rest)
                at = to
            n = np.array(counts, np.int64)
            index.write_batch(pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(total + np.cumsum(n) - n), pa.array(n)], schema=_SIDE))
            total, docs = total + int(n.sum()), docs + len(n)
        if n_held:
            ids = np.frombuffer(b"".join(held), kind)
            seq.write_batch(_batch(ids, len(ids), length, schema))
    for x, at in temporary.items():
        if docs:
            fs.move(at, f"{root}/{name}.{x}")
        else:
            fs.delete_file(at)
    return docs, total


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, doc_id: str = "doc_id", text: str = "text",
          length: int = LENGTH) -> list[tuple[str, int, int, int]]:
    """Writes all rows of ``docs``; (part, documents, start, tokens) of each part in order.

    ``tokenizer`` is the path of a tokenizers file on every worker.  The list has one
    entry per part, so it grows with the number of files alone.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens", unique=True)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
    jfs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    jfs.mkdirs(jpath)
    folder = jfs.makeQualified(jpath).toString().replace("file:/", "file:///", 1) if jfs.getScheme() == "file" else jfs.makeQualified(jpath).toString()
    from tokenizers import Tokenizer
    kind = "<u2" if max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values()) < 1 << 16 else "<u4"

    def run(batches):
        name = f"part-{TaskContext.get().partitionId():07d}"
        n, tokens = _write_part(batches, folder, name, tokenizer, kind, end_id, length)
        if n:
            yield pa.RecordBatch.from_pydict({"part": [f"{folder}/{name}"], "docs": [n], "tokens": [tokens]})

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body(F.col(f"`{text}`")).alias("text"))
    tie = F.xxhash64("text")
    made = (rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
            .mapInArrow(run, "part string, docs long, tokens long"))
    out, start = [], 0
    for part, n, tokens in sorted(tuple(r) for r in stable(made).collect()):
        out.append((part, n, start, tokens))
        start += tokens
    return out


class Sequences:
    """Random access to the equal-length sequences of one part; local parts are memory-mapped and never copied."""

    def __init__(self, part: str):
        fs, path = pafs.FileSystem.from_uri(f"{part}.seq")
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches

    def flat(self, batch: int) -> np.ndarray:
        """The ids of one record batch, end to end, as a view."""
        return self.reader.get_batch(batch).column(0).values.to_numpy()

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = self.reader.get_batch(i // ROWS), i % ROWS
        return (batch.column(0).values.to_numpy()[row * self.length:(row + 1) * self.length],
                batch.column(1).values.slice(row * self.length, self.length).to_numpy(zero_copy_only=False))

    def tokens(self, first: int, n: int) -> np.ndarray:
        """``n`` ids from place ``first`` of the part's stream."""
        per, out = self.length * ROWS, []
        while n:
            got = self.flat(first // per)[first % per:first % per + n]
            out.append(got)
            first, n = first + len(got), n - len(got)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, np.uint16)


def read(spark: SparkSession, parts: list[tuple[str, int, int, int]], per_document, schema: str) -> DataFrame:
    """doc_id, start, n_tokens and what ``per_document(ids)`` gives (``schema``: name and type), read from the files."""
    name = schema.split()[0]

    def run(batches):
        for batch in batches:
            for part, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seq = Sequences(part)
                fs, path = pafs.FileSystem.from_uri(f"{part}.doc")
                with fs.open_input_file(path) as side:
                    index = pa.ipc.open_file(side)
                    for b in range(index.num_record_batches):
                        got = index.get_batch(b)
                        extra = [per_document(seq.tokens(a, n)) for a, n in zip(got.column(1).to_pylist(), got.column(2).to_pylist())]
                        yield pa.RecordBatch.from_arrays([got.column(0), pa.array(got.column(1).to_numpy() + start), got.column(2), pa.array(extra)],
                                                         ["doc_id", "start", "n_tokens", name])

    listed = spark.createDataFrame([(p, s) for p, _, s, _ in parts], "part string, start long")
    return listed.repartitionByRange(max(1, len(parts)), "part").mapInArrow(run, f"doc_id long, start long, n_tokens long, {schema}")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
