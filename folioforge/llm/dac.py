"""Token ids as directly addressable codes (Brisaboa, Ladra and Navarro).

An id is split into chunks of 8 bits, the lowest on level 0.  A level holds the
chunks of the ids that reach it, a bitmap that tells which of them go on, and a
rank directory: the count of set bits before each block of 512.  Token ``i`` is
read by its chunk on level 0 and, while the bit is set, by the chunk at the bit's
rank on the next level: a few bytes, wherever the token is.

Layout, little-endian: ``D`` ``A`` ``C`` and the number of levels, one byte each;
the number of ids (8 bytes); then for each level its count (8 bytes), its chunks
and, but for the last level, its directory (4 bytes a block) and its bitmap.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import bpe
from .common import batched, set_aside

BLOCK = 512
_MAGIC = b"DAC"


def encode(ids: np.ndarray) -> bytes:
    """The code of non-negative ids."""
    rest = np.asarray(ids)
    if len(rest) and rest.min() < 0:
        raise ValueError("ids can't be negative")
    rest = rest.astype(np.uint64 if len(rest) and rest.max() >= 1 << 32 else np.uint32)
    levels = []
    while True:
        on = rest > 255
        more = bool(on.any())
        part = [struct.pack("<Q", len(rest)), rest.astype(np.uint8).tobytes()]
        if more:
            before = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.uint32)
            part += [(np.cumsum(before, dtype=np.uint32) - before).astype("<u4").tobytes(), np.packbits(on, bitorder="little").tobytes()]
        levels.append(b"".join(part))
        if not more:
            return b"".join([_MAGIC, bytes([len(levels)]), struct.pack("<Q", len(ids)), *levels])
        rest = rest[on] >> 8


class Reader:
    """Random access to a code, without decoding any of it first."""

    def __init__(self, code: bytes):
        if code[:3] != _MAGIC:
            raise ValueError("not a code of this kind")
        self.code, self.levels, at = memoryview(code), [], 12
        for k in range(code[3]):
            n = int.from_bytes(code[at : at + 8], "little")
            chunks = at + 8
            directory = chunks + n
            bits = directory + 4 * -(-n // BLOCK)
            self.levels.append((n, chunks, directory, bits))
            at = bits + -(-n // 8)
        self.size = int.from_bytes(code[4:12], "little")

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        if not -self.size <= i < self.size:
            raise IndexError(i)
        i, out, code = i % self.size, 0, self.code
        for k, (_, chunks, directory, bits) in enumerate(self.levels):
            out |= code[chunks + i] << 8 * k
            if k == len(self.levels) - 1 or not code[bits + i // 8] >> i % 8 & 1:
                break
            block = i // BLOCK
            lo, n = block * (BLOCK // 8), i - block * BLOCK
            set_here = int.from_bytes(code[bits + lo : bits + lo + -(-n // 8)], "little") & (1 << n) - 1
            i = int.from_bytes(code[directory + 4 * block : directory + 4 * block + 4], "little") + set_here.bit_count()
        return out

    def to_numpy(self) -> np.ndarray:
        """All ids."""
        out, reach = np.zeros(self.size, np.int64), np.arange(self.size)
        for k, (n, chunks, _, bits) in enumerate(self.levels):
            out[reach] |= np.frombuffer(self.code[chunks : chunks + n], np.uint8).astype(np.int64) << 8 * k
            if k < len(self.levels) - 1:
                on = np.unpackbits(np.frombuffer(self.code[bits : bits + -(-n // 8)], np.uint8), count=n, bitorder="little")
                reach = reach[on.astype(bool)]
        return out


def encode_lists(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``df`` with ``code`` binary in the place of the ids.

    A NULL list has a NULL code, an empty list the code of no ids; NULL ids in a
    list are left out.  Rows are independent of each other: a repeated one has the
    same code, a very long list one code, and an empty table gives an empty one.  A
    clashing column ``code`` gets the prefix ``input_``.
    """
    df, renamed = set_aside(df, "code")
    tokens = renamed.get(tokens, tokens)
    at = df.columns.index(tokens)
    schema = T.StructType([T.StructField("code", T.BinaryType()) if f.name == tokens else f for f in df.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(at):
                ids = x.values
                out.append(None if ids is None else encode((ids.drop_null() if ids.null_count else ids).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()) if i == at else c for i, c in enumerate(b.columns)], schema.names)

    return df.transform(batched).mapInArrow(run, schema)


def pick(df: DataFrame, code: str = "code", position: str = "position") -> DataFrame:
    """``df`` with ``token``: the id at ``position`` of each row's code; NULL
    where either is NULL or the position is outside.  Repeated rows have the same
    token, a position in a very long code is found as in a short one, and an empty
    table gives an empty one.  A clashing column ``token`` gets the prefix
    ``input_``."""
    df, renamed = set_aside(df, "token")
    code, position = renamed.get(code, code), renamed.get(position, position)
    schema = T.StructType([*df.schema.fields, T.StructField("token", T.LongType())])
    at, where = df.columns.index(code), df.columns.index(position)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for c, i in zip(b.column(at), b.column(where).to_pylist()):
                r = Reader(c.as_py()) if c.is_valid and i is not None else None
                out.append(r[i] if r is not None and 0 <= i < len(r) else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], schema.names)

    return df.transform(batched).mapInArrow(run, schema)


def encode_texts(spark: SparkSession, docs: DataFrame, path: str = bpe.VOCABULARY, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, code): each document's token ids as a code.

    A NULL or empty text has the code of no ids; every row of the input, also a
    repeated one or one with a NULL ``doc_id``, has a row.  ``doc_id`` is an integer
    column.  A very long text is one code; an empty table gives an empty one; other
    columns of the input, whatever their names, are left out.
    """
    shared = bpe.share(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe._codec(shared)
        for b in batches:
            done = 0
            for ids, off in codec.encode(b.column(1)):
                n = len(off) - 1
                codes = [encode(ids[off[i] : off[i + 1]]) for i in range(n)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(done, n), pa.array(np.diff(off).astype(np.int32)), pa.array(codes, pa.binary())], ["doc_id", "n_tokens", "code"])
                done += n

    return docs.selectExpr("cast(doc_id as long) as doc_id", f"`{text}` as text").transform(batched).mapInArrow(run, "doc_id long, n_tokens int, code binary")
