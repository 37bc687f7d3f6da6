"""Byte-level BPE encoding and decoding by forced boundaries.

A byte pair that occurs inside no vocabulary token can't be inside any token of
an encoding: every place where it stands in a text is a certain cut.  The text is
cut there, each fragment is encoded by itself and the ids are put together; the
result is that of encoding the whole text.  Fragments are about as long as words,
so the distinct ones of a slice are few and each is encoded once.

The tokenizer's own splitting pattern looks at neighbouring characters, so a cut
is made only where it can't see the difference: not after white space (a run of it
looks at what follows), not before an apostrophe nor inside a contraction, and
not inside a character.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import textscan
from .common import batched, set_aside

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The usual splitting pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SLICE = 12 << 20
#: Bytes with which a white-space character may end: ASCII ones and the last
#: bytes of the others in UTF-8.
_SPACE_ENDS = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F, *range(0x80, 0x8B)]
#: Fragments that a worker remembers.
_REMEMBERED = 400_000


def load(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary file (base64 and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def certain_cuts(tokens: Iterator[bytes]) -> np.ndarray:
    """65,536 booleans: whether the pair (first byte * 256 + second) is a cut."""
    cut = np.ones((256, 256), bool)
    for t in tokens:
        for a, b in zip(t, t[1:]):
            cut[a, b] = False
    cut[_SPACE_ENDS, :] = False
    cut[:, ord("'")] = False
    cut[ord("'"), :] = False
    for a, b in ("re", "ve", "ll"):
        cut[ord(a), ord(b)] = False
    cut[:, 0x80:0xC0] = False
    return cut.ravel()


class Codec:
    """Encodes and decodes Arrow arrays with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = certain_cuts(iter(ranks))
        size = max(ranks.values()) + 1
        self.pieces = [b""] * size
        for t, i in ranks.items():
            self.pieces[i] = t
        self.known: dict[bytes, list[int]] = {}
        lengths = np.array([len(t) for t in self.pieces])
        self.length, self.begin = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(self.pieces), np.uint8)

    def fragments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The fragments of all rows as one binary array over the texts' buffer,
        and the number of them before each row and after the last."""
        off, data = textscan.buffers(texts)
        if not len(data):
            return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
        pair = data[:-1].astype(np.uint16)
        pair <<= 8
        pair |= data[1:]
        at = np.zeros(len(data) + 1, bool)
        at[1:-1] = self.cut[pair]
        at[off] = True
        cuts = np.flatnonzero(at)
        frag = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])
        return frag, np.searchsorted(cuts, off)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets of the rows) for slices of the rows, in order.  A NULL
        text is ''."""
        for _, part in textscan.slices(texts, _SLICE):
            frag, rows = self.fragments(part)
            if not len(frag):
                yield np.zeros(0, np.int32), rows
                continue
            coded = frag.dictionary_encode()
            if len(self.known) > _REMEMBERED:
                self.known.clear()
            known, encode = self.known, self.encoding.encode_ordinary
            own = []
            for x in coded.dictionary.to_pylist():
                ids = known.get(x)
                if ids is None:
                    known[x] = ids = encode(x.decode())
                own.append(ids)
            n = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.fromiter((i for ids in own for i in ids), np.int32, int(n.sum()))
            first = np.cumsum(n) - n
            which = coded.indices.to_numpy()
            count = n[which]
            end = np.cumsum(count)
            ids = flat[np.arange(end[-1]) + np.repeat(first[which] - (end - count), count)]
            yield ids, np.r_[0, end][rows]

    def decode_bytes(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, bytes) of the rows whose ids lie between the offsets."""
        count = self.length[ids]
        end = np.cumsum(count)
        out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
        step = 1 << 20
        for i in range(0, len(ids), step):
            c = count[i : i + step]
            e = np.cumsum(c)
            lo = end[i] - count[i]
            out[lo : lo + e[-1]] = self.bytes[np.arange(e[-1]) + np.repeat(self.begin[ids[i : i + step]] - (e - c), c)]
        return np.r_[0, end][offsets], out

    def decode(self, tokens: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; NULL for NULL, and bytes that aren't UTF-8
        are replaced."""
        return pa.array([None if t is None else b"".join(self.pieces[i] for i in t).decode("utf-8", "replace") for t in tokens.to_pylist()], pa.string())


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec for a broadcast (ranks, pattern)."""
    if shared.value[0] not in _codecs:
        _codecs.clear()
        _codecs[shared.value[0]] = Codec(shared.value[1], shared.value[2])
    return _codecs[shared.value[0]]


def share(spark: SparkSession, path: str = VOCABULARY, pattern: str = PATTERN):
    """A broadcast of the vocabulary, read on the driver: its size doesn't depend
    on the corpus, and executors need no copy of the file."""
    return spark.sparkContext.broadcast((f"{path}\n{pattern}", load(path), pattern))


def encode(spark: SparkSession, docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``tokens`` array<int>, ``n_tokens`` int and ``round_trip``
    boolean (whether the ids decode to the text's very bytes).

    A NULL or empty text has no tokens.  Rows are independent of each other:
    repeated ones have the same ids, a very long text is encoded whole, and an empty
    table gives an empty one.  Clashing columns of the input get the prefix
    ``input_``.  ``keep_text=False`` leaves the text out.
    """
    docs, renamed = set_aside(docs, "tokens", "n_tokens", "round_trip")
    text = renamed.get(text, text)
    shared, at = share(spark, path, pattern), docs.columns.index(text)
    fields = [f for f in docs.schema.fields if keep_text or f.name != text]
    stay = [i for i, c in enumerate(docs.columns) if keep_text or c != text]
    schema = T.StructType([*fields, T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for b in batches:
            done = 0
            for (_, part), (ids, off) in zip(textscan.slices(b.column(at), _SLICE), codec.encode(b.column(at))):
                text_off, data = textscan.buffers(part)
                back_off, back = codec.decode_bytes(ids, off)
                same = np.array_equal(back, data) and np.array_equal(back_off, text_off)
                good = np.ones(len(part), bool) if same else np.array([back[back_off[i] : back_off[i + 1]].tobytes() == data[text_off[i] : text_off[i + 1]].tobytes() for i in range(len(part))])
                tokens = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))
                rows = b.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in stay), tokens, pa.array(np.diff(off).astype(np.int32)), pa.array(good)], schema.names)

    return docs.transform(batched).mapInArrow(run, schema)


def decode(spark: SparkSession, coded: DataFrame, path: str = VOCABULARY, tokens: str = "tokens") -> DataFrame:
    """``coded`` with ``decoded`` string, from its lists of ids: NULL for NULL, ''
    for no ids.  Rows are independent of each other, however long or often repeated,
    and an empty table gives an empty one.  A clashing column ``decoded`` gets the
    prefix ``input_``."""
    coded, renamed = set_aside(coded, "decoded")
    tokens = renamed.get(tokens, tokens)
    shared, at = share(spark, path), coded.columns.index(tokens)
    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, codec.decode(b.column(at))], schema.names)

    return coded.transform(batched).mapInArrow(run, schema)
