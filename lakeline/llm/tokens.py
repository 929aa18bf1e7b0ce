"""Encoding a corpus with a public byte-level BPE by forced boundaries (problem 7).

A pair of bytes that occurs inside no token of the vocabulary can never be merged over, so a text may
be cut there with certainty. The pair table (65,536 flags) follows from the vocabulary. Cuts are
further limited to places where the splitting pattern of the tokenizer sees the same on both sides:
between two characters of which the first is no white space and the second no apostrophe (white
space looks ahead to what follows it; an apostrophe may begin a contraction). The pieces of an Arrow
batch are cut with numpy over its bytes, reduced to distinct ones, encoded once each, and concatenated by
offsets: there is no Python loop over documents, and a very long text is pieces like any other.

Defined ids: null and empty texts have the empty list. Text that spells a special token is ordinary.
Each row is encoded whatever other rows hold; repeated rows are encoded as often as they stand.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The vocabulary file (token bytes in base64 and rank a line); a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published splitting pattern of this tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CACHE_LIMIT = 400_000  # distinct pieces remembered by one worker; beyond it the memory is emptied


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The file's bytes; they travel to the workers (under 1 MB), which need no such file."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def _ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}


def forced_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Flags by first byte * 256 + second byte: true where no token holds the two in a row."""
    forced = np.ones(65536, dtype=bool)
    whole = np.frombuffer(b"".join(ranks), dtype=np.uint8).astype(np.int32)
    ends = np.cumsum(np.fromiter(map(len, ranks), dtype=np.int64, count=len(ranks)))
    inside = np.ones(max(len(whole) - 1, 0), dtype=bool)
    inside[ends[:-1] - 1] = False
    forced[(whole[:-1] * 256 + whole[1:])[inside]] = False
    return forced


def _cut_table(ranks: dict[bytes, int]) -> np.ndarray:
    """``forced_pairs`` where the pattern allows a cut, told by the two bytes alone."""
    cut = forced_pairs(ranks).reshape(256, 256).copy()
    cut[:, 0x80:0xC0] = False  # inside a character
    cut[:, 0x27] = False  # before an apostrophe
    cut[[*range(0x09, 0x0E), *range(0x1C, 0x21)], :] = False  # after ASCII white space
    # Last bytes that end some white space character beyond ASCII; letters that share them are cut less often, which is safe.
    cut[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F, 0x8E], :] = False
    return cut.reshape(-1)


class Encoder:
    """Encodes Arrow string columns; one per worker and vocabulary."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        import tiktoken

        ranks = _ranks(vocabulary)
        self.bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = _cut_table(ranks)
        self.known: dict[bytes, np.ndarray] = {}

    def pieces(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Offsets of the pieces of concatenated texts that begin at ``starts``; every start is one."""
        first = np.zeros(len(data) + 1, dtype=bool)
        first[starts] = True
        if len(data) > 1:
            first[1 : len(data)] |= self.cut[data[:-1].astype(np.int32) * 256 + data[1:]]
        first[len(data)] = True
        return np.flatnonzero(first)

    def _encode(self, piece: bytes) -> np.ndarray:
        ids = self.known.get(piece)
        if ids is None:
            if len(self.known) >= _CACHE_LIMIT:
                self.known.clear()
            ids = self.known[piece] = np.array(self.bpe.encode_ordinary(piece.decode("utf-8")), dtype=np.int32)
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets by text); null and empty texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
        low, high = int(offsets[0]) if n else 0, int(offsets[-1]) if n else 0
        if high == low:
            return np.empty(0, np.int32), np.zeros(n + 1, np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[low:high]
        starts = offsets - low
        at = self.pieces(data, starts[:-1][starts[:-1] < len(data)])
        binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        distinct = binary.dictionary_encode()
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        ids = [self._encode(p) for p in distinct.dictionary.to_pylist()]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        base = np.cumsum(lengths) - lengths
        each = lengths[codes]
        ends = np.cumsum(each)
        out = flat[np.repeat(base[codes] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)]
        # Tokens before the piece at which a text begins.
        before = np.concatenate([[0], ends])
        return out.astype(np.int32, copy=False), before[np.searchsorted(at, starts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    sign = hashlib.sha256(vocabulary).hexdigest()
    if sign not in _ENCODERS:
        _ENCODERS[sign] = Encoder(vocabulary)
    return _ENCODERS[sign]


def _mapped(df: DataFrame, text: str, out: str, kind: T.DataType, values, vocabulary: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # under 1 MB by its nature
    kept = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(shared.value)
        for batch in batches:
            # Batches of few rows with huge texts and of many rows alike are cut so that offsets stay small.
            for part in _sliced(batch, text):
                got = values(*code.encode(part.column(text)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), got], names=[*kept, out])

    return df.mapInArrow(run, schema)


def _sliced(batch: pa.RecordBatch, text: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def encode_column(df: DataFrame, text: str, out: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with ``out`` (list of token ids) in place of ``text``; the other columns stay."""
    return _mapped(df, text, out, T.ArrayType(T.IntegerType()), lambda ids, at: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)), vocabulary)


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with the number of tokens of ``text`` in its place."""
    return _mapped(df, text, out, T.LongType(), lambda _, at: pa.array(np.diff(at)), vocabulary)
