"""Packing documents into training sequences along a space-filling curve.

Each document's tokens are projected to a few dimensions by signs hashed from the token ids; the
cell of the projection gets its place on a Hilbert curve, so that documents with like tokens lie
close together. Documents are range-sorted by that place and laid end to end within each range;
the stream is cut into sequences of SEQUENCE tokens wherever it happens to be. What is left at
the end of a range is cut into sequences of powers of two, so no sequence needs padding.

Tokens are computed once and written; the range sort moves them once, as 16-bit ids where the
vocabulary allows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import add_columns, held, joined_schema, staged

SEQUENCE, CLOSE = 1024, 0
DIMENSIONS, CELL_BITS = 3, 10
#: Tokens a range should hold, and ranges at most: beyond, ranges grow, which their sort spills.
RANGE_TOKENS, RANGES = 4_000_000, 20_000
PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Fixed value: how byte-level BPE cuts a text before merging.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class has been the same in every version of Unicode for long.
_COMMON = re.compile(r"[\n -~\u00a1-\u024f\u0400-\u045f\u2010-\u2027]*")


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level tokenizer files write bytes as: printable ones stand for
    themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by a tokenizer file, as 16-bit numbers where the vocabulary allows.

    `tokenizers` defines the ids. For byte-level BPE files, texts of common letters take the same
    vocabulary and merges through `tiktoken`, several times as fast; other texts, in which the
    two libraries' letter and blank classes could differ or an added token's string occurs (which
    `tokenizers` takes as that token), and other files take `tokenizers`.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.fast = self._fast()
        self.added = [t["content"] for t in json.loads(self.tokenizer.to_str())["added_tokens"]]

    def _fast(self):
        import tiktoken

        spec = json.loads(self.tokenizer.to_str())
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"], before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) != ("BPE", "ByteLevel", True, False):
            return None
        vocab = model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if spec["normalizer"] or merged != sorted(merged):
            return None
        letters = _byte_letters()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if self.fast and _COMMON.fullmatch(text) and not any(t in text for t in self.added):
                ids = self.fast.encode_ordinary(text)
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            out.append(np.array(ids, self.kind).tobytes())
        return out


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, made once in a worker process."""
    return held(("encoder", path), lambda: Encoder(path))


def hilbert(cells: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    """Place of each row of unsigned cell coordinates on the Hilbert curve of that many bits a
    dimension (the transpose form: undo the excess rotations, then read Gray-coded bits)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


def _directions(n: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A sign per id and dimension from a multiplicative hash of the id."""
    ids = np.arange(n, dtype=np.uint64)[:, None]
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)[:dimensions]
    mixed = (ids + np.uint64(1)) * odd
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.float32) * 2 - 1)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, place, n_tokens, check, ids) of (doc_id, text); null text is empty. `ids` are the
    text's and CLOSE after them, little-endian; `place` is the
    curve's, `check` a checksum that tells texts apart."""
    signs: list[np.ndarray] = []

    def make(texts: list[str | None]) -> list[pa.Array]:
        model = encoder(path)
        if not signs:
            signs.append(_directions(model.tokenizer.get_vocab_size()))
        close = np.array([CLOSE], model.kind).tobytes()
        coded = [ids + close for ids in model.encode([t or "" for t in texts])]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // model.kind.itemsize
        points = np.empty((len(coded), DIMENSIONS))
        for i, ids in enumerate(coded):
            points[i] = signs[0][np.frombuffer(ids, model.kind)].sum(axis=0)
        points /= np.sqrt(sizes)[:, None]
        top = (1 << CELL_BITS) - 1
        cells = np.clip((np.tanh(points / 4) + 1) / 2 * top, 0, top).astype(np.int64)
        checks = np.fromiter(map(zlib.crc32, coded), np.int64, len(coded))
        return [pa.array(hilbert(cells)), pa.array(sizes), pa.array(checks), pa.array(coded, pa.binary())]

    rows = docs.select("doc_id", "text")
    return add_columns(rows, "text", "place long, n_tokens long, check long, ids binary", make, keep_text=False)


def sequences(left: int) -> list[int]:
    """Sizes of the sequences that so many tokens fill without padding."""
    sizes = [SEQUENCE] * (left // SEQUENCE)
    return sizes + [1 << b for b in range(SEQUENCE.bit_length() - 2, -1, -1) if left & (1 << b)]


class _Range:
    """Lays the documents of one range end to end. A document waits until its sequences' sizes
    are sure, which only the range's last SEQUENCE tokens need."""

    def __init__(self, number: int, kind: np.dtype) -> None:
        self.first = number << 40
        self.kind = kind
        self.filled = 0  # in the open sequence
        self.count = 0
        self.waiting: list[tuple] = []
        self.tokens = 0
        self.out: list[tuple] = []

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.waiting.append((doc_id, ids, 0))
        self.tokens += len(ids)
        if self.tokens >= SEQUENCE:
            self.fill([SEQUENCE] * (self.tokens // SEQUENCE))

    def close(self) -> None:
        self.fill(sequences(self.tokens))

    def fill(self, sizes: list[int]) -> None:
        at = 0
        for size in sizes:
            filled = 0
            while filled < size:
                doc_id, ids, start = self.waiting[at]
                length = min(size - filled, len(ids) - start)
                piece = ids[start : start + length].astype("<u4").tobytes()
                self.out.append((doc_id, start, length, piece, len(ids), self.first + self.count, filled))
                filled += length
                if start + length == len(ids):
                    at += 1
                else:
                    self.waiting[at] = (doc_id, ids, start + length)
            self.count += 1
            self.tokens -= size
        self.waiting = self.waiting[at:]


def packed(docs: DataFrame, path: str) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    Every document has at least CLOSE, so each gives a piece. Copies share a place on the curve
    and are told apart by doc_id and ids, so a large group of copies spreads over ranges; rows
    equal throughout are packed each. A sequence is named by its range and number; ranges are
    independent tasks, a lost one is repeated alone. Other columns are left out.
    """
    tokens = staged(tokenized(docs, path), "tokens")
    total = tokens.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    ranges = min(RANGES, max(1, -(-total // RANGE_TOKENS)))
    spread = F.xxhash64("doc_id", "check")
    rows = tokens.repartitionByRange(ranges, "place", spread).sortWithinPartitions("place", spread, "doc_id", "ids")
    rows = rows.select("doc_id", "ids", F.spark_partition_id().alias("range"))
    kind = encoder(path).kind
    schema = joined_schema(tokens.select("doc_id"), PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Range | None = None
        key = None

        def rows_out() -> pa.RecordBatch:
            columns = zip(*state.out, strict=True)
            types = (key, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            state.out = []
            return pa.RecordBatch.from_arrays(made, names=names)

        for batch in batches:
            key = batch.schema.field("doc_id").type
            numbers = batch.column("range")
            for i in range(batch.num_rows):
                if state is None:
                    state = _Range(numbers[i].as_py(), kind)
                state.add(batch.column("doc_id")[i].as_py(), np.frombuffer(batch.column("ids")[i].as_buffer(), kind))
                if len(state.out) >= 2_000:
                    yield rows_out()
        if state is not None:
            state.close()
            if state.out:
                yield rows_out()

    return rows.mapInArrow(run, schema)
