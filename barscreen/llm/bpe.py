"""Byte-level BPE with a rank queue.

A text is cut into pre-tokens by a pattern, and the bytes of each are merged pair by pair: always
the pair of the lowest rank, the leftmost among equals, until no two neighbours form a token. The
next pair comes from a queue over ranks. Each rank has a bucket of places in a linked list of
parts; a bitmap of two levels marks the buckets that hold anything, so that the lowest is found by
two find-first-set operations, also when a merge makes a pair of a lower rank than its own. A
place whose pair has changed since it was put down is skipped when it comes up. A merge costs a
few steps whatever the length of the pre-token, so one of millions of bytes takes a time in
proportion, not its square.

All new pre-tokens of a slice of texts are laid into one list with gaps between them: they share
the queue, and no pair crosses a gap. Pre-tokens met before come from a table of bounded size.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import add_columns, held, joined_schema, slices

#: Pre-tokens a worker remembers (the table starts anew once it holds more, before the next slice),
#: and bytes of the longest among them.
REMEMBERED, LONGEST = 300_000, 256
#: Bits of a word of the bitmap.
WORD = 8
NONE = -1


class RankQueue:
    """Places by rank, lowest first. Ranks run from 0 to `size` - 1."""

    def __init__(self, size: int) -> None:
        self.buckets: list[list[int]] = [[] for _ in range(size)]
        self.words = [0] * ((size >> WORD) + 1)
        self.top = 0

    def mark(self, rank: int) -> None:
        word = rank >> WORD
        self.words[word] |= 1 << (rank & (1 << WORD) - 1)
        self.top |= 1 << word

    def fill(self, ranks: list[int]) -> None:
        """Put down every place with its rank, NONE for no place. The queue must be empty."""
        buckets = self.buckets
        for place, rank in enumerate(ranks):
            if rank >= 0:
                buckets[rank].append(place)
        for rank in set(ranks):
            if rank >= 0:
                self.mark(rank)

    def lowest(self) -> int:
        """The lowest rank whose bucket holds anything, NONE if no bucket does."""
        if not self.top:
            return NONE
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        return (word << WORD) + (bits & -bits).bit_length() - 1

    def emptied(self, rank: int) -> None:
        """Take the mark of an empty bucket away."""
        word = rank >> WORD
        self.words[word] &= ~(1 << (rank & (1 << WORD) - 1))
        if not self.words[word]:
            self.top &= ~(1 << word)


class Vocabulary:
    """Tokens of a rank file (one base64 token and its rank a line), with the pairs that merge."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.cut = regex.compile(pattern).findall
        ranks = self.ranks
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        # Every way in which two tokens make a third, keyed by both.
        self.pairs = {
            ranks[token[:i]] << 32 | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.queue = RankQueue(len(self.tokens))
        self.known: dict[str, bytes] = {}

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        part: list[int] = []
        letters, pair = self.bytes, self.pairs.get
        for piece in pieces:
            part.extend([letters[b] for b in piece])
            part.append(NONE)
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        # No pair has a key with NONE in it: such keys are negative.
        found = [pair(a << 32 | b, NONE) for a, b in zip(part, part[1:], strict=False)]
        found.append(NONE)
        queue = self.queue
        mark, buckets = queue.mark, queue.buckets
        queue.fill(found)
        # A bucket is sorted when its turn comes, and its places are taken off the end. Only where a
        # lower rank comes up meanwhile, the rest of it becomes a heap, which stays ordered as more
        # places come: `heaps` names such ranks.
        heaps: set[int] = set()
        while (rank := queue.lowest()) >= 0:
            bucket = buckets[rank]
            if rank in heaps:
                take = heappop
            else:
                take = list.pop
                bucket.sort(reverse=True)
            lower = False
            while bucket and not lower:
                place = take(bucket)
                if found[place] != rank:
                    continue
                gone = after[place]
                right, left = after[gone], before[place]
                part[place] = rank
                part[gone] = found[gone] = NONE
                after[place] = right
                before[right] = place
                made = found[place] = pair(rank << 32 | part[right], NONE)
                if made >= 0:
                    other = buckets[made]
                    if not other:
                        mark(made)
                    if made in heaps:
                        heappush(other, place)
                    else:
                        other.append(place)
                    lower = made < rank
                if left >= 0:
                    made = found[left] = pair(part[left] << 32 | rank, NONE)
                    if made >= 0:
                        other = buckets[made]
                        if not other:
                            mark(made)
                        if made in heaps:
                            heappush(other, left)
                        else:
                            other.append(left)
                        lower = lower or made < rank
            if not bucket:
                queue.emptied(rank)
                heaps.discard(rank)
            elif take is not heappop:
                bucket.reverse()
                heaps.add(rank)
        out = []
        place = 0
        for piece in pieces:
            ids = []
            end = place + len(piece)
            while place < end:
                ids.append(part[place])
                place = after[place]
            out.append(ids)
            place = end + 1
        return out

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit numbers in the machine's order, which is
        little-endian wherever Arrow runs."""
        cut = [self.cut(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list(set().union(*cut).difference(known))
        coded = [word.encode("utf-8", "surrogatepass") for word in new]
        whole = [self.ranks.get(c) for c in coded]
        rest = iter(self.merged([c for c, rank in zip(coded, whole, strict=True) if rank is None]))
        for word, rank in zip(new, whole, strict=True):
            known[word] = array("I", (rank,) if rank is not None else next(rest)).tobytes()
        out = [b"".join(map(known.__getitem__, words)) for words in cut]
        for word, c in zip(new, coded, strict=True):
            if len(c) > LONGEST:
                del known[word]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a rank file, read once in a worker process."""
    return held(("bpe", path, pattern), lambda: Vocabulary(path, pattern))


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep_text: bool = False) -> DataFrame:
    """Every column of `docs` (its texts if asked) and the ids of each whole text, as binary of
    little-endian unsigned 32-bit numbers.

    Null texts count as empty and have no ids. Rows are encoded where they lie: no shuffle.
    """

    def make(texts: list[str | None]) -> list[pa.Array]:
        coded = vocabulary(path, pattern).encode([t or "" for t in texts])
        return [pa.array(coded, pa.large_binary()).cast(pa.binary())]

    return add_columns(docs, text, f"`{ids}` binary", make, keep_text)


def decoded(coded: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Every column of `coded` and the bytes its ids stand for: those of the text that was encoded.
    Null ids give null; an id that the vocabulary lacks is an error."""

    schema = f"`{name}` binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path, pattern)
        for piece in slices(batches, ids):
            texts = [None if i is None else model.decode(i) for i in piece.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.binary())], names=[*piece.schema.names, name])

    return coded.mapInArrow(run, joined_schema(coded, schema))


def digests(coded: DataFrame, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`coded` with n_tokens and SHA-256 of ids and decoded bytes in place of both."""
    rest = [c for c in coded.columns if c not in (ids, text)]
    return coded.select(
        *rest, (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2(text, 256).alias("decoded_sha256"),
    )
