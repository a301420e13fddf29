"""Best-fit packing of token sequences in bounded space.

Pieces come one by one; a piece goes to the open bin it fills best. A fixed number of bins is
open at a time. Their free spaces are the set bits of one integer, so the best fit is the lowest
set bit from the piece's length on. If none fits and no further bin may open, the fullest closes.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from tamiz.llm.common import ceil_div, small_batches, stored

CAPACITY = 2048
OPEN_BINS = 512
#: Tokens that one packer takes, about; each leaves at most OPEN_BINS sequences part empty.
TOKENS_PER_PACKER = 64_000_000
END = 0
#: The only special token of the vocabulary; texts that hold its string go to the full tokenizer.
SPECIAL = "<|endoftext|>"


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str | None):
    """A function from a text to its token ids.

    The ranks of the vocabulary are those of its merges, so the faster reader of the same merges
    gives the same ids; it is used where both files are at hand, and never for the special token.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    @functools.cache
    def full() -> Tokenizer:
        return Tokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))

    if vocabulary:
        return lambda text: full().encode(text, add_special_tokens=False).ids
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL in text:
            return full().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: only the first of several may be shorter."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
              vocabulary: str | None = None) -> DataFrame:
    """Pieces of the documents: doc_id, piece, start, length, ids_crc32. A NULL text is empty: one end token."""

    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for at, value in enumerate(batch.column(1)):
                ids = np.array([*encode(value.as_py() or ""), END], dtype="<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for column, v in zip(rows, (at, piece, start, length, crc)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                 *[pa.array(r, pa.int64()) for r in rows[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Bins of ``capacity``, at most ``open_bins`` of them open."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f is set if an open bin has f places free
        self.bins: dict[int, list[int]] = {}
        self.n_open = self.n_bins = 0

    def put(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.n_open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            space, number = self.capacity, self.n_bins
            self.n_bins += 1
        left = space - length
        if left:
            self.bins.setdefault(left, []).append(number)
            self.free |= 1 << left
            self.n_open += 1
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        same = self.bins[space]
        number = same.pop()
        if not same:
            del self.bins[space]
            self.free &= ~(1 << space)
        self.n_open -= 1
        return number


def packed(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
           tokens_per_packer: int = TOKENS_PER_PACKER) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Pieces are dealt to packers by hash of document and piece and arrive there in the order of that
    hash, whatever the order of the input. Their number follows the tokens, so each holds about as
    many however large the table; a sequence id is a packer's number and a bin's.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    packers = max(1, ceil_div(total, tokens_per_packer))
    dealt = (pieces.withColumn("order", F.xxhash64("doc_id", "piece"))
             .withColumn("packer", F.pmod(F.xxhash64("order"), F.lit(packers)))
             .repartitionById(packers, F.col("packer").cast("int"))
             .sortWithinPartitions("packer", "order", "doc_id", "piece", "ids_crc32"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bins = None, None
        for batch in batches:
            numbers, offsets = [], []
            for now, length in zip(batch.column("packer").to_pylist(), batch.column("length").to_pylist()):
                if now != packer:
                    packer, bins = now, BestFit(capacity, open_bins)
                number, offset = bins.put(length)
                numbers.append((packer << 40) + number)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                 "sequence_id long, offset long")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         open_bins: int = OPEN_BINS, vocabulary: str | None = None,
         tokens_per_packer: int = TOKENS_PER_PACKER) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    A document is its ids and one end token; longer ones than ``capacity`` are cut. A NULL or empty
    text is the end token alone. Repeated rows are packed as often as they come, pieces that tie in order are equal. Long texts are
    tokenized whole, other columns play no part, and an empty table gives no rows. Only lengths and checksums are shuffled.
    """
    pieces = stored(tokenized(docs, doc_id, text, capacity, vocabulary), "pieces")
    return packed(pieces, capacity, open_bins, tokens_per_packer)
