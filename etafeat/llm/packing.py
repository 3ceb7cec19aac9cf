"""Best-fit packing (operator 11).

Documents become token ids, long ones are cut, and the pieces are packed into
sequences of at most ``capacity`` tokens. Packing is bounded-space online best
fit: a packer keeps at most ``OPEN_BINS`` open sequences in a bitset keyed by
their free space, so the fullest one that still holds a piece is the lowest set
bit from the piece's length up; a piece that fits none opens a sequence, and
beyond the bound the fullest open sequence closes first. Packers work on
disjoint buckets of about ``BUCKET`` pieces, dealt by a hash of the piece and
read longest first; nothing but the lengths is needed, and pieces that fill a
sequence alone are not packed at all. The number of buckets grows with the
pieces, so a packer's memory and time do not.

Ids are those of the ``tokenizers`` file. Texts whose code points all lie below
U+0300 are encoded with the same vocabulary as ``tiktoken`` ranks, which is the
same merge table several times faster (tests/llm/test_packing.py proves the
tables equal); all others go through ``tokenizers``. Names of special tokens in
a text are ordinary text. A text is encoded in stretches that end between a
printable ASCII character and a space, where both split anyway: results do not
depend on the stretch length.

Defined results: a NULL or empty text is the end id alone, one piece of length
one. Rows are documents of their own: repeated rows, rows that share a
``doc_id`` and rows without one are packed each. A very long text is one row of
pieces; a task holds its ids (4 bytes a token) at once. An empty table gives an
empty result. Input columns other than the two named are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import materialize, table

END = 2
CAPACITY = 1024
OPEN_BINS = 8192
BUCKET = 2 * OPEN_BINS  # pieces a packer sees before it starts anew
STRETCH = 1 << 18  # code points encoded at once
ROWS = 512  # texts held as Python strings at a time
PIECES = 4096  # pieces in an outgoing batch

_EXOTIC = re.compile("[^\x00-˿]")
_SEAM = re.compile(r"(?<=[!-~]) ")


class Encoder:
    """Text -> token ids, from a ``tokenizers`` file and the ``tiktoken`` ranks of the same vocabulary."""

    def __init__(self, tokenizer: str, ranks: str | None = None):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(tokenizer)
        self.slow.encode_special_tokens = True
        self.fast = None
        if ranks:
            import tiktoken
            from public_tokenizers import PATTERN
            with open(ranks, "rb") as f:
                table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table_, special_tokens={})

    def stretches(self, text: str, length: int = STRETCH) -> Iterator[str]:
        at = 0
        while len(text) - at > length:
            seam = _SEAM.search(text, at + length)
            if not seam:
                break
            yield text[at:seam.start()]
            at = seam.start()
        yield text[at:]

    def ids(self, text: str) -> np.ndarray:
        parts = []
        for s in self.stretches(text):
            if self.fast is not None and not _EXOTIC.search(s):
                parts.append(np.array(self.fast.encode_ordinary(s), "<u4"))
            else:
                parts.append(np.array(self.slow.encode(s, add_special_tokens=False).ids, "<u4"))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def token_pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY,
                 end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, item): the documents' token ids, cut.

    A document of more than ``capacity`` ids is cut so that all pieces but its
    first are full. ``item`` numbers the pieces; it is only stable in a written
    table, so write this before using ``item``.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer, ranks)
        item = TaskContext.get().partitionId() << 40
        tail = np.array([end], "<u4")
        rows: list[tuple] = []
        kept: list[np.ndarray] = []

        def batch(kind: pa.DataType) -> pa.RecordBatch:
            nonlocal item
            doc, piece, start, crc = zip(*rows)
            lengths = np.array([len(k) for k in kept], "int64")
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept).astype("int32")))
            out = pa.RecordBatch.from_arrays(
                [pa.array(doc, kind), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths),
                 ids, pa.array(crc, pa.int64()), pa.array(np.arange(item, item + len(rows)))],
                ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "item"])
            item += len(rows)
            rows.clear()
            kept.clear()
            return out

        for b in batches:
            kind = b.schema.field("doc_id").type
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.concatenate([encoder.ids(text), tail]) if text else tail
                    first = (len(ids) - 1) % capacity + 1
                    for number, stop in enumerate(range(first, len(ids) + 1, capacity)):
                        start = max(stop - capacity, 0)
                        rows.append((doc, number, start, zlib.crc32(ids[start:stop].tobytes())))
                        kept.append(ids[start:stop])
                        if len(rows) == PIECES:
                            yield batch(kind)
            if rows:
                yield batch(kind)

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {id_type}, piece int, start long, length long, ids array<int>, ids_crc32 long, item long")


class OpenBins:
    """At most ``limit`` open bins, in a bitset keyed by free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.clear()

    def clear(self) -> None:
        self.bits = self.open = self.made = 0
        self.at: list[list[int]] = [[] for _ in range(self.capacity + 1)]

    def _take(self, free: int) -> int:
        number = self.at[free].pop()
        if not self.at[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset of a piece of ``length``."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if not self.at[left]:
                self.bits |= 1 << left
            self.at[left].append(number)
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, bucket: int = BUCKET) -> DataFrame:
    """``pieces`` (a written table with ``length`` and a unique ``item``) with ``sequence_id`` and ``offset``.

    Packers read (bucket, longest piece first); the bucket number is part of
    the sequence id, so ids do not depend on the physical partitions.
    """
    alone = (pieces.filter(F.col("length") >= capacity)
             .withColumns({"sequence_id": F.col("item").bitwiseOR(F.lit(1 << 62)), "offset": F.lit(0).cast("long")}))
    short = pieces.filter(F.col("length") < capacity)
    buckets = max(1, -(-short.count() // bucket))
    cols = short.columns
    short = (short.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets))).repartition("bucket")
             .sortWithinPartitions("bucket", F.desc("length"), "item"))

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, now = OpenBins(capacity, open_bins), None
        for b in batches:
            sequence, offset = [], []
            for k, length in zip(b.column("bucket").to_pylist(), b.column("length").to_pylist()):
                if k != now:
                    bins.clear()
                    now = k
                number, at = bins.place(length)
                sequence.append(k << 32 | number)
                offset.append(at)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*cols, "sequence_id", "offset"])

    return alone.unionByName(short.mapInArrow(fill, alone.schema))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, starts): the packed sequences with the offsets at which their pieces start.
    A group is one sequence, so at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p"))
            .select("sequence_id", "length", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.offset").alias("starts")))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    pieces = materialize(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("byte_bpe_50k.tiktoken")), "token-pieces")
    return (pack(pieces.drop("ids"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
