"""SimHash near-dedup (operator 4).

Each document gets a 64-bit fingerprint of its word shingles; fingerprints that
differ in at most two bits are linked, and documents reachable over links form
a group. Candidates come from covering locality-sensitive hashing: every bit
position gets one of the non-zero vectors of GF(2)^(radius+1), and table ``a``
keeps the positions whose vector has an odd product with ``a``. Any ``radius``
positions are orthogonal to some ``a`` together, so in that table the two
fingerprints agree on all kept bits: no pair within the radius is missed.

Inside a bucket no pairs are listed. Members differ only in positions the table
does not keep, and two fingerprints are within two bits exactly if some value is
within one bit of both. So each member of a shared bucket names the values
within one bit of it among those positions, and members that name the same
value are linked to the smallest of them. A bucket of m members costs m times
the positions left out, whatever m is.

Defined results: a NULL or empty text has fingerprint zero and is linked like
any other. Exact copies share a fingerprint and meet in a grouped minimum. Rows
with a NULL ``doc_id`` take part in linking; a group without any id has a NULL
``component_id``. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import components, materialize, table

RADIUS = 2  # the midpoint argument above is for two bits
SHINGLE = 3
CHUNK = 1 << 16  # shingles hashed at a time, so a very long text needs no more memory


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Majority of the bits of XXH64 (seed 42) over the ``size``-word shingles of ``text``."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and exactly 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))  # starts, and one past each end
    n = max(1, len(words) - size + 1)
    last = min(size, len(words))
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        stop = min(n, at + CHUNK)
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b - 1], 42)
                         for a, b in zip(ends[at:stop], ends[at + last:stop + last])), np.uint64, stop - at)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def row_hashes(docs: DataFrame) -> tuple[Column, Column]:
    return F.xxhash64(docs["text"]).alias("row"), F.xxhash64(*[docs[c] for c in docs.columns]).alias("rest")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, row, rest, fp): one row per input row, ``fp`` the fingerprint as a signed long;
    ``row`` and ``rest`` are hashes of the text and of all columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in b.column(3)], np.uint64)
            yield pa.record_batch([*b.columns[:3], pa.array(fps.view(np.int64))], ["doc_id", "row", "rest", "fp"])

    return docs.select("doc_id", *row_hashes(docs), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, row long, rest long, fp long")


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The bits that each of the 2^(radius+1)-1 covering tables keeps."""
    space = range(1, 1 << (radius + 1))
    vector = [space[i % len(space)] for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & a).bit_count() % 2) for a in space]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame) -> DataFrame:
    """(u, v): a star over each set of distinct ``fp`` that lie within one bit of one value.

    Its components are those of all pairs within two bits.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(masks())])
    # the balls: per table the fingerprint itself and its one-bit neighbours among the bits left out
    balls = F.array(*[F.array(*[F.lit(0).cast("long")] + [F.lit(_signed(1 << i)).cast("long")
                                                         for i in range(64) if not m >> i & 1]) for m in masks()])
    rows = fps.select("fp", F.explode(tables).alias("x")).select(
        "fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"))
    shared = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("t", "key")
    near = (rows.join(shared, ["t", "key"])
            .select("fp", F.explode(F.element_at(balls, F.col("t") + 1)).alias("flip"))
            .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")))
    # at most 65 distinct fingerprints lie within one bit of a value
    sets = near.groupBy("value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return (sets.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
            .filter("u <> v").select("u", "v").distinct())


def first_rows(per_doc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of each fingerprint's group, and (root, first): the first row of each
    group by id (rows without one last), text and other columns."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "rest")
    distinct = materialize(per_doc.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    of = components(links(distinct)).withColumnRenamed("node", "fp")
    groups = distinct.join(of, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return groups.select("fp", "root"), groups.groupBy("root").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    per_doc = materialize(fingerprints(docs.select("doc_id", "text"), size), "fingerprints")
    groups, least = first_rows(per_doc)
    groups = materialize(groups.join(least, "root").select("fp", F.col("first.doc_id").alias("component_id")), "groups")
    return per_doc.join(groups, "fp").select("doc_id", "fp", "component_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group, the one with the smallest id.

    Of rows that share that id the one with the smallest hash of its text (then of
    all columns) stays, once. A group without any id keeps one row in the same way.
    """
    _, least = first_rows(materialize(fingerprints(docs), "fingerprints"))
    kept = least.select(*[F.col(f"first.{c}").alias(f"kept_{c}") for c in ("doc_id", "row", "rest")])
    row, rest = row_hashes(docs)
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_doc_id"]) & (row == kept["kept_row"])
                     & (rest == kept["kept_rest"]), "left_semi").distinct()
