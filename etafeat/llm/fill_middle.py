"""Fill-in-middle transformation (operator 12).

A text of n units (runs of letters A-Z, else single code points) is cut after
two unit counts that are drawn by SHA-256 of its id, and rearranged: suffix
first (spm) or last but one (psm), or left as it is (plain).

The rearrangement is a secondary sort. A task turns each text into pieces of at
most ``UNITS`` whole units, compressed and keyed by document and output
position, the marks being pieces of their own. One exchange partitions the
pieces by document and sorts them by position (the DataFrame form of
repartitionAndSortWithinPartitions), and a task streams them into an incremental
digest of the output. Restoration reads the output stream alone: a mark
switches the section, and the pieces are sorted again by section and position,
in the partitions they are in, and streamed into the digest of the restored
text. No task holds more than a piece of an output, however long the text.

Defined results: a NULL or empty text is plain with n = 0. A text that contains
a mark is plain. A NULL ``doc_id`` draws as the empty string. Rows are
documents of their own: repeated rows, and rows that share an id, give a row
each; equal rows of one input partition travel once, with their number, and
those of different input partitions are keyed apart, so that a hot row spreads.
A unit longer than ``CHARS`` bytes is cut over several pieces. An empty table
gives an empty result. Input columns other than the two named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = re.compile(b"<[PSM]>")
UNITS = 1 << 14  # units in a piece
CHARS = 1 << 17  # bytes in a piece
BLOCK = 1 << 20  # bytes of a text whose units are counted at once
PIECE_BYTES = 4 << 20  # bytes of compressed pieces in an outgoing batch
PLAIN_FROM, SPM_BELOW = 90, 20  # percent
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1), "plain": (0,)}  # sections (prefix, middle, suffix) as they are written
SECTION = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Units:
    """The units of a UTF-8 text: their number, and the byte at which the k-th starts."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        self.before = [0]
        for at in range(0, len(data), BLOCK):
            self.before.append(self.before[-1] + int(self._starts(at).sum()))
        self.n = self.before[-1]

    def _starts(self, at: int) -> np.ndarray:
        block = self.data[at:at + BLOCK]
        letter = _LETTER[block]
        follows = np.empty(len(block), bool)
        follows[1:] = letter[:-1]
        follows[0] = at > 0 and _LETTER[self.data[at - 1]]
        return ((block & 0xC0) != 0x80) & ~(letter & follows)

    def bytes_at(self, ks: np.ndarray) -> np.ndarray:
        """Byte offsets of ascending unit numbers ``ks``; number n is the end of the text."""
        out = np.full(len(ks), len(self.data), "int64")
        of = np.searchsorted(self.before, ks, "right") - 1
        for b in np.unique(of[ks < self.n]):
            here = (of == b) & (ks < self.n)
            out[here] = np.flatnonzero(self._starts(b * BLOCK))[ks[here] - self.before[b]] + b * BLOCK
        return out


def draw(doc_id: int | None, n: int) -> tuple[int, int, int, int]:
    """(units of the prefix, units up to the end of the middle, plain draw, spm draw) of a document."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return a, b, h[2] % 100, h[3] % 100


def output_pieces(doc_id: int | None, data: bytes) -> tuple[tuple, Iterator[bytes]]:
    """((n, form, prefix_chars, middle_chars), the pieces of the output in their order)."""
    units = Units(data)
    first, second, plain, spm = draw(doc_id, units.n)
    is_plain = not units.n or plain >= PLAIN_FROM or MARKS.search(data) is not None
    form = "plain" if is_plain else "spm" if spm < SPM_BELOW else "psm"
    bounds = (0, units.n) if is_plain else (0, first, second, units.n)
    ends = units.bytes_at(np.array(bounds)).tolist()

    def chars(i: int) -> int | None:
        if is_plain:
            return None
        return int(((units.data[ends[i]:ends[i + 1]] & 0xC0) != 0x80).sum())

    def pieces() -> Iterator[bytes]:
        for section in ORDER[form]:
            if not is_plain:
                yield (PREFIX, MIDDLE, SUFFIX)[section]
            ks = np.arange(bounds[section], bounds[section + 1], UNITS)
            cuts = [*units.bytes_at(ks).tolist(), ends[section + 1]]
            for lo, hi in zip(cuts, cuts[1:]):
                for at in range(lo, hi, CHARS):
                    yield data[at:min(at + CHARS, hi)]
    return (units.n, form, chars(0), chars(1)), pieces()


FACTS = ("n", "form", "prefix_chars", "middle_chars", "copies")


def _compressor():
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress


def _expander():
    import zstandard
    return zstandard.ZstdDecompressor().decompress


class _Rows:
    """Rows gathered into Arrow batches of a schema, at most about ``PIECE_BYTES`` of pieces each."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if self.size > PIECE_BYTES or len(self.rows) >= 8192:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self.rows, self.size = [], 0


def _schema(id_type: str, key: bool, *more: str) -> str:
    return ", ".join([f"doc_id {id_type}", *(["key binary"] if key else []), *more])


def _arrow(ddl: str, kind: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return pa.schema([(name, kind if name == "doc_id" else kinds[t]) for name, t in fields])


_PIECE = ("form string", "pos long", "piece binary", "n long", "prefix_chars long", "middle_chars long", "copies long")


def pieces_of(docs: DataFrame) -> DataFrame:
    """The output pieces of every document, in no order: (doc_id, key, form, pos, piece) and, as each
    document's last row, its facts (no piece). ``piece`` is zstandard-compressed UTF-8."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ddl = _schema(id_type, True, *_PIECE)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, out = _compressor(), None
        for b in batches:
            out = out or _Rows(_arrow(ddl, b.schema.field(0).type))
            docs_, texts, parts = b.columns
            keys = []
            for doc, text, part in zip(docs_, texts, parts):
                key = hashlib.blake2b(text.as_buffer(), digest_size=16, key=b"%d" % part.as_py()).digest()
                keys.append(key + repr(doc.as_py()).encode())
            copies: dict[bytes, int] = {}
            for key in keys:
                copies[key] = copies.get(key, 0) + 1
            for i, key in enumerate(keys):
                times = copies.pop(key, 0)
                if not times:  # an equal row of this batch went before
                    continue
                doc, data = docs_[i].as_py(), texts[i].as_py() or b""
                (n, form, prefix, middle), pieces = output_pieces(doc, data)
                pos = 0
                for pos, piece in enumerate(pieces, 1):
                    piece = pack(piece)
                    yield from out.add((doc, key, form, pos, piece, None, None, None, None), len(piece))
                yield from out.add((doc, key, form, pos + 1, None, n, prefix, middle, times))
        if out:
            yield from out.flush()

    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", text.alias("text"), F.spark_partition_id().alias("part")).mapInArrow(emit, ddl)


def ordered(pieces: DataFrame) -> DataFrame:
    """``pieces`` by document and output position: one exchange and a sort inside the partitions."""
    return pieces.repartition("key").sortWithinPartitions("key", "pos")


def _documents(b: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one, so that a task holds one piece as a Python object."""
    names, columns = b.schema.names, b.columns
    for i in range(b.num_rows):
        yield {c: v[i].as_py() for c, v in zip(names, columns)}


def _single(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows in the order of (key, position), of which equal rows of several batches have become one."""
    held = None
    for b in batches:
        for row in _documents(b):
            if held is not None and (held["key"], held["pos"]) == (row["key"], row["pos"]):
                held["copies"] = held["copies"] and held["copies"] + row["copies"]
                continue
            if held is not None:
                yield held
            held = row
    if held is not None:
        yield held


def with_output_digest(pieces: DataFrame) -> DataFrame:
    """Stream ordered pieces into the output's digest, and give each piece the section that the
    output's own marks put it in. Facts carry the digest and section 3, behind all text."""
    id_type = pieces.schema["doc_id"].dataType.simpleString()
    ddl = _schema(id_type, True, "section int", *_PIECE, "output_sha256 string")

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, out = _expander(), None
        digest, section = hashlib.sha256(), 0
        batches = iter(batches)
        for row in _single(batches):
            out = out or _Rows(_arrow(ddl, _KINDS[id_type]))
            head = (row["doc_id"], row["key"])
            if row["piece"] is None:
                facts = (row["n"], row["prefix_chars"], row["middle_chars"], row["copies"])
                yield from out.add((*head, 3, row["form"], row["pos"], None, *facts, digest.hexdigest()))
                digest, section = hashlib.sha256(), 0
                continue
            piece = expand(row["piece"])
            digest.update(piece)
            if row["form"] != "plain" and piece in SECTION:
                section = SECTION[piece]
                continue
            yield from out.add((*head, section, row["form"], row["pos"], row["piece"], None, None, None, None, None),
                               len(row["piece"]))
        if out:
            yield from out.flush()

    return pieces.mapInArrow(stream, ddl)


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def digests(docs: DataFrame) -> DataFrame:
    """One row a document: n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ddl = _schema(id_type, False, "n long", "form string", "prefix_chars long", "middle_chars long",
                  "output_sha256 string", "restored_sha256 string")

    def restore(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, out = _expander(), None
        digest = hashlib.sha256()
        for b in batches:
            out = out or _Rows(_arrow(ddl, _KINDS[id_type]))
            for row in _documents(b):
                if row["piece"] is not None:
                    digest.update(expand(row["piece"]))
                    continue
                done = (row["doc_id"], row["n"], row["form"], row["prefix_chars"], row["middle_chars"],
                        row["output_sha256"], digest.hexdigest())
                digest = hashlib.sha256()
                for _ in range(row["copies"]):
                    yield from out.add(done)
        if out:
            yield from out.flush()

    # the pieces of a document are in one partition already: sorting again needs no exchange
    again = with_output_digest(ordered(pieces_of(docs))).sortWithinPartitions("key", "section", "pos")
    return again.mapInArrow(restore, ddl)


def transformed(docs: DataFrame) -> DataFrame:
    """One row a document: n, form, prefix_chars, middle_chars and the output text itself (held whole by a task)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ddl = _schema(id_type, False, "n long", "form string", "prefix_chars long", "middle_chars long", "output string")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, out, text = _expander(), None, bytearray()
        for row in _single(batches):
            out = out or _Rows(_arrow(ddl, _KINDS[id_type]))
            if row["piece"] is not None:
                text += expand(row["piece"])
                continue
            done = text.decode("utf-8", "replace")
            text = bytearray()
            for _ in range(row["copies"]):
                yield from out.add((row["doc_id"], row["n"], row["form"], row["prefix_chars"], row["middle_chars"],
                                    done), len(done))
        if out:
            yield from out.flush()

    return ordered(pieces_of(docs)).mapInArrow(join, ddl)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut),
placed AS (
  SELECT doc_id, text, units, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:], '') AS s FROM placed),
written AS (
  SELECT doc_id, n, form, length(p) AS np, length(m) AS nm,
         CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parts),
marks AS (SELECT *, strpos(o, '<P>') AS ip, strpos(o, '<S>') AS isf, strpos(o, '<M>') AS im FROM written)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(np AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(nm AS BIGINT) END AS middle_chars,
       sha256(o) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN o
                        WHEN 'psm' THEN substr(o, 4, isf - 4) || substr(o, im + 3) || substr(o, isf + 3, im - isf - 3)
                        ELSE substr(o, ip + 3, im - ip - 3) || substr(o, im + 3) || substr(o, 4, ip - 4) END) AS restored_sha256
FROM marks
"""
