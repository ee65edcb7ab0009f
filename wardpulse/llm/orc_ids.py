"""Token-ID output as ORC: integer run-length encoded id lists, row indexes
and Bloom filters on the document id, read back stripe by stripe.

Documents are range-partitioned by id, and within an id by a hash of the text, into
slices, so a hot id spreads over several; they are sorted within a slice, encoded and
written as one ORC file per slice: columns ``doc_id``, ``slice``,
``local_start`` (ids before the document in its slice), ``n_tokens`` and
``ids``. ORC writes integers run-length encoded in stripes, keeps min/max row
indexes and, for ``doc_id``, Bloom filters, so a filter on it skips stripes
and row groups. A document's global ``start`` adds the totals of the slices before to
its local start; these are running sums in blocks of ``BLOCK`` slices, of the blocks'
sums in blocks again, and so on, so no task sees the totals of all slices.

A null text is an empty document (just the end id). Null document ids sort
first. Rows that repeat an id stay, ordered among themselves by a hash of their text,
then by the text.
Extra columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Memory, arrow, land, local_path, pieces_of, resident, shared_dir

#: Slices (or blocks of them) that one running sum covers, and how often they are blocked again.
BLOCK, LEVELS = 2048, 4
#: Words that a generation of a worker's memory holds.
MEMORY = 500_000
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in out]
    out.update({b: chr(256 + k) for k, b in enumerate(rest)})
    return out


def _after_letter(end: bytes) -> bool:
    """Whether a text ends in an ASCII letter or digit or a Latin-1 letter: a
    mark after it, before white space, is a pre-token of its own."""
    if not end:
        return False
    return end[-1:].isalnum() or (len(end) == 2 and end[0] == 0xC3 and 0x80 <= end[1] <= 0xBF and end[1] not in (0x97, 0xB7))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """ids of texts by the tokenizers library, remembered word by word.

    The tokenizer drops white space and never joins characters across it, so
    a text's ids are its words' ids in order (special strings hold no white
    space). A word of plain Latin letters is one pre-token and goes straight
    to the library's BPE model; any other word takes the whole pipeline.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(local_path(path))
        self.model = self.tok.model
        self.table = _byte_letters()
        self.memory = Memory(self.word, MEMORY)

    def _whole(self, word: str) -> bytes:
        return _packed(self.tok.encode(word, add_special_tokens=False).ids)

    def word(self, w: bytes) -> bytes:
        s = w.decode()
        if len(s) > 1 and s[-1] in ".," and _LETTERS(s[:-1]):
            return self.memory.get(w[:-1]) + self.memory.get(w[-1:])
        if not _LETTERS(s) or not unicodedata.is_normalized("NFC", s):
            return self._whole(s)
        low = s.lower()
        if low != s:
            return self.memory.get(low.encode())
        mapped = s if s.isascii() else "".join(map(self.table.__getitem__, w))
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids."""
        if not text:
            return b""
        raw = text.encode("utf-8")
        if b"<|" not in raw:                    # no special string: the tokenizer lowers all letters
            raw = raw.lower()
        for mark in (b". ", b".\n", b", ", b",\n"):
            parts = raw.split(mark)
            if len(parts) > 1 and all(map(_after_letter, {p[-2:] for p in parts[:-1]})):
                raw = (b" " + mark).join(parts)
        return b"".join(self.memory.get_all(raw.split()))


def write_ids(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
              slice_bytes: int = 32 << 20, stripe_bytes: int = 16 << 20, row_stride: int = 1000,
              bloom_fpp: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the ORC files at ``path``: slices of about
    ``slice_bytes`` of text."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    slices = max(1, -(-size // slice_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.col("print")]
    # the slice number is written with the rows, so readers need not derive it again
    dealt = (rows.withColumn("print", F.xxhash64("text")).repartitionByRange(slices, *order)
             .sortWithinPartitions(*order, "text").drop("print").withColumn("slice", F.spark_partition_id()))

    def run(batches):
        encode = resident(("orc_ids", tokenizer), lambda: WordEncoder(tokenizer)).encode
        end = np.array([end_id], "<u4").tobytes()
        at = 0                                  # a task is one slice
        for batch in batches:
            for p in pieces_of(batch, "text", 4 << 20):
                docs_ids = [encode(t) + end for t in p.column(1).to_pylist()]
                counts = np.array([len(b) // 4 for b in docs_ids], np.int64)
                ends = at + np.cumsum(counts)
                starts, at = ends - counts, int(ends[-1])
                flat = np.frombuffer(b"".join(docs_ids), "<u4").astype(np.int32)
                offsets = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(counts, out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [p.column(0), p.column(2), pa.array(starts), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["doc_id", "slice", "local_start", "n_tokens", "ids"])

    (arrow(dealt, run, f"doc_id {kind}, slice int, local_start long, n_tokens long, ids array<int>")
     .write.option("orc.stripe.size", str(stripe_bytes)).option("orc.row.index.stride", str(row_stride))
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", str(bloom_fpp)).option("compression", "zstd").orc(path))


def totals_before(totals: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(k, before): the sum of ``n`` over all smaller ``k``, from a row (k, n) per
    number k. Running sums go over blocks of ``BLOCK`` neighbouring numbers, and the
    blocks' sums are treated alike; ``levels`` blockings cover BLOCK ** levels numbers."""
    block = F.floor(F.col("k") / BLOCK).cast("long")
    run = Window.partitionBy(block).orderBy("k")
    inner = totals.select("k", block.alias("b"), (F.sum("n").over(run) - F.col("n")).alias("before"))
    if levels == 1:
        return inner.select("k", "before")
    above = totals_before(totals.groupBy(block.alias("k")).agg(F.sum("n").alias("n")), levels - 1)
    return (inner.join(above.select(F.col("k").alias("b"), F.col("before").alias("more")), "b")
            .select("k", (F.col("before") + F.col("more")).alias("before")))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with each document's global ``start``. A filter on
    doc_id reaches the ORC reader (row indexes, Bloom filters)."""
    rows = spark.read.orc(path)
    totals = land(rows.groupBy(F.col("slice").cast("long").alias("k")).agg(F.sum("n_tokens").alias("n")), "totals")
    before = totals_before(totals).select(F.col("k").cast("int").alias("slice"), F.col("before").alias("_before"))
    return (rows.join(before, "slice")
            .withColumn("start", F.col("_before") + F.col("local_start")).drop("_before", "local_start"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The id lists of a few documents, by metadata pruning."""
    return spark.read.orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def ids_digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as read from the files."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids = b.column(3)
            flat = np.frombuffer(ids.values.buffers()[1], "<i4")[ids.values.offset:]
            off = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(off[1:] - off[:-1], pa.int64()),
                                              pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow(rows.select("doc_id", "start", "n_tokens", "ids"), run,
                 f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def orc_round_trip(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, **options) -> DataFrame:
    """Write the files in the shared folder, read them back and digest them."""
    path = f"{shared_dir(docs.sparkSession)}/ids.orc"
    write_ids(docs, path, tokenizer, end_id, **options)
    return ids_digest(read_ids(docs.sparkSession, path))
