"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import glob
import os
import sys
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share.

    Only a local session that names none (tests, a laptop) gets a temporary
    one; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark's setting by which a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends there, so a lost executor costs no recomputation before it.

    The shuffles behind it are done with then. Spark is told to delete their files
    as the write ends; by itself it does so when the driver happens to collect the
    plans that refer to them, and until then they fill the executors' disks. Other
    remains of the plans (broadcasts) go with a collection asked for here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this subpackage sent to the executors once per
    application, so that their Python workers can import it from anywhere."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="run-"), "wardpulse_llm.zip")
        with zipfile.ZipFile(path, "w") as z:
            z.write(os.path.join(os.path.dirname(here), "__init__.py"), "wardpulse/__init__.py")
            for f in sorted(glob.glob(os.path.join(here, "*.py"))):
                z.write(f, f"wardpulse/llm/{os.path.basename(f)}")
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(run, schema)


def fold(a: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), element by element."""
    a = a.astype(np.uint64, copy=True)
    a ^= a >> np.uint64(32)
    a *= np.uint64(0xD6E8FEB86659FD93)
    a ^= a >> np.uint64(32)
    a *= np.uint64(0xD6E8FEB86659FD93)
    a ^= a >> np.uint64(32)
    return a


_BASE = 0x9E3779B97F4A7C15 | 1
_POW: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if len(_POW[0]) < n:
        m = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0], _POW[1]


_PLAIN = np.array([chr(b).isalnum() or b > 127 for b in range(256)])


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts, as arrays.

    ``doc`` numbers the text of each word, ``start``/``end`` are byte places in
    ``data``; ``hash`` is a 64-bit fingerprint of the word's bytes (of its
    A-Z-lowered bytes if ``lower``). ``first`` has, for each text, the index of
    its first word (length texts + 1). Null texts have no words. With ``plain``
    words are runs of ASCII letters and digits and of characters beyond ASCII.
    """

    def __init__(self, texts: pa.Array, lower: bool, plain: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        self.n_docs, self.offsets = len(texts), off
        if lower and len(data):
            up = (data >= 65) & (data <= 90)
            data = data + (up.astype(np.uint8) << 5)
        self.data = data
        n = len(data)
        if n:
            if plain:
                inside = _PLAIN.take(data)
            else:
                inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            ends = inside.copy()
            ends[:-1] &= ~inside[1:]
            cut = off[1:-1]
            cut = cut[(cut > 0) & (cut < n)]
            starts[cut] |= inside[cut]          # a word never spans two texts
            ends[cut - 1] |= inside[cut - 1]
            self.start = np.flatnonzero(starts)
            self.end = np.flatnonzero(ends) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.doc = (np.searchsorted(off, self.start, side="right") - 1).astype(np.int32)
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs + 1))

    def hash(self) -> np.ndarray:
        """Polynomial fingerprints modulo 2**64 from one prefix sum, then mixed.

        The prefix sum restarts every block, so its memory is bounded.
        """
        out = np.zeros(len(self.start), np.uint64)
        size = 1 << 20
        lo = 0
        while lo < len(self.start):
            at = self.start[lo]
            hi = max(lo + 1, int(np.searchsorted(self.end, at + size, side="right")))
            part = self.data[at:self.end[hi - 1]]
            up, down = _powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
            s, e = self.start[lo:hi] - at, self.end[lo:hi] - at
            out[lo:hi] = (sums[e] - sums[s]) * down[s]
            lo = hi
        length = (self.end - self.start).astype(np.uint64)
        return fold(out ^ (length * np.uint64(0xA24BAED4963EE407)))


def pieces_of(batch: pa.RecordBatch, column: str, most: int = 16 << 20):
    """Slices of a record batch whose texts hold about ``most`` bytes (one long
    text may be more), so that a task's memory does not follow the batch."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1]
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        hi = min(hi, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


class Memory:
    """A bounded memory of computed values in two generations: when the young
    one is full it becomes the old one, whose entries return on use."""

    def __init__(self, compute, most: int):
        self.compute, self.most = compute, most
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.compute(key)
            if len(key) < 64:
                if len(self.young) >= self.most:
                    self.old, self.young = self.young, {}
                self.young[key] = value
        return value

    def get_all(self, keys: list) -> list:
        values = list(map(self.young.get, keys))
        if None in values:
            get = self.get
            return [get(k) if v is None else v for k, v in zip(keys, values)]
        return values


_RESIDENT: list = [None, None]


def resident(key, make):
    """The one large object that this Python worker holds between tasks (a model
    with its memory). Asking for another one lets the last one go, so that the
    operators of a long session do not pile up in reused workers."""
    if _RESIDENT[0] != key:
        if _RESIDENT[0] is not None:
            _RESIDENT[:] = [None, None]
            gc.collect()
            pa.default_memory_pool().release_unused()
            if sys.platform.startswith("linux"):        # freed pages go back to the system
                ctypes.CDLL(None).malloc_trim(0)
        _RESIDENT[:] = [key, make()]
    return _RESIDENT[1]


def local_path(name_or_path: str) -> str:
    """A tokenizer file: a path as it is, or a name of the public set."""
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers
    return public_tokenizers.path(name_or_path)
