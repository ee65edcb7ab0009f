"""Blocks of vectors met by streams of probes.

A table of vectors is cut into blocks of bounded size, each packed into one row.
Probes that must see a block are sent to its key; a task gets the block first
and then its probes as a stream, so it holds one block and one batch of probes,
however many probes there are. Blocks are sent once for each slice of probes,
which bounds the time of a task too.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow

#: Numbers in a block at most (rows times components), and its rows at most.
BLOCK_NUMBERS, BLOCK_ROWS = 1 << 20, 8192
#: Probes a task meets a block with, about.
SLICE_ROWS = 2048
_MOST_TASKS = 20_000


def tasks(cells: int) -> int:
    return max(1, min(2 * cells, _MOST_TASKS))


def block_rows(dim: int) -> int:
    return max(64, min(BLOCK_ROWS, BLOCK_NUMBERS // max(dim, 1)))


def per_key(values: dict, key: Column) -> Column:
    """The value of each key of a small table, as an expression."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key)


def dealt(parts: Column, *by: str) -> Column:
    """A part number from 0 to parts - 1, by a hash of some columns."""
    return F.pmod(F.xxhash64(*by), parts.cast("long")).cast("int")


def finite(vec: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    infinite = F.lit(float("inf"))
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))


def to_bytes(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def from_bytes(body: bytes) -> dict:
    with np.load(io.BytesIO(body)) as z:
        return {k: z[k] for k in z.files}


def matrix(lists: pa.Array, kind) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(lists), -1) if len(flat) else np.zeros((len(lists), 0), kind)


def _stretches(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """(values, start, end) of the stretches of rows that agree in the keys."""
    n = batch.num_rows
    if not n:
        return
    cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
    new = np.zeros(n, bool)
    new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    at = np.append(np.flatnonzero(new), n)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield tuple(int(c[a]) for c in cols), a, b


def packed(rows: DataFrame, keys: list[str], order: list[str], n_blocks: int,
           make: Callable[[pa.Table], bytes]) -> DataFrame:
    """(keys, body): the rows of each key, sorted, as ``make`` packs them.
    Keys are integers."""
    placed = rows.repartition(tasks(n_blocks), *keys).sortWithinPartitions(*keys, *order)

    def run(batches):
        held: list = []
        now = None

        def done():
            cols = [pa.array([k], pa.int32()) for k in now]
            body = pa.array([make(pa.Table.from_batches(held))], pa.binary())
            return pa.RecordBatch.from_arrays([*cols, body], names=[*keys, "body"])

        for batch in batches:
            for key, a, b in _stretches(batch, keys):
                if held and key != now:
                    yield done()
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    return arrow(placed, run, ", ".join(f"{k} int" for k in keys) + ", body binary")


def meet(blocks: DataFrame, probes: DataFrame, keys: list[str], cells: int,
         load: Callable[[bytes], object], search: Callable[[object, pa.StructArray], pa.RecordBatch | None],
         schema: str) -> DataFrame:
    """What ``search`` yields for each block and each stretch of its probes.

    ``blocks`` is (keys, body), ``probes`` (keys, probe struct). Probes of a key
    without a block yield nothing."""
    kind = probes.schema["probe"].dataType
    left = blocks.select(*keys, F.lit(0).alias("kind"), "body", F.lit(None).cast(kind).alias("probe"))
    right = probes.select(*keys, F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("body"), "probe")
    both = left.unionAll(right).repartition(tasks(cells), *keys).sortWithinPartitions(*keys, "kind")

    def run(batches):
        block, of = None, None
        for batch in batches:
            for key, a, b in _stretches(batch, [*keys, "kind"]):
                if key[-1] == 0:
                    block, of = load(batch.column(len(keys) + 1)[a].as_py()), key[:-1]
                elif key[:-1] == of:
                    found = search(block, batch.column(len(keys) + 2).slice(a, b - a))
                    if found is not None and found.num_rows:
                        yield found

    return arrow(both, run, schema)
