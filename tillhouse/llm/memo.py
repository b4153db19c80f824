"""Helpers of the tokenizer operators: a table of solved pieces bounded by
bytes, and Arrow columns computed from texts in slices of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_CHARS = 2_000_000   # characters of texts worked on at once; one text may exceed it alone


class Memo:
    """Solved pieces of one Python worker, in two generations.

    When the younger one holds more than half of ``limit`` bytes it becomes the
    older one and what that held is dropped, unless it was asked for since.
    A dropped piece is only solved again, so the bound changes no result."""

    ENTRY = 300   # bytes of the objects of an entry, besides its contents

    def __init__(self, limit: int = 64 << 20):
        self.half, self.young, self.old, self.held = limit // 2, {}, {}, 0

    def missing(self, keys: set) -> list:
        """The keys that are not held; older ones that are become young."""
        out, old = [], self.old
        for k in keys.difference(self.young):
            if k in old:
                self.young[k] = old.pop(k)
                self.held += self.ENTRY + 4 * len(k)
            else:
                out.append(k)
        return out

    def put(self, key, value, size: int) -> None:
        """``size`` counts the bytes of the contents."""
        self.young[key] = value
        self.held += size + self.ENTRY

    def trim(self) -> None:
        """Call between slices, when no value is needed any more."""
        if self.held > self.half:
            self.old, self.young, self.held = self.young, {}, 0


#: What operators keep in this Python worker from task to task: how to drop it, by operator.
_KEPT: dict[str, Callable[[], object]] = {}


def make_room(operator: str, drop: Callable[[], object] | None = None) -> None:
    """Call at the start of a task's work: what other operators left in this
    worker is dropped and its memory goes back to the system; ``drop`` will do
    so for this one.  A worker outlives its stage, and what is dropped is only
    made again, so no result changes."""
    others = [_KEPT.pop(k) for k in [*_KEPT] if k != operator]
    if drop:
        _KEPT[operator] = drop
    if others:
        for f in others:
            f()
        give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def fewer_collections() -> None:
    """Solved pieces live long and hold no cycles: the collector need not walk
    them after every few hundred new ones."""
    gc.set_threshold(200_000, 20, 100)


def slices(column: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``chars`` characters together."""
    import pyarrow.compute as pc
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).tolist()):
        if i > start and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(column):
        yield start, len(column)


def text_columns(df: DataFrame, text: str, fields: Sequence[T.StructField], make: Callable[[], Callable]) -> DataFrame:
    """``df`` without ``text`` and with ``fields``.

    ``make()`` runs in each task and gives a function from a list of texts to
    one sequence for each field.  Columns of ``df`` that have the name of a
    field are replaced by it."""
    from pyspark.sql.pandas.types import to_arrow_type

    own = {f.name for f in fields}
    keep = [c for c in df.columns if c != text and c not in own]
    schema = T.StructType([*df.select(*[f"`{c}`" for c in keep]).schema.fields, *fields])
    kinds, names = [to_arrow_type(f.dataType) for f in fields], [f.name for f in schema]

    def work(batches):
        run = None
        for batch in batches:
            run = run or make()
            texts = batch.column(len(keep))
            for a, b in slices(texts):
                new = run(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(len(keep))],
                     *[pa.array(x, k) for x, k in zip(new, kinds)]], names=names)

    return df.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(work, schema)
