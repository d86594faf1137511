"""User-defined aggregates (A6): create, add, merge, result, run in two phases.

An aggregate says what an empty accumulator is, how rows of one key are added to it, how two
accumulators merge and what comes out. ``aggregate`` runs it like a built-in: each task adds its
rows to one accumulator per key (rows never meet by key before that), accumulators are
shuffled and merged key by key. A hot key costs one accumulator per task and flush.

Rows come to ``add`` as pandas columns, those of one key among many Arrow batches' rows at a time, so
an aggregate works on arrays. An accumulator that ``add`` or ``merge`` is given is theirs to change. Where an accumulator grows with its values (a set), deal the key over them
(``spread``) and add up the results.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEYS = 1 << 16      # accumulators a task holds before it sends them
ROWS, BYTES = 1 << 17, 16 << 20     # rows, or Arrow bytes, that are grouped at a time


class UserAggregate(ABC):
    """One aggregate. ``accumulator`` and ``returns`` are DDL: the fields of an accumulator (a
    tuple) and the type of a result."""

    accumulator: str
    returns: str

    @abstractmethod
    def create(self) -> tuple: ...

    @abstractmethod
    def add(self, acc: tuple, rows: pd.DataFrame) -> tuple: ...

    @abstractmethod
    def merge(self, a: tuple, b: tuple) -> tuple: ...

    @abstractmethod
    def result(self, acc: tuple) -> Any: ...


class Count(UserAggregate):
    """Rows (clicks per product, clicks per user and product)."""

    accumulator, returns = "n bigint", "bigint"

    def create(self):
        return (0,)

    def add(self, acc, rows):
        return (acc[0] + len(rows),)

    def merge(self, a, b):
        return (a[0] + b[0],)

    def result(self, acc):
        return acc[0]


class SumAndCount(UserAggregate):
    """Money (in hundredths, so sums do not depend on row order) and rows."""

    accumulator, returns = "cents bigint, n bigint", "struct<total: double, n: bigint>"

    def create(self):
        return 0, 0

    def add(self, acc, rows):
        cents = rows.iloc[:, 0].dropna()
        return acc[0] + int(cents.sum()) if len(cents) else acc[0], acc[1] + len(rows)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, acc):
        return acc[0] / 100, acc[1]


class DistinctCount(UserAggregate):
    """Distinct values; the accumulator is the set of them (a list as it arrives). Values are added to
    the set in place, so many small additions cost no more than their values."""

    accumulator, returns = "values array<string>", "bigint"

    def create(self):
        return (set(),)

    def add(self, acc, rows):
        return self.merge(acc, ([str(v) for v in rows.iloc[:, 0].tolist() if v is not None and v == v],))

    def merge(self, a, b):
        values = a[0] if isinstance(a[0], set) else set(a[0])
        values.update(b[0])
        return (values,)

    def result(self, acc):
        return len(acc[0])


def _columns(schema: str) -> list[str]:
    return StructType.fromDDL(schema).fieldNames()


def _gathered(batches: Iterator) -> Iterator:
    """Batches of about ``ROWS`` rows (``BYTES`` bytes): a key's rows come in fewer pieces."""
    import pyarrow as pa

    some: list = []

    def joined():
        whole = pa.Table.from_batches(some).combine_chunks().to_batches()
        some.clear()
        return whole

    for b in batches:
        if b.num_rows:
            some.append(b)
        if sum(x.num_rows for x in some) >= ROWS or sum(x.nbytes for x in some) >= BYTES:
            yield from joined()
    if some:
        yield from joined()


def _partial(batches: Iterator, keys: list[str], agg: UserAggregate, names: list[str], most: int) -> Iterator:
    import numpy as np
    import pyarrow as pa

    held: dict[tuple, tuple] = {}

    def sent():
        rows = [(*k, *acc) for k, acc in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([list(r[i]) if isinstance(r[i], set) else r[i] for r in rows],
                      kinds[i] if i < len(kinds) else None) for i in range(len(names))], names)

    kinds: list = []
    for b in _gathered(batches):
        kinds = [b.schema.field(i).type for i in range(len(keys))]
        # keys by their codes: pandas would turn NULL integers into floats
        codes = pd.DataFrame({i: b.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy()
                              for i in range(len(keys))})
        group = (codes.groupby(list(codes.columns), sort=False).ngroup().to_numpy() if len(codes.columns)
                 else np.zeros(b.num_rows, np.int64))
        # rows of a key side by side: a piece is a slice
        order = group.argsort(kind="stable")
        cuts = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1)).tolist()
        rows = b.select(b.schema.names[len(keys):]).to_pandas().iloc[order]
        first = pa.array(order[cuts[:-1]])
        found = zip(*(b.column(i).take(first).to_pylist() for i in range(len(keys)))) if keys else [()]
        for key, start, end in zip(found, cuts[:-1], cuts[1:]):
            held[key] = agg.add(held.get(key) or agg.create(), rows.iloc[start:end])
            if len(held) >= most:
                yield sent()
    if held:
        yield sent()


def _final(batches: Iterator, keys: list[str], agg: UserAggregate, out: str, kind) -> Iterator:
    import pyarrow as pa

    key, acc = None, None
    for b in batches:
        done = []
        for row in zip(*(c.to_pylist() for c in b.columns)):
            k, part = row[:len(keys)], row[len(keys):]
            if k == key:
                acc = agg.merge(acc, part)
                continue
            if key is not None:
                done.append((*key, agg.result(acc)))
            key, acc = k, part
        yield _rows(done, b.schema, keys, out, kind)
        last = b.schema
    if key is not None:
        yield _rows([(*key, agg.result(acc))], last, keys, out, kind)


def _rows(rows: list, schema, keys: list[str], out: str, kind):
    import pyarrow as pa

    types = [*(schema.field(i).type for i in range(len(keys))), kind]
    values = [[r[i] for r in rows] for i in range(len(types))]
    if pa.types.is_struct(kind):
        values[-1] = [dict(zip((f.name for f in kind), v)) for v in values[-1]]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], [*keys, out])


def aggregate(df: DataFrame, keys: Iterable[str], inputs: Iterable[str], agg: UserAggregate, out: str,
              most: int = KEYS) -> DataFrame:
    """``keys`` and ``out``, the aggregate of the ``inputs`` of each key (NULL keys are keys)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    keys, inputs = list(keys), list(inputs)
    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, *(f"_acc_{c}" for c in _columns(agg.accumulator))]
    accumulators = ", ".join(f"`_acc_{f.name}` {f.dataType.simpleString()}"
                             for f in StructType.fromDDL(agg.accumulator))
    partial = df.select(*keys, *inputs).mapInArrow(
        lambda b: _partial(b, keys, agg, names, most), f"{key_types}, {accumulators}")
    kind = to_arrow_type(_parse_datatype_string(agg.returns))
    dealt = partial.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(lambda b: _final(b, keys, agg, out, kind), f"{key_types}, `{out}` {agg.returns}")


def spread(df: DataFrame, keys: Iterable[str], value: str, agg: UserAggregate, out: str, parts: int = 64) -> DataFrame:
    """An additive aggregate (its results over disjoint values add up, as distinct counts do) with
    each key dealt over its values: no accumulator holds more than a part of a key's values."""
    keys = list(keys)
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(value), F.lit(parts)).cast("int"))
    return (aggregate(dealt, [*keys, "_part"], [value], agg, out)
            .groupBy(*keys).agg(F.sum(out).alias(out)))
