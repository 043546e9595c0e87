"""Neighbouring rows of a group as one row, so that a shuffle moves few and small ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType, StringType, StructField, StructType

from ..functions.text import computed

#: Between the values of a run's text columns, and a null there.
SEPARATOR, NULL = " ", "\x00"
#: 2 to this many numbers share a run in a join: what is compared there grows with its square.
JOIN_RUN_BITS = 4


def pack_runs(df: DataFrame, keys: Sequence[str], order: str, texts: Sequence[str], keep: str | None = None) -> DataFrame:
    """One row per run: neighbouring rows of a task that share ``keys`` and ascend in
    ``order``. ``order`` becomes a list, each of the string columns ``texts`` its values
    joined by a space (see ``run_items``). A row whose text holds a space or NUL is a run
    of its own. Whatever the order of the rows, all of them are kept; rows in no order
    make short runs. A run ends with its Arrow batch.

    ``keep``: a boolean column; rows where it is not true are left out, but keys that
    have no other row in the neighbourhood keep an empty run."""
    fields = {f.name: f for f in df.schema.fields}
    schema = StructType([fields[k] for k in keys] + [StructField(order, ArrayType(fields[order].dataType))]
                        + [StructField(t, StringType()) for t in texts])
    n_keys, names = len(keys), [*keys, order, *texts]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def known(flags):
            return pc.fill_null(flags, False).to_numpy(zero_copy_only=False)

        def same(column):
            """Whether each value but the first equals the one before it."""
            try:
                return known(pc.equal(column.slice(1), column.slice(0, len(column) - 1)))
            except pa.ArrowNotImplementedError:  # nested values
                v = column.to_pylist()
                return np.array([a is not None and a == b for a, b in zip(v, v[1:])], dtype=bool)

        def same_keys(columns, n):
            out = np.ones(n - 1, dtype=bool)
            for c in columns[:n_keys]:
                out &= same(c)
            return out

        def packed(columns, n):
            at = columns[n_keys]
            joined = same_keys(columns, n) & known(pc.less(at.slice(0, n - 1), at.slice(1)))
            for c in columns[n_keys + 1:n_keys + 1 + len(texts)]:
                alone = known(pc.match_substring_regex(c, f"[{SEPARATOR}{NULL}]"))
                joined &= ~(alone[1:] | alone[:-1])
            starts = np.concatenate([[0], np.flatnonzero(~joined) + 1])
            ends, first = pa.array(np.append(starts, n), pa.int32()), pa.array(starts)
            single = pa.array(np.diff(np.append(starts, n)) == 1)

            def text(c):
                whole = pc.binary_join(pa.ListArray.from_arrays(ends, pc.fill_null(c, NULL)), SEPARATOR)
                return pc.if_else(single, c.take(first), whole)

            return pa.RecordBatch.from_arrays(
                [*(c.take(first) for c in columns[:n_keys]), pa.ListArray.from_arrays(ends, at),
                 *(text(c) for c in columns[n_keys + 1:n_keys + 1 + len(texts)])], names)

        for batch in batches:
            if keep and batch.num_rows:
                flags = known(batch.column(batch.num_columns - 1))
                group = np.concatenate([[0], np.cumsum(~same_keys(batch.columns, batch.num_rows))])
                lone = np.flatnonzero(~np.isin(group, group[flags]))
                lone = lone[np.unique(group[lone], return_index=True)[1]]
                if len(lone):
                    place = batch.schema.field(n_keys).type
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(pa.array(lone)) for c in batch.columns[:n_keys]),
                         pa.ListArray.from_arrays(pa.array(np.zeros(len(lone) + 1), pa.int32()), pa.array([], place)),
                         *(pa.array([""] * len(lone)) for _ in texts)], names)
                batch = batch.filter(pa.array(flags))
            if batch.num_rows:
                yield packed(batch.columns, batch.num_rows)

    return df.select(*keys, order, *texts, *([keep] if keep else [])).mapInArrow(run, schema)


def run_items(run: Column, order: str, texts: Sequence[str]) -> Column:
    """The rows of a run (a struct of ``pack_runs`` columns, not empty) as an array of structs."""
    def added(name):
        return lambda s, v: s.withField(name, v)
    items = F.transform(run[order], lambda o: F.struct(o.alias(order)))
    for t in texts:
        several = F.transform(F.split(run[t], SEPARATOR, -1), lambda v: F.nullif(v, F.lit(NULL)))
        values = F.when(F.size(run[order]) == 1, F.array(run[t])).otherwise(several)
        items = F.zip_with(items, values, added(t))
    return items


def join_runs(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` (null equals nothing); the other columns' names differ.

    Where the last key is a whole number and the other columns are strings, 2 **
    ``JOIN_RUN_BITS`` numbers at a time move as one row, and the rows of two runs are paired by number;
    any other table is joined row by row."""
    *group, last = keys
    texts = [[c for c in d.columns if c not in keys] for d in (left, right)]
    types = {(i, f.name): f.dataType for i, d in enumerate((left, right)) for f in d.schema.fields}
    if not all(isinstance(types[i, last], IntegralType) and all(types[i, t] == StringType() for t in texts[i]) for i in (0, 1)):
        return left.join(right, list(keys))
    chunk = F.shiftright(F.col(last).cast("bigint"), JOIN_RUN_BITS)
    sides = []
    for d, names, side in ((left, texts[0], "_l"), (right, texts[1], "_r")):
        d = d.filter(F.col(last).isNotNull()).withColumn("_chunk", chunk)
        runs = pack_runs(d, [*group, "_chunk"], last, names)
        sides.append(runs.withColumnsRenamed({c: f"{side}{i}" for i, c in enumerate((last, *names))}))
    both = sides[0].join(sides[1], [*group, "_chunk"]).drop("_chunk")
    of = {f.name: f for d in (right, left) for f in d.schema.fields}
    schema = StructType([of[c] for c in (*group, last, *texts[0], *texts[1])])
    n_group, n_left = len(group), 1 + len(texts[0])

    def pair(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            (row, number, left_texts), (other, key, right_texts) = (
                unpacked(batch.columns[a:b]) for a, b in ((n_group, n_group + n_left), (n_group + n_left, batch.num_columns)))
            # numbers ascend in a run, so each is there once
            mask = (1 << JOIN_RUN_BITS) - 1
            place = np.full(batch.num_rows << JOIN_RUN_BITS, -1, dtype=np.int64)
            place[(other << JOIN_RUN_BITS) + (key.to_numpy() & mask)] = np.arange(len(other))
            found = place[(row << JOIN_RUN_BITS) + (number.to_numpy() & mask)]
            hit = found >= 0
            at, on = pa.array(np.flatnonzero(hit)), pa.array(found[hit])
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(row[hit])) for c in batch.columns[:n_group]), number.take(at),
                 *(t.take(at) for t in left_texts), *(t.take(on) for t in right_texts)], schema.names)

    return both.mapInArrow(pair, schema).select(*keys, *texts[0], *texts[1])


def unpacked(columns: list):
    """The rows of the runs in an Arrow batch: number of the run, ``order`` and texts of each row."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.list_value_length(columns[0]).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.repeat(np.arange(len(size)), size)
    alone = size == 1
    # rows of longer runs first, then the lone ones: where each row is among these
    single = alone[run]
    where = np.empty(len(run), dtype=np.int64)
    where[~single], where[single] = np.arange((~single).sum()), (~single).sum() + np.arange(single.sum())
    alone, where = pa.array(alone), pa.array(where)

    def values(c):
        several = pc.split_pattern(c.filter(pc.invert(alone)), SEPARATOR).flatten()
        several = pc.if_else(pc.equal(several, NULL), pa.scalar(None, several.type), several)
        return pa.concat_arrays([several, c.filter(alone)]).take(where)

    return run, columns[0].flatten(), [values(c) for c in columns[1:]]
