"""Links within buckets, and connected components, without a group in one place."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.shared import shared_table

#: Rows of a bucket that one task handles at once. A larger bucket is cut into blocks,
#: and each pair of blocks becomes a bucket of its own.
BLOCK = 50_000
BLOCK_BYTES = 64_000_000

#: Buckets of so many rows at most are compared pair by pair, all in one sweep.
SMALL = 12

#: near(rows, i, js) -> which of the rows js are linked to row i, or to the row of i in
#: the same place if i is an array; rows are arrays by name.
Near = Callable[[dict[str, np.ndarray], int | np.ndarray, np.ndarray], np.ndarray]


def forest(rows: dict, near: Near, size: int) -> list[tuple[int, int]]:
    """Links that connect what `near` connects, at most one less than rows.

    Each row is compared with the rows no link has reached yet, so a dense bucket costs
    about as much as it has rows.
    """
    links = []
    left = np.arange(size)
    while left.size > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and left.size:
            i = queue.pop()
            hit = near(rows, i, left)
            reached = left[hit]
            links += [(i, int(j)) for j in reached]
            queue += reached.tolist()
            left = left[~hit]
    return links


def bucket_links(
    df: DataFrame, node: str, columns: Sequence[str], near: Near, key: str = "key"
) -> DataFrame:
    """Links (a, b) between nodes of rows that share a key and are `near`, as a table.

    Rows are (key, node, columns), both long; they are dealt out and sorted by key and
    read as a stream, so a task holds the rows of the key at hand and no more than two
    blocks of them. The links of a bucket connect the same rows as all its links do.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    df = df.select(key, node, *(c for c in columns if c != node))
    fields = df.schema
    schema = ", ".join(
        ["a long", "b long", "block long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)]
    )
    names = [f.name for f in fields]
    out_schema = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out_schema)

    def output(links, deferred=None, block=0):
        n = len(links)
        kept = deferred.num_rows if deferred is not None else 0
        a = pa.array([x for x, _ in links] + [None] * kept, pa.int64())
        b = pa.array([y for _, y in links] + [None] * kept, pa.int64())
        blocks = pa.array([None] * n + [block] * kept, pa.int64())
        rest = [
            pa.concat_arrays(
                [pa.nulls(n, arrow.field(c).type)]
                + ([x.cast(arrow.field(c).type) for x in deferred.column(c).chunks] if kept else [])
            )
            for c in names
        ]
        return pa.RecordBatch.from_arrays([a, b, blocks, *rest], schema=arrow)

    def of(table):
        rows = {}
        for c in names:
            col = table.column(c).combine_chunks()
            numeric = pa.types.is_integer(col.type)
            rows[c] = col.to_numpy(zero_copy_only=False) if numeric else np.array(col.to_pylist(), object)
        return rows

    def linked(table, keys):
        """Links of whole buckets; `keys` are the columns that make one."""
        if table.num_rows < 2:
            return []
        marks = [table.column(c).combine_chunks().to_numpy() for c in keys]
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for m in marks:
            change[1:] |= m[1:] != m[:-1]
        starts = np.flatnonzero(change)
        sizes = np.diff(np.append(starts, table.num_rows))
        links = []
        bucket = np.cumsum(change) - 1
        few = (sizes[bucket] > 1) & (sizes[bucket] <= SMALL)
        if few.any():
            part = of(table.filter(pa.array(few)))
            own, ids = bucket[few], part[node]
            for step in range(1, min(SMALL, len(ids))):
                i = np.flatnonzero(own[:-step] == own[step:])
                if not len(i):
                    break
                i = i[near(part, i, i + step)]
                links += zip(ids[i].tolist(), ids[i + step].tolist(), strict=True)
        many = sizes > SMALL
        for start, size in zip(starts[many].tolist(), sizes[many].tolist(), strict=True):
            part = of(table.slice(start, size))
            ids = part[node]
            links += [(int(ids[i]), int(ids[j])) for i, j in forest(part, near, size)]
        return links

    def stream(keys, may_defer):
        def run(batches):
            held, block = None, 0
            for batch in batches:
                now = pa.Table.from_batches([batch])
                held = now if held is None else pa.concat_tables([held, now])
                marks = [held.column(c).combine_chunks().to_numpy() for c in keys]
                same = np.ones(held.num_rows, bool)
                for m in marks:
                    same &= m == m[-1]
                begin = int(np.argmax(same))  # sorted: the last bucket starts here
                if begin:
                    if block:  # the bucket that was deferred ends in this table
                        first = np.ones(held.num_rows, bool)
                        for m in marks:
                            first &= m == m[0]
                        ends = int(np.argmin(first))
                        yield output([], held.slice(0, ends), block)
                        held, begin, block = held.slice(ends), begin - ends, 0
                    yield output(linked(held.slice(0, begin), keys))
                    held = held.slice(begin)
                while may_defer and (held.num_rows > 2 * BLOCK or held.nbytes > 2 * BLOCK_BYTES and held.num_rows > 2):
                    rows = max(1, min(BLOCK, held.num_rows * BLOCK_BYTES // held.nbytes))
                    yield output([], held.slice(0, rows), block)
                    held, block = held.slice(rows), block + 1
            if held is not None and held.num_rows:
                if block:
                    yield output([], held, block)
                else:
                    yield output(linked(held, keys))

        return run

    found = shared_table(
        df.repartition(key).sortWithinPartitions(key).mapInArrow(stream([key], True), out_schema),
        "links",
    )
    links = found.where("a IS NOT NULL").select("a", "b")
    late = found.where("block IS NOT NULL").drop("a", "b")
    if late.isEmpty():
        return links.distinct()
    blocks = late.groupBy(key).agg((F.max("block") + 1).alias("blocks"))
    pairs = (
        late.join(blocks, key)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .select(key, "lo", "hi", *(n for n in names if n != key))
    )
    names_late = [key, "lo", "hi"]
    more = (
        pairs.repartition(*names_late)
        .sortWithinPartitions(*names_late)
        .mapInArrow(stream(names_late, False), out_schema)
        .select("a", "b")
    )
    return shared_table(links.unionByName(more).distinct(), "links")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); component is the smallest node.

    Alternating stars: each round hangs a node's larger neighbours, then its smaller
    ones, on the smallest. A round is written to the shared folder, and rounds end when
    one changes nothing. Null ends and loops are left out.
    """
    now = shared_table(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            break
        seen = tuple(mark)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        now = shared_table(small.select("e.*").where("u <> v").distinct(), "edges")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
