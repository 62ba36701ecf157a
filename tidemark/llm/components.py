"""Connected components of an edge table, by local forests and large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut, ready

#: Tasks follow the edges: one for so many, whatever the session's shuffle partitions.
EDGES_PER_TASK = 250_000


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One star step over (a, b): neighbours are tied to the least vertex seen.

    The large star ties every greater neighbour of a vertex to the least vertex
    around it, the small star the lesser neighbours and the vertex itself. The
    join's right side has a row per vertex, so adaptive execution can split the
    edges of a vertex that has very many.
    """
    if large:
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    tied = both.join(least, "a").coalesce(tasks)
    if large:
        return tied.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    pairs = tied.select(F.explode(F.array(F.struct("b", "_m"), F.struct(F.col("a").alias("b"), "_m"))).alias("e"))
    return pairs.select(F.col("e.b").alias("a"), F.col("e._m").alias("b")).filter(F.col("a") != F.col("b"))


def _forest(edges: DataFrame) -> DataFrame:
    """Each partition's edges as stars (vertex, least vertex reached), which join what the edges join.

    At most EDGES_PER_TASK edges are held at once; a longer partition gives several sets of stars.
    """
    names = edges.schema.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}
        held = 0

        def root(v):
            while (up := above.setdefault(v, v)) != v:
                above[v] = v = above.setdefault(up, up)
            return v

        def stars(kind: list[pa.DataType]) -> pa.RecordBatch:
            out = [(v, r) for v in list(above) if (r := root(v)) != v]
            above.clear()
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind[k]) for k in (0, 1)], names=names)

        kind: list[pa.DataType] = []
        for batch in batches:
            kind = [f.type for f in batch.schema]
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(x), root(y)
                if x < y:
                    above[y] = x
                elif y < x:
                    above[x] = y
                held += 1
                if held == EDGES_PER_TASK:
                    yield stars(kind)
                    held = 0
        if above:
            yield stars(kind)

    return edges.mapInArrow(read, edges.schema)


def components(edges: DataFrame) -> DataFrame:
    """vertex, root for every vertex of an edge; the root is the least vertex of its component.

    Vertices may be long or binary. What a task sees is first joined there, so
    up to EDGES_PER_TASK edges that are left are finished in one task. With more,
    rounds of stars write their edges to the checkpoint folder each and end when
    nothing changes, which takes a logarithmic number of them. Loops are no
    edges. An empty table gives no rows.
    """
    ready(edges.sparkSession)
    now = cut(_forest(edges.filter(F.col("a") != F.col("b")).select("a", "b")))
    size = now.count()
    if size <= EDGES_PER_TASK:
        now = cut(_forest(now.coalesce(1)))
    else:
        before = None
        while True:
            state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if tuple(state) == before:
                break
            before = tuple(state)
            tasks = 1 + state[0] // EDGES_PER_TASK
            now = cut(_star(_forest(_star(now, True, tasks)), False, tasks).distinct().coalesce(tasks))
    roots = now.select(F.col("b").alias("vertex")).distinct().withColumn("root", F.col("vertex"))
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)
