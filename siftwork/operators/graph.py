"""Connected components over an edge table: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.session import cut, drop_cut, unsized


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node that has an edge to another, with the smallest node of its component.

    Each round replaces the edges by those of a large-star step (every larger neighbour is tied to the smallest one)
    and a small-star step (every smaller neighbour likewise); the number of rounds grows with the logarithm of the
    size. The least neighbour of a node comes from a partial aggregate and is joined back by sort-merge (see
    :func:`unsized`), so the edges of a node are never held in memory together; those of one node pass through one task,
    which spills what it sorts. The edges of each round are written to the shared folder, so a lost executor costs no
    recomputation of earlier rounds. Null ends, loops and repeated edges are ignored; an empty table gives an empty table.
    """
    kind = edges.schema[a].dataType.simpleString()
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = cut(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _sum(now)
    while state[0]:
        large = _large_star(now)
        after = cut(_small_star(large), "edges")
        drop_cut(now)
        now, new = after, _sum(after)
        if new == state:
            break
        state = new
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots).select(F.col("node").cast(kind), F.col("component").cast(kind))


def grouped_edges(rows: DataFrame, joined: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b): the edges of rows (id, h) whose groups ``h`` are joined as wholes, an edge a row and a link. ``links``: (h1, h2,
    first1, first2), two groups that are joined, with the least ids of both; ``joined``: (h, first), groups joined in
    themselves. A group with a link is joined in itself, too; the rows of other groups have no edges."""
    links = cut(links, "links")
    end = lambda n: links.select(F.col(f"h{n}").alias("h"), F.col(f"first{n}").alias("first"))
    every = joined.unionAll(end(1)).unionAll(end(2)).distinct()
    own = rows.join(unsized(every), "h").where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    return own.unionAll(links.select(F.col("first1").alias("a"), F.col("first2").alias("b")))


def _sum(edges: DataFrame) -> tuple:
    """Count and a hash of the edge set; equal to the round before only when nothing changed."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(unsized(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` all point from a larger to a smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(unsized(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
