"""Connected components as a distributed union-find, and pairs out of buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import release_unused, written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and component (the smallest node reachable) of every node of
    ``edges`` (columns a and b, of one type that can be ordered).

    Each round hooks the larger neighbours of every node to its smallest one, then
    the smaller ones too (large star, small star).  Trees flatten in a number of
    rounds like the logarithm of their size; each round is a written table.
    Smallest neighbours are aggregated map-side, so a node with very many edges
    costs a row for each task.
    """
    edges = written(_oriented(edges, "a", "b").distinct(), name)
    before = _summary(edges)
    while True:
        # large star: edges both ways, the larger neighbours of a node go to its smallest
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = _oriented(both.where("b > a").join(least, "a"), "b", "m").distinct()
        # small star: a node's smaller neighbours, and itself, go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _oriented(large.join(least, "a").select("b", "m"), "b", "m").unionByName(
            _oriented(least, "a", "m")
        )
        edges = written(small.distinct(), name)
        after = _summary(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = after


def _oriented(edges: DataFrame, x: str, y: str) -> DataFrame:
    """Edges from the larger end (a) to the smaller (b); loops go."""
    return edges.where(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))


def _summary(edges: DataFrame) -> tuple:
    """Number and hash total of the edges: two numbers, whatever the size."""
    half = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(half)).first())


def star_pairs(rows: DataFrame, key: str, member: str, most: int, partitions: int) -> DataFrame:
    """Pairs (a, b) of members that share a bucket.

    Rows are sorted by bucket and read as a stream.  A bucket of at most ``most``
    members gives all its pairs; a larger one pairs each member, itself too, with
    the first (a) only.  Such rows name the bucket, so that the caller can see to the
    pairs that are left out; it is null in the others.
    """
    kind = dict(rows.dtypes)[member]
    arrow = {"bigint": pa.int64(), "binary": pa.binary()}[kind]
    schema = pa.schema([("bucket", pa.int64()), ("a", arrow), ("b", arrow)])
    placed = (
        rows.select(F.col(key).alias("bucket"), F.col(member).alias("b"))
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"key": None, "members": [], "large": False}
        out: list[tuple] = []

        def close() -> None:
            own = state["members"]
            if not state["large"]:
                out.extend((None, x, y) for i, x in enumerate(own) for y in own[i + 1 :])

        def add(k: int, members: list) -> None:
            if state["key"] != k:
                close()
                state.update(key=k, members=[], large=False)
            own = state["members"]
            for m in members:
                if own and own[-1] == m:
                    continue
                if state["large"]:
                    out.append((k, own[0], m))
                    own[-1] = m  # only the first and the last are needed
                    continue
                own.append(m)
                if len(own) > most:
                    state["large"] = True
                    out.extend((k, own[0], x) for x in own)
                    state["members"] = own = [own[0], m]

        def take() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], schema.field(i).type) for i in range(3)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("bucket").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            size = np.diff(np.r_[edge, len(keys)])
            # buckets of one row can only matter at the ends of a batch
            chosen = np.flatnonzero(size > 1)
            chosen = np.unique(np.r_[0, chosen, len(edge) - 1])
            members = batch.column("b")
            for i in chosen.tolist():
                add(int(keys[edge[i]]), members.slice(edge[i], size[i]).to_pylist())
                if len(out) > 50_000:
                    yield take()
        close()
        yield take()
        release_unused()

    return placed.mapInArrow(run, f"bucket long, a {kind}, b {kind}")


def close_links(
    large: DataFrame,
    found: DataFrame,
    tried: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    rest: Callable[[DataFrame], DataFrame],
    rounds: int = 2,
) -> DataFrame:
    """Links (a, b) with the components of ``found`` and of what large buckets hold.

    ``large`` has bucket and member (and what ``rest`` needs), ``found`` the links
    so far, ``tried`` the pairs already compared; ``verify`` gives the links among
    pairs.  In each round the members of a bucket outside its largest component
    are paired with one member of it, another in each bucket.  The pairs of the
    buckets that still span several components come from ``rest``, which gets their
    rows with the component of each member.  A round starts from the flat trees of
    the one before, so that only new links are left to follow.
    """
    for turn in range(rounds + 1):
        label = components(found).withColumnRenamed("node", "member")
        found = label.where("member <> component").select(F.col("member").alias("a"), F.col("component").alias("b"))
        sized = label.join(label.groupBy("component").agg(F.count(F.lit(1)).alias("weight")), "component")
        rows = large.join(sized, "member", "left").withColumns(
            {"component": F.coalesce("component", "member"), "weight": F.coalesce("weight", F.lit(1))}
        )
        # buckets that lie in one component have nothing left to find
        turned = F.struct("weight", "component", F.xxhash64("bucket", "member", F.lit(turn)).alias("turn"), "member")
        spans = rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max(turned).alias("centre"))
        rows = written(rows.join(spans.where("lo <> hi").select("bucket", "centre"), "bucket"), "open")
        if rows.isEmpty():
            break
        if turn < rounds:
            new = rows.where("component <> centre.component").select(F.col("centre.member").alias("a"), F.col("member").alias("b"))
        else:
            new = rest(rows)
        new = written(_oriented(new, "a", "b").select(F.col("b").alias("a"), F.col("a").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        if not new.isEmpty():
            found = written(found.unionByName(verify(new)), "links")
            tried = written(tried.unionByName(new), "tried")
    return found
