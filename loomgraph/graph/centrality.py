"""Degree, PageRank, betweenness and closeness of a projected view, and their combination.

Conventions: edges as directed; degree counts out-edges; PageRank starts at
1 - d, adds d times what comes in and lets the mass of nodes without out-edges
go; closeness is, over the nodes that reach one, their number by the sum of
their distances; betweenness is exact and not normalised.  Parallel edges count
each in degree and PageRank, once in distances; self-loops are on no shortest
path.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.storage import drop_settled, settle

MEASURES = ["degree", "pagerank", "betweenness", "closeness"]


def project(nodes: DataFrame, edges: DataFrame, labels: DataFrame, rel_types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id) and (src, dst) of a view: nodes of its labels, and edges of its types between them."""
    own = nodes.join(F.broadcast(labels.select("label").distinct()), "label", "left_semi").select("id").distinct()
    kept = edges.join(F.broadcast(rel_types.select("rel_type").distinct()), "rel_type", "left_semi").select("src", "dst")
    for end in ("src", "dst"):
        kept = kept.join(own.select(F.col("id").alias(end)), end, "left_semi")
    return own, kept.select("src", "dst")


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    out = edges.groupBy("src").agg(F.count("*").alias("degree"))
    return nodes.join(out.withColumnRenamed("src", "id"), "id", "left").select("id", F.coalesce("degree", F.lit(0)).cast("double").alias("degree"))


def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int = 20, damping: float = 0.85, cut: int = 5) -> DataFrame:
    """Exactly `iterations` rounds, each one join and one aggregation; ranks are settled every `cut` rounds and at the end."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = edges.groupBy("src").agg(F.count("*").alias("n"))
    weighted = settle(edges.groupBy("src", "dst").agg(F.count("*").alias("m")).join(out, "src").select("src", "dst", (F.col("m") / F.col("n")).alias("share")))
    # the edges stay where their sources' ranks come to, so a round moves ranks and sums alone
    held = weighted.repartition(parts, "src").persist(StorageLevel.DISK_ONLY)
    base = settle(nodes.select("id"))
    rank = base.withColumn("pagerank", F.lit(1.0 - damping))
    last = None
    for k in range(1, iterations + 1):
        come = held.join(rank, held["src"] == rank["id"]).groupBy("dst").agg(F.sum(F.col("share") * F.col("pagerank")).alias("come"))
        rank = base.join(come, base["id"] == come["dst"], "left").select("id", (F.lit(1.0 - damping) + damping * F.coalesce("come", F.lit(0.0))).alias("pagerank"))
        if k % cut == 0 or k == iterations:
            rank = settle(rank)
            if last is not None:
                drop_settled(last)
            last = rank
    held.unpersist()
    drop_settled(weighted)
    return rank


def shortest_paths(nodes: DataFrame, edges: DataFrame, sources: DataFrame | None = None, max_depth: int | None = None) -> DataFrame:
    """src, dst, d, sigma of all ordered pairs a path joins, src = dst with d 0 among them.

    Level by level from all sources together; the state is a row for each pair,
    so bound the sources where the view is large.  A shortest path of more than
    max_depth edges, if that is given, is an error.
    """
    adjacent = settle(edges.where(F.col("src") != F.col("dst")).select(F.col("src").alias("at"), F.col("dst").alias("to")).distinct())
    starts = (sources if sources is not None else nodes).select("id").distinct()
    done = settle(starts.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0).alias("d"), F.lit(1.0).alias("sigma")))
    levels, frontier = [done], done
    for depth in count(1):
        step = frontier.join(adjacent, frontier["dst"] == adjacent["at"]).groupBy("src", "to").agg(F.sum("sigma").alias("sigma")).withColumnRenamed("to", "dst")
        seen = levels[0].select("src", "dst")
        for level in levels[1:]:
            seen = seen.unionByName(level.select("src", "dst"))
        frontier = settle(step.join(seen, ["src", "dst"], "left_anti").select("src", "dst", F.lit(depth).alias("d"), "sigma"))
        if frontier.limit(1).count() == 0:
            break
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"a shortest path has more than {max_depth} edges")
        levels.append(frontier)
        if len(levels) > 8:  # few files to look at again
            merged = levels[0]
            for level in levels[1:]:
                merged = merged.unionByName(level)
            levels = [settle(merged)]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def closeness(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    got = paths.where("d > 0").groupBy("dst").agg((F.count("*") / F.sum("d")).alias("closeness"))
    return nodes.join(got.withColumnRenamed("dst", "id"), "id", "left").select("id", F.coalesce("closeness", F.lit(0.0)).alias("closeness"))


#: Targets in a chunk; edges in a group, about; chunks that meet a group in one task; bytes of reach held for one block of targets.
CHUNK, GROUP_EDGES, MEET, HELD_BYTES = 1024, 1 << 18, 4, 1 << 30


def closeness_by_reach(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, closeness of every node, as `closeness` of all shortest paths gives it, without a row for each pair.

    A node's reach, the targets within d edges of it, is a bit for each node
    that edges lead to, in chunks of CHUNK.  Round by round it is the reach of
    the node's successors and itself; targets are counted by bit, until nothing
    is added.  Nodes that no edge leads to are counted and not held.  Edges are
    dealt to groups by source, and a group gets the reach of each successor
    once.  Targets come in blocks whose reach takes HELD_BYTES at most; a
    source's edges are worked on by one task.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adjacent = settle(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    targets = adjacent.select(F.col("dst").alias("id")).distinct()
    n = targets.count()
    # number >> 10 is a chunk, the rest the bit in it
    numbered = settle(targets.orderBy("id").coalesce(-(-n // (64 * CHUNK)) or 1).withColumn("at", F.monotonically_increasing_id()))
    named = adjacent.join(nodes.select(F.col("id").alias("src")).distinct().withColumn("own", F.lit(True)), "src", "left")
    named = named.join(numbered.select(F.col("id").alias("dst"), F.col("at").alias("to")), "dst").join(numbered.select(F.col("id").alias("src"), "at"), "src", "left")
    groups = max(parts, -(-adjacent.count() // GROUP_EDGES))
    dealt = settle(named.repartitionByRange(groups, "src").select(F.spark_partition_id().alias("group"), "src", F.coalesce("own", F.lit(False)).alias("own"), F.coalesce("at", F.lit(-1)).alias("at"), "to"))
    packed = settle(dealt.groupBy("group").applyInArrow(_packed, _PACKED_SQL))
    needs = settle(dealt.select("group", "to").distinct())
    blocks = max(1, -(-n * n // (8 * HELD_BYTES)))
    rounds = None
    for k in range(blocks):
        chunk = F.shiftright("at", 10)
        inside = lambda df: df.where(F.pmod(F.xxhash64(chunk), F.lit(blocks)) == k).select("at", chunk.alias("chunk"), _one_bit(F.col("at")).alias("bits"))
        itself, total = inside(numbered), 0
        reach = itself
        for depth in count(1):
            met = needs.join(reach.withColumnRenamed("at", "to"), "to").withColumn("part", F.floor(F.col("chunk") / MEET))
            keys = needs.join(reach.select(F.col("at").alias("to"), "chunk"), "to").select("group", F.floor(F.col("chunk") / MEET).alias("part")).distinct()
            both = packed.join(keys, "group").groupBy("group", "part").cogroup(met.groupBy("group", "part"))
            step = settle(both.applyInArrow(_reached, _REACHED_SQL))
            added = step.where("counts is not null").select("chunk", F.posexplode("counts").alias("bit", "n")).where("n > 0").groupBy("chunk", "bit").agg(F.sum("n").alias("n"))
            added = settle(added.withColumn("depth", F.lit(depth)))
            before, total = total, added.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            if total == before:
                break
            rounds = added if rounds is None else rounds.unionByName(added)
            if depth > 1:
                drop_settled(last)
            last, reach = step, step.where("bits is not null").select("at", "chunk", "bits").unionByName(itself)
        # nothing came in this last round, so the distances of what the rounds before counted are known
        drop_settled(step)
        if depth > 1:
            drop_settled(last)
    if rounds is None:
        return nodes.select("id", F.lit(0.0).alias("closeness"))
    # c pairs within each depth: their number is that of the last one, and each distance is 1 and 1 for each earlier depth that lacks the pair
    by = rounds.groupBy("chunk", "bit").agg(F.max("n").alias("n"), F.max("depth").alias("depth"), F.sum("n").alias("s"))
    got = by.select((F.shiftleft("chunk", 10) + F.col("bit")).alias("at"), (F.col("n") / (F.col("n") * (F.col("depth") + 1) - F.col("s"))).alias("closeness"))
    close = numbered.join(got, "at").select("id", "closeness")
    return nodes.join(close, "id", "left").select("id", F.coalesce("closeness", F.lit(0.0)).alias("closeness"))


def _one_bit(at):
    """CHUNK bits as a string of bytes, of which one is set: bit b is bit b % 8 of byte b / 8."""
    place = at.bitwiseAND(CHUNK - 1)
    byte = F.lpad(F.hex(F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), (place % 8 + 1).cast("int"))), 2, "0")
    left = F.floor(place / 8).cast("int")
    return F.unhex(F.concat(F.repeat(F.lit("00"), left), byte, F.repeat(F.lit("00"), F.lit(CHUNK // 8 - 1) - left)))


_PACKED_SQL = "group int, own binary, at binary, start binary, names binary, to binary"
_PACKED = pa.schema([("group", pa.int32()), *((c, pa.binary()) for c in ("own", "at", "start", "names", "to"))])
_REACHED_SQL = "at long, chunk long, bits binary, counts array<long>"
_REACHED = pa.schema([("at", pa.int64()), ("chunk", pa.int64()), ("bits", pa.binary()), ("counts", pa.list_(pa.int64()))])


def _packed(table: pa.Table) -> pa.Table:
    """A group's edges by source: whether it counts, its number (-1: none), where its edges start; the targets' numbers, and each edge's among them."""
    source = np.asarray(table["src"].combine_chunks().dictionary_encode().indices)
    order = np.argsort(source, kind="stable")
    source = source[order]
    start = np.flatnonzero(np.append(True, source[1:] != source[:-1]))
    names, to = np.unique(np.asarray(table["to"])[order], return_inverse=True)
    own, at = (np.asarray(table[c])[order][start] for c in ("own", "at"))
    blobs = [own.astype(np.uint8), at.astype(np.int64), start.astype(np.int64), names.astype(np.int64), to.astype(np.int32)]
    return pa.table({"group": table["group"][:1], **{c: [x.tobytes()] for c, x in zip(_PACKED.names[1:], blobs)}}, schema=_PACKED)


def _reached(packed: pa.Table, met: pa.Table) -> pa.Table:
    """What a group's sources reach, of the chunks met, one edge before what their successors do, and counts; without themselves."""
    if not packed.num_rows or not met.num_rows:
        return _REACHED.empty_table()
    own, at, start, names, to = (np.frombuffer(packed[c][0].as_py(), kind) for c, kind in zip(_PACKED.names[1:], (np.uint8, np.int64, np.int64, np.int64, np.int32)))
    source = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(to))))
    chunks, targets = np.asarray(met["chunk"]), np.asarray(met["to"])
    bits = met["bits"].combine_chunks()
    out = {c: [] for c in _REACHED.names}
    for chunk in np.unique(chunks):
        rows = np.flatnonzero(chunks == chunk)
        name = np.searchsorted(names, targets[rows])
        order = np.argsort(name, kind="stable")
        rows, name = rows[order], name[order]
        one = np.flatnonzero(np.append(True, name[1:] != name[:-1]))  # a target has a row for itself and one for what it reaches
        held = np.bitwise_or.reduceat(np.frombuffer(b"".join(bits.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1), one, axis=0)
        row_of = np.full(len(names), -1)
        row_of[name[one]] = np.arange(len(one))
        row = row_of[to]
        edge = np.flatnonzero(row >= 0)
        first = np.flatnonzero(np.append(True, source[edge][1:] != source[edge][:-1]))
        total = np.zeros(CHUNK, np.int64)
        numbers, blobs = [], []
        ends = np.append(first, len(edge))
        for a in range(0, len(first), 4096):
            b = min(a + 4096, len(first))
            inner = edge[ends[a] : ends[b]]
            some = np.bitwise_or.reduceat(held[row[inner]], first[a:b] - ends[a], axis=0)
            who = source[edge[first[a:b]]]
            flat = np.ascontiguousarray(some).view(np.uint8)
            self_at = np.flatnonzero(at[who] >> 10 == chunk)
            bit = at[who][self_at] & (CHUNK - 1)
            flat[self_at, bit // 8] &= ~(1 << bit % 8).astype(np.uint8)
            counted = own[who] > 0
            total += np.unpackbits(flat[counted], axis=1, bitorder="little").sum(0, dtype=np.int64)
            kept = at[who] >= 0
            numbers.append(at[who][kept])
            blobs.append(flat[kept])
        numbers = np.concatenate(numbers)
        out["at"] += [*numbers.tolist(), None]
        out["chunk"] += [int(chunk)] * (len(numbers) + 1)
        out["bits"] += [*(x.tobytes() for x in np.concatenate(blobs)), None]
        out["counts"] += [*[None] * len(numbers), total.tolist()]
    return pa.table(out, schema=_REACHED)


def betweenness(nodes: DataFrame, edges: DataFrame, paths: DataFrame) -> DataFrame:
    """The sum over pairs of the share of their shortest paths that pass a node; over the sources that paths has."""
    adjacent = edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    got = passed(adjacent, paths).groupBy("id").agg(F.sum("b").alias("betweenness"))
    return nodes.join(got, "id", "left").select("id", F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"))


def combine(measures: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """measures with `<column>_norm`, min-max scaled with 1e-10 in the divisor, and combined, their mean."""
    bounds = measures.agg(*[f(c).alias(f"_{c}_{k}") for c in columns for k, f in (("lo", F.min), ("hi", F.max))])
    joined = measures.crossJoin(F.broadcast(bounds))  # one row
    out = joined.withColumns({f"{c}_norm": (F.col(c) - F.col(f"_{c}_lo")) / (F.col(f"_{c}_hi") - F.col(f"_{c}_lo") + 1e-10) for c in columns})
    total = sum((F.col(f"{c}_norm") for c in columns), F.lit(0.0))
    return out.withColumn("combined", total / len(columns)).select(*measures.columns, *[f"{c}_norm" for c in columns], "combined")


def centrality(nodes: DataFrame, edges: DataFrame, *, iterations: int = 20, damping: float = 0.85, max_exact: int = 2000, seed: int = 7) -> DataFrame:
    """id, the four measures and combined of every node, exact at every size.

    Sources are taken in blocks of about max_exact, dealt by a hash with the
    seed, and what each block adds to closeness and betweenness is summed.
    """
    nodes, edges = settle(nodes.select("id").distinct()), settle(edges.select("src", "dst"))
    n = nodes.count()
    blocks = max(1, -(-n // max_exact))
    adjacent = settle(edges.where(F.col("src") != F.col("dst")).distinct())
    total = None
    for k in range(blocks):
        paths = settle(shortest_paths(nodes, edges, nodes.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(blocks)) == k)))
        near = paths.where("d > 0").groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"), F.sum("d").alias("d"), F.lit(0.0).alias("b"))
        both = near.unionByName(passed(adjacent, paths).select("id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("d"), "b"))
        both = both if total is None else both.unionByName(total)
        added = settle(both.groupBy("id").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.sum("b").alias("b")))
        for old in (paths, total):
            if old is not None:
                drop_settled(old)
        total = added
    far = nodes.join(total, "id", "left").select("id", F.coalesce("b", F.lit(0.0)).alias("betweenness"), F.coalesce(F.when(F.col("d") > 0, F.col("n") / F.col("d")), F.lit(0.0)).alias("closeness"))
    out = degree(nodes, edges).join(pagerank(nodes, edges, iterations, damping), "id").join(far, "id")
    return combine(settle(out)).select("id", *MEASURES, "combined")


def passed(adjacent: DataFrame, paths: DataFrame) -> DataFrame:
    """id, b: over the sources in paths, the shares of their shortest paths that pass a node, from the farthest level back (Brandes)."""
    deepest = paths.agg(F.max("d")).first()[0] or 0
    later, out = None, paths.where("false").select(F.col("dst").alias("id"), F.lit(0.0).alias("b"))
    for depth in range(deepest, 1, -1):
        level = paths.where(F.col("d") == depth).select("src", "dst", "sigma")
        level = level.withColumn("b", F.lit(0.0)) if later is None else level.join(later, ["src", "dst"], "left").withColumn("b", F.coalesce("b", F.lit(0.0)))
        back = level.select(F.col("src").alias("s"), F.col("dst").alias("to"), ((1 + F.col("b")) / F.col("sigma")).alias("share")).join(adjacent.select(F.col("src").alias("at"), F.col("dst").alias("to")), "to")
        before = paths.where(F.col("d") == depth - 1).select("src", "dst", "sigma")
        met = before.join(back, (before["src"] == back["s"]) & (before["dst"] == back["at"]))
        later = settle(met.groupBy("src", "dst").agg(F.sum(F.col("share") * F.col("sigma")).alias("b")))
        out = out.unionByName(later.groupBy(F.col("dst").alias("id")).agg(F.sum("b").alias("b")))
    return out


def view_counts(views: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """view, nodes, relationships of projected views."""
    rows = None
    for view, (nodes, edges) in views.items():
        one = nodes.agg(F.count("*").alias("nodes")).crossJoin(edges.agg(F.count("*").alias("relationships"))).select(F.lit(view).alias("view"), "nodes", "relationships")
        rows = one if rows is None else rows.unionByName(one)
    return rows
