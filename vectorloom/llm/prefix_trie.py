"""Prefix trie of conversations, with subtree totals by centroid decomposition.

A prefix is known by two 64-bit lanes: the exclusive-or of a hash of each turn with its
depth. That adds up in any order, so a very long conversation is cut into stretches. A
node is named by its smallest member and its depth; ``path`` holds for every turn of a
conversation the node it leads to, so an ancestor at a known depth is one look-up.

Subtree totals: a component is a connected part of the forest of parent edges. Its
centroid is the deepest node with more than half of the component's weight below it.
The weight of a node, the turns of all members from it on, is known from the start,
and what lies below a node is less wherever a centroid was cut off. Without the
centroid, every child's side and the upper side are components of at most half the
weight. The total of the lower sides and the centroid is the centroid's own, and is
added along the path from it to the component's top. Large components are cut in
rounds over tables; those below ``most`` are cut to the end inside a task, the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.llm.common import map_rows, stored, unsigned_crc32
from vectorloom.operators.positions import rows_before

SHARED_TURNS = 6  # a conversation shares fewer turns than this
SHARED_AMONG = 100
STRETCH = 4096  # turns of one conversation hashed by one window
MOST_WEIGHT = 4096  # of a component cut inside a task
MOST_ROUNDS = 100
IDS_PER_PIECE = 1 << 15

NODE = ["conv", "depth"]
TOP = ["top_conv", "top_depth"]
SETTLED = "conv bigint, depth bigint, n_leaves bigint, saved bigint"


def _turns(rows: DataFrame) -> DataFrame:
    """``conv, at, d1, d2, chars``: the turns of each conversation numbered from 0.

    Order is by turn (null first), then role and text. The range partitioning is by all
    four, so one conversation may fill many partitions.
    """
    clean = rows.select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).where("conv IS NOT NULL")
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    digests = [F.xxhash64(F.lit(lane), "role", "text").alias(f"d{lane}") for lane in (1, 2)]
    ordered = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv", *digests, F.char_length("text").cast("bigint").alias("chars"))
    # written at once, so the numbers are fixed from here on
    ordered = stored(ordered.withColumn("seq", F.monotonically_increasing_id()), "turns")
    return rows_before(ordered, ["conv"], "seq", "at").drop("seq")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``conv, depth, d1, d2, chars`` and conversations ``conv, turns``."""
    own = turns.groupBy("conv").agg(F.count("*").alias("own"))
    text = F.col("conv").cast("string")
    own = own.select(
        "conv",
        "own",
        (unsigned_crc32(text) % SHARED_TURNS).alias("h"),
        (F.col("conv") - F.col("conv") % SHARED_AMONG).alias("origin"),
    )
    origin = own.select(F.col("conv").alias("origin"), F.col("own").alias("origin_turns"))
    taken = F.least("h", F.coalesce("origin_turns", F.lit(0)))
    convs = own.join(origin, "origin", "left").withColumn("taken", taken)
    convs = convs.withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))

    heads = turns.where(F.col("at") < SHARED_TURNS).withColumnRenamed("conv", "origin")
    shared = convs.join(heads, "origin").where("at < taken")
    rest = turns.join(convs, "conv").where("at >= h").withColumn("at", F.expr("taken + at - h"))
    columns = ["conv", (F.col("at") + 1).alias("depth"), "d1", "d2", "chars"]
    return shared.select(*columns).unionByName(rest.select(*columns)), convs.select("conv", "turns")


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """Adds the lanes ``x1, x2`` of the prefix that ends at a turn, and those before it (``p1, p2``)."""
    lanes = [F.xxhash64(F.lit(lane), "depth", "d1", "d2").alias(f"k{lane}") for lane in (1, 2)]
    hashed = rebuilt.select("conv", "depth", "chars", F.expr(f"depth div {STRETCH}").alias("stretch"), *lanes)
    stretches = hashed.groupBy("conv", "stretch").agg(*[F.expr(f"bit_xor(k{lane})").alias(f"s{lane}") for lane in (1, 2)])
    before = W.partitionBy("conv").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    above = [F.coalesce(F.expr(f"bit_xor(s{lane})").over(before), F.lit(0)).alias(f"s{lane}") for lane in (1, 2)]
    stretches = stretches.select("conv", "stretch", *above)
    inside = W.partitionBy("conv", "stretch").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    hashed = hashed.withColumns({f"x{lane}": F.expr(f"bit_xor(k{lane})").over(inside) for lane in (1, 2)})
    joined = hashed.join(stretches, ["conv", "stretch"])
    joined = joined.withColumns({f"x{lane}": F.col(f"x{lane}").bitwiseXOR(F.col(f"s{lane}")) for lane in (1, 2)})
    before_it = {f"p{lane}": F.col(f"x{lane}").bitwiseXOR(F.col(f"k{lane}")) for lane in (1, 2)}
    return joined.withColumns(before_it).select("conv", "depth", "chars", "x1", "x2", "p1", "p2")


def _nodes(prefixes: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes, and the path table ``conv, depth, node_conv, above_conv`` (nodes at this depth and one above)."""
    roots = convs.select("conv", *[F.lit(0).cast("bigint").alias(c) for c in ("depth", "chars", "x1", "x2", "p1", "p2")])
    rows = stored(prefixes.unionByName(roots).join(convs, "conv"), "prefixes")
    key = ["depth", "x1", "x2"]
    weight = F.sum(F.col("turns") - F.col("depth") + 1).alias("weight")
    nodes = rows.groupBy(*key).agg(
        F.min("conv").alias("node_conv"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), weight,
    )
    nodes = stored(nodes, "nodes")
    up = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
        F.col("node_conv").alias("above_conv"),
    )
    nodes = stored(nodes.join(up, ["depth", "p1", "p2"], "left"), "nodes")
    found = rows.join(nodes.select(*key, "node_conv", "above_conv"), key)
    return nodes, stored(found.select("conv", "depth", "node_conv", "above_conv", "turns"), "path")


def settle(parents: list[int], weights: list[int], values: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Subtree totals in one component, its nodes in order of depth; ``parents[0]`` is not looked at."""
    weights, width = list(weights), len(values[0])
    added = [[0] * width for _ in values]
    totals: list[tuple[int, ...]] = [()] * len(values)
    work = [list(range(len(values)))]
    while work:
        part = work.pop()
        top = part[0]
        half = weights[top]
        centre = next(n for n in reversed(part) if 2 * weights[n] > half)
        lower: dict[int, list[int]] = {}
        side: dict[int, int] = {}
        upper = []
        for n in part:
            if n == centre:
                continue
            above = centre if n != top and parents[n] == centre else side.get(parents[n]) if n != top else None
            if above is None:
                upper.append(n)
            elif above == centre:
                side[n], lower[n] = n, [n]
            else:
                side[n] = above
                lower[above].append(n)
        below = [values[n] for n in side]
        total = [sum(column) for column in zip(values[centre], *below, strict=True)]
        totals[centre] = tuple(t + a for t, a in zip(total, added[centre], strict=True))
        at, cut = centre, weights[centre]
        while at != top:
            at = parents[at]
            weights[at] -= cut
            added[at] = [a + t for a, t in zip(added[at], total, strict=True)]
        work.extend(lower.values())
        if upper:
            work.append(upper)
    return totals


def _settle_all(slices: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components, sorted by their top, cut to the end one after the other."""
    out: list[tuple] = []
    names = ["conv", "depth", "n_leaves", "saved"]

    def finish(rows: list[dict]) -> None:
        place = {(r["conv"], r["depth"]): n for n, r in enumerate(rows)}
        parents = [place.get((r["above_conv"], r["depth"] - 1), 0) for r in rows]
        values = [(r["leaves"], r["saved"]) for r in rows]
        for r, total in zip(rows, settle(parents, [r["weight"] for r in rows], values), strict=True):
            out.append((r["conv"], r["depth"], total[0] + r["add_leaves"], total[1] + r["add_saved"]))

    def batch() -> pa.RecordBatch:
        columns = [pa.array(column, pa.int64()) for column in zip(*out, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    held: list[dict] = []
    for part in slices:
        for row in part.to_pylist():
            if held and (row["top_conv"], row["top_depth"]) != (held[0]["top_conv"], held[0]["top_depth"]):
                finish(held)
                held = []
            held.append(row)
        if len(out) >= 1 << 16:
            yield batch()
    if held:
        finish(held)
    if out:
        yield batch()


def _centroids(large: DataFrame) -> DataFrame:
    """Per component its centroid: the least weight among the nodes with more than half of it."""
    heavy = large.where("2 * weight > top_weight").groupBy(*TOP)
    return heavy.agg(
        F.min("weight").alias("centre_weight"),
        F.min_by("conv", "weight").alias("centre_conv"),
        F.min_by("depth", "weight").alias("centre_depth"),
    )


def rollup(tree: DataFrame, path: DataFrame, most: int = MOST_WEIGHT) -> DataFrame:
    """``conv, depth, n_leaves, saved`` summed over the subtree of every node of ``tree``.

    ``tree`` has ``conv, depth, above_conv, weight, leaves, saved``. A round halves the
    weight of every large component, so there are at most log2(all turns / ``most``).
    """
    zero = F.lit(0).cast("bigint")
    active = tree.withColumns({"top_conv": zero, "top_depth": zero})
    active = active.withColumns({"add_leaves": zero, "add_saved": zero})
    small, settled = [], []
    for _ in range(MOST_ROUNDS):
        active = stored(active, "components")
        tops = active.groupBy(*TOP).agg(F.max("weight").alias("top_weight"))
        sized = active.join(tops, TOP)
        small.append(sized.where(F.col("top_weight") <= most).drop("top_weight"))
        large = sized.where(F.col("top_weight") > most)
        if large.isEmpty():
            break
        marked = large.join(_centroids(large), TOP)
        steps = path.select(
            F.col("conv"), (F.col("depth") - 1).alias("centre_depth"),
            F.col("node_conv").alias("side_conv"), F.col("above_conv").alias("passes"),
        )
        centre = (F.col("conv") == F.col("centre_conv")) & (F.col("depth") == F.col("centre_depth"))
        below = F.coalesce((F.col("depth") > F.col("centre_depth")) & (F.col("passes") == F.col("centre_conv")), F.lit(False))
        cut = marked.join(steps, ["conv", "centre_depth"], "left").withColumns({"centre": centre, "below": below})
        cut = stored(cut.drop("passes"), "cut")

        sums = [F.sum(c).alias(f"sum_{c}") for c in ("leaves", "saved")]
        parts = cut.where("centre OR below").groupBy(*TOP, "centre_conv", "centre_depth", "centre_weight").agg(*sums)
        climbs = path.select(F.col("conv").alias("centre_conv"), "depth", F.col("node_conv").alias("conv"))
        climbs = parts.join(climbs, "centre_conv").where("depth >= top_depth AND depth <= centre_depth")
        climbs = climbs.select("conv", "depth", "sum_leaves", "sum_saved", "centre_weight")
        reached = cut.where("NOT below").drop("centre_weight").join(climbs, NODE, "left")
        added = {f"add_{c}": F.col(f"add_{c}") + F.coalesce(f"sum_{c}", zero) for c in ("leaves", "saved")}
        reached = reached.withColumns(added)
        settled.append(
            reached.where("centre").select(*NODE, F.col("add_leaves").alias("n_leaves"), F.col("add_saved").alias("saved"))
        )
        kept = reached.where("NOT centre").withColumn("weight", F.col("weight") - F.coalesce("centre_weight", zero))
        sides = cut.where("below").withColumns({"top_conv": F.col("side_conv"), "top_depth": F.col("centre_depth") + 1})
        active = kept.select(*active.columns).unionByName(sides.select(*active.columns))
    else:
        raise RuntimeError("components did not become small")
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    rest = rest.repartition(*TOP).sortWithinPartitions(*TOP, "depth")
    result = map_rows(rest, _settle_all, SETTLED)
    for more in settled:
        result = result.unionByName(more)
    return result


def _joined_ids(slices: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted identifiers of a node as texts of up to ``IDS_PER_PIECE`` of them."""
    names = ["conv", "depth", "first", "ids"]
    node, ids, out = None, [], []

    def close() -> None:
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for part in slices:
        for conv, depth, member in zip(*(part.column(c).to_pylist() for c in ("conv", "depth", "member")), strict=True):
            if (conv, depth) != node or len(ids) >= IDS_PER_PIECE:
                close()
                node = (conv, depth)
            ids.append(member)
        if out:
            yield batch()
    close()
    if out:
        yield batch()


def _hash_pieces(slices: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a node, in order, through one running hash."""
    names = ["conv", "depth", "ends_sha256"]
    node, running, out = None, None, []
    for part in slices:
        for row in part.to_pylist():
            if (row["conv"], row["depth"]) == node:
                running.update(b",")
            else:
                if node is not None:
                    out.append((*node, running.hexdigest()))
                node, running = (row["conv"], row["depth"]), hashlib.sha256()
            running.update(row["ids"].encode())
        if out:
            yield _digests(out, names)
            out = []
    if node is not None:
        yield _digests([(*node, running.hexdigest())], names)


def _digests(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _ends(path: DataFrame) -> DataFrame:
    """``conv, depth, ends_sha256`` of nodes at which a conversation ends.

    Identifiers are sorted over all tasks and joined to pieces there, so that the one
    task that hashes a node reads a row for thousands of conversations.
    """
    ends = path.where("depth = turns").select(F.col("node_conv").alias("conv"), "depth", F.col("conv").alias("member"))
    order = ["conv", "depth", "member"]
    pieces = map_rows(
        ends.repartitionByRange(*order).sortWithinPartitions(*order), _joined_ids,
        "conv bigint, depth bigint, first bigint, ids string",
    )
    pieces = pieces.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "first")
    return map_rows(pieces, _hash_pieces, "conv bigint, depth bigint, ends_sha256 string")


def build(conversations: DataFrame, most: int = MOST_WEIGHT) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, with totals over its subtree.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    Reads ``conv_id, turn, role, text`` only. Null role or text is empty. Rows without
    ``conv_id`` belong to no conversation and are left out. Null turns come first;
    equal turns are ordered by role, then text; repeated rows are turns of their own. An
    origin ``c - c % 100`` takes the sign of ``c``. An empty table has no root: 0 rows.
    """
    rebuilt, convs = _rebuilt(_turns(conversations))
    nodes, path = _nodes(_prefixes(rebuilt), stored(convs, "conversations"))
    children = nodes.groupBy(F.col("above_conv").alias("node_conv"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), ["node_conv", "depth"], "left")
    nodes = nodes.select(
        F.col("node_conv").alias("conv"), "depth", "above_conv", "n_convs", "weight", "chars",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
    )
    nodes = stored(nodes, "nodes")
    tree = nodes.select(
        "conv", "depth", "above_conv", "weight", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    totals = rollup(tree, path, most)
    full = nodes.join(totals, NODE).join(_ends(path), NODE, "left")
    return full.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("above_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
