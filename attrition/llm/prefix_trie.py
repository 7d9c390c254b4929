"""A trie of conversations, its subtree totals passed up by time-forward processing.

Conversations are rebuilt over shared openings, and every distinct beginning of
one is a node. Nodes on which the same conversations agree form a run, so a long
conversation of its own is one run. Runs are processed in reverse level order:
Spark sorts each shard externally, a run takes what its children left for it in a
priority queue that spills to files, and leaves its own totals for its parent.
A shard holds whole subtrees of a bounded number of conversations; what shard
roots send further up is summed map-side, and the runs above them go through
shards of their own in the next round, until the root is reached.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.scratch import store

# Conversations in a subtree that one shard takes whole; the next round takes subtrees of as many times more.
SHARD = 256
# Messages a queue holds in memory before it spills them, sorted, to a file.
QUEUE = 100_000
# Turns of a conversation that one window goes over, and consecutive ids whose members one row lists.
CHUNK, IDS = 4096, 4096


class SpillingQueue:
    """A priority queue of tuples that keeps at most ``limit`` in memory; the rest is in sorted files.

    Files are nameless, live as long as their task and lie where Spark's own sorts spill; a task that is run again makes its own.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.memory, self.heads, self.spills = limit, [], [], 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.memory, message)
        if len(self.memory) > self.limit:
            file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
            for item in sorted(self.memory):
                pickle.dump(item, file)
            file.seek(0)
            self.memory = []
            self.spills += 1
            self._advance(file, self.spills)

    def _advance(self, file, name: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(file), name, file))
        except EOFError:
            file.close()

    def first(self) -> tuple | None:
        found = [queue[0] if queue is self.memory else queue[0][0] for queue in (self.memory, self.heads) if queue]
        return min(found, default=None)

    def pop(self) -> tuple:
        if self.heads and (not self.memory or self.heads[0][0] < self.memory[0]):
            item, name, file = heapq.heappop(self.heads)
            self._advance(file, name)
            return item
        return heapq.heappop(self.memory)


def positions(turns: DataFrame) -> DataFrame:
    """``turns`` with ``place``, 1 for the first turn of a conversation; a conversation may be spread over many tasks.

    Turns are range-partitioned and numbered inside each range; a conversation that goes on
    over ranges takes the counts of those before, so at most one conversation a range is joined.
    """
    order = [F.col("turn").asc_nulls_first(), "t1", "t2"]
    # The last key deals out equal turns, whose order makes no difference.
    dealt = turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order, "tie")
    ranged = store(dealt.drop("tie").withColumn("part", F.spark_partition_id()), "turns")
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    later = store(counts.withColumn("before", before).where("before IS NOT NULL").select("conv_id", "part", "before"), "later-ranges")
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    placed = ranged.withColumn("inside", inside).join(later, ["conv_id", "part"], "left")
    return placed.select("conv_id", "t1", "t2", "chars", (F.col("inside") + F.coalesce("before", F.lit(0))).alias("place"))


def rebuilt(conversations: DataFrame, shared_of: int, shared_turns: int) -> tuple[DataFrame, DataFrame]:
    """All rebuilt turns, ``conv_id, n_turns, depth, t1, t2, chars``, and all ``conv_id, n_turns``, both written."""
    content = [F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))]
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(*content).alias("t1"),
        F.xxhash64(F.lit(7), *content).alias("t2"),
        F.char_length(content[1]).cast("long").alias("chars"),
    )
    placed = store(positions(turns), "placed")
    base, taken = F.expr(f"conv_id - conv_id % {shared_of}"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % (shared_turns + 1)
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", base.alias("base"), taken.alias("h"))
    openings = placed.where(f"conv_id % {shared_of} = 0 AND place <= {shared_turns}").withColumnRenamed("conv_id", "base")
    # What a conversation finds to open with, of at most ``shared_turns`` turns of its base.
    there = openings.groupBy("base").agg(F.count("*").alias("there"))
    asked = sizes.join(there, "base", "left").withColumn("found", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
    asked = asked.withColumn("n_turns", F.col("found") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long")))
    asked = store(asked.select("conv_id", "base", "h", "found", "n_turns"), "asked")
    opening = asked.where("found > 0").join(openings, "base").where("place <= found").withColumn("depth", F.col("place"))
    own = placed.join(asked, "conv_id").where("place > h").withColumn("depth", F.expr("place - h + found"))
    columns = ["conv_id", "n_turns", "depth", "t1", "t2", "chars"]
    return store(opening.select(columns).union(own.select(columns)), "rebuilt"), asked.select("conv_id", "n_turns")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with two hashes of all turns up to ``depth`` (``p1, p2``) and up to the one before (``b1, b2``).

    A prefix is the exclusive or of hashes of each turn and its place, so long conversations are hashed in chunks.
    """
    hashed = turns.withColumns(
        {
            "chunk": F.expr(f"(depth - 1) div {CHUNK}"),
            "h1": F.xxhash64("depth", "t1", "t2"),
            "h2": F.xxhash64(F.lit(7), "depth", "t2", "t1"),
        }
    )
    chunks = hashed.groupBy("conv_id", "chunk").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select("conv_id", "chunk", *[F.bit_xor(f"h{i}").over(earlier).alias(f"o{i}") for i in (1, 2)]).where("chunk > 0")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.withColumns({f"r{i}": F.bit_xor(f"h{i}").over(inside) for i in (1, 2)}).join(before, ["conv_id", "chunk"], "left")
    through = running.withColumns({f"p{i}": F.col(f"r{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0).cast("long"))) for i in (1, 2)})
    past = [F.col(f"p{i}").bitwiseXOR(F.col(f"h{i}")).alias(f"b{i}") for i in (1, 2)]
    return through.select("conv_id", "n_turns", "depth", "chars", "p1", "p2", *past)


def list_hashes(ends: DataFrame) -> DataFrame:
    """``depth, p1, p2, ends_sha256``: the SHA-256 of each node's conv_ids in ``ends``, ascending, comma-joined.

    Ids are listed by blocks of IDS consecutive numbers, so no row grows with the table; a task streams a node's blocks.
    """
    node = ["depth", "p1", "p2"]
    block = F.expr(f"shiftright(conv_id, {IDS.bit_length() - 1})")
    listed = ends.groupBy(*node, block.alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _batch(done, kinds)
            done = []
        if at is not None:
            yield _batch([(*at, digest.hexdigest())], kinds)

    kinds = {"depth": pa.int64(), "p1": pa.int64(), "p2": pa.int64(), "ends_sha256": pa.string()}
    sorted_blocks = listed.repartition(*node).sortWithinPartitions(*node, "block").select(*node, "ids")
    return sorted_blocks.mapInArrow(stream, "depth long, p1 long, p2 long, ends_sha256 string")


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


TOTALS = ["n_children", "n_leaves", "below"]
_SENT = {"conv_id": pa.int64(), "n_convs": pa.int64(), **{name: pa.int64() for name in TOTALS}}


def _time_forward(queue: int):
    """Takes runs in reverse level order and gives each its totals; a parent in the same shard finds them in the queue."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(queue)
        for batch in batches:
            done = []
            for top, conv, n, own, children, leaves, below, *parent, inside in zip(*(c.to_pylist() for c in batch.columns)):
                place = (-top, conv, n)
                while (message := waiting.first()) is not None and message[:3] == place:
                    children, leaves, below = children + 1, leaves + message[3], below + message[4]
                    waiting.pop()
                leaves = leaves or 1  # a run without children ends in a leaf
                done.append((conv, n, children, leaves, below))
                if inside:
                    waiting.push((-parent[0], parent[1], parent[2], leaves, below + own))
            yield _batch(done, _SENT)

    return process


def subtree_totals(runs: DataFrame, members: DataFrame, shard: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """``conv_id, n_convs`` of each run with its children, leaves and what is saved below it, written.

    ``runs(conv_id, n_convs, top, own, parent_conv, parent_n, parent_top)``; ``members(conv_id, rep, n_convs)`` has a row for
    each conversation that names a run and each run (``rep, n_convs``) it is a member of. In round k a shard is the subtree of the highest
    run of at most ``shard ** k`` conversations; runs of ``shard ** (k - 1)`` or fewer were summed in earlier rounds.
    """
    largest = runs.agg(F.max("n_convs")).first()[0] or 0
    sent, found, low, high = None, [], 0, shard
    while low < largest:
        # The highest run with few enough members on the way to a run is the one with most of them.
        roots = members.where(f"n_convs <= {high}").groupBy("conv_id").agg(F.max(F.struct("n_convs", "rep")).alias("root"))
        mine = runs.where(f"n_convs > {low} AND n_convs <= {high}").join(roots, "conv_id")
        inside = F.coalesce(F.col("parent_n") <= high, F.lit(False)).alias("inside")
        if sent is None:
            given = [F.lit(0).cast("long").alias(name) for name in TOTALS]
        else:
            mine = mine.join(sent, ["conv_id", "n_convs"], "left")
            given = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in TOTALS]
        ordered = mine.select("root", "top", "conv_id", "n_convs", "own", *given, "parent_top", "parent_conv", "parent_n", inside)
        ordered = ordered.repartition("root").sortWithinPartitions(F.col("top").desc(), "conv_id", "n_convs").drop("root")
        done = store(ordered.mapInArrow(_time_forward(queue), "conv_id long, n_convs long, n_children long, n_leaves long, below long"), "totals")
        found.append(done)
        # Shard roots: their parents are in later rounds.
        up = runs.where(f"n_convs > {low} AND n_convs <= {high} AND parent_n > {high}").join(done, ["conv_id", "n_convs"])
        passed = up.groupBy(F.col("parent_conv").alias("conv_id"), F.col("parent_n").alias("n_convs")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum(F.col("below") + F.col("own")).alias("below")
        )
        both = passed if sent is None else passed.union(sent.where(f"n_convs > {high}"))
        sent = store(both.groupBy("conv_id", "n_convs").agg(*[F.sum(name).alias(name) for name in TOTALS]), "sent")
        low, high = high, high * shard
    totals = found[0] if found else runs.selectExpr("conv_id", "n_convs", *[f"0L AS {name}" for name in TOTALS])
    for more in found[1:]:
        totals = totals.union(more)
    return totals


def _suffix_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``saved``: ``own`` summed from the node to the end of its run, in chunks of depths."""
    run, chunk = ["conv_id", "n_convs"], F.expr(f"depth div {CHUNK}").alias("chunk")
    cut = nodes.withColumn("chunk", chunk)
    later = Window.partitionBy(*run).orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    chunks = cut.groupBy(*run, "chunk").agg(F.sum("own").alias("own")).select(*run, "chunk", F.sum("own").over(later).alias("later"))
    inside = Window.partitionBy(*run, "chunk").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumn("inside", F.sum("own").over(inside)).join(chunks.where("later > 0"), [*run, "chunk"], "left")
    return summed.withColumn("saved", F.col("inside") + F.coalesce("later", F.lit(0).cast("long"))).drop("chunk", "inside", "later")


def build(conversations: DataFrame, shared_of: int = 100, shared_turns: int = 5, shard: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """One row per node of the trie of ``conversations(conv_id, turn, role, text)``.

    Turns go by ``turn``, nulls first; turns that tie go by a hash of role and text, and those that repeat all of it are turns
    like others. Null roles and texts are empty. Conversation c opens with the first h turns of conversation
    ``c - c % shared_of`` (h: CRC-32 of its id modulo ``shared_turns + 1``) and goes on with its own after its first h. Rows
    without a conv_id belong to no conversation. Texts of any length are read whole, and only their hashes and lengths are
    moved. An empty table has no conversation and no node, not even a root.
    Columns, all long but the last: ``conv_id`` (the smallest member) and ``depth``, which name a node, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    turns, sizes = rebuilt(conversations, shared_of, shared_turns)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = sizes.select("conv_id", "n_turns", *[zero.alias(c) for c in ("depth", "chars", "p1", "p2")], none.alias("b1"), none.alias("b2"))
    rows = store(prefixes(turns).unionByName(roots), "prefixes")
    node = ["depth", "p1", "p2"]
    nodes = store(
        rows.groupBy(*node).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("b1").alias("b1"), F.max("b2").alias("b2")
        ),
        "nodes",
    )
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), F.col("conv_id").alias("parent_conv"), F.col("n_convs").alias("parent_n"))
    linked = nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("chars")).join(above, ["depth", "b1", "b2"], "left")
    linked = store(linked.select(*node, "conv_id", "n_convs", "own", "parent_conv", "parent_n"), "linked")

    runs = linked.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"),
        F.max("depth").alias("bottom"),
        F.sum("own").alias("own"),
        F.min_by(F.struct("parent_conv", "parent_n"), "depth").alias("parent"),
    )
    runs = store(runs.select("conv_id", "n_convs", "top", "bottom", "own", "parent.*"), "runs")
    tops = runs.select(F.col("conv_id").alias("parent_conv"), F.col("n_convs").alias("parent_n"), F.col("top").alias("parent_top"))
    tree = store(runs.join(tops, ["parent_conv", "parent_n"], "left"), "tree")
    naming = rows.join(runs.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", *node)
    first = linked.where("parent_n IS NULL OR parent_n <> n_convs").select(*node, F.col("conv_id").alias("rep"), "n_convs")
    members = store(naming.join(first, node).select("conv_id", "rep", "n_convs"), "members")
    totals = subtree_totals(tree, members, shard, queue)

    ended = list_hashes(rows.where("depth = n_turns").select("conv_id", *node))
    summed = _suffix_sums(linked).join(totals.join(runs.select("conv_id", "n_convs", "bottom"), ["conv_id", "n_convs"]), ["conv_id", "n_convs"])
    return summed.join(ended, node, "left").select(
        "conv_id",
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("depth") < F.col("bottom"), F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves",
        (F.col("below") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
