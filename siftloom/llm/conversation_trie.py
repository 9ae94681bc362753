"""Operator 13: the prefix trie of conversations, its totals by time-forward processing.

A node is a distinct sequence of first turns, known by the chained digest of its turns. A
conversation is read once in order of its turns, from sorted rows and with one digest as state,
so its length does not matter; texts are digested before anything is shuffled.

Totals of subtrees flow upwards. Nodes are sorted by reverse level order, and each sends
its totals forward in time, through a queue ordered like the nodes, to its parent, which finds
them at the head of the queue when its turn comes. The queue spills sorted runs beyond a bound.
A shard is the subtree below a shard root, the first node of a path with at most ``shard``
members; shards are independent. The nodes above them have more members each, so there are at
most ``all turns / shard`` of them, and ``shard`` grows so that this stays within ``most_above``;
they take the totals of the shard roots in one last pass of the same kind.
"""

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import NO_ID, id_key, whole
from siftloom.session import materialize

ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
PATHS = "_c bigint, _depth bigint, _key binary, _parent binary, _chars bigint, _last boolean"
TOTALS = ("_key binary, _parent binary, _conv bigint, _depth bigint, _convs bigint, _top boolean, "
          "_children bigint, _leaves bigint, _saved bigint")


@dataclass(frozen=True)
class Trie:
    """``shard``: members of a shard root; ``most_above``: bound on the nodes above the shards;
    ``queued``: messages of a queue in memory."""

    shard: int = 1000
    most_above: int = 100_000
    queued: int = 200_000


class MessageQueue:
    """A priority queue of (level, key, leaves, saved) that spills sorted runs.

    Runs are anonymous files of the task's own scratch space, like the spill files of a sort; a
    task that is run again starts without them.
    """

    ROW = ">q16sqq"

    def __init__(self, limit: int):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def _read(self, file):
        file.seek(0)
        while block := file.read(struct.calcsize(self.ROW) * 4096):
            yield from struct.iter_unpack(self.ROW, block)

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        self.heap.sort()
        for first in range(0, len(self.heap), 4096):
            file.write(b"".join(struct.pack(self.ROW, *m) for m in self.heap[first:first + 4096]))
        self.heap = []
        self.runs.append(self._read(file))
        heapq.heappush(self.heads, (next(self.runs[-1]), len(self.runs) - 1))

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def head(self):
        """The least message, or None."""
        if self.heads and not (self.heap and self.heap[0] <= self.heads[0][0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and not (self.heap and self.heap[0] <= self.heads[0][0]):
            message, run = self.heads[0]
            after = next(self.runs[run], None)
            if after is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (after, run))
            return message
        return heapq.heappop(self.heap)


def _forward(limit: int):
    """Subtree totals of nodes that come in reverse level order, (depth descending, key)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = MessageQueue(limit)
        for batch in batches:
            children, leaves, saved = (batch.column(c).to_pylist()
                                       for c in ("_children", "_leaves", "_saved"))
            sent = zip(*[batch.column(c).to_pylist() for c in ("_key", "_parent", "_depth", "_up")])
            for i, (key, parent, depth, up) in enumerate(sent):
                while (head := queue.head()) is not None and head[1] == key and head[0] == -depth:
                    message = queue.pop()
                    children[i] += 1
                    leaves[i] += message[2]
                    saved[i] += message[3]
                if not children[i]:
                    leaves[i] = 1
                if up:
                    queue.push((1 - depth, parent, leaves[i], saved[i]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("_key", "_parent", "_conv", "_depth", "_convs", "_top")],
                 pa.array(children, pa.int64()), pa.array(leaves, pa.int64()),
                 pa.array(saved, pa.int64())],
                names=["_key", "_parent", "_conv", "_depth", "_convs", "_top", "_children",
                       "_leaves", "_saved"])
    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key and parent of every prefix, from the turns in order; each conversation's first row stands
    for the root. A row is given out when the next one shows whether it is the last."""
    names = [f.split()[0] for f in PATHS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]

    def table(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names)
    held = None
    for batch in batches:
        rows = []
        for conv, turn, chars in zip(*[batch.column(c).to_pylist()
                                       for c in ("_c", "_turn", "_chars")]):
            if held is not None:
                rows.append((*held, held[0] != conv))
            if held is None or held[0] != conv:
                held = (conv, 0, ROOT, None, 0)
            else:
                key = hashlib.blake2b(held[2] + turn, digest_size=16).digest()
                held = (conv, held[1] + 1, key, held[2], chars)
        if rows:
            yield table(rows)
    if held is not None:
        yield table([(*held, True)])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids that end at a node, from rows in order of (key, id)."""
    def table(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])],
            names=["_key", "_ends"])
    key, digest = None, None
    for batch in batches:
        rows = []
        for own, conv in zip(batch.column("_key").to_pylist(), batch.column("_c").to_pylist()):
            name = b"" if conv == NO_ID else str(conv).encode()
            if own == key:
                digest.update(b"," + name)
                continue
            if key is not None:
                rows.append((key, digest.hexdigest()))
            key, digest = own, hashlib.sha256(name)
        if rows:
            yield table(rows)
    if key is not None:
        yield table([(key, digest.hexdigest())])


def turns_of(conversations: DataFrame) -> DataFrame:
    """(_c, _p, _turn, _chars): the turns of each conversation by place, as digests.

    Null turns come first; equal turn numbers come in the order of the md5 of their role's
    length, role and text. A row without conv_id belongs to the one conversation without id.
    """
    turn = F.md5(F.concat(F.length(whole("role")).cast("string"), F.lit(":"), whole("role"),
                          whole("text")).cast("binary"))
    rows = conversations.select(
        id_key("conv_id").alias("_c"), F.col("turn").alias("_t"), F.unhex(turn).alias("_turn"),
        F.length(whole("text")).cast("bigint").alias("_chars"))
    place = F.row_number().over(Window.partitionBy("_c").orderBy(F.asc_nulls_first("_t"), "_turn"))
    return rows.select("_c", (place - 1).cast("bigint").alias("_p"), "_turn", "_chars")


def rebuilt(conversations: DataFrame, hundred: int = 100, most: int = 6) -> DataFrame:
    """(_c, _p, _turn, _chars) of every conversation with borrowed first turns.

    Conversation c starts with the first h turns of conversation c - c % ``hundred``, all if it
    has fewer, none if it is absent, and goes on with its own turns after its first h; h is the
    unsigned crc32 of the decimal c modulo ``most``. The conversation without id borrows
    nothing and keeps its turns. Every conversation also has a row at place -1.
    """
    given = materialize(turns_of(conversations), "turns")
    borrowed = F.when(F.col("_c") == NO_ID, 0).otherwise(
        F.crc32(F.col("_c").cast("string").cast("binary")) % most)
    first = given.where((F.col("_p") < most) & (F.col("_c") % hundred == 0)).where(
        F.col("_c") != NO_ID).select(F.col("_c").alias("_b"), "_p", "_turn", "_chars")
    lengths = first.groupBy("_b").agg(F.count("*").alias("_length"))
    convs = (given.select("_c").distinct()
             .withColumns({"_h": borrowed, "_b": F.col("_c") - F.col("_c") % hundred})
             .join(lengths, "_b", "left")
             .withColumn("_have", F.least("_h", F.coalesce("_length", F.lit(0)))))
    start = convs.select("_c", F.lit(-1).cast("bigint").alias("_p"),
                         F.lit(None).cast("binary").alias("_turn"),
                         F.lit(0).cast("bigint").alias("_chars"))
    lent = (convs.where("_have > 0").join(first, "_b").where("_p < _h")
            .select("_c", "_p", "_turn", "_chars"))
    own = (given.join(convs.select("_c", "_h", "_have"), "_c").where("_p >= _h")
           .select("_c", (F.col("_p") - F.col("_h") + F.col("_have")).alias("_p"), "_turn", "_chars"))
    return start.unionByName(lent).unionByName(own)


def prefix_trie(turns: DataFrame, trie: Trie = Trie()) -> DataFrame:
    """One row per node of the trie of ``turns`` (_c, _p, _turn, _chars), all of it long:

    ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` that of the parent (root: null),
    ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes of the subtree,
    ``saved_tokens`` of the subtree, where a node saves (n_convs - 1) times the code points of
    its last text, and ``ends_sha256`` of the ids that end here; also ``node`` and ``parent``,
    the hex names of the prefixes. Members are conversations; the one without id is the smallest,
    shows as null and is empty in ``ends_sha256``. Each conversation needs a row at place -1.
    Very long conversations and texts are streamed. An empty table has no nodes.
    """
    paths = materialize(
        turns.repartition("_c").sortWithinPartitions("_c", "_p").mapInArrow(_chained, PATHS), "paths")
    nodes = materialize(paths.groupBy("_key").agg(
        F.min("_c").alias("_conv"), F.count("*").alias("_convs"), F.min("_depth").alias("_depth"),
        F.min("_parent").alias("_parent"), F.max("_chars").alias("_chars")), "nodes")
    shard = max(trie.shard, paths.count() // trie.most_above)
    nodes = nodes.select("_key", "_parent", "_conv", "_depth", "_convs",
                         (F.col("_convs") > shard).alias("_above"),
                         ((F.col("_convs") - 1) * F.col("_chars")).alias("_own"))
    # at most ``most_above`` rows, see above
    above = F.broadcast(nodes.where("_above").select("_key", F.col("_conv").alias("_parent_conv")))

    # the nodes above are a beginning of every path; the next one is the path's shard root
    below = paths.join(above.select("_key"), "_key", "left_anti").groupBy("_c").agg(
        F.min_by("_key", "_depth").alias("_shard"))
    inner = (nodes.where("NOT _above").join(below, F.col("_conv") == F.col("_c"))
             .withColumn("_top", F.col("_key") == F.col("_shard")))
    none = F.lit(0).cast("bigint")
    inner = inner.withColumns({"_children": none, "_leaves": none, "_saved": F.col("_own"),
                               "_up": ~F.col("_top")})
    columns = ["_key", "_parent", "_conv", "_depth", "_convs", "_top", "_up", "_children", "_leaves",
               "_saved"]
    order = (F.desc("_depth"), F.asc("_key"))
    inner = materialize(
        inner.repartition("_shard").select(*columns).sortWithinPartitions(*order)
        .mapInArrow(_forward(trie.queued), TOTALS), "shards")
    arrived = inner.where("_top AND _depth > 0").groupBy(F.col("_parent").alias("_key")).agg(
        F.count("*").alias("_children"), F.sum("_leaves").alias("_leaves"),
        F.sum("_saved").alias("_from"))
    upper = nodes.where("_above").join(arrived, "_key", "left").withColumns({
        "_top": F.lit(True), "_up": F.col("_depth") > 0, "_children": F.coalesce("_children", none),
        "_leaves": F.coalesce("_leaves", none), "_saved": F.col("_own") + F.coalesce("_from", none)})
    upper = (upper.select(*columns).repartition(1).sortWithinPartitions(*order)
             .mapInArrow(_forward(trie.queued), TOTALS))

    whole_trie = materialize(inner.unionByName(upper), "totals")
    # below a shard root a parent has at most ``shard`` children
    parents = nodes.where("NOT _above").select(F.col("_key").alias("_parent"),
                                               F.col("_conv").alias("_parent_conv"))
    led = whole_trie.where("_top AND _depth > 0").join(
        above.withColumnRenamed("_key", "_parent"), "_parent").unionByName(
        whole_trie.where("NOT _top").join(parents, "_parent")).unionByName(
        whole_trie.where("_depth = 0").withColumn("_parent_conv", F.lit(None).cast("bigint")))
    ends = (paths.where("_last").select("_key", "_c").repartition("_key")
            .sortWithinPartitions("_key", "_c").mapInArrow(_ends, "_key binary, _ends string"))
    done = led.join(ends, "_key", "left")
    return done.select(
        F.nullif("_conv", F.lit(NO_ID)).alias("conv_id"), F.col("_depth").alias("depth"),
        F.nullif("_parent_conv", F.lit(NO_ID)).alias("parent_conv_id"),
        F.col("_convs").alias("n_convs"), F.col("_children").alias("n_children"),
        F.col("_leaves").alias("n_leaves"), F.col("_saved").alias("saved_tokens"),
        F.coalesce("_ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        F.lower(F.hex("_key")).alias("node"), F.lower(F.hex("_parent")).alias("parent"))


def conversation_trie(conversations: DataFrame, trie: Trie = Trie()) -> DataFrame:
    """The trie of the rebuilt conversations, see ``rebuilt`` and ``prefix_trie``."""
    return prefix_trie(rebuilt(conversations), trie)
