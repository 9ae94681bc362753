"""Operator 9: shards of near-equal bytes as the leaves of a k-d tree over metadata.

Every node is split at a weighted median along the metadata dimension in which its documents
spread widest: length, language, source or id, each scaled to its range over all documents.
A node for m shards gives m // 2 of them to its left side, together with that share of its bytes.
Where many documents share a value (a language, a hot source), a hash of id and text orders
them, so a cut goes through the middle of equal values too.

The medians of a level are found together, by histograms: each pass counts the bytes of 4,096 bins,
and the bin with the median is divided again until it holds next to nothing. What the
driver sees is bounded by nodes x bins; the documents are read as narrow rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import id_key, text_key, whole
from siftloom.session import materialize

BINS, VALUE_BITS = 4096, 20
DIMENSIONS = ("length", "language", "source", "id")


@dataclass
class Node:
    """Shards ``first`` to ``first + shards - 1``; a leaf has one."""

    first: int
    shards: int
    dimension: int = 0
    cut: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None


def _hashed(column) -> Column:
    """A place in 0..1 for a value; null has place 0."""
    return F.when(F.col(column).isNull(), F.lit(0.0)).otherwise(
        F.shiftrightunsigned(F.xxhash64(column), 11).cast("double") * F.lit(2.0 ** -53))


def narrow_rows(docs: DataFrame, doc_id: str, text: str, lang: str, source: str) -> DataFrame:
    """(doc_id, size, text_crc32, one value per dimension, tie) of each row.

    The tie is a hash of id and text; of rows that are equal in both, the later ones also hash
    their number, so that a cut can go through them.
    """
    size = F.octet_length(whole(text)).cast("bigint") + 8
    again = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), size.alias("size"),
        F.crc32(whole(text).cast("binary")).alias("text_crc32"),
        F.log2(size).alias("_v0"), _hashed(lang).alias("_v1"), _hashed(source).alias("_v2"),
        id_key(doc_id).cast("double").alias("_v3"),
        F.xxhash64(id_key(doc_id), text_key(text)).alias("_key")).withColumn("_again", again)
    tie = F.when(F.col("_again") == 1, F.col("_key")).otherwise(F.xxhash64("_key", "_again"))
    return rows.select(*[c for c in rows.columns if c not in ("_key", "_again")], (
        F.shiftrightunsigned(tie, 11).cast("double") * F.lit(2.0 ** -53)).alias("_tie"))


def placed_rows(rows: DataFrame) -> DataFrame:
    """Narrow rows with their place in 0..1 along every dimension as ``_p0``, ``_p1``, ...

    Values are scaled by their range over all documents, and equal ones spread by their hash.
    """
    ends = rows.agg(*[f(f"_v{i}").alias(f"{n}{i}") for i in range(len(DIMENSIONS))
                      for n, f in (("low", F.min), ("high", F.max))]).first().asDict()
    steps = float(1 << VALUE_BITS)

    def place(i):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        if low is None or high <= low:
            return F.col("_tie") / steps
        scaled = (F.col(f"_v{i}") - low) / (high - low)
        return (F.floor(scaled * (steps - 1)).cast("double") + F.col("_tie")) / steps
    return rows.select("doc_id", "size", "text_crc32", "_tie",
                       *[place(i).alias(f"_p{i}") for i in range(len(DIMENSIONS))])


def _routed(node: Node) -> Column:
    """The first shard of the leaf a row falls into."""
    if node.left is None:
        return F.lit(node.first)
    return F.when(F.col(f"_p{node.dimension}") < node.cut, _routed(node.left)).otherwise(
        _routed(node.right))


def _widest(rows: DataFrame, root: Node, nodes: list[Node]) -> None:
    spread = rows.withColumn("node", _routed(root)).groupBy("node").agg(*[
        (F.max(f"_p{i}") - F.min(f"_p{i}")).alias(f"w{i}") for i in range(len(DIMENSIONS))])
    found = {r.node: r for r in spread.collect()}
    for node in nodes:
        if node.first in found:
            row = found[node.first]
            node.dimension = max(range(len(DIMENSIONS)), key=lambda i: (row[f"w{i}"], -i))


def _medians(rows: DataFrame, root: Node, nodes: list[Node], tolerance: float) -> None:
    """Set ``cut`` of all nodes of a level, refining one bin of each until it is light."""
    open_bins = {n.first: (0.0, 1.0, 0) for n in nodes}  # low, width, bytes below
    totals: dict[int, int] = {}
    by_first = {n.first: n for n in nodes}
    while open_bins:
        def of_node(value):
            """A number for each node that is open, looked up by the row's node."""
            numbers = [value(k) if k in open_bins else None for k in range(root.shards)]
            return F.get(F.array(*[F.lit(x).cast("double") for x in numbers]), F.col("node"))
        place = F.get(F.array(*[F.col(f"_p{i}") for i in range(len(DIMENSIONS))]),
                      of_node(lambda k: by_first[k].dimension).cast("int"))
        number = F.floor((place - of_node(lambda k: open_bins[k][0]))
                         / of_node(lambda k: open_bins[k][1]) * BINS)
        counted = (rows.withColumn("node", _routed(root))
                   .select("node", number.alias("bin"), "size")
                   .where(F.col("bin").between(0, BINS - 1))
                   .groupBy("node", "bin").agg(F.sum("size").alias("bytes"),
                                               F.count("*").alias("n")).collect())
        for key, (start, span, below) in list(open_bins.items()):
            own = sorted((r.bin, r.bytes, r.n) for r in counted if r.node == key)
            node = by_first[key]
            totals.setdefault(key, sum(b for _, b, _ in own))
            goal = totals[key] * (node.shards // 2) / node.shards
            done = below
            node.cut = start + span
            for bin_no, held, n in own:
                if done + held > goal:
                    node.cut = start + span * bin_no / BINS
                    if n > 1 and held > tolerance * totals[key] and span > 2.0 ** -50:
                        open_bins[key] = (node.cut, span / BINS, done)
                    else:
                        if goal - done > done + held - goal:
                            node.cut = start + span * (bin_no + 1) / BINS
                        del open_bins[key]
                    break
                done += held
            else:
                del open_bins[key]


def tree(rows: DataFrame, shards: int, tolerance: float = 0.0002) -> Node:
    """The k-d tree of placed rows."""
    root = Node(0, shards)
    if rows.isEmpty():
        return root
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        _widest(rows, root, level)
        _medians(rows, root, level, tolerance)
        for node in level:
            half = node.shards // 2
            node.left = Node(node.first, half)
            node.right = Node(node.first + half, node.shards - half)
        level = [side for n in level for side in (n.left, n.right)]
    return root


def shard(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", source: str = "source", buckets: int = 256) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    A null text has no bytes and the checksum of the empty text; null metadata is a place of its
    own; repeated rows get a slot each, and cuts go through them. A very long text is one row, however
    many bytes its shard then holds. Slots count from 0 in the order of the rows' hashes:
    ranges of the hash are numbered on their own and moved up by the rows before them, so
    no task orders a whole shard. An empty table gives no rows.
    """
    rows = materialize(narrow_rows(docs, doc_id, text, lang, source), "narrow")
    rows = materialize(placed_rows(rows), "placed")
    placed = rows.select(
        "doc_id", "size", "text_crc32", _routed(tree(rows, shards)).alias("shard"),
        "_tie", F.least(F.floor(F.col("_tie") * buckets), F.lit(buckets - 1)).alias("_bucket"))
    counts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("shard", "_bucket")
                                .orderBy("_tie", "doc_id", "text_crc32"))
    # shards x buckets short rows
    return (placed.withColumn("_rank", inner).join(F.broadcast(before), ["shard", "_bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_before") + F.col("_rank") - 1).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
