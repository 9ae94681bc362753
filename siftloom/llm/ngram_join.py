"""Operator 11: the Jaccard join of word shingles by PartEnum signatures.

Sets are dealt to bands of sizes so that a set's partners lie in its own band and those next to it;
every set takes part in the instance of its own band and in that of the band above, where sets of one
band and of two neighbours meet. Within an instance such similar sets differ in at most ``k``
features. The feature domain is dealt to n1 parts, each again to n2; of n1 parts some differ in at
most k2 features, and there some n2 - k2 of the smaller parts agree in full. So a signature is the
set's content in n2 - k2 small parts of one part, and similar sets share one.

Two kinds of signatures say nothing: empty ones, and hot ones, which so many sets of
different components have that comparing all would be quadratic. ``slack`` more parts than
needed make up for them: similar sets then have slack + 1 agreeing parts, so if one of the
two has at most ``slack`` parts with such signatures, they meet in another. Being empty
or hot is a matter of the signature, hence the same for both. Sets with more such parts
go on to a next level with larger parts, the last of which leaves nothing out.

Signatures meet in buckets, to which a slice of documents sends them packed: six bytes each and a
node for all that a document has in the bucket. As similar sets agree in slack + 1 parts, a set
that shares fewer signatures in an instance, less its empty ones, has no partner there and is left
out before a text is moved.

Groups of up to ``block`` sets with a common signature are compared exactly in full. They meet in
shards by their smallest member, where a set is made once and a pair compared once, however
many groups hold it. Larger groups are compared with a leader, dealt to as many shards as they need, on
the first level also with a second one; those that are one component by then need no more, whatever
their size, the others are the hot ones above. For this a node's component meets the node once,
and its signatures go on packed. On the last level their sets are compared with those
that have a rare shingle in common (prefix filtering), which finds every similar one.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.minhash_near_dedup import shingles
from siftloom.llm.rows import id_key, lowered, mixed, slices, whole
from siftloom.operators.dedup import components
from siftloom.session import materialize

PACKED = "_bucket bigint, _sigs binary, _nodes binary, _counts binary, _known binary"
GROUPS = ("_sig bigint, _lead bigint, _n bigint, _node bigint, _shingles bigint, _free_even bigint, "
          "_free_odd bigint")
WAITING = "_node bigint, _root bigint, _next bigint, _even bigint, _odd bigint"
# signatures of a bucket in which large groups are judged, and about as many of the rows dealt at once
ENTRIES = 1 << 18
# bits of a signature that travel; those above them name the bucket
LOW = 48
BITMAP = 32768
TOP = np.uint64(1 << 63)
SALT, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class PartEnum:
    """Sets link at ``percent`` Jaccard; groups above ``block`` members are not compared in full,
    but on the last of ``levels`` by rare shingles. ``leaders`` is the number of leaders on the first level,
    ``shard`` about the number of sets in a shard."""

    percent: int = 80
    width: int = 5
    block: int = 64
    shard: int = 400
    leaders: int = 2
    levels: int = 3

    def edges(self, largest: int) -> list[int]:
        """Smallest size of each band, up to one band beyond that of ``largest``."""
        out = [1]
        while len(out) < 3 or out[-2] <= largest:
            out.append(out[-1] * 100 // self.percent + 1)
        return out

    def distance(self, one: int, other: int) -> int:
        """Features in which two similar sets of at most these sizes can differ."""
        return (one + other) * (100 - self.percent) // (100 + self.percent)

    def scheme(self, k: int, level: int) -> tuple[int, int, int, int]:
        """(n1, n2, k2, slack) for sets that differ in at most ``k`` features."""
        if k == 0:
            return 1, 1, 0, 0
        if level == 0:
            k2 = 1 if k <= 24 else 0
            n2 = 4 if k2 else 1
        else:
            k2 = min(k, 3)
            n2 = 6 if k2 > 1 else 4
        needed = k // (k2 + 1) + 1
        slack = 0 if level + 1 == self.levels else 1 + needed // 8 if k2 else 2 + needed // 10
        return needed + slack, n2, k2, slack


def signatures(document: np.ndarray, element: np.ndarray, n: int, join: PartEnum, level: int):
    """(document, signature) of all sets, and how many more spoiled parts each set can bear in
    its even and its odd instance.

    Signatures have 63 bits, of which the lowest tells the instance's parity.
    """
    sizes = np.bincount(document, minlength=n)
    edges = join.edges(int(sizes.max(initial=1)))
    band = np.searchsorted(edges, sizes, side="right") - 1
    # sets of one band meet in the instance of the band above, too
    plans = np.array([join.scheme(join.distance(edges[i] - 1, edges[i + 1] - 1), level)
                      for i in range(len(edges) - 1)] + [(0, 0, 0, 0)])
    free = np.zeros((n, 2), dtype=np.int64)
    last = level + 1 == join.levels
    owners, found = [], []
    for step in (0, 1):
        instance = band + step
        plan = plans[np.minimum(instance, len(plans) - 1)]
        for n2, k2 in {(int(p[1]), int(p[2])) for p in plan[sizes > 0]}:
            member = (sizes > 0) & (plan[:, 1] == n2) & (plan[:, 2] == k2)
            docs = np.flatnonzero(member)
            place = np.zeros(n, dtype=np.int64)
            place[docs] = np.arange(len(docs))
            n1, slack = plan[docs, 0], plan[docs, 3]
            begin = np.cumsum(n1) - n1
            salt = mixed(instance[docs].astype(np.uint64) * SALT + np.uint64((level + 1) * int(TURN) & 0xFFFFFFFFFFFFFFFF))
            own = member[document]
            of = place[document[own]]
            hashed = mixed(element[own] ^ salt[of])
            part = (hashed % n1.astype(np.uint64)[of]).astype(np.int64)
            slot = (begin[of] + part) * n2 + ((hashed >> np.uint64(40)) % np.uint64(n2)).astype(np.int64)
            parts = int(n1.sum())
            content = np.zeros(parts * n2, dtype=np.uint64)
            np.add.at(content, slot, mixed(hashed + TURN))
            content = content.reshape(parts, n2)
            held = (np.bincount(slot, minlength=parts * n2) > 0).reshape(parts, n2)
            whose = np.repeat(np.arange(len(docs)), n1)
            number = np.arange(parts) - begin[whose]
            spoiled = np.zeros(parts, dtype=bool)
            for nth, chosen in enumerate(combinations(range(n2), n2 - k2)):
                filled = held[:, chosen].any(axis=1)
                spoiled |= ~filled
                name = mixed(salt[whose] + (number * 64 + nth).astype(np.uint64) * SALT)
                signature = mixed(content[:, chosen].sum(axis=1, dtype=np.uint64) + name)
                shown = np.ones(parts, dtype=bool) if last else filled
                owner = docs[whose[shown]]
                owners.append(owner)
                parity = (instance[owner] & 1).astype(np.uint64)
                found.append((signature[shown] & ~TOP & ~np.uint64(1)) | parity)
            free[docs, instance[docs] & 1] = slack - np.bincount(
                whose, weights=spoiled, minlength=len(docs)).astype(np.int64)
    if last:
        free[:] = 0
    if not owners:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), free
    return np.concatenate(owners), np.concatenate(found), free


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The rows of ``data`` between each two bounds, as bytes."""
    data = np.ascontiguousarray(data)
    width = data.nbytes // max(1, len(data))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * width).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _signed(join: PartEnum, level: int, buckets: int):
    """For each bucket the signatures of a slice, node by node, and of the nodes dealt to it the node,
    its set's size, and what it can bear."""
    def dealt(names: np.ndarray) -> np.ndarray:
        return ((names >> np.uint64(LOW)) * np.uint64(buckets) >> np.uint64(63 - LOW)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(buckets + 1)
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                document, element = shingles(lowered(data), offsets, join.width)
                nodes, first = np.unique(piece.column("_node").to_numpy(), return_index=True)
                # copies in a slice are one
                once = np.zeros(piece.num_rows, dtype=bool)
                once[first] = True
                kept = once[document]
                document, element = document[kept], element[kept]
                owner, sig, free = signatures(document, element, piece.num_rows, join, level)
                key = dealt(sig) * piece.num_rows + owner
                order = np.argsort(key)
                key, sig = key[order], sig[order]
                begins = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
                counts = np.diff(np.append(begins, len(key))).astype(np.uint32)
                rows = piece.column("_node").to_numpy()[key[begins] % piece.num_rows]
                sizes = np.bincount(document, minlength=piece.num_rows)
                known = np.column_stack([nodes, sizes[first], free[first]])
                home = dealt(nodes.view(np.uint64) & ~TOP)
                place = np.argsort(home, kind="stable")
                own = np.searchsorted(key[begins], every * piece.num_rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(every[:-1]),
                    _binary(sig.view(np.uint8).reshape(-1, 8)[:, :LOW // 8],
                            np.searchsorted(key, every * piece.num_rows)),
                    _binary(rows, own), _binary(counts, own),
                    _binary(known[place], np.searchsorted(home[place], every)),
                ], names=["_bucket", "_sigs", "_nodes", "_counts", "_known"])
    return run


def _met(key: tuple, rows: pa.Table) -> pa.Table:
    """The signatures of a bucket that two nodes have, for each of these a row with the smallest of them and
    their number; and a row without signature for each node dealt to the bucket."""
    def joined(name, kind):
        return np.frombuffer(b"".join(rows.column(name).to_pylist()), dtype=kind)
    low = joined("_sigs", np.uint8).reshape(-1, LOW // 8)
    sig = np.pad(low, ((0, 0), (0, 8 - LOW // 8))).reshape(-1).view(np.int64)
    node = np.repeat(joined("_nodes", np.int64), joined("_counts", np.uint32))
    order = np.argsort(sig)
    sig = sig[order]
    same = sig[1:] == sig[:-1]
    common = np.append(same, False) | np.append(False, same) if len(sig) else same
    sig, node = sig[common], node[order[common]]
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), dtype=bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    begins = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else sig
    counts = np.diff(np.append(begins, len(sig)))
    held = np.repeat(counts, counts)
    lead = np.repeat(node[begins], counts)
    shared = held > 1
    known = joined("_known", np.int64).reshape(-1, 4)
    known = known[np.unique(known[:, 0], return_index=True)[1]]
    sig = sig[shared] | np.int64(key[0].as_py() << LOW)
    names = ["_sig", "_lead", "_n", "_node", "_shingles", "_free_even", "_free_odd"]
    members = pa.table([pa.array(x) for x in (sig, lead[shared], held[shared], node[shared])]
                       + [pa.nulls(len(sig), pa.int64())] * 3, names=names)
    alone = pa.table([pa.nulls(len(known), pa.int64())] * 3 + [pa.array(x) for x in known.T.copy()], names=names)
    return pa.concat_tables([members, alone])


def _sets(texts: pa.Array, join: PartEnum) -> list[np.ndarray]:
    out = []
    batch = pa.RecordBatch.from_arrays([texts], names=["_text"])
    for piece, data, offsets in slices(batch, "_text"):
        document, element = shingles(lowered(data), offsets, join.width)
        edges = np.searchsorted(document, np.arange(piece.num_rows + 1))
        out += [element[a:b] for a, b in zip(edges[:-1], edges[1:])]
    return out


def _group_links(join: PartEnum):
    """Links within the groups (_sig, _node, _root, _asks, _lead) of a shard, given the texts of its nodes.

    Nodes with one root are linked already; a link that joins nothing is left out. Two sets are
    compared if the smaller one asks, of equal ones either. A node with a leader meets only that.
    """
    def run(rows: pa.Table, texts: pa.Table) -> pa.Table:
        known = texts.column("_known").to_numpy()
        place = np.argsort(known)
        known = known[place]
        sets = _sets(texts.column("_text").combine_chunks(), join)
        sets = [sets[i] for i in place]
        at = np.searchsorted(known, rows.column("_node").to_numpy())
        parent = list(range(len(known)))

        def top(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x
        first_of: dict = {}
        for i, root in zip(at.tolist(), rows.column("_root").to_pylist()):
            parent[top(i)] = top(first_of.setdefault(root, i))
        whole = pc.is_null(rows.column("_lead")).to_numpy()
        led, leaders = at[~whole], rows.column("_lead").drop_null().to_numpy()
        leaders = np.searchsorted(known, leaders)
        rows, at = rows.filter(pa.array(whole)), at[whole]
        sig, asks = rows.column("_sig").to_numpy(), rows.column("_asks").to_numpy()
        order = np.lexsort((at, sig))
        sig, at, asks = sig[order], at[order], asks[order]
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (at[1:] != at[:-1])
        sig, at, asks = sig[new], at[new], asks[new]
        begins = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else sig
        ends = np.append(begins[1:], len(sig))
        groups = {(tuple(at[a:b].tolist()), tuple(asks[a:b].tolist())) for a, b in zip(begins, ends) if b - a > 1}
        sizes = np.array([len(x) for x in sets], dtype=np.int64)

        def candidates(group, asked):
            """Pairs of different components whose sizes allow a link and of which the smaller asks."""
            if len(group) <= 32 and all(asked):
                yield from combinations(group, 2)
                return
            members, asked = np.array(group), np.array(asked)
            size, root = sizes[members], np.array([top(i) for i in group])
            for k in range(len(group) - 1):
                others = size[k + 1:]
                asking = np.where(others < size[k], asked[k + 1:], asked[k]) | (
                    (others == size[k]) & asked[k + 1:])
                close = 100 * np.minimum(others, size[k]) >= join.percent * np.maximum(others, size[k])
                for j in np.flatnonzero(asking & close & (root[k + 1:] != root[k])):
                    yield group[k], group[k + 1 + j]
        compared, out = set(), []
        stars = ([pair] for pair in zip(led.tolist(), leaders.tolist()))
        full = (candidates(*g) for g in sorted(groups, key=lambda g: (-len(g[0]), g)))
        for pairs in chain(stars, full):
            for i, j in pairs:
                if (i, j) in compared or top(i) == top(j):
                    continue
                compared.add((i, j))
                a, b = sets[i], sets[j]
                if 100 * min(len(a), len(b)) < join.percent * max(len(a), len(b)):
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= join.percent * (len(a) + len(b) - both) > 0:
                    parent[top(i)] = top(j)
                    out.append((known[i], known[j]))
        return pa.table([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["_a", "_b"])
    return run


def _groups(docs: DataFrame, join: PartEnum, level: int) -> DataFrame:
    """Signatures that two texts have, with their nodes, the smallest and the number of these; and a row
    without signature for each node."""
    # a bucket holds the signatures of some 64 MB of texts, above the first level ten times as many are made
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = min(max(48, size >> (23 if level else 26)), 1 << 13)
    return docs.mapInArrow(_signed(join, level, buckets), PACKED).groupBy("_bucket").applyInArrow(_met, GROUPS)


def _members(groups: DataFrame, join: PartEnum) -> DataFrame:
    """(_sig, _of, _node, _lead) of nodes with as many common signatures in the instance as a partner there
    demands; ``_lead`` for groups above ``block`` of these only, ``_of`` is the smallest node of all."""
    own = Window.partitionBy("_node")
    counted = groups
    for name, parity in (("even", 0), ("odd", 1)):
        # similar sets agree in slack + 1 parts, of which a set may have empty ones
        counted = counted.withColumn(f"_{name}", F.count_if(F.expr(f"_sig & 1 = {parity}")).over(own)
                                     > F.max(f"_free_{name}").over(own))
    kept = materialize(counted.where("_sig IS NOT NULL AND CASE WHEN _sig & 1 = 0 THEN _even ELSE _odd END")
                       .select("_sig", F.col("_lead").alias("_of"), "_n", "_node"), "members")
    # a large group is counted anew, without the nodes left out
    same = Window.partitionBy("_sig")
    large = kept.where(F.col("_n") > join.block).withColumn("_lead", F.when(
        F.count("*").over(same) > join.block, F.min("_node").over(same)))
    small = kept.where(F.col("_n") <= join.block).withColumn("_lead", F.lit(None).cast("bigint"))
    return materialize(small.unionByName(large).drop("_n"), "groups")


def _perhaps(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of the distinct ``nodes`` and few others, by a bitmap of sixteen bits a node that goes to the rows."""
    bits = max(BITMAP, nodes.count() * 16)
    if bits > 1 << 29:  # 64 MB
        return docs
    place = F.pmod("_node", F.lit(bits))
    maps = nodes.select(place.alias("_p")).groupBy(F.expr(f"_p div {BITMAP}").alias("_map")).agg(
        F.bitmap_construct_agg(F.col("_p") % BITMAP).alias("_bits"))
    byte = F.expr(f"conv(hex(substring(_bits, cast(_p % {BITMAP} div 8 as int) + 1, 1)), 16, 10)").cast("int")
    return (docs.withColumn("_p", place).withColumn("_map", F.expr(f"_p div {BITMAP}"))
            .join(F.broadcast(maps), "_map").where(F.getbit(byte, F.expr("cast(_p % 8 as int)")) == 1)
            .select(*docs.columns))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """A row of each of the distinct ``nodes``."""
    # a semi-join would be pushed below the bitmaps
    return _perhaps(docs, nodes).join(nodes, "_node").select(*docs.columns).dropDuplicates(["_node"])


def _linked(rows: DataFrame, docs: DataFrame, join: PartEnum) -> DataFrame:
    """Links within the groups of (_of, _sig, _node, _root, _asks, _lead), where ``_of`` decides on the shard;
    nodes with a leader meet only that."""
    nodes = materialize(rows.select("_node").union(
        rows.where("_lead IS NOT NULL").select("_lead")).distinct(), "nodes")
    shards = nodes.count() // join.shard + 1
    dealt = rows.select(F.pmod(F.xxhash64("_of"), F.lit(shards)).alias("_shard"),
                        "_sig", "_node", "_root", "_asks", "_lead")
    held = dealt.select(F.col("_shard").alias("_at"), F.col("_node").alias("_known")).unionByName(
        dealt.where("_lead IS NOT NULL").select(F.col("_shard").alias("_at"), F.col("_lead").alias("_known")))
    # copies go and texts meet their shards after one exchange
    texts = _perhaps(docs, nodes).dropDuplicates(["_node"])
    held = held.distinct().join(texts.select(F.col("_node").alias("_known"), "_text"), "_known")
    return dealt.groupBy("_shard").cogroup(held.groupBy("_at")).applyInArrow(
        _group_links(join), "_a bigint, _b bigint")


def _led(pairs: DataFrame, join: PartEnum) -> DataFrame:
    """The distinct (_node, _root, _lead) as rows for ``_linked``, a leader in as many shards as it needs."""
    pairs = pairs.where("_node <> _lead").distinct()
    many = pairs.groupBy("_lead").agg((F.expr(f"count(*) div {join.shard}") + 1).alias("_pieces"))
    return pairs.join(many, "_lead").select(
        F.xxhash64("_lead", F.pmod(F.xxhash64("_node"), F.col("_pieces"))).alias("_of"),
        F.col("_lead").alias("_sig"), "_node", "_root", F.lit(True).alias("_asks"), "_lead")


def _packed(buckets: int):
    """For each bucket the (signature, node, root) of some of the rows (_node, _root, _sigs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(buckets + 1)
        for batch in batches:
            held = pc.sum(pc.list_value_length(batch.column("_sigs"))).as_py() or 1
            step = batch.num_rows * ENTRIES // held + 1
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                counts = pc.list_value_length(piece.column("_sigs")).to_numpy()
                sig = piece.column("_sigs").flatten().to_numpy()
                home = (mixed(sig.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                entries = np.column_stack([sig] + [
                    np.repeat(piece.column(name).to_numpy(), counts) for name in ("_node", "_root")])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every[:-1]), _binary(entries[order], np.searchsorted(home[order], every))],
                    names=["_bucket", "_entries"])
    return run


def _judged(leaders: bool):
    """Members of a bucket's groups that are not one component yet, with their components, and how many such
    signatures of either parity they have, one row for each. With ``leaders`` the groups whose highest
    component is another are told apart by ``_next``, the highest member of that, else it is the node."""
    def run(rows: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(rows.column("_entries").to_pylist()), dtype=np.int64).reshape(-1, 3)
        sig, node, root = entries[np.lexsort((entries[:, 1], entries[:, 2], entries[:, 0]))].T
        begins = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else sig
        counts = np.diff(np.append(begins, len(sig)))
        last = np.repeat(begins + counts - 1, counts)
        waits = np.repeat(root[begins], counts) < root[last]
        after = np.where(leaders & (root < root[last]), node[last], node)
        found = np.column_stack([node, root, after, sig & 1])[waits]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        new = np.ones(len(found), dtype=bool)
        new[1:] = (found[1:, [0, 2]] != found[:-1, [0, 2]]).any(axis=1)
        begins = np.flatnonzero(new)
        held = np.diff(np.append(begins, len(found)))
        odd = np.add.reduceat(found[:, 3], begins) if len(begins) else held
        columns = [*found[begins, :3].T, held - odd, odd]
        return pa.table([pa.array(np.ascontiguousarray(x)) for x in columns],
                        names=["_node", "_root", "_next", "_even", "_odd"])
    return run


def _waiting(held: DataFrame, roots: DataFrame, buckets: int, leaders: bool) -> DataFrame:
    """Members of the large groups that are not one component yet, given the nodes with their signatures in
    large groups (_node, _sigs); a node's component is looked up once."""
    rows = held.join(roots.withColumnRenamed("_node", "_of"), F.col("_node") == F.col("_of"), "left").select(
        "_node", F.coalesce("_root", "_node").alias("_root"), "_sigs")
    return rows.mapInArrow(_packed(buckets), "_bucket bigint, _entries binary").groupBy("_bucket").applyInArrow(
        _judged(leaders), WAITING)


def _elements(join: PartEnum):
    """(node, element, size of the set) of every shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                document, element = shingles(lowered(data), offsets, join.width)
                sizes = np.bincount(document, minlength=piece.num_rows)
                nodes = piece.column("_node").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[document]), pa.array(element.view(np.int64)),
                     pa.array(sizes[document].astype(np.int64))], names=["_node", "_sig", "_size"])
    return run


def _rare(waiting: DataFrame, texts: DataFrame, join: PartEnum) -> DataFrame:
    """The nodes of the large groups as groups with a rare shingle in common; shards of them.

    In one order of all shingles, rarest first, similar sets have one in common among the
    first of either, so many as the larger can have without the smaller and one more. Of the smaller
    set still fewer count, as the larger has to hold most of it: what a family of texts shares
    comes last and groups only those that hold hardly anything else, which are one component.
    """
    roots = waiting.select("_node", "_root").distinct()
    held = materialize(texts.mapInArrow(_elements(join), "_node bigint, _sig bigint, _size bigint"), "elements")
    held = held.withColumn("_n", F.count("*").over(Window.partitionBy("_sig")))
    place = F.row_number().over(Window.partitionBy("_node").orderBy("_n", "_sig"))
    percent = join.percent
    first = held.withColumn("_place", place).where("_n > 1").where(
        F.col("_place") <= F.expr(f"_size - (_size * {percent} + 99) div 100 + 1")).select(
        "_sig", "_node", (F.col("_place") <= F.expr(
            f"_size - (2 * {percent} * _size + {99 + percent}) div {100 + percent} + 1")).alias("_asks"))
    rows = materialize(first.join(roots, "_node"), "rare")
    worth = rows.groupBy("_sig").agg(F.min("_root").alias("_low"), F.max("_root").alias("_high"),
                                     F.bool_or("_asks").alias("_asked")).where("_asked AND _low < _high")
    return rows.join(worth.select("_sig"), "_sig").select(
        F.col("_sig").alias("_of"), "_sig", "_node", "_root", "_asks", F.lit(None).cast("bigint").alias("_lead"))


def _level(docs: DataFrame, links: list[DataFrame], join: PartEnum, level: int):
    """Adds the links found on one level; returns its groups and the nodes left for the next."""
    groups = materialize(_groups(docs, join, level), "groups")
    members = _members(groups, join)
    members = members.withColumn("_root", F.col("_node"))
    small = members.where("_lead IS NULL").select("_of", "_sig", "_node", "_root", F.lit(True).alias("_asks"), "_lead")
    large = members.where("_lead IS NOT NULL")
    led = materialize(_led(large.select("_node", "_root", "_lead"), join), "led")
    links.append(materialize(_linked(small.unionByName(led), docs, join), "links"))
    left = groups.where("_sig IS NULL").select("_node", "_shingles", "_free_even", "_free_odd")
    if not large.isEmpty():
        held = materialize(large.groupBy("_node").agg(F.collect_list("_sig").alias("_sigs")), "held")
        buckets = held.agg(F.sum(F.size("_sigs"))).first()[0] // ENTRIES + 1
        rounds = join.leaders if level == 0 else 1
        for again in range(rounds):
            if again:
                pairs = waiting.select("_node", "_root", F.col("_next").alias("_lead"))
                links.append(materialize(_linked(materialize(_led(pairs, join), "led"), docs, join), "links"))
            roots = components(reduce(DataFrame.unionByName, links))
            waiting = materialize(_waiting(held, roots, buckets, again + 1 < rounds), "waiting")
        if level + 1 == join.levels:
            rare = _rare(waiting, _texts(docs, waiting.select("_node").distinct()), join)
            links.append(materialize(_linked(materialize(rare, "shared"), docs, join), "links"))
        hot = waiting.groupBy(F.col("_node").alias("_of")).agg(
            F.sum("_even").alias("_even"), F.sum("_odd").alias("_odd"))
        left = left.join(hot, F.col("_node") == F.col("_of"), "left").withColumns({
            "_free_even": F.col("_free_even") - F.coalesce("_even", F.lit(0)),
            "_free_odd": F.col("_free_odd") - F.coalesce("_odd", F.lit(0))})
    if level + 1 == join.levels:
        return groups, None
    left = materialize(left.where("_shingles > 0 AND (_free_even < 0 OR _free_odd < 0)")
                       .select("_node"), "left")
    return groups, None if left.isEmpty() else left


def ngram_join(docs: DataFrame, join: PartEnum = PartEnum(), doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are lowered in A-Z; two texts link if their sets of shingles have a Jaccard
    similarity of ``percent`` or more. Fewer words than a shingle are one shingle; null texts and
    texts without words have no set and link with nothing, not even each other. A component
    is named by its smallest id; rows without an id are in components like others but name none
    unless no row of it has one. Repeated rows give repeated rows. Texts are known by a 64-bit hash, so
    among n texts two are taken for one with a probability of n * n / 2^65. Very long texts have as many
    shingles as they have; an empty table gives no rows.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), id_key(doc_id).alias("_d"),
                        F.xxhash64(whole(text)).alias("_node"), whole(text).alias("_text"))
    links, left = [], None
    for level in range(join.levels):
        own = given.select("_node", "_text")
        if left is not None:
            own = materialize(_texts(own, left), "own")
        groups, left = _level(own, links, join, level)
        if level == 0:
            known = groups.where("_sig IS NULL").select("_node", F.col("_shingles").alias("n_shingles"))
        if left is None:
            break
    roots = components(reduce(DataFrame.unionByName, links)).withColumnRenamed("_node", "_of")
    ids = given.select("_node", "doc_id")
    # read twice
    nodes = materialize(
        ids.groupBy("_node").agg(F.min("doc_id").alias("_least")).join(known, "_node")
        .join(roots, F.col("_node") == F.col("_of"), "left")
        .select("_node", "n_shingles", "_least", F.coalesce("_root", "_node").alias("_class")), "classes")
    classes = nodes.groupBy("_class").agg(F.min("_least").alias("_first"))
    nodes = nodes.join(classes, "_class").select("_node", "n_shingles", "_first")
    return ids.join(nodes, "_node").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("_first")).otherwise(F.col("doc_id")).alias("component_id"))
