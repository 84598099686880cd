"""Prefix trie of conversations, built from partial tries that merge.

A node is a distinct sequence of first turns; its key is a digest chained over the turns, so equal prefixes have equal keys wherever they are read.
Partitions read their conversations in order, emit the way of each through the trie and a table of nodes combined locally: members, the smallest one,
and the lists of those that end there, in slices of the range of ids. Partial tables are then merged by key, FAN of them at a time and round
after round, so the root and a first turn that many share never meet in one task by more rows than FAN. Lists of ends are merged by (node, slice): no
slice can hold more than SLICE ids.

The rollup goes bottom-up along each conversation: a node belongs to its smallest member, whose nodes are the lower end of its way, so what lies
below a node is summed from the ends of the ways upward, each node once, and the sums are merged by key again. Work and rows are linear in turns.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.llm.common import WORD, dropped, remainder, written

#: Partial tables that one step of a merge takes; ids that a slice of a list of ends spans; nodes and ends that a partition holds before it emits them.
FAN, SLICE, HELD = 16, 1 << 16, 1 << 16
ROOT = b"\0" * 16
NOTHING = hashlib.sha256(b"").hexdigest()


def _content(role: str, text: str) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), F.col(role), F.col(text)), 256), 1, 32))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, content, words) of each row with a conv_id: its place in the order of turns, a digest of role and text, the text's words.

    Null roles and texts are empty; rows of one turn are ordered by role, then by digest. Texts are read once and not moved.
    """
    plain = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", plain("role"), plain("text"))
    rows = rows.select("conv_id", "turn", "role", _content("role", "text").alias("content"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "content")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "content", "words")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Conversations that share heads: (conv_id, place, content, words), with place -1 for each conversation itself, turnless ones too.

    The first h turns of c are those of conversation c - c % block, h being crc32(c) % most; then follow c's own turns from its h-th on. A head is
    looked up by block - 1 conversations at most.
    """
    own = turns.withColumn("h", remainder("conv_id", most))
    later = own.where("place >= h").select("conv_id", (F.col("place") + most).alias("place"), "content", "words")
    ids = own.where("place = 0").select("conv_id", "h")
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("place") < most - 1)).withColumnRenamed("conv_id", "head")
    first = ids.where("h > 0").withColumn("head", F.col("conv_id") - F.col("conv_id") % block).join(heads, "head").where("place < h").select("conv_id", "place", "content", "words")
    none = ids.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("content"), F.lit(0).cast("long").alias("words"))
    return none.unionByName(first).unionByName(later)


def _ways(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, node, words, last) of each conversation's way from the root, partition by partition, and the partition's own table of
    nodes: rows with a ``part``, (node, slice, n_convs, ends, least, ids), the members with a null slice."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: dict[bytes, list[int]] = {}
        ends: dict[tuple[bytes, int], list[int]] = {}
        out: list[tuple] = []
        conv, node, depth, pending, sum_ends = None, ROOT, 0, None, 0

        def step(last: bool):
            """The pending node takes the conversation."""
            nonlocal sum_ends
            out.append((conv, depth, node, pending, last, None, None, None, None, None, None))
            counts = held.setdefault(node, [0, 0, conv])
            counts[0] += 1
            counts[1] += last
            counts[2] = min(counts[2], conv)
            if last:
                ends.setdefault((node, conv // SLICE), []).append(conv)
                sum_ends += 1

        def emitted():
            nonlocal sum_ends
            out.extend((None, None, k, None, None, part, None, n, e, least, None) for k, (n, e, least) in held.items())
            out.extend((None, None, k, None, None, part, s, 0, 0, None, sorted(ids)) for (k, s), ids in ends.items())
            held.clear()
            ends.clear()
            sum_ends = 0

        def flushed():
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KINDS, strict=True)], _NAMES)
            out.clear()
            return done

        for batch in batches:
            for own, place, content, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "content", "words")), strict=True):
                if pending is not None:
                    step(own != conv)
                if place < 0:
                    conv, node, depth, pending = own, ROOT, 0, 0
                else:
                    node, depth, pending = hashlib.sha256(node + content).digest()[:16], depth + 1, words
                if len(held) + sum_ends >= HELD:
                    emitted()
                if len(out) >= 8192:
                    yield flushed()
        if pending is not None:
            step(True)
        emitted()
        if out:
            yield flushed()

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(run, "conv_id long, depth long, node binary, words long, last boolean, part int, slice long, n_convs long, ends long, least long, ids array<long>")


_NAMES = ["conv_id", "depth", "node", "words", "last", "part", "slice", "n_convs", "ends", "least", "ids"]
_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]


def merged(partial: DataFrame, parts: int) -> DataFrame:
    """Partial tables (part, node, slice, n_convs, ends, least, ids) of ``parts`` partitions as one, by rounds of FAN tables."""
    while True:
        parts = -(-parts // FAN)
        to = F.floor(F.col("part") / FAN).cast("int").alias("part")
        sums = [F.sum("n_convs").alias("n_convs"), F.sum("ends").alias("ends"), F.min("least").alias("least"), F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids")]
        partial = partial.groupBy("node", "slice", to).agg(*sums)
        if parts <= 1:
            return partial.drop("part")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the hash of a node's ids in order, joined by commas. Slices come in order and are read as a stream."""

    def run(batches):
        node, state, out = None, None, []
        for batch in batches:
            for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                    state.update(",".join(map(str, ids)).encode())
                else:
                    state.update(("," + ",".join(map(str, ids))).encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["node", "ends_sha256"])
                out = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    ordered = ends.select("node", "slice", "ids").repartition("node").sortWithinPartitions("node", "slice").select("node", "ids")
    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, an integer; turn, role, text) rebuilt with shared heads; other columns are not read."""
    turns = written(turns_of(conversations), "turns")
    return prefix_trie(rebuilt(turns), turns)


def prefix_trie(rows: DataFrame, *spent: DataFrame) -> DataFrame:
    """The trie of conversations given as rebuilt() gives them: one row a node.

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes in its subtree, itself
    included), saved_tokens (over its subtree, members but one times the words of a node's last turn), ends_sha256 (of the ids of the
    conversations that end there, in order, joined by commas). Repeated conversations are members of the same nodes. No rows in, no nodes out.
    spent: written tables that only ``rows`` reads.
    """
    ways = written(_ways(rows), "ways")
    dropped(*spent)
    parts = ways.where("part is not null").agg(F.max("part")).first()[0]
    both = written(merged(ways.where("part is not null").select("part", "node", "slice", "n_convs", "ends", "least", "ids"), (parts or 0) + 1), "nodes")
    nodes = both.where("slice is null").select("node", "n_convs", "ends", "least")
    way = ways.where("conv_id is not null").select("conv_id", "depth", "node", "words", "last")
    own = way.hint("merge").join(nodes, "node").withColumn("mine", F.col("least") == F.col("conv_id"))
    order = Window.partitionBy("conv_id").orderBy("depth")
    down = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    leaf = F.col("last") & F.col("mine") & (F.col("n_convs") == F.col("ends"))
    saved = F.when(F.col("mine"), (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    up = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = own.select(
        "node",
        F.when(F.col("mine"), F.struct("conv_id", "depth", F.lag("least").over(order).alias("parent_conv_id"), "n_convs")).alias("row"),
        F.coalesce(F.lead("mine").over(order), F.lit(False)).cast("long").alias("child"),
        F.max(leaf).over(up).cast("long").alias("leaf"),
        F.sum(saved).over(up).alias("saved"),
    )
    sums = shares.groupBy("node").agg(F.max("row").alias("row"), F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    digests = ends_digests(both.where("slice is not null"))
    out = sums.hint("merge").join(digests, "node", "left")
    return out.select("row.*", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
