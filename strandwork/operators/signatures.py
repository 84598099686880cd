"""H10 and G8. Clusters of sequences of similar k-mers, of bounded size: bit signatures, split by a tree that partitions' summaries build.

A signature has a bit for each of 256 random directions: which side the sum of a text's different k-mers lies on. Rows of a gene are one node; a node of
too many rows is split in two by the bit that divides it most evenly, then each row goes to the nearer of both sides' majority signatures, a few times. What a
level needs of a node is its bit counts: partitions send one row a node, whatever its size. Nodes of up to LOCAL rows, whose signatures are one
megabyte at most, are split to their end where they are, by the same steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType
from pyspark.sql.window import Window

from strandwork.scratch import dropped, written

BITS = 256
#: Rounds of going to the nearer side, nodes that a partition holds counts of, and rows of a table that may be broadcast.
ROUNDS, HELD, MOST_BROADCAST = 2, 4096, 20_000
#: Rows of a node that one task splits to the end.
LOCAL = 1 << 15
_POWERS = np.uint64(256) ** np.arange(8, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def signature(text: bytes, k: int = 5) -> bytes:
    """The bits of a text's different k-mers (k up to 8); a shorter text is one k-mer, an empty one has no bits."""
    if not text:
        return bytes(BITS // 8)
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    k = min(k, len(raw))
    grams = np.sort(sum(raw[j : len(raw) - k + 1 + j] * _POWERS[j] for j in range(k)))
    grams = grams[np.append(True, grams[1:] != grams[:-1])]
    with np.errstate(over="ignore"):
        words = _mixed(grams[:, None] * np.uint64(4) + np.arange(4, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    whole = len(bits) // 255 * 255  # sums of 255 bits are bytes
    ones = bits[whole:].sum(0, dtype=np.int64) + np.add.reduce(bits[:whole].reshape(-1, 255, BITS), axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(grams)).tobytes()


def signatures(rows: DataFrame, k: int = 5) -> DataFrame:
    """(gene, name, sig) of rows (gene, name, seq); a null seq is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("gene"), b.column("name"), pa.array([signature(t or b"", k) for t in b.column("seq").to_pylist()], pa.binary())], ["gene", "name", "sig"])

    return rows.select("gene", "name", F.col("seq").cast("binary").alias("seq")).mapInArrow(run, "gene string, name string, sig binary")


def _bits(sigs: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, BITS // 8), axis=1)


def _counted(rows: DataFrame) -> DataFrame:
    """(gene, node, side, n, ones) of rows (gene, node, side, sig): rows and set bits, summed in each partition and then over them."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def emitted() -> pa.RecordBatch:
            keys = list(held)
            out = [pa.array([key[j] for key in keys], t) for j, t in ((0, pa.string()), (1, pa.string()), (2, pa.int32()))]
            out += [pa.array([held[key][0] for key in keys], pa.int64()), pa.array([held[key][1].tobytes() for key in keys], pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(out, ["gene", "node", "side", "n", "ones"])

        for b in batches:
            bits = _bits(b.column("sig").to_pylist()) if b.num_rows else np.zeros((0, BITS), np.uint8)
            groups = pd.DataFrame({c: b.column(c).to_pylist() for c in ("gene", "node", "side")}).groupby(["gene", "node", "side"], dropna=False).indices
            for key, at in groups.items():
                key = (key[0] if isinstance(key[0], str) else None, key[1], int(key[2]))
                own = held.setdefault(key, [0, np.zeros(BITS, np.int64)])
                own[0] += len(at)
                own[1] += bits[at].sum(0, dtype=np.int64)
            if len(held) >= HELD:
                yield emitted()
        if held:
            yield emitted()

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        ones = np.stack([np.frombuffer(x, np.int64) for x in pdf["ones"]]).sum(0)
        return pd.DataFrame([(pdf["gene"].iloc[0], pdf["node"].iloc[0], pdf["side"].iloc[0], int(pdf["n"].sum()), ones.tobytes())], columns=["gene", "node", "side", "n", "ones"])

    schema = "gene string, node string, side int, n long, ones binary"
    partial = rows.select("gene", "node", F.col("side").cast("int").alias("side"), "sig").mapInArrow(local, schema)
    return partial.groupBy("gene", "node", "side").applyInPandas(total, schema)


def _given(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows with the columns of a written table of one row a node: broadcast while it is small, else joined like any."""
    table = table.select(F.col("gene").alias("__g"), F.col("node").alias("__n"), *[c for c in table.columns if c not in ("gene", "node")])
    small = F.broadcast(table) if table.count() <= MOST_BROADCAST else table
    return rows.join(small, rows["gene"].eqNullSafe(F.col("__g")) & (rows["node"] == F.col("__n"))).drop("__g", "__n")


@F.pandas_udf(IntegerType())
def _even_bit(n: pd.Series, ones: pd.Series) -> pd.Series:
    """The bit that divides a node's rows most evenly; -1 where all rows are alike."""
    def one(n: int, ones: bytes) -> int:
        count = np.frombuffer(ones, np.int64)
        less = np.minimum(count, n - count)
        return int(less.argmax()) if less.max() > 0 else -1

    return pd.Series([one(*x) for x in zip(n, ones, strict=True)], dtype="int32")


@F.pandas_udf(BinaryType())
def _majority(n: pd.Series, ones: pd.Series) -> pd.Series:
    return pd.Series([np.packbits(2 * np.frombuffer(o, np.int64) > m).tobytes() for m, o in zip(n, ones, strict=True)])


@F.pandas_udf(IntegerType())
def _bit_of(sig: pd.Series, bit: pd.Series) -> pd.Series:
    return pd.Series([s[b >> 3] >> (7 - (b & 7)) & 1 if b >= 0 else 0 for s, b in zip(sig, bit, strict=True)], dtype="int32")


@F.pandas_udf(IntegerType())
def _nearer(sig: pd.Series, zero: pd.Series, one: pd.Series) -> pd.Series:
    """1 where a signature differs in fewer bits from ``one`` than from ``zero``; 0 without them."""
    far = lambda a, b: (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return pd.Series([int(z is not None and o is not None and far(s, o) < far(s, z)) for s, z, o in zip(sig, zero, one, strict=True)], dtype="int32")


def _split(sigs: list[bytes], dealt: np.ndarray, most: int) -> np.ndarray:
    """What a node's rows have after its name when it is split to the end, as signature_clusters() does it level by level; dealt: xxhash64 of the names."""
    words, bits = np.frombuffer(b"".join(sigs), np.uint64).reshape(-1, BITS // 64), _bits(sigs)
    out, waiting = np.full(len(sigs), "", object), [("", np.arange(len(sigs)))]
    while waiting:
        name, at = waiting.pop()
        n = len(at)
        if n <= most:
            out[at] = name
            continue
        ones = bits[at].sum(0, dtype=np.int64)
        less = np.minimum(ones, n - ones)
        if not less.max():
            out[at] = [f"{name}={x}" for x in dealt[at] % math.ceil(n / most)]
            continue
        even = bits[at, less.argmax()].astype(bool)
        side = even
        for _ in range(ROUNDS):
            if side.all() or not side.any():
                side = np.zeros(n, bool)
                continue
            centres = [np.packbits(2 * bits[at[own]].sum(0, dtype=np.int64) > own.sum()).view(np.uint64) for own in (~side, side)]
            zero, one = (np.bitwise_count(words[at] ^ c).sum(1, dtype=np.int64) for c in centres)
            side = one < zero
        side = even if side.all() or not side.any() else side
        waiting += [(name + "0", at[~side]), (name + "1", at[side])]
    return out


def _split_here(rows: DataFrame, most: int) -> DataFrame:
    """(gene, name, node) of rows (gene, name, node, sig) whose nodes have LOCAL rows at most, with the nodes that they end in."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[["gene", "name"]].assign(node=pdf["node"] + _split(list(pdf["sig"]), pdf["dealt"].to_numpy(), most))

    return rows.withColumn("dealt", F.xxhash64("name")).groupBy("gene", "node").applyInPandas(run, "gene string, name string, node string")


def signature_clusters(rows: DataFrame, k: int = 5, most: int = 500) -> DataFrame:
    """(gene, name, cluster) of rows (gene, name, seq): clusters from 0 in each gene, of at most ``most`` rows or thereabouts where alike rows
    are dealt by their names. The same rows give the same clusters, however they are partitioned. A null gene is a gene.
    """
    left, done = written(signatures(rows, k).withColumn("node", F.lit("")), "signatures"), []
    while True:
        sizes = written(_counted(left.withColumn("side", F.lit(0))), "sizes")
        few = max(most, LOCAL)
        small = written(_split_here(_given(left, sizes.where(F.col("n") <= few).select("gene", "node")), most), "small")
        done.append(small)
        big = sizes.where(F.col("n") > few)
        if not big.count():
            dropped(left, sizes)
            break
        plan = written(big.select("gene", "node", F.col("n").alias("rows"), _even_bit("n", "ones").alias("bit")), "plan")
        now = written(_given(left, plan).withColumn("even", _bit_of("sig", "bit")).withColumn("side", F.col("even")), "sides")
        dropped(left, sizes, plan)
        for _ in range(ROUNDS):
            sums = _counted(now).withColumn("centre", _majority("n", "ones"))
            pick = lambda s: F.max(F.when(F.col("side") == s, F.col("centre"))).alias(f"centre{s}")
            centres = written(sums.groupBy("gene", "node").agg(pick(0), pick(1)), "centres")
            moved = written(_given(now, centres).withColumn("side", _nearer("sig", "centre0", "centre1")).drop("centre0", "centre1"), "sides")
            dropped(now, centres)
            now = moved
        full = written(now.groupBy("gene", "node").agg(F.countDistinct("side").alias("sides")), "full")
        alike = F.pmod(F.xxhash64("name"), F.ceil(F.col("rows") / most)).cast("string")
        side = F.when(F.col("bit") < 0, F.concat(F.lit("="), alike)).when(F.col("sides") > 1, F.col("side").cast("string")).otherwise(F.col("even").cast("string"))
        split = _given(now, full).withColumn("node", F.concat("node", side))
        # Rows that are all alike are dealt once for all; the others go on.
        done.append(written(split.where("bit < 0").select("gene", "name", "node"), "alike"))
        left = written(split.where("bit >= 0").select("gene", "name", "sig", "node"), "signatures")
        dropped(now, full)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    number = F.dense_rank().over(Window.partitionBy("gene").orderBy("node")) - 1
    names = out.select("gene", "node").distinct().withColumn("cluster", number.cast("long"))
    names = names.select(F.col("gene").alias("__g"), F.col("node").alias("__n"), "cluster")
    return out.join(names, out["gene"].eqNullSafe(F.col("__g")) & (out["node"] == F.col("__n"))).select("gene", "name", "cluster")
