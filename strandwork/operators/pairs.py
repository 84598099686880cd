"""Protein and nucleotide rows of one alignment side by side, and what the rows of a gene share."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions import msa
from strandwork.functions.dna import let
from strandwork.functions.intervals import overlap
from strandwork.operators.columns import occupancy
from strandwork.operators.tallies import tallied


def paired(aa: DataFrame, nt: DataFrame, keys: list[str]) -> DataFrame:
    """J5. Full outer join of protein rows (keys, idx, aa) and nucleotide rows (keys, nt), with ``problem``: no_nt, no_aa,
    short_nt (fewer codons than letters) or null. A gene whose rows have any is not to be used: see paired_genes()."""
    rows = aa.withColumn("__a", F.lit(True)).join(nt.withColumn("__n", F.lit(True)), keys, "full_outer")
    few = F.length("nt") < 3 * msa.data_length(F.col("aa"), "-")
    problem = F.when(F.col("__n").isNull(), "no_nt").when(F.col("__a").isNull(), "no_aa").when(few, "short_nt")
    return rows.withColumn("problem", problem).drop("__a", "__n")


def paired_genes(pairs: DataFrame, gene: str = "gene") -> DataFrame:
    """J5. The rows of genes without any problem."""
    bad = pairs.where("problem is not null").select(gene).distinct()
    return pairs.join(bad, gene, "left_anti").drop("problem")


def in_order_of(nt: DataFrame, aa: DataFrame, keys: list[str], place: str = "idx") -> DataFrame:
    """J15 and O4. Nucleotide rows with the place of their protein rows, rows without one last (null)."""
    return nt.drop(place).join(aa.select(*keys, place), keys, "left")


def span_order(aa: DataFrame, by: list[str], name: str, place: str = "idx") -> DataFrame:
    """O4. ``place`` of each row in its group by start and end of its data, then name, from 0."""
    w = Window.partitionBy(*by).orderBy(msa.data_start(F.col("aa")), msa.data_end(F.col("aa")), name)
    return aa.withColumn(place, (F.row_number().over(w) - 1).cast("long"))


def alignment_order(rows: DataFrame, by: list[str], is_genome: bool, place: str = "place") -> DataFrame:
    """O3. Place in the written alignment, from 0: references (is_ref) first by name; others by their first column with data or, of
    genomes, by first node and, among rows of one node, by name, from last to first where the first of them is on the minus strand."""
    name = F.col("name")
    if is_genome:
        same = Window.partitionBy(*by, "is_ref", "node")
        minus = F.min_by("strand", "name").over(same) == "-"
        rank = F.row_number().over(same.orderBy("name"))
        order = [F.when(~F.col("is_ref"), F.col("node")), F.when(~F.col("is_ref"), F.when(F.col("__minus"), -F.col("__rank")).otherwise(F.col("__rank")))]
        rows = rows.withColumn("__minus", minus).withColumn("__rank", rank)
    else:
        order = [F.when(~F.col("is_ref"), msa.data_start(F.col("seq")))]
    w = Window.partitionBy(*by).orderBy(F.col("is_ref").desc(), *order, name)
    return rows.withColumn(place, (F.row_number().over(w) - 1).cast("long")).drop("__minus", "__rank")


def kicks_mirrored(aa: DataFrame, nt: DataFrame, kicked: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """F20. Both tables without the rows that are kicked in either: (keys) of ``kicked``."""
    gone = kicked.select(*keys).distinct()
    return aa.join(gone, keys, "left_anti"), nt.join(gone, keys, "left_anti")


def genes_with_candidates(rows: DataFrame, gene: str = "gene") -> DataFrame:
    """F17. Rows of genes that have any row that is no reference."""
    return rows.join(rows.where(~F.col("is_ref")).select(gene).distinct(), gene, "left_semi")


def reference_rows(rows: DataFrame, top: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """F11. Reference rows (gene, taxon, target, seq) of top taxa and, if given, valid targets (gene, target), with their header."""
    kept = rows.join(top.select("taxon").distinct(), "taxon", "left_semi")
    if valid is not None:
        kept = kept.join(valid.select("gene", "target").distinct(), ["gene", "target"], "left_semi")
    return kept.select("gene", "taxon", "target", F.concat_ws("|", "gene", "taxon", "target", F.lit(".")).alias("header"), "seq")


def short_rows(rows: DataFrame, least: int) -> DataFrame:
    """F22. ``too_short``: fewer than ``least`` letters of data."""
    return rows.withColumn("too_short", msa.data_length(F.col("seq"), "-") < least)


def against_median(rows: DataFrame, by: str, share: float = 0.5) -> DataFrame:
    """F21. Rows whose letters of data are at least ``share`` of their group's median."""
    data = msa.data_length(F.col("seq"), "-")
    middle = rows.groupBy(by).agg(F.percentile(data, F.lit(0.5)).alias("__m"))
    return rows.join(middle, by).where(data >= share * F.col("__m")).drop("__m")


def distinct_work(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A2. One row for each different text of a group: keys, seq and name, the smallest of those that bear it."""
    return rows.groupBy(*keys, "seq").agg(F.min("name").alias("name"))


def reinserted(rows: DataFrame, done: DataFrame, keys: list[str], result: str) -> DataFrame:
    """A2. Every row with the result of its text's work."""
    return rows.join(done.select(*keys, "seq", result), [*keys, "seq"])


def component_distinct(rows: DataFrame, component: Column) -> DataFrame:
    """A4. Of rows with equal component and text the one of the smallest name."""
    return rows.groupBy(component.alias("component"), "seq").agg(F.min_by(F.struct(*rows.columns), "name").alias("r")).select("r.*")


def internal_cull(aa: DataFrame, nt: DataFrame, by: str, least: float) -> tuple[DataFrame, DataFrame]:
    """A18. Columns whose share of data is below ``least`` are cut from protein rows (by, name, aa), and their codons from the
    nucleotide rows (by, name, nt, without gaps): the codon of a cut letter of that row. A group's columns are one array of flags."""
    rows = aa.withColumnRenamed("aa", "seq")
    cut = occupancy(rows, by).where(F.col("share") < least).groupBy(by).agg(F.collect_set("place").alias("__cut"))
    rows = rows.join(cut.select(by, msa.flags(F.col("__cut")).alias("__cut")), by, "left")
    letters = msa.letters(F.col("seq"))
    kept = rows.select(by, "name", F.array_join(F.filter(letters, lambda c, i: ~msa.at(F.col("__cut"), i)), "").alias("aa"))
    # For each letter of data in turn, whether its column stays.
    data = F.filter(F.transform(letters, lambda c, i: F.struct(c.alias("c"), msa.at(F.col("__cut"), i).alias("gone"))), lambda x: x["c"] != "-")
    marks = rows.select(by, "name", F.transform(data, lambda x: x["gone"]).alias("__gone"))
    codon = let(msa.letters(F.col("nt")), lambda x: F.transform("__gone", lambda gone, i: F.when(gone, "").otherwise(msa.codon_at(x, i))))
    rest = F.substring(F.col("nt"), F.size("__gone") * 3 + 1, F.length("nt"))
    return kept, nt.join(marks, [by, "name"]).select(by, "name", F.concat(F.array_join(codon, ""), rest).alias("nt"))


def by_gene(rows: DataFrame, gene: str = "gene") -> DataFrame:
    """A25. The rows of each gene as one array, by name: for reference sets, whose genes have tens to hundreds of rows."""
    more = [c for c in rows.columns if c != gene]
    return rows.groupBy(gene).agg(F.array_sort(F.collect_list(F.struct(*more))).alias("rows"))


def core_export(rows: DataFrame) -> DataFrame:
    """A33. key (gene|target), the unaligned protein, its gene, taxon and length."""
    plain = F.replace("seq", F.lit("-"), F.lit(""))
    return rows.select(F.concat_ws("|", "gene", "target").alias("key"), plain.alias("aa"), "gene", "taxon", F.length(plain).alias("aa_len"))


def cluster_majority(rows: DataFrame, reference_columns: DataFrame, distance: int = 100, single: float = 0.5) -> DataFrame:
    """A30. Clusters by node number of rows (gene, node, seq, passed), gaps of more than ``distance`` apart: first and last node, the
    share of the gene's reference columns (gene, columns) that they cover together, and the share that passed. A cluster of one
    counts only if it covers more than ``single``."""
    from strandwork.operators.islands import id_clusters_in_ranges

    known = rows.join(reference_columns.select("gene", F.size("columns").alias("__all")), "gene")
    marked = id_clusters_in_ranges(known, ["gene"], "node", distance, ["passed"])
    # Columns with data are counted where the rows are; a cluster may hold all rows of a gene.
    key = F.concat_ws("\x1f", F.col("cluster").cast("string"), F.col("gene").cast("string"))
    places = tallied(marked.select(key.alias("__key"), "seq"), "__key").where("ch != '-'").select("__key", "place").distinct()
    kind = rows.schema["gene"].dataType
    named = places.select(F.substring_index("__key", "\x1f", 1).cast("long").alias("cluster"), F.expr("substring(__key, instr(__key, '\x1f') + 1)").cast(kind).alias("gene"), "place")
    covered = named.join(reference_columns.select("gene", F.explode("columns").alias("place")), ["gene", "place"], "left_semi").groupBy("gene", "cluster").agg(F.count("*").alias("__n"))
    out = marked.groupBy("gene", "cluster").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("n"), F.avg(F.col("passed").cast("double")).alias("passed"), F.first("__all").alias("__all"))
    out = out.join(covered, ["gene", "cluster"], "left").withColumn("coverage", F.coalesce("__n", F.lit(0)) / F.col("__all"))
    return out.where((F.col("n") > 1) | (F.col("coverage") > single)).select("gene", "first", "last", "n", "coverage", "passed")


def reference_columns(references: DataFrame, gene: str = "gene", gap: str = "-") -> DataFrame:
    """The columns where any reference of a gene has data: gene, columns."""
    return tallied(references, gene).where(F.col("ch") != gap).groupBy(gene).agg(F.array_sort(F.collect_set("place")).alias("columns"))


def absorbed(sets: list[DataFrame]) -> DataFrame:
    """U2. All rows of several reference sets."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def subsets(rows: DataFrame, n: int, gene: str = "gene") -> DataFrame:
    """U2. ``subset`` from 0: genes in order of name, dealt in n runs of equal number (the last may be shorter)."""
    genes = rows.select(gene).distinct()
    every = genes.count()
    per = max(1, -(-every // max(1, n)))
    ranked = genes.withColumn("__k", F.row_number().over(Window.orderBy(gene)) - 1)  # one row a gene
    return rows.join(ranked.select(gene, F.floor(F.col("__k") / per).cast("int").alias("subset")), gene)


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], start: str, end: str, least: int = 1, width: int = 256) -> DataFrame:
    """J6. Pairs of rows of equal keys whose ranges [start, end) have at least ``least`` places in common: columns of ``a`` and, with
    the suffix _b, of ``b``, and ``common``.

    Ranges are cut into cells of ``width`` places and meet by cell, so one key with very many rows is many keys; a pair is taken in the
    first cell that both reach.
    """
    cell = F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width)))
    left = a.where(F.col(end) > F.col(start)).withColumn("__cell", cell)
    right = b.where(F.col(end) > F.col(start)).withColumn("__cell", cell)
    right = right.select(*keys, "__cell", *[F.col(c).alias(f"{c}_b") for c in b.columns if c not in keys])
    both = left.join(right, [*keys, "__cell"])
    first = F.floor(F.greatest(start, f"{start}_b") / width) == F.col("__cell")
    return both.where(first).withColumn("common", overlap(F.col(start), F.col(end), F.col(f"{start}_b"), F.col(f"{end}_b"))).where(F.col("common") >= least).drop("__cell")


def references_and_candidates(rows: DataFrame, header: str = "header") -> tuple[DataFrame, DataFrame]:
    """S18. The rows of references and those of candidates."""
    from strandwork.functions.headers import is_reference

    return rows.where(is_reference(F.col(header))), rows.where(~is_reference(F.col(header)))


#: Rows of a block of one key where every two rows meet, and pairs that are worked out at once.
PAIR_ROWS, PAIR_STEP = 2048, 1 << 17


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``width`` components of each array as doubles, and which of them are there: not null, and within the array."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    there = np.append(flat.is_valid().to_numpy(zero_copy_only=False), False)
    values = np.append(flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
    at = (np.cumsum(size) - size)[:, None] + np.arange(width)
    at = np.where(np.arange(width) < size[:, None], at, len(flat))
    return values[at], there[at]


def _halves_up(d: np.ndarray, digits: int) -> np.ndarray:
    """As Spark's round(): half up in the shortest decimal form of each double; what has no further digits, or is not finite, stays."""
    with np.errstate(invalid="ignore", over="ignore"):
        y = d * 10.0**digits
        low = np.floor(y)
        out = (low + (y - low >= 0.5)) / 10.0**digits
        near = np.abs(y - low - 0.5) <= 1e-6 + y * 1e-15
        out = np.where(y < 1e16, out, d)
    for k in np.flatnonzero(near & (y < 1e16)):
        out[k] = float(Decimal(repr(float(d[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


def _one_by_one(p: np.ndarray, q: np.ndarray, p_there: np.ndarray, q_there: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of rows of p and q, summed component by component over those that both have, and where there are none."""
    both, total = p_there & q_there, np.zeros(len(p))
    with np.errstate(invalid="ignore", over="ignore"):
        for k in range(p.shape[1]):
            total += np.where(both[:, k], (p[:, k] - q[:, k]) ** 2, 0.0)
    return _halves_up(total, digits), ~both.any(1)


def _block_distances(p: tuple, q: tuple | None, digits: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Every two rows of one block (``q`` None), or every row of one with every row of another: smaller name, larger name, distance.

    The distances are a matrix product; where its rounding error could change the last digit, they are summed component by component.
    """
    ids, x, there = p
    ids_b, y, there_b = q or p
    whole = bool(there.all() and there_b.all())
    with np.errstate(invalid="ignore", over="ignore"):
        square, square_b = (x**2).sum(1), (y**2).sum(1)
        slack = 10.0**digits * 1e-13 * (square.max(initial=0) + square_b.max(initial=0)) + 1e-9
    step = max(1, PAIR_STEP // max(1, len(ids_b)))
    for i in range(0, len(ids), step):
        own = slice(i, i + step)
        # In a block of its own order, the rows before have met these.
        from_ = i if q is None else 0
        names, names_b = np.broadcast_arrays(ids[own, None], ids_b[None, from_:])
        taken = names < names_b if q is None else names != names_b
        every = bool(taken.all())
        pick = np.ravel if every else lambda m: m[taken]  # noqa: B023
        n = taken.size if every else int(taken.sum())
        if whole:
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = x[own] @ y[from_:].T
                scaled *= -2
                scaled += square[own, None]
                scaled += square_b[from_:]
                scaled = pick(scaled) * 10.0**digits
                low = np.floor(scaled)
                scaled -= low
                low += scaled >= 0.5
                low /= 10.0**digits
                scaled -= 0.5
                out, again = low, np.flatnonzero(~(np.abs(scaled, out=scaled) > slack))
        else:
            out, again = np.empty(n), np.arange(n)
        none = None
        if len(again):
            r, c = np.divmod(again if every else np.flatnonzero(taken)[again], taken.shape[1])
            out[again], missing = _one_by_one(x[own][r], y[from_:][c], there[own][r], there_b[from_:][c], digits)
            if missing.any():
                none = np.zeros(n, bool)
                none[again] = missing
        a, b = (names, names_b) if q is None else (np.minimum(names, names_b), np.maximum(names, names_b))
        yield pick(a), pick(b), pa.array(out, mask=none, from_pandas=False)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column(k).dictionary_encode().indices.to_numpy(zero_copy_only=False) for k in keys]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in codes])) + 1
        for s, e in zip([0, *new], [*new, batch.num_rows], strict=True):
            key = [batch.column(k)[int(s)].as_py() for k in keys]
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(int(s), int(e - s)))
            now = key
    if held:
        yield pa.Table.from_batches(held)


def pair_distances(rows: DataFrame, key: str, name: str, vector: str, width: int, digits: int) -> DataFrame:
    """J8. Every two rows of one key: a and b, the smaller and larger ``name`` (a whole number), and the squared distance of their first
    ``width`` components, rounded. Components that either lacks are left out; without any common one the distance is null.

    The result is quadratic by nature. A key's rows are dealt into blocks of about PAIR_ROWS, every two blocks meet in a task, and their
    pairs pass on in steps: a task holds two blocks, however many rows a key has.
    """
    known = rows.select(F.col(key).alias("key"), F.col(name).cast("long").alias("name"), F.col(vector).alias("vector")).where("key is not null and name is not null")
    sizes = known.groupBy("key").agg(F.ceil(F.count("*") / PAIR_ROWS).cast("int").alias("blocks"))
    dealt = known.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("name", "vector"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("x"), F.greatest("own", k).alias("y"), (F.col("own") > k).alias("second")))
    sent = dealt.select("key", "name", "vector", F.explode(meets).alias("m")).select("key", "m.*", "name", "vector")

    def block(table: pa.Table) -> tuple:
        ids = table.column("name").to_numpy()
        order = np.argsort(ids, kind="stable")
        x, there = _matrix(table.column("vector").combine_chunks(), width)
        return ids[order], x[order], there[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["key", "x", "y"]):
            second = group.column("second")
            alone = group.column("x")[0] == group.column("y")[0]
            for a, b, distance in _block_distances(block(group.filter(pc.invert(second))), None if alone else block(group.filter(second)), digits):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), distance], ["a", "b", "distance"])

    # Into a fixed number of partitions: blocks are small to shuffle and long to work on.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(n, "key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, "a long, b long, distance double")
