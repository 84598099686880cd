"""Column functions on record names: gene|target|taxon|NODE_1&&NODE_2|frame|copies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(header: Column, k: int) -> Column:
    """X14. The k-th field, from 0; null beyond the last."""
    return F.get(F.split(header, r"\|"), F.lit(k))


def nodes(text: Column) -> Column:
    """X14. The node numbers of a name of one or more nodes."""
    return F.transform(F.split(text, "&&"), lambda n: F.regexp_extract(n, r"(\d+)", 1).cast("long"))


def is_reference(header: Column) -> Column:
    """S18. References end with a dot."""
    return F.endswith(header, F.lit("."))


def short_name(header: Column) -> Column:
    """F3. The name up to the first bar, or else the first blank."""
    return F.when(F.contains(header, F.lit("|")), F.substring_index(header, "|", 1)).otherwise(F.substring_index(header, " ", 1))


def sample_name(path: Column) -> Column:
    """S3. A file's sample: its name without folders, suffixes and read or part numbers."""
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(?i)\.(fa|fas|fasta|fq|fastq|fna)(\.gz)?$", "")
    return F.regexp_replace(name, r"(_001)?(_[RI][12]|_part\d+|_[12])?(_001)?$", "")


def json_field(header: Column, key: str) -> Column:
    """X23. A value of the JSON part of a name, single quotes read as double ones."""
    return F.get_json_object(F.replace(F.regexp_extract(header, r"(\{.*\})", 1), F.lit("'"), F.lit('"')), f"$.{key}")


def components(text: Column) -> Column:
    """X14. The parts of a name of one or more nodes, without the word NODE_."""
    return F.split(F.replace(text, F.lit("NODE_"), F.lit("")), "&&")


def first_node(text: Column) -> Column:
    """X14. The smallest node number of a name."""
    return F.array_min(nodes(text))


def merge_header(names: Column) -> Column:
    """X14. One name of several nodes: NODE_1&&2."""
    return F.concat(F.lit("NODE_"), F.array_join(F.transform(names, lambda n: F.replace(n, F.lit("NODE_"), F.lit(""))), "&&"))


def contig_header(names: Column) -> Column:
    """X14. The name of a contig: Contig_ and its nodes in order of number, joined by |."""
    return F.concat(F.lit("Contig_"), F.array_join(F.transform(F.array_sort(F.transform(names, lambda n: F.regexp_extract(n, r"(\d+)", 1).cast("long"))), lambda n: n.cast("string")), "|"))


def taxon_only(header: Column) -> Column:
    """F23. The taxon, second field of a name."""
    return field(header, 1)


def copies(header: Column) -> Column:
    """X25. The number of reads that a row stands for: the sixth field, 1 where there is none."""
    return F.coalesce(field(header, 5).cast("long"), F.lit(1).cast("long"))


def regenerated(header: Column, taxon: Column, gene: Column) -> Column:
    """X24. A name with its taxon and gene as JSON, as reference readers take it."""
    return F.concat(header, F.lit(" "), F.to_json(F.struct(taxon.alias("organism_name"), gene.alias("pub_og_id"))))


def tagged(header: Column, extra: Column) -> Column:
    """A10. A name with the number of reads that it stands for as its last field."""
    return F.concat(header, F.lit("|"), (extra + 1).cast("string"))
