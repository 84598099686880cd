"""Stages from the command line: Parquet tables in, Parquet tables out.

    python -m strandwork STAGE --table NAME=PATH ... --out FOLDER [--set PARAMETER=VALUE ...] [--fasta]

Stage names are matched without regard to case. Tables are named as the stage function's arguments; ``samples`` may be given
several times. Parameters are the fields of the stage's parameters, or its plain arguments. ``auto`` runs a sample's stages as one chain, whose
tables lie in FOLDER, and goes on where it was stopped (--set sample=NAME, --set start=STAGE).
"""

from __future__ import annotations

import argparse
import dataclasses
import inspect

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strandwork.functions.msa import as_share
from strandwork.operators.grouped import frames
from strandwork.plans import auto, stages
from strandwork.sources import catalog
from strandwork.sources.fasta import read_fasta, read_fastq, samples

STAGES = {
    "auto": auto.auto, "prepare": stages.prepare, "search": stages.search, "report": stages.report, "reportgenes": stages.report_genes, "references": stages.build_references, "hmmsearch": stages.profile_search,
    "align": frames.aligned, "pal2nal": stages.pal2nal, "flexcull": frames.end_trimmed, "motif": frames.gaps_filled, "outlier": stages.outliers, "internal": stages.internal, "excise": frames.excised, "cluster": stages.cluster,
    "combine": stages.combine, "merge": stages.merge, "finish": stages.finish, "isoform": frames.isoforms, "taxonomy_filler": catalog.filled_taxonomy,
}


def _value(text: str, like: object) -> object:
    """A parameter as its default's type; shares may be given as percentages."""
    if isinstance(like, bool):
        return text.lower() in ("1", "true", "yes")
    if isinstance(like, float):
        return as_share(float(text)) if 0 <= like <= 1 else float(text)
    return int(text) if isinstance(like, int) else text


def run_stage(spark: SparkSession, name: str, tables: dict[str, list[str]], settings: dict[str, str], out: str, fasta: bool = False) -> dict[str, str]:
    """Runs one stage and writes its tables; returns where each lies. With ``fasta`` the table ``records`` is read from sequence files."""
    stage = STAGES[name.lower()]
    wanted = inspect.signature(stage).parameters
    given: dict[str, object] = {k: v for k, v in (("spark", spark), ("root", out)) if k in wanted}
    for key, paths in tables.items():
        if key not in wanted:
            raise SystemExit(f"{name} takes {', '.join(wanted)}, not {key}")
        if fasta and key == "records":
            read = read_fastq if all(".fq" in p or ".fastq" in p for p in paths) else read_fasta
            given[key] = samples(read(spark, paths)).select(F.col("sample").alias("taxa"), "idx", "header", "seq")
        else:
            frames = [spark.read.parquet(p) for p in paths]
            given[key] = frames if key == "samples" else frames[0]
    if "params" in wanted:
        fields = {f.name: f.default for f in dataclasses.fields(wanted["params"].default)}
        given["params"] = type(wanted["params"].default)(**{k: _value(v, fields[k]) for k, v in settings.items() if k not in wanted})
        given |= {k: _value(v, wanted[k].default) for k, v in settings.items() if k in wanted}
    else:
        given |= {k: _value(v, wanted[k].default) for k, v in settings.items()}
    made = stage(**given)
    written = {}
    for key, df in (made if isinstance(made, dict) else {name.lower(): made}).items():
        written[key] = f"{out.rstrip('/')}/{key}"
        df.write.mode("overwrite").parquet(written[key])
    return written


def main(args: list[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(prog="strandwork", description=__doc__.split("\n")[0])
    parser.add_argument("stage", type=str.lower, choices=list(STAGES))
    parser.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    parser.add_argument("--set", action="append", default=[], metavar="PARAMETER=VALUE")
    parser.add_argument("--out", required=True)
    parser.add_argument("--fasta", action="store_true", help="records are FASTA or FASTQ files")
    given = parser.parse_args(args)
    tables: dict[str, list[str]] = {}
    for text in given.table:
        key, path = text.split("=", 1)
        tables.setdefault(key, []).append(path)
    spark = SparkSession.builder.appName("strandwork").getOrCreate()
    done = run_stage(spark, given.stage, tables, dict(t.split("=", 1) for t in given.set), given.out, given.fasta)
    for key, path in done.items():
        print(key, path)
    return done


if __name__ == "__main__":
    main()
