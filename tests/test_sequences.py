"""The data source of sequence files: fuzzed round trips over cuts anywhere, block-gzip, pruning, and errors instead of losses."""

import gzip
import random
import zlib

import pytest
from pyspark.errors import PySparkException

from strandwork.sources import fasta
from strandwork.sources import sequences as S


def wrap(r, text, width):
    return "\n".join(text[i : i + width] for i in range(0, len(text), width)) or ""


def made(r, kind, n):
    """(text, records): names with spaces, empty and long sequences, and qualities that look like other lines."""
    records, out, end = [], [], r.choice(["\n", "\r\n"])
    for k in range(n):
        seq = "".join(r.choice("ACGTN") for _ in range(r.choice([0, 1, 5, 60, 61, r.randint(1, 300)])))
        width, name = r.choice([7, 60, 1000]), f"r{k} {'x' * r.randint(0, 5)}".strip()
        qual = "".join(r.choice("@+>I!#A") for _ in seq) if kind == "fastq" else None
        if kind == "fastq":
            out.append(f"@{name}\n{wrap(r, seq, width)}\n+{r.choice(['', name])}\n{wrap(r, qual, width)}\n")
        else:
            out.append(f">{name}\n" + (wrap(r, seq, width) + "\n" if seq else ""))
        records.append((name, seq, qual, len(seq)))
    text = "".join(out).replace("\n", end)
    return (text if r.random() < 0.7 else text.rstrip("\r\n") if records and records[-1][1] else text).encode(), records


def blocks(data, size):
    """Block-gzip: gzip members that say how long they are, and an empty one at the end."""
    out = []
    for part in [*(data[i : i + size] for i in range(0, len(data), size)), b""]:
        machine = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = machine.compress(part) + machine.flush()
        out.append(b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(part).to_bytes(4, "little") + len(part).to_bytes(4, "little"))
    return b"".join(out)


def read(path, split, columns="header string, seq string, qual string, n long"):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(columns)
    reader = S.SequenceReader(schema, {"path": path, "split_bytes": str(split)})
    parts = reader.partitions()
    return [tuple(row.values()) for p in parts for b in reader.read(p) for row in b.to_pylist()], parts


@pytest.mark.parametrize("kind", ["fasta", "fastq"])
@pytest.mark.parametrize("packed", ["plain", "gzip", "blocks"])
def test_fuzzed_round_trips(spark, tmp_path, kind, packed, monkeypatch):
    r = random.Random(f"{kind}{packed}")
    for t in range(60):
        monkeypatch.setattr(S, "PIECE", r.choice([3, 50, 1 << 20]))
        monkeypatch.setattr(S, "LOOK_BACK", r.choice([3000, 1 << 17]))
        data, records = made(r, kind, r.randint(0, 40))
        path = tmp_path / f"{t}.f"
        path.write_bytes({"plain": lambda d: d, "gzip": lambda d: gzip.compress(d[: len(d) // 2]) + gzip.compress(d[len(d) // 2 :]), "blocks": lambda d: blocks(d, r.choice([40, 300, 5000]))}[packed](data))
        size = r.choice([1, 17, 100, 1000, 1 << 25]) if len(data) < 3000 else 400
        got, parts = read(str(path), size)
        assert got == records, (t, size)
        assert packed == "gzip" or len(parts) == max(1, -(-path.stat().st_size // size))


def test_source_in_many_tasks_with_few_columns(spark, tmp_path):
    r = random.Random(2)
    data, records = made(r, "fastq", 3000)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.fq").write_bytes(data)
    (tmp_path / "in/b.fq.gz").write_bytes(blocks(data, 20_000))
    (tmp_path / "in/_hidden").write_text("x")
    spark.dataSource.register(S.SequenceSource)
    load = lambda path, **o: spark.read.format("sequences").options(**o).load(path)
    df = load(f"file://{tmp_path}/in", split_bytes=50_000)
    assert df.rdd.getNumPartitions() > 10 and df.columns == ["file", "place", "header", "seq", "qual", "n"]
    assert sorted((x["header"], x["seq"], x["qual"], x["n"]) for x in df.collect()) == sorted(records * 2)
    ordered = df.where("file like '%a.fq'").orderBy("place").collect()
    assert [x["header"] for x in ordered] == [x[0] for x in records]
    few = spark.read.format("sequences").schema("n long, header string").load(f"{tmp_path}/in/*.gz")
    assert few.count() == 3000 and sorted(map(tuple, few.collect())) == sorted((x[3], x[0]) for x in records)
    reader = S.SequenceReader(few.schema, {"path": f"{tmp_path}/in/a.fq"})
    assert next(reader.read(reader.partitions()[0])).schema.names == ["n", "header"]
    (tmp_path / "empty.fa").write_text("")
    assert load(f"{tmp_path}/empty.fa").count() == 0
    with pytest.raises(ValueError, match="no such columns"):
        S.SequenceReader(spark.range(1).schema, {"path": "x"})


@pytest.mark.parametrize("text", ["@a\nAC\n+\nI\n@b\nA\n+\nI\n", "@a\nAC\n+\nIII\n", "@a\nAC\nII\n", "@a\nA1\n+\nII\n", "a\nAC\n+\nII\n", "@a\nAC\n+other\nII\n"])
def test_malformed_records_are_errors(spark, tmp_path, text):
    (tmp_path / "x.fq").write_text(text)
    with pytest.raises(ValueError, match=r"x\.fq, place 0"):
        reader = S.SequenceReader(spark.createDataFrame([], S.SCHEMA).schema, {"path": str(tmp_path / "x.fq"), "kind": "fastq"})
        list(reader.read(reader.partitions()[0]))
    if "+other" not in text and "A1" not in text:
        with pytest.raises(PySparkException, match="four lines"):
            fasta.read_fastq(spark, f"file://{tmp_path}/x.fq").collect()


def test_wrapped_records_are_an_error_for_the_reader_of_four_lines(tmp_path, spark):
    (tmp_path / "w.fq").write_text("@a\nACGT\nAC\n+\nIIII\nII\n@b\nA\n+\nI\n")
    with pytest.raises(PySparkException, match="four lines"):
        fasta.read_fastq(spark, f"file://{tmp_path}/w.fq").collect()
    (tmp_path / "ok.fq").write_text("@a\nACGT\n+\nIIII\n@b\n\n+\n\n\n")
    assert sorted((x["header"], x["seq"]) for x in fasta.read_fastq(spark, f"file://{tmp_path}/ok.fq").collect()) == [("a", "ACGT"), ("b", "")]
