import zlib
from collections import Counter

from strandwork.llm import sharding as S

from .conftest import DOCS, doc, prose


def test_shards_are_even_and_slots_gapless(spark):
    rows = [doc(k, prose(k, 5 + k % 40)) for k in range(1500)]
    got = S.shard(spark.createDataFrame(rows, DOCS).repartition(3), 7).collect()
    sizes, places = Counter(), {}
    for r in got:
        text = rows[r["doc_id"]][1].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        sizes[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert max(sizes.values()) - min(sizes.values()) <= max(len(r[1]) + 8 for r in rows)
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) == 7
    again = S.shard(spark.createDataFrame(rows[::-1], DOCS).repartition(5), 7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_growing_moves_slots_only_into_new_shards(spark, tmp_path):
    size = [(k * 7919) % 1000 for k in range(512)]
    first = S.SlotMap.by_bytes(size, 8)
    second = first.grow(size, 10)
    assert second.version == 2 and all(b == a or b >= 8 for a, b in zip(first.shard, second.shard))
    load = Counter()
    for k, to in enumerate(second.shard):
        load[to] += size[k]
    assert max(load.values()) < 1.3 * sum(size) / 10 and min(load.values()) > 0.6 * sum(size) / 10
    path = f"file://{tmp_path}/map"
    first.save(spark, path)
    second.save(spark, path)
    assert S.SlotMap.load(spark, path) == second and S.SlotMap.load(spark, path, 1) == first


def test_shards_are_even_whatever_the_ids_are(spark):
    """Half of the ids null, one id of many texts, and one record repeated very often."""
    rows = [doc(None if k % 2 else k, prose(k, 20)) for k in range(3000)] + [doc(7, prose(9000 + k, 20)) for k in range(1500)] + [doc(8, prose(1, 20))] * 3000
    got = S.shard(spark.createDataFrame(rows, DOCS).repartition(3), 24).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 24
    assert len(got) == len(rows) and max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean
    wanted = Counter((r[0], len(r[1].encode()) + 8, zlib.crc32(r[1].encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == wanted


def plain_map(sizes, shards):
    """Largest slot first to the lightest shard, by looking at all shards each time; empty slots in turn."""
    load, out = [0] * shards, [k % shards for k in range(len(sizes))]
    for k in sorted((k for k in range(len(sizes)) if sizes[k]), key=lambda k: (-sizes[k], k)):
        out[k] = min(range(shards), key=lambda s: (load[s], s))
        load[out[k]] += sizes[k]
    return out


def test_slots_and_shards_against_a_plain_form(edge, edge_rows):
    got = S.shard(edge, 5, n_slots=64).collect()
    sizes = [0] * 64
    for r in got:
        sizes[r["virtual_slot"]] += r["size"]
    wanted = plain_map(sizes, 5)
    assert all(r["shard"] == wanted[r["virtual_slot"]] for r in got)
    places = {}
    for r in sorted(got, key=lambda r: (r["virtual_slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"])):
        places.setdefault(r["shard"], []).append(r)
    for s, rows in places.items():
        assert [r["slot"] for r in rows] == list(range(len(rows))), s
    assert Counter((r["doc_id"], r["text_crc32"]) for r in got) == Counter((r[0], zlib.crc32((r[1] or "").encode())) for r in edge_rows)


def test_edge_cases(edge, nothing):
    got = S.shard(edge, 24).collect()
    assert len(got) == edge.count()
    assert {r["size"] for r in got if r["doc_id"] in (4, 5, 13)} == {8}
    assert S.shard(nothing, 24).count() == 0
