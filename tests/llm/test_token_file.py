import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandwork.llm import token_file as T
from strandwork.llm.common import new_path
from strandwork.llm.queries import tokenizer_path


@given(st.lists(st.integers(0, 300), max_size=2000), st.integers(0, 3))
@settings(max_examples=40, deadline=None)
def test_round_trip(ids, again):
    ids = np.array(ids * 4**again, np.uint32)
    coder = T.Coder(T.quantised(np.bincount(ids, minlength=301)))
    assert (coder.decode(coder.encode(ids), len(ids)) == ids).all()


def test_blocks_guard_themselves():
    ids = (np.arange(700_000) ** 2 % 997).astype(np.uint32)
    coder = T.Coder(T.quantised(np.bincount(ids)))
    block = T.pack_block(coder, [1, None, 3], np.array([10, 0, 699_990]), ids)
    keys, lengths, back = T.unpack_block(coder, block)
    assert keys == [1, None, 3] and lengths.tolist() == [10, 0, 699_990] and (back == ids).all()
    with pytest.raises(ValueError):
        T.unpack_block(coder, block[:5000] + b"x" + block[5001:])


def test_whole_file(spark, edge, edge_rows, nothing):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    wanted = sorted(((r[0] is not None, r[0] or 0), [*plain.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in edge_rows)
    path = new_path(spark, "file")
    got = sorted(T.encoded(edge, tokenizer_path(), path, with_ids=True).collect(), key=lambda r: r["start"])
    order = {(k, tuple(ids)): n for n, (k, ids) in enumerate(((r["doc_id"] is not None, r["doc_id"] or 0), r["ids"]) for r in got)}
    wanted.sort(key=lambda x: (x[0], order.get((x[0], tuple(x[1])), 0)))  # texts of one doc_id in the file's order
    at = 0
    for (key, ids), r in zip(wanted, got, strict=True):
        assert (r["doc_id"] or 0, r["start"], r["n_tokens"], r["ids"]) == (key[1], at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert T.encoded(nothing, tokenizer_path()).count() == 0


def test_special_texts_and_cuts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(tokenizer_path()), T.WordIds(tokenizer_path())
    texts = ["a,b don't it's '' x.y..z", "<|endoftext|>a <|startoftext|>", "A,b <|ENDOFTEXT|>", "≠ ä.  x\x1cy 1,2.3", "İİ", "###w***,….", "", "café.CafÉ"]
    for _ in range(2):
        for t in texts:
            assert own.encode(pa.array([t]))[0].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_words_that_are_no_single_run_do_not_shift_others():
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    fill = " ".join(f"{a}{b}né" for a in "bdfgk" for b in "aeiou")
    for blank in ("\u00a0", "\u3000", "\u2003", "\u0085"):
        for other in ("word\u201d", "foo\u00a0bar", "a\u2014b", "\u0130"):
            own = T.WordIds(tokenizer_path())
            for t in (f"{fill} {blank} more words {other} and ends", fill, "and more words"):
                assert own.encode(pa.array([t]))[0].tolist() == plain.encode(t, add_special_tokens=False).ids, (blank, other)


ODD = ["\u0085", "\u00a0", "\u2003", "\u3000", "\u200d", "\u0301", "\u0338", "\u0130", "\u03a3", "\u201d", "\u2014", "\u0958", "\u4e2d", "\ud55c", "\U0001f600", "'s", "'", "-", "<", "|", "9", "\u00bd", "\n", "\t", " ", " ", " ", "A", "b", "le", "Caf\u00e9"]


@given(st.lists(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=30).map("".join), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_any_text_has_the_plain_tokenizers_ids(texts):
    """Several texts through one cache, arbitrary Unicode, blanks and signs alone, inside and between words."""
    import pyarrow as pa

    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    plain, own = _tokenizers()
    for group in (texts, texts[::-1]):
        assert [x.tolist() for x in own.encode(pa.array(group))] == [plain.encode(t, add_special_tokens=False).ids for t in group]


@lru_cache(maxsize=1)
def _tokenizers():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()), T.WordIds(tokenizer_path())


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, plain = T.WordIds(path), Tokenizer.from_file(path)
    texts = ["Some  words, and\nmore", None, "", "caf\u00e9 \u00a0 x"]
    assert not own.by_word and T.WordIds(tokenizer_path()).by_word
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_rows_of_the_query_against_a_plain_loop(spark):
    """All documents of a whole table, through the file, against the tokenizer on the driver."""
    from strandwork.llm import queries

    sf = "/root/testdata/sf0.001"
    plain, at = _tokenizers()[0], 0
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(queries.op5_token_file(spark, sf).collect(), key=lambda r: r["doc_id"])
    for d, r in zip(docs, got, strict=True):
        ids = [*plain.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
