"""Pieces and spans against the sentencepiece library, for the public model and for others made from it in memory."""

import hashlib
import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from sentencepiece import sentencepiece_model_pb2  # noqa: E402

from strandwork.llm import sentence_pieces as sp  # noqa: E402
from strandwork.llm.queries import op11_sentence_pieces, piece_model_path  # noqa: E402

POOL = [*"aA é ﬁ１ Å한국어한　​…ｶﾞ\t\n\x00\x01😀𝒜▁ß.,!㎏", "  ", "   ", " the", " and", "<x>", "<xy>", "</s>", "hello"]
NFKC, BARE, FOLD = "map", "bare", "fold"


def blob(*kinds):
    """The public model with a compiled map, without a dummy prefix, with folded spaces, a suffix, symbols or without byte pieces."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(piece_model_path(), "rb") as f:
        proto.ParseFromString(f.read())
    if NFKC in kinds:
        other = sentencepiece_model_pb2.ModelProto()
        other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.add_dummy_prefix = BARE not in kinds
    proto.normalizer_spec.remove_extra_whitespaces = FOLD in kinds
    proto.trainer_spec.treat_whitespace_as_suffix = "suffix" in kinds
    if "no bytes" in kinds:
        proto.trainer_spec.byte_fallback = False
        for p in proto.pieces:
            if p.type == proto.SentencePiece.BYTE:
                p.type = proto.SentencePiece.NORMAL
    if "symbols" in kinds:
        for s in ("<x>", "<xy>"):
            proto.pieces.add(piece=s, score=0, type=proto.SentencePiece.USER_DEFINED)
    return proto.SerializeToString()


@pytest.mark.parametrize("kinds", [(), (NFKC,), (FOLD,), (NFKC, FOLD), (NFKC, BARE), (NFKC, "symbols"), (NFKC, "symbols", FOLD), (NFKC, FOLD, "suffix"), (NFKC, "no bytes")])
def test_ids_and_spans_of_arbitrary_texts(kinds, monkeypatch):
    monkeypatch.setattr(sp, "PART_LETTERS", 5)
    own, r = sp.PieceModel(blob(*kinds)), random.Random(str(kinds))
    for _ in range(600):
        text = "".join(r.choice(POOL) for _ in range(r.randint(0, 14)))
        ids, begins, ends = own.encode(text.encode())
        wanted = own.whole.encode(text, return_type="proto").pieces
        assert ids.tolist() == own.whole.encode(text, add_eos=True)
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == [*((p.begin, p.end) for p in wanted), (len(text.encode()),) * 2]


def test_bytes_that_are_no_utf8_are_one_letter_each():
    own = sp.PieceModel(blob())
    ids, begins, ends = own.encode(b"a\xff\xe2\x82 b")
    assert ids.tolist() == own.whole.encode("a��� b", add_eos=True)
    assert own.encode(b"\xe2")[1:][1].tolist()[-2:] == [1, 1] and begins.tolist() == sorted(begins.tolist()) and ends.max() == 6


def test_spans_give_the_text_back_and_long_texts_are_whole():
    own, r = sp.PieceModel(blob()), random.Random(4)
    text = " ".join(r.choice(["word", "ß", "한국", "x" * 30, "", "１"]) for _ in range(60_000))
    ids, begins, ends = own.encode(text.encode())
    data = text.encode()
    assert b"".join(data[b:e] for b, e in zip(begins, ends, strict=True)) == data
    assert ids.tolist() == own.whole.encode(text, add_eos=True) and own.whole.decode(ids.tolist()) == text


def test_rows_of_every_kind(spark, edge, edge_rows, nothing):
    path, whole = piece_model_path(), sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    table = sp.encoded(edge, path)
    got = table.withColumn("back", sp.decoded("ids", path)).collect()
    text = {tuple(whole.encode(r[1] or "", add_eos=True)): r[1] or "" for r in edge_rows}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r["ids"])) for r in got) == sorted((r[0] is None, r[0] or 0, tuple(whole.encode(r[1] or "", add_eos=True))) for r in edge_rows)
    assert all(r["back"] == text[tuple(r["ids"])] for r in got)
    assert sp.encoded(nothing, path).count() == 0
    named = sp.encoded(edge.selectExpr("cast(doc_id as string) as name", "text as body", "key"), path, "name", "body", end=False)
    assert named.columns == ["name", "ids", "begins", "ends"] and named.where("size(ids) = 0").count() == 3


def test_query_on_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    whole = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = whole.encode(r["text"] or "", add_eos=True)
        wanted[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(whole.decode(ids)), len((r["text"] or "").encode()))
    assert {r[0]: tuple(r)[1:] for r in op11_sentence_pieces(spark, sf).collect()} == wanted
