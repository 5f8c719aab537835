"""Unigram and byte-pair models with several normalisers against the library.

The models are written here piece by piece; none is trained.
"""

import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from sentencepiece import sentencepiece_model_pb2 as pb  # noqa: E402

from cohortloom.llm import piece_fst  # noqa: E402
from cohortloom.llm.normaliser import character_map  # noqa: E402

WORDS = ["▁the", "▁th", "▁t", "the", "he", "th", "in", "ing", "▁in", "an", "and", "▁and", "er", "re", "on", "▁on", "st", "est",
         "▁▁", "é", "fi", "...", "..", "12", "▁1", "ab", "bc", "abc", "cab", "ca"]
TEXTS = [
    "", " ", "   ", "the thing in the end", "  the  cab  ", "and\tthe\nand", "ﬁn the ①② ½ ＡＢＣ", "ést café Å",
    "the​in and　on", "漢字 😀 the", "abcabcabcab", "à́b", "▁the▁", "the ▁", "¨ the", "x" * 400, "the ing " * 300,
    "\x01\x02 on", "​", "......", "Ⅷ ㎏ ﷺ",
]


def model(path, kind, rule, fallback, squeeze, prefix=True, seed=1):
    """A small model of the given kind in a file."""
    draw = random.Random(seed)
    proto = pb.ModelProto()

    def add(piece, score=0.0, type_=pb.ModelProto.SentencePiece.NORMAL):
        proto.pieces.add(piece=piece, score=score, type=type_)

    add("<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN)
    add("<s>", 0.0, pb.ModelProto.SentencePiece.CONTROL)
    add("</s>", 0.0, pb.ModelProto.SentencePiece.CONTROL)
    if fallback:
        for byte in range(256):
            add(f"<0x{byte:02X}>", 0.0, pb.ModelProto.SentencePiece.BYTE)
    singles = ["▁", *"abcdefghinorst.12"]
    ranked = draw.sample(WORDS, len(WORDS))
    for at, piece in enumerate([*ranked, *singles]):
        add(piece, -float(at) if kind == "BPE" else -2.0 - draw.random() * (6 if piece in WORDS else 9))
    proto.trainer_spec.model_type = getattr(pb.TrainerSpec, kind)
    proto.trainer_spec.byte_fallback = fallback
    proto.trainer_spec.unk_id, proto.trainer_spec.bos_id, proto.trainer_spec.eos_id = 0, 1, 2
    spec = proto.normalizer_spec
    if rule != "identity":
        spec.precompiled_charsmap = charsmap(rule)
    spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = rule, prefix, squeeze, True
    path.write_bytes(proto.SerializeToString())
    return str(path)


def charsmap(rule):
    own = pb.ModelProto()
    own.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    return own.normalizer_spec.precompiled_charsmap


def mixed_texts(count, seed):
    draw = random.Random(seed)
    parts = ["the", "thing", " ", "  ", "and", "cab", "\n", "é", "é", "ﬁ", "12", "...", "漢", "　", "on", "est", "q", "▁", "①"]
    return ["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(count)]


@pytest.mark.parametrize("kind", ["UNIGRAM", "BPE"])
@pytest.mark.parametrize("rule, squeeze, prefix", [
    ("identity", False, True), ("identity", True, True), ("nmt_nfkc", True, True), ("nfkc_cf", False, True), ("nmt_nfkc", True, False),
])
@pytest.mark.parametrize("fallback", [True, False])
def test_pieces_equal_the_library(tmp_path, kind, rule, squeeze, prefix, fallback):
    path = model(tmp_path / "m.model", kind, rule, fallback, squeeze, prefix)
    known = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = TEXTS + mixed_texts(300, 7)
    ids, counts = piece_fst.PieceEncoder(path).encode([None, *texts])
    assert counts[0] == 0
    at = 0
    for text, count in zip(texts, counts[1:]):
        assert ids[at : at + count].tolist() == known.encode(text), text[:80]
        at += count


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_maps_are_read_whole(rule):
    found = character_map(charsmap(rule))
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, remove_extra_whitespaces=False,
                                                       escape_whitespaces=False)
    assert len(found) > 1000 and all(normaliser.normalize(key) == new for key, new in found.items())
    assert character_map(b"") == {}


def test_unigram_documents_through_spark(spark, tmp_path):
    path = model(tmp_path / "m.model", "UNIGRAM", "identity", True, False)
    known = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = TEXTS + mixed_texts(50, 3)
    rows = [(i, t) for i, t in enumerate([None, *texts, *texts[:3]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in piece_fst.encode_pieces(docs, model=path, with_ids=True).collect()}
    assert len(got) == len(rows) and got[0].n_pieces == 0
    for i, text in rows[1:]:
        assert got[i].ids == known.encode(text) and got[i].round_trip == (known.decode(got[i].ids) == text)
    assert piece_fst.encode_pieces(docs.limit(0), model=path).count() == 0


def test_models_that_are_not_compiled_are_refused(tmp_path):
    path = tmp_path / "m.model"
    model(path, "UNIGRAM", "identity", True, False)
    proto = pb.ModelProto()
    proto.ParseFromString(path.read_bytes())
    proto.trainer_spec.model_type = pb.TrainerSpec.WORD
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        piece_fst.transducer(str(path))
