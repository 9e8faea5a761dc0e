import random
import struct

import pytest
import sentencepiece

from basketry.llm import sentencepiece_codec as S


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def block(number, raw):
    return varint(number << 3 | 2) + varint(len(raw)) + raw


def unigram_file(path, pieces, byte_fallback=False):
    """A model with given pieces and scores; nothing is trained."""
    body = b""
    for piece, score, kind in pieces:
        body += block(1, block(1, piece.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score)
                      + varint(3 << 3) + varint(kind))
    trainer = varint(3 << 3) + varint(1) + varint(35 << 3) + varint(int(byte_fallback))
    normal = block(1, b"identity") + varint(3 << 3) + varint(1) + varint(4 << 3) + varint(0)
    path.write_bytes(body + block(2, trainer) + block(3, normal))
    return str(path)


TEXTS = ["", " ", "  Hello  world\n\ttest　é ﬁ 中文龘", "a" * 300, "\n\n\n x", "emoji 😀😀", "<s> </s> <0x0A> <unk>",
         "naïve café — “quoted” … 3.14159", "  a  b   c    d        e                   f"]


def noise(n, letters="abcdeot  hinsrßé.,'\n01"):
    rng = random.Random(n)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_bpe_ids_equal_the_library():
    codec = S.Codec(S.load_model(S.DEFAULT_MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=S.DEFAULT_MODEL)
    for t in TEXTS + noise(800):
        ids = codec.encode(t)
        assert ids == library.encode(t), repr(t)
        assert codec.decode(ids) == t == library.decode(ids)


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_unigram_ids_equal_the_library(tmp_path, byte_fallback):
    rng = random.Random(7)
    letters = "abcdehinorst"
    pieces = {"▁": -4.0} | {c: -6.0 - rng.random() for c in letters}
    for _ in range(300):
        p = "".join(rng.choice(letters) for _ in range(rng.randint(2, 5)))
        pieces[("▁" if rng.random() < 0.4 else "") + p] = -7.0 - 4 * rng.random()
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    path = unigram_file(tmp_path / "u.model", listed + [(p, s, 1) for p, s in pieces.items()], byte_fallback)
    codec = S.Codec(S.load_model(path))
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for t in noise(500, letters + "   é\n") + ["", "aaaa", "éé a"]:
        ids = codec.encode(t)
        assert ids == library.encode(t), repr(t)
        if byte_fallback:
            assert codec.decode(ids) == t


def test_dataframe_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, "dup"), (3, "dup"), (50, "long text " * 20_000)]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, token_ids int")
    got = S.encode_documents(df)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got.collect())
    back = sorted(((r.doc_id, r.text) for r in S.decode_documents(got).collect()), key=str)
    assert back == sorted(((d, t or "") for d, t in rows), key=str)
    assert S.encode_documents(df.limit(0)).count() == 0
