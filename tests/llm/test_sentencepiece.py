import math
import random

import pytest
from sentencepiece import sentencepiece_model_pb2

from clickloom.llm import sentencepiece as sp
from clickloom.llm.queries import PIECES

TEXTS = [
    "The quick brown fox.", "", "  two  spaces ", "a\tb\n\nc \nd", "\n", "\nstart", "日本語テスト 😀", "Straße, naïve; x=1.",
    "end\n", "x" * 300 + " y", "u+2581: a▁b", "http://a.b/c?d=e&f", "a", " ", "12.5% of 3,000", "(e.g.) [1] {2}", "  é̀",
]


def proto():
    made = sentencepiece_model_pb2.ModelProto()
    made.ParseFromString(sp.read_model(PIECES))
    return made


def plain(text, pieces, unknown, byte_ids):
    """Viterbi over the whole text, each piece tried at each place."""
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    best, back = [0.0] + [-math.inf] * len(s), [None] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        for size in range(min(end, 16), 0, -1):
            p = s[end - size : end]
            if p in pieces and best[end - size] + pieces[p][1] > best[end]:
                best[end], back[end] = best[end - size] + pieces[p][1], (end - size, pieces[p][0])
        if s[end - 1] not in pieces and best[end - 1] + unknown > best[end]:
            best[end], back[end] = best[end - 1] + unknown, (end - 1, -1)
    out, n = [], len(s)
    while n:
        start, piece = back[n]
        out += [piece] if piece >= 0 else [byte_ids[b] for b in reversed(s[start:n].encode())]
        n = start
    return out[::-1]


@pytest.fixture(scope="module")
def model():
    return sp.Model(sp.read_model(PIECES))


@pytest.fixture(scope="module")
def pieces():
    return {p.piece: (k, p.score) for k, p in enumerate(proto().pieces) if p.type in (1, 4)}


def test_every_path_equals_plain_viterbi(model, pieces):
    rng = random.Random(2)
    some = [p.replace("▁", " ") for p in pieces]
    texts = TEXTS + ["".join(rng.choice(some) for _ in range(rng.randint(1, 30))) for _ in range(150)]
    want = [plain(t, pieces, model.unknown_score, model.byte_ids) for t in texts]
    assert [model.encode(t) for t in texts] == want
    ids, counts = model.encode_all(texts)
    at = 0
    for own, n in zip(want, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == own
        at += n


def test_decoding_gives_the_text_back(model):
    for t in TEXTS:
        assert model.decode(model.encode(t)) == t.replace("▁", " ")


def test_longer_last_piece_wins_a_tie():
    made = proto()
    del made.pieces[259:]
    for piece, score in (("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)):
        made.pieces.add(piece=piece, score=score)
    model = sp.Model(made.SerializeToString())
    assert [model.pieces[i] for i in model.encode("ab")] == ["▁", "ab"]
    assert [model.pieces[i] for i in model.encode_all(["ab"])[0]] == ["▁", "ab"]


def test_pieces_over_spaces_and_lines_move_the_cuts():
    made = proto()
    del made.pieces[259:]
    for piece, score in (("▁", -3.0), ("a", -3.0), ("b", -3.0), ("a▁b", -1.0), ("a\nb", -1.0)):
        made.pieces.add(piece=piece, score=score)
    model = sp.Model(made.SerializeToString())
    assert not model.cut_at_words
    assert [model.pieces[i] for i in model.encode_all(["a b"])[0]] == ["▁", "a▁b"]
    assert [model.pieces[i] for i in model.encode_all(["a\nb"])[0]] == ["▁", "a\nb"]


def test_without_byte_pieces_unknown_ids():
    made = proto()
    del made.pieces[259:], made.pieces[3:]
    made.pieces.add(piece="▁", score=-1.0)
    model = sp.Model(made.SerializeToString())
    assert model.encode("ab") == [3, 0, 0] == model.encode_all(["ab"])[0].tolist()


def test_frames(odd, nothing, model):
    got = sp.round_trip(odd, PIECES).collect()
    assert len(got) == odd.count() and all(r.lossless for r in got)
    assert all(r.n_tokens == len(r["ids"]) for r in got)
    texts = {r.doc_id: r.text for r in sp.decode(sp.encode(odd, PIECES), PIECES).collect()}
    assert texts[5] == "Ünïcode ſtrange İ 😀 日本語   words here" and texts[3] == ""
    assert sp.round_trip(nothing, PIECES).collect() == []
