"""SentencePiece against its library, and exact round trips."""

from llm_tables import SF01, docs, odd  # noqa: F401
import duckdb
import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from sluice.llm import pieces as P
from sluice.llm.queries import SENTENCEPIECE_MODEL


def proto(change=None):
    model = pb.ModelProto()
    with open(SENTENCEPIECE_MODEL, "rb") as f:
        model.ParseFromString(f.read())
    if change:
        change(model)
    return model.SerializeToString()


def as_unigram(model):
    """The library's Viterbi on the same pieces. It adds scores in 32 bits, so
    the two scores of -1e9 are raised to keep its sums exact."""
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)


@pytest.fixture(scope="module")
def both():
    raw = proto(as_unigram)
    return P.Model(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)


def split(ids, ends):
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


ODD = ["Hello  world\n\ttest é 😀", "   a", "x  ", "", "日本語 テスト 😀😀", " x", "ﷺ" * 3, " ", "\n", "a" * 500, "ab " * 300,
       "\x00\x7f", "▁", "𝔘𝔫𝔦"]


def test_ids_equal_the_library(both):
    model, library = both
    texts = ODD + [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF01}/documents.parquet' WHERE length(text) < 2500").fetchall()]
    assert split(*model.encode(texts)) == [library.encode(t) for t in texts]


def test_decoding_equals_the_library(both):
    model, library = both
    rng = np.random.default_rng(0)
    lists = [rng.integers(0, len(model.kind), 40) for _ in range(200)] + [rng.integers(3, 259, 30) for _ in range(200)]
    lists = [x[model.kind[x] != P.UNKNOWN] for x in lists]
    ends = np.cumsum([0, *map(len, lists)])
    assert model.decode(np.concatenate(lists), ends) == [library.decode(x.tolist()) for x in lists]


def brute(model, text):
    """Best score by plain dynamic programming over all pieces."""
    score = {p: s for p, s in zip(model.names, model.score)}
    text, best = model.normalise(text), [0.0]
    for end in range(1, len(text) + 1):
        some = [best[b] + score[text[b:end]] for b in range(max(0, end - 16), end) if text[b:end] in score]
        if text[end - 1] not in score:
            some.append(best[end - 1] + model.unknown_score)
        best.append(max(some))
    return best[-1]


def test_scores_are_the_best_ones():
    raw = proto()
    model, parsed = P.Model(raw), pb.ModelProto.FromString(raw)
    model.names = [p.piece if p.type in (P.NORMAL, P.USER_DEFINED) else object() for p in parsed.pieces]
    for text in ("the thhhe internation", "wwwwxyz zzzq", "ermanenti thesse", "日本 é"):
        ids = split(*model.encode([text]))[0]
        covered = [i for i in ids if model.kind[i] != P.BYTE]
        unknown = sum(c not in model.names for c in model.normalise(text))
        assert sum(model.score[covered]) + unknown * model.unknown_score == pytest.approx(brute(model, text))


def test_round_trip_of_whole_texts(spark, docs, odd):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, "long words " * 30_000)]
    out = P.encode_documents(docs(rows), SENTENCEPIECE_MODEL).collect()
    assert all(r["round_trip"] for r in out)
    assert all(r["decoded"] == r["text"] for r in out if "▁" not in r["text"])
    out = P.encode_documents(odd, SENTENCEPIECE_MODEL)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == 10 and rows[1]["ids"] == [] and rows[1]["decoded"] == "" and out.columns.count("ids") == 1
    assert P.encode_documents(docs([]), SENTENCEPIECE_MODEL).collect() == []


def test_forgetting_changes_nothing(both, monkeypatch):
    model, _ = both
    texts = [f"word{i} other{i * 7}" for i in range(50)]
    want = split(*model.encode(texts))
    monkeypatch.setattr(P, "_MEMORY", 3)
    assert [split(*model.encode([t]))[0] for t in texts] == want
