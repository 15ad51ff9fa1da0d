import math

import public_tokenizers
import pytest
import sentencepiece

from plumbline.llm.sentencepiece import MARK, PENALTY, Model, decode_documents, encode_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "   ", "a", "Hello world.", "  two  spaces ", "line\nbreak\ttab", "é日本語 𝒳 \x00", "don't stop", "supercalifragilistic " * 3, "a" * 300, "‍🙂 mixed é\n",
]


@pytest.fixture(scope="module")
def model():
    return Model(PATH, cache=50)


def best_score(text, pieces, unknown):
    """Plain dynamic programming over every substring of the whole text."""
    marked = MARK + text.replace(" ", MARK) if text else ""
    longest = max(map(len, pieces))
    best = [0.0] + [-math.inf] * len(marked)
    for end in range(1, len(marked) + 1):
        best[end] = best[end - 1] + unknown
        for start in range(max(0, end - longest), end):
            if (s := pieces.get(marked[start:end])) is not None:
                best[end] = max(best[end], best[start] + s)
    return best[-1]


def test_best_path(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    assert model.splits
    for t in TEXTS:
        ids, score = model.encode(t)
        assert score == pytest.approx(best_score(t, pieces, min(pieces.values()) - PENALTY))
        assert model.decode(memoryview(ids).cast("i").tolist()) == t


def test_round_trip_over_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    encoded = encode_documents(docs, PATH)
    assert encoded.filter("not round_trip or size(ids) <> n_ids").isEmpty()
    back = decode_documents(encoded.select("doc_id", "ids"), PATH)
    assert back.join(docs, ["doc_id", "text"]).count() == docs.count()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "a", "x"), (1, "a", "x"), (None, "b ▁", "x")], "doc_id long, text string, ids string")
    got = {(r.doc_id, tuple(r.ids), r.round_trip) for r in encode_documents(df, PATH).collect()}
    assert (1, (), True) in got and sum(1 for d, _, ok in got if d is None and not ok) == 1
    assert encode_documents(df.limit(0), PATH).count() == 0
