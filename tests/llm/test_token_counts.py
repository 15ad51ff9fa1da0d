import random

import pytest
from tokenizers import Tokenizer

from plumbline.llm.queries import tokenizer_path
from plumbline.llm.token_counts import TokenCounter, token_counts

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    return lambda t: len(made.encode(t or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def own():
    return TokenCounter(PATH)


def texts(seed, n):
    """Words, marks, contractions, digits, white space of all kinds and characters from all over Unicode."""
    rnd = random.Random(seed)
    bits = ["the", " The", "'s", "'ll", "!!", "1234", " ", "  ", "\n", "\r\n", "\t", " ", "　", "\x1c", "é", "naïve", "Straße", "中文字", "<|endoftext|>", "<|endof", "´", "́", "ǅ", "½", "٣"]
    for _ in range(n):
        yield "".join(rnd.choice([rnd.choice(bits), chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0xD800), rnd.randrange(0xE000, 0x1FFFF)]))]) for _ in range(rnd.randrange(30)))


def test_random_texts(own, library):
    for t in texts(1, 4000):
        assert own(t) == library(t), repr(t)


def test_small_cache_and_parts(library):
    small = TokenCounter(PATH)
    small.CACHE, small.PART, small.LONGEST = len(small.whole) + 5, 7, 6
    for t in texts(2, 500):
        assert small(t) == library(t), repr(t)
    assert len(small) <= small.CACHE
    prose = "Ein längerer Satz, mit Wörtern; and one more, isn't it? " * 40
    assert small(prose) == library(prose) and sum(1 for _ in small.parts(prose)) > 40


def test_whole_tokens_are_proved(own, library):
    assert len(own.whole) > 49_000 and all(library(t) == 1 for t in random.Random(3).sample(sorted(own.whole), 2000))
    assert " the" in own.whole and "\nthe" not in own.whole and "<|endoftext|>" not in own.whole


def test_long_texts(own, library):
    for t in ("a" * 200_000, "word " * 200_000, " " * 100_000, "é" * 50_000, "\n" * 50_000 + "x"):
        assert own(t) == library(t)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        TokenCounter(tokenizer_path("word_bpe_49k.json"))


def test_frame(spark, library):
    rows = [(1, "Hello world", 5, "x"), (2, None, 6, "y"), (3, "", 7, "z"), (None, "é <|endoftext|> ", 8, None), (1, "Hello world", 5, "x"), (4, "word " * 600, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, over_limit string")
    got = token_counts(df, PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), library(t), library(t) > 512) for i, t, *_ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts(df, PATH, limit=1).filter("over_limit").count() == 4
    assert token_counts(df.limit(0), PATH).collect() == []


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs, PATH).collect()}
    assert got == {r.doc_id: (len((r.text or "").encode()), library(r.text)) for r in docs.collect()}
