import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plumbline.llm.packing import Limits, WordCache, pack_documents, pack_examples

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", " lead", "trail ", "a  b", "a \n b", "x  y z", "don't. you're!! it's,", "<|endoftext|> a b", "a<|endoftext|>b c", "tab\t x",
    "é́ ü. 日本語. ١٢٣, ²! a", "\x1c x y\x1c z", "foo\x85 bar", "!!! ... ?", "a. b.c d..", "'s 't. x's.", "ª. º. ⅷ. x", "हिन्दी. x", "w " * 900,
]


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(PATH)
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_words_have_the_tokenizers_ids(ids):
    words = WordCache(PATH)
    for text in ODD:
        assert words(text) == ids(text)[:-1].tobytes(), text


def test_long_white_space_has_the_tokenizers_ids(ids):
    """The encoder's pattern gives up on it; at any place in the text, in any mix."""
    encode = WordCache(PATH)
    for n in (1, 499, 500, 501, 998, 999, 1500, 1_200_000):
        for text in ("a" + "\n" * n + "b", " x" * 123 + " \t\n" * (n // 3) + " y z", "\u2003" * n, "a b" + " " * n):
            assert encode(text) == ids(text)[:-1].tobytes(), (n, text[:20])


def test_nothing_is_kept_from_text_to_text(ids):
    """Words that never come again cost no cache, and split words, marks and digits have the tokenizer's ids."""
    rng, encode = np.random.default_rng(5), WordCache(PATH)
    letters = np.array([*"abcdeéñABC01.,'!? \n\t语"])
    for _ in range(300):
        text = "".join(rng.choice(letters, 200))
        assert encode(text) == ids(text)[:-1].tobytes(), text
    assert not isinstance(encode, dict)


def check(rows, ids, texts, limits):
    placed, cut = defaultdict(list), defaultdict(list)
    for r in rows:
        doc = ids(texts[r.doc_id])
        assert r.doc_tokens == len(doc) and zlib.crc32(doc[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert list(r.ids) == doc[r.start : r.start + r.length].tolist()
        placed[r.sequence_id].append((r.offset, r.length))
        cut[r.doc_id].append((r.start, r.length))
    for pieces, whole in [*((p, None) for p in placed.values()), *((c, len(ids(texts[d]))) for d, c in cut.items())]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert whole is None or at == whole
    assert set(cut) == set(texts)
    assert all(len(p) <= limits.segments and sum(n for _, n in p) <= min(limits.tokens, limits.loss) for p in placed.values())
    return [sum(n for _, n in p) for p in placed.values()]


@pytest.mark.parametrize("limits", [Limits(), Limits(tokens=64, segments=4, loss=64, pool=8), Limits(tokens=64, segments=8, loss=50, pool=5, min_piece=2)])
def test_documents(spark, ids, limits):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate([None, *ODD])]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, offset string").coalesce(2)
    filled = check(pack_documents(df, PATH, limits=limits, with_ids=True).collect(), ids, dict(rows), limits)
    most = min(limits.tokens, limits.loss)
    assert len(filled) <= 1.1 * sum(filled) / most + 4 or limits.segments < 8  # little padding, unless segments are what is short


def test_documents_without_rows_or_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c")], "doc_id long, text string")
    assert sorted((r.doc_id for r in pack_documents(df, PATH).collect()), key=repr) == [1, 1, None]
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_examples_keep_all_limits(spark):
    rng = np.random.default_rng(0)
    data = [(i, int(t), int(t * rng.random())) for i, t in enumerate(rng.integers(1, 900, 300))] + [(900, 5000, 1), (901, 10, 3000), (902, None, None)]
    limits = Limits(tokens=1000, segments=6, loss=400, pool=64)
    got = pack_examples(spark.createDataFrame(data, "key long, tokens long, loss long").coalesce(1), limits).collect()
    assert sorted(r.key for r in got) == sorted(d[0] for d in data)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append(r)
    assert sorted(r.key for r in bins.pop(None)) == [i for i, t, x in data if (t or 0) > 1000 or (x or 0) > 400]
    for b in bins.values():
        assert len(b) <= 6 and sum(r.tokens for r in b) <= 1000 and sum(r.loss for r in b) <= 400
    fits = [d for d in data[:300] if d[2] <= 400]
    least = max(sum(d[1] for d in fits) / 1000, sum(d[2] for d in fits) / 400, len(fits) / 6)
    assert len(bins) <= 1.25 * least + 2
