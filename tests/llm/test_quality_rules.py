import random
import re
from collections import Counter

from plumbline.llm.quality_rules import host_verdicts, passing_quality, quality_verdicts, with_measures

SCHEMA = "doc_id long, text string, lang string, source string, host string, failures long"


def measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(win)
    covered = {i + o for i, x in enumerate(win) if many[x] > 1 for o in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_measures_against_brute_force(spark):
    random.seed(3)
    texts = [None, "", " \n ", "a", "a a", "a a a", "a a a a", "a b c a b c", "a b c x a b c", "x\ny\nx\n\n x\nx", "#a|<>& é 日 \x85 \xa0b", "a b\tc\x0bd e"]
    texts += [" ".join(random.choice("abcd") for _ in range(random.randint(1, 80))) for _ in range(60)]
    texts += ["\n".join(random.choice(["aa bb", "cc", " ", "$ %"]) for _ in range(9)), "w " * 3000 + "z"]
    df = with_measures(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    for r in df.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(r.text), r.text


GOOD = " ".join(f"word{i}" for i in range(60))


def rows():
    out = [(i, GOOD + f" {i}", "en", "good", "h", 1) for i in range(40)]
    out += [(100 + i, "bad", "en", "bad", "h", 1) for i in range(40)] + [(199, GOOD, "en", "bad", "h", 1)]
    out += [(200, "bad", "en", "tiny", "h", 1), (201, GOOD, None, None, "h", 1), (201, GOOD, None, None, "h", 1), (None, None, "en", "good", "h", 1)]
    return out


def test_host_verdicts_reach_documents(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = {(r.doc_id, r.host): r for r in quality_verdicts(df).collect()}
    assert not got[199, "bad"].kept and not got[199, "bad"].base_failed  # the host is out
    assert got[0, "good"].kept and got[201, None].kept
    assert not got[None, "good"].kept and got[None, "good"].base_failed
    assert got[199, "bad"].host_rate > 0.9 > got[200, "tiny"].host_rate  # one document does not condemn a host as forty do
    kept = passing_quality(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(40), 201, 201]


def test_each_rule_decides_and_counts_for_the_host(spark):
    texts = {
        1: GOOD, 2: GOOD + " ######", 3: GOOD + " #######", 4: "abc " + " ".join(chr(97 + i // 26) + chr(97 + i % 26) for i in range(80)),
        5: " ".join(f"longerwords{i}" for i in range(60)), 6: GOOD + "\n" + "\n".join(["same line of text"] * 5), 7: None, 8: "",
        9: " ".join(f"word{i}" for i in range(60)) + "\na\na\nb\nc",
    }
    docs = [(i, t, "en", "mixed" if i != 1 else "clean", "h", 1) for i, t in texts.items()]
    got = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(docs, SCHEMA)).collect()}
    # six symbols among 61 words are within a tenth, seven are not; four of six lines repeat in 6, one of five in 9
    assert {i for i, r in got.items() if r.failed} == {3, 4, 5, 6, 7, 8}
    assert {i for i, r in got.items() if r.base_failed} == {7, 8}
    assert got[2].host_rate > 0.5 and not got[2].kept and not got[9].kept and got[1].kept


def test_empty_and_uniform(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_verdicts(empty).count() == 0 and passing_quality(empty).count() == 0
    same = spark.createDataFrame([("a", False), ("b", False)], "host string, base_failed boolean")
    assert {r.host_rate for r in host_verdicts(same).collect()} == {0.0}
