import hashlib
import re
from collections import defaultdict

import pytest

from plumbline.llm.exact_dedup import exact_duplicates

SCHEMA = "doc_id long, text string, level string, name string, row string"  # names the operator uses inside


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    groups = defaultdict(list)
    for i, t in enumerate(norm):
        groups[t].append((rows[i][0] is None, rows[i][0] or 0, i))
    out = []
    for i, t in enumerate(norm):
        first = min(groups[t])
        out.append((rows[i][0], None if first[0] else first[1], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_against_brute_force(spark, size):
    texts = ["", " ", "\t\n ", None, "abcabc", "abc abc", "abc\t abc", "abc abc ", "aaaa", "aaa", "aaaaaaa", "abcabcabcabd", "é" * 7, "é" * 6 + "e", "日本 語", "日本\n語", "𝒳y" * 9, "x" * 5000]
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts + texts[3:12])] + [(3, None, "x", "y", "z"), (None, "abcabc", "x", "y", "z"), (None, "only", "x", "y", "z"), (4, "abcabc", "x", "y", "z")]
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), block_chars=size).collect()
    want, groups = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
