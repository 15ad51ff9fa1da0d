"""The registered queries: against SQL where there is some, the pipeline stage by stage."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline
from oracle.check import compare, connect
from plumbline.llm.oracle import ORACLE, QUALITY
from plumbline.llm.queries import QUERIES

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(TINY)


def test_thirteen_operators():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, TINY)
    want = con.sql(ORACLE[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], want.columns, want.fetchall()) == ""


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, as rows."""
    folder, docs, out = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{TINY}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, TINY)
        result.write.parquet(f"{folder}/{i}")
        out[name] = (docs, docs := spark.read.parquet(f"{folder}/{i}"))
    return out


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        assert name == "packing" or after.schema.names == before.schema.names


def test_quality_stage(stages, con):
    before, after = stages["quality_rules"]
    want = con.sql(f"WITH {QUALITY} SELECT doc_id FROM m JOIN v ON m.source IS NOT DISTINCT FROM v.source WHERE NOT base_failed AND NOT rejected").fetchall()
    assert sorted(r.doc_id for r in after.collect()) == sorted(x for x, in want)
    assert after.join(before, before.columns, "left_semi").count() == after.count()


def test_toxicity_stage(stages):
    before, after = stages["toxicity"]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    toxic = {"idiot", "moron", "scum", "trash", "clown", "loser", "stupid", "pathetic", "worthless", "disgusting"}
    for r in before.collect():
        if r.doc_id in gone:
            assert toxic & set(re.findall(r"[a-z]+", r.text.lower()))


def test_line_stage(stages):
    before, after = ([(r.doc_id, r.text, r.n_chars) for r in x.collect()] for x in stages["line_dedup"])
    assert sorted(d for d, *_ in before) == sorted(d for d, *_ in after)
    lines = [x.strip() for _, t, _ in after for x in t.split("\n") if x.strip()]
    assert len(lines) == len(set(lines)) and set(lines) <= {x.strip() for _, t, _ in before for x in t.split("\n")}
    assert all(n == len(t) for _, t, n in after)


def test_near_duplicate_stage(stages):
    """One document stays of each group linked by a similarity of 0.8 of five-word shingles, by brute force."""
    before, after = ([(r.doc_id, r.text) for r in x.collect()] for x in stages["simhash_dedup"])

    def sets(text):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 5 else {tuple(w)}

    own = [sets(t) for _, t in before]
    label = list(range(len(own)))
    while True:
        new = [min(label[j] for j in range(len(own)) if 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j])) for i in range(len(own))]
        if new == label:
            break
        label = new
    groups = defaultdict(list)
    for (d, _), c in zip(before, label):
        groups[c].append(d)
    assert sorted(d for d, _ in after) == sorted(map(min, groups.values()))


def test_packing_stage(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, TINY).count() == stages["packing"][1].count()
