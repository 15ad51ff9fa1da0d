import random

from plumbline.llm.warc import damaged_places, fixity_audit, height_for

SCHEMA = "page_id long, url string, html string, row string, at string"


def test_finds_every_difference_and_no_more(spark):
    rnd = random.Random(0)
    for n in (0, 1, 17, 300):
        a = [(i, f"h{i}") for i in range(n)]
        b = [(i, "other" if rnd.random() < 0.05 else h) for i, h in a if rnd.random() > 0.05] + [(n, "extra")]
        frames = [spark.createDataFrame(x, "ordinal long, hash string") for x in (a, b)]
        got = {(r.ordinal, r.expected, r.found) for r in damaged_places(*frames, n + 1).collect()}
        a, b = dict(a), dict(b)
        assert got == {(i, a.get(i), b.get(i)) for i in a.keys() | b.keys() if a.get(i) != b.get(i)}
    assert [height_for(x) for x in (0, 1, 2, 16, 17, 256, 257)] == [0, 0, 1, 1, 2, 2, 3]


def test_sound_replicas_and_odd_pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>", "r", "a") for i in range(1100)] + [(None, None, None, "r", "a"), (5, "http://x/5", "<p>5</p>", "r", "a"), (7, None, "é" * 9, "r", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    got = fixity_audit(df, replica=F.col("record")).collect()
    assert len(got) == len(rows) and {r.status for r in got} == {"intact"}
    at = {}
    for r in sorted(got, key=lambda r: (r.file_id, r.record_offset)):
        assert r.record_offset == at.get(r.file_id, 0)
        at[r.file_id] = r.record_offset + r.record_length
    assert set(at) == {0, 1}
    kinds = {r.status for r in fixity_audit(df).collect()}
    assert kinds == {"intact", "corrupt", "missing"}
    assert fixity_audit(df.limit(0)).count() == 0
