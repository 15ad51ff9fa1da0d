import numpy as np

from plumbline.llm.toxicity import CATEGORIES, Training, apply_chain, fit_chain, toxicity, train, without_toxic, words

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    seen, held = labels.filter("doc_id % 2 = 0"), {r.doc_id: r.toxic for r in labels.filter("doc_id % 2 = 1").collect()}
    got = toxicity(docs, seen, training_docs=docs).select("doc_id", "toxic").collect()
    pairs = [(held[r.doc_id], r.toxic) for r in got if r.doc_id in held]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.95
    assert sum(b and not a for a, b in pairs) <= 0.005 * len(pairs)  # clean documents are left alone
    marked = {w for group in CATEGORIES.values() for w in group}
    found = [r.doc_id for r in docs.select("doc_id", "text").collect() if held.get(r.doc_id) and words(r.text) & marked]
    verdict = {r.doc_id: r.toxic for r in got}  # labels on documents without any such word are noise
    assert sum(verdict[d] for d in found) >= 0.95 * len(found) > 100


def test_later_models_use_earlier_probabilities():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (2000, 30)).astype(np.float32)
    first = x[:, 0] * x[:, 1]
    y = np.c_[x[:, 0], first, x[:, 0]]
    how = Training()
    models = fit_chain(x, y, np.arange(2000) % how.folds, how)
    assert [len(w) for w, _ in models] == [30, 31, 32]
    p = apply_chain(x, models)
    assert p.shape == (2000, 3) and ((p[:, 0] > 0.5) == (x[:, 0] > 0)).mean() > 0.99


def test_odd_input(spark):
    schema = "doc_id long, text string, toxic string, p string"
    own = ["".join(chr(97 + int(d)) * 3 for d in str(i)) for i in range(80)]  # a word of each document's own
    rows = [(i, f"you idiot and moron {own[i]}" if i % 4 == 0 else f"fine words {own[i]}", "x", "y") for i in range(80)]
    docs = spark.createDataFrame([*rows, (80, None, "x", "y"), (None, "idiot", "x", "y"), (80, "", "x", "y")], schema)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)] + [(999, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == 83 and all((r.doc_id % 4 == 0) == r.toxic for r in got if r.doc_id is not None and r.doc_id < 80)
    assert all(not r.toxic for r in got if r.doc_id == 80)
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.filter("text like '%moron%'").isEmpty()
    assert toxicity(docs.limit(0), labels).count() == 0
    none = toxicity(docs, labels.limit(0)).collect()
    assert all(r.kept and r.p_toxic == 0.5 for r in none)
    assert train(docs, labels.limit(0)).vocabulary == {}


def test_rare_toxic_words_are_found(spark):
    """One toxic label in a hundred, none of its words in half a percent of the labelled documents."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(8000):
        toxic = i % 100 == 0
        text = " ".join("plain" + "".join(chr(97 + int(c)) for c in str(k)) for k in rng.integers(0, 300, 20))
        rows.append((i, text + (" " + ["idiot", "vermin", "trash", "gorblax"][i // 100 % 4] if toxic else "")))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.toxic for r in toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    found = [got[i] for i, t in labels if t]
    assert sum(found) >= 0.95 * len(found) and sum(got[i] for i, t in labels if not t) <= 40
