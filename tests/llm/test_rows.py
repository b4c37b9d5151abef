"""Row identity: repeated rows, rows of one doc_id with different texts, rows without one."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from clicklens.llm import decontaminate, jaccard, toxicity  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_key string, id int"
WINDOW = "one two three four five six seven eight nine ten"
CLEAN = "nothing of that kind is said anywhere in this text"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "clash", 1) for d, t in rows], SCHEMA).repartition(3)


def items(spark):
    return spark.createDataFrame([("i1", WINDOW)], "item_id string, text string")


def test_decontamination_by_id_and_text(spark):
    rows = [(1, WINDOW), (1, CLEAN), (2, f"a {WINDOW} b"), (2, f"a {WINDOW} b"), (None, WINDOW), (None, CLEAN), (3, None), (None, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_hit) for r in decontaminate.contamination(frame(spark, rows), items(spark)).collect()), key=str)
    assert got == sorted([(1, 10, 10), (1, 10, 0), (2, 12, 10), (2, 12, 10), (None, 10, 10), (None, 10, 0), (3, 0, 0), (None, 0, 0)], key=str)


def test_jaccard_by_id_and_text(spark):
    """Two texts of one id link by their own sets; a row without id bridges two others."""
    base = [f"w{i}" for i in range(62)]
    one, other = " ".join(base), " ".join(f"v{i}" for i in range(40))
    left, middle, right = base + ["l1", "l2", "l3", "l4", "l5", "l6"], base + ["l1", "l2"], ["y1", "y2"] + base[2:] + ["l1", "l2"]
    rows = [(5, one), (5, other), (9, other), (4, one + " end"), (4, one + " end"), (8, "alone"), (8, None), (None, None), (None, "single")]
    got = sorted(map(tuple, jaccard.jaccard_components(frame(spark, rows), unnamed=True).collect()), key=str)
    assert got == sorted([(5, 60, 4), (5, 38, 5), (9, 38, 5), (4, 61, 4), (4, 61, 4), (8, 1, 8), (8, 0, 8), (None, 0, None),
                          (None, 1, None)], key=str)
    chain = [(7, " ".join(left)), (None, " ".join(middle)), (3, " ".join(right))]
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for _, t in chain)]
    links = lambda a, b: 100 * len(a & b) >= 90 * len(a | b)
    assert links(sets[0], sets[1]) and links(sets[1], sets[2]) and not links(sets[0], sets[2])
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(frame(spark, chain), unnamed=True).collect()}
    assert got == {7: 3, None: 3, 3: 3}
    plain = {r.doc_id: r.component_id for r in jaccard.jaccard_components(frame(spark, chain)).collect()}
    assert plain == {7: 7, None: None, 3: 3}


def test_training_takes_one_row_of_an_id(spark, monkeypatch):
    """5,000 repeated rows of one id: what reaches the driver keeps its bound."""
    rows = [(7, "you worthless idiot scum")] * 5000 + [(i, f"text number {i} of many") for i in range(100, 400)]
    labels = spark.createDataFrame([(7, 1), *((i, 0) for i in range(100, 110))], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "LABELLED", 8)
    monkeypatch.setattr(toxicity, "TRAINED", 20)
    fit = toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: seen.append(len(x)) or fit(x, y))
    model = toxicity.train(frame(spark, rows), labels)
    assert 0 < seen[0] <= 20
    assert {r.predicted for r in toxicity.score(frame(spark, rows[:3]), model).collect()} == {1}


def test_pipeline_stages_by_row(spark, tmp_path):
    import corpus_pipeline

    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, WINDOW), (1, CLEAN), (None, WINDOW), (2, base), (3, base + " x"), (None, base + " y"), (None, "lonely text without a number"),
            (4, None), (None, None), (5, ""), (6, base)]
    docs = frame(spark, rows)
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2
    assert kept.where(F.col("text") == CLEAN).count() == 1
    near = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert near.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=str) == sorted(
        [(1, WINDOW), (1, CLEAN), (2, base), (None, "lonely text without a number"), (4, None), (None, None), (5, "")], key=str)
    empty = docs.limit(0)
    assert corpus_pipeline.drop_near_duplicates(spark, empty, "").count() == 0
    assert corpus_pipeline.redact_secrets(spark, empty, "").count() == 0 and corpus_pipeline.encode(spark, empty, "").count() == 0
