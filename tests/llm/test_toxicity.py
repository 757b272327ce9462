import random

import numpy as np
import pytest

from millwright.llm import toxicity

BAD = ["blorf", "snarg", "quelt"]
WORDS = [f"w{n}" for n in range(200)]


def corpus(n, seed):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = draw.choices(WORDS, k=draw.randint(5, 80))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(draw.choice([1, 1, 4])):
                # every second one is a word of its own behind a common beginning
                words.insert(draw.randrange(len(words)), draw.choice(BAD) if draw.random() < 0.5 else f"zorkl{draw.randint(0, 9999)}")
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents):
    docs, said = corpus(1500, 1)
    rows = toxicity.report(documents(*docs), labelled(spark, [x for x in said if x[0] < 750])).collect()
    held = [r for r in rows if r.doc_id >= 750]
    assert len(rows) == 1500 and len(held) == 750
    assert sum(r.rejected != (r.doc_id % 5 == 0) for r in held) <= 7
    bad = [r for r in held if r.rejected]
    assert all(0 <= r.severity <= 2 for r in held) and {r.grade for r in bad} == {1, 2}


def test_more_indications_are_more_severe(spark, documents):
    docs, said = corpus(600, 2)
    more = [(9001, "w1 w2"), (9002, "w1 blorf"), (9003, "w1 blorf snarg quelt zorkl5"), (9004, None), (9004, None)]
    rows = toxicity.report(documents(*docs, *more), labelled(spark, said)).collect()
    by_id = {r.doc_id: r.severity for r in rows}
    assert len(rows) == 605
    assert by_id[9004] <= by_id[9001] < by_id[9002] < by_id[9003]


def test_thresholds_are_ordered_and_weights_shared():
    draw = np.random.default_rng(0)
    marks = draw.random((400, 6)) < 0.4
    score = marks @ np.array([3.0, 2.0, 0, 0, 0, -1.0]) + draw.logistic(size=400) * 0.3
    grade = np.digitize(score, [1.0, 3.0])
    row, column = np.nonzero(marks)
    weights, cuts = toxicity.fit_ordinal(row, column, grade, np.full(400, 1 / 400), 6, penalty=1e-4, rounds=800)
    assert cuts[0] < cuts[1] and weights[0] > weights[1] > 0.5 and weights[5] == 0
    assert weights[2:5].max() < 0.5 * weights[1] and weights.min() == 0


def test_without_labels_nothing_is_toxic(spark, documents):
    docs = documents((1, "blorf"), (None, None), (2, ""))
    for said in ([], [(1, 1, 1)], [(1, 1, None), (None, 1, 1)], [(2, 1, 0)]):
        rows = toxicity.report(docs, labelled(spark, said)).collect()
        assert len(rows) == 3 and not any(r.rejected for r in rows)
    assert toxicity.report(documents(), labelled(spark, [])).count() == 0


def test_filter_keeps_clean_rows_and_columns(spark, documents):
    docs, said = corpus(400, 3)
    table = documents(*docs, (7, docs[7][1]))
    kept = toxicity.without_toxic(table, labelled(spark, said))
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 2 and len([i for i in ids if i % 5]) == 321 and sum(i % 5 == 0 for i in ids) <= 2


@pytest.mark.parametrize("text", [b"", b"...", b"abcd abcdefgh abcd"])
def test_marks_are_distinct(text):
    owner, feature = toxicity.marks([text, text])
    assert len(set(zip(owner.tolist(), feature.tolist()))) == len(owner)
    assert (feature[owner == 0] == feature[owner == 1]).all()
