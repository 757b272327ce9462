"""Filtering stages keep the user's columns, whatever their names."""

from millwright.llm import decontaminate, simhash, toxicity
from millwright.llm.common import fresh

OWN = ["_severity", "_benchmark_hits", "_benchmark_hits_0", "_mark", "_id", "code"]


def rows(spark, texts):
    layout = "doc_id long, text string, " + ", ".join(f"{name} string" for name in OWN)
    return spark.createDataFrame([(i, text, *[f"{name}{i}" for name in OWN]) for i, text in texts], layout)


def kept(found, docs):
    assert found.columns == docs.columns
    got = found.collect()
    assert all(r[name] == f"{name}{r.doc_id}" for r in got for name in OWN)
    return sorted(r.doc_id for r in got)


def test_fresh_names(spark):
    docs = spark.createDataFrame([], "a int, A_1 int")
    assert [fresh(docs, name) for name in ("b", "A")] == ["b", "A_2"]


def test_toxicity(spark):
    texts = [(n, f"w{n % 7} w{n % 11} " + ("blorf " * 3 if n % 4 == 0 else "fine words here")) for n in range(80)]
    docs = rows(spark, texts)
    labels = spark.createDataFrame([(n, int(n % 4 == 0)) for n in range(80)], "doc_id long, toxic int")
    assert kept(toxicity.without_toxic(docs, labels), docs) == [n for n in range(80) if n % 4]


def test_decontamination(spark):
    item = " ".join(f"q{n}" for n in range(12))
    docs = rows(spark, [(1, f"before {item} after"), (2, "clean text"), (3, None)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert kept(decontaminate.without_contaminated(docs, benchmark), docs) == [2, 3]


def test_simhash(spark):
    docs = rows(spark, [(1, "one two three four"), (2, "one two three four"), (3, "quite another text here")])
    assert kept(simhash.first_of_each(docs), docs) == [1, 3]
