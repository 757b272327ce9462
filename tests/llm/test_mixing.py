from collections import Counter
from fractions import Fraction

import pytest

from millwright.llm import mixing


@pytest.mark.parametrize("weights", [[1], [1, 1], [3, 1], [5, 3, 1, 1], [7, 7, 7, 2, 13], [1, 99]])
def test_less_than_one_block_off_at_every_slot(spark, weights):
    order = mixing.period(spark, weights)
    total = sum(weights)
    assert Counter(order) == dict(enumerate(weights))
    done = Counter()
    for slot, stream in enumerate(order, 1):
        done[stream] += 1
        assert all(abs(Fraction(slot * n, total) - done[i]) < 1 for i, n in enumerate(weights))


def test_every_document_has_its_place(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 7)
    sources = ["a"] * 50 + ["b"] * 21 + ["c"] * 9 + [None, "d"] * 5
    docs = documents(*[(n, f"t{n}", s) for n, s in enumerate(sources)], (3, "t3", "a"))
    rows = mixing.report(docs, {"a": 2, "b": 2, "c": 1}, block=4).collect()
    assert Counter(r.doc_id for r in rows) == Counter([*range(90), 3])
    assert {r.stream for r in rows if r.source in (None, "d")} == {""}
    for stream in {r.stream for r in rows}:
        own = sorted((r.block, r.place) for r in rows if r.stream == stream)
        assert own == [(n // 4, n % 4) for n in range(len(own))]
    blocks = {(r.slot, r.stream, r.block) for r in rows}
    assert sorted(s for s, _, _ in blocks) == list(range(len(blocks)))
    # blocks of a stream come in order, and shares hold until the first stream runs out
    ordered = [s for _, s, _ in sorted(blocks)]
    for stream in set(ordered):
        assert [b for _, s, b in sorted(blocks) if s == stream] == list(range(ordered.count(stream)))
    done, weights = Counter(), {"a": 2, "b": 2, "c": 1, "": 1}
    for slot, stream in enumerate(ordered, 1):
        done[stream] += 1
        assert all(abs(Fraction(slot * n, 6) - done[s]) < 1 for s, n in weights.items())
        if done[stream] == ordered.count(stream):
            break


def brute_period(weights):
    """Earliest deadline first, slot by slot, in fractions."""
    total, done, order = sum(weights), [0] * len(weights), []
    for at in range(total):
        due = [
            (-(-(done[i] + 1) * total // n), i)
            for i, n in enumerate(weights)
            if done[i] < n and Fraction(done[i] * total, n) < at + 1
        ]
        order.append(min(due)[1])
        done[order[-1]] += 1
    return order


@pytest.mark.parametrize("weights", [[4, 3, 2, 1, 1], [9, 9, 1], [250, 1, 749], [1000, 999, 7]])
def test_schedule_agrees_with_brute_force(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "SLOTS", 97)
    assert mixing.period(spark, weights) == brute_period(weights)


@pytest.mark.parametrize("sent", [100_000, 10])
def test_fine_weights(documents, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT_SLOTS", sent)
    weights = {f"s{n}": 1_000 + n for n in range(10)}
    docs = documents(*[(n, f"t{n}", f"s{n % 10}") for n in range(100)])
    rows = mixing.report(docs, weights, block=2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(100))
    assert sorted({r.slot for r in rows}) == list(range(50))


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame(
        [(n, f"t{n}", "a", n, -n, n * 2) for n in range(9)], "doc_id long, text string, source string, slot long, _draw long, Stream long"
    )
    found = mixing.mixed(docs, {"a": 1}, block=2)
    assert found.columns == [*docs.columns, "stream_1", "block", "slot_1", "place"]
    rows = found.collect()
    assert sorted((r.doc_id, r.slot, r._draw, r.Stream) for r in rows) == [(n, n, -n, n * 2) for n in range(9)]
    assert sorted(r.slot_1 * 2 + r.place for r in rows) == list(range(9))


def test_physical_order_and_columns(documents):
    docs = documents(*[(n, f"t{n}", "ab"[n % 2]) for n in range(40)])
    laid = mixing.in_order(docs, {"a": 3, "b": 1}, 3, block=2)
    assert laid.columns == docs.columns
    want = {r.doc_id: (r.slot, r.place) for r in mixing.report(docs, {"a": 3, "b": 1}, block=2).collect()}
    places = [want[r.doc_id] for r in laid.collect()]
    assert len(places) == 40 and places == sorted(places)


def test_odd_input(documents):
    assert mixing.report(documents(), {"a": 1}).count() == 0
    assert mixing.report(documents((None, None, None), (None, None, None)), {}).count() == 2
    for bad in ({"a": 0}, {"a": 1.5}):
        with pytest.raises(ValueError):
            mixing.report(documents((1, "t")), bad)
