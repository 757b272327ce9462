import re

from pyspark.sql import functions as F

from millwright.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute(text, items):
    words = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for name, item in items:
        own = WORD.findall((item or "").translate(LOWER))
        for at in range(max(1, len(own) - 9) if own else 0):
            run = own[at : at + 10]
            for i in range(len(words) - len(run) + 1):
                if words[i : i + len(run)] == run:
                    hit |= set(range(i, i + len(run)))
                    found.add(str(name))
    return len(words), len(hit), found


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


LONG = "One two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, LONG), (2, "Short été item"), (3, "item"), (4, None), (5, "?!"), (6, "seven eight nine"), (6, "seven eight nine")]
TEXTS = [
    None, "", "nothing here", f"x {LONG.upper()} y", "one two three four five six seven eight nine ten",
    "short, ÉTÉ; item", "short été item items", "ONE-TWO three/four five six\nseven eight nine ten eleven twelve thirteen", "item item",
    "z " * 60_000 + LONG,
]


def test_agrees_with_brute_force(spark, documents):
    docs = documents(*enumerate(TEXTS))
    for block in (decontaminate.BLOCK_BYTES, 20):
        rows = decontaminate.report(docs, bench(spark, ITEMS), block_bytes=block).collect()
        assert len(rows) == len(TEXTS)
        for row in rows:
            n_words, n_hit, items = brute(TEXTS[row.doc_id], ITEMS)
            assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n_words, n_hit, len(items), n_hit > 0)
            assert row.items_sha256 == decontaminate.items_digest(items)


def test_spans_point_into_the_original(spark, documents):
    found = decontaminate.contamination(documents((1, "Éa, SHORT: été -- item!"), (2, None)), bench(spark, ITEMS))
    rows = {r.doc_id: r for r in decontaminate.hit_spans(found).collect()}
    (span,) = rows[1].spans
    assert rows[1].text[span.start : span.end] == "SHORT: été -- item"
    assert rows[2].spans == []


def test_filter_keeps_clean_rows_and_their_columns(spark, documents):
    docs = documents((1, "clean"), (1, "clean"), (None, None), (3, LONG))
    kept = decontaminate.without_contaminated(docs, bench(spark, ITEMS))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]


def test_empty_tables(spark, documents):
    assert decontaminate.report(documents(), bench(spark, ITEMS)).count() == 0
    row = decontaminate.report(documents((1, "item")), bench(spark, ITEMS).filter(F.lit(False))).first()
    assert (row.n_words, row.contaminated) == (1, False)
