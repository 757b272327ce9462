import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millwright.llm import exact_dedup


def brute(rows):
    """rows of (id, text); (id, id that stays, group size, digest) and how many of each stay."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[plain].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out, stay = Counter(), Counter()
    for plain, members in groups.items():
        first = min(members)
        sha = hashlib.sha256(plain.encode()).hexdigest()
        for *_, doc_id in members:
            out[(doc_id, first[3], len(members), sha)] += 1
        stay[(first[3], sha)] += 1
    return out, stay


def held(found):
    rows = found.collect()
    assert all(r.kept is False or r.doc_id == r.keep_id for r in rows)
    return (
        Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows),
        Counter((r.keep_id, r.text_sha256) for r in rows if r.kept),
    )


ROWS = [
    (4, "a b"), (2, "ab"), (9, "a\tb \r\n"), (3, "a\xa0b"), (1, None), (8, ""), (7, " \x0b\x0c"), (5, "same"), (5, "same"),
    (None, "sa me"), (None, "only here"), (6, "long " * 40_000), (10, "long " * 40_000 + "x"), (11, "long" * 40_000),
    (12, "é"), (13, "é"),
]


def test_odd_rows(documents):
    assert held(exact_dedup.judged(documents(*ROWS))) == brute(ROWS)
    assert exact_dedup.judged(documents()).count() == 0


@pytest.mark.parametrize("letters", [0, 1, 2])
def test_colliding_digests_are_told_apart_by_the_texts(documents, letters):
    draw = random.Random(letters)
    rows = ROWS + [(20 + n, " ".join(draw.choices(["a", "b", "ab"], k=draw.randint(1, 4)))) for n in range(80)]
    weak = lambda text: F.substring(text, 1, letters).cast("binary")
    assert held(exact_dedup.judged(documents(*rows), weak)) == brute(rows)


def test_a_group_of_most_rows_collapses_before_the_shuffle(documents):
    rows = [(n, "copy" if n % 3 else f"text {n}") for n in range(300)]
    assert held(exact_dedup.judged(documents(*rows).repartition(7))) == brute(rows)


def test_rows_that_stay_keep_their_columns(documents):
    docs = documents(*ROWS)
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    wanted = brute(ROWS)[1]
    got = Counter((r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).hexdigest()) for r in kept.collect())
    assert got == wanted and {r.key for r in kept.collect()} == {"x"}
    assert exact_dedup.without_copies(documents()).count() == 0
