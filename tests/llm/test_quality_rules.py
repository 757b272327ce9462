import collections
import re
from math import comb

import pytest

from millwright.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


TEXTS = [
    None, "", " \n\t", "a", "a b c a b c", "é ü x y # $\x0b*", "l\nl\n\nl\nl \n", "x y z\nx y z\n" * 20,
    " ".join(f"w{n}" for n in range(60)), "a a a a", "\n\n", "q " * 100_000, "end\n", " ", "a b c\nd a b c",
]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_agree_with_brute_force(spark, documents):
    rows = quality_rules.report(documents(*enumerate(TEXTS)), labels(spark, [(None, 1, 0), (1, None, 0)])).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id][:20]
        assert r.kept == (not r.base_failed)


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 10, 0.3), (9, 10, 0.5), (10, 10, 0.5), (2, 400, 0.01), (30, 1000, 0.04)])
def test_binomial_tail_is_exact(k, n, p):
    want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_respect_the_risk(spark, documents):
    good = " ".join(f"word{n}" for n in range(60))
    docs, said = [], []
    for n in range(3000):
        bad = n % 10 == 0
        docs.append((n, good.replace("word5", "w### $$$ %%%") + f" u{n}" if bad else f"{good} u{n}"))
        said.append((n, 0 if bad else 1, 0))
    docs += [(5000, good + " ###"), (5000, good + " ###")]
    verdicts = {r.doc_id: r for r in quality_rules.report(documents(*docs), labels(spark, said + [(5, 0, 0), (5, 1, 0)])).collect()}
    assert not any(verdicts[n].kept for n in range(0, 3000, 10))
    assert all(verdicts[n].kept for n in range(3000) if n % 10)
    assert verdicts[0].failed_rules == "symbols"


def test_too_few_labels_reject_nothing(spark, documents):
    good = " ".join(f"word{n}" for n in range(60))
    docs = [(n, good + " ###" * (n % 2 * 40)) for n in range(40)]
    rows = quality_rules.report(documents(*docs), labels(spark, [(n, 1 - n % 2, 0) for n in range(40)])).collect()
    assert len(rows) == 40 and all(r.failed_rules == "" for r in rows)


def test_empty_tables(spark, documents):
    assert quality_rules.report(documents(), labels(spark, [])).count() == 0
    assert quality_rules.report(documents((1, "a")), labels(spark, [])).first().base_failed
