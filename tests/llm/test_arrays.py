import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from millwright.llm import arrays, line_dedup, quality_rules, suffix_dedup


def regular(bits):
    """Two different strings of 2**bits letters on which simple polynomial hashes agree."""
    ones = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join("ab"[o] for o in ones), "".join("ba"[o] for o in ones)


def hashes(texts):
    data, begins = arrays.laid_out([t.encode() for t in texts])
    return arrays.span_hashes(data, begins, begins + np.array([len(t.encode()) for t in texts])).tolist()


def test_equal_strings_have_equal_hashes_wherever_they_stand():
    draw = random.Random(7)
    texts = ["".join(draw.choices("abé ", k=draw.randint(0, 24))) for _ in range(400)]
    found = hashes(texts)
    names = {}
    for text, value in zip(texts, found):
        assert names.setdefault(text, value) == value
    assert len(set(names.values())) == len(names)
    assert hashes(["x" * 7]) == hashes(["x" * 7, "other words behind it"])[:1]


@pytest.mark.parametrize("bits", [9, 10, 11, 12])
def test_regular_strings_are_told_apart(bits):
    assert len(set(hashes(regular(bits)))) == 2


def test_regular_lines_are_no_copies(spark, documents):
    one, two = regular(10)
    docs = documents((1, f"{one}\n{two}"), (2, f"{one} {two}"), (3, f"{two} {one}"))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.n_dup_lines for r in quality_rules.report(docs, labels).collect()} == {0}
    got = {r.doc_id: r.n_removed for r in line_dedup.report(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 1}  # the third has the words of the second


def test_task_functions_run_where_the_package_is_missing(tmp_path):
    text = b"one two three\none two three"
    work = {
        "span_hashes": cloudpickle.dumps((arrays.span_hashes, arrays.laid_out, arrays.word_spans)),
        "word_sets": cloudpickle.dumps((line_dedup.word_sets,)),
    }
    for name, data in work.items():
        (tmp_path / name).write_bytes(data)
    script = (
        "import sys, pickle\n"
        "for name in sys.argv[1:]:\n"
        "    found = pickle.load(open(name, 'rb'))\n"
        "    if name.endswith('span_hashes'):\n"
        f"        data, begins = found[1]([{text!r}])\n"
        "        found[0](data, *found[2](data))\n"
        "    if name.endswith('word_sets'):\n"
        f"        found[0]([{text!r}])\n"
        "assert not any(m.startswith('millwright') and 'llm' not in m for m in sys.modules)\n"
    )
    subprocess.run([sys.executable, "-I", "-c", script, *[str(tmp_path / name) for name in work]], check=True, cwd=tmp_path)


def test_sums_over_a_text_are_built_once_for_all_its_hashes(monkeypatch):
    text = bytes(random.Random(3).choices(range(256), k=3000))
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(0, 2000, 7)
    hasher = arrays.span_hasher(data)
    for width in (0, 3, 8, 400):
        assert (hasher(starts, starts + width) == arrays.span_hashes(data, starts, starts + width)).all()
    mixed_widths = starts + starts % 19
    assert (hasher(starts, mixed_widths) == arrays.span_hashes(data, starts, mixed_widths)).all()
    built, sums = [], arrays._sums
    monkeypatch.setattr(arrays, "_sums", lambda *given: built.append(1) or sums(*given))
    found = suffix_dedup.sampled([text], 400)
    assert len(built) == 2 and len(found["run"]) == len(found["next_2"]) > 0
    again = suffix_dedup.sampled([text], 400, ranked=False)
    assert all((again[c] == found[c]).all() for c in ("text", "at", "strings", "before", "run"))
