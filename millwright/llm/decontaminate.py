"""Benchmark passages in texts, found with one Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z in lower case, words of
digits, letters and non-ASCII characters, one space between words. Every run
of ten words of an item is a pattern; an item of fewer words is one pattern.
The automaton reads each normalised text once and reports every occurrence;
offsets are carried back to the words of the original text.

Null and empty texts have no words. Items without words match nothing. Rows
are judged one by one, so repeated rows, null ids and further columns change
nothing. Equal item ids count as one item; a null item id is written ``null``.
With an empty benchmark nothing is contaminated.
"""

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import bounded_batches, fresh, text_struct

WINDOW = 10
#: normalised benchmark bytes that one automaton may hold; more are searched in further passes
BLOCK_BYTES = 4 << 20

HITS = "n_words long, words array<int>, items array<string>"

# lower case, and a space for every ASCII character that is no letter or digit
_FOLD = bytes(
    byte | 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _patterns(words: list[bytes], window: int) -> set[str]:
    """Runs of words with a space before and behind, so that only whole words match."""
    last = max(1, len(words) - window + 1) if words else 0
    return {" " + b" ".join(words[at : at + window]).decode() + " " for at in range(last)}


def _finder(items: list[tuple[str, bytes]], window: int):
    def prepare():
        owners: dict[str, set[str]] = {}
        for name, text in items:
            for pattern in _patterns(normal_words(text), window):
                owners.setdefault(pattern, set()).add(name)
        automaton = ahocorasick.Automaton()
        for pattern, names in owners.items():
            automaton.add_word(pattern, (len(pattern), pattern.count(" ") - 1, names))
        if owners:
            automaton.make_automaton()

        def search(text: bytes) -> tuple[int, list[int], list[str]]:
            words = normal_words(text)
            if not owners or not words:
                return len(words), [], []
            normal = " " + b" ".join(words).decode() + " "
            hits = [(end, *value) for end, value in automaton.iter(normal)]
            if not hits:
                return len(words), [], []
            # the space before word i is the i-th of the normalised text
            spaces = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le"), np.uint32) == 32)
            end, size, count, names = zip(*hits)
            first = np.searchsorted(spaces, np.array(end) - np.array(size) + 1)
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, first, 1)
            np.add.at(cover, first + np.array(count), -1)
            hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
            return len(words), hit.tolist(), sorted(set().union(*names))

        def work(texts: list[bytes]) -> dict:
            found = [search(text) for text in texts]
            return dict(zip(("n_words", "words", "items"), map(list, zip(*found)))) if found else {}

        return work

    return prepare


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> list[list[tuple[str, bytes]]]:
    """The items in lists of at most ``limit`` bytes (a longer item is a list of its own).

    The driver holds one list at a time while it ships them; rows arrive
    partition by partition.
    """
    rows = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    ).distinct()
    blocks: list[list[tuple[str, bytes]]] = [[]]
    held = 0
    for name, text in rows.toLocalIterator():
        if held and held + len(text) > limit:
            blocks.append([])
            held = 0
        blocks[-1].append((name, bytes(text)))
        held += len(text)
    return blocks


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    into: str = "contamination",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct: ``n_words``, the numbers of the ``words`` hit, and the ``items`` found.

    One automaton serves a benchmark of up to ``block_bytes``; each further
    block adds one automaton and one pass, so no worker ever holds more.
    """
    bounded_batches(docs.sparkSession)
    parts = [
        text_struct(_finder(block, window), HITS)(text_col)
        for block in _blocks(benchmark, item_col, item_text_col, block_bytes)
    ]
    if len(parts) == 1:
        return docs.withColumn(into, parts[0])
    names = [fresh(docs, f"{into}_{uid}") for uid in range(len(parts))]
    wide = docs
    for name, part in zip(names, parts):
        wide = wide.withColumn(name, part)
    whole = F.struct(
        F.col(f"{names[0]}.n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.words") for n in names])))).alias("words"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.items") for n in names])))).alias("items"),
    )
    return wide.withColumn(into, whole).drop(*names)


def hit_spans(docs: DataFrame, text_col: str = "text", of: str = "contamination", into: str = "spans") -> DataFrame:
    """Adds the hit passages as (start, end) code points of the original text, end exclusive."""

    def spans(text: str, words: list[int]) -> list[dict]:
        if not len(words):
            return []
        folded = text.translate({c: c + 32 for c in range(65, 91)})
        inside = np.array([ord(c) >= 128 or c in "0123456789" or "a" <= c <= "z" for c in folded])
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        words = np.asarray(words)
        cut = np.flatnonzero(np.diff(words) > 1) + 1
        return [{"start": int(starts[run[0]]), "end": int(ends[run[-1]])} for run in np.split(words, cut)]

    def batch(texts, words):
        return pd.Series([spans(text, hits) for text, hits in zip(texts, words)])

    batch.__annotations__ = {"texts": pd.Series, "words": pd.Series, "return": pd.Series}
    apply = F.pandas_udf(batch, "array<struct<start:int,end:int>>")
    return docs.withColumn(into, apply(F.coalesce(F.col(text_col), F.lit("")), F.col(f"{of}.words")))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: words, words hit, items found with a digest of their ids, and whether any word was hit."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = contamination(rows, benchmark, into="hits", **options)
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.size("hits.words").cast("long").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits.words") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage occurs, with the columns they came with."""
    mark = fresh(docs, "_benchmark_hits")
    found = contamination(docs, benchmark, into=mark, **options)
    return found.filter(F.size(F.col(f"{mark}.words")) == 0).drop(mark)


def items_digest(items: set[str]) -> str:
    """The digest of ``report`` for a set of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()

