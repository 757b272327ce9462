"""Secrets in texts: all rules in one deterministic automaton, one pass over the bytes.

Nulls and empty texts have no secrets. Every row is judged by itself, so
repeated rows and ids, null ids and further columns change nothing; an empty
table gives an empty result. Of two matches that begin together the rule
listed first comes first.
"""

import hashlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.automaton import Rule, RuleSet
from millwright.llm.common import bounded_batches, text_struct

# The three kinds that a scan must report, in their order.
BASE_RULES = [
    Rule(
        "assign",
        r"[A-Za-z0-9+/_.=-]+",
        head=r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        least=12,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # a shorter run never counts and hides no other, so part of the length can stand in the pattern
    Rule("hex", r"[0-9a-f]{8,}", least=16),
]
# Public formats of credentials that the base kinds miss.
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[opsur]_[A-Za-z0-9]+", least=40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_.-]+", least=30),
]
RULES = BASE_RULES + MORE_RULES
FOUND = "array<struct<kind:string,start:int,end:int>>"


@cache
def compiled_rules(rules: tuple[Rule, ...]) -> RuleSet:
    """The automata, built once per driver and sent to the tasks."""
    return RuleSet(list(rules))


def _scanner(rules: list[Rule]):
    compiled = compiled_rules(tuple(rules))

    def prepare():
        def work(texts: list[bytes]) -> dict:
            return {"spans": [_in_characters(text, compiled.spans(text), rules) for text in texts]}

        return work

    return prepare


def _in_characters(text: bytes, spans: list[tuple[int, int, int]], rules: list[Rule]) -> list[dict]:
    """Byte spans as code point spans."""
    if not spans:
        return []
    if text.isascii():
        before = range(len(text) + 1)
    else:
        first_bytes = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(first_bytes)])

    def place(at: int) -> int:
        return int(before[at])

    return [{"kind": rules[number].kind, "start": place(start), "end": place(end)} for start, number, end in spans]


def scan(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with an array of (kind, start, end) in code points, ordered by start, then by rule.

    Per rule the matches are leftmost, longest and do not overlap. A column
    named as ``into`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    find = text_struct(_scanner(rules), f"spans {FOUND}")
    return docs.withColumn(into, find(text_col)["spans"])


def redact(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of the text replaced; a null text stays null."""
    bounded_batches(docs.sparkSession)

    compiled = compiled_rules(tuple(rules))

    def prepare():
        def clean(text: bytes) -> str:
            out, at = [], 0
            for start, _, end in compiled.spans(text):
                if start >= at:
                    out += [text[at:start], by.encode()]
                at = max(at, end)
            return b"".join([*out, text[at:]]).decode()

        return lambda texts: {"text": [clean(text) for text in texts]}

    cleaned = text_struct(prepare, "text string")(text_col)["text"]
    known = F.col(text_col).isNotNull()
    return docs.withColumn(text_col, F.when(known, cleaned))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: how many secrets of each base kind, and the spans written as ``kind:start:end``."""
    found = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), into="secrets")
    base = [rule.kind for rule in BASE_RULES]
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    of_base = F.filter("secrets", lambda s: s["kind"].isin(base))

    def count_of(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count_of, base),
        F.sha2(written(of_base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"),
    )


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The digest of ``report`` for a list of spans, for tests."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
