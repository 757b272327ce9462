import gc
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwright.llm import token_records

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "ÉCOLE! ÇA-VA? Über... straße, <|ENDOFTEXT|>, a<|endoftext|>, it's; THAT'S' ÿ× Ÿ÷ İx a\u0301. b\u0301 $$$ no*** Q&&&",
    "Hello, world! It's   fine.", None, "", "é́ ΑΣ Σ. x y z \x85 q\x1cr", "a <|endoftext|> b<|startoftext|>c", "ﬁ ½ 日本語 \U0001f600",
    " ", "\n\t", "don't we'll THEY'RE 'S", "word " * 5000, "z" * 3000, "́ x", "line\r\nend",
]


def plain(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("known", [300_000, 20, 0])
def test_words_one_by_one_give_the_same_ids(monkeypatch, known):
    monkeypatch.setattr(token_records, "KNOWN_WORDS", known)
    monkeypatch.setattr(token_records, "TOGETHER", 3)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_records.WordEncoder(file.read(), 2)
    texts = [(t or "").encode() for t in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(i, "<u2").tolist() for i in encoder.ids(texts)] == [plain(t)[:-1] for t in TEXTS]


def test_read_back(spark, documents, monkeypatch):
    monkeypatch.setattr(token_records, "FILE_BYTES", 2000)
    rows = [(len(TEXTS) - n, text) for n, text in enumerate(TEXTS)] + [(None, "null id")]
    got = {r.doc_id: r for r in token_records.encode_to_files(documents(*rows), PATH, 2).collect()}
    assert len(got) == len(rows)
    at = 0
    for doc_id, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = plain(text)
        row = got[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_repeated_rows_and_empty_tables(documents):
    rows = token_records.encode_to_files(documents((1, "a b"), (1, "a b"), (1, "a")), PATH, 2).orderBy("start").collect()
    assert sorted(r.n_tokens for r in rows) == [2, 3, 3] and [r.doc_id for r in rows] == [1, 1, 1]
    assert token_records.encode_to_files(documents(), PATH, 2).count() == 0


def test_own_order(documents):
    docs = documents((1, "a"), (2, "b b"), (3, "c c c"))
    rows = token_records.encode_to_files(docs, PATH, 2, order=[-F.col("doc_id")]).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in rows] == [(3, 0), (2, 4), (1, 7)]


def test_shuffled_reading_gives_every_record_once(spark, documents, tmp_path):
    texts = {n: f"text number {n} " * (n % 5) for n in range(60)}
    token_records.encode_to_files(documents(*texts.items()), PATH, 2, path=str(tmp_path))
    index = spark.read.parquet(str(tmp_path / "index"))
    orders = []
    for seed in (1, 2):
        rows = token_records.read_shuffled(spark, str(tmp_path / "records"), index, 2, seed).collect()
        assert {r.doc_id: r.ids for r in rows} == {n: plain(t) for n, t in texts.items()}
        orders.append([r.doc_id for r in rows])
    assert orders[0] != orders[1] != sorted(texts)


def test_damage_is_noticed():
    record = token_records.frame(5, b"\x01\x00\x02\x00", 2) + b"\n"
    assert [(o, d, i.tolist()) for o, _, d, i in token_records.frames(record * 2, 2)] == [(0, 5, [1, 2]), (len(record), 5, [1, 2])]
    for at in (0, 9, 14, len(record) - 3):
        bad = bytearray(record)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(token_records.frames(bytes(bad), 2))


def test_plain_words_cost_the_tokenizer_nothing(monkeypatch):
    """Split here, with the same ids; only other words are sent through the whole tokenizer."""
    with open(PATH, encoding="utf-8") as file:
        encoder = token_records.WordEncoder(file.read(), 2)
    sent = []
    each = encoder._each
    monkeypatch.setattr(encoder, "_each", lambda words: sent.extend(words) or each(words))
    marks = "".join(map(chr, [*range(1, 9), *range(14, 32), *range(33, 48), *range(58, 65), *range(91, 97), *range(123, 128)]))
    texts = [
        "key=AKIA42xyz 3.14% 'Tis rock'n'roll we'LLs ÀÉÎ'Sß12é x'd' ''ve 'RE're it'sé's <b>Größe</b> 0x1f",
        " ".join(f"{a}{m}{b}" for m in marks for a in ("", "Ab", "7") for b in ("", "ç", "9", "'s")),
    ]
    got = encoder.ids([t.encode() for t in texts])
    assert [np.frombuffer(i, "<u2").tolist() for i in got] == [plain(t)[:-1] for t in texts] and not sent
    other = "İstanbul a<|endoftext|>1 1½ µm"
    assert np.frombuffer(encoder.ids([other.encode()])[0], "<u2").tolist() == plain(other)[:-1]
    assert sorted(sent) == sorted(other.split())


def test_a_tokenizer_of_other_rules_gets_whole_words():
    from tokenizers import models, normalizers, pre_tokenizers

    vocabulary = {"a": 0, "B": 1, "!": 2, "B!": 3}
    tokenizer = Tokenizer(models.BPE(vocabulary, [("B", "!")]))
    tokenizer.normalizer, tokenizer.pre_tokenizer = normalizers.NFC(), pre_tokenizers.WhitespaceSplit()
    text = "aB! a B!B a\tB !"
    (got,) = token_records.WordEncoder(tokenizer.to_str(), 2).ids([text.encode()])
    assert np.frombuffer(got, "<u2").tolist() == tokenizer.encode(text).ids and token_records.WordEncoder(tokenizer.to_str(), 2).ids([]) == []


def test_remembered_pieces_are_no_python_objects():
    with open(PATH, encoding="utf-8") as file:
        encoder = token_records.WordEncoder(file.read(), 2)
    letters = "abcdefghij"
    words = ["".join(letters[int(digit)] for digit in f"{n:05d}") for n in range(40_000)]
    texts = [" ".join(words[at : at + 5000]) for at in range(0, 40_000, 5000)]
    encoder.ids([b"warm up"])
    gc.collect()
    tracemalloc.start()
    for text in texts:
        encoder.ids([text.encode()])
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    memory = encoder.memory
    assert len(memory.pieces) > 40_000
    # 40,000 strings with their ids would take over 5 MB
    assert held < 1_000_000 and memory.pieces.nbytes + memory.ids.nbytes < 40 * len(memory.pieces)
    assert np.frombuffer(encoder.ids([texts[3].encode()])[0], "<u2").tolist() == plain(texts[3])[:-1]
