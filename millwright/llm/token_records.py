"""Token ids as length-delimited binary records with a separate offset index.

A record is: the payload's length (8 bytes), the masked checksum of those 8
bytes (4), the payload, the masked checksum of the payload (4), a line feed.
The payload is a flag byte (1: the id is null), the id (8), the number of
tokens (4), and the token ids (2 bytes each where the vocabulary fits, else
4). Numbers are little-endian. A checksum is CRC-32, rotated right by 15 bits
plus a constant, so that a checksum over data that holds checksums stays
meaningful.

Files are written by Spark's own committer to any store it knows, so a lost
executor leaves no half file. Each holds a range of the order asked for; the
file number and the place in the file give the order of all records.

A null or empty text has only the end token. Null ids come first. Rows with
equal ids are ordered by their text; equal rows are written as often as they
occur. An empty table gives an empty result; further columns are ignored.
"""

import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.llm.common import bounded_batches, utf8
from millwright.session import scratch_path

#: text bytes that one file should hold; a reader takes a file at a time
FILE_BYTES = 16 << 20
#: distinct pieces of words that a worker remembers (about 25 bytes each); and how many are encoded together
KNOWN_WORDS = 700_000
TOGETHER = 512
# Letters whose lower case is one letter everywhere, marks that never belong to the letters before them, and how
# a tokenizer splits words, as it is written there and for plain words.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
LETTERS = f"([{_LETTER}]*)"
MARKS = r"([^A-Za-z0-9'\n\u0080-\U0010ffff]*)"
PLAIN = rf"[\x00-\x09\x0b-\x7f{_LETTER}]"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+").findall
_MASK_DELTA = 0xA282EAD8
_HEAD, _HEAD_BYTES = "<QI", 12
_BODY, _BODY_BYTES = "<BqI", 13
INDEX = (
    "file string, file_no long, place long, offset long, length long, doc_id long, "
    "start_in_file long, n_tokens long, ids_crc32 long"
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, n_tokens: int) -> bytes:
    """One record without its line feed."""
    payload = struct.pack(_BODY, doc_id is None, doc_id or 0, n_tokens) + ids
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def frames(content: bytes, width: int) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Records of a file as (offset, length, id, token ids); a damaged one is an error."""
    at = 0
    while at < len(content):
        length, check = struct.unpack_from(_HEAD, content, at)
        if masked(content[at : at + 8]) != check:
            raise ValueError(f"damaged length at byte {at}")
        begin = at + _HEAD_BYTES
        payload = content[begin : begin + length]
        if struct.unpack_from("<I", content, begin + length)[0] != masked(payload):
            raise ValueError(f"damaged record at byte {at}")
        missing, doc_id, n_tokens = struct.unpack_from(_BODY, payload)
        ids = np.frombuffer(payload, f"<u{width}", n_tokens, _BODY_BYTES)
        whole = _HEAD_BYTES + length + 5
        yield at, whole, None if missing else doc_id, ids
        at += whole


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies spell each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


def _splits_plainly(definition: dict) -> bool:
    """Whether the tokenizer treats plain words as ``WordEncoder`` does by itself: lower case, ``SPLIT``, bytes as letters."""
    normal, before = definition.get("normalizer") or {}, definition.get("pre_tokenizer") or {}
    steps = [step.get("type") for step in normal.get("normalizers", [])]
    spaces = [step for step in normal.get("normalizers", []) if step.get("type") == "Replace"]
    split = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
    spelled = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    chain = [{k: v for k, v in step.items() if k != "trim_offsets"} for step in before.get("pretokenizers", [])]
    hidden = re.compile(LETTERS + MARKS)
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and spaces[0].get("pattern") == {"Regex": r"\s+"}
        and chain == [split, spelled]
        and not any(hidden.fullmatch(token["content"]) for token in definition.get("added_tokens") or [])
    )


class PieceMemory:
    """Pieces and their ids, end to end in two Arrow arrays; as Python objects they take several times the memory."""

    def __init__(self):
        self.pieces = pa.array([""], pa.string())
        self.ids = pa.array([b""], pa.binary())

    def split(self, pieces: list[str]) -> tuple[dict[str, bytes], list[str]]:
        """The ids of the pieces that are remembered, and the other pieces."""
        place = pc.index_in(pa.array(pieces, pa.string()), value_set=self.pieces).fill_null(-1).to_numpy()
        held = place >= 0
        ids = self.ids.take(pa.array(place[held])).to_numpy(zero_copy_only=False)
        return dict(zip(compress(pieces, held.tolist()), ids.tolist())), list(compress(pieces, (~held).tolist()))

    def add(self, pieces: list[str], ids: list[bytes]) -> None:
        """Remember further pieces, if there is room for all of them."""
        if pieces and len(self.pieces) + len(pieces) <= KNOWN_WORDS:
            self.pieces = pa.concat_arrays([self.pieces, pa.array(pieces, pa.string())])
            self.ids = pa.concat_arrays([self.ids, pa.array(ids, pa.binary())])


class WordEncoder:
    """Token ids of texts, encoding the distinct words of a batch only.

    The tokenizer replaces white space by single spaces and never joins across
    it, so a text's ids are those of its words one after the other. Words are
    cut at ASCII white space only; other spaces stay inside and are left to
    the tokenizer. Where the tokenizer lower-cases and splits words by
    ``SPLIT``, words of ASCII and Latin letters are split here in the same way,
    and its model encodes each distinct piece; a word has the ids of its
    pieces. All other words go through the whole tokenizer.
    """

    def __init__(self, definition: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.width = width
        told = json.loads(definition)
        # a line is letters and marks, or other plain characters, or else one word whatever it holds
        plainly = f"{LETTERS}{MARKS}|({PLAIN}+)|(.+)" if _splits_plainly(told) else "()()()(.*)"
        self.parts = re.compile(f"^(?:{plainly})$", re.M)
        self.added = re.compile("|".join(re.escape(token["content"]) for token in told.get("added_tokens") or []) or "(?!)")
        self.spelling = _byte_letters()
        self.memory = PieceMemory()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not texts:
            return []
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = lists.flatten().dictionary_encode()
        each = self._encoded(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # words are numbers here, and all their ids are copied in one step
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // self.width
        number = coded.indices.to_numpy()
        counts = sizes[number]
        ends = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(ends[-1])
        place += np.repeat((np.cumsum(sizes) - sizes)[number] - ends[:-1], counts)
        data = np.frombuffer(b"".join(each), f"<u{self.width}")[place].tobytes()
        edges = (ends[lists.offsets.to_numpy()] * self.width).tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def _encoded(self, words: list[str]) -> list[bytes]:
        stems, marks, plain, others = zip(*self.parts.findall("\n".join(words)))
        stems = "\n".join(stems).lower().split("\n")
        pieces, whole = [], []
        for n, word in enumerate(plain):
            if word and not self.added.search(word):
                pieces.append((n, _PIECES(word.lower())))
            elif word or others[n]:
                whole.append((n, word or others[n]))
        known = self._known({*stems, *marks}.union(*(found for _, found in pieces)))
        out = [known[stem] + known[mark] for stem, mark in zip(stems, marks)]
        for n, found in pieces:
            out[n] = b"".join(map(known.__getitem__, found))
        for (n, _), ids in zip(whole, self._each([word for _, word in whole])):
            out[n] = ids
        return out

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, f"<u{self.width}").tobytes() for one in found]

    def _known(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of lower-case pieces, from what is remembered or from the tokenizer's model."""
        known, new = self.memory.split(list(pieces))
        tokenize = self.tokenizer.model.tokenize
        for at in range(0, len(new), TOGETHER):
            run = new[at : at + TOGETHER]
            tokens = [tokenize(piece if piece.isascii() and piece.isalpha() else self._spelled(piece)) for piece in run]
            data = np.array([token.id for one in tokens for token in one], f"<u{self.width}").tobytes()
            stops = (np.cumsum([len(one) for one in tokens], dtype=np.int64) * self.width).tolist()
            known.update((piece, data[a:b]) for piece, a, b in zip(run, [0, *stops], stops))
        self.memory.add(new, [known[piece] for piece in new])
        return known

    def _spelled(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.spelling)


def worker_encoder(definition: str, width: int) -> WordEncoder:
    """The encoder of this Python worker, kept from task to task."""
    held = sys.__dict__.setdefault("_millwright_encoders", {})
    key = (zlib.crc32(definition.encode()), len(definition), width)
    if key not in held:
        held.clear()
        held[key] = WordEncoder(definition, width)
    return held[key]


def id_width(definition: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def write_records(
    docs: DataFrame, path: str, definition: str, end_id: int, order: list[Column] | None = None, id_col: str = "doc_id"
) -> None:
    """Encode every text and write the records in ascending ``order`` (by default the id)."""
    bounded_batches(docs.sparkSession)
    width = id_width(definition, end_id)
    end = np.array([end_id], f"<u{width}").tobytes()
    order = order or [F.col(id_col)]
    keys = {f"key{n}": column for n, column in enumerate(order)}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8("text").alias("text"), *[c.alias(n) for n, c in keys.items()])
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES))
    sorted_rows = rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys, F.xxhash64("text"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(definition, width)
        for batch in batches:
            ids = [one + end for one in encoder.ids(batch.column(1).to_pylist())]
            # Arrow's allocator keeps what a batch needed, beside the JVM's memory, unless asked
            pa.default_memory_pool().release_unused()
            records = [frame(doc, one, len(one) // width) for doc, one in zip(batch.column(0).to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    encoded = sorted_rows.select("doc_id", "text", *keys).mapInArrow(encode, "record binary")
    # the text writer passes bytes through as they are
    encoded.select(F.col("record").cast("string")).write.option("lineSep", "\n").text(path)


def read_index(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Read all files, check every record, and give where each stands; see ``INDEX``."""
    bounded_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = pa.schema(
            [("file", pa.string())]
            + [(name.split()[0], pa.int64()) for name in INDEX.split(", ")[1:]]
        )
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                number = int(file.rsplit("part-", 1)[1].split("-")[0])
                rows, start = [], 0
                for place, (offset, length, doc_id, ids) in enumerate(frames(content.as_py(), width)):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((file, number, place, offset, length, doc_id, start, len(ids), crc))
                    start += len(ids)
                columns = list(zip(*rows)) or [()] * len(layout)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, layout)], schema=layout)

    return files.mapInArrow(index, INDEX)


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, width: int, seed: int) -> DataFrame:
    """Records (doc_id, ids) in a pseudo-random order given by the seed.

    Files are read in a random order and records are drawn through the index
    at random within each file; a file is the unit, so reads stay sequential.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.col("path").alias("file"), "content")
    drawn = index.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct(F.xxhash64(F.lit(seed), "place").alias("draw"), "offset", "length"))).alias("at")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, at in zip(batch.column(0), batch.column(1).to_pylist()):
                content = content.as_py()
                records = [next(frames(content[a["offset"] : a["offset"] + a["length"]], width)) for a in at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc for _, _, doc, _ in records], pa.int64()),
                        pa.array([ids.astype(np.int32) for *_, ids in records], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "ids"],
                )

    joined = files.join(drawn, "file").orderBy(F.xxhash64(F.lit(seed), "file"))
    return joined.select("content", "at").mapInArrow(read, "doc_id long, ids array<int>")


def with_start(index: DataFrame) -> DataFrame:
    """The index with ``start``, the number of tokens before the record in all files.

    Only one total per file is summed up in a single task.
    """
    totals = index.groupBy("file_no").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file_no", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return index.join(bases, "file_no").withColumn("start", F.col("base") + F.col("start_in_file"))


def encode_to_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, order: list[Column] | None = None, path: str | None = None
) -> DataFrame:
    """Write records and their index below ``path``; per record what was read back from the files.

    The index is built by reading the records, so the two cannot disagree, and
    is stored beside them as a table.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    write_records(docs, f"{path}/records", definition, end_id, order)
    width = id_width(definition, end_id)
    read_index(spark, f"{path}/records", width).write.parquet(f"{path}/index")
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    return with_start(index).select("doc_id", "start", "n_tokens", "ids_crc32")
