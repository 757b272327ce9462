"""Exact copies of whole texts.

Two texts are equal if they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``. Rows are grouped by the MD5 digest of what is left, 128
bits. Of a group, the row with the most code points in its original text
stays, then the one with the smallest id.

Equal digests are not taken for equal texts: the smallest and the largest text
of every group of two or more are compared byte by byte. Both are combined on
the map side, so a group that holds a third of all rows costs two texts per
task. The rows of a digest that stands for different texts are grouped anew by
the texts themselves.

Null counts as an empty text. A null id comes after all others. Rows of equal
id and length are told apart by their place in the table, so one row per group
stays, also among repeated rows. An empty table gives an empty result; further
columns are ignored.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import stored

#: white space that does not count: space, and tab to carriage return
WHITE = " \t\n\x0b\x0c\r"
#: bits of the filter on digests that occur more than once; a full filter lets every text pass and only costs time
SHARED_BITS = 1 << 25
_BITMAP = 1 << 15

Digest = Callable[[Column], Column]


def normalised(text: str | Column) -> Column:
    """The text without white space; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def content_digest(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text.cast("binary")))


def _slot(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(SHARED_BITS))


def _possibly_in(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows whose ``digest`` is among ``digests``, and perhaps some others.

    The filter is a set of bitmaps, built in Spark; all of it, at most
    ``SHARED_BITS`` bits, goes to every task.
    """
    slots = digests.select(_slot(F.col("digest")).alias("slot"))
    maps = slots.groupBy(F.floor(F.col("slot") / _BITMAP).alias("map")).agg(
        F.bitmap_construct_agg(F.pmod("slot", F.lit(_BITMAP))).alias("bits")
    )
    slot = _slot(F.col("digest"))
    byte = F.substring("bits", (F.pmod(slot, F.lit(_BITMAP)) / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    set_there = F.expr("shiftright(value, cast(pmod(slot, 8) as int)) & 1") == 1
    columns = rows.columns
    return (
        rows.withColumn("slot", slot)
        .withColumn("map", F.floor(F.col("slot") / _BITMAP))
        .join(F.broadcast(maps), "map")
        .withColumn("value", value)
        .filter(set_there)
        .select(*columns)
    )


def _stays() -> Column:
    """The first of these is the row that stays."""
    return F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "row")


def _groups(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("size"), F.min(_stays()).alias("first"))


def _judged(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Every row with its group's first row; a row without a group stands alone."""
    first = F.coalesce(F.col("first"), _stays())
    return rows.join(groups, list(keys), "left").select(
        "doc_id",
        first["doc_id"].alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (first["row"] == F.col("row")).alias("kept"),
        "text_sha256",
    )


def judged(docs: DataFrame, digest: Digest = content_digest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.char_length(text).alias("chars"),
            digest(normalised(text_col)).alias("digest"),
            F.sha2(normalised(text_col).cast("binary"), 256).alias("text_sha256"),
        ),
        "digests",
    )
    groups = stored(_groups(digests, "digest").filter("size > 1"), "digest-groups")

    plain = normalised(text_col)
    texts = docs.select(digest(plain).alias("digest"), F.col(id_col).alias("doc_id"), F.char_length(text).alias("chars"), plain.alias("plain"))
    shared = _possibly_in(texts, groups)
    ends = shared.groupBy("digest").agg(F.min("plain").alias("low"), F.max("plain").alias("high"))
    collided = stored(ends.filter("low <> high").select("digest"), "collided-digests")
    if collided.isEmpty():
        return _judged(digests, groups, "digest")

    # practically never: these few rows go by the texts, numbered anew as their digests say nothing
    apart = digests.join(collided, "digest", "left_anti")
    again = stored(
        texts.join(collided, "digest").select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "chars", "plain",
            F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256"),
        ),
        "collided-texts",
    )
    by_text = _judged(again, _groups(again, "plain"), "plain")
    return _judged(apart, groups, "digest").unionByName(by_text)


def without_copies(docs: DataFrame, digest: Digest = content_digest) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows with equal id and equal text any one stays.
    """
    rows = docs.select(F.struct(*docs.columns).alias("document"), F.col("doc_id"), F.col("text"))
    found = judged(rows, digest).filter("kept").select(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("sha"))
    marked = rows.withColumn("sha", F.sha2(normalised("text").cast("binary"), 256)).withColumn(
        "chars", F.char_length(F.coalesce(F.col("text"), F.lit("")))
    )
    same = marked["doc_id"].eqNullSafe(found["keep_id"]) & (marked["sha"] == found["sha"])
    kept = marked.join(found, same, "left_semi")
    first = kept.groupBy("doc_id", "sha").agg(F.max_by("document", "chars").alias("document"))
    return first.select("document.*")
