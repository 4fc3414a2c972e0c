"""Exact duplicates by deterministic block naming; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.support import FILE, PLACE, keep_located, located
from starloom.session import materialize

BLOCK_BYTES = 4096
# What needs a change: runs of white space, and single white space other than a blank.
SPACES = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
_NO_RIGHT = -(1 << 63)


def normalized(text: Column) -> Column:
    """Each run of ASCII white space as one blank; NULL as empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _blocks(size: int) -> Column:
    """The bytes in ``__bytes`` cut into blocks; empty text is one empty block."""
    last = F.greatest(F.ceil(F.length("__bytes") / size), F.lit(1)).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(F.col("__bytes"), i * size + 1, F.lit(size))
    )


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """A unique integer per row, rising with ``order`` inside each partition."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def named_blocks(docs: DataFrame, text: str, block_bytes: int, hashed: Callable) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with a row number, and ``(row, pos, name)`` for each of their blocks.

    Two blocks get the same name exactly if their bytes are equal. Every
    distinct block crosses the network once, to be sorted and numbered. The
    occurrences carry a 64-bit hash instead of the bytes; they find the
    name by it. Different blocks that share a hash are found by counting names per hash, and the
    occurrences of those, and only those, find their names by the bytes.
    """
    cut = docs.withColumn("__bytes", normalized(F.col(text)).cast("binary"))
    blocks = cut.withColumn("__blocks", _blocks(block_bytes))
    rows = materialize(
        blocks.select(
            *[c for c in docs.columns if c != text],
            F.sha2("__bytes", 256).alias("text_sha256"),
            F.length("__bytes").cast("bigint").alias("bytes"),
            F.transform("__blocks", lambda block: hashed(block)).alias("hashes"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    # outer: an inferred "not empty" filter would normalise the text once more per use
    contents = blocks.select(F.explode_outer("__blocks").alias("block")).select(hashed(F.col("block")).alias("h"), "block")
    names = materialize(_numbered(contents.distinct(), ["h", "block"]).select("h", "name"), "names")
    occurrences = rows.select("row", F.posexplode("hashes").alias("pos", "h"))
    shared = materialize(names.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "shared")
    if shared.isEmpty():
        return rows, occurrences.join(names, "h").select("row", "pos", "name")
    plain = occurrences.join(names.join(shared, "h", "left_anti"), "h").select("row", "pos", "name")
    placed = blocks.select(FILE, PLACE, F.posexplode_outer("__blocks").alias("pos", "block"))
    unclear = materialize(placed.withColumn("h", hashed(F.col("block"))).join(shared, "h", "left_semi"), "unclear")
    own = materialize(_numbered(unclear.select("h", "block").distinct(), ["h", "block"]), "own")
    by_bytes = unclear.join(own.withColumn("name", -1 - F.col("name")), ["h", "block"])
    exact = by_bytes.join(rows.select(FILE, PLACE, "row"), [FILE, PLACE]).select("row", "pos", "name")
    return rows, plain.unionByName(exact)


def identities(
    docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES, hashed: Callable = F.xxhash64
) -> DataFrame:
    """Rows of ``located`` documents with ``text_sha256``, ``bytes``, ``row`` and ``name``.

    Two texts are equal exactly if ``bytes`` and ``name`` are: the blocks of a
    text are named, then adjacent pairs of names, level by level, until one name is
    left. Texts of equal length take the same number of levels, so a name is
    only compared with names of its own level. Each level is written to the
    shared folder and handles only texts that still have several names.
    """
    rows, level = named_blocks(docs, text, block_bytes, hashed)
    rows = rows.withColumn("blocks", F.size("hashes")).drop("hashes")
    longest = rows.agg(F.max("blocks")).first()[0] or 0
    level = materialize(level.join(rows.select("row", "blocks"), "row"), "level") if longest > 1 else level
    done = level.where("blocks = 1").select("row", "name") if longest > 1 else level.select("row", "name")
    width = 1
    if longest > 1:
        level = level.where("blocks > 1")
    while width < longest:
        width *= 2
        side = lambda bit: F.min(F.when(F.col("pos").bitwiseAND(1) == bit, F.col("name")))
        pairs = level.groupBy("row", "blocks", F.shiftright("pos", 1).alias("pos")).agg(
            side(0).alias("l"), F.coalesce(side(1), F.lit(_NO_RIGHT)).alias("r")
        )
        names = materialize(_numbered(pairs.select("l", "r").distinct(), ["l", "r"]), "pairs")
        level = materialize(pairs.join(names, ["l", "r"]).select("row", "pos", "name", "blocks"), "level")
        done = done.unionByName(level.where(F.col("blocks") <= width).select("row", "name"))
        level = level.where(F.col("blocks") > width)
    return materialize(rows.join(done, "row"), "identities")


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hashed=F.xxhash64
) -> DataFrame:
    """One row per document: its group of equal texts and whether it is the one that stays.

    Returns ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and
    the two columns of ``located``. Texts are equal when identical after
    ``normalized``; NULL equals empty text. The row with the smallest key
    stays, NULL keys last; of rows that repeat the key, the first by file and
    place. ``keep_id`` is NULL only if no row of the group has a key. An empty
    table gives no rows. Other columns of ``docs`` do not matter, whatever their names.
    """
    lean = located(docs).select(F.col(key).alias("key"), F.col(text).alias("text"), FILE, PLACE)
    named = identities(lean, "text", block_bytes, hashed)
    first = F.struct(F.col("key").isNull(), "key", FILE, PLACE)
    groups = materialize(
        named.groupBy("bytes", "name").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size")),
        "groups",
    )
    joined = named.join(groups, ["bytes", "name"])
    stays = (F.col(FILE) == F.col(f"first.{FILE}")) & (F.col(PLACE) == F.col(f"first.{PLACE}"))
    return joined.select(
        F.col("key").alias(key),
        F.col("first.key").alias("keep_id"),
        "group_size",
        stays.alias("kept"),
        "text_sha256",
        FILE,
        PLACE,
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per group of equal texts; the columns stay as they are."""
    placed = located(docs)
    return keep_located(placed, exact_groups(placed, key, text).where("kept"))
