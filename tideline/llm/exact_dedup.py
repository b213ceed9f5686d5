"""Exact deduplication by distributed MSD radix partitioning.

Documents are told apart by successive blocks of their UTF-8 bytes, most
significant first, each eight times as long as the one before; no digest decides
equality. A group is done when it is a singleton or *ended*: its texts stop inside the
block, so they are equal.

1. *Large groups* are split by all executors together. Each level groups the rows still
   open by (group, block) with a partial aggregate, so copies collapse before the shuffle.
   There are at most ``max_hot`` large groups a level, because each holds over
   ``rows / max_hot`` rows; their keys are broadcast if their bytes, which are counted, are
   within ``BROADCAST_BYTES``, and joined by salted keys if not. The texts are read for the
   first level and once more for the rows of large groups, which are written as (id, rest of
   the text) for the levels below.
2. *Small groups.* One exchange sends each row to the bucket of its deepest large group and
   next block. There the recursion goes on in the same way, a level for each block, until
   all groups are singletons or ended. Rows of ended large groups need no comparison any
   more: size and survivor are known from the aggregate, and they are spread by id, so a
   text that a third of all rows share is split evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import PREFIX, drop, materialise, restored, set_aside, text_or_empty, utf8, without

FIRST_BLOCK = 32
GROWTH = 8
MAX_HOT = 16384
MIN_BUCKET_ROWS = 200
BROADCAST_BYTES = 16 << 20
SALTS = 32
ADDED = ("keep_id", "group_size", "kept")

PATH, BLOCK, HOT, KEEP, SIZE, TEXT, ID, SALT = (
    PREFIX + x for x in ("path", "block", "hot", "keep", "size", "text", "id", "salt")
)
#: The finest group so far inside a bucket, the rows in it, and a number that only one row of the bucket has.
GROUP, ROWS, NUMBER = PREFIX + "group", PREFIX + "rows", PREFIX + "number"


def _block(raw: Column, offset: int, width: int) -> Column:
    return F.substring(raw, offset + 1, width)


class _Level:
    """The large groups of one level; ``offset`` and ``width`` say which bytes tell them apart."""

    def __init__(self, offset: int, width: int, groups: DataFrame, key_bytes: int):
        self.offset, self.width, self.groups = offset, width, groups
        self.small = key_bytes <= BROADCAST_BYTES

    def join(self, rows: DataFrame, raw: Column) -> DataFrame:
        """``rows`` with BLOCK, and HOT, SIZE and KEEP of the large group they are in (else null)."""
        right = self.groups.select(F.col(PATH).alias("__tl_parent"), F.col(BLOCK).alias("__tl_key"), HOT, SIZE, KEEP)
        out = rows.withColumn(BLOCK, _block(raw, self.offset, self.width))
        same = (F.col(PATH) == F.col("__tl_parent")) & (F.col(BLOCK) == F.col("__tl_key"))
        if self.small:
            return out.join(F.broadcast(right), same, "left").drop("__tl_parent", "__tl_key")
        # Every key once for each salt, so that the rows of a large group spread over many tasks.
        right = right.withColumn("__tl_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = out.withColumn(SALT, F.pmod(F.xxhash64(ID), F.lit(SALTS)).cast("int"))
        return out.join(right, same & (F.col(SALT) == F.col("__tl_s")), "left").drop("__tl_parent", "__tl_key", "__tl_s", SALT)


def _large_groups(base: DataFrame, rows: int, bucket: int, first_block: int) -> tuple[list[_Level], int]:
    """All levels of groups of more than ``bucket`` rows, and the bytes of the longest text."""
    levels: list[_Level] = []
    raw = utf8(F.col(TEXT))
    # The longest text is noted while the first level reads them all.
    seen = Observation()
    open_rows = base.select(ID, raw.alias(TEXT), F.lit(-1).cast("long").alias(PATH))
    open_rows = open_rows.observe(seen, F.max(F.octet_length(TEXT)).alias("longest"))
    rest, from_byte = None, 0
    offset, width, first_path = 0, first_block, 0
    while True:
        local = offset - from_byte
        found = open_rows.groupBy(PATH, _block(F.col(TEXT), local, width).alias(BLOCK)).agg(
            F.count("*").alias(SIZE), F.max(ID).alias(KEEP)
        )
        # Numbers are given once: they are written with the groups.
        hot = found.filter(F.col(SIZE) > bucket).withColumn(HOT, F.monotonically_increasing_id() + F.lit(first_path))
        numbered = materialise(hot, "radix")
        n_hot, n_open, top, size = numbered.agg(
            F.count("*"), F.count(F.when(F.octet_length(BLOCK) == width, 1)), F.max(HOT), F.sum(F.octet_length(BLOCK) + 64)
        ).first()
        if n_hot:
            levels.append(_Level(offset, width, numbered, size))
        else:
            drop(numbered)
        if not n_open:
            break
        first_path = top + 1
        joined = _Level(local, width, numbered, size).join(open_rows, F.col(TEXT))
        joined = joined.filter(F.col(SIZE).isNotNull() & (F.octet_length(BLOCK) == width))
        if rest is None:
            # What is left of the rows still open, for all levels below: the texts are not read again for these.
            rest = materialise(joined.select(ID, F.substring(TEXT, width + 1, 2**31 - 1).alias(TEXT), F.col(HOT).alias(PATH)), "rest")
            open_rows, from_byte = rest, width
        else:
            open_rows = joined.select(ID, TEXT, F.col(HOT).alias(PATH))
        offset, width = offset + width, width * GROWTH
    if rest is not None:
        drop(rest)
    return levels, (seen.get["longest"] or 0) if rows else 0


def mark_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_hot: int = MAX_HOT,
    min_bucket_rows: int = MIN_BUCKET_ROWS,
    first_block: int = FIRST_BLOCK,
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``keep_id``, ``group_size``, ``kept``.

    Of equal texts the row with the largest id stays. A null text counts as
    empty. Null ids sort below all others (``keep_id`` is null only where all ids
    of a group are). Repeated rows with one id: exactly one is kept. An empty
    table gives an empty result. Input columns named like the three added ones
    are replaced.

    Groups of at most ``max(min_bucket_rows, rows / max_hot)`` rows are split further inside the
    task that has them, larger ones by all executors; both go down to singletons and ended groups.
    """
    base = (
        without(docs, *ADDED)
        .withColumn(TEXT, text_or_empty(text_col))
        .withColumn(ID, F.col(id_col))
    )
    n = docs.count()
    levels, longest = _large_groups(base, n, max(min_bucket_rows, n // max_hot), first_block)

    # Deepest large group of each row, and how many bytes that group shares.
    raw = utf8(F.col(TEXT))
    id_type = base.schema[ID].dataType
    rows = base.select(
        "*", F.lit(-1).cast("long").alias(PATH), F.lit(False).alias("__tl_ended"), F.lit(None).cast(id_type).alias("__tl_keep0"),
        F.lit(None).cast("long").alias("__tl_size0"), F.lit(0).alias("__tl_depth"),
    )
    for depth, level in enumerate(levels):
        joined = level.join(rows, raw)
        hit = F.col(SIZE).isNotNull()
        ended = hit & (F.octet_length(BLOCK) < level.width)
        rows = joined.select(
            *[F.col(f"`{c}`") for c in base.columns],
            F.when(hit, F.col(HOT)).otherwise(F.col(PATH)).alias(PATH),
            (F.col("__tl_ended") | ended).alias("__tl_ended"),
            F.when(ended, F.col(KEEP)).otherwise(F.col("__tl_keep0")).alias("__tl_keep0"),
            F.when(ended, F.col(SIZE)).otherwise(F.col("__tl_size0")).alias("__tl_size0"),
            F.when(hit, F.lit(depth + 1)).otherwise(F.col("__tl_depth")).alias("__tl_depth"),
        )
    ended = F.col("__tl_ended")
    bounds = _bounds(longest, first_block)

    def block_at(depth: int) -> Column:
        offset, width = bounds[depth] if depth < len(bounds) else (2**30, 1)
        return _block(raw, offset, width)

    # The block is hashed only to choose a partition; blocks themselves are compared below.
    below = block_at(0)
    for depth in range(len(levels)):
        below = F.when(F.col("__tl_depth") == depth + 1, block_at(depth + 1)).otherwise(below)
    # Of an ended group only rows of the id that stays must meet; those without an id are spread by place.
    place = F.when(F.col(ID).isNull() & F.col("__tl_keep0").isNotNull(), F.xxhash64(F.monotonically_increasing_id()))
    dealt = F.when(ended, F.coalesce(place, F.xxhash64(F.col(ID).cast("string")))).otherwise(F.xxhash64(below))
    rows = rows.withColumn(BLOCK, dealt).repartition(PATH, BLOCK)

    # From here on all windows stay inside the partition: each level splits the groups of the one above.
    rows = rows.withColumn(NUMBER, F.monotonically_increasing_id())
    start = Window.partitionBy(PATH, BLOCK)
    rows = rows.withColumn(GROUP, F.min(NUMBER).over(start)).withColumn(ROWS, F.count("*").over(start))
    for depth in range(len(bounds)):
        # A row starts with the block below its deepest large group; earlier ones are shared by all of its group.
        open_ = ~ended & (F.col(ROWS) > 1) & (F.col("__tl_depth") <= depth)
        rows = rows.withColumn("__tl_part", F.when(open_, block_at(depth)))
        split = Window.partitionBy(PATH, BLOCK, GROUP, "__tl_part")
        rows = rows.withColumn("__tl_g", F.min(NUMBER).over(split)).withColumn(ROWS, F.count("*").over(split))
        rows = rows.drop(GROUP, "__tl_part").withColumnRenamed("__tl_g", GROUP)
    order = Window.partitionBy(PATH, BLOCK, GROUP).orderBy(F.col(ID).desc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("__tl_rank", F.row_number().over(order)).withColumn("__tl_max", F.max(F.col(ID)).over(whole))
    return rows.select(
        *[F.col(f"`{c}`") for c in base.columns if c not in (TEXT, ID)],
        F.when(ended, F.col("__tl_keep0")).otherwise(F.col("__tl_max")).alias("keep_id"),
        F.when(ended, F.col("__tl_size0")).otherwise(F.col(ROWS)).alias("group_size"),
        ((F.col("__tl_rank") == 1) & (~ended | F.col(ID).eqNullSafe(F.col("__tl_keep0")))).alias("kept"),
    )


def _bounds(longest: int, first_block: int) -> list[tuple[int, int]]:
    """(offset, width) of the blocks that cover ``longest`` bytes, and one more: there all texts have ended."""
    out, offset, width = [], 0, first_block
    while offset <= longest:
        out.append((offset, width))
        offset, width = offset + width, width * GROWTH
    return out


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The surviving rows, with the columns of ``docs`` only (clashing names survive too)."""
    inner, new = set_aside(docs, *ADDED)
    return restored(mark_duplicates(inner, new[id_col], new[text_col]).filter("kept"), new)
