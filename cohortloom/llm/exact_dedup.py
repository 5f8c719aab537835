"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and
numbered: equal blocks, and only they, share a name. Adjacent names are then paired and
the distinct pairs named again, until each text has one name. The number of rounds and
that name identify a text without collisions, whatever its length.

Everything is Column expressions. Blocks travel as 16-byte keys. Only blocks whose key
occurs again can equal another one: their contents are shuffled once, after combining
equal blocks on the map side, so copies of one text cost a row per task. This proves that
no two blocks share a key, else the contents themselves are named and joined. Joins on a
hot name are ordinary equi-joins that AQE splits.

Defined results: null counts as the empty text, which is one empty block; the row with
the largest id stays (null ids are smallest), and of rows that also share the id exactly
one; an empty table gives no rows; columns in ``carry`` keep their names, and a clash
with a computed column raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import ascii_lower, free_names, small_ids, Stages, text_of

BLOCK_BYTES = 16 << 10
COMPUTED = ["keep_id", "group_size", "kept", "text_sha256"]


def block_key(block: Column) -> Column:
    return F.struct(F.xxhash64(block).alias("a"), F.xxhash64(F.lit(7), block).alias("b"))


def _blocks(content: Column, n_blocks: Column, size: int) -> Column:
    """Binary slices take constant time each, unlike slices of a string."""
    return F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda i: F.substring(content, i * size + 1, F.lit(size)),
    )


def _named(distinct: DataFrame, order: Sequence[str]) -> DataFrame:
    """Number distinct rows: partitions hold disjoint keys, each sorted."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def identities(rows: DataFrame, stages: Stages, size: int = BLOCK_BYTES) -> DataFrame:
    """``row``, ``rounds``, ``name`` for rows (``row``, ``content`` binary, ``n_blocks`` int)."""
    contents = _blocks(F.col("content"), F.col("n_blocks"), size)
    keys = F.transform(contents, block_key)
    dictionary = stages.keep(
        _named(rows.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count("*").alias("n")), ["key"]), "blocks"
    )
    blocks = rows.select(F.explode(contents).alias("block"))
    again = stages.keep(dictionary.filter("n > 1").select(F.col("key.a").alias("a")).distinct(), "again")
    met = blocks.withColumn("key", block_key(F.col("block"))).withColumn("a", F.col("key.a"))
    met = met.join(small_ids(again), "a", "left_semi").select("key", "block").distinct()
    clashes = met.groupBy("key").count().filter("count > 1").limit(1).count()
    stages.drop(again)
    if clashes:
        stages.drop(dictionary)
        dictionary = stages.keep(
            _named(blocks.distinct(), ["block"]).select(F.col("block").alias("key"), "name"), "contents"
        )
        keys = contents
    spread = rows.select("row", "n_blocks", F.posexplode(keys).alias("at", "key"))
    level = stages.keep(
        spread.join(dictionary.select("key", "name"), "key").select("row", "n_blocks", F.col("at").cast("long").alias("at"), "name"),
        "level",
    )
    stages.drop(dictionary)
    most = level.agg(F.max("n_blocks")).first()[0] or 1  # one number
    done, rounds, width = [], 0, 1
    while True:
        done.append(level.filter(F.col("n_blocks") == 1).select("row", F.lit(rounds).alias("rounds"), "name"))
        if width >= most:
            break
        open_rows = level.filter("n_blocks > 1")
        side = F.col("at") % 2
        pairs = stages.keep(
            open_rows.groupBy("row", "n_blocks", F.floor(F.col("at") / 2).alias("at")).agg(
                F.max(F.when(side == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1).cast("long")).alias("right"),
            ),
            "pairs",
        )
        names = stages.keep(_named(pairs.select("left", "right").distinct(), ["left", "right"]), "names")
        level = stages.keep(
            pairs.join(names, ["left", "right"]).select(
                "row", F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks"), "at", "name"
            ),
            "level",
        )
        stages.drop(pairs, names)
        rounds, width = rounds + 1, width * 2
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def exact_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] = ("doc_id",),
    size: int = BLOCK_BYTES, stages: Stages | None = None,
) -> DataFrame:
    """``carry``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``: a row per input row."""
    if clash := {c.lower() for c in carry} & {*COMPUTED, "__row", "__id"}:
        raise ValueError(f"columns {sorted(clash)} are also computed; rename them or leave them out")
    stages = stages or Stages(docs.sparkSession)
    carried = [F.col(f"`{c}`") for c in carry]
    normal = docs.select(
        *carried, F.col(f"`{doc_id}`").alias("__id"), ascii_lower(text_of(f"`{text}`")).alias("__text")
    )
    rows = stages.keep(
        normal.select(
            F.monotonically_increasing_id().alias("__row"), *carried, "__id",
            F.sha2("__text", 256).alias("text_sha256"), *_content(size),
        ),
        "rows",
    )
    return rows.join(verdicts(rows, stages, size), "__row").select(*carried, *COMPUTED)


def _content(size: int) -> list[Column]:
    """The bytes and the number of blocks of the normal text."""
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("__text") / size)).cast("int")
    return [F.col("__text").cast("binary").alias("content"), n_blocks.alias("n_blocks")]


def verdicts(rows: DataFrame, stages: Stages, size: int = BLOCK_BYTES) -> DataFrame:
    """``__row``, ``keep_id``, ``group_size``, ``kept`` for rows (``__row``, ``__id``, ``content``, ``n_blocks``)."""
    named = identities(rows.select(F.col("__row").alias("row"), "content", "n_blocks"), stages, size)
    tagged = rows.select("__row", "__id").join(named.withColumnRenamed("row", "__row"), "__row")
    tagged = stages.keep(tagged, "tagged")
    groups = stages.keep(
        tagged.groupBy("rounds", "name").agg(
            F.count("*").alias("group_size"), F.max(F.struct("__id", "__row")).alias("best")
        ),
        "groups",
    )
    verdict = tagged.join(groups, ["rounds", "name"]).select(
        "__row", F.col("best.__id").alias("keep_id"), "group_size",
        (F.col("__row") == F.col("best.__row")).alias("kept"),
    )
    return stages.keep(verdict, "verdict")


def drop_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = BLOCK_BYTES,
    stages: Stages | None = None,
) -> DataFrame:
    """The input rows that stay, with the input's columns, whatever their names.

    Only the row numbers of dropped rows are joined to the texts, as an anti join. The texts
    are written once, with the row numbers.
    """
    stages = stages or Stages(docs.sparkSession)
    (number,) = free_names(docs.columns, "__number")
    rows = stages.keep(docs.withColumn(number, F.monotonically_increasing_id()), "input")
    normal = rows.select(
        F.col(number).alias("__row"), F.col(f"`{doc_id}`").alias("__id"), ascii_lower(text_of(f"`{text}`")).alias("__text")
    )
    verdict = verdicts(normal.select("__row", "__id", *_content(size)), stages, size)
    dropped = stages.keep(verdict.filter("not kept").select(F.col("__row").alias(number)), "dropped")
    return rows.join(small_ids(dropped), number, "left_anti").drop(number)
