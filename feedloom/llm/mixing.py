"""Mixing sources to target weights, with DataFrame functions only.

Each source's words form one stream of documents, cut into blocks of fixed
length.  A source owes ``target`` words; it has one slot per block it must give
(a second pass over its blocks where the target exceeds its size).

Every slot falls into a random output shard, so the numbers of a source's slots
in the shards are a multinomial draw, conditioned on the totals that the targets
fix.  Running sums of a source's counts give each shard its stretch of the
source's slots.  A slot is mapped to a block by its source's pseudorandom
permutation for that pass: a keyed Feistel network over two factors whose product
is a little more than the number of blocks, walked on while it leaves the range.
Blocks are joined by (source, index).  The last slot of a source takes only the
words still owed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import WORD, need_columns, stored

BLOCK_WORDS = 128
SHARD_SLOTS = 1024
SHARE = 1.5
REPEATS = 2
WEIGHTS = (5, 2, 1)
# Documents of a source are laid out in so many stretches, each numbered apart.
STRETCHES = 1024
# Steps that a permutation may walk outside its range: below 5,000 blocks never more
# are needed; beyond, a step stays outside with a chance below 1 in 70.
WALK = 72


def document_sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size in words.  Rows that repeat a doc_id and source add up."""
    need_columns(documents, "doc_id", "text", "source")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sizes = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"))
    return sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))


def weighted_targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """Per source: rank (by code point, null last), weight, source_size, target.

    Weights repeat 5, 2, 1.  Shares stop at ``REPEATS`` times a source's size;
    what is left is shared again by weight.  With sources ordered by size over
    weight, the full ones are a prefix, so one pass finds the common level.
    Only one row per source is ever in these windows.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1))
    sources = sources.withColumn("rank", rank).withColumn("weight", weight)
    all_rows = W.partitionBy()
    by_level = W.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    total = (F.sum("source_size").over(all_rows) * F.lit(share)).alias("total")
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * REPEATS
    rest = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sources = sources.select("*", total, full.alias("full"), rest.alias("rest"))
    level = (F.col("total") - F.col("full")) / F.col("rest")
    # The first source whose limit lies above the level that is then left.
    fits = level * F.col("weight") < F.col("source_size") * REPEATS
    sources = sources.withColumn("level", F.min(F.when(fits, F.struct("full", level.alias("x")))).over(all_rows)["x"])
    cap = (F.col("source_size") * REPEATS).cast("double")
    target = F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("level") * F.col("weight")))
    return sources.select("source", "rank", "weight", "source_size", target.alias("target"))


def _laid_out(sizes: DataFrame) -> DataFrame:
    """Adds ``at``: words of the source before the document, in stretch order."""
    stretch = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(STRETCHES)).alias("stretch")
    docs = sizes.select("*", stretch)
    heads = docs.groupBy("rank", "stretch").agg(F.sum("size").alias("words"))
    before = W.partitionBy("rank").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    heads = heads.select("rank", "stretch", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("head"))
    inside = W.partitionBy("rank", "stretch").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    docs = docs.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    docs = docs.join(heads, ["rank", "stretch"])
    return docs.select("doc_id", "rank", "size", (F.col("head") + F.col("inner")).alias("at"))


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` found once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _random(*parts: Column | str | int) -> Column:
    """A number below 2**32 that the parts fix."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _network(x: Column, a: Column, b: Column, key: tuple[Column, Column], back: bool) -> Column:
    """Four Feistel rounds on x = left * b + right, left below a and right below b."""

    def turn(part: Column, by: Column, no: int, size: Column) -> Column:
        step = _random(*key, no, by)
        return F.pmod(part - step if back else part + step, size)

    left, right = F.floor(x / b), x % b
    if back:
        return _let(right, lambda r0: _let(left, lambda l0: _let(turn(r0, l0, 3, b), lambda r1: _let(
            turn(l0, r1, 2, a), lambda l1: _let(turn(r1, l1, 1, b), lambda r2: turn(l1, r2, 0, a) * b + r2)))))
    return _let(left, lambda l0: _let(right, lambda r0: _let(turn(l0, r0, 0, a), lambda l1: _let(
        turn(r0, l1, 1, b), lambda r1: _let(turn(l1, r1, 2, a), lambda l2: l2 * b + turn(r1, l2, 3, b))))))


def permuted(turn: Column, blocks: Column, rank: Column, no: Column, back: bool = False) -> Column:
    """Block index of the ``turn``-th slot of pass ``no``: a bijection on 0 .. blocks-1.

    ``back`` gives the slot of a block.
    """
    a = F.ceil(F.sqrt(blocks))
    b = F.ceil(blocks / a)

    def step(x: Column) -> Column:
        return _network(x, a, b, (rank, no), back).cast("long")

    steps = F.sequence(F.lit(1), F.lit(WALK))
    return F.aggregate(steps, step(turn), lambda x, _: F.when(x < blocks, x).otherwise(step(x)))


def _owed_slots(targets: DataFrame, block_words: int) -> DataFrame:
    """Per source: rank, words, owed, blocks, shards, and how many slots it gives.

    Only the last block is short; words before a slot depend on whether it came
    earlier (``short_0`` and ``short_1``: its slot in each pass).  One row per source.
    """
    owed = targets.select("rank", F.col("source_size").alias("words"), F.round("target").cast("long").alias("owed"))
    total = F.sum("owed").over(W.partitionBy())
    shards = F.greatest(F.lit(1), F.ceil(total / (block_words * SHARD_SLOTS))).cast("long")
    owed = owed.withColumn("shards", shards).where("words > 0 AND owed > 0")
    owed = owed.withColumn("blocks", F.expr(f"(words + {block_words - 1}) div {block_words}"))
    missing = F.col("blocks") * block_words - F.col("words")
    given = F.lit(0).cast("long")
    for no in range(REPEATS):
        short = permuted(F.col("blocks") - 1, F.col("blocks"), F.col("rank"), F.lit(no), back=True)
        owed = owed.withColumn(f"short_{no}", short)
        due = F.least("words", F.greatest(F.lit(0), F.col("owed") - no * F.col("words")))
        early = F.ceil(due / block_words)
        late = F.least("blocks", F.ceil((due + missing) / block_words))
        given = given + F.when(early <= F.col(f"short_{no}") + 1, early).otherwise(
            F.greatest(F.col(f"short_{no}") + 1, late)
        )
    return owed.withColumn("slots", given.cast("long"))


def draw_counts(numbers: DataFrame) -> DataFrame:
    """The draw: how many slots of each source fall into each output shard.

    ``numbers`` has a row per slot: rank, slot, shards.
    """
    shard = (_random("shard", F.col("rank"), F.col("slot")) % F.col("shards")).alias("shard")
    return numbers.groupBy("rank", shard).agg(F.count("*").alias("drawn"))


def mixture(sizes: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of the mix: shard, rank, pass, block, doc_id, first word, words taken.

    One row per slot and document piece in its block.
    """
    docs = _laid_out(sizes)
    block = F.explode(F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}")))
    pieces = docs.where("size > 0").withColumn("block", block)
    start = F.greatest("at", F.col("block") * block_words)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select(
        "rank",
        "block",
        "doc_id",
        (start - F.col("at")).alias("first_word"),
        (start - F.col("block") * block_words).alias("offset"),
        (end - start).alias("length"),
    )
    owed = stored(_owed_slots(targets, block_words))
    # A block's number is also a slot's number: the slots need no list of their own.
    numbers = pieces.where("offset = 0").select("rank", F.col("block").alias("number"))
    passes = F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("no")
    numbers = numbers.join(owed.select("rank", "blocks", "slots", "shards"), "rank")
    numbers = numbers.select("*", passes).withColumn("slot", F.col("no") * F.col("blocks") + F.col("number"))
    drawn = draw_counts(numbers.where("slot < slots"))
    # One row per source and shard, which holds about SHARD_SLOTS slots.
    so_far = W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    drawn = drawn.withColumn("first", F.coalesce(F.sum("drawn").over(so_far), F.lit(0)))
    slot = F.explode(F.sequence("first", F.col("first") + F.col("drawn") - 1)).alias("slot")
    # These few rows become many slots, each with a walk: they are spread over all tasks.
    tasks = int(drawn.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = drawn.repartition(tasks, "rank", "shard")
    slots = drawn.select("rank", "shard", slot).join(owed, "rank")
    slots = slots.withColumn("pass", F.expr("slot div blocks")).withColumn("turn", F.expr("slot % blocks"))
    short_turn = F.when(F.col("pass") == 0, F.col("short_0"))
    for no in range(1, REPEATS):
        short_turn = short_turn.when(F.col("pass") == no, F.col(f"short_{no}"))
    missing = F.when(F.col("turn") > short_turn, F.col("blocks") * block_words - F.col("words")).otherwise(0)
    done = F.col("pass") * F.col("words") + F.col("turn") * block_words - missing
    index = permuted(F.col("turn"), F.col("blocks"), F.col("rank"), F.col("pass"))
    slots = slots.select("shard", "rank", "pass", index.alias("block"), (F.col("owed") - done).alias("left"))
    taken = F.least("length", F.col("left") - F.col("offset"))
    mix = slots.join(pieces, ["rank", "block"]).where("left > offset")
    return mix.select("shard", "rank", "pass", "block", "doc_id", "first_word", taken.alias("words"))


def mix_documents(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, shards.

    ``shards`` counts the output shards that hold words of the document.  Null and empty texts have size 0 and are never taken.  Null sources are one
    source, after all others.  Rows that repeat doc_id and source are one
    document whose size is their sum.  Other columns are ignored.
    """
    sizes = stored(document_sizes(documents))
    targets = stored(weighted_targets(sizes))
    ranked = sizes.join(targets, sizes.source.eqNullSafe(targets.source)).select(
        "doc_id", "rank", "size", "source_size", "target"
    )
    mix = mixture(ranked.select("doc_id", "rank", "size"), targets, block_words)
    taken = mix.groupBy("doc_id", "rank").agg(
        F.sum("words").alias("taken"), F.count_distinct("shard").alias("shards")
    )
    joined = ranked.alias("d").join(
        taken.alias("t"), F.expr("d.doc_id <=> t.doc_id AND d.rank = t.rank"), "left"
    )
    return joined.select(
        "d.doc_id",
        "d.size",
        "d.source_size",
        "d.target",
        F.coalesce("t.taken", F.lit(0)).alias("taken"),
        F.coalesce("t.shards", F.lit(0)).alias("shards"),
    )
