"""Mixing of sources to target weights by Pfair scheduling.

Each source's documents, in a hashed order, form blocks of about ``BLOCK_WORDS`` words. Block
i of a source with the share w of the weights may run from the time (i - 1) / w on, its
release, and is due at i / w. Slot after slot goes to the released block that is due
first: no source is ever a whole block ahead of its share or behind it. When a source is
used up its weight leaves the sum, time goes on faster by it, and the others keep to
their shares of what is left; no slot stays empty and all rows stay.

The schedule is a fold over the slots that holds the next block of each source. It is as
long as there are blocks, at most ``MOST_BLOCKS``: beyond that blocks are longer. Everything
else is spread: blocks are numbered by sums over hashed buckets of bounded expected
size, so no window spans a source, and rows meet their block's slot in a join. All of it
is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martworks.llm import common

BLOCK_WORDS = 20_000
#: Blocks in a schedule; a corpus that has more gets longer ones.
MOST_BLOCKS = 1 << 18
#: Slots whose order is put together before it is kept.
EPOCH = 1024
#: A share of the weights below this counts as this.
LEAST = 1e-9
#: Target weights are shares of words to this power: small sources count for more.
TEMPERATURE = 0.7
BUCKET_ROWS = 5_000


def source_weights(docs: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Targets from the data: (source, weight) of every source."""
    words = _words(docs).groupBy("source").agg(F.sum("words").alias("words"))
    return words.select("source", F.pow(F.col("words").cast("double"), F.lit(temperature)).alias("weight"))


def _words(docs: DataFrame) -> DataFrame:
    """Source and number of words of each row, one at least."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blanks = F.length(text) - F.length(F.replace(F.replace(text, F.lit(" ")), F.lit("\n")))
    return docs.select(F.col("source").cast("string").alias("source"), (blanks + 1).cast("long").alias("words"))


def shares(weights: DataFrame) -> DataFrame:
    """(source, w) with w the share of each of ``weights`` (source, weight). Weights that are
    null, NaN or negative count as none; without any weight all sources are equal."""
    weight = F.coalesce(F.nanvl(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    weights = weights.groupBy("source").agg(F.max(F.greatest(weight, F.lit(0.0))).alias("weight"))
    total = weights.agg(F.sum("weight")).first()[0]
    share = F.greatest(F.col("weight") / F.lit(total), F.lit(LEAST)) if total else F.lit(1.0)
    return weights.select("source", share.alias("w"))


#: The fold. ``s`` lists the sources by name as (source, blocks, w); a state holds ``n``, how
#: many blocks each has had, the time ``v``, and ``sum``, the weights of those not used up.
#: A block is released when its time comes before the slot's end.
_DUE = """transform(a.n, (d, i) -> if(d < s[i].blocks and (not {released} or d / s[i].w < a.v + (1 - 1e-9) / a.sum),
    struct((d + 1) / s[i].w as due, i as i), null))"""
_NEXT = f"""coalesce(array_min({_DUE.format(released='true')}).i, array_min({_DUE.format(released='false')}).i)"""
_STEP = f"""transform(array({_NEXT}), k -> named_struct(
    'n', transform(a.n, (d, i) -> if(i = k, d + 1, d)),
    'v', a.v + 1 / a.sum,
    'sum', if(a.n[k] + 1 = s[k].blocks, greatest(a.sum - s[k].w, {LEAST}D / 2), a.sum),
    'order', concat(a.order, array(k))))[0]"""
_FOLD = f"""aggregate(
    sequence(0, (total - 1) div {EPOCH}),
    named_struct('n', transform(s, x -> 0L), 'v', 0D, 'sum', aggregate(s, 0D, (t, x) -> t + x.w),
        'order', cast(array() as array<array<int>>)),
    (e, epoch) -> transform(array(aggregate(
        sequence(1, least({EPOCH}, total - epoch * {EPOCH})),
        named_struct('n', e.n, 'v', e.v, 'sum', e.sum, 'order', cast(array() as array<int>)),
        (a, slot) -> {_STEP})), x -> named_struct('n', x.n, 'v', x.v, 'sum', x.sum, 'order', concat(e.order, array(x.order))))[0],
    e -> e.order)"""


def schedule(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """Earliest deadline first: (source, block, slot) of all blocks, both numbered from 0.
    ``blocks``: (source, blocks), ``weights``: (source, w) of the same sources. Where two
    blocks are due at once the source that comes first by name, null before all, is next."""
    both = blocks.join(weights, blocks["source"].eqNullSafe(weights["source"])).select(
        F.coalesce(F.concat(F.lit("s"), blocks["source"]), F.lit("")).alias("key"), blocks["source"],
        F.col("blocks").cast("long").alias("blocks"), "w",
    ).where("blocks > 0")
    listed = both.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("key", "source", "blocks", "w"))), lambda x: x.dropFields("key")).alias("s"),
        F.sum("blocks").cast("int").alias("total"),
    ).where("total > 0")
    epochs = listed.select("s", F.posexplode(F.expr(_FOLD)).alias("epoch", "order"))
    slots = epochs.select("s", "epoch", F.posexplode("order").alias("at", "i"))
    number = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1
    slots = slots.select((F.col("epoch") * EPOCH + F.col("at")).cast("long").alias("slot"), "i", F.get("s", F.col("i"))["source"].alias("source"))
    return slots.select("source", number.cast("long").alias("block"), "slot")


def mixed(docs: DataFrame, weights: DataFrame | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` with its place in the mixture: its own columns and
    ``mix_source`` (its source), ``mix_block`` (its number in the source, from 0),
    ``mix_slot`` and ``mix_order`` (within the slot). Ordered by mix_slot and mix_order
    the rows are the mixture. ``weights``: (source, weight); None takes source_weights().
    Sources without one among ``weights`` have the smallest of them each.

    A null source is a source of its own. Null and empty texts count as one word. A text
    longer than a block is a block, and blocks it reaches into have no rows. Rows that repeat
    stay; rows of a source with equal hashes follow each other by id and words. Columns of
    ``docs`` that have one of the new names are replaced. An empty table gives an empty
    result."""
    path = common.folder(docs.sparkSession)
    sizes = common.stored(
        _words(docs).groupBy("source").agg(F.sum("words").alias("words"), F.count("*").alias("n")), f"{path}/sizes"
    )
    words, n = sizes.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    block_words = max(block_words, -(-words // MOST_BLOCKS))
    if weights is None:
        weights = sizes.select("source", F.pow(F.col("words").cast("double"), F.lit(TEMPERATURE)).alias("weight"))
    else:
        weights = _of_all(weights, sizes)
    weights = common.stored(shares(weights), f"{path}/weights")

    own = [c for c in docs.columns if c not in ("mix_source", "mix_block", "mix_slot", "mix_order")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blanks = F.length(text) - F.length(F.replace(F.replace(text, F.lit(" ")), F.lit("\n")))
    rows = docs.select(
        F.struct(*own).alias("own"),  # so that no name of theirs can clash
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("_key"),
        F.xxhash64("doc_id", "text").alias("_h"),
        (blanks + 1).cast("long").alias("_words"),
    )
    buckets = max(1, -(-n // BUCKET_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.shiftright("_h", 20), F.lit(buckets)))
    # Words before each bucket of a source, from one row per source and bucket.
    sums = rows.groupBy("_key", "_bucket").agg(F.sum("_words").alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = common.stored(
        sums.select("_key", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")),
        f"{path}/buckets",
    )
    inside = Window.partitionBy("_key", "_bucket").orderBy("_h", "doc_id", "_words")
    numbered = rows.withColumn(
        "_at", F.sum("_words").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_words")
    )
    numbered = numbered.join(sums, ["_key", "_bucket"]).withColumn("_at", F.col("_at") + F.col("_before"))
    numbered = numbered.withColumn("_block", F.floor(F.col("_at") / block_words).cast("long"))
    blocks = sizes.select("source", F.ceil(F.col("words") / block_words).cast("long").alias("blocks"))
    slots = common.stored(
        schedule(blocks, weights).select(
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("_key"), F.col("block").alias("_block"), "slot"
        ),
        f"{path}/slots",
    )
    return numbered.join(slots, ["_key", "_block"]).select(
        *(F.col("own").getField(c).alias(c) for c in own),
        F.expr("if(_key = '', null, substring(_key, 2))").alias("mix_source"),
        F.col("_block").alias("mix_block"),
        F.col("slot").alias("mix_slot"),
        (F.col("_at") - F.col("_block") * block_words).cast("long").alias("mix_order"),
    )


def _of_all(weights: DataFrame, sizes: DataFrame) -> DataFrame:
    """``weights`` of the sources that there are; those without one get the smallest."""
    least = weights.agg(F.min("weight")).first()[0]
    given = weights.select(F.col("source").cast("string").alias("_s"), F.col("weight").cast("double").alias("weight"))
    found = sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left")
    return found.select("source", F.coalesce("weight", F.lit(least).cast("double"), F.lit(1.0)).alias("weight"))
