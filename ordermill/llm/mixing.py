"""Mixing sources to target weights: blocks of words drawn by source, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordermill.llm.shared import staged

#: The weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Fixed values of the permutations: a prime that products of two remainders stay below 2^62 with, and a factor that spreads source numbers.
PRIME, SPREAD, ROUNDS = 2_147_483_647, 2_654_435_761, 12
#: The draw's numbers are cut into so many equal cells, in which slots meet the sources' ranges.
CELLS = 16_384


def number_of(text: str) -> int:
    """The first 60 bits of the MD5 of a text."""
    return int(md5(text.encode()).hexdigest()[:15], 16)


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def word_count(text: str) -> Column:
    """The number of runs of characters other than ASCII white space; null has none."""
    parts = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", -1)
    return F.size(F.array_remove(parts, "")).cast("bigint")


def running(df: DataFrame, order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """`df` with the sums of `values` over all rows before each row in this order.

    The rows are dealt out by ranges and written with their range's number; sums run inside each range, and those of the ranges before, one row per
    range, are added. So no task sees the whole order. Rows that are equal in `order` come in any order.
    """
    ranged = staged(df.withColumns(dict(values)).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    nothing = F.lit(0).cast("bigint")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(*[F.sum(name).alias(name) for name in values])
    offsets = ranges.select("_range", *[F.coalesce(F.sum(name).over(before), nothing).alias(f"_{name}") for name in values])
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sums = [(F.coalesce(F.sum(name).over(inside), nothing) + F.col(f"_{name}")).alias(name) for name in values]
    return ranged.join(offsets, "_range").select(*df.columns, *sums)


@dataclass(frozen=True)
class Mix:
    """A planned mix.

    sources: sid, source, size, weight, target, wanted (whole words), full (whole blocks), blocks, quota (slots), last (words that the last slot takes).
    slots: shard, sid, slot (number within the source), epoch, block, part (words taken of the block, null: all), one row per drawn block.
    placed: the documents with sid and start, the words of their source before them; `size` words each.
    """

    sources: DataFrame
    slots: DataFrame
    placed: DataFrame
    block: int


def targets(sizes: DataFrame, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """(sid, source, size, weight, target, wanted) from rows (source, size): what each source gives to a mix of share[0] / share[1] of all words.

    Sources in code point order, null last, have the weights 5, 2, 1, repeating, and share by weight. A source stops at `most` times its size; what is
    over goes to the others by weight, until none is above: in order of size per weight, the sources up to some place stop and the rest share what
    is left, and running sums show the place. All numbers but the target itself are whole.
    """
    counted = sizes.groupBy("source").agg(F.sum("size").alias("size")).withColumn("none", F.col("source").isNull())
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    ranked = running(counted, ["none", "source"], {"sid": F.lit(1).cast("bigint")}).withColumn("weight", weight).drop("none")
    # The weights divide 10, so the order by size per weight is one of whole numbers.
    leveled = ranked.withColumns({"cap": most * F.col("size"), "level": F.call_function("div", 10 * F.col("size"), F.col("weight"))})
    found = staged(running(leveled, ["level", "sid"], {"capped_before": F.col("cap"), "weight_before": F.col("weight")}), "targets")
    total, weights = found.agg(F.sum("size"), F.sum("weight")).first()
    total, weights = int(total or 0), int(weights or 0)
    up, down = share
    left, among = F.lit(up * total) - down * F.col("capped_before"), F.lit(weights) - F.col("weight_before")
    wide = "decimal(38,0)"
    stops = F.col("weight") * left.cast(wide) >= F.col("cap").cast(wide) * down * among
    first = found.where(~stops).agg(F.min(F.struct("level", "sid", left.alias("left"), among.alias("among")))).first()[0]
    target = F.col("cap").cast("double")
    if first is not None:
        ahead = (F.col("level") < first.level) | (F.col("level") == first.level) & (F.col("sid") < first.sid)
        target = F.when(ahead, target).otherwise((F.col("weight") * first.left).cast("double") / float(down * first.among))
    return found.select("sid", "source", "size", "weight", target.alias("target"), F.floor(target + 0.5).cast("bigint").alias("wanted"))


def permuted(index: str, size: str, key: str, seed: int) -> Column:
    """A pseudorandom permutation of 0 .. size - 1, one for each key, at `index`.

    Each round pairs every number with another and swaps the numbers of a pair or not, by a bit that both compute alike; so it is a permutation for any size.
    """
    rounds = ", ".join(
        f"named_struct('k', {number_of(f'{seed}:k:{r}')}L, 'a', {number_of(f'{seed}:a:{r}') % PRIME}L, 'b', {number_of(f'{seed}:b:{r}') % PRIME}L)"
        for r in range(ROUNDS)
    )
    turn = f"((r.k ^ ({key} * {SPREAD}L)) & {(1 << 62) - 1}L) % {size}"
    pair = f"({turn} + {size} - x) % {size}"
    return F.expr(f"aggregate(array({rounds}), {index}, (x, r) -> if(((greatest(x, {pair}) % {PRIME}L) * r.a + r.b) % {PRIME}L % 2 = 1, {pair}, x))")


def mix(
    docs: DataFrame,
    block: int = 64,
    shard_slots: int = 8192,
    seed: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    texts: bool = False,
) -> Mix:
    """Draws a mix of 150 % of all words from the sources, by `targets`.

    The words of a source, documents in the order of their ids, are cut into blocks of `block`; a source needs so many slots as blocks make its target. Every slot of every
    output shard draws a number below all slots, and the source whose range has it: so the counts per shard are multinomial. A source's slots are
    numbered through the shards. What a source drew beyond its slots goes, in this order, to the sources that drew too few: its totals are
    exact, whatever the draw. Slot j stands for a block of epoch j / blocks by a permutation for each source and epoch; the rest of under `block` words
    at the end of a source is the last block of every epoch. The last slot takes only the words still wanted.

    So the words taken of a source are its rounded target, and no block is taken twice in an epoch. The same rows give the same mix. Nothing is joined by source but tables of a row per
    source or per source and shard; slots meet blocks by source and block, so a source of a third of all words is spread like any other.

    Null and empty texts have no words and take part in nothing. A null source is a source. Repeated rows are documents of their own; of rows with the same id, source
    and size it is not said which comes first. Other columns are not read. With `texts` the placed rows keep their texts, for `mixed_blocks`. An empty table gives an empty mix.
    """
    spark = docs.sparkSession
    wanted = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), word_count(text_column).alias("size"), *([F.col(text_column).alias("text")] if texts else [])
    )
    rows = staged(wanted, "sizes")
    whole = F.lit(block).cast("bigint")
    shared = targets(rows)
    full, rest = F.call_function("div", F.col("size"), whole), F.when(F.col("size") > 0, F.col("wanted") % F.col("size")).otherwise(0)
    shared = shared.withColumns({"full": full, "blocks": F.ceil(F.col("size") / whole).cast("bigint"), "rest": rest}).withColumns(
        {
            "quota": F.when(F.col("size") > 0, F.call_function("div", F.col("wanted"), F.col("size"))).otherwise(0) * F.col("blocks")
            + F.call_function("div", F.col("rest") + whole - 1, whole),
            "last": F.when(F.col("rest") > 0, (F.col("rest") - 1) % whole + 1),
        }
    )
    sources = staged(running(shared, ["sid"], {"words_before": F.col("size"), "slots_before": F.col("quota")}), "sources")
    slots = int(sources.agg(F.sum("quota")).first()[0] or 0)
    counts = staged(_drawn(spark.range(slots), sources, slots, shard_slots, seed), "drawn")
    drawn = _filled(counts, sources)
    placed = running(
        rows.join(sources.select("sid", F.col("source").alias("_source"), "words_before"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source"),
        ["sid", "id", "size"],
        {"start": F.col("size")},
    ).withColumn("start", F.col("start") - F.col("words_before"))
    epoch, place = F.call_function("div", F.col("slot"), F.col("blocks")), F.col("slot") % F.col("blocks")
    found = (
        drawn.withColumns({"epoch": epoch, "place": place})
        .withColumn("own", F.col("sid") * 4 + F.col("epoch"))
        .select(
            "shard",
            "sid",
            "slot",
            "epoch",
            F.when(F.col("place") < F.col("full"), permuted("place", "full", "own", seed)).otherwise(F.col("place")).alias("block"),
            F.when(F.col("slot") == F.col("quota") - 1, F.col("last")).alias("part"),
        )
    )
    names = ["sid", "source", "size", "weight", "target", "wanted", "full", "blocks", "quota", "last"]
    return Mix(sources.select(*names), found, staged(placed.drop("words_before"), "placed"), block)


def _drawn(slots: DataFrame, sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, sid, n): how many slots of a shard fall to each source. Slots meet the sources' ranges in cells of equal width."""
    width = F.lit(max(1, -(-total // CELLS))).cast("bigint")
    end = F.col("slots_before") + F.col("quota")
    cells = F.sequence(F.call_function("div", F.col("slots_before"), width), F.call_function("div", end - 1, width))
    ranges = sources.where("quota > 0").select("sid", F.col("slots_before").alias("low"), end.alias("high"), F.explode(cells).alias("cell"))
    draw = _number(F.concat(F.lit(f"{seed}:"), F.col("id"))) % F.lit(max(1, total))
    drawn = slots.select(F.call_function("div", F.col("id"), F.lit(shard_slots).cast("bigint")).alias("shard"), draw.alias("draw"))
    met = drawn.withColumn("cell", F.call_function("div", F.col("draw"), width)).join(ranges, "cell")
    return met.where("draw >= low AND draw < high").groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))


def _filled(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """(shard, sid, slot, blocks, full, quota, last): every slot with its number in its source, after what is drawn beyond the quota went to others."""
    kept = ["sid", "blocks", "full", "quota", "last"]
    given = counts.groupBy("sid").agg(F.sum("n").alias("drawn"))
    none = F.lit(0).cast("bigint")
    got = sources.where("quota > 0").join(given, "sid", "left").withColumn("drawn", F.coalesce("drawn", none))
    over, under = F.greatest(F.col("drawn") - F.col("quota"), none), F.greatest(F.col("quota") - F.col("drawn"), none)
    got = staged(running(got.withColumn("under", under), ["sid"], {"drawn_before": F.col("drawn"), "over_before": over, "under_before": under}), "quotas")
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # explicit: these few rows become all slots
    numbered = running(counts, ["sid", "shard"], {"first": F.col("n")}).join(got, "sid").withColumn("first", F.col("first") - F.col("drawn_before"))
    numbered = numbered.repartition(tasks, "shard", "sid")
    every = numbered.select("shard", *kept, "over_before", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    own = every.where("slot < quota").select("shard", *kept, "slot")
    moved = every.where("slot >= quota").select("shard", (F.col("over_before") + F.col("slot") - F.col("quota")).alias("number"))
    free = got.where("under > 0").select(
        *kept, "drawn", "under_before", F.explode(F.sequence(F.col("under_before"), F.col("under_before") + F.col("under") - 1)).alias("number")
    )
    taken = moved.join(free, "number").select("shard", *kept, (F.col("drawn") + F.col("number") - F.col("under_before")).alias("slot"))
    return own.unionByName(taken)


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """The parts of documents in blocks: sid, block, start, at (where in the block), words, and the other columns."""
    whole, end = F.lit(block).cast("bigint"), F.col("start") + F.col("size")
    cut = placed.where("size > 0").select(
        "*", F.explode(F.sequence(F.call_function("div", F.col("start"), whole), F.call_function("div", end - 1, whole))).alias("block")
    )
    begin = F.greatest(F.col("start"), F.col("block") * whole)
    return cut.withColumns({"at": begin - F.col("block") * whole, "words": F.least(end, (F.col("block") + 1) * whole) - begin})


def taken(mixed: Mix, id_column: str = "doc_id") -> DataFrame:
    """(id, size, source_size, target, taken): how many words the mix takes of each document, repeats counted."""
    part = F.col("part")
    draws = mixed.slots.groupBy("sid", "block").agg(F.count_if(part.isNull()).alias("times"), F.coalesce(F.max(part), F.lit(0)).alias("part"))
    words = F.col("words") * F.col("times") + F.least(F.col("words"), F.greatest(F.col("part") - F.col("at"), F.lit(0)))
    sums = (
        _pieces(mixed.placed.select("sid", "start", "size"), mixed.block)
        .join(draws, ["sid", "block"])
        .groupBy("sid", "start")
        .agg(F.sum(words).alias("taken"))
    )
    rows = mixed.placed.select("id", "sid", "start", "size")
    with_words = rows.where("size > 0").join(sums, ["sid", "start"], "left")
    everything = with_words.select("id", "sid", "size", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken")).unionByName(
        rows.where("size = 0").select("id", "sid", "size", F.lit(0).cast("bigint").alias("taken"))
    )
    about = mixed.sources.select("sid", F.col("size").alias("source_size"), "target")
    return everything.join(about, "sid").select(F.col("id").alias(id_column), "size", "source_size", "target", "taken")


def mixed_blocks(mixed: Mix) -> DataFrame:
    """(shard, source, slot, epoch, block, text): the mix itself, each drawn block as its words joined by one space. Needs a mix with `texts`."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    begin = (F.col("block") * mixed.block + F.col("at") - F.col("start") + 1).cast("int")
    pieces = _pieces(mixed.placed, mixed.block).select("sid", "block", "at", F.slice(words, begin, F.col("words").cast("int")).alias("words"))
    blocks = pieces.groupBy("sid", "block").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
    joined = mixed.slots.join(blocks, ["sid", "block"])
    every = F.flatten(F.transform("parts", lambda p: p["words"]))
    text = F.array_join(F.slice(every, 1, F.coalesce(F.col("part"), F.lit(mixed.block)).cast("int")), " ")
    named = mixed.sources.select("sid", "source")
    return joined.join(named, "sid").select("shard", "source", "slot", "epoch", "block", text.alias("text"))
