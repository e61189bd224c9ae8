"""Mixing sources to target weights by a splitting tree (operator 9). DataFrame and SQL functions only.

Each source is dealt into blocks of documents by a hash, which permutes it; quotas say how many blocks of each source the
mix draws. A binary tree over the output shards splits the quotas: the left half of a node's shards gets
a multivariate hypergeometric draw from the node's blocks, so every shard ends with exact counts per source that add up
to the quotas, as if all drawn blocks had been shuffled, without moving any. A shard then takes the next
blocks of each source's permutation, disjoint from all others, and orders its own documents by a hash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.storage import stash

WORDS = r"[^\x20\x09-\x0D]+"

_SMALL = ", ".join(f"{math.lgamma(n + 1)}D" for n in range(16))
_LOG_FACTORIAL = (
    f"(CASE WHEN {{0}} < 16 THEN element_at(array({_SMALL}), cast({{0}} AS int) + 1) "
    "ELSE {0} * ln({0}) - {0} + 0.5D * ln(2 * pi() * {0}) + 1 / (12D * {0}) - 1 / (360D * {0} * {0} * {0}) END)"
)


def _log_factorial(x: str) -> str:
    return _LOG_FACTORIAL.format(f"({x})")


def hypergeometric(all_: str, marked: str, drawn: str, uniform: str) -> str:
    """SQL for the number of marked ones among ``drawn`` of ``all_``, given a uniform number: values are tried from the mode outwards.

    Steps are bounded by 24 standard deviations to each side, beyond which no double adds to the sum.
    """
    f = _log_factorial
    return f"""
    element_at(transform(array(struct(cast({all_} AS bigint) AS n, cast({marked} AS bigint) AS k, cast({drawn} AS bigint) AS d, {uniform} AS u)), a ->
    element_at(transform(array(struct(greatest(0L, a.d - a.n + a.k) AS lo, least(a.d, a.k) AS hi,
        greatest(greatest(0L, a.d - a.n + a.k), least(least(a.d, a.k), cast(floor((a.d + 1D) * (a.k + 1D) / (a.n + 2D)) AS bigint))) AS m)), b ->
    element_at(transform(array(exp({f("a.k")} - {f("b.m")} - {f("a.k - b.m")} + {f("a.n - a.k")} - {f("a.d - b.m")} - {f("a.n - a.k - a.d + b.m")}
        - {f("a.n")} + {f("a.d")} + {f("a.n - a.d")})), p ->
    aggregate(sequence(1L, greatest(1L, least(b.hi - b.lo, cast(24 * sqrt(a.d * (a.k / greatest(a.n, 1D)) * (1 - a.k / greatest(a.n, 1D))) AS bigint) + 24))),
        struct(p AS total, b.m AS up, p AS pup, b.m AS down, p AS pdown, if(a.u < p, b.m, cast(NULL AS bigint)) AS found),
        (s, i) -> if(s.found IS NOT NULL, s, element_at(transform(array(struct(
            if(s.up < b.hi, s.pup * (a.k - s.up) * (a.d - s.up) / ((s.up + 1D) * (a.n - a.k - a.d + s.up + 1D)), 0D) AS pup,
            if(s.down > b.lo, s.pdown * s.down * (a.n - a.k - a.d + s.down) / ((a.k - s.down + 1D) * (a.d - s.down + 1D)), 0D) AS pdown)), t ->
            struct(s.total + t.pup + t.pdown AS total, if(s.up < b.hi, s.up + 1, s.up) AS up, t.pup AS pup,
                if(s.down > b.lo, s.down - 1, s.down) AS down, t.pdown AS pdown,
                CASE WHEN a.u < s.total + t.pup THEN s.up + 1 WHEN a.u < s.total + t.pup + t.pdown THEN s.down - 1 END AS found)), 1)),
        s -> coalesce(s.found, b.m))), 1)), 1)), 1)"""


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (part, blocks) with one row per part -> rows (shard, part, blocks): a multivariate hypergeometric tree over the shards.

    One row holds the quotas of a node, two numbers for each part (source). Levels only map rows, nothing is shuffled in between.
    """
    uniform = f"shiftrightunsigned(xxhash64({seed}L, first, x.part), 11) / 9007199254740992D"
    drawn = f"""aggregate(quotas,
        struct(aggregate(quotas, 0L, (t, x) -> t + x.blocks) AS rest,
               (aggregate(quotas, 0L, (t, x) -> t + x.blocks) * (shards DIV 2)) DIV shards AS draw, cast(array() AS array<bigint>) AS took),
        (s, x) -> element_at(transform(array({hypergeometric("s.rest", "x.blocks", "s.draw", uniform)}), d ->
            struct(s.rest - x.blocks AS rest, s.draw - d AS draw, concat(s.took, array(d)) AS took)), 1),
        s -> s.took)"""
    tree = quotas.agg(F.sort_array(F.collect_list(F.struct("part", "blocks"))).alias("quotas")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("shards"), "quotas"
    )
    for _ in range(max(0, shards - 1).bit_length()):
        left = tree.withColumn("took", F.expr(f"if(shards > 1, {drawn}, transform(quotas, x -> x.blocks))"))
        tree = left.selectExpr(
            """inline(if(shards > 1, array(
                struct(first, shards DIV 2 AS shards, zip_with(quotas, took, (x, d) -> struct(x.part AS part, d AS blocks)) AS quotas),
                struct(first + shards DIV 2 AS first, shards - shards DIV 2 AS shards, zip_with(quotas, took, (x, d) -> struct(x.part AS part, x.blocks - d AS blocks)) AS quotas)),
                array(struct(first, shards, quotas))))"""
        )
    return tree.selectExpr("first AS shard", "inline(quotas)")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Rows (source, source_size) -> with ``part`` (place of the source by code point, NULL last) and ``target``.

    Sources weigh ``weights``, repeating. Targets share ``share`` of all sizes by weight; none goes above ``most`` times its
    source's size, and what is cut off is shared by the others. One row of numbers per source in one window.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    cap = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("part", rank).withColumn("weight", weight).withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "part")
    everything = Window.partitionBy()
    pool = F.sum("source_size").over(everything) * F.lit(float(share))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (pool - before) / rest).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    # the first source that is not full sets the level of all that are not
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "part", "level"))).over(everything)["level"]
    target = F.when(F.col("full") | level.isNull(), F.col("cap")).otherwise(level * F.col("weight"))
    return rows.select("source", "part", "source_size", target.alias("target"))


def _mark(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key.cast("string"))


def _draws(
    docs: DataFrame, weights: Sequence[float], share: float, most: int, block_words: int, seed: int, key: str, text: str, source: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their blocks; a row per source with its target and number of blocks; and the blocks drawn in each pass.

    A pass draws a source's blocks from the first on. ``cut`` is the words wanted of the one block that is not drawn whole.
    """
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")
    sized = stash(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words.alias("size"), _mark(F.col(key), seed).alias("mark")), "mix-sized")
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    count = F.greatest(F.lit(1), F.round(F.col("source_size") / block_words)).cast("long")
    sources = stash(sources.withColumn("n_blocks", count), "mix-sources")

    here = sized.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    here = here.withColumn("block", F.pmod(F.col("mark"), "n_blocks"))

    # where each block lies on its source's line of words; two levels, so that no window holds all blocks of a source
    blocks = here.groupBy("part", "block").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("n_blocks").alias("n_blocks")
    )
    blocks = blocks.withColumn("run", F.floor(F.col("block") / F.ceil(F.sqrt("n_blocks"))))
    runs = blocks.groupBy("part", "run").agg(F.sum("words").alias("run_words"), F.count("*").alias("run_blocks"))
    earlier = Window.partitionBy("part").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("part")
    runs = runs.select(
        "part",
        "run",
        F.coalesce(F.sum("run_words").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("run_blocks").over(earlier), F.lit(0)).alias("blocks_before"),
        F.sum("run_blocks").over(whole).alias("blocks_of_part"),
    )
    within = Window.partitionBy("part", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    line = (
        blocks.withColumn("w", F.coalesce(F.sum("words").over(within), F.lit(0)))
        .withColumn("b", F.count("*").over(within))
        .join(runs, ["part", "run"])
        .select(
            "part", "block", "words", "source_size", "target", "blocks_of_part",
            (F.col("w") + F.col("words_before")).alias("start"), (F.col("b") + F.col("blocks_before")).alias("index"),
        )
    )
    passes = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    draws = line.withColumn("pass", passes).withColumn("room", F.col("target") - F.col("pass") * F.col("source_size") - F.col("start"))
    # a block is drawn if some of it is wanted; cut: the words wanted where that is not all of it
    draws = draws.where((F.col("room") >= F.col("words")) | (F.col("room") > 0)).select(
        "part",
        "block",
        "pass",
        (F.col("pass") * F.col("blocks_of_part") + F.col("index")).alias("position"),
        F.when(F.col("room") < F.col("words"), F.col("room")).alias("cut"),
    )
    return here, sources, stash(draws, "mix-draws")


def _dealt(draws: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (part, block, drawn) of the drawn blocks: for each pass that draws one its shard by the splitting tree, and its cut."""
    quotas = draws.groupBy("part").agg(F.count("*").alias("blocks"))
    leaves = stash(split_quotas(quotas, shards, seed), "mix-shards")
    ahead = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.withColumn("low", F.coalesce(F.sum("blocks").over(ahead), F.lit(0))).where("blocks > 0")
    dealt = leaves.select("part", "shard", F.explode(F.sequence("low", F.col("low") + F.col("blocks") - 1)).alias("position"))
    return (
        draws.join(dealt, ["part", "position"])
        .groupBy("part", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "cut"))).alias("drawn"))
    )


def _cut_rows(rows: DataFrame) -> DataFrame:
    """Rows of cut blocks, with ``upto``: the words of the block up to and with the row. A cut block holds few rows with words."""
    order = Window.partitionBy("part", "block").orderBy("mark", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("upto", F.sum("size").over(order))


def _fits(cut: Column) -> Column:
    return F.col("upto") - F.col("size") / 2 <= cut


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    shards: int = 64,
    block_words: int = 4096,
    seed: int = 20240607,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per row of ``docs``: key, source, size, source_size, target, taken and ``draws`` (pass, shard, place of each time it is taken).

    size is the number of words, 0 for NULL. A source is passed through at most ``most`` times; the last pass takes whole blocks,
    then documents with words of one more block up to the one whose middle the target lies nearest, so taken words miss the target by at
    most half a document. NULL is a source of its own. Rows with equal keys are taken alike. Blocks depend on keys and ``seed`` alone, so
    reruns agree. An empty table gives no rows. Other columns are not read.
    """
    here, _, draws = _draws(docs, weights, share, most, block_words, seed, key, text, source)
    by_block = _dealt(draws, shards, seed)
    taken = here.join(by_block, ["part", "block"], "left")
    # only rows of cut blocks are put in order; rows without words add nothing to them, however many they are
    ordered = F.exists(F.coalesce("drawn", F.array()), lambda d: d["cut"].isNotNull()) & (F.col("size") > 0)
    taken = _cut_rows(taken.where(ordered)).unionByName(taken.where(~ordered).withColumn("upto", F.lit(None).cast("long")))

    def wanted(d: Column) -> Column:
        return d["cut"].isNull() | F.coalesce(_fits(d["cut"]), F.lit(False))

    def placed(d: Column) -> Column:
        return F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), F.xxhash64(F.lit(seed + 1), F.col("mark"), d["pass"]).alias("place"))

    taken = taken.withColumn("draws", F.transform(F.filter(F.coalesce("drawn", F.array()), wanted), placed))
    return taken.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        (F.col("size") * F.size("draws")).alias("taken"), "draws",
    )


def mixed(docs: DataFrame, plan: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of a mix, a row for each time one is taken, with shard, pass and place; rows of a shard in their shuffled order.

    Keys must be unique and not NULL here.
    """
    taken = plan.select(key, F.explode("draws").alias("draw")).select(key, "draw.*")
    return docs.join(taken, key).repartition("shard", F.pmod("place", F.lit(16))).sortWithinPartitions("shard", "place")


#: sources, and rows of cut blocks, that a broadcast may hold; beyond it the joins shuffle
BROADCAST_ROWS = 100_000
#: drawn blocks that one may hold: a row of some 100 bytes stands for ``block_words`` words
BROADCAST_BLOCKS = 2_000_000


def _small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= most else rows


def mix_rows(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    shards: int = 64,
    block_words: int = 4096,
    seed: int = 20240607,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs``, with all their columns and none else, once for each draw of ``mix``: in the shard that the splitting tree gives
    the draw, in the shuffled order of that shard. Texts are shuffled once, into their shards.

    A row finds its block by its key and source; the drawn blocks, with their passes and shards, are few. Rows of one source with equal
    keys, NULL included, are taken alike: as often as the one of them that is taken most. NULL is a source, NULL texts hold no words.
    """
    inside = {"_source", "_part", "_blocks", "_block", "_in", "_at", "_drawn", "_key", "_more", "_time", "_shard", "_place"}
    if used := inside & set(docs.columns):
        raise ValueError(f"columns {sorted(used)} are used inside")
    here, sources, draws = _draws(docs, weights, share, most, block_words, seed, key, text, source)
    by_block = stash(_dealt(draws, shards, seed), "mix-dealt")
    cut = by_block.select("part", "block", F.filter("drawn", lambda d: d["cut"].isNotNull()).alias("cuts")).where(F.size("cuts") > 0)
    rows = _cut_rows(here.where("size > 0").join(_small(stash(cut, "mix-cuts")), ["part", "block"]))
    more = rows.withColumn("more", F.filter("cuts", lambda d: _fits(d["cut"]))).where(F.size("more") > 0)
    more = more.groupBy(F.col("part").alias("_in"), F.col("key").alias("_key")).agg(F.max_by("more", F.size("more")).alias("_more"))
    more = stash(more, "mix-more")

    numbers = sources.select(F.col("source").alias("_source"), F.col("part").alias("_part"), F.col("n_blocks").alias("_blocks"))
    blocks = by_block.select(
        F.col("part").alias("_in"), F.col("block").alias("_at"), F.filter("drawn", lambda d: d["cut"].isNull()).alias("_drawn")
    ).where(F.size("_drawn") > 0)
    mark = _mark(F.col(key), seed)
    out = docs.join(_small(numbers), F.col(source).eqNullSafe(F.col("_source"))).withColumn("_block", F.pmod(mark, "_blocks"))
    out = out.join(_small(stash(blocks, "mix-blocks"), BROADCAST_BLOCKS), (F.col("_part") == F.col("_in")) & (F.col("_block") == F.col("_at")), "left").drop("_in")
    out = out.join(_small(more), (F.col("_part") == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    nothing = F.array().cast(blocks.schema["_drawn"].dataType)
    out = out.withColumn("_time", F.explode(F.concat(F.coalesce("_drawn", nothing), F.coalesce("_more", nothing))))
    out = out.withColumn("_shard", F.col("_time.shard")).withColumn("_place", F.xxhash64(F.lit(seed + 1), mark, F.col("_time.pass")))
    out = out.select(*docs.columns, "_shard", "_place").repartition("_shard", F.pmod("_place", F.lit(16)))
    return out.sortWithinPartitions("_shard", "_place").select(*docs.columns)


def repeat_in_place(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    block_words: int = 4096,
    seed: int = 20240607,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, with all their columns and none else, where they lie: texts are not shuffled.

    A pass draws a source's blocks up to a limit and some documents of the next one, so a row's number follows from one row of numbers for
    its source, and a look-up in the keys taken of cut blocks. Rows of one source with equal keys, NULL included, are taken alike: as often as
    the one of them that is taken most. NULL is a source, NULL texts hold no words.
    """
    inside = {"_source", "_part", "_blocks", "_passes", "_block", "_in", "_key", "_more", "_time"}
    if used := inside & set(docs.columns):
        raise ValueError(f"columns {sorted(used)} are used inside")
    here, sources, draws = _draws(docs, weights, share, most, block_words, seed, key, text, source)
    # blocks drawn whole are those up to ``last``; -1 where there are none
    limits = draws.groupBy("part", "pass").agg(
        F.coalesce(F.max(F.when(F.col("cut").isNull(), F.col("block"))), F.lit(-1)).alias("last"),
        F.max(F.when(F.col("cut").isNotNull(), F.col("block"))).alias("cut_block"),
    )
    passes = limits.groupBy("part").agg(F.collect_list(F.struct("last", "cut_block")).alias("_passes"))
    numbers = sources.join(passes, "part").select(F.col("source").alias("_source"), F.col("part").alias("_part"), F.col("n_blocks").alias("_blocks"), "_passes")
    numbers = _small(stash(numbers, "mix-limits"))

    cuts = _small(stash(draws.where("cut IS NOT NULL").groupBy("part", "block").agg(F.collect_list("cut").alias("cuts")), "mix-cuts"))
    rows = _cut_rows(here.where("size > 0").join(cuts, ["part", "block"]))
    more = rows.withColumn("more", F.size(F.filter("cuts", _fits))).where("more > 0")
    more = more.groupBy(F.col("part").alias("_in"), F.col("key").alias("_key")).agg(F.max("more").alias("_more"))

    # rows of another source than any known one do not exist: the sources are those of ``docs``
    out = docs.join(numbers, F.col(source).eqNullSafe(F.col("_source"))).withColumn("_block", F.pmod(_mark(F.col(key), seed), "_blocks"))
    out = out.join(_small(stash(more, "mix-more")), (F.col("_part") == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    whole = F.size(F.filter("_passes", lambda p: F.col("_block") <= p["last"]))
    times = whole + F.coalesce("_more", F.lit(0))
    return out.withColumn("_time", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)
