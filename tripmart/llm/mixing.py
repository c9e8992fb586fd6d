"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target share of all words; each of its documents should then be taken
target / source size times, which is a whole number of copies plus a fraction. Fractions become 0
or 1 by the pivotal method: two documents meet, and words move from one to the other, up or down at
random with the chances that keep every document's mean, until one fraction is whole. What moves is
words (copies times size), so a source's taken words stay at its target throughout.

The meetings form a reduction tree: about 64 documents of a source meet in each group, one by one;
at most one document of a group is left with a fraction and goes to the next level, where 64 groups
meet, and so on. The last one of a source is rounded to the nearer number, so a source misses its target by
half of one document at most. No source is one task's work at any level but the last, where 64 rows meet.

Cases: a null text has size 0; documents of size 0 take no part in the moving and are rounded on
their own; a null source is a source of its own and comes last in the order of weights; rows that
repeat key, source and size are units of their own, each with its own number of copies (:func:`mix`, which can't
tell them apart, gives each their mean, rounded by a seeded number of the row); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import field, packed, running_before, seeded, stored, unit
from tripmart.llm.rules import words_of

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 23
GROUP = 64


def weighted_sources(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``_source, _total, _weight``: sources in code-point order (null last) take the weights in turn.

    Ranks come from a range-partitioned sort: rows before a partition plus the row's place in it.
    """
    sources = rows.groupBy("_source").agg(F.sum("_size").alias("_total"))
    sources = sources.repartitionByRange(F.col("_source").asc_nulls_last())
    sources = sources.sortWithinPartitions(F.col("_source").asc_nulls_last())
    sources = stored(sources.withColumn("_part", F.spark_partition_id().cast("bigint")).withColumn(
        "_place", F.monotonically_increasing_id() % F.lit(1 << 33)), "mix-sources")
    before = running_before(sources.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_part", "_n")
    ranked = sources.join(before.select("_part", "before"), "_part")
    turn = F.expr(f"cast((before + _place) % {len(weights)} AS int)")
    return ranked.select("_source", "_total", F.get(F.array(*map(F.lit, weights)), turn).alias("_weight"))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``_target``: all words shared by weight, none above ``most`` times the source's words,
    the excess reshared among the others. Each round is one sum over the sources; once a source is
    at its limit it stays there, so the rounds end."""
    whole, weight = sources.agg(F.sum("_total"), F.sum("_weight")).first()
    level, at_limit = (whole / weight if weight else 0.0), 0
    while True:
        above = F.col("_weight") * F.lit(level) > most * F.col("_total")
        n, used, left = sources.agg(F.count_if(above), F.sum(F.when(above, most * F.col("_total"))),
                                    F.sum(F.when(~above, F.col("_weight")))).first()
        if n == at_limit or not left:
            break
        at_limit, level = n, (whole - (used or 0)) / left
    return sources.withColumn("_target", F.least(F.col("_weight") * F.lit(level), (most * F.col("_total")).cast("double")))


def _meet(a: Column, b: Column, level: int) -> Column:
    """The two fractions after one meeting: one of them at least is 0 or 1."""
    r = b.w / a.w  # words move: a share x of a is x / r of b
    up, down = F.least(1 - a.p, b.p * r), F.least(a.p, (1 - b.p) * r)
    chance = F.shiftrightunsigned(F.xxhash64(a.h, b.h, F.lit(level)), 11) / F.lit(float(1 << 53))
    rise = F.struct(F.when(1 - a.p <= b.p * r, F.lit(1.0)).otherwise(a.p + b.p * r).alias("a"),
                    F.when(1 - a.p <= b.p * r, b.p - (1 - a.p) / r).otherwise(F.lit(0.0)).alias("b"))
    fall = F.struct(F.when(a.p <= (1 - b.p) * r, F.lit(0.0)).otherwise(a.p - (1 - b.p) * r).alias("a"),
                    F.when(a.p <= (1 - b.p) * r, b.p + a.p / r).otherwise(F.lit(1.0)).alias("b"))
    return F.when(chance * (up + down) < down, rise).otherwise(fall)


def _whole(p: Column) -> Column:
    return (p <= 1e-12) | (p >= 1 - 1e-12)


def _with(item: Column, p: Column) -> Column:
    near = F.when(p <= 1e-12, F.lit(0.0)).when(p >= 1 - 1e-12, F.lit(1.0)).otherwise(p)
    return F.struct(item.key.alias("key"), item.w.alias("w"), near.alias("p"), item.h.alias("h"))


def _reduce(items: DataFrame, level: int, kind: str) -> DataFrame:
    """One level: the items of each (source, group) meet in seeded order; one row per item with its
    new fraction."""
    def step(state: Column, x: Column) -> Column:
        one = state.now
        pair = F.transform(F.array(_meet(one, x, level)), lambda m: F.struct(
            F.when(_whole(m.a), _with(x, m.b)).otherwise(_with(one, m.a)).alias("now"),
            F.concat(state.done, F.array(F.when(_whole(m.a), _with(one, m.a)).otherwise(_with(x, m.b)))).alias("done")))[0]
        nxt = F.struct(x.alias("now"), F.concat(state.done, F.array(one)).alias("done"))
        first = F.struct(x.alias("now"), state.done.alias("done"))
        return F.when(one.isNull(), first).when(_whole(one.p), nxt).otherwise(pair)

    shape = f"struct<key:{kind},w:double,p:double,h:bigint>"
    zero = F.struct(F.lit(None).cast(shape).alias("now"), F.array().cast(f"array<{shape}>").alias("done"))
    groups = items.groupBy("_source", "_group").agg(F.array_sort(F.collect_list(
        F.struct("h", "key", "w", "p"))).alias("items"))
    ordered = F.transform("items", lambda x: F.struct(x.key.alias("key"), x.w.alias("w"), x.p.alias("p"), x.h.alias("h")))
    met = groups.select("_source", "_group", F.aggregate(ordered, zero, step).alias("s"))
    rows = met.select("_source", "_group", F.explode(F.concat("s.done", F.array("s.now"))).alias("x"))
    return rows.select("_source", "_group", "x.key", "x.w", "x.p", "x.h")


def each_row(counted: DataFrame, run: int = 4096) -> DataFrame:
    """A row per copy of equal rows (``_m`` of them), numbered by ``_copy`` from 0. Groups of more than ``run`` copies are
    dealt out in runs, so no task writes all copies of a hot row."""
    last = F.col("_m") - 1
    few = counted.where(F.col("_m") <= run).withColumn("_run", F.lit(0).cast("bigint"))
    many = counted.where(F.col("_m") > run).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / run))))
    many = many.repartition("_key", "_source", "_size", "_run")
    numbers = F.sequence(F.col("_run") * run, F.least((F.col("_run") + 1) * run - 1, last))
    return few.unionByName(many).withColumn("_copy", F.explode(numbers)).drop("_m", "_run")


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
           group: int = GROUP, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key, source, size, source_size, target, copies, taken`` per row of ``docs``."""
    size = F.size(words_of(F.coalesce(F.col(text), F.lit("")))).cast("bigint")
    rows = stored(docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), size.alias("_size")), "mix-rows")
    plan = stored(targets(weighted_sources(rows, weights), most), "mix-targets")
    plan = plan.select(F.col("_source").alias("_s"), "_total", "_target")

    units = each_row(rows.groupBy("_key", "_source", "_size").agg(F.count(F.lit(1)).alias("_m")))
    units = units.join(plan, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    mean = F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(F.lit(1.0))
    units = units.withColumn("_mean", mean).withColumn("_base", F.floor("_mean"))
    units = units.select(
        F.struct("_key", "_size", "_base").alias("key"), "_source", "_total", F.col("_size").cast("double").alias("w"),
        (F.col("_mean") - F.col("_base")).alias("p"), F.when(F.col("_copy") == 0, seeded(seed, F.col("_key"), F.col("_size"))).otherwise(
            seeded(seed, F.col("_key"), F.col("_size"), F.col("_copy"))).alias("h"))
    units = stored(units, "mix-units")
    kind = units.schema["key"].dataType.simpleString()
    moving = (F.col("w") > 0) & ~_whole(F.col("p"))
    alone = F.when(unit(F.col("h")) < F.col("p"), F.lit(1.0)).otherwise(F.lit(0.0))
    settled = [units.where(~moving).withColumn("p", F.when(_whole(F.col("p")), F.round("p")).otherwise(alone))]

    items = units.where(moving)
    n = items.groupBy("_source").agg(F.count(F.lit(1)).alias("_n"))
    largest = n.agg(F.max("_n")).first()[0] or 0
    n = n.select(F.col("_source").alias("_s"), F.ceil(F.col("_n") / group).alias("_groups"))
    items = items.join(n, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    items = items.withColumn("_group", F.least(F.floor(unit(F.col("h")) * F.col("_groups")), F.col("_groups") - 1).cast("bigint"))
    level, groups = 0, -(-largest // group)
    while groups:
        met = stored(_reduce(items, level, kind), f"mix-level-{level}")
        if groups == 1:  # the last of each source
            settled.append(met.withColumn("p", F.round("p")))
            break
        settled.append(met.where(_whole(F.col("p"))))
        items = met.where(~_whole(F.col("p"))).withColumn("_group", F.expr(f"_group div {group}"))
        level, groups = level + 1, -(-groups // group)

    out = None
    for part in settled:
        part = part.select(F.col("key._key").alias("_k"), F.col("key._size").alias("_z"), F.col("_source").alias("_o"),
                           (F.col("key._base") + F.round("p")).cast("bigint").alias("copies"))
        out = part if out is None else out.unionByName(part)
    rows = out.join(plan, F.col("_o").eqNullSafe(F.col("_s")))
    return rows.select(F.col("_k").alias(key), F.col("_o").alias(source), F.col("_z").alias("size"),
                       F.col("_total").alias("source_size"), F.col("_target").alias("target"), "copies",
                       (F.col("copies") * F.col("_z")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; rows taken 0 times go."""
    found = copies(docs, weights, most, seed, key=key, text=text, source=source)
    found = found.groupBy(F.col(key).alias("k"), F.col(source).alias("o"), F.col("size").alias("z")).agg(
        (F.sum("copies") / F.count(F.lit(1))).alias("mean")).where("mean > 0")
    size = F.size(words_of(F.coalesce(field(text), F.lit("")))).cast("bigint")
    # Rows that nothing tells apart share their copies: each has the whole part, and one more with the chance of the rest.
    rows = packed(docs).withColumn("u", unit(seeded(seed, F.monotonically_increasing_id())))
    taken = rows.join(found, field(key).eqNullSafe(F.col("k")) & field(source).eqNullSafe(F.col("o")) & (size == F.col("z")))
    taken = taken.withColumn("copies", (F.floor("mean") + (F.col("u") < F.col("mean") - F.floor("mean")).cast("int")).cast("bigint"))
    return taken.where("copies > 0").select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
