"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document of a source is wanted ``target / source_size`` times. The whole part is given to all; the fractional
part is a copy probability, which holds a mass of ``probability x size`` words. Two documents meet: one passes words to
the other until one of them is integral (out, or in whole), in which direction is drawn so that each probability stays
what it was on average. The one with a fraction left goes on to the next. Words are only moved, so a source takes its
target, whatever the sizes.

The meetings form a reduction tree: documents are dealt by a seeded hash into groups of about ``GROUP``, a group is
folded to one residual, and the residuals of ``GROUP`` groups meet on the next level, up to one residual a source.
A source of any share of the rows is spread over many groups. Each level is written to the shared folder.

The last residual of a source is one document with a fraction of a copy: ``last="part"`` takes that many of its words
(the target is met to the word), ``last="round"`` draws the whole copy or none (all copies are whole).

Documents without words have no mass: they are taken ``round(target / source_size)`` times, with 0 words. A null
source is a source like any other. Draws depend on the seed, ids and sizes alone, so reruns agree; rows with a null id
are told apart by their place in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterloom.llm.common import free_name, store

GROUP = 64
WEIGHTS = (3, 1, 2)
_ITEM = "struct<key:bigint,row:bigint,size:bigint,mass:double>"
_DONE = "array<struct<row:bigint,up:int>>"
_TINY = 1e-6  # words


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source``, ``n``, ``source_size``, ``target`` from rows of ``source``, ``size``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words. A target stops at
    ``most`` times its source; the excess is shared by weight until none is above. There is one row for each source.
    """
    known = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    ranked = known.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "n", "source_size", "rank", weight.alias("weight"), (F.lit(most) * F.col("source_size")).alias("limit"))
    # Sources reach their limit in the order of limit / weight; the level is that of the first that does not.
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    wanted = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    level = (wanted - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
    free = F.col("limit") >= F.col("level") * F.col("weight")
    final = F.min_by(F.when(free, F.col("level")), F.when(free, F.col("place"))).over(Window.partitionBy())
    target = F.coalesce(F.least("limit", F.col("weight") * final), F.col("limit"))
    return levels.select("source", "n", "source_size", target.alias("target"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def _item(one: Column, mass: Column) -> Column:
    return F.struct(one["key"].alias("key"), one["row"].alias("row"), one["size"].alias("size"), mass.alias("mass")).cast(_ITEM)


def _settled(one: Column, mass: Column) -> Column:
    return (mass <= _TINY) | (one["size"] - mass <= _TINY)


def _decision(one: Column, mass: Column) -> Column:
    return F.struct(one["row"].alias("row"), (mass > one["size"] / 2).cast("int").alias("up"))


def _meet(state: Column, item: Column, seed: int) -> Column:
    """One meeting: the state has the settled documents so far and the one with a fraction left."""
    cur = state["cur"]
    gives = F.least(cur["mass"], item["size"] - item["mass"])
    gets = F.least(cur["size"] - cur["mass"], item["mass"])
    # Chance of giving: gets / (gives + gets), which keeps both expectations.
    draw = _uniform(F.lit(seed), cur["key"], item["key"]) * (gives + gets)
    moved = F.when(draw < gets, -gives).otherwise(gets)

    def after(move: Column) -> Column:
        mine, its = cur["mass"] + move, item["mass"] - move
        decided = F.filter(
            F.array(
                F.when(_settled(cur, mine), _decision(cur, mine)), F.when(_settled(item, its), _decision(item, its))
            ),
            lambda d: d.isNotNull(),
        )
        rest = F.when(~_settled(cur, mine), _item(cur, mine)).when(~_settled(item, its), _item(item, its))
        return F.struct(F.concat(state["done"], decided).cast(_DONE).alias("done"), rest.alias("cur"))

    first = F.struct(state["done"].alias("done"), _item(item, item["mass"]).alias("cur"))
    return F.when(cur.isNull(), first).otherwise(_let(moved, after))


def _fold(rows: DataFrame, seed: int) -> DataFrame:
    """Rows of ``source``, ``group``, ``item`` to one row a group: ``done``, ``cur``."""
    start = F.struct(F.array().cast(_DONE).alias("done"), F.lit(None).cast(_ITEM).alias("cur"))
    # Large documents first, so that what is left over tends to be small.
    ordered = F.reverse(F.array_sort(F.collect_list(F.struct(F.col("item.size"), F.col("item.key"), F.col("item.row"), "item"))))
    folded = F.aggregate(ordered, start, lambda state, x: _meet(state, x["item"], seed))
    return rows.groupBy("source", "group").agg(folded.alias("state")).select("source", "group", "state.*")


def allot(
    docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", seed: int = 11,
    last: str = "part", **sharing,
) -> tuple[DataFrame, DataFrame, str]:
    """``docs`` stored with a row number, the allotment per row number, and that column's name.

    The allotment has ``size``, ``source_size``, ``target``, ``copies`` (whole ones) and ``part`` (words of a last one).
    """
    row = free_name(docs.columns, "mix_row")
    docs = store(docs.withColumn(row, F.monotonically_increasing_id()), "mix")
    narrow = docs.select(
        F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(size_col).alias("size")
    )
    known = store(targets(narrow, **sharing), "targets")
    # A null source must find its row: join on the null-safe comparison.
    wanted = narrow.alias("d").join(known.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("d.*", "t.n", "t.source_size", "t.target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = wanted.withColumn("rate", rate).withColumn("base", F.floor("rate").cast("int"))
    mass = (F.col("rate") - F.col("base")) * F.col("size")
    open_ = (mass > _TINY) & (F.col("size") - mass > _TINY)
    key = F.when(F.col("id").isNull(), F.xxhash64(F.lit(seed), "row")).otherwise(F.xxhash64(F.lit(seed), "id", "size"))
    wanted = wanted.withColumn("mass", mass)

    level = 0
    spread = F.ceil(F.col("n") / GROUP)
    rows = wanted.filter(open_).withColumn("key", key).select(
        "source",
        F.pmod("key", spread).alias("group"),
        F.struct("key", "row", "size", "mass").cast(_ITEM).alias("item"),
    )
    settled = []
    while True:
        folded = store(_fold(rows, seed + level), "round")
        settled.append(folded.select(F.explode("done").alias("d")).select("d.row", "d.up", F.lit(0).cast("bigint").alias("part")))
        rest = folded.filter("cur is not null").select("source", F.floor(F.col("group") / GROUP).alias("group"), F.col("cur").alias("item"))
        if (folded.agg(F.max("group")).first()[0] or 0) == 0:
            break
        rows, level = rest, level + 1
    size, left = F.col("item.size"), F.col("item.mass")
    if last == "part":
        up, part = F.lit(0), F.round(left).cast("bigint")
    else:
        up, part = (_uniform(F.lit(seed), F.lit(-1), F.col("item.key")) * size < left).cast("int"), F.lit(0).cast("bigint")
    decided = rest.select("item.row", up.alias("up"), part.alias("part"))
    for one in settled:
        decided = decided.unionByName(one)
    whole = F.when(F.col("size") == 0, F.round("rate").cast("int")).when(F.col("size") - F.col("mass") <= _TINY, F.col("base") + 1).otherwise(F.col("base"))
    # One row for each document: a merge join, whatever the files' size.
    found = wanted.join(decided.hint("merge"), "row", "left").select(
        "row", "size", "source_size", "target",
        F.coalesce(F.col("base") + F.col("up"), whole).alias("copies"), F.coalesce("part", F.lit(0)).alias("part"),
    )
    return docs, found.withColumnRenamed("row", row), row


def mix(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (whole copies), with their columns."""
    names, size = docs.columns, free_name(docs.columns, "mix_size")
    docs = docs.withColumn(size, word_count(F.col(text_col)))
    stored, found, row = allot(docs, size_col=size, last="round", **options)
    copies = found.filter("copies > 0").select(row, F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return stored.join(copies.select(row).hint("merge"), row).select(*(F.col(f"`{c}`") for c in names))
