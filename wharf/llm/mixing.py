"""Mixing sources to target weights: Sainte-Lague apportionment of words, taken in blocks.

A source's words are laid out in seeded order, shard by shard, and cut into blocks of ``block`` words.
Targets become integer quotas of words by highest quotients, first over the sources, then over each
source's shards. Within a shard, whole rounds take every block; the rest of the quota goes to the blocks
with the smallest seeded hash, the last of them cut to the words still owed. All of it is aggregates,
windows and joins of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import WORD, boxed, content_key, cut, unboxed

BLOCK = 64  # words of a block
SHARD = 1 << 20  # words of a shard, about: bounds what one window sorts together
MOST = 3  # times that a word may be taken


def size_column(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` in, plus ``weight`` and ``target`` out.

    Sources by code point, null last, take the weights in turn. Targets share the total of all sizes by
    weight, none above ``most`` times its source's size. Sources reach their limit in the order of
    limit / weight; with the first k at their limits, the others share the rest at one level (words per
    unit of weight). The right k is the smallest whose level does not lift the next source over its limit.

    ``sizes`` has one row per source: the windows below see the sources, never documents.
    """
    named = sizes.select(
        "source", "source_size",
        F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))).alias("_n"),
    )
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_n") - 1) % len(weights) + 1).cast("int"))
    named = named.select("source", "source_size", pick.alias("weight"), (F.col("source_size") * most).cast("double").alias("_limit"))
    order = Window.orderBy((F.col("_limit") / F.col("weight")), F.col("source").isNull(), F.col("source").cast("binary"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = (F.col("_total") - F.col("_full")) / F.col("_open")
    ranked = named.select(
        "*",
        F.coalesce(F.sum("_limit").over(before), F.lit(0.0)).alias("_full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_open"),
        F.sum("source_size").over(everything).cast("double").alias("_total"),
    )
    # Row k says the level if all sources before it are at their limits; it holds if k itself stays below.
    fits = F.when(level * F.col("weight") <= F.col("_limit"), level)
    # the level falls or stays once it holds, so the first that holds is the answer
    ranked = ranked.select("*", F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_level"))
    target = F.when(F.col("_level").isNull(), F.col("_limit")).otherwise(F.least("_limit", F.col("_level") * F.col("weight")))
    return ranked.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def sainte_lague(parties: DataFrame, vote: str, group: list[str], name: list[str], seats: str, out: str = "quota") -> DataFrame:
    """Seats of each party within its group by highest quotients vote / (2k + 1).

    ``seats`` (a column, the same on all rows of a group) is the number to allocate. With n parties, all
    seats at the divisor total / (seats - n/2 - 1) are surely won and none beyond the divisor
    total / (seats + n/2 + 1) can be, since rounding moves each party by at most a half; only the few
    quotients between are ranked. Ties go to the first party by ``name``.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    n, total = F.count(F.lit(1)).over(whole), F.sum(vote).over(whole)
    share = F.when(F.col("_total") > 0, F.col(vote) / F.col("_total")).otherwise(F.lit(0.0))
    least = F.floor(share * F.greatest(F.col(seats) - F.col("_n") / 2 - 1, F.lit(0.0)) + 0.5)
    most = F.floor(share * (F.col(seats) + F.col("_n") / 2 + 1) + 0.5)
    sure = parties.withColumns({"_n": n, "_total": total}).withColumns({"_least": least, "_most": F.greatest(most, least)})
    sure = sure.withColumn("_open", F.col(seats) - F.sum("_least").over(whole))
    tried = sure.where(F.col("_most") > F.col("_least")).select(
        *group, *name, vote, "_open", F.explode(F.sequence(F.col("_least"), F.col("_most") - 1)).alias("_k")
    )
    best = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    best = best.orderBy((F.col(vote) / (2 * F.col("_k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in name], F.col("_k"))
    won = (
        tried.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= F.col("_open"))
        .groupBy(*group, *name).agg(F.count(F.lit(1)).alias("_won"))
    )
    keys = list(dict.fromkeys(group + name))
    won = won.select(*[F.col(c).alias(f"_w_{c}") for c in keys], "_won")
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return sure.join(won, on, "left").select(*parties.columns, (F.col("_least") + F.coalesce("_won", F.lit(0))).cast("long").alias(out))


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", content_key("doc_id", "text").alias("_hash"), "source", size_column().alias("size"))


def _place(seed: int, number: Column) -> Column:
    """A block's place among those of its shard (columns ``source`` and ``_shard``): by seeded hash."""
    return F.struct(F.xxhash64(F.lit(seed), F.col("source"), F.col("_shard"), number).alias("hash"), number.alias("number"))


def mix(documents: DataFrame, seed: int = 7, block: int = BLOCK, shard: int = SHARD, most: int = MOST, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """One row per document: ``doc_id``, ``_hash``, ``size``, ``source_size``, ``target``, ``taken``,
    ``rounds`` and ``spans``.

    The mix takes the whole document ``rounds`` times, and once more its words [from, to) of each entry of
    ``spans``. No word is taken more than ``most`` times. A source's taken words are its target rounded by
    highest quotients, whatever the size of the corpus: a shard's last block counts by the words it holds.

    Null text has size 0 and is never taken; a null source is a source like others (last in order). Rows
    that repeat are mixed as documents of their own. An empty table gives an empty result. Other columns
    of ``documents`` do not matter. Reruns agree: order and choice come from hashes of the rows.
    """
    rows = cut(_rows(documents))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, most))

    by_source = targets.select(F.col("source").alias("_s"), "source_size", "target")
    rows = rows.join(by_source, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    shards = F.greatest(F.ceil(F.col("source_size") / shard), F.lit(1)).cast("long")
    rows = rows.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "_hash"))
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64("_order"), shards))
    # rows without words have no place in the line: however many there are, they stand in groups of their own
    alone = F.when(F.col("size") == 0, F.col("_order"))
    line = Window.partitionBy("source", "_shard", alone).orderBy("_order", "doc_id", "_hash").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_at", F.coalesce(F.sum("size").over(line), F.lit(0).cast("long")))

    cells = rows.groupBy("source", "_shard").agg(F.sum("size").alias("_words")).where(F.col("_words") > 0)
    parties = targets.withColumn("_seats", F.floor(F.sum("target").over(Window.partitionBy(F.lit(0))) + 0.5))
    quotas = sainte_lague(parties, "target", [], ["source"], "_seats").select(F.col("source").alias("_s"), F.col("quota").alias("_seats"))
    cells = cells.join(quotas, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    cells = sainte_lague(cells, "_words", ["source"], ["_shard"], "_seats")
    # Of a cell's blocks, those beyond the whole rounds are the ones with the smallest seeded hashes: the
    # cell keeps the last one as a limit, so documents can judge their own blocks, and the words that it
    # still owes (all blocks but the one at the cell's end hold ``block`` words).
    quota = F.least(F.col("quota"), F.lit(most) * F.col("_words"))
    rounds = F.floor(quota / F.col("_words")).cast("int")
    end = F.floor((F.col("_words") - 1) / block).cast("long")
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), end), lambda b: _place(seed, b)))
    cells = cells.select(
        "source", "_shard", rounds.alias("rounds"), (quota - rounds * F.col("_words")).alias("_extra"),
        end.alias("_end"), (F.col("_words") - end * block).alias("_short"), ranked.alias("_ranked"),
    )
    before = (F.array_position("_ranked", _place(seed, F.col("_end"))) - 1) * block  # words taken before the end's block
    lacks = F.when(F.col("_extra") > before + F.col("_short"), block - F.col("_short")).otherwise(F.lit(0).cast("long"))
    nth = F.when(
        (F.col("_extra") > before) & (F.col("_extra") <= before + F.col("_short")), F.floor(before / block) + 1
    ).otherwise(F.ceil((F.col("_extra") + lacks) / block))
    cells = cells.select("*", nth.cast("int").alias("_nth"), lacks.alias("_lacks"))
    cells = cells.select(
        F.col("source").alias("_s"), F.col("_shard").alias("_c"), "rounds",
        F.when(F.col("_extra") > 0, F.element_at("_ranked", F.greatest("_nth", F.lit(1)))).alias("_limit"),
        (F.col("_extra") + F.col("_lacks") - (F.col("_nth") - 1) * block).alias("_owed"),
    )
    rows = rows.join(cells, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_c")), "left").drop("_s", "_c")
    last = F.col("_at") + F.col("size")
    touched = F.when(
        (F.col("size") > 0) & F.col("_limit").isNotNull(),
        F.filter(
            F.sequence(F.floor(F.col("_at") / block), F.floor((last - 1) / block)),
            lambda b: _place(seed, b) <= F.col("_limit"),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    spans = F.transform(
        touched,
        lambda b: F.struct(
            (F.greatest(b * block, F.col("_at")) - F.col("_at")).alias("from"),
            (F.least(b * block + F.when(b == F.col("_limit.number"), F.col("_owed")).otherwise(F.lit(block)), last) - F.col("_at")).alias("to"),
        ),
    )
    spans = F.filter(spans, lambda x: x["to"] > x["from"])  # the last block may end before the document
    rows = rows.withColumn("rounds", F.when(F.col("size") > 0, F.coalesce("rounds", F.lit(0))).otherwise(F.lit(0))).withColumn("spans", spans)
    more = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"])
    return rows.select(
        "doc_id", "_hash", "size", "source_size", "target", (F.col("rounds") * F.col("size") + more).alias("taken"), "rounds", "spans"
    )


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself, with the columns of ``documents``: a document comes ``rounds`` times whole, and once
    more with the words of its spans (joined by single spaces) if it has any. ``n_chars`` follows the text."""
    plan = mix(documents, **settings)
    nth = Window.partitionBy("doc_id", "_hash").orderBy("rounds", F.size("spans"))
    plan = plan.where("taken > 0").withColumn("_nth", F.row_number().over(nth))
    plan = plan.select(F.col("doc_id").alias("_i"), F.col("_hash").alias("_h"), F.col("_nth").alias("_m"), "rounds", "spans")
    cols = documents.columns
    rows = boxed(documents).withColumn("_id", F.col("row.doc_id")).withColumn("_key", F.xxhash64("_id", "text"))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.lit(0))))
    rows = rows.join(plan, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_h")) & (F.col("_nth") == F.col("_m")))
    # a text's words are found once, as the one element that the outer lambda sees, whatever its spans
    words = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))

    def taken_words(w: Column) -> Column:
        cuts = F.transform("spans", lambda s: F.slice(w, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))
        return F.array_join(F.flatten(cuts), " ")

    part = F.transform(words, taken_words)
    no_text = F.array().cast("array<string>")
    whole = F.when(F.col("rounds") > 0, F.array_repeat(F.col("text"), F.col("rounds"))).otherwise(no_text)
    rows = rows.select("row", F.explode(F.concat(whole, F.when(F.size("spans") > 0, part).otherwise(no_text))).alias("_text"))
    rows = rows.select(*unboxed(cols, "_text"))
    if "n_chars" in cols:
        rows = rows.withColumn("n_chars", F.length("text").cast(dict(documents.dtypes)["n_chars"]))
    return rows
