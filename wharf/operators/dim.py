"""Dimension table apply (T6, K3-K5): keyed upserts and deletes of sparse string cells.

A dimension table is ``(sink_table, row_key, family, cells map<string,string>)``. Per
``(sink_table, row_key)``, a ``delete`` clears the row and every other change writes its non-null
cells; per cell the latest write wins. ``null_cells="keep_old"`` (D8, the table's contract) skips null
cells, so an update to null keeps the old value; ``"overwrite"`` lets the null remove the cell. A row
exists while it has a cell (D16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.functions.jsonx import get_string

DIM_COLUMNS = ("sink_table", "row_key", "family", "cells")


def _writes(changes: DataFrame, order: Column) -> DataFrame:
    """One row per written cell and one marker row (``col`` NULL) per delete, from a single generator
    over each change, so the input plan is read once."""
    is_del = F.col("change_op") == "delete"
    marker = F.array(F.struct(F.lit(None).cast("string").alias("col"), F.lit(None).cast("string").alias("val")))
    cells = F.transform(
        F.map_entries(F.coalesce(F.col("data"), F.create_map().cast("map<string,variant>"))),
        lambda e: F.struct(e["key"].alias("col"), get_string(e["value"]).alias("val")),
    )
    return changes.select(
        "sink_table", "row_key", F.col("sink_family").alias("family"), order.alias("o"),
        F.inline(F.when(is_del, marker).otherwise(cells)),
    )


def apply_changes(
    changes: DataFrame,
    base: DataFrame | None = None,
    null_cells: str = "keep_old",
    order: tuple[str, ...] = ("ts", "partition", "offset"),
) -> DataFrame:
    """The table after applying ``changes`` (from :func:`wharf.operators.cdc.trim`) to ``base``.

    Plan, two keyed aggregates and no window:

    1. per ``(sink_table, row_key, col)``: the latest kept write (``max_by`` over the change order) and
       its position; deletes are cells with ``col`` NULL. Partial aggregation runs map-side, so a row
       key holding a third of all changes collapses before the shuffle.
    2. per ``(sink_table, row_key)``: the last delete, and the cells written after it. At most one
       entry per column reaches this step, so the ``collect_list`` is bounded by the column count.

    ``base`` cells count as writes ordered before every change, so a delete clears them and a kept
    old cell survives a null update.
    """
    o = F.struct(F.lit(1).alias("src"), F.struct(*[F.col(c) for c in order]).alias("pos"))
    w = _writes(changes, o)
    if base is not None:
        pos_type = changes.select(F.struct(*[F.col(c) for c in order])).schema[0].dataType
        bo = F.struct(F.lit(0).alias("src"), F.lit(None).cast(pos_type).alias("pos"))
        bw = base.select("sink_table", "row_key", "family", bo.alias("o"), F.explode(F.map_entries("cells")).alias("e")).select(
            "sink_table", "row_key", "family", "o", F.col("e.key").alias("col"), F.col("e.value").alias("val")
        )
        w = bw.unionByName(w)
    return _rows(_fold(w, null_cells))


def row_effects(changes: DataFrame, null_cells: str = "keep_old", order: tuple[str, ...] = ("ts", "partition", "offset")) -> DataFrame:
    """What a batch of changes does to each row key, without reading the table: ``(sink_table, row_key,
    family, cleared, cells)``. ``cleared``: a delete emptied the row; ``cells``: the last writes after it
    (a null value, under ``"overwrite"``, removes the cell). The work grows with the batch alone."""
    w = _writes(changes, F.struct(*[F.col(c) for c in order]))
    return _fold(w, null_cells).where(F.col("cleared") | (F.size("cells") > 0))


def fold_effects(effects: DataFrame, n: str = "n") -> DataFrame:
    """The table that :func:`row_effects` of batches numbered ``n`` lead to, applied in that order."""
    return _rows(fold_to_effects(effects, n))


def fold_to_effects(effects: DataFrame, n: str = "n") -> DataFrame:
    """:func:`row_effects` of several batches as those of one."""
    none = F.lit(None).cast("string")
    marker = F.array(F.struct(none.alias("col"), none.alias("val"), F.lit(0).alias("s")))
    cells = F.transform(F.map_entries("cells"), lambda e: F.struct(e["key"].alias("col"), e["value"].alias("val"), F.lit(1).alias("s")))
    w = effects.select("sink_table", "row_key", "family", F.col(n).alias("_n"), F.inline(F.when(F.col("cleared"), F.concat(marker, cells)).otherwise(cells)))
    w = w.select("sink_table", "row_key", "family", F.struct("_n", "s").alias("o"), "col", "val")
    return _fold(w, "overwrite")


def _rows(folded: DataFrame) -> DataFrame:
    """The rows of a table: those with a cell."""
    cells = F.map_filter("cells", lambda _k, v: v.isNotNull())
    return folded.select("sink_table", "row_key", "family", cells.alias("cells")).where(F.size("cells") > 0)


def _fold(w: DataFrame, null_cells: str) -> DataFrame:
    """Writes (``o, col, val``; a delete has no ``col``) to one row per row key, as :func:`row_effects`."""
    if null_cells not in ("keep_old", "overwrite"):
        raise ValueError("null_cells must be 'keep_old' or 'overwrite'")
    is_cell = F.col("col").isNotNull()
    counted = (is_cell & F.col("val").isNotNull()) if null_cells == "keep_old" else is_cell
    o_kept = F.when(counted | ~is_cell, F.col("o"))
    per_cell = w.groupBy("sink_table", "row_key", "col").agg(
        F.max_by(F.col("val"), o_kept).alias("val"),
        F.max(o_kept).alias("o"),
        F.max_by(F.col("family"), F.col("o")).alias("family"),
        F.max(F.col("o")).alias("o_any"),
    )
    last_del = F.max(F.when(F.col("col").isNull(), F.col("o")))
    per_row = per_cell.groupBy("sink_table", "row_key").agg(
        last_del.alias("ld"),
        F.collect_list(F.when(F.col("col").isNotNull() & F.col("o").isNotNull(), F.struct("col", "val", "o"))).alias("cs"),
        F.max_by(F.col("family"), F.col("o_any")).alias("family"),
    )
    live = F.filter(F.col("cs"), lambda c: F.col("ld").isNull() | (c["o"] > F.col("ld")))
    cells = F.map_from_entries(F.transform(live, lambda c: F.struct(c["col"], c["val"])))
    return per_row.select("sink_table", "row_key", "family", F.col("ld").isNotNull().alias("cleared"), cells.alias("cells"))


def unpivot_cells(dim: DataFrame) -> DataFrame:
    """``(sink_table, row_key, column, value)``, one row per cell."""
    return dim.select("sink_table", "row_key", F.explode(F.map_entries("cells")).alias("e")).select(
        "sink_table", "row_key", F.col("e.key").alias("column"), F.col("e.value").alias("value")
    )
