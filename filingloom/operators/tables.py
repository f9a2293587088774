"""Tables: cells to grids under three policies, grids to fields, to pipe tables and to lines.

A table's grid stands in the table's own row: an array of rows of cell numbers, where a cell stands first, -2 - number where a
merged cell shows again, BLANK where no cell is, null where nothing reaches. Fields, text and lines are made from the
arrays; nothing is exploded before the result, so no table is shuffled or sorted for it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.functions import clean_cell, clean_text, escape_cell, joined_labels, normalize_scalar, scalar_kind, scalar_value, strip
from filingloom.operators.forms import OPEN

TABLE = ["rcept_no", "block_no"]
GRID = "array<array<int>>"
#: Cells that hold labels, and cells that hold values.
LABELS, VALUES = ("TD", "TH"), ("TE", "TU")
UNITS = ("acode", "aunit", "aunitvalue")
#: Cell numbers of a place without a cell, and of one that is still free.
BLANK, FREE = -1, -2


@dataclass(frozen=True)
class Policy:
    """How merged cells fill a grid. strict: a span that is no number fails the table, else it counts as 1. shown: places after
    a merged cell's first show it too. walked: places below a merged cell fill only as a row's own cells reach them, and
    the grid's width is given. overhang: rows below the last one exist where merged cells reach them."""

    strict: bool
    shown: bool
    walked: bool
    overhang: bool


# The three families.
POLICIES = {"shared": Policy(False, True, False, False), "repeat": Policy(True, True, True, False), "origin": Policy(True, False, False, True)}


def span(text: Any, strict: bool) -> int:
    """A span attribute; missing or empty is 1, below 0 is 0."""
    try:
        return max(0, int(text or 1))
    except ValueError:
        if strict:
            raise
        return 1


def grid_places(row: np.ndarray, down: np.ndarray, right: np.ndarray, n_cols: int, policy: Policy) -> list[tuple[int, int, int]]:
    """(row, col, cell number) of a table's grid, from its cells in order.

    Two arrays over the columns carry what merged cells still owe to the rows below: owed counts rows, owner names the
    cell. A row is an array too: debts and own cells are written to slices of it, own cells into the first free column.
    """
    n_rows = int(row.max(initial=-1)) + 1
    starts = np.searchsorted(row, np.arange(n_rows + 1))
    sums = np.add.reduceat(np.r_[right, 0], starts[:-1]) * (starts[1:] > starts[:-1]) if n_rows else np.zeros(0, int)
    width = max(n_cols, int(sums.max(initial=0))) if policy.walked else int(right.sum())
    owed, owner, out = np.zeros(width, np.int64), np.full(width, BLANK), []
    r = 0
    while r < n_rows or policy.overhang and (owed > 0).any():
        line = np.full(width, FREE)
        if not policy.walked:
            due = owed > 0
            line[due] = owner[due]
            owed[due] -= 1
            below = owed.copy()
        at = 0
        for i in range(starts[r], starts[r + 1]) if r < n_rows else ():
            free = np.flatnonzero((owed if policy.walked else line - FREE)[at:] == 0)
            to = at + int(free[0]) if len(free) else width
            if policy.walked:
                settle(line, owed, owner, at, to)
            if to == width and policy.walked:
                at = width
                break
            end = min(to + int(right[i]), width)
            if policy.overhang and not down[i]:  # no row, no place
                at = end
                continue
            line[to:end] = i if policy.shown else BLANK
            line[to : min(to + 1, end)] = i
            if down[i] > 1:
                debts = owed if policy.walked else below
                debts[to:end] = down[i] - 1 if policy.shown else np.maximum(debts[to:end], down[i] - 1)
                owner[to:end] = i if policy.shown else BLANK
            at = to + int(right[i])
        if policy.walked:
            free = np.flatnonzero(owed[at:] == 0)
            settle(line, owed, owner, at, at + int(free[0]) if len(free) else width)
            line[line == FREE] = BLANK
        else:
            owed = below
            if policy.shown:  # gaps left of a row's last place are blank
                used = np.flatnonzero(line != FREE)
                last = int(used[-1]) + 1 if len(used) else 0
                line[:last][line[:last] == FREE] = BLANK
        cols = np.flatnonzero(line != FREE)
        out += zip([r] * len(cols), cols.tolist(), line[cols].tolist())
        r += 1
    return out


def settle(line: np.ndarray, owed: np.ndarray, owner: np.ndarray, start: int, end: int) -> None:
    """Columns that a row walks through take what is owed to them."""
    line[start:end] = owner[start:end]
    owed[start:end] -= 1


def piped(line: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(line, " | "), F.lit(" |"))


def let(value: Column, made: Callable[[Column], Column]) -> Column:
    """made(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def encoded(places: list[tuple[int, int, int]]) -> list[list[int | None]]:
    """Places (row, col, cell) in order as a grid."""
    grid: list[list[int | None]] = []
    seen = set()
    for r, c, n in places:
        grid += [[] for _ in range(r + 1 - len(grid))]
        grid[r] += [None] * (c - len(grid[r]))
        grid[r].append(-2 - n if n in seen else n)
        if n >= 0:
            seen.add(n)
    return grid


def placed(row: list, down: list, right: list, n_cols: int, policy: str) -> tuple[str | None, list | None]:
    """The error or the grid of a table, by the rows and spans of its cells alone."""
    how = POLICIES[policy]
    try:
        sizes = [np.array([span(x, how.strict) for x in some], np.int64) for some in (down, right)]
        return None, encoded(grid_places(np.asarray(row, np.int64), *sizes, n_cols, how))
    except ValueError as e:
        return f"ValueError: {e}", None


def gridded(blocks: DataFrame, policy: str) -> DataFrame:
    """blocks with a column grid (null but for tables), and with an error for tables whose spans are bad, where policy says so.

    Only tables with merged or missing cells go to the helper, which sees positions alone. Filings follow forms, so shapes recur:
    each is expanded once a batch.
    """

    def place(shapes: pa.Array) -> pa.Array:
        coded, out = shapes.dictionary_encode(), []
        for text in coded.dictionary.to_pylist():
            shape = json.loads(text)
            out.append(placed(*(shape.get(n) or [] for n in ("row", "rowspan", "colspan")), shape.get("n_cols") or 0, policy))
        errors, grids = zip(*out) if out else ([], [])
        each = pa.StructArray.from_arrays([pa.array(errors, pa.string()), pa.array(grids, pa.list_(pa.list_(pa.int32())))], ["error", "grid"])
        return each.take(coded.indices)

    put = F.arrow_udf(place, f"struct<error:string,grid:{GRID}>")
    b = blocks if "error" in blocks.columns else blocks.withColumn("error", F.lit(None).cast("string"))
    b = b.withColumn("cells", F.coalesce("cells", F.array().cast(blocks.schema["cells"].dataType)))
    merged = F.exists("cells", lambda c: ~(F.coalesce(c["rowspan"], F.lit("")).isin("", "1") & F.coalesce(c["colspan"], F.lit("")).isin("", "1")))
    rows, cols = F.array_max("cells.row") + 1, F.array_max("cells.at") + 1
    regular = (F.size("cells") == 0) | (~merged & (F.size("cells") == rows * cols) & (F.coalesce("n_cols", F.lit(0)) <= cols))
    as_is = F.when(F.size("cells") == 0, F.array().cast(GRID)).otherwise(F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.sequence(r * cols, r * cols + cols - 1)))
    table = F.coalesce(F.col("type") == "table", F.lit(False))
    b = b.withColumn("_odd", table & ~regular)
    shape = F.to_json(F.struct(F.col("cells.row").alias("row"), F.col("cells.rowspan").alias("rowspan"), F.col("cells.colspan").alias("colspan"), "n_cols"))
    b = b.withColumn("_p", put(F.when(F.col("_odd"), shape)))
    return b.withColumns({"grid": F.when(F.col("_odd"), F.col("_p.grid")).when(table, as_is), "error": F.coalesce("error", "_p.error")}).drop("_p", "_odd")


def number(place: Column) -> Column:
    """The cell of a place; null for a blank one."""
    return F.when(place >= 0, place).when(place < BLANK, -2 - place)


def cell(place: Column) -> Column:
    return F.get("cells", number(place))


def expand_spans(tables: DataFrame, policy: str) -> DataFrame:
    """Rows of a grid: the tables' key columns, error, row, col, cell_no (-1: no cell) and the cell's columns; one row without a
    place for a table that has none, or that failed."""
    keys = [c for c in tables.columns if c not in ("cells", "n_cols", "error")]
    places = F.flatten(F.transform("grid", lambda line, r: F.transform(line, lambda p, c: F.struct(r.alias("row"), c.alias("col"), p.alias("p")))))
    each = gridded(tables.where("type = 'table'"), policy).select(*keys, "error", "cells", F.inline_outer(F.filter(places, lambda x: x["p"].isNotNull())))
    no = F.when(F.col("p").isNotNull(), F.coalesce(number(F.col("p")), F.lit(BLANK)))
    return each.select(*keys, "error", "row", "col", no.alias("cell_no"), *(cell(F.col("p"))[c].alias(f"cell_{c}") for c in ("tag", "text", "acode", "aunit", "aunitvalue")))


def spread_out(texts: Column) -> Column:
    """The grid with each place's text; blank places are empty."""
    return F.transform("grid", lambda line: F.transform(line, lambda p: F.coalesce(F.get(texts, number(p)), F.lit(""))))


def table_values(grids: DataFrame) -> DataFrame:
    """Values of shared grids with their labels: labels since the last new value of the row name the next; a merged value counts once."""

    def counted(line: Column, texts: Column) -> Column:
        """What counts in a row: values where they stand first, and labels that aren't blank."""
        entry = F.transform(line, lambda p, col: F.struct(col.alias("col"), number(p).alias("cell"), F.get(texts, number(p)).alias("t"), ((p >= 0) & cell(p)["tag"].isin(*VALUES)).alias("new"), cell(p)["tag"].isin(*LABELS).alias("label")))
        return F.filter(entry, lambda e: e["new"] | (e["label"] & (e["t"] != "")))

    def fields(entries: Column, row: Column) -> Column:
        at = F.filter(F.transform(entries, lambda e, i: F.when(e["new"], i + 1)), lambda i: i.isNotNull())

        def one(ends: Column, end: Column, k: Column) -> Column:
            start = F.when(k > 0, F.get(ends, k - 1)).otherwise(0)
            value = F.get(entries, end - 1)
            return F.struct(row.alias("row"), value["col"].alias("col"), value["cell"].alias("cell"), *(F.get("cells", value["cell"])[x].alias(x) for x in ("tag", *UNITS)), value["t"].alias("raw_value"), F.transform(F.slice(entries, start + 1, end - start - 1), lambda e: e["t"]).alias("labels"))

        return let(at, lambda ends: F.transform(ends, lambda end, k: one(ends, end, k)))

    texts = F.transform("cells", lambda c: clean_cell(F.coalesce(c["text"], F.lit(""))))
    found = let(texts, lambda t: F.flatten(F.transform("grid", lambda line, r: let(counted(line, t), lambda entries: fields(entries, r)))))
    t = grids.where("type = 'table' and error is null").select(*TABLE, "section_path", "aclass", F.inline(found))
    return t.select(*TABLE, "row", "col", "section_path", F.col("aclass").alias("table_aclass"), "labels", "tag", *UNITS, "raw_value")


def gathered_values(values: DataFrame) -> DataFrame:
    """(rcept_no, fields): of table_values, what payload_fields reads, in order, in the filing's row."""
    one = F.struct(F.struct("block_no", "row", "col").alias("pos"), "labels", "aunitvalue", "raw_value")
    return values.groupBy("rcept_no").agg(F.sort_array(F.collect_list(one)).alias("fields"))


def payload_fields(fields: Column) -> Column:
    """Records (pos, label, value, value_type) of gathered_values, as read_fields has them."""

    def one(x: Column) -> Column:
        label, unit = F.nullif(joined_labels(x["labels"]), F.lit("")), x["aunitvalue"]
        record = lambda t, kind: F.struct(x["pos"].alias("pos"), label.alias("label"), scalar_value(kind, t, unit).alias("value"), kind.alias("value_type"))
        return let(strip(x["raw_value"]), lambda t: let(scalar_kind(t, unit), lambda kind: record(t, kind)))

    return F.transform(fields, one)


def read_fields(values: DataFrame) -> DataFrame:
    """Label/value fields of table_values: equal labels once, values by their kinds."""
    label = F.nullif(joined_labels(F.col("labels")), F.lit(""))
    f = values.withColumn("label", label).drop("labels")
    f = f.select(*TABLE, "row", "col", "section_path", "table_aclass", "label", "tag", *UNITS, "raw_value")
    return f.select("*", normalize_scalar(F.col("raw_value"), F.col("aunitvalue")).alias("n")).select(*f.columns, "n.*")


def table_fields(grids: DataFrame) -> DataFrame:
    """Label/value fields of shared grids."""
    return read_fields(table_values(grids))


def pipe_text(lines: Column, width: Column | int = 0) -> Column:
    """Header, rule and body; short rows are filled up."""

    def text(rows: Column, w: Column) -> Column:
        full = lambda x: piped(F.concat(x, F.array_repeat(F.lit(""), w - F.size(x))))
        body = F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(1))), full)
        return F.array_join(F.concat(F.array(full(F.get(rows, F.lit(0))), piped(F.array_repeat(F.lit("---"), w))), body), "\n")

    return let(lines, lambda rows: let(F.greatest(F.array_max(F.transform(rows, F.size)), F.lit(width) if isinstance(width, int) else width), lambda w: text(rows, w)))


def periodic_text() -> Column:
    """A repeat grid as text: blank rows dropped, the first row heads the table; null without any text."""
    texts = F.transform("cells", lambda c: clean_text(c["text"]))
    rows = let(texts, lambda t: F.filter(spread_out(t), lambda line: F.exists(line, lambda x: x != "")))
    escaped = lambda r: F.transform(r, lambda line: F.transform(line, lambda x: escape_cell(x, "periodic")))
    return let(rows, lambda r: F.when(F.size(r) > 0, pipe_text(escaped(r))))


def pipeline_text() -> Column:
    """A shared grid as text: leading rows without a value cell merge into one header, merged cells print once, a single
    cell is a quote; null where the body has no text."""

    def name(head: Column, col: Column) -> Column:
        """The texts above a column, each run of equal ones once."""
        some = F.filter(F.transform(head, lambda line: F.get(line, col)), lambda x: x != "")
        return let(some, lambda ts: F.array_join(F.filter(ts, lambda x, i: (i == 0) | (x != F.get(ts, i - 1))), " "))

    def text(t: Column, body_at: Column) -> Column:
        shown = F.transform("grid", lambda line: F.transform(line, lambda p: F.when(p >= 0, escape_cell(F.get(t, p), "pipeline")).otherwise("")))
        body = F.filter(F.slice(shown, body_at + 1, F.greatest(F.size("grid"), F.lit(1))), lambda line: F.exists(line, lambda x: strip(x) != ""))
        width = F.array_max(F.transform("grid", F.size))
        head = F.slice(spread_out(t), F.lit(1), body_at)
        titles = let(head, lambda h: F.transform(F.sequence(F.lit(0), width - 1), lambda c: escape_cell(name(h, c), "pipeline")))

        def whole(b: Column) -> Column:
            single = (body_at == 0) & (F.size(b) == 1) & (F.size(F.get(b, F.lit(0))) == 1)
            quote = F.concat(F.lit("> "), F.get(F.get(b, F.lit(0)), F.lit(0)))
            return F.when(F.size(b) == 0, None).when(single, quote).when(body_at > 0, pipe_text(F.concat(F.array(titles), b), width)).otherwise(pipe_text(b))

        return let(body, whole)

    valued = F.filter(F.transform("grid", lambda line, r: F.when(F.exists(line, lambda p: cell(p)["tag"].isin(*VALUES)), r)), lambda r: r.isNotNull())
    texts = F.transform("cells", lambda c: clean_cell(F.coalesce(c["text"], F.lit(""))))
    return let(texts, lambda t: let(F.coalesce(F.get(valued, F.lit(0)), F.lit(0)), lambda body_at: text(t, body_at)))


def marked_heads(grids: DataFrame) -> DataFrame:
    """The keys of forms (operators.forms) in which marks may decide how rows above the first value merge into one header."""
    valued = F.transform("grid", lambda line: F.exists(line, lambda p: F.coalesce(cell(p)["tag"].isin(*VALUES), F.lit(False))))
    head = let(F.coalesce(F.array_position(valued, True).cast("int") - 1, F.lit(0)), lambda n: F.when(n > 1, F.slice("grid", F.lit(1), n)).otherwise(F.array().cast(GRID)))
    marked = F.exists(F.flatten(head), lambda p: F.coalesce(F.contains(cell(p)["text"], F.lit(OPEN)), F.lit(False)))
    return grids.where(F.col("type") == "table").where(marked).select("rcept_no").distinct()


TEXTS = {"repeat": periodic_text, "shared": pipeline_text}


def table_text(policy: str) -> Column:
    """The pipe text of a row of gridded(blocks, policy) that is a whole table; null for other rows."""
    return F.when((F.col("type") == "table") & F.col("grid").isNotNull(), TEXTS[policy]())


def exchange_rows(grids: DataFrame) -> DataFrame:
    """(rcept_no, block_no, row, cells): the non-empty cells of every row of origin grids."""
    line = lambda places: F.filter(F.transform(F.filter(places, lambda p: p >= 0), lambda p: clean_text(F.get("cells", p)["text"])), lambda t: t != "")
    rows = grids.where("type = 'table' and error is null").select(*TABLE, F.posexplode(F.transform("grid", line)).alias("row", "cells"))
    return rows.where(F.size("cells") > 0)
