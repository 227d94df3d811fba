"""Points, rectangles and lines of text on a page. Every join has equality keys first; the geometry is a residual."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def point_in_rect(points: DataFrame, rects: DataFrame, key: Sequence[str], x: str, y: str, order: str, point_id: str, cell: float | None = None) -> DataFrame:
    """points with the first rectangle (by `order`) of the same key that holds them: left <= x < right, top <= y < bottom.

    Points in none are left out, and points of equal key and place share their rectangle, so places are joined once. With
    `cell`, key and a grid cell both join: a rectangle stands in each cell that it touches, a place in one. Of a place's
    rectangles the first is a grouped minimum, which combines before it is shuffled.
    """
    places, r, on = points.select(*key, x, y).distinct(), rects, list(key)
    if cell:
        places = places.withColumns({"_cx": F.floor(F.col(x) / cell), "_cy": F.floor(F.col(y) / cell)})
        for c, low, high in (("_cx", "left", "right"), ("_cy", "top", "bottom")):
            r = r.withColumn(c, F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))))
        on = [*on, "_cx", "_cy"]
    inside = (F.col(x) >= F.col("left")) & (F.col(x) < F.col("right")) & (F.col(y) >= F.col("top")) & (F.col(y) < F.col("bottom"))
    kept = [c for c in rects.columns if c not in key]
    hits = places.join(r, on).filter(inside)
    first = hits.groupBy(*key, x, y).agg(F.min(F.struct(order, *(c for c in kept if c != order))).alias("_r"))
    return points.join(first, [*key, x, y]).select(*points.columns, *(F.col(f"_r.{c}").alias(c) for c in kept))


def cells(low: Column | str, high: Column | str, cell: float) -> Column:
    """The numbers of the grid cells that a stretch touches; none for nulls or where its end lies before its start."""
    a, b = (F.floor((F.col(x) if isinstance(x, str) else x) / cell) for x in (low, high))
    return F.when(b >= a, F.sequence(a, b))


def band_overlap(words: DataFrame, bands: DataFrame, key: Sequence[str], least: float = 0.5, cell: float = 32.0) -> DataFrame:
    """Every (word, band) of a key whose vertical overlap is `least` (over 0) of the word's height or more.

    Key and a grid cell of height join, so that a key with many words and bands is dealt over its cells and words meet
    nearby bands alone; a pair that shares several cells counts in the first of them. No result depends on `cell`.
    """
    w = words.withColumn("_cell", F.explode(cells("top", "bottom", cell)))
    b = bands.withColumn("_cell", F.explode(cells("band_top", "band_bottom", cell)))
    shared = F.greatest(F.lit(0), F.least("bottom", "band_bottom") - F.greatest("top", "band_top"))
    once = F.col("_cell") == F.floor(F.greatest("top", "band_top") / cell)
    near = w.join(b, [*key, "_cell"]).filter(once).withColumn("overlap", shared / F.greatest(F.col("bottom") - F.col("top"), F.lit(1e-9)))
    return near.filter(F.col("overlap") >= least).drop("_cell")


def neighbour_overlaps(rects: DataFrame, by: Sequence[str], order: Sequence[str], ahead: int = 3) -> DataFrame:
    """by..., id, other: rectangles that overlap one of the next `ahead` in order."""
    w = W.partitionBy(*by).orderBy(*order)
    box = F.struct("id", "left", "top", "right", "bottom")
    nexts = F.filter(F.array(*(F.lead(box, k).over(w) for k in range(1, ahead + 1))), lambda b: b.isNotNull())
    hits = rects.withColumn("_n", nexts).select(*by, "id", "left", "top", "right", "bottom", F.explode("_n").alias("o"))
    return hits.filter("left < o.right AND o.left < right AND top < o.bottom AND o.top < bottom").select(*by, "id", F.col("o.id").alias("other"))


def nearest_within(expected: DataFrame, found: DataFrame, key: Sequence[str], want: str, have: str, tolerance: float) -> DataFrame:
    """expected with the closest found value of its key, null where none lies within the tolerance; the smaller wins ties.

    Found values stand in their bucket of one tolerance's width and its neighbours, expected ones in their own. Within a
    bucket both are sorted together and each expected value looks at the found ones next to it: no value meets all others.
    """
    wide = tolerance or 1.0
    at = lambda v: F.floor(F.col(v) / wide)
    asked = expected.filter(F.col(want).isNotNull()).select(*key, F.col(want).alias("_v"), at(want).alias("_b")).distinct()
    given = found.filter(F.col(have).isNotNull()).select(*key, F.col(have).alias("_h"), at(have).alias("_b")).distinct()
    given = given.withColumn("_b", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))
    both = asked.withColumns({"_at": F.col("_v").cast("double"), "_h": F.lit(None).cast(found.schema[have].dataType)}).unionByName(given.withColumns({"_at": F.col("_h").cast("double"), "_v": F.lit(None).cast(expected.schema[want].dataType)}))
    w = W.partitionBy(*key, "_b").orderBy("_at")
    below, above = F.last("_h", ignorenulls=True).over(w.rangeBetween(W.unboundedPreceding, W.currentRow)), F.first("_h", ignorenulls=True).over(w.rangeBetween(W.currentRow, W.unboundedFollowing))
    rows = both.withColumns({"_below": below, "_above": above}).filter(F.col("_v").isNotNull())
    near = lambda c: F.when(F.abs(F.col("_v") - F.col(c)) <= tolerance, F.struct(F.abs(F.col("_v") - F.col(c)).alias("d"), F.col(c).alias("h")))
    best = rows.withColumn("_m", F.least(near("_below"), near("_above"))).filter(F.col("_m").isNotNull()).select(*key, F.col("_v").alias(want), F.col("_m.h").alias(have))
    return expected.join(best, [*key, want], "left")


def on_every_page(rules: DataFrame, by: Sequence[str], page: str, value: str, tolerance: float) -> DataFrame:
    """by..., value: values of the first page that every page has within the tolerance.

    A page's values are reduced to the ends of each bucket of one tolerance's width; a value looks at the ends of its own
    and the two next to it, one row for each page, however many values a page has.
    """
    wide = tolerance or 1.0
    rows = rules.filter(F.col(value).isNotNull())
    pages = rules.groupBy(*by).agg(F.count_distinct(page).alias("_pages"), F.min(page).alias("_first"))
    ends = rows.groupBy(*by, page, F.floor(F.col(value) / wide).alias("_b")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    first = rows.join(pages, list(by)).filter(F.col(page) == F.col("_first")).select(*by, F.col(value).alias("_v"), "_pages").distinct()
    own = F.floor(F.col("_v") / wide)
    first = first.withColumn("_b", F.explode(F.array(own - 1, own, own + 1)))
    near = (F.abs(F.col("_v") - F.col("_lo")) <= tolerance) | (F.abs(F.col("_v") - F.col("_hi")) <= tolerance)
    if not tolerance:
        exact = rows.groupBy(*by, page, F.col(value).alias("_v")).agg(F.count("*"))
        hits = first.select(*by, "_v", "_pages").distinct().join(exact, [*by, "_v"])
    else:
        hits = first.join(ends, [*by, "_b"]).filter(near)
    return hits.groupBy(*by, "_v", "_pages").agg(F.count_distinct(page).alias("_n")).filter("_n = _pages").select(*by, F.col("_v").alias(value))


def group_lines(words: DataFrame, by: Sequence[str], least: float = 0.7) -> DataFrame:
    """by..., line, text, top, bottom: words into lines by top; a word joins the current line while its overlap with the
    line's running extent is `least` of the shorter.

    The extent depends on earlier words, so a group's words are folded in order as they stream by: one line is held at a
    time, however many words its group has.
    """
    names = [*by, "line", "text", "top", "bottom"]

    def fold(batches):
        group, number, line = None, 0, None

        def close():
            top, bottom, members = line
            return (*group, number, " ".join(str(t) for _, _, t in sorted(members, key=lambda m: m[:2])), float(top), float(bottom))

        for pdf in batches:
            rows = []
            for *keys, top, left, text, bottom in pdf[[*by, "top", "left", "text", "bottom"]].itertuples(index=False, name=None):
                if line is not None and tuple(keys) == group:
                    shared = min(line[1], bottom) - max(line[0], top)
                    if shared >= least * max(1e-9, min(line[1] - line[0], bottom - top)):
                        line = (min(line[0], top), max(line[1], bottom), [*line[2], (left, top, text)])
                        continue
                if line is not None:
                    rows.append(close())
                number = number + 1 if tuple(keys) == group else 0
                group, line = tuple(keys), (top, bottom, [(left, top, text)])
            yield pd.DataFrame(rows, columns=names)
        if line is not None:
            yield pd.DataFrame([close()], columns=names)

    kinds = {f.name: f.dataType.simpleString() for f in words.schema}
    rows = words.select(*by, "top", "left", "text", "bottom").repartition(*by).sortWithinPartitions(*by, "top", "left", "text")
    return rows.mapInPandas(fold, ", ".join(f"{c} {kinds[c]}" for c in by) + ", line long, text string, top double, bottom double")


def _packed(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Rows of equal `by` as one, with what else they have as structs in an array."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.collect_list(F.struct(*rest) if rest else F.struct(F.lit(0).alias("_"))).alias(name))


#: Lots in which words and rectangles of one place are packed, and how many ways the words of a grid cell are dealt.
WORD_LOTS, RECT_LOTS, DEALT = 64, 8, 4


def words_within(words: DataFrame, rects: DataFrame, key: Sequence[str], slack: float = 2.0, cell: float = 50.0) -> DataFrame:
    """Every (word, rectangle) of a key where the word lies between the rectangle's sides, give or take the slack, and its
    middle height within it; words, by left side and middle, meet only the rectangles of their grid cell.

    Words of one place, and rectangles of one place, are packed into arrays of a lot each, and places are joined: what lies
    in many rectangles costs its result rows and no comparisons. The work of a cell can't be told by its bytes, so cells are
    dealt over all shuffle partitions, each cell's words DEALT ways. No result depends on cells and lots.
    """
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place, area, on = ["left", "right", "top", "bottom"], ["rect_left", "rect_right", "rect_top", "rect_bottom"], [*key, "_row", "_col", "_deal"]
    lot = lambda df, by, lots: F.pmod(F.hash(F.lit(0), *(c for c, kind in df.dtypes if c not in by and "map<" not in kind)), F.lit(lots))
    middle = (F.col("top") + F.col("bottom")) / 2
    w = words.withColumns({"_row": F.floor(middle / cell), "_col": F.floor(F.col("left") / cell), "_lot": lot(words, [*key, *place], WORD_LOTS)})
    w = _packed(w.withColumn("_deal", F.col("_lot") % DEALT).repartition(n, *on), [*on, *place, "_lot"], "_ws")
    r = _packed(rects.withColumn("_side", lot(rects, [*key, *area], RECT_LOTS)), [*key, *area, "_side"], "_rs")
    r = r.withColumn("_row", F.explode(cells("rect_top", "rect_bottom", cell)))
    r = r.withColumn("_col", F.explode(cells(F.col("rect_left") - slack, F.col("rect_right") + slack, cell)))
    r = r.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))).repartition(n, *on)
    inside = (F.col("left") >= F.col("rect_left") - slack) & (F.col("right") <= F.col("rect_right") + slack) & (middle >= F.col("rect_top")) & (middle < F.col("rect_bottom"))
    pairs = w.join(r.hint("merge"), on).filter(inside).withColumn("_w", F.explode("_ws")).withColumn("_r", F.explode("_rs"))
    told = lambda df, by, of: [F.col(c if c in by else f"{of}.{c}").alias(c) for c in df.columns if c not in key]
    return pairs.select(*key, *told(words, place, "_w"), *told(rects, area, "_r"))
