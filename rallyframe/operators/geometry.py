"""Page numbers and row strips of rendered pages, as relations; pixels are not made here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written


def pages(spec: Column, total: Column) -> Column:
    """0-based pages of a text such as ``1-5,8``, in order and with repeats, inside the document; an empty text means all.

    A part that is no number fails, as does a range with one; a descending range is empty.
    """
    part = lambda x: F.split(x, "-")

    def numbers(x):
        a, b = F.get(part(x), 0).cast("int"), F.get(part(x), F.size(part(x)) - 1).cast("int")
        return F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(F.array().cast("array<int>"))

    listed = F.flatten(F.transform(F.filter(F.transform(F.split(spec, ","), lambda x: F.trim(x)), lambda x: x != ""), numbers))
    inside = F.transform(F.filter(listed, lambda p: (p >= 1) & (p <= total)), lambda p: p - 1)
    everything = F.when(total > 0, F.sequence(F.lit(0), F.greatest(total - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.when(F.trim(F.coalesce(spec, F.lit(""))) == "", everything).otherwise(inside)


def _page(rows: DataFrame) -> list[str]:
    """Columns that tell a page: ``page`` (from 0), and ``file`` where rows of several files come together."""
    return [c for c in ("file", "page") if c in rows.columns]


def rendered(pages_: DataFrame, dpi: float = 200) -> DataFrame:
    """``pages_`` (page from 0, width and height in points) with the image's name, zoom, and width and height in pixels."""
    zoom = F.lit(dpi) / 72
    size = lambda c: F.ceil(F.col(c) * zoom).cast("int").alias(f"{c}_px")
    return pages_.select("*", F.format_string("page-%03d.png", F.col("page").cast("int") + 1).alias("name"), zoom.alias("zoom"), size("width"), size("height"))


def ruling_lines(shapes: DataFrame) -> DataFrame:
    """(file if given, page, y): long horizontal lines, and both edges of rectangles, of (page, width, kind, x0, y0, x1, y1)."""
    line = F.when((F.col("kind") == "l") & (F.abs(F.col("y0") - F.col("y1")) < 1) & (F.abs(F.col("x1") - F.col("x0")) > F.col("width") / 2), F.array("y0"))
    edges = line.when(F.col("kind") == "re", F.array("y0", "y1")).otherwise(F.array().cast("array<double>"))
    return shapes.select(*_page(shapes), F.explode(edges).alias("y"))


def dealt(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with a column _part: ranges of about equally many rows in ``order``, so that a key with most rows has many parts."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())


def clusters(points: DataFrame, key: str | list[str], value: str, gap: float) -> DataFrame:
    """(key, cluster, n, mean, low, high): a cluster ends where the next value is more than ``gap`` further.

    Points are dealt by ranges of key and value, clusters are made inside each range, and those at the joint of two ranges of one
    key become one where the gap is small.  What comes together for a key has one row a range, so that a key may have most points.
    """
    keys = [key] if isinstance(key, str) else key
    inside = Window.partitionBy(*keys, "_part").orderBy(value)
    new = F.coalesce((F.col(value) - F.lag(value).over(inside) > gap).cast("int"), F.lit(0))
    rows = dealt(points.select(*keys, value), [*keys, value]).withColumn("_new", new)
    rows = rows.withColumn("_own", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = rows.groupBy(*keys, "_part", "_own").agg(F.count("*").alias("n"), F.count(value).alias("_known"), F.sum(value).alias("_sum"), F.min(value).alias("low"), F.max(value).alias("high"))
    pieces = written(pieces, "clusters")
    ranges = pieces.groupBy(*keys, "_part").agg(F.count("*").alias("_count"), F.min("low").alias("_low"), F.max("high").alias("_high"))
    along = Window.partitionBy(*keys).orderBy("_part")
    apart = F.coalesce(F.col("_low") - F.lag("_high").over(along) > gap, F.lit(False))
    ranges = ranges.withColumn("_joined", ((F.row_number().over(along) > 1) & ~apart).cast("int"))
    before = F.sum("_count").over(along) - F.col("_count") - F.sum("_joined").over(along)
    ranges = ranges.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), before.alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    found = pieces.join(ranges, [*same, F.col("_part") == F.col("_p")]).withColumn("cluster", F.col("_before") + F.col("_own"))
    whole = [F.sum("n").alias("n"), (F.sum("_sum") / F.sum("_known")).alias("mean"), F.min("low").alias("low"), F.max("high").alias("high")]
    return found.groupBy(*keys, "cluster").agg(*whole)


def following(rows: DataFrame, key: str | list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``value`` of the next row of the same key as ``name``, null for the last one.

    ``order`` tells all rows of a key apart.  As in ``clusters`` a key with most rows is dealt to many tasks: the last row of a
    range takes what the next range of the key begins with.
    """
    keys = [key] if isinstance(key, str) else key
    held = written(dealt(rows, [*keys, *order]), "following")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    first = held.groupBy(*keys, "_part").agg(F.min_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_first"))
    along = Window.partitionBy(*keys).orderBy("_part")
    first = first.withColumn("_next", F.lead("_first").over(along))
    first = first.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), "_next")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    out = held.withColumn("_own", F.lead(F.struct(F.col(value).alias("v"))).over(inside)).join(first, [*same, F.col("_part") == F.col("_p")])
    return out.select(*rows.columns, F.coalesce("_own", "_next")["v"].alias(name))


def strips(lines: DataFrame, least: float = 12, gap: float = 4.0, margin: float = 1.0) -> DataFrame:
    """(file if given, page, row, name, top, bottom, clip_top, clip_bottom): spaces of ``least`` height between neighbouring clusters of lines.

    All spaces of a page are numbered from 0, those that are too low as well; the name counts pages from 1.  The clip reaches
    ``margin`` beyond both lines.
    """
    keys = _page(lines)
    order = Window.partitionBy(*keys).orderBy("mean")
    rows = clusters(lines, keys, "y", gap).withColumn("row", F.row_number().over(order) - 1).withColumn("bottom", F.lead("mean").over(order))
    name = F.format_string("p%03d-row%02d.png", F.col("page").cast("int") + 1, F.col("row"))
    return rows.where(F.col("bottom") - F.col("mean") >= least).select(
        *keys, "row", name.alias("name"), F.col("mean").alias("top"), "bottom", (F.col("mean") - margin).alias("clip_top"), (F.col("bottom") + margin).alias("clip_bottom")
    )
