"""Region geometry and taxonomy as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The region taxonomy, in its matching order.
REGION_TYPES = ["TitleRegion", "TableRegion", "GraphRegion", "ParagraphRegion", "MarginaliaRegion", "FootnoteRegion", "PageNumberRegion"]
# The keys that may carry each edge of a box; the first that is present decides.
X, Y = ["x", "left", "x_min", "xmin", "x1"], ["y", "top", "y_min", "ymin", "y1"]
WIDTH, HEIGHT = ["width", "w"], ["height", "h"]
X_MAX, Y_MAX = ["x_max", "xmax", "x2", "right", "x1"], ["y_max", "ymax", "y2", "bottom", "y1"]
METADATA = ["title_text", "rows", "cols", "header_rows", "has_red_ink", "has_totals_row", "graph_type", "has_fitted_curve", "line_count", "script", "page_number"]
MARGIN = 0.003
MAX_REGIONS = 12
SMALLEST = 10

BOX = "struct<x:double,y:double,width:double,height:double>"


def normal_type(raw: Column) -> Column:
    """A taxonomy name as it is; else the first one that holds the text or is held by it, whatever the case; else a paragraph.

    A missing type is a table.
    """
    names = F.array(*[F.lit(t) for t in REGION_TYPES])
    low = F.lower(raw)
    like = F.filter(names, lambda t: F.contains(F.lower(t), low) | F.contains(low, F.lower(t)))
    return F.when(raw.isNull(), "TableRegion").when(raw.isin(REGION_TYPES), raw).otherwise(F.coalesce(F.get(like, 0), F.lit("ParagraphRegion")))


def has_key(box: Column, key: str) -> Column:
    """Whether a variant object has the key, null values included."""
    return F.variant_get(box, f"$.{key}", "variant").isNotNull()


def _bound(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _first(box: Column, keys: list[str]) -> Column:
    """The number under the first key that is there; null if it does not convert, or there is none."""
    here = F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.map_contains_key(box, k))
    return F.try_element_at(box, F.get(here, 0))


def _box(x: Column, y: Column, width: Column, height: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), width.alias("width"), height.alias("height"))


def _from_list(v: Column) -> Column:
    ymin, xmin, ymax, xmax = (F.get(v, i) for i in range(4))
    return F.when((F.size(v) == 4) & (ymax > ymin) & (xmax > xmin), _box(xmin, ymin, xmax - xmin, ymax - ymin))


def _from_edges(e: Column) -> Column:
    x, y, w, h, right, bottom = (F.get(e, i) for i in range(6))
    sized = x.isNotNull() & y.isNotNull() & w.isNotNull() & h.isNotNull()
    cornered = x.isNotNull() & y.isNotNull() & (right > x) & (bottom > y)
    return F.when(sized, _box(x, y, w, h)).when(cornered, _box(x, y, right - x, bottom - y))


def normal_box(box: Column) -> Column:
    """The box of a variant: a list [ymin, xmin, ymax, xmax], or an object by size or by corners; null if unusable."""
    kind = F.schema_of_variant(box)
    as_list = _bound(F.try_variant_get(box, "$", "array<double>"), _from_list)
    edges = _bound(F.try_variant_get(box, "$", "map<string,double>"), lambda m: F.array(*[_first(m, k) for k in (X, Y, WIDTH, HEIGHT, X_MAX, Y_MAX)]))
    return F.when(kind.startswith("ARRAY"), as_list).when(kind.startswith("OBJECT"), _bound(edges, _from_edges))


def recovered(box: Column) -> Column:
    """Whether an object lacks width or height under these very names."""
    return F.schema_of_variant(box).startswith("OBJECT") & ~(has_key(box, "width") & has_key(box, "height"))


def pixel_box(x: Column, y: Column, width: Column, height: Column, img_w: Column, img_h: Column, margin: float = MARGIN) -> Column:
    """The box on a 0-1000 grid in pixels: clamped, at least ten wide and high, then widened by a margin and clipped."""

    def scaled(v: Column, size: Column) -> Column:
        return (v * size / 1000).cast("long")

    px = F.greatest(F.lit(0), F.least(scaled(x, img_w), img_w - 1))
    py = F.greatest(F.lit(0), F.least(scaled(y, img_h), img_h - 1))
    pw = F.greatest(F.lit(SMALLEST), F.least(scaled(width, img_w), img_w - px))
    ph = F.greatest(F.lit(SMALLEST), F.least(scaled(height, img_h), img_h - py))
    mx, my = (img_w * margin).cast("long"), (img_h * margin).cast("long")
    left, top = F.greatest(F.lit(0), px - mx), F.greatest(F.lit(0), py - my)
    return F.struct(left.cast("int").alias("x"), top.cast("int").alias("y"), F.least(pw + 2 * mx, img_w - left).cast("int").alias("width"), F.least(ph + 2 * my, img_h - top).cast("int").alias("height"))


def split_spread(stem: Column, width: Column, height: Column, overlap: int = 10) -> Column:
    """The two pages of a spread: each half and an overlap over the middle."""
    mid = F.floor(width / 2).cast("int")

    def side(name: str, left: Column, right: Column) -> Column:
        return F.struct(F.concat(stem, F.lit(f"_{name}")).alias("page_id"), F.lit(name).alias("side"), left.cast("int").alias("x0"), right.cast("int").alias("x1"), (right - left).cast("int").alias("width"), height.alias("height"))

    return F.array(side("L", F.lit(0), F.least(mid + overlap, width)), side("R", F.greatest(mid - overlap, F.lit(0)), width))


def viewer_size(width: Column, height: Column, most: int) -> Column:
    """Width and height after scaling down to at most `most` pixels across."""
    wide = width > most
    return F.struct(F.when(wide, most).otherwise(width).alias("width"), F.when(wide, (height * (F.lit(float(most)) / width)).cast("int")).otherwise(height).alias("height"))
