"""The deterministic rules as functions of SQL, for queries in text: registered once in a session, then callable by name.

Scalar functions take and give plain values; table functions take a JSON answer or a page's size and give rows. They are SQL
functions, so Catalyst inlines their bodies: no Python runs in them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pagelake.functions import regions as R
from pagelake.functions import text as T


def _names(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


FUNCTIONS = {
    "page_region_type": f"""(raw STRING) RETURNS STRING RETURN CASE WHEN raw IS NULL THEN 'TableRegion' WHEN array_contains({_names(R.REGION_TYPES)}, raw) THEN raw
        ELSE coalesce(try_element_at(filter({_names(R.REGION_TYPES)}, t -> contains(lower(t), lower(raw)) OR contains(lower(raw), lower(t))), 1), 'ParagraphRegion') END""",
    "page_natural_key": """(name STRING) RETURNS ARRAY<STRUCT<s: STRING, n: DECIMAL(38,0)>> RETURN transform(split(regexp_replace(name, '([0-9]+)', concat(chr(0), '$1', chr(0))), chr(0), -1),
        (p, i) -> named_struct('s', CASE WHEN i % 2 = 0 THEN lower(p) ELSE '' END, 'n', CASE WHEN i % 2 = 1 THEN CAST(p AS DECIMAL(38,0)) ELSE CAST(0 AS DECIMAL(38,0)) END))""",
    "page_stem": r"""(name STRING) RETURNS STRING RETURN regexp_replace(name, '(?<=[^/])\\.[^.]*$', '')""",
    "page_mime": f"""(name STRING) RETURNS STRING RETURN coalesce(try_element_at(map({", ".join(f"'{k}', '{v}'" for k, v in T.MIME.items())}), lower(regexp_extract(name, '(?<=[^/])(\\\\.[^./]*)$', 1))), 'image/png')""",
    "page_pixel_box": f"""(x DOUBLE, y DOUBLE, w DOUBLE, h DOUBLE, img_w INT, img_h INT) RETURNS TABLE(px INT, py INT, pw INT, ph INT)
        RETURN SELECT CAST(x1 AS INT), CAST(y1 AS INT), CAST(least(w0 + 2 * mx, img_w - x1) AS INT), CAST(least(h0 + 2 * my, img_h - y1) AS INT) FROM
        (SELECT *, greatest(0, x0 - mx) AS x1, greatest(0, y0 - my) AS y1, greatest(10, least(CAST(w * img_w / 1000 AS BIGINT), img_w - x0)) AS w0, greatest(10, least(CAST(h * img_h / 1000 AS BIGINT), img_h - y0)) AS h0 FROM
        (SELECT greatest(0, least(CAST(x * img_w / 1000 AS BIGINT), img_w - 1)) AS x0, greatest(0, least(CAST(y * img_h / 1000 AS BIGINT), img_h - 1)) AS y0, CAST(img_w * {R.MARGIN}D AS BIGINT) AS mx, CAST(img_h * {R.MARGIN}D AS BIGINT) AS my))""",
    "page_regions": """(answer STRING) RETURNS TABLE(pos INT, region_type STRING, reading_order INT, bbox VARIANT)
        RETURN SELECT r.pos, try_variant_get(r.value, '$.type', 'string'), try_variant_get(r.value, '$.reading_order', 'int'), try_variant_get(r.value, '$.bbox', 'variant') FROM variant_explode(try_variant_get(try_parse_json(answer), '$.regions', 'variant')) AS r""",
}


def register(spark: SparkSession) -> SparkSession:
    """Create or replace the functions in the session."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return spark
