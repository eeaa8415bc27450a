"""One browsable HTML file from a run's Markdown, images and region files."""

from __future__ import annotations

import argparse
import html
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions import render
from pagelake.functions import text as T
from pagelake.operators import images, viewer
from pagelake.sources import scans, sinks

STYLE = "body{font-family:serif;margin:0}nav{position:sticky;top:0;background:#fff;padding:.5em}.page{display:flex;gap:1em;padding:1em}.page>*{flex:1;min-width:0}.scan{position:relative}.scan img{width:100%}.region-overlay{position:absolute;inset:0;width:100%}.rg-halo,.rg-box{fill:none;stroke-width:3}.table-wrap{overflow-x:auto}.red{color:#a00}.key{border-left:1em solid;padding:0 .5em}.summary,.number{color:#666}"
SCRIPT = "const q=document.querySelector('#q');q.oninput=()=>{const v=q.value.trim().toLowerCase();document.querySelectorAll('.page').forEach(p=>p.hidden=!p.dataset.search.includes(v))};"


def page_html(pages: DataFrame) -> DataFrame:
    """Viewer pages with the HTML fragment of each."""
    picture = F.when(F.col("image_src").isNotNull(), F.concat(F.lit('<div class="scan"><img loading="lazy" src="'), "image_src", F.lit('">'), "overlay_svg", F.lit("</div>"))).otherwise("")
    number = F.when(F.col("page_number") != "", F.concat(F.lit(' <span class="number">p. '), T.html_escape(F.col("page_number")), F.lit("</span>"))).otherwise("")
    head = F.concat(F.lit("<h2>"), T.html_escape(F.col("page_id")), number, F.lit('</h2><p class="summary">'), T.html_escape(F.col("regions_summary")), F.lit("</p>"))
    fragment = F.concat(F.lit('<section class="page" id="'), T.slug(F.col("page_id")), F.lit('" data-search="'), T.html_escape(viewer.search_blob()), F.lit('">'), picture, F.lit("<article>"), head, "md_html", F.lit("</article></section>"))
    return pages.withColumn("md_html", render.rendered(F.col("body"))).withColumn("fragment", fragment)


def build(spark: SparkSession, run_dir: str, out_file: str, title: str = "Pages", embed: bool = True, max_width: int = 1600) -> dict:
    """Write the viewer and return its numbers. Fragments are made and put in order by Spark; none comes to the driver."""
    docs = scans.markdown_files(spark, f"{run_dir}/md")
    pictures = scans.decoded(spark, f"{run_dir}/pages")
    sizes = scans.sized(spark, f"{run_dir}/pages")
    pages = viewer.viewer_pages(docs, sizes.select("stem", F.lower("ext").alias("ext"), "width", "height"), scans.region_files(spark, f"{run_dir}/regions"))

    @F.pandas_udf("binary")
    def small(data, width, height, channels):
        return data.combine(width.combine(height.combine(channels, lambda h, c: (h, c)), lambda w, hc: (w, *hc)), lambda d, s: None if d is None else images.png(images.scaled(images.rgb(images.from_bgr(d, *map(int, s)), int(s[0]), int(s[1])), max_width)))

    shown = pictures.where("error is null").select("stem", small("bgr", "width", "height", "channels").alias("png")).dropDuplicates(["stem"])
    pages = pages.join(shown, "stem", "left")
    if embed:
        pages = pages.withColumn("image_src", F.when(F.col("png").isNotNull(), images.data_uri(F.col("png"))))
    else:
        assets = os.path.splitext(out_file)[0] + "_assets"
        sinks.fresh_folder(assets)
        sinks.write_files(pages.where("png is not null").select(F.concat("stem", F.lit(".png")).alias("name"), "png"), assets, "name", "png")
        pages = pages.withColumn("image_src", F.when(F.col("png").isNotNull(), F.concat(F.lit(os.path.basename(assets) + "/"), "stem", F.lit(".png"))))
    pages = page_html(pages.drop("png")).cache()
    # A few region types: the legend in its order.
    types = viewer.legend(viewer.region_boxes(scans.region_files(spark, f"{run_dir}/regions"))).orderBy("rank", "stem", "ord").collect()
    key = "".join(f'<span class="key" style="border-color:{t.colour}">{html.escape(t.region_type)}</span>' for t in types)
    numbers = viewer.stats(pages).first().asDict()
    place = T.natural_key(F.concat("stem", F.lit(".md")))
    items = pages.withColumn("item", F.concat(F.lit('<li><a href="#'), T.slug(F.col("page_id")), F.lit('">'), T.html_escape(F.col("page_id")), F.lit("</a></li>")))
    head = f'<!doctype html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title><style>{STYLE}</style></head><body><nav><input id="q" placeholder="Search">{key}</nav><ol class="pages">'
    sinks.write_in_order([head, (items, place, "item"), "</ol>", (pages, place, "fragment"), f"<script>{SCRIPT}</script></body></html>"], out_file)
    pages.unpersist()
    return numbers


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="pagelake.plans.viewer", description="One HTML file from the folder of a run.")
    p.add_argument("run_dir", help="the output folder of a document run")
    p.add_argument("-o", "--output", help="the file to write; viewer.html in the run's folder by default")
    p.add_argument("--title", default="Pages")
    p.add_argument("--no-embed", action="store_true", help="images as files beside the HTML")
    p.add_argument("--max-width", type=int, default=1600)
    a = p.parse_args(argv)
    if a.max_width < 1:
        p.error("--max-width has to be at least 1")
    a.output = a.output or f"{a.run_dir.rstrip('/')}/viewer.html"
    return a


def main(argv: list[str] | None = None) -> int:
    """Exit code 1 if the run has no page."""
    a = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("pagelake-viewer").getOrCreate()
    numbers = build(spark, a.run_dir, a.output, a.title, not a.no_embed, a.max_width)
    print(a.output, numbers)
    return int(not numbers["n_pages"])


if __name__ == "__main__":
    sys.exit(main())
