"""Edge semantics with literals."""

import json

import pytest
from pyspark.sql import functions as F

from pagelake.config import RunConfig, parse_args
from pagelake.functions import regions as R
from pagelake.functions import render
from pagelake.functions import text as T
from pagelake.operators import detection, markdown, model, viewer


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first().r


BOXES = [
    ('{"x":395,"y":55,"x1":526}', None),
    ('{"x":1,"y":2,"x1":5,"y1":9}', (1, 2, 4, 7)),
    ('{"x1":1,"y1":2,"x2":5,"y2":9}', (1, 2, 4, 7)),
    ('{"x":"abc","left":3,"y":0,"width":5,"height":5}', None),
    ('{"x":0,"y":0,"width":-5,"height":0}', (0, 0, -5, 0)),
    ("[10,20,5,30]", None),
    ("[10,20,50,60]", (20, 10, 40, 40)),
    ("[10,20,50]", None),
    ('{"left":"1.5","top":2,"w":3,"h":4}', (1.5, 2, 3, 4)),
    ("7", None),
    ("null", None),
]


@pytest.mark.parametrize("box,expected", BOXES)
def test_boxes(spark, box, expected):
    got = one(spark, box, lambda v: R.normal_box(F.parse_json(v)))
    assert (got and tuple(got)) == expected


def test_pixel_box_minimum_and_edge(spark):
    lit = lambda x: F.lit(float(x))
    box = spark.range(1).select(R.pixel_box(lit(1000), lit(0), lit(-5), lit(0), F.lit(100), F.lit(1000)).alias("b")).first().b
    assert tuple(box) == (99, 0, 1, 16)


@pytest.mark.parametrize(
    "raw,expected",
    [("", "TitleRegion"), ("region", "TitleRegion"), (None, "TableRegion"), ("my table", "ParagraphRegion"), ("TABLE", "TableRegion"), ("xGraphRegiony", "GraphRegion")],
)
def test_types(spark, raw, expected):
    assert one(spark, raw, R.normal_type) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ('```json\n{"a":1}\n```', '{"a":1}'),
        ('so: {"a":{"b":2}} ok', '{"a":{"b":2}}'),
        ('[{"a":1},{"b":2}]', '{"a":1},{"b":2}'),
        ('{"a":1} x {"b":2}', '{"a":1} x {"b":2}'),
        ("} {", "} {"),
        ("no json", "no json"),
        ('} then {"a":1} end', '{"a":1}'),
        ("", ""),
    ],
)
def test_clean_json(spark, text, expected):
    assert one(spark, text, T.clean_json) == expected


def test_cap_comes_first_and_ties_keep_position(spark):
    rows = [("p", i, "TableRegion", None if i in (1, 2) else (1.0, 1.0, 100.0, 100.0), 5, 1000, 1000) for i in range(14)]
    raw = spark.createDataFrame(rows, "page_id string, pos int, type string, box struct<x:double,y:double,width:double,height:double>, reading_order int, img_w int, img_h int")
    got = detection.detect(raw).orderBy("reading_order").collect()
    assert [r.pos for r in got] == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert [r.id for r in got][:2] == ["r01", "r02"] and got[-1].reading_order == 10


def test_bad_reading_order_fails_the_page(spark):
    text = json.dumps({"regions": [{"type": "Title", "bbox": [1, 2, 30, 40], "reading_order": None}, {"bbox": [1, 2, 30, 40]}]})
    parsed = detection.parse_answers(spark.createDataFrame([("p", text)], "page_id string, response string"))
    rows = detection.fields(detection.unnest_regions(parsed, ["page_id"]), ["page_id"]).orderBy("pos").collect()
    assert [(r.fails, r.reading_order) for r in rows] == [(True, None), (False, 2)]
    bad = detection.parse_answers(spark.createDataFrame([("p", '{"regions": null}'), ("q", "{}"), ("r", "x")], "page_id string, response string"))
    assert {r.page_id for r in detection.page_errors(bad, ["page_id"]).collect()} == {"p", "r"}


def test_blocks(spark):
    rows = [
        ("TitleRegion", " "), ("TableRegion", "<TABLE>x"), ("TableRegion", "```html\n<table>\n```"), ("GraphRegion", "g"),
        ("MarginaliaRegion", "a\nb"), ("FootnoteRegion", "a\nb"), ("FootnoteRegion", "a"), ("PageNumberRegion", "4"), ("ParagraphRegion", "\tp\n"),
    ]
    df = spark.createDataFrame([(t, x, None, None, None, None, None) for t, x in rows], "type string, text string, rows int, cols int, header_rows int, has_red_ink boolean, graph_type string")
    head = "<!-- TableRegion: ? rows × ? cols, ? header row(s), red ink: no -->\n"
    assert [r.b for r in df.select(markdown.block().alias("b")).collect()] == [
        None, head + "```html\n<TABLE>x\n```", head + "```html\n<table>\n```", "<!-- GraphRegion: unknown -->\ng",
        "> *[Marginalie]*\n> a\n> b", "[^fn]: a\n    b", "[^fn]: a", None, "p",
    ]


def test_full_page(spark):
    df = spark.createDataFrame([("a", "map", " \n"), ("b", "table", "x\n Page: 12 \ny")], "page_id string, doc_type string, text string")
    a, b = [r.md for r in markdown.full_page_documents(df).orderBy("page_id").collect()]
    assert a.endswith("---\n" + T.EMPTY_BODY + "\n") and "page_number: 12\n---\nx" in b


def test_front_matter(spark):
    md = "---\na: 1\nb: 'x: y'\na: \"2\"\nnothing\n---\nbody"
    got = one(spark, md, lambda v: F.struct(T.front_matter(v).alias("m"), T.body_of(v).alias("b")))
    assert got.m == {"a": "2", "b": "x: y"} and got.b == "body"
    assert one(spark, "---\n---\nx", T.front_matter) == {}


def test_fences_and_tables(spark):
    assert one(spark, "a\n```html\n<table><tr>\n```\nb", T.unwrap_fences) == "a\n<table><tr>\n</table>\nb"
    assert one(spark, "prose line\n| a | b |\n|---|---|\n| 1 | 2 |", T.blank_before_tables) == "prose line\n\n| a | b |\n|---|---|\n| 1 | 2 |"
    assert one(spark, "x\n```html\n<table>\n\n> note", T.close_fence) == "x\n```html\n<table>\n```\n\n> note"
    assert one(spark, "```\na", T.close_fence) == "```\na\n```\n"
    assert one(spark, "```html\n<p>\n\nmore\n\n## h\n\n- x", T.close_fence) == "```html\n<p>\n\nmore\n```\n\n## h\n\n- x"
    assert one(spark, "```html\nx\n```\n```\n\n> q", T.close_fence) == "```html\nx\n```\n```\n\n> q\n```\n"
    assert one(spark, "- item\n| a |\n|---|", T.blank_before_tables) == "- item\n| a |\n|---|"
    assert one(spark, "```html\nnever ended", T.unwrap_fences) == "```html\nnever ended"
    assert one(spark, "a<table>1</table>b<table x>2</table><table>", T.wrap_tables) == 'a<div class="table-wrap"><table>1</table></div>b<div class="table-wrap"><table x>2</table></div><table>'
    assert one(spark, "```html\na\n```", T.close_fence) == "```html\na\n```"


def test_render(spark):
    html = one(spark, "# T\n\nsome *text*\n| a | b |\n|---|---|\n| 1 | 2 |\n\n> q\n\n- x\n- y", render.rendered)
    assert "<h1>T</h1>" in html and '<div class="table-wrap"><table>' in html and "<em>text</em>" in html
    assert "<blockquote>" in html and html.count("<li>") == 2


def test_natural_order(spark):
    names = ["scan_10", "Scan_2", "scan_2b", "a-x", "a", "7"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(T.natural_key(F.col("n"))).collect()] == ["7", "a", "a-x", "Scan_2", "scan_2b", "scan_10"]
    assert [r.n for r in df.where("n like 'a%'").orderBy(T.natural_key(F.concat("n", F.lit(".md")))).collect()] == ["a-x", "a"]


def test_retries():
    def script(*answers):
        left = list(answers)

        def ask(prompt, level, resolution):
            x = left.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        return ask

    waits = []
    go = lambda policy, *a, parse=None: model.call(script(*a), policy, "p", parse, waits.append)
    t = model.Policy("transcribe", "high", "high", 2)
    r = go(t, "", "", " x ")
    assert r["text"] == "x" and r["attempts"] == [("empty", "high", "high"), ("empty", "medium", "high"), ("success", "low", "ultra_high")]
    r = go(t, OSError("a"), OSError("b"), OSError("c"))
    assert r["status"] == "error" and r["error"] == "c" and waits == [1.5, 3.0] and r["attempts"][-1] == ("exception", "high", "high")
    assert go(t, "  ")["status"] == "success"
    d = model.Policy("detect", "high", "high", 3)
    assert len(go(d, OSError("a"), "x")["attempts"]) == 1
    assert [a[1] for a in go(d, "x", "", "{}", parse=json.loads)["attempts"]] == ["high", "high", "medium"]
    assert model.next_level("detect", "minimal") == "medium" and model.next_level("transcribe", "minimal") == "minimal"


def test_null_page_number(spark):
    df = spark.createDataFrame([("PageNumberRegion", None, ["page_number"]), ("PageNumberRegion", None, []), ("PageNumberRegion", "0", ["page_number"])], "type string, page_number string, present array<string>")
    assert [r.text for r in model.route_regions(df)[0].collect()] == ["None", "", "0"]


def test_config():
    with pytest.raises(ValueError):
        RunConfig(doc_type="poem")
    c = parse_args(["-i", "a", "-o", "b", "--double-page", "--no-sharpen", "--doc-type", "map"])
    assert not c.single_page and not c.sharpen and c.enhance_contrast and not c.uses_region_detection


def test_malformed_region_files(spark):
    docs = [("a", "{"), ("b", '{"x":1}'), ("c", '[1, {"type":"T","bbox":{"x":"1","y":2,"width":3,"height":4}}, {"bbox":[1]}, {"type":"FullPage","bbox":{"x":1,"y":1,"width":1,"height":1}}]'), ("d", None)]
    got = viewer.region_boxes(spark.createDataFrame(docs, "stem string, json string")).collect()
    assert [(r.stem, r.region_type, r.x, r.height) for r in got] == [("c", "T", 1, 4)]


def test_search(spark):
    pages = spark.createDataFrame([("Scan_1", "7", "scan_1"), ("b", "", "B")], "page_id string, page_number string, stem string")
    assert [r.page_id for r in viewer.search(pages, " SCAN ").collect()] == ["Scan_1"] and viewer.search(pages, "").count() == 2


def test_blocks_and_tables_at_the_edges(spark):
    """Lines that only look like Markdown leave a fenced table whole; short prose and lone bars are no table's frame."""
    table = "```html\n<table>\n<tr><td>1</td></tr>\n\n{}\n</table>"
    for plain in ("3.5 ha", "1.a", "#tag", "-5", "*bold*", "####### seven", "--", "5"):
        assert one(spark, table.format(plain), T.close_fence) == table.format(plain) + "\n```\n"
    for block in ("3. ha", "12.\tx", "# h", "###### six", "- x", "* x", "> x", ">x", "---", "----"):
        assert one(spark, table.format(block), T.close_fence) == "```html\n<table>\n<tr><td>1</td></tr>\n```\n\n" + block + "\n</table>"
    assert one(spark, "```html\nx\n\n1.\ny", T.close_fence) == "```html\nx\n```\n\n1.\ny"  # a line feed is white space
    assert one(spark, "```html\nx\n\n1.", T.close_fence) == "```html\nx\n\n1.\n```\n"
    rest = "\n| a | b |\n|---|---|\n| 1 | 2 |"
    for prose in ("prose", "ab", " a", "7 ha", "é ü"):
        assert one(spark, prose + rest, T.blank_before_tables) == prose + "\n" + rest
    for other in ("a", "a ", "", "  ", "- item", "* x", "> q", "# h", "3. x", "3.5 ha", "| x"):
        assert one(spark, other + rest, T.blank_before_tables) == other + rest
    for no_table in ("prose\n|\n|---|", "prose\n| a\n|---|", "prose\n| a |\n| b |", "prose\n| a |\n||", "prose\n| a |\n|--"):
        assert one(spark, no_table, T.blank_before_tables) == no_table
    assert one(spark, "prose\n||\n|:-|x", T.blank_before_tables) == "prose\n\n||\n|:-|x"


def test_fences_of_many_lines(spark):
    assert one(spark, "a\n```html\n```\nb\n```html \n<table>\n```rest\n```json\nx\n```\nz", T.unwrap_fences) == "a\n\nb\n<table>\n</table>\nrest\n```json\nx\n```\nz"
    body = "\n".join(f"<tr><td>{i}</td></tr>" for i in range(50_000))
    assert one(spark, f"```html\n<table>\n{body}\n```\nend\n```html\nopen", T.unwrap_fences) == f"<table>\n{body}\n</table>\nend\n```html\nopen"
    many = "```html\n<p>\n```\n" * 5000
    assert one(spark, many, T.unwrap_fences) == "<p>\n" * 5000


def test_both_forms_of_the_json_rule_agree(spark):
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choice(["{", "}", "{", "}", "a", " ", "\n", "```", "json", '"', "\xa0"]) for _ in range(rng.randrange(0, 14))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.clean_json(F.col("t")).alias("j")).collect()
    assert [(r.t, r.j) for r in rows if r.j != T.object_text(r.t)] == []
