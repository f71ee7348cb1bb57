import datetime

import pytest

from pricetide.schema import PAGES, RAW
from pricetide.sources.observations import shop_a_pages, shop_b_pages
from pricetide.sources.pages import (
    FieldRule,
    extract_fields,
    extract_shop_a,
    extract_shop_b,
    read_pages,
)

FETCHED = datetime.datetime(2025, 1, 1, 10, 0, 5)
NAME_A = '<span class="LMizgS">Nike C1TY</span>'
BRAND_A = '<span class="qbKhdn">NIKE</span>'
NAME_B = '<h1 class="prod-name">Nike C1TY</h1><h2 class="brand-name">NIKE</h2>'
BAG = '<div class="pdp-addtocart-button">Add to Bag</div>'


@pytest.fixture
def pages(spark):
    def make(*htmls):
        rows = [(f"u{n}", html, FETCHED) for n, html in enumerate(htmls)]
        return spark.createDataFrame(rows, PAGES)

    return make


def prices(df):
    assert df.columns == RAW.names
    return [(r.status, r.mrp, r.selling_price) for r in df.collect()]


def test_shop_a_in_stock(pages):
    html = f'<div class="hZ3P6w">₹3,522</div><div class="kRYCnD">₹4,295</div>{NAME_A}{BRAND_A}'
    (row,) = extract_shop_a(pages(html)).collect()
    assert row.asDict() == {
        "product_name": "Nike C1TY",
        "selling_price": "₹3,522",
        "status": "In Stock",
        "mrp": "₹4,295",
        "brand": "NIKE",
        "website": "Flipkart",
        "timestamp": "2025-01-01 10:00:05",
        "url": "u0",
    }


def test_shop_a_sold_out(pages):
    notice = '<div class="VkYRUs">Sold Out</div><div class="hZ3P6w">₹1</div>'
    result = extract_shop_a(pages(notice + NAME_A + BRAND_A, notice + NAME_A, notice + BRAND_A))
    assert prices(result) == [("Out of Stock", None, None)] * 2
    assert [r.brand for r in result.collect()] == ["NIKE", None]


@pytest.mark.parametrize(
    ("price", "text"),
    [
        ('<div class="bnqy13">₹5</div><div class="hZ3P6w">₹6</div>', "₹5"),
        ("<p>now ₹3,522 </p><p>₹9</p>", "now ₹3,522"),
        ("<p>&#8377;3,522</p>", "₹3,522"),
        ("<p>&#x20B9;3,522</p>", "₹3,522"),
        ('<div class="hZ3P6w"></div><p>₹9</p>', ""),
        ('<div class="hZ3P6w"> <b> ₹ </b> 7&nbsp;</div>', "₹7"),
        ('<div class="hZ3P6w-new">₹1</div><div class="x hZ3P6w y">₹2</div>', "₹2"),
        ("<div class='hZ3P6w'>₹2</div>", "₹2"),
        ("<div class=hZ3P6w>₹2</div>", "₹2"),
        ('<DIV id="p" CLASS="hZ3P6w" data-x="1">₹2</DIV>', "₹2"),
        ('<span class="hZ3P6w">a</span><div class="hZ3P6w">₹2</div>', "₹2"),
        ('<!-- <div class="hZ3P6w">₹1</div> --><div class="hZ3P6w">₹2</div>', "₹2"),
        ('<script>"<div class=\\"hZ3P6w\\">₹1</div>"</script><div class="hZ3P6w">₹2</div>', "₹2"),
        ('<div class="hZ3P6w">₹<div>2<div>,</div></div>0</div>1', "₹2,0"),
        ('<div class="hZ3P6w">₹2', "₹2NIKE"),
    ],
)
def test_shop_a_price_places(pages, price, text):
    (row,) = extract_shop_a(pages(NAME_A + price + BRAND_A)).collect()
    assert row.selling_price == text


def test_shop_a_incomplete_pages_yield_no_row(pages):
    price = '<div class="hZ3P6w">₹3</div>'
    incomplete = [NAME_A + BRAND_A, NAME_A + price, BRAND_A + price, "", None]
    assert extract_shop_a(pages(*incomplete)).collect() == []


def test_shop_a_text_of_name_keeps_inner_spaces(pages):
    name = '<span class="LMizgS"> Nike <b>C1TY</b> &amp; &lt;co&gt; &amp;lt; <span>x</span>y </span>'
    (row,) = extract_shop_a(pages(name + BRAND_A + "<p>₹1</p>")).collect()
    assert row.product_name == "Nike C1TY & <co> &lt; xy"


def test_shop_b_price_places(pages):
    block = '<div class="prod-price-sec"><div>x</div><span class="prod-cp">₹8,695</span></div>'
    mrp_only = '<div class="prod-price"><span class="prod-mrp">₹8,000</span></div>'
    sp = '<div class="prod-sp">₹6,782</div>'
    inside = f'<div class="prod-price-sec">{sp}<span class="prod-cp">₹8,695</span></div>'
    outside = f'<div class="prod-price-sec"><div>x</div></div><span class="prod-cp">₹1</span>{sp}'
    both = '<div class="prod-price">no</div>' + block
    result = extract_shop_b(
        pages(
            *[
                NAME_B + BAG + body
                for body in (block + sp, block, mrp_only, sp, inside, outside, both, "")
            ]
        )
    )
    assert prices(result) == [
        ("In Stock", "₹8,695", "₹6,782"),
        ("In Stock", "₹8,695", "₹8,695"),
        ("In Stock", "₹8,000", "₹8,000"),
        ("In Stock", "₹6,782", "₹6,782"),
        ("In Stock", "₹8,695", "₹6,782"),
        ("In Stock", None, "₹6,782"),
        ("In Stock", "₹8,695", "₹8,695"),
        ("In Stock", None, None),
    ]


def test_shop_b_availability_keeps_prices(pages):
    sp = '<div class="prod-sp">₹6,782</div>'
    buttons = [
        "",
        '<div class="pdp-addtocart-button"><b>SOLD OUT</b></div>',
        '<div class="pdp-addtocart-button">Currently out of stock</div>',
    ]
    result = extract_shop_b(pages(*[NAME_B + sp + button for button in buttons]))
    assert prices(result) == [("Out of Stock", "₹6,782", "₹6,782")] * 3


def test_shop_b_failed_pages_leave_their_url(pages):
    result = extract_shop_b(pages(None, "<h1>Access denied</h1>"))
    nothing = dict.fromkeys(RAW.names)
    assert [r.asDict() for r in result.collect()] == [nothing | {"url": u} for u in ("u0", "u1")]


def test_character_references(pages):
    html = "<h1>&#65;&#x42;&#x1F600; &rsquo;&euro; &#0; &#55296; &amp;#65; &unknown; &#65;</h1>"
    (row,) = extract_fields(pages(html), {"h": FieldRule("h1", join_nodes=False)}).collect()
    assert row.h == "AB😀 ’€ � � &#65; &unknown; A"


def test_rules_with_fallback(pages):
    rule = FieldRule("span", ("new",), otherwise=FieldRule("b"))
    df = pages('<b>old</b><span class="new">fresh</span>', "<b>old</b>", "<i>none</i>", None)
    result = extract_fields(df, {"x": rule, "i": FieldRule("i")})
    assert result.columns == [*PAGES.names, "x", "i"]
    assert [(r.x, r.i) for r in result.collect()] == [
        ("fresh", None),
        ("old", None),
        (None, "none"),
        (None, None),
    ]


def test_long_pages_do_not_exhaust_the_stack(pages):
    filler = "<div>" * 3000 + "text " * 100_000 + "</div>" * 3000
    html = f'<div class="x">{filler}</div><div class="hZ3P6w">{filler}₹4</div>{NAME_A}{BRAND_A}'
    (row,) = extract_shop_a(pages(html)).collect()
    assert row.selling_price.endswith("₹4")
    assert row.brand == "NIKE"


def test_extraction_needs_no_shuffle_no_python_and_one_pass(pages):
    """A filter on the result stays above the generator and repeats none of its searches."""
    for extract in (extract_shop_a, extract_shop_b):
        priced = extract(pages(NAME_B)).filter("selling_price IS NOT NULL")
        plan = priced._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Filter") < plan.index("Generate")
        assert plan.count("Filter ") == 1
        assert "Exchange" not in plan
        assert "Python" not in plan


def test_read_pages(spark, pages, tmp_path):
    pages("<p>").write.parquet(str(tmp_path / "p"))
    assert read_pages(spark, str(tmp_path / "p")).collect() == pages("<p>").collect()


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("&rarr;&ntilde;&#146;", "→ñ’"),
        ("&#00000065;&#x00041", "AA"),
        ("a &amp b &copy2 &notit;", "a & b ©2 ¬it;"),
        ("&amp;lt; &lt;", "&lt; <"),
        ("&#99999999999999999999; &#x110000; &bogus; & &;", "� � &bogus; & &;"),
    ],
)
def test_character_references(spark, markup, text):
    df = spark.createDataFrame([(f"<h1>{markup}</h1>",)], "html string")
    assert extract_fields(df, {"h": FieldRule("h1", join_nodes=False)}).first().h == text


@pytest.mark.parametrize(
    ("start", "found"),
    [
        ('<div data-x="a>b" class="c">', "₹5"),
        ("<div a='>' b=x/y class=c d='>'>", "₹5"),
        ("<div hidden class = 'x c y'>", "₹5"),
        ('<div data-x="class=c">', None),
        ('<div data-class="c">', None),
        ("<div title=it's class=\"c\">", "₹5"),
    ],
)
def test_start_tags(spark, start, found):
    df = spark.createDataFrame([(f"<p>₹1</p>{start}₹<i t='>'>5</i></div>",)], "html string")
    assert extract_fields(df, {"p": FieldRule("div", ("c",))}).first().p == found


def test_long_tags_do_not_exhaust_the_stack(spark):
    many = " ".join(f'data-{n}="{n}>"' for n in range(500))
    html = f"<div {many} style='{'x' * 500_000}' class='c'>₹5</div>"
    df = spark.createDataFrame([(html,)], "html string")
    assert extract_fields(df, {"p": FieldRule("div", ("c",))}).first().p == "₹5"


def test_pages_of_one_row_group_are_dealt_to_all_tasks(spark, tmp_path):
    columns = "p_partkey long, p_name string, p_brand string, p_retailprice double"
    parts = [*((i, f"part {i}", "Brand#1", 900.0 + i) for i in range(400)), (7, "part 7", "Brand#1", 907.0), (None, None, None, None)]
    spark.createDataFrame(parts, columns).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for made in (shop_a_pages(spark, str(tmp_path)), shop_b_pages(spark, str(tmp_path))):
        sizes = made.rdd.glom().map(len).collect()
        assert sum(sizes) == len(parts) and len(sizes) == 4 and min(sizes) > 50
