"""The test tables read as price observations and as shop pages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.schema import RAW


def _rupees(amount: Column) -> Column:
    return F.concat(F.lit("₹"), F.format_number(amount, 0))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as RAW: a product page per user, two shops, prices as rupee text.

    Every 11th row lacks a price; every 5th lacks a list price, some others hold junk there.
    """
    price = F.floor(F.col("value") * 100) + 100
    list_price = price + (F.col("user_id") % 40) * 100
    columns = {
        "product_name": F.concat(F.lit("item-"), F.col("user_id") % 50),
        "selling_price": F.when(F.col("event_id") % 11 != 0, _rupees(price)),
        "status": F.when(F.col("event_type") == "error", "Out of Stock").otherwise("In Stock"),
        "mrp": F.when(F.col("event_id") % 5 == 0, F.lit(None))
        .when(F.col("event_id") % 7 == 0, "MRP ₹500")
        .otherwise(_rupees(list_price)),
        "brand": F.concat(F.lit("Brand#"), F.col("user_id") % 10),
        "website": F.when(F.col("event_id") % 2 == 0, "shop-a").otherwise("shop-b"),
        "timestamp": F.col("ts").cast("string"),
        "url": F.concat(F.lit("https://shop/p/"), F.col("user_id")),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(*[columns[name].alias(name) for name in RAW.names])


def _part_pages(spark: SparkSession, sf_dir: str, site: str, markup: Column) -> DataFrame:
    fetched = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(
        secs=F.col("p_partkey").cast("decimal(18,6)")
    )
    price = F.floor("p_retailprice")
    # rows of a few bytes become pages here, so a task would get all pages of a row group of up to a million parts
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        spark.read.parquet(f"{sf_dir}/part.parquet")
        .select("p_partkey", "p_name", "p_brand", "p_retailprice")
        .repartition(tasks)
        .withColumns(
            {
                "price": _rupees(price),
                "list": _rupees(price + 500),
                # behind an escaped sign without semicolon
                "amount": F.concat(F.lit(" "), F.format_number(price + 500, 0)),
            }
        )
        .select(
            F.concat(F.lit(f"https://{site}/p/"), F.col("p_partkey")).alias("url"),
            markup.alias("html"),
            fetched.alias("fetched_at"),
        )
    )


def _page(*body: str) -> Column:
    """A page from text in which {name} stands for the column ``name``."""
    head = "<html><head><title>{p_name}</title><style>div{margin:0}</style></head><body>"
    text = head + "".join(body) + "<footer>&copy; shop</footer></body></html>"
    pieces = []
    for part in text.replace("}", "{").split("{"):
        known = ("p_name", "p_brand", "price", "list", "amount")
        pieces.append(F.col(part) if part in known else F.lit(part))
    return F.concat(*pieces)


def shop_a_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per ``part``, in eight layouts of shop A."""
    name = '<span class="x LMizgS"> {p_name} &amp; <b>co</b>&nbsp;</span>'
    brand = "<span data-k='1' class='qbKhdn'>{p_brand}</span>"
    sold_out = '<div class="VkYRUs"><span>Sold Out</span></div>'
    split_notice = '<div data-x="a>b" class="VkYRUs">Sold <b>Out</b></div>'
    old_price = '<!-- <div class="hZ3P6w">₹1</div> -->'
    by_class = '<div class="hZ3P6w c1">{price}</div><div class="kRYCnD">{list}</div>'
    nested = (
        '<div class="bnqy13"><div>₹</div><div><i> </i></div></div>'
        '<div class="c2 yHYOcc"><span>{list}</span></div>'
    )
    by_attribute = '<div data-x="a>b" class="hZ3P6w">{price}</div><div class="kRYCnD">&#0008377{amount}</div>'
    layout = F.col("p_partkey") % 8
    return _part_pages(
        spark,
        sf_dir,
        "shop-a",
        F.when(layout == 0, _page(sold_out, name, brand, by_class))
        .when(layout == 1, _page(name, brand, old_price, by_class))
        .when(layout == 2, _page(brand, nested, name))
        .when(layout == 3, _page(name, brand, "<p>\n {price}&nbsp;</p>"))
        .when(layout == 4, _page(name, by_class))
        .when(layout == 5, _page(sold_out, brand, by_class))
        .when(layout == 6, _page(split_notice, name, brand, by_class))
        .otherwise(_page(name, brand, "<p>₹1</p>", by_attribute)),
    )


def shop_b_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per ``part``, in seven layouts of shop B."""
    name = '<h1 class="prod-name">{p_name} &#38; co</h1><h2 class="brand-name">{p_brand}</h2>'
    button = '<div class="pdp-addtocart-button"><div>ADD TO BAG</div></div>'
    gone = '<div class="pdp-addtocart-button"><span>Sold Out</span></div>'
    sp = '<div class="prod-sp">{price}</div>'
    block = '<div class="prod-price-sec"><div>MRP</div><span class="prod-cp">{list}</span></div>'
    plain = '<div class="prod-price"><span class="prod-mrp">{list}</span></div>'
    empty = '<div class="prod-price-sec"><div>MRP</div></div><span class="prod-cp">{list}</span>'
    layout = F.col("p_partkey") % 7
    return _part_pages(
        spark,
        sf_dir,
        "shop-b",
        F.when(layout == 0, _page(name, sp, block, button))
        .when(layout == 1, _page(name, button, empty, sp))
        .when(layout == 2, _page(name, plain, button))
        .when(layout == 3, _page(name, sp, button))
        .when(layout == 4, _page(name, sp, block))
        .when(layout == 5, _page(name, plain, gone, sp)),
    )
