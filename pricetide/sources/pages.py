"""Product pages to raw observations: one row in, at most one row out, no shuffle."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.functions.markup import (
    by_node,
    clean_texts,
    find_element,
    first_match,
    let,
    plain,
    text_node_with,
    visible,
)
from pricetide.schema import PAGES, RAW

# Shop tags, page classes, stock texts and formats of the two shops.
SHOP_A_WEBSITE = "Flipkart"
SHOP_A_SOLD_OUT = ("div", "VkYRUs")
SHOP_A_NAME = ("span", "LMizgS")
SHOP_A_BRAND = ("span", "qbKhdn")
SHOP_A_PRICE = ("div", "hZ3P6w", "bnqy13")
SHOP_A_LIST_PRICE = ("div", "kRYCnD", "yHYOcc")
SHOP_A_SOLD_OUT_TEXT = "Sold Out"
SHOP_B_WEBSITE = "ajio"
SHOP_B_NAME = ("h1", "prod-name")
SHOP_B_BRAND = ("h2", "brand-name")
SHOP_B_PRICE_BLOCK = ("div", "prod-price-sec")
SHOP_B_PRICE_BLOCK_ELSE = ("div", "prod-price")
SHOP_B_PRICE = ("div", "prod-sp")
SHOP_B_LIST_PRICE = ("span", "prod-cp")
SHOP_B_LIST_PRICE_ELSE = ("span", "prod-mrp")
SHOP_B_BAG_BUTTON = ("div", "pdp-addtocart-button")
SHOP_B_SOLD_OUT_TEXT = "out of stock|sold out"
RUPEE = "₹"
RUPEE_ESCAPED = "&#0*8377(?![0-9]);?|&#[xX]0*20[bB]9(?![0-9a-fA-F]);?"
RUPEE_AMOUNT = r"₹\s?[\d,]+"
IN_STOCK = "In Stock"
OUT_OF_STOCK = "Out of Stock"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class FieldRule:
    """Where a field stands: a tag and class tokens; ``otherwise`` is asked if it is absent."""

    tag: str
    classes: tuple[str, ...] = ()
    join_nodes: bool = True
    otherwise: "FieldRule | None" = None

    def text(self, html: Column) -> Column:
        element = find_element(html, self.tag, *self.classes)
        found = by_node(element) if self.join_nodes else plain(element)
        return found if self.otherwise is None else F.coalesce(found, self.otherwise.text(html))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def extract_fields(pages: DataFrame, rules: dict[str, FieldRule]) -> DataFrame:
    """Add one text column per rule to pages with an ``html`` column."""

    def fields(html: Column) -> Column:
        texts = clean_texts(*[rule.text(html) for rule in rules.values()])
        return let(texts, lambda t: F.struct(*[t[i].alias(n) for i, n in enumerate(rules)]))

    return pages.select("*", F.inline(F.array(let(visible(F.col("html")), fields))))


def _rows_of(row: Column) -> Column:
    """The page's row, or none where ``row`` is NULL.

    As a generator it is evaluated once per page: no later filter or projection can move
    into it and repeat the searches.
    """
    return F.inline(F.array_compact(F.array(row)))


def _with_rupees(html: Column) -> Column:
    """The page with its escaped rupee signs written out."""
    escaped = html.contains("&#")
    return F.when(escaped, F.regexp_replace(html, RUPEE_ESCAPED, RUPEE)).otherwise(html)


def _fetched_at() -> Column:
    return F.date_format("fetched_at", TIMESTAMP_FORMAT)


def _observation(**columns: Column) -> Column:
    columns |= {"timestamp": _fetched_at(), "url": F.col("url")}
    return F.struct(*[columns[name].alias(name) for name in RAW.names])


def extract_shop_a(pages: DataFrame) -> DataFrame:
    """Observations of shop A.

    A sold-out page keeps name and brand without prices. Any other page needs a price, a
    name and a brand to yield a row. Without a price element the first text with a rupee
    sign is the price.
    """

    def row(html: Column) -> Column:
        texts = clean_texts(
            plain(find_element(html, *SHOP_A_SOLD_OUT)),
            plain(find_element(html, *SHOP_A_NAME)),
            plain(find_element(html, *SHOP_A_BRAND)),
            by_node(find_element(html, *SHOP_A_PRICE)),
            by_node(find_element(html, *SHOP_A_LIST_PRICE)),
        )
        return let(texts, lambda t: observed(t[0], t[1], t[2], t[3], t[4]))

    def price_in_text(page: Column) -> Column:
        found = F.coalesce(
            text_node_with(page, RUPEE), first_match(plain(visible(page)), RUPEE_AMOUNT)
        )
        return F.when(page.contains(RUPEE), clean_texts(found)[0])

    def observed(
        notice: Column, name: Column, brand: Column, price: Column, mrp: Column
    ) -> Column:
        sold_out = F.coalesce(notice.contains(SHOP_A_SOLD_OUT_TEXT), F.lit(False))
        amount = F.coalesce(price, let(_with_rupees(F.col("html")), price_in_text))

        def seen(amount: Column) -> Column:
            complete = sold_out | (amount.isNotNull() & brand.isNotNull())
            return F.when(
                name.isNotNull() & complete,
                _observation(
                    product_name=name,
                    brand=brand,
                    selling_price=amount,
                    mrp=F.when(~sold_out, mrp),
                    status=F.when(sold_out, OUT_OF_STOCK).otherwise(IN_STOCK),
                    website=F.lit(SHOP_A_WEBSITE),
                ),
            )

        return let(F.when(~sold_out, amount), seen)

    return pages.select(_rows_of(let(visible(F.col("html")), row)))


def extract_shop_b(pages: DataFrame) -> DataFrame:
    """Observations of shop B, one per page.

    A page that did not load (no HTML, or no product name in it) leaves a row with only
    its URL. Prices are kept when out of stock. With only one of the two price places on
    the page, that one serves as price and list price.
    """

    def row(html: Column) -> Column:
        block = F.coalesce(
            find_element(html, *SHOP_B_PRICE_BLOCK),
            find_element(html, *SHOP_B_PRICE_BLOCK_ELSE),
        )
        return let(block, lambda block: let(texts(html, block), lambda t: F.when(
            t[0].isNotNull(), observed(block.isNotNull(), t[0], t[1], t[2], t[3], t[4])
        )))

    def texts(html: Column, block: Column) -> Column:
        return clean_texts(
            by_node(find_element(html, *SHOP_B_NAME)),
            by_node(find_element(html, *SHOP_B_BRAND)),
            by_node(find_element(html, *SHOP_B_BAG_BUTTON)),
            by_node(find_element(html, *SHOP_B_PRICE)),
            by_node(
                F.coalesce(
                    find_element(block, *SHOP_B_LIST_PRICE),
                    find_element(block, *SHOP_B_LIST_PRICE_ELSE),
                )
            ),
        )

    def observed(
        has_block: Column, name: Column, brand: Column, button: Column, price: Column, mrp: Column
    ) -> Column:
        sold_out = button.isNull() | F.lower(button).rlike(SHOP_B_SOLD_OUT_TEXT)
        return _observation(
            product_name=name,
            brand=brand,
            selling_price=F.coalesce(price, mrp),
            mrp=F.when(has_block, mrp).otherwise(price),
            status=F.when(sold_out, OUT_OF_STOCK).otherwise(IN_STOCK),
            website=F.lit(SHOP_B_WEBSITE),
        )

    only_url = F.struct(
        *[(F.col(n) if n == "url" else F.lit(None).cast("string")).alias(n) for n in RAW.names]
    )
    loaded = let(visible(F.col("html")), row)
    return pages.select(F.inline(F.array(F.coalesce(loaded, only_url))))
