"""Repeated and nearly repeated lines: a segment-partition edit join in DataFrame functions.

Of two lines within k edits, cut one into k + 1 segments: at least one segment stands
unchanged in the other, near its own place. So every line indexes its segments by (length,
segment number, text) and probes with those of its substrings that a line up to k shorter could have as a
segment there (4 keys a line for k = 1, 15 for k = 2). Lines that meet under a key are candidates,
which a banded bit-parallel edit distance verifies.

Under a key, lines are compared by their lengths and packed letter counts; only pairs that pass leave
the join. A key under which very many lines meet (a common beginning) is not paired out. What is left of
its lines without the shared segment must still be within k edits, so the join is repeated
on these rests inside the key, until fewer lines meet or at most 2k characters are left. For k = 2 a line
with one change of its own keeps two of three segments, so every repetition doubles its rests: comparing
a few hundred lines costs less.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.components import components, thin_out
from pricetide.sources.paths import StageScope, stage

MAX_EDITS = 1
# Lines of so many characters or more are compared with so many edits.
LONG_CHARS, LONG_EDITS = 200, 2
# White space of Unicode: lines of nothing else are blank.
WHITE = "".join(filter(str.isspace, map(chr, range(0x3001))))
# Characters whose counts are compared before the distance is computed.
COUNTED = "0123456789abcdefghijklmnopqrstuvwxyz"
# Shorter lines are compared for equality alone.
MIN_CHARS = 20
# Letters whose counts, a byte each, are packed into numbers and compared inside the join.
PACKED = ("aq", "bt0", "cs1", "dy2", "e3", "f4l", "gu5", "hj6", "i7k", "m8o", "n9v", "pr", "w", "x", "z", " ")
# Up to so many lines under one key are compared with each other; beyond, the key is refined.
CROWDED = 512


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Let Spark generate no Java method that the JVM finds too large to compile.

    Key arrays and distances are long expressions; in one method over 8,000 bytes of bytecode they would be interpreted.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _segments(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the other line is, segment number, shift) of a line's own segments, then of its probes.

    The probes are chosen by the multi-match rule: of the shared segments of a similar pair
    one has at most i - 1 edits before it and k + 1 - i after it. A probe for the own
    length that stands at its own segment equals it and is left out.
    """
    own, probes = [], []
    for shorter in range(edits + 1):
        for i in range(1, edits + 2):
            low = max(-(i - 1), shorter - (edits + 1 - i))
            high = min(i - 1, shorter + (edits + 1 - i))
            for shift in range(low, high + 1):
                chosen = own if shorter == shift == 0 else probes
                chosen.append((shorter, i, shift))
    return own + probes


def _bounds(chars: str, edits: int, shorter: int, i: int) -> tuple[str, str]:
    """SQL of the start and size of a segment of a line so much shorter than ``chars``."""
    # the last ``longer`` segments have one character more
    base, longer = f"({chars} - {shorter}) div {edits + 1}", f"({chars} - {shorter}) % {edits + 1}"
    start = f"int(1 + {i - 1} * ({base}) + greatest(0, {longer} - {edits + 2 - i}))"
    return start, f"int(({base}) + if({longer} > {edits + 1 - i}, 1, 0))"


def segment_bounds(chars: str, edits: int) -> dict[str, Column]:
    """Columns that `segment_keys` needs; each is computed once for all keys that use it."""
    found = {}
    for shorter in range(edits + 1):
        for i in range(1, edits + 2):
            start, size = _bounds(chars, edits, shorter, i)
            found[f"_start_{edits}_{shorter}_{i}"] = F.expr(start)
            found[f"_size_{edits}_{shorter}_{i}"] = F.expr(size)
    return found


def segment_keys(text: str, chars: str, prefix: str, edits: int) -> Column:
    """Array of the keys of a text (given by column names, beside those of `segment_bounds`), those of its
    own segments first; null where a very short text has no room for a probe."""
    keys = []
    for shorter, i, shift in _segments(edits):
        start, size = f"(_start_{edits}_{shorter}_{i} + {shift})", f"_size_{edits}_{shorter}_{i}"
        keys.append(
            f"if({chars} >= {shorter} AND {start} >= 1 AND {start} + {size} <= {chars} + 1, "
            f"xxhash64({prefix}, {chars} - {shorter}, {i}, substring({text}, {start}, {size})), NULL)"
        )
    return F.expr(f"array({', '.join(keys)})")


def segment_place(at: str, chars: str, edits: int) -> tuple[Column, Column]:
    """Start and size of the key at a place of `segment_keys`."""
    places = [(*_bounds(chars, edits, shorter, i), shift) for shorter, i, shift in _segments(edits)]
    pick = lambda parts: F.expr(f"element_at(array({', '.join(parts)}), {at} + 1)")
    return pick([f"{start} + {shift}" for start, _, shift in places]), pick([size for _, size, _ in places])


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts of more than ``edits`` characters are within ``edits`` edits, ``a``
    being at least as long as ``b``.

    Bit vectors hold the vertical differences of the edit matrix in a band around its diagonal; one
    step per character of the shorter text moves the band down the diagonal, then along the last row.
    """
    characters = lambda text: F.split(text, "")
    return _let(
        characters(a), lambda x: _let(characters(b), lambda y: _banded(x, y, edits))
    )


def _banded(a: Column, b: Column, edits: int) -> Column:
    width = 2 * edits + 2
    mask = F.lit((1 << width) - 1).cast("long")
    size_a, size_b = F.size(a), F.size(b)

    def bit(value: Column, at: Column) -> Column:
        return F.call_function("shiftright", value, at.cast("int")).bitwiseAND(F.lit(1)).cast("int")

    def step(state: Column, j: Column) -> Column:
        equal = [
            F.when(F.get(a, j + (edits - width + k)) == F.get(b, j - 1), F.lit(1 << k))
            .otherwise(F.lit(0)).cast("long")
            for k in range(width)
        ]
        return F.struct(
            state["vp"].alias("vp"),
            state["vn"].alias("vn"),
            state["distance"].alias("distance"),
            reduce(lambda x, y: x.bitwiseOR(y), equal).alias("pm"),
            j.alias("j"),
        )

    def move(s: Column) -> Column:
        vp, vn, pm = s["vp"], s["vn"], s["pm"]
        d0 = (pm.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(mask)
        return F.struct(d0.alias("d0"), vp.alias("vp"), vn.alias("vn"), s["distance"].alias("distance"), s["j"].alias("j"))

    def across(s: Column) -> Column:
        hp = s["vn"].bitwiseOR(F.bitwise_not(s["d0"].bitwiseOR(s["vp"]))).bitwiseAND(mask)
        hn = s["d0"].bitwiseAND(s["vp"])
        return F.struct(hp.alias("hp"), hn.alias("hn"), s["d0"].alias("d0"), s["distance"].alias("distance"), s["j"].alias("j"))

    def settle(s: Column) -> Column:
        hp, hn, d0, j = s["hp"], s["hn"], s["d0"], s["j"]
        last = F.greatest(F.lit(0), size_a - j - edits + width - 1)
        down = 1 - bit(d0, F.lit(width - 1))
        right = bit(hp, last) - bit(hn, last)
        lower = F.call_function("shiftright", d0, F.lit(1))
        return F.struct(
            hn.bitwiseOR(F.bitwise_not(lower.bitwiseOR(hp))).bitwiseAND(mask).alias("vp"),
            lower.bitwiseAND(hp).alias("vn"),
            (s["distance"] + F.when(j <= size_a - edits, down).otherwise(right)).cast("int").alias("distance"),
        )

    start = F.struct(
        F.lit(((1 << width) - 1) ^ ((1 << (width - 1 - edits)) - 1)).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"),
        F.lit(edits).cast("int").alias("distance"),
    )
    end = F.aggregate(
        F.sequence(F.lit(1), size_b),
        start,
        # along the last row the distance falls at most ``edits`` times
        lambda s, j: F.when(s["distance"] > 2 * edits, s).otherwise(_let(_let(_let(step(s, j), move), across), settle)),
    )
    return (size_a - size_b <= edits) & (end["distance"] <= edits)


def like_counts(a: Column, b: Column, edits: int) -> Column:
    """Whether the counts of some characters allow ``edits`` edits: each edit changes at most
    two counts by one. No similar pair fails this."""
    without = lambda text, c: F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    apart = [
        F.abs(F.octet_length(a) - without(a, c) - F.octet_length(b) + without(b, c)) for c in COUNTED
    ]
    return reduce(add, apart) <= 2 * edits


def packed_counts(text: Column) -> list[Column]:
    """Counts of the letters of `PACKED` modulo 256, eight in a number, then the length in characters."""
    def count(letters: str) -> Column:
        return reduce(add, [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in letters])

    numbers = []
    for begin in range(0, len(PACKED), 8):
        parts = [
            F.call_function("shiftleft", (count(letters) % 256).cast("long"), F.lit(8 * k))
            for k, letters in enumerate(PACKED[begin : begin + 8])
        ]
        numbers.append(reduce(lambda x, y: x.bitwiseOR(y), parts))
    return [*numbers, F.char_length(text)]


def like_packed(a: list[Column], b: list[Column], edits: int) -> Column:
    """Whether two results of `packed_counts` allow ``edits`` edits; no similar pair fails this."""
    byte = lambda number, k: F.call_function("shiftrightunsigned", number, F.lit(8 * k)).bitwiseAND(F.lit(255)).cast("int")
    apart = []
    for x, y in zip(a[:-1], b[:-1]):
        for k in range(8):
            off = F.abs(byte(x, k) - byte(y, k))
            apart.append(F.least(off, 256 - off))
    return (F.abs(a[-1] - b[-1]) <= edits) & (reduce(add, apart) <= 2 * edits)


def _pairs(members: DataFrame, keys: DataFrame, counts: DataFrame, edits: int) -> DataFrame:
    """Pairs of lines that meet under the keys and have like ``counts``; two lines of one class (column component) are none."""
    packed = [c for c in counts.columns if c != "line"]
    few = members.join(keys, "key").join(counts, "line")
    side = lambda name: few.select(
        *(F.col(c).alias(f"{c}_{name}") for c in ("key", "own", "component", *packed)), F.col("line").alias(name)
    )
    of = lambda name: [F.col(f"{c}_{name}") for c in packed]
    return side("a").join(
        side("b"),
        (F.col("key_a") == F.col("key_b"))
        & (F.col("a") < F.col("b"))
        & (F.col("own_a") | F.col("own_b"))
        & (F.col("component_a") != F.col("component_b"))
        & like_packed(of("a"), of("b"), edits),
    ).select("a", "b")


def _placed(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members with their component among the links so far; an unlinked line is its own."""
    if labels is None:
        return members.withColumn("component", F.col("line"))
    known = members.join(labels, F.col("line") == F.col("node"), "left")
    return stage(known.withColumn("component", F.coalesce("component", "line")).drop("node"))


def _stars(placed: DataFrame) -> DataFrame:
    """Under each key, every line with the least one among those whose own segment it is, if that is of another component."""
    centres = (
        placed.filter("own")
        .groupBy("key")
        .agg(F.min(F.struct("line", "component")).alias("first"))
        .select("key", F.col("first.line").alias("centre"), F.col("first.component").alias("known"))
    )
    around = placed.join(centres, "key").filter("line <> centre AND component <> known")
    return around.select(F.least("line", "centre").alias("a"), F.greatest("line", "centre").alias("b")).distinct()


def _similar(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """The pairs of lines that are within ``edits`` edits."""
    left = texts.select(F.col("line").alias("a"), F.col("rest").alias("text_a"))
    right = texts.select(F.col("line").alias("b"), F.col("rest").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")
    longer = F.char_length("text_a") >= F.char_length("text_b")
    first = F.when(longer, F.col("text_a")).otherwise(F.col("text_b"))
    second = F.when(longer, F.col("text_b")).otherwise(F.col("text_a"))
    possible = like_counts(F.col("text_a"), F.col("text_b"), edits)
    return both.filter(possible & within(first, second, edits)).select("a", "b").distinct()


def with_keys(lines: DataFrame, text: str, edits: int) -> DataFrame:
    """``lines`` with chars, the length of ``text``, and keys; a column ``prefix`` goes into the keys."""
    bounds = segment_bounds("chars", edits)
    keyed = lines.withColumn("chars", F.char_length(text)).withColumns(bounds)
    return keyed.withColumn("keys", segment_keys(text, "chars", "prefix", edits)).drop(*bounds)


def near_lines(
    lines: DataFrame,
    edits: int = MAX_EDITS,
    crowded: int = CROWDED,
    index: DataFrame | None = None,
    holding: Callable[[DataFrame], DataFrame] | None = None,
    spanning: bool = False,
) -> DataFrame:
    """Links (a, b) between the 64-bit hashes of different lines within ``edits`` edits.

    ``lines`` has a column ``text``; repeated lines are fine. Lines need more than ``edits`` characters.
    ``index`` may give (prefix, line, chars, keys) of the lines where they are known, and
    ``holding`` lines among which all of some hashes (line) are found.

    With ``spanning``, only as many links as connect what all links do: every line is first compared with one
    other under each of its keys, and from then on only lines that this did not connect are paired, so a family of
    like lines costs in proportion to its lines, not to its pairs.
    """
    hashed = lambda some: some.select(F.xxhash64("text").alias("line"), F.col("text").alias("rest"))
    zero = F.lit(0).cast("long")
    if index is None:
        index = with_keys(hashed(lines).withColumn("prefix", zero), "rest", edits)
    frontier, texts, counts, labels, links, found = None, None, None, None, None, []
    start, size = segment_place("at", "chars", edits)
    while True:
        keyed = index if frontier is None else with_keys(frontier, "rest", edits)
        entries = (
            # the outer form: a plain one has Spark compute the array a second time, to filter by its size
            keyed.select("prefix", "line", "chars", F.posexplode_outer("keys").alias("at", "key"))
            .filter("key IS NOT NULL")
        )
        own = F.col("at") <= edits
        keys = stage(
            entries.groupBy("key")
            .agg(F.min("line").alias("low"), F.max("line").alias("high"), F.min("at").alias("at"))
            .filter((F.col("low") < F.col("high")) & own)
            .select("key")
        )
        members = stage(
            thin_out(entries, "key", keys, "key")
            .join(keys, "key")
            .distinct()
            .withColumns({"own": own, "start": start, "size": size})
        )
        if texts is None:
            wanted = stage(members.select("line").distinct())
            some = hashed(lines if holding is None else holding(wanted))
            texts = stage(thin_out(some, "line", wanted, "line").join(wanted, "line", "left_semi").distinct())
            frontier = texts.withColumn("prefix", zero)
            packed = {f"counts{k}": c for k, c in enumerate(packed_counts(F.col("rest")))}
            counts = stage(texts.withColumns(packed).drop("rest"))
        placed = _placed(members, labels)
        if spanning:
            around = stage(_similar(_stars(placed), texts, edits))
            if not around.isEmpty():
                links = around if links is None else stage(links.union(around))
                labels = stage(components(links))
                placed = _placed(members, labels)
        sizes = stage(
            placed.groupBy("key").agg(
                ((F.count("*") > crowded) & (F.max(F.col("chars") - F.col("size")) > 2 * edits)).alias("refine"),
                (F.min("component") < F.max("component")).alias("open"),
            ).filter("open")
        )
        found.append(stage(_pairs(placed, sizes.filter("NOT refine").select("key"), counts, edits).distinct()))
        hot = members.join(sizes.filter("refine").select("key"), "key")
        if hot.isEmpty():
            break
        cut = F.concat(
            F.substring("rest", F.lit(1), F.col("start") - 1),
            F.substring("rest", F.col("start") + F.col("size"), F.char_length("rest")),
        )
        frontier = stage(
            hot.join(frontier, ["prefix", "line"])
            .select(F.col("key").alias("prefix"), "line", cut.alias("rest"))
            .distinct()
        )
    more = _similar(reduce(DataFrame.union, found).distinct(), texts, edits)
    return more if links is None else links.union(more)


def remove_repeated_lines(
    docs: DataFrame,
    edits: int = MAX_EDITS,
    min_chars: int = MIN_CHARS,
    crowded: int = CROWDED,
    doc_id: str = "doc_id",
    text: str = "text",
    long_chars: int = LONG_CHARS,
    long_edits: int = LONG_EDITS,
) -> DataFrame:
    """All columns of ``docs`` with the text cut to first lines, and n_lines, n_removed.

    Lines end at ``\\n``. Equal lines form a class, and so do lines of ``min_chars``
    characters or more that are linked by steps of at most ``edits`` edits, or ``long_edits`` where
    both lines of a step have ``long_chars`` characters or more. The first line of
    each class stays, by doc_id (nulls last), then place; the others go. Lines of white space
    alone always stay. A null text stays null (0 lines). Rows that repeat an id and a text
    share their fate. Existing columns n_lines and n_removed are replaced.

    Equality is by 96 bits of hash and the length. Lines are split and hashed once, into an
    index without texts. Only lines that occur again, or are near others, are grouped with
    their places, and the places that go are joined to the texts, which are shuffled once.
    """
    if min_chars <= edits or long_chars <= max(min_chars, long_edits) or long_edits < edits:
        raise ValueError("min_chars must exceed edits, long_chars min_chars, and long_edits must not be less than edits")
    with small_methods(docs.sparkSession), StageScope(docs.sparkSession) as scope:
        cuts = scope.result(_cuts(docs, edits, min_chars, crowded, doc_id, text, long_chars, long_edits))
    return _cut(docs, cuts, doc_id, text)


def _cuts(
    docs: DataFrame, edits: int, min_chars: int, crowded: int, doc_id: str, text: str, long_chars: int, long_edits: int
) -> DataFrame:
    """id, row (hash of the text), gone (places that go, as bits by word), n_gone of the rows that lose lines."""
    content = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(content).alias("row"), content.alias("content")
    )
    cut_up = lambda some: some.select("id", "row", F.posexplode_outer(F.split("content", "\n")).alias("at", "text"))
    lines = cut_up(rows).filter(F.ltrim("text", F.lit(WHITE)) != "")
    prefixed = lines.withColumns({"prefix": F.lit(0).cast("long"), "chars": F.char_length("text")})
    # a pair of both kinds is within ``edits`` only if the longer line just reaches ``long_chars``
    reach = F.col("chars").between(min_chars, long_chars - 1 + edits)
    bounds = segment_bounds("chars", edits) | segment_bounds("chars", long_edits)
    index = stage(
        prefixed.withColumns(bounds).select(
            "id", "row", "at", "prefix", "chars",
            F.when(reach, segment_keys("text", "chars", "prefix", edits)).alias("keys"),
            F.when(F.col("chars") >= long_chars, segment_keys("text", "chars", "prefix", long_edits)).alias("long_keys"),
            F.xxhash64("text").alias("line"), F.hash("text").alias("more"), F.octet_length("text").alias("bytes"),
        )
    )

    def holding(wanted: DataFrame) -> DataFrame:
        """Lines of documents that hold all wanted lines between them."""
        found = thin_out(index, "line", wanted, "line").join(wanted, "line", "left_semi")
        held = stage(found.groupBy("line").agg(F.min("row").alias("row")).select("row").distinct())
        return cut_up(thin_out(rows, "row", held, "row")).filter(F.char_length("text") >= min_chars)

    short = near_lines(lines, edits, crowded, index.filter("keys IS NOT NULL"), holding, True)
    long = index.filter("long_keys IS NOT NULL").drop("keys").withColumnRenamed("long_keys", "keys")
    links = stage(short.union(near_lines(lines, long_edits, crowded, long, holding, True)).distinct())
    labels = stage(components(links))
    repeated = index.groupBy("line", "more", "bytes").count().filter("count > 1").select("line")
    again = stage(repeated.union(labels.select("node")))
    place = F.struct(F.col("id").isNull().alias("late"), "id", F.hex("row").alias("row"), "at").alias("place")
    alone = F.col("component").isNull()
    # a class without links is named by all that makes lines equal
    names = [
        F.coalesce("component", "line").alias("class"),
        F.when(alone, F.col("more")).otherwise(0).alias("more"),
        F.when(alone, F.col("bytes")).otherwise(-1).alias("bytes"),
    ]
    placed = stage(
        thin_out(index, "line", again, "line")
        .join(labels, F.col("line") == F.col("node"), "left")
        .select(*names, "id", "row", "at")
    )
    # written, so that the join of a very common line's places has an exchange that Spark can split
    firsts = stage(
        placed.groupBy("class", "more", "bytes")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    gone = placed.join(firsts, ["class", "more", "bytes"]).filter(place != F.col("first"))
    words = gone.groupBy("id", "row", F.floor(F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)).alias("bits")
    )
    return words.groupBy("id", "row").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("gone"),
        F.sum(F.bit_count("bits")).alias("n_gone"),
    )


def _cut(docs: DataFrame, cuts: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All columns of ``docs``, in one struct on the way so that no name clashes, the text without the places of ``cuts``."""
    kept_columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    given = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept_columns)).alias("given"),
        F.col(f"`{doc_id}`").alias("own_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("own_row"),
    )
    joined = given.join(
        cuts, (F.col("own_row") == F.col("row")) & F.col("own_id").eqNullSafe(F.col("id")), "left"
    )
    content = F.col("given").getField(text)
    n_lines = F.octet_length(content) - F.octet_length(F.replace(content, F.lit("\n"), F.lit(""))) + 1
    bits = joined.withColumn("n_lines", F.coalesce(n_lines, F.lit(0)).cast("long")).withColumn(
        "bits",
        F.when(
            F.col("gone").isNotNull(),
            F.transform(
                F.sequence(F.lit(0), F.floor(F.col("n_lines") / 64).cast("int")),
                lambda w: F.coalesce(F.element_at("gone", w), F.lit(0).cast("long")),
            ),
        ),
    )
    stays = lambda line, i: F.call_function(
        "shiftright", F.get("bits", F.floor(i / 64).cast("int")), i % 64
    ).bitwiseAND(F.lit(1)) == 0
    left = F.when(
        F.col("bits").isNotNull(), F.array_join(F.filter(F.split(content, "\n"), stays), "\n")
    ).otherwise(content)
    return bits.select(
        *((left if c == text else F.col("given").getField(c)).alias(c) for c in kept_columns),
        "n_lines",
        F.coalesce("n_gone", F.lit(0)).cast("long").alias("n_removed"),
    )
