"""Operator 8: lines that repeat across documents, up to a few edits. DataFrame and SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import row_key, spare, stored, with_row_key

#: Edits that two lines may be apart and still count as one, by the length from which so many are allowed (that of the
#: shorter line). Shorter lines count as one only if they are equal.
EDITS = ((16, 1), (64, 2))
BLANKS = " \t\r"
Steps = tuple[tuple[int, int], ...]
#: Starts of two lines that are compared by their characters before the lines meet: every 16 characters, so many of them.
STARTS = (16, 32)
#: Lines (copies counted) up to which those under one key all meet; under other keys they need a group in common too.
FEW = 16
#: Bits of the filters that spare a shuffle of all lines.
FILTER_BITS = 24


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings, ``a`` not the longer, are at most ``edits`` apart: banded bit-parallel edit distance.

    The band of ``2 * edits + 1`` cells around the diagonal is one machine word of vertical differences; each
    character of ``b`` moves it one cell down by a handful of bit operations. The last cell's value is the value
    at the band's lower edge less the differences below the last row.
    """
    width = 2 * edits + 1
    ones = (1 << width) - 1
    start = ones & ~((1 << edits) - 1)

    def matches(x: Column, y: Column, j: Column) -> Column:
        bits = [
            F.when(F.get(x, j - edits + t - 1) == F.get(y, j - 1), F.lit(1 << t).cast("long")).otherwise(F.lit(0).cast("long"))
            for t in range(width)
        ]
        return sum(bits[1:], bits[0])

    def inverse(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(ones)

    def step(state: Column, match: Column) -> Column:
        up, down = state["up"], state["down"]

        def with_diagonal(d: Column) -> Column:
            right = down.bitwiseOR(inverse(d.bitwiseOR(up)))
            left = d.bitwiseAND(up)
            return _let(
                right,
                lambda r: F.struct(
                    left.bitwiseOR(inverse(F.shiftright(d, 1).bitwiseOR(r))).alias("up"),
                    F.shiftright(d, 1).bitwiseAND(r).alias("down"),
                    (state["score"] + F.when(F.shiftright(d, width - 1) == 0, 1).otherwise(0)).cast("long").alias("score"),
                ),
            )

        sums = match.bitwiseAND(up) + up
        return _let(sums.bitwiseAND(ones).bitwiseXOR(up).bitwiseOR(match).bitwiseOR(down), with_diagonal)

    first = F.struct(
        F.lit(start).cast("long").alias("up"), F.lit(0).cast("long").alias("down"), F.lit(edits).cast("long").alias("score")
    )

    def below(state: Column, gap: Column) -> Column:
        """Differences of the rows after the last: bits from ``edits - gap`` to ``width - 2``."""
        value = F.lit(0)
        for t in range(width - 1):
            bit = F.shiftright(state["up"], t).bitwiseAND(1) - F.shiftright(state["down"], t).bitwiseAND(1)
            value = value + F.when(F.lit(t) >= F.lit(edits) - gap, bit).otherwise(0)
        return value

    gap = F.length(b) - F.length(a)
    marks = _let(
        F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y")),
        lambda p: F.transform(F.sequence(F.lit(1), F.length(b)), lambda j: matches(p["x"], p["y"], j)),
    )
    last = F.aggregate(marks, first, step, lambda s: s["score"] - below(s, gap))
    return F.when((gap >= 0) & (gap <= edits), last <= edits).otherwise(False)


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and size of the ``edits + 1`` even segments of a line; the later ones are longer."""
    parts = edits + 1
    size, rest = F.floor(length / parts), length % parts
    out = []
    for i in range(parts):
        longer = F.greatest(F.lit(0), rest - (parts - 1 - i))
        before = F.greatest(F.lit(0), rest - (parts - i))
        out.append(((size * i + before + 1).cast("int"), (size + (longer - before)).cast("int")))
    return out


def _key(length: Column, i: int, start: Column, size: Column) -> Column:
    """Of ``size`` characters of the line; ``wide`` has four bytes for each, so they are cut out without a search."""
    return F.xxhash64(length.cast("int"), F.lit(i), F.substring(F.col("wide"), 4 * (start - 1) + 1, 4 * size))


def allowed(n: Column, steps: Steps) -> Column:
    """Edits that a line of ``n`` characters may be from a longer one."""
    found = F.lit(0)
    for least, edits in steps:
        found = F.when(n >= least, edits).otherwise(found)
    return found


def _index(steps: Steps) -> Column:
    n, keys = F.col("n"), []
    for edits in sorted({e for _, e in steps}):
        own = allowed(n, steps) == edits
        keys += [F.when(own, _key(n, i, at, size)) for i, (at, size) in enumerate(_segments(n, edits))]
    return F.array(*keys) if keys else F.array().cast("array<bigint>")


def _probes(steps: Steps) -> Column:
    """Substrings at which a segment of a line as long, or shorter by no more than its edits, can stand.

    Those of the line's own segments are left out: ``_index`` has them.
    """
    n, keys = F.col("n"), []
    for edits in sorted({e for _, e in steps}):
        for gap in range(edits + 1):
            length = n - gap
            meant = allowed(length, steps) == edits
            for i, (at, size) in enumerate(_segments(length, edits)):
                low, high = max(-i, gap - (edits - i)), min(i, gap + (edits - i))
                for shift in range(low, high + 1):
                    if gap or shift:
                        start = at + shift
                        fits = meant & (start >= 1) & (start + size - 1 <= n)
                        keys.append(F.when(fits, _key(length, i, start, size)))
    return F.array(*keys) if keys else F.array().cast("array<bigint>")


def _groups(steps: Steps) -> int:
    return 2 * max((edits for _, edits in steps), default=0) + 1


def _signatures(line: Column, groups: int) -> Column:
    """A sum over the characters of each group (code modulo ``groups``), whatever their order.

    An edit takes a character out of one group and may put one into another, so of two lines that are within
    ``(groups - 1) / 2`` edits at least one group has the same characters.
    """

    def totals(codes: Column) -> Column:
        return F.array(*[total(codes, group) for group in range(groups)])

    def total(codes: Column, group: int) -> Column:
        # Spark counts a function's parameters, those with defaults too: a second one would be the position.
        own = F.filter(codes, lambda c: c % groups == group)
        return F.aggregate(own, F.lit(0).cast("long"), lambda x, c: x + F.xxhash64(c).bitwiseAND((1 << 31) - 1))

    return _let(F.transform(F.split(line, ""), F.ascii), totals)


def _among(frame: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose 64-bit ``column`` may be among ``ids`` (of the same name); few others pass, none of them is lost.

    The ids' low 24 bits mark bits of at most 2 ** 18 words, so what is broadcast is bounded whatever their number.
    """
    word, bit = f"(shiftrightunsigned({column}, 6) & {(1 << (FILTER_BITS - 6)) - 1})", f"CAST({column} & 63 AS INT)"
    bits = ids.select(F.expr(word).alias("word"), F.expr(f"shiftleft(1L, {bit})").alias("bit"))
    bits = bits.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits"))
    found = frame.withColumn("word", F.expr(word)).join(F.broadcast(bits), "word")
    return found.where(f"getbit(bits, {bit}) = 1").drop("word", "bits")


def _shape(line: Column) -> Column:
    """Which characters (code modulo 64) stand an odd number of times in each start of the line, then in the whole.

    Bits of one long per start; null where the line is shorter.
    """
    step, starts = STARTS
    none = F.lit(0).cast("long")
    bits = F.transform(F.split(line, ""), lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c).bitwiseAND(63)))

    def odd(some: Column) -> Column:
        return F.aggregate(some, none, lambda x, y: x.bitwiseXOR(y))

    def longer(found: Column, more: Column) -> Column:
        return F.concat(found, F.array(more.bitwiseXOR(F.coalesce(F.get(found, F.size(found) - 1), none))))

    def shape(bits: Column) -> Column:
        whole = F.transform(
            F.sequence(F.lit(0), F.lit(starts - 1)),
            lambda i: F.when(F.size(bits) >= (i + 1) * step, odd(F.slice(bits, i * step + 1, step))),
        )
        return F.concat(F.aggregate(whole, F.array().cast("array<bigint>"), longer), F.array(odd(bits)))

    return _let(bits, shape)


def _alike(a: str, b: str, edits: str) -> str:
    """Whether no start of the lines, nor the whole, differs in more bits than the edits allow: an edit turns two at most.

    A plain condition, without functions on arrays, so that it is part of the join and no pair that fails is made.
    """
    places = [STARTS[1], *range(STARTS[1])]
    return " AND ".join(f"coalesce(bit_count({a}[{i}] ^ {b}[{i}]) <= 2 * {edits}, true)" for i in places)


def _judged(documents: DataFrame, steps: Steps) -> DataFrame:
    """``k1, k2, n_lines, n_removed, removed`` per different row that has a text."""
    rows = with_row_key(documents).where("text IS NOT NULL")
    place = F.expr("CAST(coalesce(doc_id, 9223372036854775807) AS DECIMAL(38, 0)) * 4294967296 + number")
    place = place.cast("decimal(38,0)").alias("place")
    lines = rows.select("doc_id", "k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("number", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).withColumn("n", F.length("line"))
    some, long = F.col("n") > 0, F.col("n") >= min((least for least, _ in steps), default=2**31 - 1)
    marks = {"h1": F.when(some, F.xxhash64("line")), "h2": F.when(some, F.hash("line", F.lit(1)))}
    keys = {"own": F.when(long, _index(steps)), "others": F.when(long, _probes(steps))}
    wide = lines.withColumn("wide", F.when(long, F.encode("line", "UTF-32")))
    # A function on an array keeps this projection out of the stage's one method, which with all keys has 34 KB of code
    # and would be interpreted (from 8 KB on); by itself Spark writes it as many small methods, which are compiled.
    apart = _let(F.col("number"), lambda number: number).alias("number")
    plain = stored(wide.select("doc_id", "k1", "k2", apart, *[c.alias(n) for n, c in (marks | keys).items()]), "lines")
    numbered = plain.select("doc_id", "k1", "k2", "number", place, "h1", "h2")
    classes = numbered.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min("place").alias("first"))

    own = plain.select("h1", F.explode("own").alias("key"), F.lit(1).alias("is_own"))
    keyed = own.unionByName(plain.select("h1", F.explode("others").alias("key"), F.lit(0).alias("is_own")))
    # Keys that a line does not have are null; taking them out inside the row would interpret the expressions of all.
    keyed = keyed.where("key IS NOT NULL")
    shared = keyed.groupBy("key").agg(
        F.min("h1").alias("low"), F.max("h1").alias("high"), F.max("is_own").alias("is_own"), F.count("*").alias("met")
    )
    shared = stored(shared.where("low < high AND is_own = 1").select("key", "met"), "line-keys")
    some = stored(_among(keyed, "key", shared).join(shared, "key").distinct(), "line-meetings")
    ids = some.select("h1").distinct()
    wanted = _among(classes, "h1", ids).join(ids, "h1").select("h1", "h2", "first")
    texts = lines.where(long).select("doc_id", "number", "line", *[c.alias(n) for n, c in marks.items()])
    texts = _among(texts, "h1", ids).select("h1", "h2", place, "line").join(wanted, ["h1", "h2"]).where("place = first")
    texts = texts.select("h1", "h2", "first", "line").dropDuplicates(["h1", "h2"])
    line = F.col("line")
    texts = texts.withColumns(
        {"edits": allowed(F.length(line), steps), "groups": _signatures(line, _groups(steps)), "shape": _shape(line)}
    )
    texts = stored(texts, "line-texts")
    # Below a key that many lines share, only those meet that also have the same characters in one of the groups.
    grouped = F.transform("groups", lambda same, group: F.xxhash64("key", group, same))
    meetings = F.when(F.col("met") <= FEW, F.array("key")).otherwise(grouped)
    known = some.join(texts.select("h1", "edits", "shape", "groups"), "h1").withColumn("meeting", F.explode(meetings))
    index = known.where("is_own = 1").select("meeting", "h1", "edits", "shape")
    probes = known.select("meeting", F.col("h1").alias("p1"), F.col("shape").alias("other"))
    near = index.join(probes, "meeting").where("h1 <> p1").where(_alike("shape", "other", "edits"))
    pairs = near.select(F.least("h1", "p1").alias("a"), F.greatest("h1", "p1").alias("b")).distinct()
    parts = texts.select("h1", "h2", "first", "line", "edits")
    one, two = (parts.select(*[F.col(c).alias(f"{c}_{side}") for c in parts.columns]) for side in "ab")
    met = pairs.join(one, F.col("a") == F.col("h1_a")).join(two, F.col("b") == F.col("h1_b"))
    swap = F.length("line_a") > F.length("line_b")

    def ordered(column: str, shorter: bool) -> Column:
        return F.when(swap == shorter, F.col(f"{column}_b")).otherwise(F.col(f"{column}_a"))

    met = met.withColumns(
        {"short": ordered("line", True), "tall": ordered("line", False), "edits": ordered("edits", True)}
    )
    close = F.lit(False)
    for edits in sorted({e for _, e in steps}):
        close = F.when(F.col("edits") == edits, within(F.col("short"), F.col("tall"), edits)).otherwise(close)
    met = met.where(close)
    later = F.col("first_a") > F.col("first_b")
    near = met.select(
        F.when(later, F.col("h1_a")).otherwise(F.col("h1_b")).alias("h1"),
        F.when(later, F.col("h2_a")).otherwise(F.col("h2_b")).alias("h2"),
    ).distinct()
    # Written, so that the join with all lines is one of two plain exchanges and a very common line can be split.
    classes = stored(classes.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left"), "line-classes")
    judged = numbered.join(classes, ["h1", "h2"], "left")
    goes = F.col("h1").isNotNull() & (F.col("near").isNotNull() | (F.col("place") > F.col("first")))
    judged = judged.withColumn("goes", F.when(goes, F.col("number")))
    return judged.groupBy("k1", "k2").agg(
        F.countDistinct("number").alias("n_lines"), F.countDistinct("goes").alias("n_removed"),
        F.array_sort(F.collect_set("goes")).alias("removed"),
    )


def repeated_lines(documents: DataFrame, steps: Steps = EDITS) -> DataFrame:
    """``doc_id, k1, k2, n_lines, n_removed, removed``: the lines of each document that an earlier line repeats.

    ``documents`` needs doc_id and text. Lines are parted by the line feed and compared without blanks at their
    ends; empty ones stay. The order of lines is that of doc_id (null last), then of the line in its text. A line
    goes if an equal line of any length first appears before it, or a different one that is no more edits away than
    ``steps`` allow for the length of the shorter of the two. ``removed`` has the line numbers, from 0, in order.
    Every input row has a row; rows that are equal in doc_id and text are one document and say the same. A null text
    has no lines, an empty one has one. Other columns are ignored.

    Equal lines are one class, counted per task first. A class is cut into one segment more than the edits it may
    have and probed by the substrings at which a segment of a line shorter by no more than its edits can stand.
    Classes that share a key get their texts; pairs of them that nearly agree in the characters of their starts
    (``STARTS``) and of the whole, and under keys of more than ``FEW`` lines have the same characters in one of the
    groups, are verified.
    """
    keys = with_row_key(documents).select("doc_id", "k1", "k2")
    found = keys.join(_judged(documents, steps), ["k1", "k2"], "left")
    none = F.lit(0).cast("long")
    return found.select(
        "doc_id", "k1", "k2", F.coalesce("n_lines", none).alias("n_lines"), F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def without_lines(documents: DataFrame, steps: Steps = EDITS) -> DataFrame:
    """The documents, all their columns, without the lines that ``repeated_lines`` finds.

    ``n_chars``, where there is such a column, follows the text. A document that loses all its lines goes;
    documents that lose none, null and empty ones included, stay as they are.
    """
    columns = documents.columns
    one, two, gone, empty = (spare(columns, c) for c in ("k1", "k2", "gone", "empty"))
    found = _judged(documents, steps).where("n_removed > 0")
    found = found.select(
        F.col("k1").alias(one), F.col("k2").alias(two), F.col("removed").alias(gone),
        (F.col("n_lines") == F.col("n_removed")).alias(empty),
    )
    out = documents.withColumns(dict(zip((one, two), row_key()))).join(found, [one, two], "left")
    out = out.where(~F.coalesce(empty, F.lit(False)))
    cut = F.col(gone).isNotNull()
    kept = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(gone, i)), "\n"
    )
    out = out.withColumn("text", F.when(cut, kept).otherwise(F.col("text")))
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        count = F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", count)
    return out.select(*columns)
