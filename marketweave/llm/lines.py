"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Lines of MIN_CHARS characters or more are compared by edit distance: two link when it is TAU at
most.  Shorter lines that hold a letter or digit are alike only if they are equal, as two edits
make another word of a short one; shorter ones without (list marks, rules, blank lines) stay.

A line of length l is cut into TAU + 1 even segments.  A line within the distance holds one of
them unchanged, shifted by little: the probe of a line of length l + d looks up, for d of 0 to
TAU and each segment, only the substrings whose shift leaves enough edits for both sides.
Segments and substrings are hashed with the length and the segment's number, so a key only
meets lines of one length.  Candidates must share all but TAU of FINE finer segments too; what
they differ in is verified by a banded bit-parallel edit distance.

Index keys are reduced to their smallest and largest line and a count before anything is
joined, so a key that two lines have at most never forms a group.  A key of more lines keeps
what is left of them without the shared part; those rests must be within the distance again.
If they form PAIRS pairs at most, the ones go on whose counts of characters are near enough.
Rests of a larger group lose the head and the tail that all of them share, which changes no
distance.  If CORE characters are left at most, as in lines of one template that differ in a
number, no pair is formed: each rest names its variants within the distance (two places open,
one character less, and so on), all that name one variant are within the distance of its smallest
indexed line, and each links with that one.  Longer rests are cut into segments in turn.
No line is dropped or capped, and no link is lost.

A class is a connected component of linked lines.  Its first line, by doc_id and then by place,
stays; the others are removed.

Defined results: null text counts as no line and stays null; a null doc_id keeps its row
unchanged and takes no part; rows that repeat a doc_id count as one document, so equal lines at
equal places of both stay.  An empty table gives an empty result.  Other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketweave.llm.components import components
from marketweave.llm.thin import split_by, thin
from marketweave.session import shared_dir, stage

TAU = 2
MIN_CHARS = 24
#: Characters that are counted together, eight classes to a number.
CLASSES = (("e", "a", "i", "o", "u", "n", "t", "s"), ("r", "h", "d", "l", "cm", "gfpb", "vwykjxqz", " .,"))
FINE = 12  # segments that a candidate must share but for TAU before its distance is taken
PAIRS = 10_000  # pairs that a key may form
CORE = 12  # characters up to which the rests of a larger group name their variants
#: Unicode's noncharacters, which no text holds: an open place, and what stands for a part cut out.
HOLE, MARKS = "\ufdd0", [chr(c) for c in range(0xFDD1, 0xFDF0)]


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def edit_within(a: Column, b: Column, tau: int = TAU) -> Column:
    """Whether two texts are within edit distance `tau`, for lengths that differ by `tau` at most.

    A column of the dynamic programme is held as two words of 2 * tau + 1 bits around the
    diagonal: where the value rises by one downwards and where it falls.  One step of bit
    operations moves the band along the longer text; the diagonal that ends in the last cell
    counts the distance.
    """
    swap = F.length(a) > F.length(b)
    short, long_ = F.split(F.when(swap, b).otherwise(a), ""), F.split(F.when(swap, a).otherwise(b), "")
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    mask = F.lit(2 ** (2 * tau + 1) - 1).cast("long")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    gap = (longer - shorter).cast("int")

    def run(p: Column, t: Column) -> Column:
        def step(s: Column, j: Column) -> Column:
            same = zero
            for bit in range(2 * tau + 1):
                hit = F.coalesce(F.get(p, j - tau + bit - 1) == F.get(t, j - 1), F.lit(False))
                same = same.bitwiseOR(F.when(hit, F.lit(2**bit).cast("long")).otherwise(zero))

            def moved(d0: Column) -> Column:
                def shifted(hp: Column) -> Column:
                    down = F.shiftright(d0, 1)
                    rise = d0.bitwiseAND(s["vp"]).bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(mask))
                    on = sum(
                        (F.when((gap == d) & (F.shiftright(d0, tau - d).bitwiseAND(one) == 0), 1).otherwise(0) for d in range(tau + 1)),
                        F.lit(0),
                    )
                    return F.struct(rise.alias("vp"), down.bitwiseAND(hp).alias("vn"), (s["e"] + F.when(j > gap, on).otherwise(0)).alias("e"))

                return _let(s["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(s["vp"]))).bitwiseAND(mask), shifted)

            def entered(x: Column) -> Column:
                carry = (x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])
                return _let(carry.bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(mask), moved)

            # A distance beyond the bound stays there.
            return F.when(s["e"] > tau, s).otherwise(_let(same, entered))

        fall = F.lit(2**tau - 1).cast("long")
        start = F.struct((mask - fall).alias("vp"), fall.alias("vn"), gap.alias("e"))
        return F.aggregate(F.sequence(F.lit(1), longer.cast("int")), start, step)["e"]

    pair = F.struct(short.alias("p"), long_.alias("t"))
    distance = F.when(longer == 0, 0).otherwise(_let(pair, lambda x: run(x["p"], x["t"])))
    return (gap <= tau) & (distance <= tau)


def _cut(d: int, i: int) -> tuple[str, str]:
    """Start (from 1) and size of segment `i` of TAU + 1 even ones, in a text `d` shorter than `_size`."""
    sizes = [f"int((_size - {d} + {j}) div {TAU + 1})" for j in range(i + 1)]
    return " + ".join(["1", *sizes[:i]]), sizes[i]


#: What an entry is, by its number: role (0 indexed, 1 probe), length less than the line's,
#: segment, and shift of the substring against the segment.
INDEXED = [(0, 0, i, 0) for i in range(TAU + 1)]
PROBES = [
    (1, d, i, shift)
    for d in range(TAU + 1)
    for i in range(TAU + 1)
    for shift in range(max(-i, d - (TAU - i)), min(i, d + (TAU - i)) + 1)
]


def _entries(df: DataFrame, text: str, wanted: list[tuple], *columns: str, context: str | None = None) -> DataFrame:
    """`columns, key, entry` of the wanted entries of each row's text; `_size` is its length.

    Texts and lengths are columns already, so the hashes are all that is computed here.  A text
    of MIN_CHARS characters holds every entry; shorter rests, which have a context, may not.
    """
    keys = []
    for _, d, i, shift in wanted:
        at, size = _cut(d, i)
        hashed = f"xxhash64({context + ', ' if context else ''}_size - {d}, {i}, substring({text}, {at} + {shift}, {size}))"
        if context:
            hashed = f"if(_size - {d} > {TAU} and {at} + {shift} >= 1 and {at} + {shift} + {size} - 1 <= _size, {hashed}, null)"
        keys.append(F.expr(hashed))
    return df.select(*columns, F.posexplode(F.array(*keys)).alias("entry", "key")).filter("key is not null")


def _rest(text: str, wanted: list[tuple], level: int) -> Column:
    """The text with marks for the substring of its entry.

    TAU + 1 marks keep what stands before the shared part from what stands behind it: two edits
    cannot bring something across.  So texts are within the distance if their rests are.
    """
    cases, mark = [], MARKS[level % len(MARKS)] * (TAU + 1)
    for number, (_, d, i, shift) in enumerate(wanted):
        at, size = _cut(d, i)
        cases.append(f"when {number} then concat(substring({text}, 1, {at} + {shift} - 1), '{mark}', substring({text}, {at} + {shift} + {size}))")
    return F.expr(f"case entry {' '.join(cases)} end")


def _what(wanted: list[tuple], field: int) -> Column:
    return F.element_at(F.array(*[F.lit(w[field]) for w in wanted]), F.col("entry") + 1)


def occurrences(docs: DataFrame) -> DataFrame:
    """`doc_id, text_id, pos, line, id, _size` of each line that may be removed."""
    text_id = F.xxhash64("text").alias("text_id")
    found = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), text_id, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    found = found.withColumn("_size", F.length("line")).filter((F.col("_size") >= MIN_CHARS) | F.col("line").rlike(r"[\p{L}\p{N}]"))
    return found.withColumn("id", F.xxhash64("line"))


def _histogram(text: str) -> Column:
    """Counts of classes of characters, up to 255 each, in two numbers."""
    out = []
    for part in CLASSES:
        number = F.lit(0).cast("long")
        for k, members in enumerate(part):
            count = F.least(F.lit(255), F.length(text) - F.length(F.translate(F.col(text), members, ""))).cast("long")
            number = number.bitwiseOR(F.shiftleft(count, 8 * k))
        out.append(number)
    return F.struct(*[n.alias(f"h{j}") for j, n in enumerate(out)])


def _alike(a: str, b: str) -> Column:
    """Whether two histograms may be of texts within the distance: an edit moves two counts by one at most."""
    byte = lambda c, k: F.shiftrightunsigned(c, 8 * k).bitwiseAND(F.lit(255))
    apart = [F.abs(byte(F.col(a)[f"h{j}"], k) - byte(F.col(b)[f"h{j}"], k)) for j, part in enumerate(CLASSES) for k in range(len(part))]
    return sum(apart, F.lit(0)) <= 2 * TAU


def _common(a: str, b: str) -> Column:
    """How many characters two texts begin with together."""
    both = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"), F.least(F.length(a), F.length(b)).alias("n"))
    step = lambda x: lambda s, i: F.when((s == i) & (F.get(x["a"], i) == F.get(x["b"], i)), s + 1).otherwise(s)
    run = lambda x: F.aggregate(F.sequence(F.lit(0), x["n"] - 1), F.lit(0), step(x))
    return F.when(F.least(F.length(a), F.length(b)) == 0, 0).otherwise(_let(both, run))


def _variants(df: DataFrame) -> DataFrame:
    """`v, id, role`: hashes of what a rest is within the distance of, by role and difference of length.

    Of rests of one length: two places open, or one character less.  Of an indexed one and one that
    is a character longer: one place open, the character left out.  Two longer: both left out.  All
    that share one of these are within two edits of the indexed ones among them.  Two open places in
    front of all spare the cases of short rests.
    """
    text = f"concat('{HOLE}{HOLE}', rest)"
    n = "(length(rest) + 2)"
    less = lambda t, i: f"concat(left({t}, {i} - 1), substring({t}, {i} + 1))"
    open_ = lambda t, i: f"concat(left({t}, {i} - 1), '{HOLE}', substring({t}, {i} + 1))"
    each = lambda body, size=n, i="i": f"transform(sequence(1, {size}), {i} -> {body})"
    hashed = lambda kind, value: f"xxhash64(key, {kind}, {value})"
    pairs = lambda kind, change: f"filter(flatten({each(each(f'if(i < j, {hashed(kind, change(change(text, 'j'), 'i'))}, null)', i='j'))}), h -> h is not null)"
    two_open, one_less = pairs(0, open_), each(hashed(1, less(text, "i")))
    one_open = each(hashed(2, open_(text, "i")))
    less_open = f"flatten({each(each(hashed(2, open_(less(text, 'j'), 'i')), f'{n} - 1'), i='j')})"
    kinds = f"""case when role = 0 then concat({two_open}, {one_less}, {one_open}, array({hashed(3, text)}))
        when d = 0 then concat({two_open}, {one_less}) when d = 1 then {less_open} else {pairs(3, less)} end"""
    return df.select(F.explode(F.array_distinct(F.expr(kinds))).alias("v"), "id", "role")


def _stars(df: DataFrame) -> DataFrame:
    """`a, b`: each line with the smallest indexed one that shares a variant with it."""
    named = _variants(df)
    center = named.groupBy("v").agg(F.min(F.when(F.col("role") == 0, F.col("id"))).alias("center"), F.min("id").alias("low"), F.max("id").alias("high"))
    center = center.filter("center is not null and low <> high").select("v", "center")
    found = named.join(center, "v").filter("id <> center").select(F.greatest("id", "center").alias("a"), F.least("id", "center").alias("b"))
    return found.distinct()


def candidates(found: DataFrame, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """`a, b`: ids of different lines that share a segment's key; ids that are within the distance
    for sure; `id, line` of these lines; and `id` of all lines that may be linked or repeated."""
    keys = _entries(found, "line", INDEXED, "id").groupBy("key")
    keys = keys.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
    # Repeats of one line are one; what holds two lines and repeats counts as a key of more.
    keys = keys.withColumn("again", F.col("n") > 1).withColumn("n", F.when(F.col("low") == F.col("high"), 1).otherwise(F.col("n")))
    hits = _entries(found, "line", PROBES, "id").select("key", "id").join(keys, "key")
    # A line's own segments are among its probes, so a repeated line finds that its key is used again.
    hits = stage(hits.filter("again or low <> id").distinct(), "hits", root)
    seen = hits.select(F.explode(F.array("id", "low", "high")).alias("id"))
    hits = hits.filter("n > 2 or low <> id or high <> id")
    near = hits.filter("n <= 2").select("id", F.explode(F.array_distinct(F.array("low", "high"))).alias("other"))
    near = near.filter("id <> other").select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b"))
    out, sure = [near], [near.filter("false")]

    # Keys of three lines or more: the entries of their lines again, with the rest of the line.
    # For the same reason the hits hold all the indexed lines of these keys.
    full = hits.filter("n > 2").select("key").distinct()
    every = INDEXED + PROBES
    wanted = hits.select(F.explode(F.array("id", "low", "high")).alias("id"))
    lines = stage(thin(found.select("id", "line", "_size"), wanted, "id").distinct(), "lines", root)
    again = lines.join(hits.filter("n > 2").select("id").distinct(), "id", "left_semi").withColumn("hist", _histogram("line"))
    going = _entries(again, "line", every, "id", "line", "_size", "hist").join(full, "key")
    open_ = going.select("key", "id", "hist", _what(every, 0).alias("role"), _what(every, 1).alias("d"), _rest("line", every, 0).alias("rest"))
    level = 0
    while True:
        level += 1
        open_ = stage(open_.distinct(), f"open_{level}", root)
        size, back = F.length("rest"), F.reverse("rest")
        ends = [F.min("rest").alias("lo"), F.max("rest").alias("hi"), F.min(back).alias("rlo"), F.max(back).alias("rhi"), F.min(size).alias("least"), F.max(size).alias("most")]
        groups = open_.groupBy("key").agg(F.sum(1 - F.col("role")).alias("ni"), F.sum("role").alias("np"), *ends).filter("ni > 0 and np > 0")
        groups = groups.withColumn("few", F.col("ni") * F.col("np") <= PAIRS)
        groups = groups.withColumn("head", F.when(~F.col("few"), _common("lo", "hi")).otherwise(0))
        groups = groups.withColumn("tail", F.when(~F.col("few"), F.least(_common("rlo", "rhi"), F.col("least") - F.col("head"))).otherwise(0))
        kind = F.when(F.col("few"), 0).when(F.col("most") - F.col("head") - F.col("tail") <= CORE, 1).otherwise(2)
        sized = open_.join(groups.select("key", kind.alias("kind"), "head", "tail"), "key")
        sized = sized.withColumn("rest", F.when(F.col("kind") > 0, F.substr("rest", F.col("head") + 1, F.length("rest") - F.col("head") - F.col("tail"))))
        sized = stage(sized.withColumn("_size", F.length("rest")).drop("head", "tail"), f"sized_{level}", root)
        one = sized.filter("kind = 0 and role = 0").select("key", F.col("id").alias("x"), F.col("hist").alias("hx"))
        two = sized.filter("kind = 0 and role = 1").select("key", F.col("id").alias("y"), F.col("hist").alias("hy"))
        pairs = one.join(two, "key").filter((F.col("x") != F.col("y")) & _alike("hx", "hy")).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        out.append(stage(pairs.distinct(), f"near_{level}", root))
        left = {r["kind"] for r in sized.select("kind").distinct().collect()}  # three at most
        if 1 in left:
            sure.append(stage(_stars(sized.filter("kind = 1")), f"stars_{level}", root))
        if 2 not in left:
            break
        going = sized.filter("kind = 2").select(F.col("key").alias("ctx"), "id", "hist", "role", "d", "rest", "_size")
        # Roles and the difference of the lengths stay what they are.
        parts = []
        for role, d, wanted in [(0, 0, INDEXED), *((1, d, [w for w in PROBES if w[1] == d]) for d in range(TAU + 1))]:
            side = going.filter((F.col("role") == role) & (F.col("d") == d))
            cut = _entries(side, "rest", wanted, "id", "hist", "rest", "_size", context="ctx")
            parts.append(cut.select("key", "id", "hist", F.lit(role).alias("role"), F.lit(d).alias("d"), _rest("rest", wanted, level).alias("rest")))
        open_ = reduce(DataFrame.unionByName, parts)
    return reduce(DataFrame.unionByName, out).distinct(), reduce(DataFrame.unionByName, sure).distinct(), lines, seen


def _holds_segments(a: str, b: str) -> Column:
    """Whether all but TAU of FINE even segments of a text occur in another one about where they
    are; `_size` is the first one's length. TAU edits spoil TAU segments at most."""
    size = F.col("_size")
    base, over = F.floor(size / FINE).cast("int"), F.pmod(size, F.lit(FINE))
    found = F.lit(0)
    for i in range(FINE):
        at = base * i + F.greatest(F.lit(0), over + i - FINE) + 1
        width = base + F.when(over + i >= FINE, 1).otherwise(0)
        start = F.greatest(F.lit(1), at - TAU)
        near = F.substr(F.col(b), start, at + width + TAU - start)
        found = found + F.when(near.contains(F.substr(F.col(a), at, width)), 1).otherwise(0)
    return found >= FINE - TAU


def _trimmed(both: DataFrame, a: str, b: str) -> DataFrame:
    """`both` with common heads and tails cut from the two texts, in FINE steps; their edit
    distance stays the same."""
    least = F.least("_size", F.length(b))
    steps = [F.floor(F.col("_least") * j / FINE).cast("int") for j in range(FINE, 0, -1)]
    both = both.withColumn("_least", least)
    head = F.coalesce(*[F.when(F.substr(F.col(a), F.lit(1), n) == F.substr(F.col(b), F.lit(1), n), n) for n in steps], F.lit(0))
    both = both.withColumn("_head", head)
    tail = F.coalesce(*[F.when((n <= F.col("_least") - F.col("_head")) & (F.right(F.col(a), n) == F.right(F.col(b), n)), n) for n in steps], F.lit(0))
    both = both.withColumn("_tail", tail)
    inner = lambda c: F.substr(F.col(c), F.col("_head") + 1, F.length(c) - F.col("_head") - F.col("_tail"))
    return both.withColumns({a: inner(a), b: inner(b)})


def links(found: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """`a, b`: ids of lines within the edit distance; and `id` of all lines that may be linked or repeated."""
    pairs, sure, lines, seen = candidates(found, root)
    pairs = pairs.join(sure, ["a", "b"], "left_anti")
    side = lambda c: lines.select(F.col("id").alias(c), F.col("line").alias(f"line_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("_size", F.length("line_a"))
    # Most candidates share one segment and no more: those are not worth the distance.
    both = stage(_trimmed(both.filter(_holds_segments("line_a", "line_b")), "line_a", "line_b"), "alike", root)
    near = both.filter(edit_within(F.col("line_a"), F.col("line_b"))).select("a", "b")
    return stage(near.unionByName(sure), "links", root), seen


def repeated(docs: DataFrame) -> DataFrame:
    """`doc_id, text_id, removed`: the places of the lines that repeat an earlier one, of texts with any."""
    root = shared_dir(docs.sparkSession)
    every = occurrences(docs)
    found = every.filter(F.col("_size") >= MIN_CHARS)
    edges, seen = links(found, root)
    joined = components(edges, "a", "b").withColumnRenamed("node", "id")
    # Only lines that share a key are looked at again. A second hash keeps unequal lines of equal ids apart.
    place = ["doc_id", "text_id", "pos", "id", F.xxhash64(F.lit(1), "line").alias("also")]
    short = every.filter(F.col("_size") < MIN_CHARS).select(*place)
    found = stage(thin(found.select(*place), seen, "id").unionByName(short), "places", root)
    first = found.groupBy("id", "also").agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.count(F.lit(1)).alias("n"))
    first = stage(first, "first", root)
    joined = stage(joined, "classes", root)
    linked = first.join(joined, "id")
    class_first = linked.groupBy("component").agg(F.min("f").alias("f"))
    linked = linked.drop("f").join(class_first, "component").select("id", "also", "f")
    alone = first.filter("n > 1").join(joined, "id", "left_anti").select("id", "also", "f")
    many = stage(alone.unionByName(linked), "many", root)
    again = found.join(many, ["id", "also"]).filter(F.struct("doc_id", "pos") != F.col("f"))
    return again.groupBy("doc_id", "text_id").agg(F.collect_set("pos").alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs` with repeated lines cut from `text`, and `_lines`, `_removed` counts."""
    root = shared_dir(docs.sparkSession)
    gone = stage(repeated(docs), "removed", root)
    touched, rest = split_by(docs, gone, "doc_id")
    columns = docs.columns
    lines = F.split("text", "\n")
    # The same plan at any size: documents that change are dealt by id, the others are not moved.
    places = gone.hint("merge").select(F.col("doc_id").alias("_gone_id"), F.col("text_id").alias("_gone_text"), F.col("removed").alias("_gone"))
    touched = touched.join(places, (touched["doc_id"] == F.col("_gone_id")) & (F.xxhash64("text") == F.col("_gone_text")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    whole = _let(lines, lambda x: F.array_join(F.transform(kept, lambda i: F.get(x, i)), "\n"))
    text = F.when(F.col("_gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(whole)
    cut = F.when(F.col("text").isNull(), 0).otherwise(F.coalesce(F.size("_gone"), F.lit(0)))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    some = touched.select(*[text.alias(c) if c == "text" else F.col(c) for c in columns], count.alias("_lines"), cut.alias("_removed"))
    return some.unionByName(rest.select(*columns, count.alias("_lines"), F.lit(0).alias("_removed")))
