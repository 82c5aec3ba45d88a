"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct five-word shingles.  Two documents link when 100 times the
size of the intersection is at least 75 times the size of the union.  Then the sets differ in
at most a seventh of their summed sizes.  Sets are banded by size (a band's upper edge is 16/9
of the lower), and one whose partner may be in the next band signs for that band too, so both
sets of a pair sign for the larger one's band.  There a set of s elements, among sets of u at
most, differs from a partner in at most k = (s + min(4s / 3, u)) // 7 elements.  The elements
are dealt by hash to more than k partitions; all but k of those of two linked sets agree, and
the elements of an agreed partition are a signature both have.

A set with F partitions that are not empty thus shares F - k signatures at least with each
partner; `spare` is one less.  That guarantee gives three things, none of which loses a link:
- A pair that shares fewer signatures is no link, and its texts are not compared.
- Signatures of more than GROUP sets (*hot*, as of a passage that many texts quote) form no
  pairs but those with one member.  A set stays safe while no more of its signatures are hot
  than it has to spare.
- Sets that are not safe are members of large groups of copies which nearly link, or consist of
  shared passages.  Their components fall into clusters by the hot signatures they share; one
  that shares none with another component is done.  In a cluster the
  sets outside of its largest component are compared with all sets of similar size, block by
  block: a block holds about BLOCK count sketches, and only pairs that these allow go on.

Pairs are refuted by their sizes, then by count sketches (the counts of elements by hash differ
by no more than the sets do), and what is left is decided on the whole texts.  Exact copies are
one node wherever they are found: a task signs equal sets once.  No group is held in one task:
groups of a signature stream past, copies are hung on a smallest one by parts, and clusters are
cut into blocks.

Defined results: a null or empty text, or one of white space, has an empty set (n_shingles 0)
and links with nothing; fewer than five words give one shingle, the whole sequence.  Rows with
the same doc_id are one node, which links where any of their texts does.  A null doc_id keeps
its row with a null component.  An empty table gives an empty result.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from marketweave.llm import tokens
from marketweave.llm.components import components
from marketweave.llm.thin import thin
from marketweave.session import shared_dir, small_batches, stage

SHINGLE = 5
GROUP = 24  # members up to which a signature sends all its pairs
TEXT = 500_000  # bytes of text that are signed at once; the arrays take some 50 times that
GATHER = 200_000  # pairs a task gathers before it counts how often each comes
FLUSH = 400_000  # different pairs it holds before it sends them, each once with its count
SEND = 100_000  # pairs in a batch it sends
EXTRA = 4  # there are an EXTRA-th more partitions than sets can differ in
SEEDS = 6  # deals that are tried to find one with enough partitions that have elements
PARTS = 64  # parts of a class of copies
BLOCK = 64

_edges = [1]
while _edges[-1] < 2**40:
    _edges.append(max(_edges[-1] + 1, -(-_edges[-1] * 16 // 9)))
EDGES = np.array(_edges)


def band(size: int) -> int:
    return int(np.searchsorted(EDGES, size, side="right")) - 1


def bands(size: int) -> tuple[int, ...]:
    """The bands for which a set of this size signs."""
    own = band(size)
    return (own, own + 1) if size * 4 // 3 >= EDGES[own + 1] else (own,)


def most_apart(of: int, size: int | None = None) -> int:
    """Elements in which two linked sets that sign for a band differ at most; one has `size`."""
    upper = int(EDGES[of + 1]) - 1
    return (2 * upper if size is None else size + min(4 * size // 3, upper)) // 7


def sets(column: pa.Array):
    """The sorted distinct shingle values of each text."""
    found = tokens.words(column)
    values = tokens.hashes(found)
    runs = tokens.windows(values, SHINGLE)
    first = found.bounds()
    for i in range(len(first) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= SHINGLE:
            yield np.unique(runs[a : b - SHINGLE + 1])
        elif b > a:
            yield tokens.windows(values[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def _identity(members: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        one = tokens.mix(members + np.uint64(11)).sum(dtype=np.uint64)
        two = tokens.mix(members ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def sketch(members: np.ndarray) -> bytes:
    """Counts of elements by the first bits of their hash, in half as many buckets as elements
    or more; nothing if a count does not fit in a byte."""
    bits = max(4, len(members).bit_length() - 1)
    counts = np.bincount((members >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def apart(one: bytes, two: bytes) -> int:
    """Lower bound of the symmetric difference of the sets of two sketches."""
    if not one or not two:
        return 0
    a, b = np.frombuffer(one, np.uint8).astype(np.int32), np.frombuffer(two, np.uint8).astype(np.int32)
    size = min(len(a), len(b))
    return int(np.abs(a.reshape(size, -1).sum(axis=1) - b.reshape(size, -1).sum(axis=1)).sum())


def _parts(of: int) -> int:
    """Partitions of a band."""
    k = most_apart(of)
    return k + k // EXTRA + 1 + (k > 0)


def _seed(of: int, turn: int) -> int:
    return (of * 64 + turn) * 2 + 1


def signatures(every: list[np.ndarray], of: list[int], turn: int = 0) -> list[tuple[np.ndarray, int]]:
    """For each set and its band: the signatures of the deal `turn`, and how many of them it can
    spare: non-empty partitions, less those in which a linked set may differ, less one."""
    size = np.array([len(m) for m in every])
    width = np.array([_parts(b) for b in of])
    seed = np.array([_seed(b, turn) for b in of], np.uint64)
    begin = np.cumsum(width) - width
    member = np.concatenate(every)
    with np.errstate(over="ignore"):
        dealt = tokens.mix(member * np.repeat(seed, size) + np.uint64(turn))
        value = tokens.mix(member ^ np.repeat(tokens.mix(seed), size))
    place = ((dealt >> np.uint64(32)) * np.repeat(width, size).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    key = place + np.repeat(begin, size)
    count = np.bincount(key, minlength=int(width.sum()))
    full = np.flatnonzero(count)
    # Sums of halves are exact as floating-point numbers.
    low = np.bincount(key, (value & np.uint64(0xFFFFFFFF)).astype(float), len(count))[full].astype(np.uint64)
    high = np.bincount(key, (value >> np.uint64(32)).astype(float), len(count))[full].astype(np.uint64)
    owner = np.searchsorted(begin, full, side="right") - 1
    with np.errstate(over="ignore"):
        total = low + (high << np.uint64(32))
        found = tokens.mix(total * np.uint64(3) + tokens.mix(((full - begin[owner]).astype(np.uint64) << np.uint64(20)) + seed[owner]))
    edge = np.searchsorted(owner, np.arange(len(every) + 1))
    return [(found[edge[i] : edge[i + 1]], int(edge[i + 1] - edge[i]) - most_apart(of[i], len(every[i])) - 1) for i in range(len(every))]


def _sign(batches):
    """`sig, doc_id, spare, info`: the signatures of each set; for each document and band a row
    with what it has to spare; for each document a row with its set's size, identity and sketch.
    Of equal sets only the first one in the task signs."""
    schema = pa.schema([("sig", pa.int64()), ("doc_id", pa.int64()), ("spare", pa.int32()), ("info", pa.binary())])
    signed = set()
    for batch in batches:
        for part in tokens.chunks(batch, size=TEXT):
            rows, signing = [], []
            for doc, members in zip(part.column("doc_id").to_pylist(), sets(part.column("text"))):
                same = _identity(members)
                rows.append((same[0] ^ (doc or 0), doc, np.array([len(members), *same], np.int64).tobytes() + sketch(members)))
                if doc is not None and len(members) and same not in signed:
                    signed.add(same)
                    signing += [(doc, members, of) for of in bands(len(members))]
            sig, doc, info = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(doc, pa.int64()), pa.nulls(len(rows), pa.int32()), pa.array(info, pa.binary())], schema=schema)
            if not signing:
                continue
            docs, every, of = zip(*signing)
            sigs, lengths, spares = [], [], []
            for i, (found, spare) in enumerate(signatures(every, of)):
                mine, turn = [found], 1
                while spare < 0 and turn < SEEDS:
                    found, spare = signatures([every[i]], [of[i]], turn)[0]
                    # A partner may have stopped at an earlier deal, where this set counts on nothing.
                    spare = min(spare, 0)
                    mine.append(found)
                    turn += 1
                if spare < 0:
                    # No deal leaves enough partitions with elements: such sets of a band meet.
                    mine.append(tokens.mix(np.array([of[i] * 97 + 1], np.uint64)))
                    spare = 0
                sigs += mine
                lengths.append(sum(map(len, mine)))
                spares.append(spare)
            owners = np.repeat(np.array(docs, np.int64), lengths)
            n = len(owners)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(owners), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
            n = len(docs)
            spread = tokens.mix(np.array(docs, np.int64).view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(docs, pa.int64()), pa.array(spares, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)


PAIR, HOT, SPARE, SET = 0, 1, 2, 3
MANY = 1 << 40  # count of a pair that is compared in any case


def _meet(batches):
    """From rows sorted by signature: `kind, a, b, n, info`.

    PAIR: documents a > b and the signatures they share here; HOT: document a has the hot
    signature b; SPARE: what document a has to spare; SET: what there is of document a.  Holds one batch, the rows of one
    signature up to GROUP, FLUSH different pairs, and GATHER pairs that are not yet counted.
    """
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("info", pa.binary())])

    def rows(kind, a, b, n, info=None):
        info = pa.nulls(len(a), pa.binary()) if info is None else info
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(n), info], schema=schema)

    def counted():
        """How many different pairs there are; afterwards each is there once, with its count."""
        a, b, n = (np.concatenate(x) for x in zip(*gathered))
        gathered.clear()
        order = np.lexsort((b, a))
        a, b, n = a[order], b[order], n[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        gathered.append((a[first], b[first], np.add.reduceat(n, first)))
        return len(first)

    def flush():
        a, b, n = gathered.pop()
        for at in range(0, len(a), SEND):
            yield rows(PAIR, a[at : at + SEND], b[at : at + SEND], n[at : at + SEND])

    def gather(x, y, n):
        keep = x != y
        x, y = x[keep], y[keep]
        if len(x):
            gathered.append((np.maximum(x, y), np.minimum(x, y), np.full(len(x), n, np.int64)))
        return len(x)

    gathered, count = [], 0
    held_sig = held_doc = np.zeros(0, np.int64)
    hot = None  # signature and member of a group that began in an earlier batch
    for batch in batches:
        known = batch.column("info").is_valid()
        if batch.column("info").null_count < batch.num_rows:
            part = batch.filter(known)
            zero = np.zeros(part.num_rows, np.int64)
            yield rows(SET, part.column("doc_id"), zero, zero, part.column("info"))
            batch = batch.filter(pc.invert(known))
        told = batch.column("spare").is_valid()
        if batch.column("spare").null_count < batch.num_rows:
            part = batch.filter(told)
            doc = part.column("doc_id").to_numpy()
            yield rows(SPARE, doc, doc, part.column("spare").cast(pa.int64()))
            batch = batch.filter(pc.invert(told))
        sig, doc = batch.column("sig").to_numpy(), batch.column("doc_id").to_numpy()
        if hot is not None:
            same = sig == hot[0]
            if same.any():
                yield rows(HOT, doc[same], sig[same], np.zeros(same.sum(), np.int64))
                count += gather(doc[same], np.full(same.sum(), hot[1]), MANY)
            sig, doc = sig[~same], doc[~same]
        sig, doc = np.append(held_sig, sig), np.append(held_doc, doc)
        if not len(sig):
            continue
        at = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(at, len(sig)))
        # The last signature may go on in the next batch.
        last = at[-1]
        if size[-1] <= GROUP:
            held_sig, held_doc = sig[last:], doc[last:]
            sig, doc, at, size = sig[:last], doc[:last], at[:-1], size[:-1]
        else:
            held_sig = held_doc = np.zeros(0, np.int64)
            hot = (sig[last], doc[last])
        of = np.repeat(size, size)
        for part in _groups(sig, doc, at, size, of, gather):
            if isinstance(part, int):
                count += part
            else:
                yield rows(HOT, *part)
        if count >= GATHER:
            count = 0
            if counted() >= FLUSH:
                yield from flush()
    if len(held_sig):
        size = np.array([len(held_sig)])
        for part in _groups(held_sig, held_doc, np.array([0]), size, np.repeat(size, size), gather):
            count += part
    if gathered:
        counted()
        yield from flush()


def _groups(sig, doc, at, size, of, gather):
    """Gathers the pairs of whole groups; gives how many, and the members of hot ones."""
    small = of <= GROUP
    for step in range(1, min(GROUP, int(size.max(initial=1)))):
        keep = small[step:] & (sig[step:] == sig[:-step])
        if not keep.any():
            break
        yield gather(doc[step:][keep], doc[:-step][keep], 1)
    if not small.all():
        member, least = doc[~small], np.repeat(doc[at], size)[~small]
        yield member, sig[~small], np.zeros(len(member), np.int64)
        yield gather(member, least, MANY)


def _jaccard(batches):
    """Keeps the pairs whose whole texts link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        one, held = None, None
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            left, right = part.column("a").to_pylist(), sets(part.column("right"))
            keep = []
            for i, members in enumerate(right):
                if left[i] != one:
                    one, held = left[i], next(sets(part.column("left").slice(i, 1)))
                both = len(np.intersect1d(held, members, assume_unique=True))
                keep.append(len(held) > 0 and len(members) > 0 and 100 * both >= 75 * (len(held) + len(members) - both))
            if any(keep):
                part = part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=schema)


def _possible(batches):
    """Drops pairs that their sketches refute."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        most = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()) // 7
        keep = [apart(x.as_py(), y.as_py()) <= m for x, y, m in zip(batch.column("s_a"), batch.column("s_b"), most.tolist())]
        part = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=schema)


def _verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, root: str, name: str) -> DataFrame:
    """The pairs `a, b` whose documents link; sizes and sketches first, then the texts of the rest."""
    side = lambda s: nodes.select(F.col("doc_id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}"))
    known = pairs.join(side("a"), "a").join(side("b"), "b").filter("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
    with small_batches(docs.sparkSession):
        possible = stage(known.mapInArrow(_possible, "a long, b long"), f"possible_{name}", root)
    text = lambda s, c: docs.select(F.col("doc_id").alias(s), F.col("text").alias(c))
    wanted = stage(possible.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"wanted_{name}", root)
    docs = thin(docs, wanted)
    both = possible.join(text("b", "right"), "b").join(text("a", "left"), "a")
    with small_batches(docs.sparkSession):
        return stage(both.mapInArrow(_jaccard, "a long, b long"), f"links_{name}", root)


def _nodes(batches):
    """`doc_id, n_shingles, h1, h2, sketch` of SET rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sketch", pa.binary())])
    for batch in batches:
        info = batch.column("info").to_pylist()
        head = np.frombuffer(b"".join(x[:24] for x in info), np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([batch.column("a"), *map(pa.array, head.T.copy()), pa.array([x[24:] for x in info], pa.binary())], schema=schema)


def _copies(nodes: DataFrame) -> DataFrame:
    """Links `a, b` that connect equal sets: each to the smallest of its part, those to the smallest of all."""
    same = ["h1", "h2", "n_shingles"]
    nodes = nodes.select("doc_id", *same, F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).alias("part"))
    least = nodes.groupBy(*same, "part").agg(F.min("doc_id").alias("b"))
    first = least.groupBy(*same).agg(F.min("b").alias("b"))
    near = nodes.join(least, [*same, "part"]).select(F.col("doc_id").alias("a"), "b")
    far = least.withColumnRenamed("b", "a").join(first, same).select("a", "b")
    return near.unionByName(far).filter("a > b").distinct()


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    return np.stack([np.frombuffer(s, np.uint8).astype(np.int16).reshape(size, -1).sum(axis=1, dtype=np.int16) for s in sketches])


def _blocks(batches):
    """Pairs of a block of loose sets and a block of sets that their sketches do not refute."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        for loose, every in zip(batch.column("loose").to_pylist(), batch.column("every").to_pylist()):
            size = min(len(x["sketch"]) for x in (*loose, *every))
            one, two = ([np.array([x[c] for x in side]) for c in ("doc_id", "n", "c")] for side in (loose, every))
            n = one[1][:, None] + two[1][None, :]
            keep = (one[2][:, None] != two[2][None, :]) & (7 * np.abs(one[1][:, None] - two[1][None, :]) <= n)
            if size:  # else some counts do not fit in a sketch, which refutes nothing
                left, right = (_folded([x["sketch"] for x in side], size) for side in (loose, every))
                for i in np.flatnonzero(keep.any(axis=1)):
                    keep[i] &= 7 * np.abs(left[i] - right).sum(axis=1, dtype=np.int64) <= n[i]
            i, j = np.nonzero(keep)
            if len(i):
                a, b = one[0][i], two[0][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], schema=schema)


def _clustered(split: DataFrame, unsafe: DataFrame, nodes: DataFrame, root: str) -> DataFrame:
    """Pairs `a, b` of unsafe documents (`doc_id, c`) of one cluster and of different components.
    Components fall into clusters by the hot signatures they share (`split`: `sig, c`)."""
    least = split.groupBy("sig").agg(F.min("c").alias("b"))
    shared = split.join(least, "sig").select(F.col("c").alias("a"), "b").distinct()
    cluster = components(stage(shared, "shared", root), "a", "b").select(F.col("node").alias("c"), F.col("component").alias("cluster"))
    # Sizes of linked sets are within 4 / 3, three of these steps at most.
    step = F.floor(F.log("n_shingles") / F.log(F.lit(4 / 3)) * 2).cast("int")
    kept = unsafe.join(cluster, "c").join(nodes.select("doc_id", "n_shingles", "sketch"), "doc_id")
    kept = stage(kept.select("cluster", step.alias("step"), "doc_id", F.col("n_shingles").alias("n"), "c", "sketch"), "members", root)
    counts = kept.groupBy("cluster", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(F.max(F.struct("n", "c"))["c"].alias("main"))
    slots = kept.groupBy("cluster", "step").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("slots"))
    kept = kept.join(slots, ["cluster", "step"]).join(counts, "cluster")
    kept = kept.withColumn("slot", F.pmod(F.xxhash64("doc_id"), "slots"))
    row = F.collect_list(F.struct("doc_id", "n", "c", "sketch"))
    every = stage(kept.groupBy("cluster", "step", "slot").agg(row.alias("every")).drop("slot"), "blocks", root)
    loose = kept.filter("c <> main").groupBy("cluster", "step", "slot").agg(row.alias("loose")).drop("slot")
    loose = loose.withColumn("step", F.explode(F.sequence(F.col("step") - 3, F.col("step") + 3)))
    pairs = loose.join(every, ["cluster", "step"]).select("loose", "every").mapInArrow(_blocks, "a long, b long")
    return pairs.distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id` of each row of `docs` (`doc_id`, `text`)."""
    spark = docs.sparkSession
    root = shared_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = docs.mapInArrow(_sign, "sig long, doc_id long, spare int, info binary")
    rows = rows.repartition("sig").sortWithinPartitions("sig")
    with small_batches(spark):
        met = stage(rows.mapInArrow(_meet, "kind int, a long, b long, n long, info binary"), "met", root)
    every = met.filter(F.col("kind") == SET).select("a", "info").mapInArrow(_nodes, "doc_id long, n_shingles long, h1 long, h2 long, sketch binary")
    every = stage(every, "sets", root)
    nodes = every.filter("doc_id is not null and n_shingles > 0")
    found = [stage(_copies(nodes), "copies", root)]

    hot = met.filter(F.col("kind") == HOT).select(F.col("a").alias("doc_id"), F.col("b").alias("sig"))
    spare = met.filter(F.col("kind") == SPARE).groupBy(F.col("a").alias("doc_id")).agg(F.min("n").alias("spare"))
    heat = hot.groupBy("doc_id").agg(F.count(F.lit(1)).alias("h"))
    sizes = nodes.groupBy("doc_id").agg(F.max("n_shingles").alias("n"), F.count_distinct("n_shingles").alias("texts"))
    # What a linked pair shares at least, besides hot signatures; several texts of one id count on nothing.
    need = F.when(F.col("texts") > 1, 0).otherwise(F.col("spare") + 1 - F.coalesce("h", F.lit(0)))
    needs = stage(spare.join(heat, "doc_id", "left").join(sizes, "doc_id").select("doc_id", F.col("n").alias("size"), need.alias("need"), "texts"), "needs", root)
    side = lambda c: needs.select(F.col("doc_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("size", "need", "texts")])
    pairs = met.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("n")).join(side("a"), "a").join(side("b"), "b")
    need = F.when(F.col("size_a") > F.col("size_b"), F.col("need_a")).when(F.col("size_a") < F.col("size_b"), F.col("need_b")).otherwise(F.greatest("need_a", "need_b"))
    # Several texts of one id have sizes of their own, which the verification knows.
    sized = (4 * F.least("size_a", "size_b") >= 3 * F.greatest("size_a", "size_b")) | (F.greatest("texts_a", "texts_b") > 1)
    pairs = pairs.filter(((F.col("n") >= need) | (F.greatest("texts_a", "texts_b") > 1)) & sized).select("a", "b")
    found.append(_verify(pairs, nodes, docs, root, "pairs"))

    joined = stage(components(_union(found), "a", "b").withColumnRenamed("node", "doc_id"), "joined", root)
    # Documents with more hot signatures than they can spare, and the components that meet in one.
    unsafe = needs.filter("need <= 0").select("doc_id").join(joined, "doc_id", "left")
    unsafe = stage(unsafe.select("doc_id", F.coalesce("component", "doc_id").alias("c")), "unsafe", root)
    met_in = stage(hot.join(unsafe, "doc_id").select("sig", "c").distinct(), "met_in", root)
    several = met_in.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("sig")
    split = stage(met_in.join(several, "sig"), "split", root)
    if not split.isEmpty():
        rest = _verify(_clustered(split, unsafe, nodes, root), nodes, docs, root, "rest")
        if not rest.isEmpty():
            joined = stage(components(_union([*found, rest]), "a", "b").withColumnRenamed("node", "doc_id"), "rejoined", root)
    out = every.select("doc_id", "n_shingles").join(joined, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, with all columns; rows without an
    id and empty texts stay. Of rows that repeat an id and a text one stays."""
    group = jaccard_components(docs).select(F.col("doc_id").alias("_id"), "component_id").distinct()
    gone = group.filter("component_id < _id").select("_id")
    rest = docs.join(gone, docs["doc_id"] == gone["_id"], "left_anti")
    # The join has dealt the rows by their ids, so this moves nothing again.
    return rest.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null"))
