"""Near copies by SetSketch registers.

Every shingle is the start of its own fixed stream of exponentially spaced arrival times, each with a
register.  A register keeps the earliest arrival over a document's shingles; its level, the truncated
logarithm of that time, is the stored value, so sketches of parts merge by the maximum level.  Equal
levels get likelier with similarity: bands of registers gather candidates, the joint likelihood of two
sketches drops the clearly different ones, and the full sets decide."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from procurelytics.llm.common import SPACE, SPACE_CHARS, bounded_batches, giving_back, whole_text
from procurelytics.session import cut_lineage, cut_result

#: Base of the levels, rate of arrivals per register, and the range levels are truncated to.
BASE, RATE, TOP = 1.02, 20.0, 65_534
#: A linked pair misses all bands with a chance under (1 - 0.8^ROWS)^BANDS, about 4e-7; equal levels
#: of different minima make it smaller still.
ROWS, BANDS = 6, 48
REGISTERS = ROWS * BANDS
#: Documents and shingles that are sketched at a time (about 100 bytes a shingle).
SKETCHED, SKETCHED_SHINGLES = 500, 200_000
#: The estimate may lie this far under the threshold before a pair is dropped unverified (about seven
#: standard deviations of the estimate at the threshold).
ESTIMATE_SLACK = 0.18
#: Where at most so many documents lie outside a group's component, they are compared with all of it.
FEW_OUTSIDE = 16
#: Links that one task shrinks without a shuffle; more are dealt.
FEW_LINKS = 20_000
#: Most ids that are broadcast to pick texts (8 bytes each).
BROADCAST_IDS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower_ascii(text):
    """A-Z in lower case, all else as it is."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles): the distinct ``size``-word shingles of the whole text as sorted 64-bit
    hashes; a text with fewer words is one shingle, a text without words has none."""
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.explode(F.array(F.split(F.btrim(_lower_ascii(whole_text("text")), F.lit(SPACE_CHARS)), SPACE))).alias("w"))
    n = F.size("w")
    many = F.sort_array(F.array_distinct(F.slice(F.transform("w", lambda x, i: F.xxhash64(x, *[F.get("w", i + k) for k in range(1, size)])), F.lit(1), F.greatest(n - (size - 1), F.lit(0)))))
    few = F.array(F.xxhash64("w"))
    none = F.array().cast("array<bigint>")
    return words.select("doc_id", F.when(n >= size, many).when(F.get("w", F.lit(0)) == "", none).otherwise(few).alias("shingles"))


# --- registers ----------------------------------------------------------------------
_GOLD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def sketch(shingles: np.ndarray, owner: np.ndarray, documents: int, registers: int = REGISTERS) -> np.ndarray:
    """Levels (documents x registers, uint16) of the sets given as (shingle, owner) pairs.

    Arrivals of a shingle form a Poisson stream over all registers, so the first arrival of each
    register is exponential and independent of the others.  A shingle is done when its next arrival
    is later than every register's earliest one of its document."""
    earliest = np.full((documents, registers), np.inf)
    flat = earliest.reshape(-1)
    with np.errstate(over="ignore"):
        state, time, at = _mixed(shingles.view(np.uint64) + _GOLD), np.zeros(len(shingles)), owner.astype(np.int64)
        step = 0
        while len(state):
            state = state + _GOLD
            draw = _mixed(state)
            time = time - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            register = (_mixed(draw ^ _M2) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(flat, at * registers + register, time)
            step += 1
            if step < 8 or step % 8 == 0:  # the bound moves slowly later on
                going = time < earliest.max(1)[at]
                state, time, at = state[going], time[going], at[going]
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(earliest / (registers * RATE)) / math.log(BASE))
    return np.clip(level, 0, TOP).astype(np.uint16)


def joint_similarity(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, least: float | None = None) -> float:
    """The Jaccard similarity that makes the numbers of registers with a greater, equal and smaller
    level likeliest, given the set sizes: each comparison has probability p(u - v J), p(v - u J) and
    the rest, where u, v are the shares of the two sizes in
    their sum.  With ``least``: 1.0 if that maximum lies at ``least`` or above, else 0.0."""
    greater, smaller = int((a > b).sum()), int((a < b).sum())
    equal, log_b = len(a) - greater - smaller, math.log(BASE)
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)

    def p(x):  # chance that a level exceeds another by its own part x of the union
        return -math.log1p(-x * (BASE - 1) / BASE) / log_b

    def likelihood(j):
        up, down = p(max(u - v * j, 0.0)), p(max(v - u * j, 0.0))
        same = 1 - up - down
        if (greater and up <= 0) or (smaller and down <= 0) or (equal and same <= 0):
            return -math.inf
        return sum(n * math.log(q) for n, q in ((greater, up), (smaller, down), (equal, same)) if n)

    if least is not None:  # concave: the maximum lies above where the likelihood still rises
        return 1.0 if likelihood(least + 1e-3) >= likelihood(least) else 0.0
    low, high = 0.0, min(u / v, v / u)
    for _ in range(40):  # the likelihood is concave
        a_third, b_third = low + (high - low) / 3, high - (high - low) / 3
        if likelihood(a_third) < likelihood(b_third):
            low = a_third
        else:
            high = b_third
    return (low + high) / 2


def _flat(column):
    """Values and lengths of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths().fill_null(0))


def _levels(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sketches of the sets that end at ``ends`` in ``values``, a bounded number of shingles at a time; the
    parts of a set that is larger merge by the maximum."""
    levels = np.zeros((len(ends), REGISTERS), np.uint16)
    for low in range(0, len(values), SKETCHED_SHINGLES):
        part = values[low : low + SKETCHED_SHINGLES]
        owner = np.searchsorted(ends, np.arange(low, low + len(part)), "right")
        first, last = int(owner[0]), int(owner[-1]) + 1
        np.maximum(levels[first:last], sketch(part, owner - first, last - first), out=levels[first:last])
    return levels


def sketches(sets: DataFrame) -> DataFrame:
    """(doc_id, k, registers): what identifies each set, and its sketch as binary; both NULL for an
    empty set."""
    key = F.struct(F.size("shingles").alias("n"), F.xxhash64("shingles").alias("h1"), F.hash("shingles").alias("h2"), F.get("shingles", F.lit(0)).alias("s"))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SKETCHED):
                part = batch.slice(start, SKETCHED)
                values, sizes = _flat(part.column(1))
                levels = _levels(values, np.cumsum(sizes))
                registers = pa.array([r.tobytes() if n else None for r, n in zip(levels, sizes)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], registers], names=["doc_id", "n", "h1", "h2", "s", "registers"])

    found = sets.select("doc_id", "shingles", key.alias("k")).select("doc_id", "shingles", "k.*").mapInArrow(giving_back(run), "doc_id long, n int, h1 long, h2 int, s long, registers binary")
    return found.select("doc_id", F.when(F.col("n") > 0, F.struct("n", "h1", "h2", "s")).alias("k"), "registers")


def band_keys(sketched: DataFrame) -> DataFrame:
    """(bucket, doc_id): one row per document and band."""
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("registers", i * width + 1, F.lit(width))))
    return sketched.select("doc_id", F.explode(keys).alias("bucket"))


# --- components ---------------------------------------------------------------------
def _least_reachable(links: DataFrame) -> DataFrame:
    """(doc_id, component) of the ends of ``links`` (a, b) that are not their component's least id.
    Labels and links shrink together: each round, links move to the least neighbour of their ends until
    none is left."""
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())

    def marked(df):
        """Distinct links: an equal number with an equal 64-bit sum means that nothing moved."""
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    state = marked(edges)
    while True:
        if state[0] <= FEW_LINKS:
            edges = edges.coalesce(1)
        # large star: every neighbour above a node hangs on the node's least neighbour
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: a node and its lower neighbours hang on the least of them
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi <> lo").distinct()
        edges, before = cut_lineage(small), state
        state = marked(edges)
        if state == before:
            break
    return edges.groupBy(F.col("hi").alias("doc_id")).agg(F.min("lo").alias("component"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``component``: the least id reachable from doc_id over ``links`` (a, b)."""
    return nodes.join(_least_reachable(links), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


# --- links --------------------------------------------------------------------------
def _likely(pairs: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and joint likelihood allow a similarity of ``percent``."""
    left = sketched.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = sketched.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    least = percent / 100 - ESTIMATE_SLACK

    def run(batches):
        for batch in batches:
            columns = batch.to_pydict()
            keep = [joint_similarity(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), m, n, least) > 0
                    for x, y, m, n in zip(columns["ra"], columns["rb"], columns["na"], columns["nb"])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return joined.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(giving_back(run), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(giving_back(run), "a long, b long")


def _sharing_differences(crowded: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): every pair of documents of a group (largest, hub, doc_id, component) that can be linked, one of
    them outside the group's component ``largest``.

    Documents differ from the group's hub in a set of shingles, added or missing, and from each other in
    what these sets do not share.  So two that are d and f away from the hub and linked share at least
    (d + f - the most that linked ones differ) / 2 of their differences; with those of a group put in
    one order, the rarest first, they share one within the first places that this leaves.  A document that is
    not linked to the hub has so large a d that its partner needs only about half of its places,
    which are its own rare ones."""
    core = crowded.where("doc_id = hub").select("largest", "hub").join(sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("core")), "hub")
    away = crowded.drop("hub", "n").join(sets, "doc_id").join(core, "largest").select(
        "largest", "hub", "doc_id", "component", F.size("shingles").alias("n"), F.size("core").alias("of"),
        F.concat(F.array_except("shingles", "core"), F.array_except("core", "shingles")).alias("differs"))
    away = cut_lineage(away.withColumn("d", F.size("differs")))
    part, whole = 100 - percent, 100 + percent  # linked: whole * difference <= part * (sum of the sizes)
    outside, far = F.col("component") != F.col("largest"), F.col("d") * whole > (F.col("n") + F.col("of")) * part

    each = away.select("largest", "doc_id", "component", "n", "of", "d", F.explode("differs").alias("s"))
    times = each.groupBy("largest", "s").agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy("largest", "doc_id").orderBy("times", "s"))
    placed = cut_lineage(each.join(times, ["largest", "s"]).withColumn("place", place).where("times > 1"))
    ours = placed.where(outside & far & ((F.col("place") - 1) * percent <= F.col("n") * part))
    theirs = placed.where((F.col("place") - 1) * 2 * whole <= F.col("d") * whole + F.greatest(F.col("n") - F.col("of"), F.lit(0)) * part)
    side = lambda rows, x: rows.select("largest", "s", *[F.col(c).alias(c + x) for c in ("doc_id", "component", "n", "d", "place")])
    # twice as many as must be shared, times ``whole``
    shared = (F.col("da") + F.col("db")) * whole - (F.col("na") + F.col("nb")) * part
    fits = [shared <= (F.col(f"d{x}") - F.col(f"place{x}") + 1) * 2 * whole for x in "ab"]
    pairs = side(ours, "a").join(side(theirs, "b"), ["largest", "s"]).where((F.col("componenta") != F.col("componentb")) & fits[0] & fits[1])
    to_hub = away.where(outside & ~far).select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))
    return pairs.select(F.col("doc_ida").alias("a"), F.col("doc_idb").alias("b")).unionByName(to_hub)


def near_components(docs: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents linked where 100 * shared >= percent * union of
    their shingle sets, directly or over others; component_id is the least doc_id reachable.

    NULL, empty and wordless texts have no shingles and are linked with nothing.  Equal sets are one
    class from the start, so copies never meet in a bucket.  Rows that repeat a doc_id give one row,
    of which the least set counts; rows without doc_id are left out; other columns are not read; an
    empty table gives no rows.

    Every bucket is first linked to one member, the one that meets most others over all its buckets:
    a star, not all pairs, and the origin of a group of copies is its centre.  Buckets that still
    hold several components are put together by the largest one of each.  Where few documents of such a group lie
    outside that component, they are compared with all others of other components; where many do,
    with those that share enough of what sets them apart from the group's hub (see
    ``_sharing_differences``).  No pair that shares a bucket and could be linked is left out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    base = cut_lineage(sketches(shingle_sets(docs.where("doc_id is not null").select("doc_id", "text"), shingle)))
    keyed = base.groupBy("doc_id").agg(F.min("k").alias("k"))
    classes = cut_lineage(keyed.where("k is not null").groupBy("k").agg(F.min("doc_id").alias("rep")))
    reps = classes.select(F.col("rep").alias("doc_id"), "k.n")
    chosen = base.join(classes.select(F.col("rep").alias("doc_id"), F.col("k").alias("of")), "doc_id").where(F.col("k") == F.col("of"))
    sketched = cut_lineage(chosen.groupBy("doc_id").agg(F.first("k.n").alias("n"), F.first("registers").alias("registers")))
    buckets = band_keys(sketched)
    shared = cut_lineage(buckets.join(buckets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "bucket"))

    def sets_of(ids: DataFrame) -> DataFrame:
        """The full sets of some documents; their ids are broadcast behind a check of their number,
        else joined by shuffle."""
        ids = cut_lineage(ids.distinct())
        if ids.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
        least = F.struct(F.size("shingles"), F.xxhash64("shingles"), F.hash("shingles"), F.get("shingles", F.lit(0)))
        return cut_lineage(shingle_sets(texts, shingle).groupBy("doc_id").agg(F.min_by("shingles", least).alias("shingles")))

    degree = shared.groupBy("doc_id").agg(F.sum("m").alias("met"))
    ranked = cut_lineage(shared.select("bucket", "doc_id").join(degree, "doc_id"))
    centre = ranked.groupBy("bucket").agg(F.max_by("doc_id", F.struct("met", -F.col("doc_id"))).alias("b"))
    pairs = ranked.join(centre, "bucket").where("doc_id <> b").select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b"))
    likely = cut_lineage(_likely(pairs.distinct(), sketched, percent))
    links = cut_lineage(_confirmed(likely, sets_of(likely.select(F.explode(F.array("a", "b")).alias("doc_id"))), percent))

    found = cut_lineage(components(reps, links))
    members = ranked.join(found, "doc_id")
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("m", "component")).alias("largest"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    mixed = cut_lineage(members.join(largest, "bucket").select("largest", "doc_id", "component", "n", "met").distinct())
    counted = mixed.groupBy("largest").agg(F.count_if(F.col("component") != F.col("largest")).alias("out"), F.max_by(
        "doc_id", F.when(F.col("component") == F.col("largest"), F.struct("met", -F.col("doc_id")))).alias("hub"))
    mixed = cut_lineage(mixed.join(counted, "largest"))
    few = mixed.where(F.col("out") <= FEW_OUTSIDE)
    outside = few.where("component <> largest").select("largest", F.col("doc_id").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"))
    others = few.select("largest", F.col("doc_id").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"))
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    pairs = outside.join(others, "largest").where((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("largest")) | (F.col("a") < F.col("b"))) & near).select("a", "b")
    crowded = mixed.where(F.col("out") > FEW_OUTSIDE)
    sets = sets_of(mixed.select("doc_id"))
    pairs = pairs.unionByName(_sharing_differences(crowded, sets, percent))
    likely = cut_lineage(_likely(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), sketched, percent))
    late = cut_lineage(_confirmed(likely, sets, percent))
    if late.count():  # they join whole components
        label = lambda x: found.select(F.col("doc_id").alias(x), F.col("component").alias(f"{x}_in"))
        late = late.join(label("a"), "a").join(label("b"), "b").select(F.col("a_in").alias("a"), F.col("b_in").alias("b"))
        moved = _least_reachable(late).select(F.col("doc_id").alias("component"), F.col("component").alias("to"))
        found = found.join(moved, "component", "left").withColumn("component", F.coalesce("to", "component"))
    of_class = classes.join(found.withColumnRenamed("doc_id", "rep"), "rep").select("k", F.col("component").alias("component_id"))
    return keyed.join(of_class, "k", "left").select("doc_id", F.coalesce("k.n", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_dup_rows(docs: DataFrame) -> DataFrame:
    return near_components(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near copies of a document with a smaller id.  Rows without doc_id have
    no group and stay; of rows that repeat a doc_id all stay or go together."""
    gone = cut_result(docs.sparkSession, lambda: near_components(docs.select("doc_id", "text"), shingle, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")))
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
