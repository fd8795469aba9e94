"""Near-duplicate documents by ProbMinHash over five-word shingles.

Sketch.  Each distinct shingle of a text is a Poisson process: its arrivals come at the
rate of its weight, and each arrival falls into a random register.  A register keeps the
shingle that arrived first.  Two texts agree in a register with their probability Jaccard
similarity, each register by itself.  A shingle is followed only while its next arrival
can still be the first anywhere, so after its first few arrivals almost all work ends.

Candidates.  Registers form bands; texts that agree in a band share a bucket.  A shingle
weighs 1 + ln(count), so a text has the bands of its weighted shingles, and beside them
those of its set, in which all weigh alike; where no shingle occurs more often than
another the two are the same and stand once.  Texts with the same set of shingles are one
node, so copies never meet as pairs; it has the bands and counts of its smallest row.

Verification is exact: two nodes are linked if the probability Jaccard similarity of their
weighted shingles, or the Jaccard similarity of their sets, is 0.8 or more.

Pairs.  Within a bucket each node is first compared with the bucket's smallest one only,
and verified links are joined to components.  Then only nodes that share a bucket but not
a component are compared with each other.  So a large group of near copies costs links in
proportion to its size, and still no candidate pair is left out that could join two
components.  Each node carries an odd sketch for that: one bit for each of 2048 classes of
shingles, 1 if it holds an odd number of the class.  Where two sketches differ in d bits,
the sets differ in d shingles at least, so the join itself drops pairs that are surely too
far apart, and never one that is near enough (by either similarity: a shingle weighs 1 at
least, and probability Jaccard is at most 1 less the share of weight that is not common).
32 bands of 5 registers miss a pair at 0.8 about three times in a million,
(1 - 0.8 ** 5) ** 32, and nearer ones less often.
"""

from __future__ import annotations

import functools
import hashlib
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, steps
from .components import components
from .words import factors, mix, windows, words_of

SHINGLE = 5
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: 0.8 as whole numbers: common / (all) >= 4 / 5.
NUMERATOR, DENOMINATOR = 4, 5
#: Bits of the odd sketch.
ODD_BITS = 2048
#: Nodes to compare whose keys are sent to every task up to this number, else joined.
BROADCAST_ROWS = 1_000_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles: text, hash and count, ordered by text and hash.

    A text of fewer than five words, but not none, is one shingle.
    """
    words = words_of(column)
    hashes, doc = words.hashes(), words.doc
    found, places = windows(hashes, doc, SHINGLE)
    owner = doc[places]
    counts = words.counts()
    first = np.cumsum(counts) - counts
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        if len(short):
            total = np.full(len(short), np.uint64(size), np.uint64)
            for k in range(size):
                total += hashes[first[short] + k] * factors(SHINGLE, 4)[k]
            found, owner = np.concatenate([found, mix(total)]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    return owner[starts], found[starts], np.diff(np.append(starts, len(found)))


def sketch(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """Registers of each text: the shingle that arrived first, 0 for texts without any."""
    arrived = np.full(docs * REGISTERS, np.inf)
    holder = np.zeros(docs * REGISTERS, np.uint64)
    element, owner, rate = shingle, doc * REGISTERS, weight
    time, step = np.zeros(len(element)), 0
    while len(element):
        # Few processes left: follow each for several arrivals at once.
        block = int(np.clip(100_000 // len(element), 1, 64))
        number = (np.arange(step + 1, step + block + 1, dtype=np.uint64) * _GOLDEN)[None, :]
        drawn = mix(element[:, None] + number)
        wait = -np.log(((drawn >> np.uint64(16)).astype(np.float64) + 0.5) * 2.0**-48) / rate[:, None]
        times = time[:, None] + np.cumsum(wait, axis=1)
        register = ((drawn & np.uint64(0xFFFF)) * np.uint64(REGISTERS) >> np.uint64(16)).astype(np.int64) + owner[:, None]
        row, column = np.nonzero(times < arrived[register])
        place, when = register[row, column], times[row, column]
        late_first = np.lexsort((element[row], -when))  # of several to one register the earliest is written last
        arrived[place[late_first]] = when[late_first]
        holder[place[late_first]] = element[row[late_first]]
        time, step = times[:, -1], step + block
        limit = arrived.reshape(docs, REGISTERS).max(axis=1)
        going = time < limit[owner // REGISTERS]
        element, owner, rate, time = element[going], owner[going], rate[going], time[going]
    return holder.reshape(docs, REGISTERS)


def weights_of(doc: np.ndarray, counts: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each shingle, and which texts have different ones.  Equal weights are 1."""
    ends = np.cumsum(np.bincount(doc, minlength=docs))
    mixed = np.zeros(docs, bool)
    if len(doc):
        some = np.flatnonzero(np.diff(np.append(0, ends)))
        first = np.append(0, ends[:-1])[some]
        mixed[some] = np.minimum.reduceat(counts, first) != np.maximum.reduceat(counts, first)
    return np.where(mixed[doc], 1 + np.log(counts), 1.0), mixed


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two rows of weights over the same shingles (0 where one lacks it):
    the sum over common i of 1 / sum over j of max(x[j] / x[i], y[j] / y[i])."""
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    common = np.flatnonzero((x > 0) & (y > 0))
    # up to i in this order y[j] / y[i] is the larger one, behind it x[j] / x[i]
    below, above = np.cumsum(y)[common], x.sum() - np.cumsum(x)[common]
    return float((1 / (below / y[common] + above / x[common])).sum())


def _bands(shingle: np.ndarray, owner: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    registers = sketch(owner, shingle, weight, docs)
    return mix((mix(registers).reshape(docs, BANDS, ROWS) * factors(ROWS, 5)).sum(axis=2, dtype=np.uint64) + factors(BANDS, 6))


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``k`` (the key), ``h`` (a hash of the text), ``digest`` (of the set of
    shingles; of the text itself where it has no word), ``size`` (number of shingles),
    ``weight`` (all of them, rounded up), ``bands`` (bucket keys, none without words; of the set,
    then of the weighted shingles where these weigh differently) and ``odd`` (the odd sketch)."""
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t")).select("k", F.xxhash64("t").alias("h"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 2):
            n = batch.num_rows
            doc, shingle, counts = shingles_of(batch.column(2))
            weight, mixed = weights_of(doc, counts, n)
            size = np.bincount(doc, minlength=n)
            ends = np.cumsum(size)
            digest = [
                hashlib.blake2b(shingle[b - s : b].tobytes() if s else b"text" + (value or "").encode(), digest_size=16).digest()
                for s, b, value in zip(size.tolist(), ends.tolist(), batch.column(2).to_pylist())
            ]
            some = np.flatnonzero(size)
            number = np.zeros(n, np.int64)
            number[some] = np.arange(len(some))
            sets = _bands(shingle, number[doc], np.ones(len(shingle)), len(some))
            other = np.flatnonzero(mixed)
            place = np.zeros(n, np.int64)
            place[other] = np.arange(len(other))
            uneven = mixed[doc]
            bands = np.empty((len(some) + len(other), BANDS), np.uint64)
            at = np.arange(len(some)) + np.cumsum(mixed[some]) - mixed[some]
            bands[at] = sets
            bands[at[mixed[some]] + 1] = _bands(shingle[uneven], place[doc[uneven]], weight[uneven], len(other))
            classes_of = (mix(shingle + _GOLDEN) % np.uint64(ODD_BITS)).astype(np.int64) + number[doc] * ODD_BITS
            odd = np.packbits((np.bincount(classes_of, minlength=len(some) * ODD_BITS) & 1).astype(np.uint8)).view(np.int64)
            has = (size > 0).astype(np.int32)
            band_list = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((has + mixed) * BANDS)]), pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))
            whole = np.ceil(np.bincount(doc, weight, minlength=n)).astype(np.int64)
            odd_list = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * (ODD_BITS // 64))]), pa.int32()), pa.array(odd))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(whole), band_list, odd_list],
                names=["k", "h", "digest", "size", "weight", "bands", "odd"])

    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, h bigint, digest binary, size bigint, weight bigint, bands array<bigint>, odd array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``nid``, its sorted shingles, and their weights (null if all are equal) for nodes in
    ``wanted`` (``nid``, ``k``, ``h``)."""
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    other = wanted.select("nid", F.col("k").alias("k2"), F.col("h").alias("h2"))
    chosen = rows.join(other, (rows.h == other.h2) & rows.k.eqNullSafe(other.k2)).select("nid", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            doc, shingle, counts = shingles_of(batch.column(1))
            weight, mixed = weights_of(doc, counts, batch.num_rows)
            ends = np.append(0, np.cumsum(np.bincount(doc, minlength=batch.num_rows)))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shingle.view(np.int64)))
            packed = [weight[a:b].astype("<f8").tobytes() if m else None for a, b, m in zip(ends, ends[1:], mixed)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(packed, pa.binary())], names=["nid", "shingles", "weights"])

    return chosen.mapInArrow(run, "nid bigint, shingles array<bigint>, weights binary").dropDuplicates(["nid"])


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with their shingles, those that are near by weight; pairs without are near by their sets."""
    for batch in batches:
        near = np.ones(batch.num_rows, bool)
        for n, x in enumerate(batch.column(2)):
            if not x.is_valid:
                continue
            own = [np.asarray(batch.column(c)[n].values) for c in (2, 3)]
            every = np.union1d(*own)
            rows = np.zeros((2, len(every)))
            for row, shingles, packed in zip(rows, own, (batch.column(4)[n], batch.column(5)[n])):
                row[np.searchsorted(every, shingles)] = np.frombuffer(packed.as_buffer(), "<f8") if packed.is_valid else 1.0
            near[n] = probability_jaccard(*rows) >= NUMERATOR / DENOMINATOR
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Those of the pairs (``a``, ``b``) that are similar enough, by their sets or by weight."""
    ids = pairs.select(F.col("a").alias("nid")).union(pairs.select(F.col("b").alias("nid"))).distinct()
    wanted = materialize(nodes.select("nid", "k", "h").join(ids, "nid", "left_semi"), label)
    sets = materialize(_sets(docs, wanted, key, text), label)
    left = sets.select(F.col("nid").alias("a"), F.col("shingles").alias("x"), F.col("weights").alias("u"))
    right = sets.select(F.col("nid").alias("b"), F.col("shingles").alias("y"), F.col("weights").alias("v"))
    common = F.size(F.array_intersect("x", "y"))
    every = F.size("x") + F.size("y") - common
    both = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("near", DENOMINATOR * common >= NUMERATOR * every)
    both = both.where("near OR u IS NOT NULL OR v IS NOT NULL")
    rest = both.select("a", "b", *(F.when(~F.col("near"), F.col(c)).alias(c) for c in ("x", "y", "u", "v")))
    return materialize(rest.mapInArrow(_weighed, "a bigint, b bigint"), label)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: the key, ``class_id`` and ``copy_id``.

    ``copy_id`` is the smallest key among texts with the same shingles (copies, up to case
    and marks), ``class_id`` the smallest among all that verified links tie together; each
    is null only if no member has a key.  Null and empty texts are copies of each other;
    texts without a word are copies if they are equal.  Repeated rows are copies; an empty
    table gives no row.  Other columns are not read.
    """
    rows = materialize(sketches(docs, key, text), "sketches")
    nodes, pairs = _nodes(rows)
    comp = _components(nodes, pairs, docs, key, text)
    members = nodes.select("nid", "digest", F.col("k").alias("copy_id")).join(comp.withColumnRenamed("id", "nid"), "nid", "left")
    members = members.withColumn("comp", F.coalesce("comp", "nid"))
    least = members.groupBy("comp").agg(F.min("copy_id").alias("class_id"))
    named = materialize(members.join(least, "comp").select("digest", "copy_id", "class_id"), "classes")
    return rows.select("k", "digest").join(named, "digest").select(F.col("k").alias(key), "class_id", "copy_id")


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per set of shingles with a number, and the buckets (``bucket``, ``nid``,
    ``size``, ``odd``)."""
    nodes = rows.groupBy("digest").agg(
        F.min(F.struct(F.col("k").isNull().alias("z"), "k", "h", "weight", "bands")).alias("rep"),
        F.first("size").alias("size"), F.first("odd").alias("odd"),
    ).select("digest", "rep.k", "rep.h", "rep.weight", "size", "rep.bands", "odd")
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")  # written, so the numbers stay
    return nodes, nodes.select(F.explode(F.array_distinct("bands")).alias("bucket"), "nid", "size", "weight")


def _components(nodes: DataFrame, buckets: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``comp`` of the nodes that verified links join to others."""
    leaders = buckets.groupBy("bucket").agg(F.min("nid").alias("leader"), F.count("nid").alias("n")).where("n > 1").select("bucket", "leader")
    leaders = materialize(leaders, "leaders")
    shared = materialize(buckets.join(leaders, "bucket"), "buckets")  # rows of buckets with company
    first = materialize(shared.where("nid <> leader").select(F.col("leader").alias("a"), F.col("nid").alias("b")).distinct(), "pairs")
    links = _linked(first, nodes, docs, key, text, "links")
    comp = components(links)

    # Nodes in one bucket but in different components: all of them are compared.
    rest = shared.join(comp.withColumnRenamed("id", "nid"), "nid", "left").withColumn("comp", F.coalesce("comp", "nid"))
    mixed = rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    mixed = materialize(mixed, "mixed")
    rest = rest.where("nid <> leader").join(mixed, "bucket", "left_semi")  # pairs with a leader are done
    rest = materialize(rest.join(nodes.select("nid", "odd", "bands"), "nid"), "rest")
    x, y = rest.alias("x"), rest.alias("y")
    differing = functools.reduce(operator.add, (F.bit_count(F.col("x.odd")[i].bitwiseXOR(F.col("y.odd")[i])) for i in range(ODD_BITS // 64)))
    small, large = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    # common / every >= n / d as bounds on the sizes and on the number of shingles in one set only
    by_sets = (DENOMINATOR * small >= NUMERATOR * large) & ((DENOMINATOR + NUMERATOR) * differing <= (DENOMINATOR - NUMERATOR) * (small + large))
    # the same by weight, where it differs from the size: what is not common weighs 1 a shingle at least
    whole = F.col("x.weight") + F.col("y.weight")
    by_weight = (whole > small + large) & (DENOMINATOR * differing <= (DENOMINATOR - NUMERATOR) * whole)
    # of the buckets that a pair shares one gives it
    near = (
        (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.comp") < F.col("y.comp")) & (by_sets | by_weight)
        & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket"))
    )
    second = materialize(x.join(y, near).select(F.col("x.nid").alias("a"), F.col("y.nid").alias("b")), "pairs")
    more = _linked(second, nodes, docs, key, text, "links")
    return components(links.union(more))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with its own columns: that of the smallest key (a null key
    comes last; of equal keys, one)."""
    number = free_name(docs, "row")
    numbered = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    named = numbered.select(F.col(number).alias("row"), F.col(key).alias("k"), F.col(text).alias("t"))
    found = classes(named.select(F.struct(F.col("k").isNull().alias("z"), "k", "row").alias("id"), "t"), "id", "t")
    first = found.where("id = class_id").select(F.col("id.row").alias(number))
    return numbered.join(first, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
