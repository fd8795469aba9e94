"""Phrase collocations per language by best-first branch-and-bound growth.

Phrases grow to the right, one word at a time, from words that occur ``least`` times.  A
phrase with first word v scores at most floor(1000 * n / f(v)), whatever follows: in its
cut after v the rest occurs at least as often as the whole.  So the count of a prefix
bounds all that grows from it.  Prefixes are expanded in falling order of that bound, in
batches (``WIDEN``), and once a language has ``top`` surviving scores, prefixes whose bound
is below the last of them are never expanded; ties with it are.  The counts of second parts
that growth has not met are asked for only where the score could still reach that place.

Whether a phrase survives needs no search: a longer phrase that occurs as often as it and
holds it exists if and only if all its occurrences have the same word before, or all the
same word after them.  The smallest and largest neighbour are taken along with its count.

Words are 64-bit hashes of language and word, proven free of collisions with words of
``least`` occurrences or more (else another seed is taken), so counts are exact.  The text
is read twice: for the counts of words, and to write the runs of frequent words that all
later passes read.  What a pass looks for is sent as bitmaps of fixed size; a false hit
costs a counted phrase too many, which is left out again by an exact join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, steps
from .words import Words, column_bytes, factors, mix, words_of

LEAST, LONGEST, TOP = 100, 5, 2000
#: Each batch takes prefixes whose first word occurs up to so many times as often as before.
WIDEN = 64
#: Bits of a bitmap (8 MB), whatever the number of phrases in it.
BITMAP_BITS = 26
#: Bytes of runs counted together, and words in one row of runs (more only if a run is
#: longer), so that a batch of rows stays small.
BLOCK, ROW = 8 << 20, 1 << 9
UNKNOWN_LANG = "und"
#: Parts of a language in which places are counted first.
PARTS = 64

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True


def _byte_table() -> np.ndarray:
    """Bytes of words with A-Z in lower case; U+0000 is a word character too, for which the
    free code of A stands."""
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 32
    out[0] = 0x41
    out[_BREAKS] = 0
    out[[0x20, 0x09]] = 0
    return out


def _hashes(words: Words, langs: list[str], seed: int) -> np.ndarray:
    """Hash of language and word of each word, never 0 (0 ends a run)."""
    salts = [int.from_bytes(hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest(), "little") for x in langs]
    out = mix(words.hashes() * np.uint64(2 * seed + 1) + np.array(salts, np.uint64)[words.doc])
    return np.where(out == 0, np.uint64(1), out)


def _second_hashes(words: Words) -> np.ndarray:
    """Another hash of each word, without its language."""
    sizes = words.ends - words.starts
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms = words.data[words.data != 0].astype(np.uint64) * factors(int(sizes.max()), 9)[place]
    return np.add.reduceat(terms, np.cumsum(sizes) - sizes)


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings that are slices of a byte array."""
    sizes = ends - starts
    bounds = np.append(0, np.cumsum(sizes))
    taken = data[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])]
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(taken)])


def _keys(table: np.ndarray) -> pa.Array:
    """Rows of words as binary values."""
    bounds = np.arange(len(table) + 1, dtype=np.int32) * 8 * table.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(table), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(table.astype("<u8").tobytes())])


def _langs(batch: pa.RecordBatch) -> list[str]:
    return [UNKNOWN_LANG if x is None else x for x in batch.column(1).to_pylist()]


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """Occurrences of every word: ``key`` (8 bytes), ``lang, word, a``.  ``docs`` has text
    and language.  Different words of one hash stay rows of their own."""
    table = _byte_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 0):
            words, langs = words_of(batch.column(0), table), _langs(batch)
            if not len(words.starts):
                continue
            h = _hashes(words, langs, seed)
            _, first, which, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            check = _second_hashes(words)
            if not np.array_equal(check[first][which], check):
                first, n = np.arange(len(h)), np.ones(len(h), np.int64)
            data = words.data.copy()
            data[data == 0x41] = 0
            lang = pa.array(langs, pa.string()).take(pa.array(words.doc[first]))
            yield pa.RecordBatch.from_arrays(
                [_keys(h[first][:, None]), lang, _slices(data, words.starts[first], words.ends[first]), pa.array(n)],
                names=["key", "lang", "word", "a"])

    counted = docs.mapInArrow(run, "key binary, lang string, word string, a bigint")
    return counted.groupBy("key", "lang", "word").agg(F.sum("a").alias("a"))


def _extend(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases, each with one word more; that of a single word is the word."""
    return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words)


def bitmap(keys: DataFrame) -> np.ndarray | None:
    """Bitmap of phrases (``key``: 8 bytes a word); None if there are none.

    At most ``2 ** BITMAP_BITS / 64`` rows come to the driver, however many phrases.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pc.binary_length(batch.column(0)))
            bits = [np.zeros(0, np.uint64)]
            for size in np.unique(sizes).tolist():
                some = batch.column(0).filter(pa.array(sizes == size))
                table = np.frombuffer(b"".join(some.to_pylist()), "<u8").reshape(-1, size // 8)
                hashes = table[:, 0]
                for k in range(1, table.shape[1]):
                    hashes = _extend(hashes, table[:, k])
                bits.append(hashes >> np.uint64(64 - BITMAP_BITS))
            found = np.unique(np.concatenate(bits))
            if len(found):
                slots, first = np.unique(found >> np.uint64(6), return_index=True)
                masks = np.bitwise_or.reduceat(np.uint64(1) << (found & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(masks.view(np.int64))], names=["slot", "mask"])

    found = keys.select("key").mapInArrow(run, "slot int, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    if not found.num_rows:
        return None
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def frequent_runs(docs: DataFrame, frequent: DataFrame, seed: int) -> DataFrame:
    """Runs of two frequent words or more as ``run`` (8 bytes a word, 0 after each run)."""
    table = _byte_table()
    bits = bitmap(frequent)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in steps(batches, 0):
            words = words_of(batch.column(0), table)
            if bits is None or not len(words.starts):
                continue
            h = _hashes(words, _langs(batch), seed)
            good = _has(bits, h)
            piece = np.concatenate([[0], np.cumsum(_BREAKS[words.raw])])[words.starts]
            joined = np.zeros(len(h) + 1, bool)  # with the word before
            joined[1:-1] = good[1:] & good[:-1] & (piece[1:] == piece[:-1]) & (words.doc[1:] == words.doc[:-1])
            inside = joined[:-1] | joined[1:]
            last = inside & ~joined[1:]
            if not last.any():
                continue
            place = np.cumsum(inside.astype(np.int64) + last)
            out = np.zeros(int(place[-1]), np.uint64)
            out[(place - 1 - last)[inside]] = h[inside]
            ends = np.flatnonzero(out == 0) + 1
            ends = np.unique(ends[np.minimum(np.searchsorted(ends, np.arange(ROW, len(out) + ROW, ROW)), len(ends) - 1)])
            rows = [out[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["run"])

    return docs.mapInArrow(run, "run binary")


@dataclass(frozen=True)
class Wanted:
    """What a pass counts: phrases whose prefix, one word shorter, is in a bitmap, and
    phrases that are in another; and the lengths for which there are any."""

    grow: np.ndarray | None
    grow_sizes: frozenset[int]
    ask: np.ndarray | None
    ask_sizes: frozenset[int]


def _count_block(words: np.ndarray, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    """Counts of the wanted phrases in a block of runs."""
    places = np.flatnonzero(words)
    hashes = words[places]
    padded = np.concatenate([np.zeros(1, np.uint64), words, np.zeros(LONGEST, np.uint64)])  # words[i] is padded[i + 1]
    for size in range(2, max(wanted.grow_sizes | wanted.ask_sizes) + 1):
        goes_on = padded[places + size] != 0
        places, prefix = places[goes_on], hashes[goes_on]
        hashes = _extend(prefix, padded[places + size])
        take = np.zeros(len(places), bool)
        if size in wanted.grow_sizes:
            take |= _has(wanted.grow, prefix)
        if size in wanted.ask_sizes:
            take |= _has(wanted.ask, hashes)
        at, h = places[take], hashes[take]
        if not len(at):
            continue
        order = np.argsort(h, kind="stable")
        at = at[order]
        table = padded[at[:, None] + np.arange(1, size + 1)]
        new = np.ones(len(at), bool)
        new[1:] = (table[1:] != table[:-1]).any(axis=1)  # words themselves: a clash of hashes only splits a group
        first = np.flatnonzero(new)
        sides = []
        for beside in (padded[at], padded[at + size + 1]):
            low = np.minimum.reduceat(beside, first)
            only = np.where(low == np.maximum.reduceat(beside, first), low, np.uint64(0)).view(np.int64)  # 0: not one alone
            sides += [pa.array(only), pa.array(only)]
        yield pa.RecordBatch.from_arrays([_keys(table[first]), pa.array(np.diff(np.append(first, len(at)))), *sides], names=_COUNTED)


_COUNTED = ["key", "a", "before_lo", "before_hi", "after_lo", "after_hi"]


def count_phrases(runs: DataFrame, wanted: Wanted) -> DataFrame:
    """Exact counts of all phrases that the bitmaps let through, and the smallest and largest
    of the words that stand alone before or after them in a block (0 where several do)."""
    shared = runs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 0, BLOCK):
            yield from _count_block(column_bytes(batch.column(0))[0].view("<u8"), shared.value)

    counted = runs.mapInArrow(run, "key binary, " + ", ".join(f"{c} bigint" for c in _COUNTED[1:]))
    return counted.groupBy("key").agg(
        F.sum("a").alias("a"), *(f(c).alias(c) for c, f in zip(_COUNTED[2:], (F.min, F.max, F.min, F.max))))


def _size(key: str = "key") -> Column:
    return (F.octet_length(key) / 8).cast("int")


def _score(whole: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (l * r)); the products are decimals of 38 digits."""
    wide = "cast({} as decimal(19, 0))".format
    return F.expr(f"1000 * {wide(whole)} * {wide('n')} div ({wide(left)} * {wide(right)})")


def _survives() -> Column:
    """No longer phrase that holds this one occurs as often."""
    def same(side: str) -> Column:
        return (F.col(f"{side}_lo") == F.col(f"{side}_hi")) & (F.col(f"{side}_lo") != 0)

    return ~(same("before") | same("after"))


def scored(phrases: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """Every surviving phrase with its lowest cut: ``key, a, lang, n, score, k, l, r`` and
    ``unknown``, the second parts without a count.

    A second part occurs at least as often as the whole, so until it is counted the score
    is a bound from above.  ``words`` has ``key, a, lang, n``.
    """
    counts = phrases.select("key", "a").unionByName(words.select("key", "a"))
    cuts = phrases.where((_size() == longest) | _survives())
    cuts = cuts.select("key", "a", F.explode(F.sequence(F.lit(1), _size() - 1)).alias("k"))
    cuts = cuts.selectExpr("*", "substring(key, 1, 8) AS first", "substring(key, 1, 8 * k) AS left", "substring(key, 8 * k + 1) AS right")
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("a").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("key").alias("right"), F.col("a").alias("r")), "right", "left")
    cuts = cuts.join(words.select(F.col("key").alias("first"), "lang", "n"), "first")
    cuts = cuts.withColumn("score", _score("a", "l", "coalesce(r, a)"))
    found = cuts.groupBy("key", "a", "lang", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.collect_list(F.when(F.col("r").isNull(), F.col("right"))).alias("unknown"))
    return found.select("key", "a", "lang", "n", "cut.*", "unknown")


def shortlist(found: DataFrame, top: int) -> DataFrame:
    """The settled phrases that can have one of the first places of their language, ties
    included: those that have one in their part of it, so no task sees a whole language."""
    parts = found.where(F.size("unknown") == 0).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    place = F.rank().over(Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a")))
    return parts.withColumn("place", place).where(F.col("place") <= top).drop("part", "place")


def floors(found: DataFrame, top: int) -> DataFrame:
    """By language the score of the last place, where all places are taken."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
    best = shortlist(found, top).select("lang", "score").withColumn("place", place).where(F.col("place") <= top)
    return best.where(F.col("place") == top).select("lang", F.col("score").alias("floor"))


def _next_work(phrases: DataFrame, done: DataFrame, found: DataFrame, words: DataFrame, longest: int, top: int) -> DataFrame:
    """Prefixes to expand (``key``, ``f`` of the first word) and phrases to count (``f`` null)
    that can still bring a score as high as the last place of their language, ties included."""
    floor = floors(found, top)  # one row a language

    def reaches(score: str) -> Column:
        return F.col("floor").isNull() | (F.col(score) >= F.col("floor"))

    bounds = words.select(F.col("key").alias("first"), F.col("a").alias("f"), "lang", F.expr("1000 * cast(n as decimal(19, 0)) div a").alias("bound"))
    known = phrases.where(_size() < longest).select("key").unionByName(words.select("key"))
    fresh = known.join(done, "key", "left_anti").withColumn("first", F.expr("substring(key, 1, 8)"))
    fresh = fresh.join(bounds, "first").join(floor, "lang", "left").where(reaches("bound")).select("key", "f")
    asked = found.where(F.size("unknown") > 0).join(floor, "lang", "left").where(reaches("score"))
    asked = asked.select(F.explode("unknown").alias("key")).distinct().withColumn("f", F.lit(None).cast("bigint"))
    return materialize(fresh.unionByName(asked), "phrase-frontier")


def grow(runs: DataFrame, words: DataFrame, least: int, longest: int, top: int) -> DataFrame:
    """Expand prefixes by falling bounds until the places of all languages are settled.

    Every round ends in written tables, so a lost executor repeats one round at most.
    """
    spark = runs.sparkSession
    phrases = spark.createDataFrame([], "key binary, " + ", ".join(f"{c} bigint" for c in _COUNTED[1:]))
    done = spark.createDataFrame([], "key binary")  # prefixes that were expanded
    found, limit = scored(phrases, words, longest), least
    while True:
        work = _next_work(phrases, done, found, words, longest, top)
        sizes = work.groupBy(_size().alias("size"), F.col("f").isNull().alias("asked")).agg(F.min("f").alias("least")).collect()
        if not sizes:
            return found
        rarest = min((x["least"] for x in sizes if not x["asked"]), default=0)
        limit = max(limit, 0 if any(x["asked"] for x in sizes) else rarest) * WIDEN
        expand, asked = work.where(F.col("f") <= limit).select("key"), work.where(F.col("f").isNull()).select("key")
        wanted = Wanted(
            bitmap(expand), frozenset(x["size"] + 1 for x in sizes if not x["asked"] and x["least"] <= limit),
            bitmap(asked), frozenset(x["size"] for x in sizes if x["asked"]),
        )
        counted = count_phrases(runs, wanted).where(F.col("a") >= least).withColumn("prefix", F.expr("substring(key, 1, octet_length(key) - 8)"))
        # what the bitmaps let through by mistake is left out, a phrase that is known stays once
        counted = counted.join(expand.select(F.col("key").alias("prefix"), F.lit(True).alias("grown")), "prefix", "left")
        counted = counted.join(asked.select("key", F.lit(True).alias("wanted")), "key", "left").where("grown OR wanted")
        counted = counted.select(*_COUNTED).join(phrases.select("key"), "key", "left_anti")
        phrases = materialize(phrases.unionByName(counted), "phrases")
        done = materialize(done.unionByName(expand), "phrases-expanded")
        found = materialize(scored(phrases, words, longest), "phrases-scored")


def ranked(found: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The places of each language.  Phrases are spelt out for those that can have one, ties included."""
    rank = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    best = shortlist(found, top).withColumn("place", rank).where(F.col("place") <= top)
    best = best.select("key", "lang", "a", "l", "r", "n", "score", F.explode(F.sequence(F.lit(0), _size() - 1)).alias("at"))
    spelt = best.withColumn("one", F.expr("substring(key, 8 * at + 1, 8)")).join(words.select(F.col("key").alias("one"), "word"), "one")
    spelt = spelt.groupBy("key", "lang", "a", "l", "r", "n", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelt = spelt.withColumn("phrase", F.array_join("words.word", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelt.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Null and empty texts have no words, a null language is ``und``.  Equal rows all count;
    ties go by count, then by the bytes of the phrase.  Only the two named columns are read.
    Without a phrase of ``least`` occurrences the result has no rows.
    """
    docs = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    for seed in range(1, 9):
        every = materialize(count_words(docs, seed), "words")
        clash = every.groupBy("key").agg(F.count("a").alias("words"), F.sum("a").alias("a")).where((F.col("words") > 1) & (F.col("a") >= least))
        if clash.isEmpty():
            break
    else:
        raise RuntimeError("hashes of frequent words clash under every seed")
    totals = every.groupBy("lang").agg(F.sum("a").alias("n"))
    words = materialize(every.where(F.col("a") >= least).join(totals, "lang"), "frequent-words")
    runs = materialize(frequent_runs(docs, words, seed), "runs")
    return ranked(grow(runs, words, least, longest, top), words, top)
