"""Document rules, and host verdicts from how often a host's documents break them.

Each document is measured by array and text functions in one pass, without a shuffle.  The
failures of each rule are then counted by host, and a host's rate is shrunk towards the
rate of all hosts by a beta prior fitted to the spread between hosts: a host with few
documents says little about itself.  Hosts whose shrunk rate is above a limit for any rule
are rejected, and the verdict is joined back to their documents.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

LEAST_WORDS = 50
#: Words in repeated three-word windows, in percent of the words.
MOST_REPEATED = 50
#: Symbols and repeated lines: that many per 100 words are too many.
MOST_SYMBOLS, MOST_DUP_LINES = 50, 20
#: A host is rejected if for some rule its shrunk failure rate is above this.
MOST_FAILING = 0.5
#: Rejected hosts that may be sent to every task; more are joined by a shuffle.
BROADCAST_HOSTS = 100_000

#: White space of the rules, as characters and as a class.
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = "[\\x20\\x09-\\x0D]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct of ``MEASURES``; returns the frame and its name.

    Null and empty texts measure 0 throughout.  Texts are taken whole; the work for one is
    in proportion to n log n of its words.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    words, lines, keys, runs, hits, out = (free_name(docs, f"measured_{x}") for x in ("words", "lines", "keys", "runs", "hits", "all"))
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(whole, F.lit(_BLANKS))
    w, size = F.col(words), F.size(words)

    # 1. words, and lines with a word
    df = docs.select(
        *columns,
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _BLANK_RUN)).alias(words),
        F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "").alias(lines),
    )
    # 2. hashes of three-word windows: without two equal ones no window is repeated
    df = df.select("*", F.when(size >= 3, F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).alias(keys))
    # 3. for the others the windows themselves, equal ones side by side
    window = F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("w"), i.alias("i")),
    )
    df = df.select("*", F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.sort_array(window)).alias(runs))
    # 4. where repeated windows start, in order
    r, last = F.col(runs), F.size(runs) - 1

    def repeated(x: Column, i: Column) -> Column:
        return ((i > 0) & (x["w"] == F.get(r, i - 1)["w"])) | ((i < last) & (x["w"] == F.get(r, i + 1)["w"]))

    df = df.select("*", F.sort_array(F.transform(F.filter(r, repeated), lambda x: x["i"])).alias(hits))
    # 5. words covered: three from each start, less where the next one is nearer
    h = F.col(hits)
    steps = F.transform(h, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(h, i + 1), x + 3) - x))
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x)
    return df.select(*columns, F.struct(
        size.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    ).alias(out)), out


def rules(measures: str) -> dict[str, Column]:
    """Failures by rule."""
    n, m = F.col(f"{measures}.n_words"), {x: F.col(f"{measures}.{x}") for x in MEASURES}
    return {
        "few_words": n < LEAST_WORDS,
        "repeated_words": 100 * m["n_repeat_words"] > MOST_REPEATED * n,
        "symbols": 100 * m["n_symbols"] > MOST_SYMBOLS * n,
        "dup_lines": 100 * m["n_dup_lines"] > MOST_DUP_LINES * n,
    }


def base_failed(measures: str) -> Column:
    found = rules(measures)
    return found["few_words"] | found["repeated_words"]


def host_counts(measured: DataFrame, measures: str, host: str = "source") -> DataFrame:
    """Documents and failures of each rule by host; a null host is the host without name."""
    failed = {name: F.sum(F.when(failure, 1.0).otherwise(0.0)).alias(name) for name, failure in rules(measures).items()}
    name = F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("host")
    return measured.groupBy(name).agg(F.count(F.lit(1)).cast("double").alias("n"), *failed.values())


def beta_priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """(a, b) of a beta distribution per rule, from the spread of the hosts' rates.

    Moments of the beta-binomial: what the rates vary beyond chance gives the correlation
    within hosts, and so the weight a + b of the prior.  Fewer than two hosts, or a rule
    that never or always fails, give no prior.
    """
    names = [c for c in hosts.columns if c not in ("host", "n")]
    sums = [F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") ** 2).alias("n2")]
    for x in names:
        sums += [F.sum(x).alias(f"f_{x}"), F.sum(F.col(x) ** 2 / F.col("n")).alias(f"s_{x}")]
    got = hosts.agg(*sums).first()
    found = {}
    for x in names:
        if got["k"] < 2 or not 0 < got[f"f_{x}"] < got["n"]:
            continue
        rate = got[f"f_{x}"] / got["n"]
        spread = (got[f"s_{x}"] - rate * rate * got["n"]) / (rate * (1 - rate))
        room = got["n"] - got["n2"] / got["n"] - (got["k"] - 1)
        within = (spread - (got["k"] - 1)) / room if room > 0 else 1.0
        weight = 1 / min(max(within, 1e-6), 0.999) - 1
        found[x] = (rate * weight, (1 - rate) * weight)
    return found


def rejected_hosts(hosts: DataFrame) -> DataFrame:
    """``host`` of those whose shrunk rate is above the limit for some rule."""
    verdict = F.lit(False)
    for x, (a, b) in beta_priors(hosts).items():
        verdict = verdict | ((F.col(x) + a) / (F.col("n") + a + b) > MOST_FAILING)
    return hosts.where(verdict).select("host")


def judge(measured: DataFrame, measures: str, host: str = "source") -> tuple[DataFrame, str]:
    """All columns and ``kept``: no base rule fails and the host is not rejected.

    ``measured`` is read twice, so it should be a written table.  Repeated rows count each.
    """
    hosts = materialize(host_counts(measured, measures, host), "hosts")
    rejected = materialize(rejected_hosts(hosts).select(F.col("host").alias("rejected_host")), "rejected")
    if rejected.count() <= BROADCAST_HOSTS:
        rejected = F.broadcast(rejected)
    mark = free_name(measured, "rejected_host")
    rejected = rejected.withColumnRenamed("rejected_host", mark)
    joined = measured.join(rejected, F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")) == F.col(mark), "left")
    kept = free_name(measured, "kept")
    columns = [F.col(f"`{c}`") for c in measured.columns]
    return joined.select(*columns, (~base_failed(measures) & F.col(mark).isNull()).alias(kept)), kept


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Documents that no base rule and no host verdict rejects, with their own columns."""
    measured, measures = measure(docs, text)
    judged, kept = judge(materialize(measured, "measured"), measures, host)
    return judged.where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
