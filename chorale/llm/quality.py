"""Quality rules with verdicts on hosts: per-document rules, shrunk failure rates per host, joined back.

Everything is built from DataFrame functions.  The rules look only inside a document, so texts are never shuffled for
them; failures are counted per host with map-side partial sums, and the hosts' verdicts are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE_CHARS, SPACE_CLASS, checkpointed, quoted, text_of, unused, without, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The further rules: symbols for 100 words, repeated lines for 100 lines, and bounds of the mean word length.
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT, MIN_WORD_CHARS, MAX_WORD_CHARS = 10, 50, 3, 10
SYMBOLS = "#*$%&|<>"
#: A host is rejected when its shrunk rate of failing documents reaches this.
MAX_HOST_RATE = 0.5
#: Hosts up to this many are broadcast (a few MB); beyond it the join is shuffled, and AQE splits a hot host.
BROADCAST_HOSTS = 50_000
#: Bounds of the strength (pseudo-documents) of the prior that the spread of the hosts' rates suggests.
MIN_PRIOR, MAX_PRIOR = 2.0, 1000.0

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*METRICS, "base_failed", "rules_failed", "host_docs", "host_failed", "host_rate", "kept")


def _without_chars(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    The windows' 64-bit hashes are sorted with their positions; windows that equal a neighbour are marked, and the marked
    positions, in order, each cover what is new of three words.  Texts without a repeated hash skip the sort.
    """
    at = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, at).otherwise(F.array().cast("array<bigint>"))


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the five measures of every whole text (null: no words), ``base_failed`` and ``rules_failed``.

    ``rules_failed`` holds if the base rules fail or one of the further ones does: on symbols a word, the share of repeated
    lines and the mean word length.
    """
    text = text_of(F.col(quoted(text_col)))
    names = without(docs, *RESULTS).columns
    columns = [F.col(quoted(c)) for c in names]
    word, line, n_lines, windows, in_order, marks = unused((*names, *RESULTS), "words", "lines", "n_lines", "windows", "in_order", "marks")
    words = F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    one = docs.select(
        *columns,
        words.alias(word),
        F.length(_without_chars(text, SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without_chars(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias(line),
    )
    two = one.select(
        *columns,
        F.size(word).cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        F.size(line).alias(n_lines),
        _repeat_words(F.col(word)).alias(windows),
    )
    ordered = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    three = two.withColumn(in_order, ordered).drop(windows)
    most = F.greatest(F.size(in_order) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(in_order, 1, most), F.slice(in_order, 2, most), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    four = three.withColumn(marks, F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))).drop(in_order)
    last = F.lit(-3)
    covered = F.aggregate(
        marks,
        F.struct(F.lit(0).cast("long").alias("n"), last.alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    five = four.withColumn("n_repeat_words", covered).drop(marks)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    further = (
        (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col(n_lines))
        | (F.col("word_chars") < MIN_WORD_CHARS * F.col("n_words"))
        | (F.col("word_chars") > MAX_WORD_CHARS * F.col("n_words"))
    )
    return five.withColumn("base_failed", failed).withColumn("rules_failed", F.col("base_failed") | further).drop(n_lines)


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """One row per ``host``: ``host_docs``, of which ``host_failed`` break a rule, and ``host_rate`` shrunk by an empirical beta prior.

    The prior's mean is the rate over all documents.  Its strength comes from the method of moments: the spread of the
    hosts' rates beyond what counting alone explains.  Hosts are counted with map-side sums; five sums reach the driver.
    """
    hosts = measured.groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("rules_failed").cast("long")).alias("host_failed"))
    hosts = checkpointed(hosts)
    docs, failed = F.col("host_docs"), F.col("host_failed")
    n, f, k, ff_n, nn = hosts.agg(F.sum(docs), F.sum(failed), F.count(F.lit(1)), F.sum(failed * failed / docs), F.sum(docs * docs).cast("double")).first()
    if not n:
        return hosts.withColumn("host_rate", F.lit(0.0))
    mean, strength = beta_prior(n, f, k, ff_n, nn)
    return hosts.withColumn("host_rate", (failed + F.lit(mean * strength)) / (docs + F.lit(strength)))


def beta_prior(n: int, f: int, k: int, ff_n: float, nn: float) -> tuple[float, float]:
    """Mean and strength of the prior from sums over k hosts: documents n, failing f, of f * f / n, and of n * n."""
    mean = f / n
    # Weighted between-host sum of squares against its expectation under one common rate.
    spread, within = ff_n - n * mean * mean, mean * (1 - mean)
    between = (spread - (k - 1) * within) / max(n - nn / n, 1e-9)
    if between <= 0 or within <= 0:
        return mean, MAX_PRIOR
    return mean, min(max(within / between - 1, MIN_PRIOR), MAX_PRIOR)


def apply_rules(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_host_rate: float = MAX_HOST_RATE, carry: tuple[str, ...] | None = None, every_host: bool = True) -> DataFrame:
    """The columns ``carry`` (all) of ``docs`` plus the five measures, ``base_failed``, ``rules_failed``, the host's verdict and ``kept``.

    The host's verdict is ``host_docs``, ``host_failed`` and ``host_rate`` (``host_rates``); a host at ``max_host_rate`` or above is
    rejected.  A document is kept if it passes the document rules and its host is not rejected.  The measured rows are written
    once in the shared folder, so carry no text where only the verdicts are wanted.  Without ``every_host`` only rejected hosts,
    which are few, are joined to the rows; those of others have null verdicts.

    A null or empty text has no words and fails (fewer than 50 words), and texts of any length are measured as a whole; a
    null host is a host of its own.  Repeated rows count and stay.  Input columns that are named like a result (in any case)
    are replaced, also where one of them holds the text or the host.  An empty table gives no rows.
    """
    names = without(docs, *RESULTS).columns
    names = names if carry is None else [c for c in names if c in carry]
    host, theirs, given = unused((*names, *RESULTS), "host", "their_host", "given")
    slim = docs.select(*[F.col(quoted(c)) for c in names], F.col(quoted(host_col)).alias(host), F.col(quoted(text_col)).alias(given))
    measured = written(with_metrics(slim, given).drop(given), "quality")
    hosts = written(host_rates(measured, host).withColumnRenamed(host, theirs), "hosts")
    if not every_host:
        hosts = hosts.where(F.col("host_rate") >= max_host_rate)
    if hosts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    joined = measured.join(hosts, F.col(host).eqNullSafe(F.col(theirs)), "left").drop(host, theirs)
    return joined.withColumn("kept", ~F.col("rules_failed") & F.coalesce(F.col("host_rate") < max_host_rate, F.lit(True)))
