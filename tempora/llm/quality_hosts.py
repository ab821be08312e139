"""Quality rules with host-level verdicts, in DataFrame functions only.

Documents are measured once. Rule failures are counted per domain, each domain's failure rate is shrunk towards the
others by an empirical beta prior (moments of the domain rates), and domains whose shrunk rate is too high are
judged bad. The verdict is joined back: in a bad domain a document must pass every rule, in the others the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tempora.llm.common import stored

#: Separators of words, and the signs that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
#: Domain rules: symbols per 100 words, repeated lines per 100 lines with a word, letters per word.
MAX_SYMBOL_PERCENT, MAX_LINE_PERCENT, WORD_CHARS = 10, 30, (2, 12)
#: A domain is bad from this shrunk failure rate on.
BAD_RATE = 0.5


def covered_words(pairs: Column) -> Column:
    """Words inside the windows whose hash occurs twice or more. ``pairs``: sorted (hash, place) of all windows."""
    again = F.filter(
        F.transform(
            F.arrays_zip(
                pairs.alias("x"),
                F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), pairs).alias("lo"),
                F.concat(F.slice(pairs, 2, F.greatest(F.size(pairs), F.lit(1))), F.array(F.lit(None).cast("struct<h:bigint,i:int>"))).alias("hi"),
            ),
            lambda z: F.when((z["x"]["h"] == z["lo"]["h"]) | (z["x"]["h"] == z["hi"]["h"]), z["x"]["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    # Places in order; each covers the words up to the next place, eight at most.
    return F.aggregate(
        F.array_sort(again),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-REPEAT_WINDOW).alias("last")),
        lambda s, i: F.struct((s["sum"] + F.least(F.lit(REPEAT_WINDOW), i - s["last"])).alias("sum"), i.alias("last")),
        lambda s: s["sum"],
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The measures of every whole text. A null text has no words; each repeated row is measured."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(
        F.col(id_col).alias("__id"),
        F.col(host_col).alias("__host"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("__chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("__symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)).alias("__lines"),
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("__words"),
    )
    step = step.select(
        "__id",
        "__host",
        "__chars",
        "__symbols",
        F.size("__words").cast("long").alias("__n"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__dup"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__h"),
    )
    # The window hashes follow the words' own hashes, shifted against each other: one pass, no word is read again.
    shifted = [F.slice("__h", k + 1, F.greatest(F.size("__h") - (REPEAT_WINDOW - 1), F.lit(0))).alias(f"w{k}") for k in range(REPEAT_WINDOW)]
    step = step.withColumn("__zip", F.arrays_zip(*shifted))
    step = step.select("__id", "__host", "__chars", "__symbols", "__n", "__n_lines", "__dup", F.transform("__zip", lambda z: F.xxhash64(z)).alias("__marks"))
    some = F.size(F.array_distinct("__marks")) < F.size("__marks")
    pairs = F.array_sort(F.transform("__marks", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("__pairs", F.when(some, pairs))
    return step.select(
        F.col("__id").alias("doc_id"),
        F.col("__host").alias("host"),
        F.col("__n").alias("n_words"),
        F.col("__chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"),
        F.col("__dup").alias("n_dup_lines"),
        F.col("__n_lines").alias("n_lines"),
        F.coalesce(covered_words(F.col("__pairs")), F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def judge_hosts(measured: DataFrame, bad_rate: float = BAD_RATE) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_bad) of every domain; documents without a domain have none.

    The prior's mean m is the failure rate of all documents. Its weight is 1 / g - 1, where g, the correlation inside a domain,
    is what the spread of the domain rates leaves after the spread that chance alone gives domains of their sizes. If nothing
    is left, every domain gets the mean itself; in place of a weight below 0 it is 0.
    """
    counts = measured.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("fails").alias("n_failed"))
    size, failed = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    total = counts.agg(F.sum(size).alias("n"), F.sum(failed).alias("f"), F.sum(size * size).alias("nn"), F.count("*").alias("h")).first()  # one row
    mean = total["f"] / total["n"] if total["h"] else 0.0
    chance = mean * (1 - mean)
    room = total["n"] - total["nn"] / total["n"] - (total["h"] - 1) if total["h"] else 0.0
    inside = 0.0
    if chance > 0 and room > 0:
        spread = counts.agg(F.sum(size * (failed / size - mean) ** 2).alias("s")).first()["s"]
        inside = min(1.0, (spread / chance - (total["h"] - 1)) / room)
    weight = 1 / inside - 1 if inside > 0 else None
    shrunk = F.lit(mean) if weight is None else (failed + weight * mean) / (size + weight)
    return counts.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"), (shrunk >= bad_rate).alias("host_bad"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", bad_rate: float = BAD_RATE) -> DataFrame:
    """One row per row of ``docs``: measures, ``base_failed``, ``fails`` (any rule), ``host_bad`` and ``kept``.

    Kept: not ``base_failed``, and not both failing some rule and coming from a bad domain. A null or empty text fails the
    base rules. Documents with a null domain are judged by the base rules alone. Repeated rows count as often as they occur.
    Other columns are not read. Texts are read once; the measures, a few numbers a document, are stored, counted by domain
    (combined before the shuffle, so a domain with a third of all rows is one row a task) and joined with the verdicts.
    """
    rows = stored(measure(docs, id_col, text_col, host_col), "measures")
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    more = (
        (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n)
        | (100 * F.col("n_dup_lines") > MAX_LINE_PERCENT * F.col("n_lines"))
        | (F.col("word_chars") < WORD_CHARS[0] * n)
        | (F.col("word_chars") > WORD_CHARS[1] * n)
    )
    rows = rows.withColumn("base_failed", base).withColumn("fails", base | more)
    verdicts = stored(judge_hosts(rows, bad_rate).select("host", "host_bad"), "host-verdicts")
    joined = rows.join(verdicts, "host", "left").withColumn("host_bad", F.coalesce("host_bad", F.lit(False)))
    return joined.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_bad") & F.col("fails")))
