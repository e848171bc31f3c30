"""Document quality rules with host-level verdicts, with DataFrame operations only.

Each text is measured in one pass. A document fails outright on the base rules; softer rules only mark
it, with a severity: by how much it passes the limits it breaks. Failures of either kind are counted by host
(in the tables here: the source), and each host's failure rate is shrunk towards the rate of all hosts
with a beta prior fitted to the hosts' own rates by moments, so that a host with a few documents is not
judged by them alone. The verdict joins both: a marked document goes where its host's odds of failure times
its severity pass a limit. At ordinary hosts that takes a document well beyond a soft limit, at a host where
every second document fails any mark is enough, at a clean host hardly any is. A document that breaks no
rule stays, whatever its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, bind, scratch_columns, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WS, -1), lambda w: w != "")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda s: F.regexp_like(s, F.lit("[^\\x20\\x09-\\x0D]")))
    return bind(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def _covered(starts: Column, size: int) -> Column:
    """Number of words in the windows that begin at the sorted ``starts``."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("total"))
    return F.aggregate(starts, zero, lambda s, p: F.struct(
        (p + size).alias("upto"), (s["total"] + p + size - F.greatest(p, s["upto"])).alias("total")),
        lambda s: s["total"])


def _repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words in ``size``-word windows that occur twice or more in the text, the first included.

    Windows are compared by their words. A set of 64-bit hashes sorts out the texts without any
    repeat; in the others the windows whose hash repeats are compared as whole texts.
    """
    def exact(ws: Column, hashes: Column) -> Column:
        by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))
        def twice(a: Column, key: str) -> Column:
            """Elements of a sorted array that share ``key`` with a neighbour."""
            return F.filter(a, lambda x, i: (
                F.coalesce(F.get(a, i - 1)[key] == x[key], F.lit(False)) | F.coalesce(F.get(a, i + 1)[key] == x[key], F.lit(False))))
        suspects = bind(by_hash, lambda a: twice(a, "h"))
        texts = F.array_sort(F.transform(suspects, lambda x: F.struct(
            F.array_join(F.slice(ws, x["i"] + 1, F.lit(size)), " ").alias("t"), x["i"].alias("i"))))
        starts = bind(texts, lambda a: F.transform(twice(a, "t"), lambda x: x["i"]))
        return _covered(F.array_sort(starts), size)

    def measure(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (size - 1)), lambda i: F.xxhash64(F.slice(ws, i, F.lit(size))))
        return F.when(F.size(ws) < size + 1, 0).otherwise(bind(hashes, lambda hs: F.when(
            F.size(F.array_distinct(hs)) == F.size(hs), 0).otherwise(exact(ws, hs))))
    return bind(words, measure).cast("long")


def measures(text: Column) -> Column:
    """Struct of the counts of a whole text (null: as empty)."""
    t = F.coalesce(text, F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    return bind(_words(t), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.aggregate(ws, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        symbols.cast("long").alias("n_symbols"), _dup_lines(t).alias("n_dup_lines"), _repeat_words(ws).alias("n_repeat_words")))


def base_failed(of=F.col) -> Column:
    return (of("n_words") < 20) | (100 * of("n_repeat_words") > 30 * of("n_words"))


def severity(of=F.col) -> Column:
    """How far a text is beyond the softer rules it breaks: the sum of its values over their limits, 0 if it breaks none.

    They are: many symbols, words too short or too long on average, repeated lines, some repetition.
    """
    n, chars = F.greatest(of("n_words"), F.lit(1)).cast("double"), F.greatest(of("word_chars"), F.lit(1)).cast("double")
    def beyond(broken: Column, ratio: Column) -> Column:
        return F.when(broken, ratio).otherwise(F.lit(0.0))
    return (beyond(10 * of("n_symbols") > of("n_words"), 10 * of("n_symbols") / n)
            + beyond(of("word_chars") < 2 * of("n_words"), 2 * n / chars)
            + beyond(of("word_chars") > 14 * of("n_words"), chars / (14 * n))
            + beyond(of("n_dup_lines") > 3, of("n_dup_lines") / F.lit(3.0))
            + beyond(100 * of("n_repeat_words") > 15 * of("n_words"), 100 * of("n_repeat_words") / (15 * n)))


def rejected(failed: Column, how_severe: Column, host_rate: Column, limit: float) -> Column:
    """The verdict: base rules, or the host's odds of failure times the document's severity above ``limit``."""
    return failed | (how_severe * host_rate > limit * (1 - host_rate))


def host_rates(rows: DataFrame) -> DataFrame:
    """``(host, n, failed, rate)`` from ``rows(host, bad)``: rates shrunk with an empirical beta prior.

    With mean ``m`` and variance ``v`` of the hosts' rates, the prior has strength
    ``m (1 - m) / v - 1``, held between 1 and 10000: hosts that differ little share one rate,
    hosts that differ much keep their own.
    """
    hosts = stored(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("failed")), "hosts")
    own = F.col("failed") / F.col("n")
    n, failed, v = hosts.agg(F.sum("n"), F.sum("failed"), F.coalesce(F.var_pop(own), F.lit(0.0))).first()
    m = failed / n if n else 0.0
    strength = min(max(m * (1 - m) / v - 1, 1.0), 10_000.0) if v else 10_000.0
    return hosts.withColumn("rate", (F.col("failed") + F.lit(strength * m)) / (F.col("n") + F.lit(strength)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          limit: float = 0.5) -> DataFrame:
    """``(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    severity, host_rate, kept)`` for every row.

    Null and empty texts have no words and fail the base rules; rows without a host form one
    host; repeated rows count as often as they occur; an empty table gives no rows.
    """
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), measures(F.col(text_col)).alias("m"))
                .select("doc_id", "host", "m.*")
                .withColumn("base_failed", base_failed()).withColumn("severity", severity()))
    rows = stored(rows, "rules")
    rates = host_rates(rows.select("host", (F.col("base_failed") | (F.col("severity") > 0)).alias("bad")))
    verdicts = stored(rates.select(F.col("host").alias("_host"), F.col("rate").alias("host_rate")), "verdicts")
    return (rows.join(verdicts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
                .withColumn("kept", ~rejected(F.col("base_failed"), F.col("severity"), F.col("host_rate"), limit)))


def keep_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that the rules reject; columns and the other rows as they are."""
    c_m, c_host, c_rate = scratch_columns(docs, "_m", "_host", "_rate")
    rows = stored(docs.withColumn(c_m, measures(F.col(text_col))), "rules")
    def of(name: str) -> Column:
        return F.col(c_m)[name]
    rates = host_rates(rows.select(F.col(host_col).alias("host"), (base_failed(of) | (severity(of) > 0)).alias("bad")))
    verdicts = stored(rates.select(F.col("host").alias(c_host), F.col("rate").alias(c_rate)), "verdicts")
    return (rows.join(verdicts, F.col(host_col).eqNullSafe(F.col(c_host)))
                .where(~rejected(base_failed(of), severity(of), F.col(c_rate), limit)).select(*docs.columns))
