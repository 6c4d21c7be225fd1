"""Quality rules: statistics of each document, and verdicts on hosts.

All in DataFrame functions. Documents that fail the base rules are counted by host;
a host's failure rate is shrunk towards the rate of all hosts by a beta prior whose
mean and strength come from the hosts themselves (method of moments), so that a host
of few documents isn't judged by chance. Hosts with too high a shrunk rate fail, and
the verdict goes back to their documents.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, settled, text_of

RUN = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: Shrunk failure rate above which a host fails.
MAX_HOST_RATE = 0.5
#: Hosts whose verdicts are broadcast at most (about 40 bytes each); more are joined by a shuffle.
BROADCAST_HOSTS = 200_000
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_CLASS = r"[\x20\x09-\x0D]+"


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _repeat_words(df: DataFrame, keep: list[str]) -> DataFrame:
    """df's columns in keep and n_repeat_words: words of _words in runs of RUN words that it has twice or more."""
    enough = F.size("_words") >= RUN
    starts = F.when(enough, F.sequence(F.lit(0), F.size("_words") - RUN)).otherwise(_empty("int"))
    df = settled(df, [*keep, "_words"], _codes=F.when(enough, F.transform("_words", lambda w: F.xxhash64(w))).otherwise(_empty("bigint")), _starts=starts)
    df = settled(df, [*keep, "_words"], _runs=F.transform("_starts", lambda i: F.xxhash64(*[F.get("_codes", i + j) for j in range(RUN)])))
    # most texts repeat no run, which costs one look; in the others, equal runs come to stand side by side
    placed = F.array_sort(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = settled(df, [*keep, "_words"], _placed=F.when(F.size(F.array_distinct("_runs")) < F.size("_runs"), placed).otherwise(_empty("struct<h:bigint,i:int>")))

    def same(x: Column, other: Column) -> Column:
        words = [F.get("_words", x["i"] + j) == F.get("_words", other["i"] + j) for j in range(RUN)]
        return F.coalesce((x["h"] == other["h"]) & reduce(and_, words), F.lit(False))

    again = F.filter("_placed", lambda x, k: same(x, F.get("_placed", k - 1)) | same(x, F.get("_placed", k + 1)))
    df = settled(df, keep, _places=F.array_sort(F.transform(again, lambda x: x["i"])))
    covered = F.transform("_places", lambda p, k: F.least(F.lit(RUN), F.coalesce(F.get("_places", k + 1) - p, F.lit(RUN))))
    return df.select(*keep, F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x).alias("n_repeat_words"))


def _host(source: Column) -> Column:
    """The host of a source that is a URL, any other source as it stands."""
    named = F.lower(F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)", 1))
    return F.coalesce(F.when(named != "", named), source)


def document_statistics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id_col, _host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of every row of df.

    _host: of a URL its host, lower-cased; what is no URL is a host as it stands. Null and
    empty texts have no words and fail; rows, ids and hosts may repeat or be
    null; other columns are not read; an empty df gives an empty result.
    """
    source = df.select(df[id_col].alias("_id"), _host(df[host_col].cast("string")).alias("_host"), text_of(text_col).alias("_t"))
    split = settled(
        source, ["_id", "_host", "_t"],
        _words=F.filter(F.split("_t", _BLANK_CLASS), lambda w: w != ""),
        _lines=F.filter(F.split("_t", "\n"), lambda x: F.translate(x, _BLANKS, "") != ""),
    )
    counted = split.select(
        "_id", "_host", "_words", F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_t", _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    done = _repeat_words(counted, ["_id", "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines"]).withColumnRenamed("_id", id_col)
    return done.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def host_verdicts(statistics: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(_host, n_docs, n_failed, shrunk_rate, host_failed) of every host; a null host has no verdict.

    With mean m and variance v of the hosts' rates, the prior's strength is
    m (1 - m) / v - 1, at least 1; where v is 0 (one host, or all alike), the strength is 1.
    """
    hosts = statistics.filter(F.col("_host").isNotNull()).groupBy("_host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    # two numbers, whatever the hosts
    mean, var = hosts.agg(F.sum("n_failed") / F.sum("n_docs"), F.coalesce(F.var_pop(rate), F.lit(0.0))).first()
    mean = mean or 0.0
    strength = max(mean * (1 - mean) / var - 1, 1.0) if var else 1.0
    shrunk = (F.col("n_failed") + F.lit(strength) * F.lit(mean)) / (F.col("n_docs") + F.lit(strength))
    return hosts.select("_host", "n_docs", "n_failed", shrunk.alias("shrunk_rate")).withColumn("host_failed", F.col("shrunk_rate") > max_rate)


def apply_rules(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The statistics of every row of df, with kept: neither the document nor its host failed.

    Statistics (some tens of bytes a document) are written once, as the hosts are
    counted from them and the verdicts joined to them. A host with any share of all
    rows is summed within the map tasks first. Verdicts are broadcast if there are
    BROADCAST_HOSTS at most, else joined by a shuffle whose large partitions are split.
    """
    statistics = checkpoint(document_statistics(df, id_col=id_col, text_col=text_col, host_col=host_col))
    verdicts = host_verdicts(statistics, max_rate).filter("host_failed").select("_host", "host_failed")
    verdicts = checkpoint(verdicts)
    if verdicts.count() <= BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))
    return statistics.join(verdicts, "_host", "left").withColumn("kept", kept).drop("_host", "host_failed")
