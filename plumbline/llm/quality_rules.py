"""Quality rules per document and per host, from built-in functions only.

Each document is measured and fails or passes the base rules and further rules on symbols, word length
and repeated lines. Documents that fail any are then counted per host (here the document's source). A host's failure rate is shrunk towards the corpus rate with a beta
prior whose two parameters come from the hosts themselves (method of moments), so that a host with
few documents is not condemned by chance. The verdict on the host is joined back to its documents, of which those stay
that pass all rules themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.exprs import with_one_row
from plumbline.llm.shared import each, head, stored, tail, text_of, words_of

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10  # of the words
MEAN_WORD_CHARS = (3, 10)
MAX_DUP_LINE_PERCENT = 30
#: A host goes when its shrunk rate of failures is above this.
MAX_HOST_RATE = 0.5
LOW_32 = 0xFFFFFFFF


def _equal_neighbours(sorted_: Column, key) -> Column:
    """For each element of a sorted array whether its key equals that of a neighbour."""
    n = F.size(sorted_)
    same = each(head(sorted_, n - 1), tail(sorted_, 2, n - 1), lambda a, b: key(a) == key(b))
    edge = F.array(F.lit(False))
    return each(F.concat(edge, same), F.concat(same, edge), lambda a, b: a | b)


def _marked(values: Column, marks: Column, value) -> Column:
    return F.array_compact(each(values, marks, lambda v, m: F.when(m, value(v))))


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with the five measures and the number of lines with a word.

    n_repeat_words counts the words that lie in a three-word window found twice or more. Windows
    are compared by a 32-bit hash packed with the position and sorted as plain numbers; the few
    that agree are then compared as text, so the count is exact. Each step is a projection of its
    own: its columns are used several times and so are not folded into one another.
    """
    t = "__text"
    df = docs.withColumn(t, text_of(text_col)).withColumn("__words", words_of(F.col(t)))
    w, lines = F.col("__words"), F.filter(F.split(F.col(t), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size(w)
    pair = each(head(w, n - 2), tail(w, 2, n - 2), lambda a, b: F.xxhash64(a, b))
    triple = each(pair, tail(w, 3, n - 2), lambda a, b: F.xxhash64(a, b))
    packed = F.transform(triple, lambda h, i: F.shiftleft(h, 32).bitwiseOR(i.cast("long")))
    df = df.withColumns({"__lines": lines, "__packed": F.sort_array(packed)})
    p = F.col("__packed")
    same_hash = _equal_neighbours(p, lambda x: F.shiftright(x, 32))
    df = df.withColumn("__starts", _marked(p, same_hash, lambda x: x.bitwiseAND(F.lit(LOW_32)).cast("int")))
    window = F.transform(
        F.col("__starts"),
        lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"), i.alias("i")),
    )
    df = df.withColumn("__windows", F.when(F.size("__starts") > 0, F.sort_array(window)).otherwise(window))
    same_text = _equal_neighbours(F.col("__windows"), lambda x: x["w"])
    df = df.withColumn("__found", F.sort_array(_marked(F.col("__windows"), same_text, lambda x: x["i"])))
    f = F.col("__found")
    steps = each(head(f, F.size(f) - 1), tail(f, 2, F.size(f) - 1), lambda a, b: F.least(F.lit(3), b - a))
    covered = F.aggregate(steps, F.lit(0), lambda s, x: s + x) + 3
    measured = {
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(F.col(t), F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.when(F.size(f) > 0, covered).otherwise(0),
        "n_lines": F.size("__lines"),
    }
    measured = {k: v.cast("long") for k, v in measured.items()}
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(k) for k, v in measured.items()])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rules_failed() -> Column:
    """Whether a measured document fails a rule: base, symbols by word, mean word length, repeated lines."""
    n, chars = F.col("n_words"), F.col("word_chars")
    shortest, longest = MEAN_WORD_CHARS
    return (
        base_failed() | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n) | (chars < shortest * n) | (chars > longest * n)
        | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"))
    )


def host_verdicts(measured: DataFrame, host: str = "host", max_rate: float = MAX_HOST_RATE, failed: str = "base_failed") -> DataFrame:
    """(host, host_docs, host_rate, host_rejected) of every host.

    With failures f of n documents on a host, corpus rate m and M the weight of the prior, the rate
    is (f + m M) / (n + M). M follows from how far the hosts' rates spread beyond chance; where they
    do not, the prior outweighs every host, and it always weighs as much as one document. Without any failure, or with failures only, all hosts
    have the corpus rate. A null host is a host of its own.
    """
    hosts = stored(
        measured.groupBy(host).agg(F.count("*").alias("host_docs"), F.count_if(failed).alias("failures")), "hosts"
    )
    n, f = F.col("host_docs").cast("double"), F.col("failures").cast("double")
    totals = hosts.agg(
        F.sum(n).alias("docs"), F.sum(f).alias("fails"), F.sum(n * n).alias("squares"), F.count("*").alias("hosts"),
        F.sum(f * f / n).alias("spread"),
    )
    df = with_one_row(hosts, totals)
    m, chance = F.col("fails") / F.col("docs"), F.col("hosts") - 1
    noise = m * (1 - m)
    beyond = (F.col("spread") - F.col("docs") * m * m) - noise * chance
    room = noise * (F.col("docs") - F.col("squares") / F.col("docs") - chance)
    share = F.least(F.lit(0.5), F.greatest(F.lit(1e-6), F.coalesce(F.try_divide(beyond, room), F.lit(1e-6))))
    weight = 1 / share - 1
    rate = (f + m * weight) / (n + weight)
    return df.select(host, "host_docs", rate.alias("host_rate"), (rate > max_rate).alias("host_rejected"))


def _judged(measured: DataFrame, host: str) -> DataFrame:
    verdicts = stored(host_verdicts(measured, host, failed="failed"), "verdicts").withColumnRenamed(host, "__h")
    joined = measured.join(verdicts, F.col(host).eqNullSafe(F.col("__h")), "left").drop("__h")
    return joined.withColumn("kept", ~F.col("failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False)))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed, failed (any rule), host, host_rate, host_rejected, kept.

    A null text has no words and fails. Repeated rows are judged one by one. An empty table gives an
    empty result. Columns other than the three named are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    measured = stored(with_measures(own, "text").drop("text").withColumns({"base_failed": base_failed(), "failed": rules_failed()}), "measures")
    return _judged(measured, "host")


def passing_quality(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The input rows, all columns, of documents that pass all rules on hosts that stay."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # own names, so that no input column can clash
    own = docs.toDF(*names)
    text, host = names[docs.columns.index(text_col)], names[docs.columns.index(host_col)]
    measured = stored(
        with_measures(own, text).withColumn("failed", rules_failed()).drop(*MEASURES), "measured-documents"
    )
    return _judged(measured.withColumn("host", F.col(host)), "host").filter("kept").select(*names).toDF(*docs.columns)
