"""Quality rules with adaptive thresholds (DataFrame functions only).

Each document gets word, symbol, line and repetition counts.  Instead of fixed
cutoffs, the verdict compares four rates with fences read from mergeable
quantile sketches: one for each (lang, source), added up to one for each
language and one for the corpus.  A sketch is a histogram of fixed resolution,
counts of a rate rounded down to whole ``STEPS`` of it: it merges by addition,
in any order, to the same counts, so reruns agree and a task that is run again
changes nothing; ranks are exact and values are off by less than a step.  A
share has 10,001 counters at most; mean word lengths count as ``LONGEST`` at
most, which makes 10^6 counters.  The fence of a rate is

    q75 + max(SPREADS * (q75 - q25), least distance of that rate)

over the documents that pass the base rules, so that a rate is odd only by its
own language and source.  A group of ``min_rows`` documents or more uses its
own fence, but none looser than its language's by more than the least distance
(a source full of junk must not excuse its junk; one of tables or listings may
stand somewhat above its language); smaller groups take the language's fence,
small languages the corpus's.

Nulls: a null text has no words (all counts 0, rejected by the base rule); a
null lang or source is a group of its own.  Repeated rows are judged alike and
all stay or go.  An empty table gives an empty result.  Columns beyond
doc_id, text, lang and source are ignored by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import BLANKS, cut, row_key

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MIN_ROWS = 30
SPREADS = 3.0
#: Steps of a sketch in a unit of its rate, and the mean word length that longer ones count as.
STEPS, LONGEST = {"symbol_rate": 10_000, "dup_line_rate": 10_000, "repeat_rate": 10_000, "word_length": 100}, 10_000
#: Parts that the rows of one (lang, source) are dealt into where they meet their fences.
SALTS = 32
#: The least distance of a fence from q75, by rate.
LEAST = {"symbol_rate": 0.04, "dup_line_rate": 0.4, "repeat_rate": 0.35, "word_length": 2.0}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _same_as_neighbour(ordered: Column, same) -> Column:
    """Items of an ordered array that ``same`` finds equal to the one before or after."""
    kept = F.transform(ordered, lambda x, i: F.when(same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)), x))
    return F.filter(kept, lambda x: x.isNotNull())


def _once(value: Column, then) -> Column:
    """then(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), then), 0)


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    A window becomes one long: a hash above, its place in the low bits that n
    needs.  Sorted as primitives, windows of equal hashes are neighbours.  Only
    those, the candidates, are then compared as words, in order of the words;
    the places of equal ones, sorted again, cover min(3, gap to the place
    before) words each.
    """
    bits = F.ceil(F.log2(n + F.lit(2))).cast("int")
    low = F.call_function("shiftleft", F.expr("cast(1 as bigint)"), bits) - 1
    place = lambda i: F.call_function("shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits).bitwiseOR(i.cast("bigint"))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), place)).otherwise(F.array().cast("array<bigint>"))
    near = lambda a, b: F.coalesce(F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits), F.lit(False))
    candidates = _once(F.sort_array(windows), lambda s: F.transform(_same_as_neighbour(s, near), lambda x: x.bitwiseAND(low).cast("int")))
    spelled = F.transform(candidates, lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.cast("bigint").alias("i")))
    equal = lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))
    twice = _once(F.array_sort(spelled), lambda s: F.array_sort(F.transform(_same_as_neighbour(s, equal), lambda x: x["i"])))
    return F.aggregate(
        twice,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).cast("bigint").alias("p")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3).cast("bigint"), p - acc["p"])).alias("n"), p.alias("p")),
        lambda acc: acc["n"],
    )


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The base counts of every row, one pass without a shuffle, beside the columns named in keep."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = docs.select(*keep, text.alias("__text"))
    one = one.withColumns({"__words": _words(F.col("__text")), "__lines": F.filter(F.split("__text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)})
    one = one.withColumn("__n", F.size("__words"))
    bare = F.translate("__text", BLANKS, "")
    return one.select(
        *keep,
        F.col("__n").cast("bigint").alias("n_words"),
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        F.coalesce(_repeat_words(F.col("__words"), F.col("__n")), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


#: A rate's counts: (above, below).
RATES = {"symbol_rate": ("n_symbols", "word_chars"), "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}


def _steps(name: str) -> Column:
    """A rate in whole steps, rounded down; 0 without a count below."""
    above, below = RATES[name]
    steps = F.when(F.col(below) > 0, F.expr(f"{STEPS[name]} * {above} div {below}")).otherwise(0)
    return F.least(steps, F.lit(LONGEST * STEPS[name])).cast("bigint")


def _least(name: str) -> int:
    return round(LEAST[name] * STEPS[name])


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(counted: DataFrame) -> DataFrame:
    """(level, lang, source, rate, step, n): the histograms of documents that pass the base rules.

    level is 0 for a (lang, source), 1 for a language and 3 for the corpus.
    Counted map-side and then merged upwards, small tables both times.
    """
    each = F.array(*[F.struct(F.lit(name).alias("rate"), _steps(name).alias("step")) for name in RATES])
    own = counted.filter(~_base_failed()).select("lang", "source", F.inline(each)).groupBy("lang", "source", "rate", "step").agg(F.count("*").alias("k"))
    sets = [["lang", "source", "rate", "step"], ["lang", "rate", "step"], ["rate", "step"]]
    merged = own.groupingSets([[F.col(c) for c in s] for s in sets], "lang", "source", "rate", "step").agg(F.grouping_id("lang", "source", "rate", "step").alias("g"), F.sum("k").alias("n"))
    return merged.select((F.col("g") / 4).cast("int").alias("level"), "lang", "source", "rate", "step", "n")


def _levels(counted: DataFrame) -> DataFrame:
    """(level, lang, source, n, f_<rate>...): the fence, in steps, of every sketch, by nearest ranks."""
    by = ["level", "lang", "source", "rate"]
    whole, upto = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketches(counted).withColumns({"__all": F.sum("n").over(whole), "__upto": F.sum("n").over(upto)})
    quantile = lambda k: F.min(F.when(4 * F.col("__upto") >= k * F.col("__all"), F.col("step")))
    least = F.create_map(*[F.lit(x) for name in LEAST for x in (name, _least(name))])[F.col("rate")]
    spread = ranked.groupBy(*by).agg(F.first("__all").alias("n"), quantile(1).alias("q1"), quantile(3).alias("q3"))
    fence = F.col("q3") + F.greatest(F.lit(SPREADS) * (F.col("q3") - F.col("q1")), least)
    return spread.withColumn("f", fence).groupBy("level", "lang", "source").agg(F.first("n").alias("n"), *[F.max(F.when(F.col("rate") == name, F.col("f"))).alias(f"f_{name}") for name in LEAST])


def fences(counted: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(lang, source, f_<rate>...): the fences, in steps, for every (lang, source) of counted.

    Groups without a document that passes the base rules still get a row, from the level above.
    """
    known = cut(_levels(counted))
    level = lambda k, tag: known.filter(F.col("level") == k).select(F.col("lang").alias(f"__lang_{tag}"), F.col("source").alias(f"__source_{tag}"), F.col("n").alias(f"n_{tag}"), *[F.col(f"f_{n}").alias(f"{tag}_{n}") for n in LEAST])
    own, lang, corpus = level(0, "g"), level(1, "l"), level(3, "c")
    found = counted.select("lang", "source").distinct()
    found = found.join(own, F.col("lang").eqNullSafe(F.col("__lang_g")) & F.col("source").eqNullSafe(F.col("__source_g")), "left").join(lang, F.col("lang").eqNullSafe(F.col("__lang_l")), "left")
    found = found.join(F.broadcast(corpus), F.lit(True), "left")  # one row
    out = ["lang", "source"]
    for n in LEAST:
        above = F.when(F.col("n_l") >= min_rows, F.col(f"l_{n}")).otherwise(F.col(f"c_{n}"))
        out.append(F.when(F.col("n_g") >= min_rows, F.least(f"g_{n}", above + _least(n))).otherwise(above).alias(f"f_{n}"))
    return found.select(*out)


def _judged(counted: DataFrame, min_rows: int) -> DataFrame:
    limits = fences(counted.select("lang", "source", *COUNTS, "n_lines"), min_rows).withColumnsRenamed({"lang": "__lang", "source": "__source"})
    # a row for each group and salt, so that a source with a third of all rows is no one task's
    limits = limits.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = counted.withColumn("__salt", F.pmod(F.xxhash64(*counted.columns), F.lit(SALTS)).cast("int"))
    both = dealt.join(limits, (dealt["__salt"] == limits["__part"]) & dealt["lang"].eqNullSafe(limits["__lang"]) & dealt["source"].eqNullSafe(limits["__source"]), "left")
    within = F.lit(True)
    for n in RATES:
        within = within & F.coalesce(_steps(n) <= F.col(f"f_{n}"), F.lit(True))
    return both.withColumn("base_failed", _base_failed()).withColumn("kept", ~F.col("base_failed") & within)


def score(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed and kept."""
    counted = cut(counts(docs, "doc_id", "lang", "source"))
    return _judged(counted, min_rows).select("doc_id", *COUNTS, "base_failed", "kept")


def keep(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of docs, all their columns, that the verdict keeps."""
    key = row_key(F.col("doc_id"), F.col("text"))
    counted = cut(counts(docs.withColumn("__key", key).select("__key", "text", "lang", "source"), "__key", "lang", "source"))
    good = _judged(counted, min_rows).filter("kept").select("__key").distinct()
    columns = docs.columns
    return docs.withColumn("__key", key).join(good, "__key", "left_semi").select(*[f"`{c}`" for c in columns])
