"""Quality rules with adaptive thresholds, with built-in DataFrame functions only.

Each measure of a text goes into a quantile sketch for its language and source: counts of log-linear buckets, 32 to an
octave, so a quantile is exact to about 3 %. Sketches merge by adding counts, in any order with the same result. The
thresholds read from them replace fixed cutoffs and are joined back to the documents.

A group's sketch is blended with those of its language and of all texts, which count as ``PRIOR`` texts of it, so small groups
lean on them and large ones don't, without a switch in between.

Word length is held to its 90 % quantile and a multiple of its distance from the median. The other measures are 0 in nearly
all texts, so their limits come from the sketch of the texts that have any: its upper fence (third quartile and three times
the distance between the quartiles) over its 10 % quantile says by what factor such texts differ. Where they begin at a
single event (one sign, one repeated line, one stretch twice) that is the tail of ordinary texts and the limit is the fence;
where they begin far above it they are another kind of text, and the limit is that factor above a single event. What one
event makes is read from the sketch of the group's text sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialise

SPACE = "[\\x20\\x09-\\x0D]+"
MEASURES = ("symbols", "dup_lines", "repeats", "long_words")
#: The size that each measure is a share of, and what one event is: a sign, a line, a stretch of eight words and its twin.
UNITS = {"symbols": ("chars", 1), "dup_lines": ("lines", 1), "repeats": ("words", 16)}
PRIOR, FINE = 100, 1 << 20  # texts that the sketches of language and of everything count as; weights are whole numbers of this part of a text


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words that lie in ``window``-word stretches found twice or more in ``words``; ``window`` is a power of two.

    A stretch is known by a 64-bit hash built by doubling, so the work is linear; only texts in which some hash
    repeats are sorted.
    """
    def doubled(hashes: Column, step: int) -> Column:
        return let(hashes, lambda h: F.zip_with(h, F.slice(h, step + 1, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b)))

    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < window:
        hashes, step = doubled(hashes, step), step * 2
    hashes = let(hashes, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (window - 1), F.lit(0))))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.array_sort(F.filter(F.transform(s, lambda x, i: F.when((F.get(s, i - 1).h == x.h) | (F.get(s, i + 1).h == x.h), x.i)), lambda x: x.isNotNull())))
        gaps = let(starts, lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source`` and the counts of each whole text; null texts count nothing, repeated rows repeat."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words, lines = words_of(text), F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != "")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    ).select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")


def rates() -> dict[str, Column]:
    """The measures that get thresholds, as whole numbers: parts per million, and thousandths of a character.

    Four lines are added to a text's own, so that one repeated line of two or three isn't taken for half of a text.
    """
    def per(n: str, of: str, unit: int) -> Column:
        return F.expr(f"case when {of} > 0 then ({n} * {unit}) div {of} else 0 end")

    values = (per("n_symbols", "word_chars", 1_000_000), per("n_dup_lines", "(n_lines + 4)", 1_000_000), per("n_repeat_words", "n_words", 1_000_000), per("word_chars", "n_words", 1000))
    return dict(zip(MEASURES, values))


def bucket_of(v: Column) -> Column:
    """The log-linear bucket of a whole number, by whole-number steps alone."""
    top = F.length(F.bin(v)) - 1
    fine = F.expr("0").cast("long") + F.call_function("shiftright", v, F.greatest(top - 5, F.lit(0))).bitwiseAND(31)
    return F.when(v < 64, v).otherwise(top.cast("long") * 32 + fine)


def bucket_top(b: Column) -> Column:
    """The largest number of a bucket."""
    wide = F.greatest(F.floor(b / 32) - 5, F.lit(0)).cast("int")
    return F.when(b < 64, b).otherwise(F.call_function("shiftleft", (F.lit(33) + b % 32).cast("long"), wide) - 1)


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: the mergeable sketches of measures and sizes, from texts that pass the base rules.

    Tasks count their own texts first, so a hot source is a few rows from each; no text gives no rows.
    """
    sizes = {"chars": F.col("word_chars"), "words": F.col("n_words"), "line_words": F.expr("(n_words * 1000) div greatest(n_lines, 1)")}
    pairs = [F.struct(F.lit(k).alias("measure"), bucket_of(v).alias("bucket")) for k, v in (rates() | sizes).items()]
    rows = measured.filter("not base_failed").select("lang", "source", F.explode(F.array(*pairs)).alias("m"))
    return rows.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def blended(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """``lang, source, measure, bucket, w``: every group's sketch with those of its language and of all texts as a prior.

    Weights are whole numbers, so sums are exact in any order. The sketch of all texts has at most 2,016 buckets a measure and is
    broadcast; null is a language and a source of its own.
    """
    keyed = sketch.withColumns({"lang": F.struct(F.col("lang").isNull().alias("none"), F.coalesce("lang", F.lit("")).alias("name")), "source": F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))})
    by_lang = keyed.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("l_n"))
    every = keyed.groupBy("measure", "bucket").agg(F.sum("n").alias("e_n"))
    sizes = by_lang.groupBy("lang", "measure").agg(F.sum("l_n").alias("l_all"))
    total = every.groupBy("measure").agg(F.sum("e_n").alias("e_all"))
    rows = keyed.select("lang", "source", "measure").distinct().join(F.broadcast(every.join(total, "measure")), "measure").join(sizes, ["lang", "measure"])
    rows = rows.join(by_lang, ["lang", "measure", "bucket"], "left").join(keyed, ["lang", "source", "measure", "bucket"], "left")
    lean = F.col("e_n").cast("double") * prior / F.col("e_all").cast("double")
    lean = (F.coalesce("l_n", F.lit(0)).cast("double") + lean) * prior / (F.col("l_all") + prior).cast("double")
    w = F.coalesce("n", F.lit(0)) * FINE + F.floor(lean * FINE)
    named = [F.when(~F.col(f"{k}.none"), F.col(f"{k}.name")).alias(k) for k in ("lang", "source")]
    return rows.select(*named, "measure", "bucket", w.cast("long").alias("w"))


def thresholds(weights: DataFrame, spread: int = 8) -> DataFrame:
    """``lang, source`` and an upper limit for each measure, as told above; 0 where no text has any of it."""
    by = W.partitionBy("lang", "source", "measure")
    some = F.when(F.col("bucket") > 0, F.col("w")).otherwise(0)
    ranked = weights.select("*", F.sum("w").over(by.orderBy("bucket")).alias("upto"), F.sum("w").over(by).alias("total"), F.sum(some).over(by.orderBy("bucket")).alias("s_upto"), F.sum(some).over(by).alias("s_total"))
    least = [F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("bucket"))).alias(f"q{q}") for q in (50, 90)]
    least += [F.min(F.when((F.col("bucket") > 0) & (F.col("s_total") > 0) & (F.col("s_upto") * 100 >= F.col("s_total") * q), F.col("bucket"))).alias(f"s{q}") for q in (10, 25, 75)]
    read = ranked.groupBy("lang", "source", "measure").agg(*least)
    read = read.select("lang", "source", "measure", *[bucket_top(F.col(q)).alias(q) for q in ("q50", "q90", "s10", "s25", "s75")])

    def of(measure: str, what: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(what))).cast("double")

    def limit(m: str) -> Column:
        if m not in UNITS:
            return (of(m, "q90") + (of(m, "q90") - of(m, "q50")) * spread).cast("long")
        size = lambda k: F.greatest(of(k, "q50"), F.lit(1.0))
        sizes = {"chars": size("chars"), "words": size("words"), "lines": size("words") * 1000 / size("line_words") + 4}
        one = F.lit(UNITS[m][1] * 1_000_000.0) / sizes[UNITS[m][0]]
        fence = of(m, "s75") + (of(m, "s75") - of(m, "s25")) * 3
        return F.coalesce(F.floor(one * fence / F.greatest(of(m, "s10"), one)), F.lit(0)).cast("long")

    return read.groupBy("lang", "source").agg(*[limit(m).alias(f"limit_{m}") for m in MEASURES])


def quality_rules(docs: DataFrame, prior: int = PRIOR, spread: int = 8, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The counts, ``base_failed`` and ``kept`` of every document, with the limits that were applied.

    Null is a language and a source of its own; a null text fails the base rules; a group of which all texts fail them has no limits.
    Repeated rows repeat and count as often in the sketches; ties at a quantile go to the lower bucket. No documents give no rows.
    """
    counted = measures(docs, id_col, text_col, lang_col, source_col)
    counted = materialise(counted.withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)))
    limits = thresholds(blended(materialise(sketches(counted)), prior), spread)
    limits = materialise(limits.withColumnRenamed("lang", "t_lang").withColumnRenamed("source", "t_source"))
    joined = counted.join(limits, counted.lang.eqNullSafe(limits.t_lang) & counted.source.eqNullSafe(limits.t_source), "left")
    fine = F.lit(True)
    for m, v in rates().items():
        fine = fine & (v <= F.col(f"limit_{m}"))
    kept = ~F.col("base_failed") & F.coalesce(fine, F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), *[f"limit_{m}" for m in MEASURES])
