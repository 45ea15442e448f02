"""Quality rules with thresholds by language and source, read off mergeable quantile sketches.

Base counts of a document (words, symbols, repeated lines, repeated word
windows) are column expressions.  From documents that pass the base rule,
four measures go into mergeable quantile sketches: relative-error
histograms (DDSketch: Masson et al., 2019) whose bucket of x is
``floor(ln x / ln 1.02)``, so a sketch has at most some thousand buckets,
two sketches merge by adding counts, and any quantile is right to 2 %.
Sketches of (language, source) merge into those of the language and of the
whole.  A group's quantile is shrunk towards its language's, and that
towards the whole's, in buckets, with ``WEIGHT`` documents' worth of weight:
a small group borrows, a large one speaks for itself, and no size switches.

Word length has two fences, ``SPREAD`` interquartile ranges outside the
quartiles (in buckets, that is in ratios; a range counts one bucket more,
the sketch's resolution).

The shares of symbols, repeated lines and repeated windows are zero in most
documents, and a share says little where the text is short: one repeated
line of three is chance, fifty of a hundred aren't.  So their threshold is
a rate, the ``USUAL`` quantile of the group's shares, and a document is held
to the number of events it allows for: ``e = 1 + rate * units`` are
expected, one being the grace that a first event has, and more than
``e + SPREAD * sqrt(e)`` are too many.  Events are symbols, repeated lines
and repeated windows (six words: a window and its copy).

A document is kept if the base rule passes and no measure is outside;
thresholds come by a join on (language, source).

All of it is built-in functions: no Python runs on the executors.  The text
is read once; narrow counts are written and used by both passes.  Sketch
rows are summed before they are shuffled, so a source with a third of all
rows sends as many rows as any other.

Defined results: a null or empty text has zero words and fails the base
rule; null languages and sources are groups of their own; a null id is
carried through; repeated rows are judged alike; an empty table gives an
empty result.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.functions.text import SPACES, let, words
from sievework.plans.shared import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Documents that a larger group counts for when a smaller one's quantiles are shrunk towards it.
WEIGHT = 200
#: Interquartile ranges between a quartile and its fence, and standard deviations of a count.
SPREAD = 6
#: Ratio of neighbouring buckets.
RATIO = 1.02
#: The quantile of the group's shares that is its usual rate, in tenths.
USUAL = 9
#: Shares: (name, counted column, column of the units, counted units of an event).
SHARES = (
    ("symbol_share", "n_symbols", "word_chars", 1),
    ("dup_line_share", "n_dup_lines", "n_lines", 1),
    ("repeat_share", "n_repeat_words", "n_words", 6),
)
#: Groups up to which the table of fences is broadcast (some hundred bytes a row); a shuffled join beyond.
BROADCAST_GROUPS = 50_000


def _repeat_words(w: Column) -> Column:
    """Words in three-word windows that the text holds twice or more: windows sorted with their places, equal neighbours marked."""
    window = lambda i: F.struct(F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("k"), i.alias("p"))
    ordered = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(w) - 2), window))

    def covered(s: Column) -> Column:
        same = lambda x, i: ((i > 0) & (F.get(s, i - 1)["k"] == x["k"])) | (F.get(s, i + 1)["k"] == x["k"])
        places = F.transform(F.filter(s, same), lambda x: x["p"])
        return let(places, lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda a: a + 1), F.transform(p, lambda a: a + 2)))))

    return F.when(F.size(w) > 2, let(ordered, covered)).otherwise(0)


def base_counts(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """Narrow rows with the base counts of every document, written once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    letters = F.translate(text, SPACES + " ", "")
    with_word = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES + " ", "") != "")
    lines = let(with_word, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("different")))
    of_words = let(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.length(letters).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        of_words.alias("of_words"),
    ).select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.col("of_words.n").cast("long").alias("n_words"),
        F.col("of_words.repeat").cast("long").alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.different")).cast("long").alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return materialize(rows.withColumn("base_failed", failed), "quality-counts")


def bucket(x: Column) -> Column:
    """A sketch's bucket of a whole number; zero has one of its own, -1."""
    return F.when(x > 0, F.floor(F.log(x.cast("double")) / F.log(F.lit(RATIO)))).otherwise(F.lit(-1)).cast("int")


def _measures() -> dict[str, Column]:
    share = lambda a, b: bucket(F.floor(1000 * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long"))
    return {"word_length": share("word_chars", "n_words")} | {name: share(n, of) for name, n, of, _ in SHARES}


def sketches(counts: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, measure, bucket, n) of the documents that pass the base rule."""
    cells = F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("bucket")) for k, v in _measures().items()])
    long = counts.where(~F.col("base_failed")).select("lang", "source", F.explode(cells).alias("cell"))
    return long.groupBy("lang", "source", "cell.measure", "cell.bucket").agg(F.count("*").alias("n"))


def merge(rows: DataFrame, *keys: str) -> DataFrame:
    """Merge sketches to those of ``keys``."""
    return rows.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, measure, q): rows and buckets at the quartiles and at ``USUAL`` of sketches; a sketch has at most some thousand buckets."""
    of = Window.partitionBy(*keys, "measure")
    upto = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(of))
    at = lambda k, of: F.min(F.when(of * F.col("upto") >= k * F.col("all"), F.col("bucket")))
    return summed.groupBy(*keys, "measure").agg(F.struct(F.max("all").alias("rows"), at(1, 4).alias("q1"), at(3, 4).alias("q3"), at(USUAL, 10).alias("usual")).alias("q"))


def _shrunk(own: Column, larger: Column, name: str) -> Column:
    """A quantile of ``own`` drawn towards ``larger``, a whole bucket."""
    return F.floor((own["rows"] * own[name] + WEIGHT * larger[name]) / (own["rows"] + WEIGHT)).cast("int")


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang, source, word_length_low, word_length_high, <share>_rate): fences and rates in buckets for every group in the sketches."""
    rows = materialize(rows, "quality-sketches")
    names = ("q1", "q3", "usual")
    shrink = lambda own, larger: F.struct(own["rows"].alias("rows"), *[_shrunk(own, larger, n).alias(n) for n in names])
    whole = quantiles(merge(rows)).select(F.col("measure").alias("w_measure"), F.col("q").alias("w"))  # a row a measure
    by_lang = quantiles(merge(rows, "lang"), "lang").join(F.broadcast(whole), F.col("measure") == F.col("w_measure"))
    by_lang = by_lang.select(F.col("lang").alias("l_lang"), F.col("measure").alias("l_measure"), shrink(F.col("q"), F.col("w")).alias("l"))
    own = quantiles(rows, "lang", "source")
    chosen = own.join(by_lang, own["lang"].eqNullSafe(F.col("l_lang")) & (own["measure"] == F.col("l_measure"))).select("lang", "source", "measure", shrink(F.col("q"), F.col("l")).alias("q"))
    of = lambda name, value: F.max(F.when(F.col("measure") == name, value))
    spread = SPREAD * (F.col("q.q3") - F.col("q.q1") + 1)
    out = [of("word_length", F.col("q.q1") - spread).alias("word_length_low"), of("word_length", F.col("q.q3") + spread).alias("word_length_high")]
    out += [of(name, F.col("q.usual")).alias(f"{name}_rate") for name, *_ in SHARES]
    return materialize(chosen.groupBy("lang", "source").agg(*out), "quality-thresholds")


def _within(count: str, units: str, per_event: int, rate: Column) -> Column:
    """Whether a document's events are no more than its units allow for at a rate given as a bucket of thousandths."""
    usual = F.when(rate < 0, F.lit(0.0)).otherwise(F.pow(F.lit(RATIO), rate + 1))
    expected = 1 + usual * F.col(units) / (1000 * per_event)
    return F.col(count) / per_event <= expected + SPREAD * F.sqrt(expected)


def judge(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """One row per document: counts, base_failed and kept."""
    counts = base_counts(docs, id_col, text_col, lang_col, source_col)
    limits = thresholds(sketches(counts)).withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    limits = F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS else limits
    joined = counts.join(limits, counts["lang"].eqNullSafe(F.col("f_lang")) & counts["source"].eqNullSafe(F.col("f_source")), "left")
    inside = _measures()["word_length"].between(F.col("word_length_low"), F.col("word_length_high"))
    for name, count, units, per_event in SHARES:
        inside = inside & _within(count, units, per_event, F.col(f"{name}_rate"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(F.coalesce(inside, F.lit(True))).alias("kept"),
    )
