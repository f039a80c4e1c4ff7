"""Quality rules over whole texts, in built-in expressions only.

Base rules count words, symbols, repeated lines and words in repeated five-word windows. The method
compares two histograms of a document with those of its language, by Jensen-Shannon distance:
kinds of characters, and the commonest words. Languages are measured over all documents that are
long enough to be judged themselves and near to most of their language; a language without a word
list here is one of a group that is measured with a list mixed from all of them. Documents below the
minimum length are left to the base rules.

Null texts count as empty: no words, which the base rules refuse. Very long texts are judged whole, repeated
rows alike. Distances that tie with a limit pass. An empty table gives no rows. Only ``doc_id``, ``text`` and
``lang`` are read, so further columns may have any name.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skymetrics.llm.common import documents, stored

# The base rules.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
PUNCTUATION = r"[.,;:!?'\"()-]"
RUN = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# The method: shorter documents are not compared; further ones than this are refused, by either
# distance or by both together.
COMPARED_WORDS = 50
CHARACTER_LIMIT = 0.3
WORD_LIMIT = 0.42
JOINT_LIMIT = 0.47

# Parts of the range of distances that medians are looked for in.
BINS = 1_000_000

# The commonest words of each language, by general frequency lists.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it as was with be by on not he his from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}
MIXED_WORDS = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words[:5]))
_ALL_WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})
OTHER = "other"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many of an array's words lie in a window of ``RUN`` words that it has twice or more.

    Windows are told apart by their 64-bit hashes. Only texts that repeat a window are sorted.
    """

    def window(w: Column) -> Callable[[Column], Column]:
        return lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(RUN)])

    def covered(starts: Column) -> Column:
        def step(x: Column, k: Column) -> Column:
            return F.least(F.lit(RUN), F.coalesce(F.get(starts, k + 1) - x, F.lit(RUN)))

        return F.aggregate(F.transform(starts, step), F.lit(0).cast("long"), lambda a, b: a + b)

    def twice(hashes: Column) -> Column:
        def same(s: Column) -> Callable[[Column, Column], Column]:
            return lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])

        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        starts = let(F.sort_array(placed), lambda s: F.transform(F.filter(s, same(s)), lambda x: x["i"]))
        return let(F.sort_array(starts), covered)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(twice(hashes))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - RUN), window(w))

    return let(words, lambda w: F.when(F.size(w) >= RUN, let(windows(w), count)).otherwise(0)).cast("long")


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def _common_words(words: Column, language: Column) -> Column:
    """How often each common word of the language occurs, and all other words."""
    lists = F.array(*map(F.lit, MIXED_WORDS))
    for name, listed in COMMON_WORDS.items():
        lists = F.when(language == name, F.array(*map(F.lit, listed))).otherwise(lists)
    found = F.filter(F.transform(words, F.lower), lambda w: w.isin(_ALL_WORDS))

    def counts(f: Column) -> Column:
        return F.transform(lists, lambda k: F.size(F.filter(f, lambda w: w == k)).cast("long"))

    def with_rest(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b)
        return F.concat(c, F.array(F.size(words) - total))

    return let(let(found, counts), with_rest)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, base counts, language, characters, common) of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    known = F.col("lang").isin(list(COMMON_WORDS))
    language = F.when(known, F.col("lang")).otherwise(OTHER)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    upper, digits, points = (F.regexp_count("text", F.lit(p)) for p in (r"\p{Lu}", "[0-9]", PUNCTUATION))
    size, rest = F.length("text"), F.length(F.regexp_replace("text", r"\p{L}+", ""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
            _common_words(w, F.col("language")).alias("common"),
        )

    characters = [upper, size - rest - upper, digits, points, F.col("n_symbols"), size - F.col("word_chars")]
    return (
        docs.select("doc_id", text.alias("text"), language.alias("language"))
        .withColumns(
            {
                "word_chars": F.length(F.regexp_replace("text", SPACE, "")).cast("long"),
                "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
                "n_dup_lines": _repeated_lines(F.col("text")),
                "of_words": let(words, of_words),
            }
        )
        .select(
            "doc_id",
            "language",
            "of_words.n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "of_words.n_repeat_words",
            F.array(*[c.cast("long") for c in characters]).alias("kinds"),
            size.cast("long").alias("n_chars"),
            "of_words.common",
        )
        .withColumn("kinds", let(F.col("kinds"), lambda k: F.concat(k, F.array(F.col("n_chars") - _sum(k)))))
        .drop("n_chars")
    )


def _sum(values: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(values, zero, lambda a, b: a + b)


def distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms, 0 to 1; null if one of them is empty."""

    def shares(v: Column) -> Column:
        return let(F.nullif(_sum(v), F.lit(0)), lambda n: F.transform(v, lambda x: x / n))

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def both(p: Column, q: Column) -> Column:
        return part(p, q) + part(q, p)

    total = F.aggregate(F.zip_with(shares(a), shares(b), both), F.lit(0.0), lambda x, y: x + y)
    return let(total, lambda t: F.when(t <= 0, 0.0).otherwise(F.sqrt(t / 2)))


def _summed(long: DataFrame) -> DataFrame:
    """(language, kinds_of, common_of): the summed histograms of each language."""

    def summed(column: str) -> DataFrame:
        return (
            long.select("language", F.posexplode(column).alias("at", "n"))
            .groupBy("language", "at")
            .agg(F.sum("n").alias("n"))
            .groupBy("language")
            .agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("pairs"))
            .select("language", F.col("pairs.n").alias(f"{column}_of"))
        )

    return summed("kinds").join(summed("common"), "language")


def compared(measured: DataFrame, references: DataFrame) -> DataFrame:
    """Adds the distances of each document to its language."""
    # One row for each listed language and one for all others.
    joined = measured.join(F.broadcast(references), "language", "left")
    return joined.withColumns(
        {
            "kinds_distance": distance(F.col("kinds"), F.col("kinds_of")),
            "common_distance": distance(F.col("common"), F.col("common_of")),
        }
    ).drop("kinds_of", "common_of")


def medians(near: DataFrame, distance: str, name: str) -> DataFrame:
    """(language, ``name``): the smallest distance that half of a language's rows do not exceed.

    Exact, and without sorting a language in one task: rows are counted per ``BINS``-th of the range, of which
    there are so many at most, and only the values of the one with the median are looked at.
    """
    known = near.where(F.col(distance).isNotNull())
    bin_ = F.floor(F.col(distance) * BINS).alias("bin")
    counts = known.groupBy("language", bin_).agg(F.count("*").alias("n"))
    all_ = Window.partitionBy("language")
    upto = all_.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.ceil(F.sum("n").over(all_) / 2)
    sums = counts.select("language", "bin", "n", F.sum("n").over(upto).alias("upto"), middle.alias("middle"))
    place = F.col("middle") - (F.col("upto") - F.col("n"))
    holding = sums.where((place >= 1) & (place <= F.col("n"))).select("language", "bin", place.alias("place"))
    # One row for each listed language and one for all others.
    inside = known.select("language", F.col(distance).alias("value"), bin_).join(F.broadcast(holding), ["language", "bin"])
    values = inside.groupBy("language", "place", "value").agg(F.count("*").alias("n"))
    reach = F.sum("n").over(Window.partitionBy("language").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    far_enough = values.withColumn("reach", reach).where(F.col("reach") >= F.col("place"))
    return far_enough.groupBy("language").agg(F.min("value").alias(name))


def references(measured: DataFrame) -> DataFrame:
    """(language, kinds_of, common_of), so that junk among the documents tells little.

    Of the documents that are long enough and pass the base rules, those count that are no further
    from the sum of all of these than half of their language is.
    """
    long = measured.where((F.col("n_words") >= COMPARED_WORDS) & ~base_failed())
    near = stored(compared(long, _summed(long)), "near")
    half = medians(near, "kinds_distance", "kinds_half").join(
        medians(near, "common_distance", "common_half"), "language", "full"
    )
    # One row for each listed language and one for all others.
    core = near.join(F.broadcast(half), "language").where(
        (F.col("kinds_distance") <= F.col("kinds_half")) | (F.col("common_distance") <= F.col("common_half"))
    )
    return _summed(core)


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


def judge(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every row of ``docs``."""
    measured = stored(measure(docs), "measured")
    judged = compared(measured, stored(references(measured), "references"))
    enough = F.col("n_words") >= COMPARED_WORDS
    kinds, common = F.col("kinds_distance"), F.col("common_distance")
    # Short documents are left to the base rules.
    kinds, common = F.when(enough, kinds), F.when(enough, common)
    far = (kinds > CHARACTER_LIMIT) | (common > WORD_LIMIT) | (kinds + common > JOINT_LIMIT)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        kinds.alias("kinds_distance"),
        common.alias("common_distance"),
        (~base_failed() & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).drop("kinds_distance", "common_distance")
