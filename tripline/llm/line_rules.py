"""Quality rules, line first: clean lines, then judge what is left. Native columns.

Each line is held against three rules; failing lines go:

- punctuation: it does not end like a sentence, nor holds several ends as prose
  that was cut short does, or it is crowded with signs;
- navigation: several separators among few words;
- boilerplate: a short line with a stock phrase of web pages.

A document is rejected when the base counts fail it or when it loses more than
``max_loss`` of its word characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import SPACE, empty_as, indexes

#: Share of word characters a document may lose.
MAX_LOSS = 0.5
#: A line with a stock phrase is boilerplate up to so many words.
BOILERPLATE_WORDS = 20
#: Sentence ends within a line that pass for the one it lacks.
INNER_ENDS = 3
MIN_SEPARATORS, SEPARATOR_SHARE = 3, 0.3
#: Signs among the characters of a line, beyond which it is crowded.
SIGN_SHARE = 0.12
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"

#: Stock phrases of web pages, lower case.
PHRASES = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "click here", "read more", "sign in", "sign up", "log in",
    "subscribe to our newsletter", "share this", "skip to content", "powered by",
    "enable javascript", "back to top", "follow us",
)

_SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.filter(F.split(empty_as(text), SPACE + "+"), lambda word: word != "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeat_words(n: int = REPEAT_WINDOW) -> Column:
    """Words of column ``words`` inside n-word windows that occur twice or more.

    Windows are compared by 64-bit hash. Their sorted list brings equal ones
    together; only texts with a repeat pay for it.
    """
    hashes = F.transform(indexes(F.size("words") - (n - 1)),
                         lambda i: F.xxhash64(F.slice("words", i + 1, n)))

    def covered(grams: Column) -> Column:
        ordered = F.array_sort(F.transform(
            grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(o: Column) -> Column:
            twin = lambda j, d: F.get(o, j)["h"] == F.get(o, j + d)["h"]
            at = F.filter(indexes(F.size(o)), lambda j: F.coalesce(twin(j, -1), F.lit(False))
                          | F.coalesce(twin(j, 1), F.lit(False)))
            return F.array_sort(F.transform(at, lambda j: F.get(o, j)["i"]))

        # array(x) and transform: each step is worked out once
        found = F.get(F.transform(F.array(ordered), places), F.lit(0))
        return F.aggregate(
            found, F.struct(F.lit(0).alias("n"), F.lit(0).alias("reached")),
            lambda acc, i: F.struct(
                (acc["n"] + i + n - F.greatest(i, acc["reached"])).alias("n"),
                (i + n).alias("reached")),
            lambda acc: acc["n"])

    return F.get(F.transform(F.array(hashes), lambda g: F.when(
        F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g))), F.lit(0))


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks a rule."""
    count = F.size(words(line))
    separators = F.length(line) - F.length(without(line, "|»·›•"))
    signs = F.length(line) - F.length(without(line, SYMBOLS + "!=~^_{}[]\\"))
    ends = F.length(line) - F.length(without(line, ".!?…。"))
    punctuation = (~F.rlike(line, F.lit(r"[.!?…。][\"'”’»)\]]*[\x20\x09-\x0D]*\z"))
                   & (ends < INNER_ENDS)) | (signs > SIGN_SHARE * F.length(line))
    navigation = (separators >= MIN_SEPARATORS) & (separators >= SEPARATOR_SHARE * count)
    stock = F.rlike(F.lower(line), F.lit("|".join(PHRASES)))
    return punctuation | navigation | (stock & (count <= BOILERPLATE_WORDS))


def judge(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """One row per document: doc_id, counts, cleaned text and verdict.

    Null or empty text: no words, base_failed, cleaned text empty. Lines
    without a word are kept as they are. All is computed within the row.
    """
    text = empty_as(F.col("text"))
    rows = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("words"),
                       F.split(text, "\n").alias("all_lines"))
    has_word = lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "text", "words",
        F.filter("all_lines", has_word).alias("lines"),
        F.filter("all_lines", lambda line: ~(has_word(line) & line_fails(line))).alias("good"))
    chars = lambda c: F.length(without(c, _SPACES)).cast("long")
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        chars(F.col("text")).alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words().cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.array_join("good", "\n").alias("cleaned"))
    rows = rows.withColumn("kept_chars", chars(F.col("cleaned")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    enough = F.col("kept_chars") >= (1 - max_loss) * F.col("word_chars")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & enough)


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "kept_chars")
