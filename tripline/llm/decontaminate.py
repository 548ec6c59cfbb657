"""Benchmark decontamination by winnowing, in native columns.

Every k-gram of words is hashed; in each run of w neighbouring k-grams the
smallest hash is kept. Two texts that share k + w - 1 words therefore keep a
k-gram in common inside that span. Fingerprints of documents and items meet in
an equality join, and each meeting is extended, word by word, as far as a
window can reach. With k = 5 and w = 6 no shared window of 10 words is missed,
and the words decide, so a clash of hashes adds nothing.

Items with fewer words than a window count whole: their own length is the k of
a second set of anchors, made only for lengths that occur.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import ascii_lower, empty_as, indexes, long, text_key
from tripline.sources.session import settle

#: Words of a window, and of a k-gram; w follows.
WINDOW, GRAM = 10, 5
#: Bits that hold a position beside its hash; longer texts than 67 million words are refused.
POSITION_BITS = 26
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

KEYS = ("doc_id", "text_hash")


def words(text: Column) -> Column:
    """Runs of digits, letters and all beyond ASCII, after lower-casing A-Z; null has none."""
    return F.filter(F.split(ascii_lower(empty_as(text)), NOT_WORD), lambda word: word != "")


def _grams(gram: int) -> Column:
    """Packed (hash, position) of every k-gram of column ``words``."""
    mask = long((1 << POSITION_BITS) - 1)
    return F.transform(indexes(F.size("words") - (gram - 1)), lambda i: F.xxhash64(
        F.slice("words", i + 1, gram)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))


def _winnowed(run: int) -> Column:
    """The smallest of each ``run`` neighbours in column ``packed``, each once."""
    return F.array_distinct(F.transform(
        indexes(F.size("packed") - (run - 1)),
        lambda j: F.array_min(F.slice("packed", j + 1, run))))


def _anchors(df: DataFrame, keep: list[str], window: int, gram: int,
             with_rows: bool = False) -> DataFrame:
    """One row per kept k-gram: ``keep``, hash, pos and the words a window through it can hold.

    ``around`` has these words, a space between, from window - gram before the
    k-gram on as far as the text goes. ``with_rows`` adds a row without a position
    for each row of ``df``, so that one pass gives both; its hash is beyond those of
    k-grams, and another for each text, so that a join spreads these rows too.
    """
    reach = window - gram
    df = df.withColumn("packed", _grams(gram))
    if reach:
        df = df.withColumn("packed", _winnowed(reach + 1))

    def entry(p: Column) -> Column:
        pos = p.bitwiseAND(long((1 << POSITION_BITS) - 1)).cast("int")
        first = F.greatest(F.lit(0), pos - reach)
        return F.struct(
            F.shiftright(p, POSITION_BITS).alias("hash"), pos.alias("pos"),
            F.array_join(F.slice("words", first + 1, pos - first + gram + reach), " ")
            .alias("around"))

    entries = F.transform("packed", entry)
    if with_rows:
        own = F.col("text_hash").bitwiseAND(long(2**62 - 1)).bitwiseOR(long(2**62))
        none = F.struct(own.alias("hash"),
                        F.lit(None).cast("int").alias("pos"),
                        F.lit(None).cast("string").alias("around"))
        entries = F.concat(F.array(none), entries)
    return df.select(*keep, F.explode(entries).alias("a")).select(
        *keep, "a.hash", "a.pos", "a.around")


def _places(around: Column, pos: Column, reach: int, span: int) -> Column:
    """The words of ``around`` at fixed places, the k-gram's first word at ``reach``."""
    ahead = F.greatest(F.lit(0), F.lit(reach) - pos)
    parts = F.split(around, " ")
    return F.array(*(F.get(parts, F.lit(i) - ahead) for i in range(span)))


def _met(anchors: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """Document words [start, end) that an item's window covers, one row per meeting.

    Rows without a position stay, without an item.
    """
    reach = window - gram
    span = gram + 2 * reach
    same = lambda i: F.get("own", F.lit(i)) == F.get("other", F.lit(i))

    def run(places: list[int]) -> Column:
        """How many of ``places`` agree, from the first on."""
        out = F.lit(len(places))
        for at in reversed(range(len(places))):
            out = F.when(same(places[at]), out).otherwise(F.lit(at))
        return out

    core = reduce(lambda a, b: a & b, [same(i) for i in range(reach, reach + gram)])
    rest = [c for c in anchors.columns if c not in ("hash", "pos", "around")]
    met = anchors.join(items, "hash", "left").where("pos IS NULL OR item_around IS NOT NULL")
    met = (met.withColumn("own", _places(F.col("around"), F.col("pos"), reach, span))
           .withColumn("other", _places(F.col("item_around"), F.col("item_pos"), reach, span))
           .withColumn("left", run(list(range(reach - 1, -1, -1))))
           .withColumn("right", run(list(range(reach + gram, span)))))
    return met.where(F.col("pos").isNull() | (
        core & (F.col("left") + F.col("right") + gram >= window))).select(
        *rest, "item_id", (F.col("pos") - F.col("left")).alias("start"),
        (F.col("pos") + gram + F.col("right")).alias("end"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         gram: int = GRAM) -> DataFrame:
    """doc_id, text_hash, n_words, item_id, start, end: word spans found in items.

    Spans of one document may overlap; one row of each document has no span.
    Null and empty texts have no others. The item anchors are written once, so
    Catalyst knows their size: it broadcasts them below its threshold, and
    beyond it joins by shuffle with AQE splitting a crowded hash.
    """
    source = docs.select("doc_id", text_key("text").alias("text_hash"),
                         words(F.col("text")).alias("words")).withColumn(
        "n_words", F.when(F.size("words") < 1 << POSITION_BITS, F.size("words").cast("long")).otherwise(
            F.raise_error(F.lit(f"a text has 2**{POSITION_BITS} words or more"))))
    keep = [*KEYS, "n_words"]
    tests = settle(benchmark.select(
        "item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0),
        "benchmark-words")
    short = [r.n for r in tests.select(F.size("words").alias("n")).where(
        F.col("n") < window).distinct().collect()]  # at most window - 1 numbers

    def meet(items: Column, window: int, gram: int, with_rows: bool) -> DataFrame:
        anchors = settle(
            _anchors(tests.where(items), ["item_id"], window, gram).select(
                "item_id", "hash", F.least("pos", F.lit(window - gram)).alias("item_pos"),
                F.col("around").alias("item_around")).distinct(), "benchmark-anchors")
        return _met(_anchors(source, keep, window, gram, with_rows), anchors, window, gram)

    found = meet(F.size("words") >= window, window, gram, True)
    for length in sorted(short):
        found = found.union(meet(F.size("words") == length, length, length, False))
    return settle(found, "hits")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted texts), contaminated.

    Null or empty text: no words, not contaminated. An item without an id counts for hits, but has no place in items. Repeated rows get equal
    results each. Other columns are ignored.
    """
    found = hits(docs, benchmark, window, gram)
    merged = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("reached")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["reached"])))
            .alias("n"), F.greatest(acc["reached"], s["end"]).alias("reached")),
        lambda acc: acc["n"])
    hit = found.where("start IS NOT NULL").groupBy(*KEYS).agg(
        F.collect_set(F.struct("start", "end")).alias("spans"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"),
    ).select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"),
             merged.cast("long").alias("n_hit"), F.array_sort("items").alias("items"))
    base = found.where("start IS NULL").select(*KEYS, "n_words")
    joined = base.join(hit, base["doc_id"].eqNullSafe(hit["hit_id"])
                       & (base["text_hash"] == hit["hit_hash"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", long(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", long(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          gram: int = GRAM) -> DataFrame:
    """The documents without a hit, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_key("text").alias("text_hash"))
    bad = settle(hits(docs, benchmark, window, gram).where("start IS NOT NULL").select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "bad")
    return rows.join(bad, rows["doc_id"].eqNullSafe(bad["bad_id"])
                     & (rows["text_hash"] == bad["bad_hash"]), "left_anti").select("row.*")
