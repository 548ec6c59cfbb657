"""Divergence of sources: how far the word use of each lies from the others of its language.

Terms are counted per (lang, source) within tasks, added up by a shuffle, and kept
where at least ``LEAST_DOCS`` documents of the language hold them. A kept term
has the smoothed share p = 1 + floor(10^9 (count + 2) / (N + 2 V)) in a group, in
whole numbers throughout.

Pairs are compared on a cube. The groups of a language are dealt to group blocks and its
terms to term blocks; a task owns a cell (group block, group block, term block),
gets the slices of both group blocks there, and sums (p - q)^2 / (p + q), rounded down
by term, over its terms for each pair. Sums over the term axis make the
divergences. A slice is copied once for each group block of its language. Terms that no
group of a cell holds are not sent: they all have the shares of a count of 0 and
are added once at the end.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripline.llm.common import long
from tripline.sources.session import settle

LEAST_DOCS = 10
SCALE_STEPS = 3  # of a thousand each: shares are in parts of 10^9
TOP = 10
#: Groups and terms of a block, about.
GROUP_BLOCK, TERM_BLOCK = 64, 2048
#: Entries of a task's table of counts before it is sent on.
MOST_ENTRIES = 200_000
#: Bytes of text split at once.
PIECE = 1 << 22

COUNTS = "lang string, source string, term string, n long, docs long"
#: A-Z in lower case, other signs of ASCII as spaces; all else belongs to words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32
                 for c in range(256))


def words(text: str) -> Iterator[list[bytes]]:
    """The words of ``text`` in UTF-8, in portions."""
    data = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            end = cut if cut > at else data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by lang, source and term; a null term counts the group's rows."""
    counts: dict[tuple, dict[bytes, list[int]]] = {}
    entries = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in counts.items():
            if terms:
                n, docs = zip(*terms.values())
                size = len(terms)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size), pa.array([source] * size),
                     pa.array(list(terms), pa.binary()).cast(pa.string()),
                     pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([source]), pa.array([None], pa.string()),
                 pa.array([0], pa.int64()), pa.array([0], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")))
        for lang, source, text in rows:
            terms = counts.setdefault((lang, source), {})
            before, found = len(terms), Counter()
            for portion in words(text):
                found.update(portion)
            for term, n in found.items():
                if term in terms:
                    seen = terms[term]
                    seen[0] += n
                    seen[1] += 1
                else:
                    terms[term] = [n, 1]
            entries += len(terms) - before
            if entries > MOST_ENTRIES:
                yield from flushed()
                entries = 0
    yield from flushed()


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs; and one row with a null term for every group."""
    empty = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*empty).mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, divisor: Column) -> Column:
    """1 + floor(10^9 (count + 2) / divisor), by long division, a thousand at a time: no
    product exceeds a long for divisors below 9 * 10^15."""
    whole, rest = long(0), count + 2
    steps = []
    for step in range(SCALE_STEPS):
        rest = rest * 1000
        steps.append((rest, 1000 ** (SCALE_STEPS - 1 - step)))
        rest = rest % divisor
    for value, scale in steps:
        whole = whole + F.call_function("div", value, divisor) * scale
    return whole + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of the pairs of one cell. Rows without a term name its groups."""
    groups = rows[rows["term"].isna()]
    sources, sides, zero = (groups[c].to_numpy() for c in ("source", "block", "zero"))
    place = {s: i for i, s in enumerate(sources)}
    slices = rows[rows["term"].notna()]
    column, terms = pd.factorize(slices["term"])
    row = slices["source"].map(place).to_numpy(dtype=np.int64)
    first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
    shares = np.repeat(zero.astype(np.int64)[:, None], len(terms), axis=1)
    shares[row, column] = slices["p"].to_numpy(dtype=np.int64)
    out = []
    for i in np.flatnonzero(sides == first).tolist():
        others = [j for j in np.flatnonzero(sides == second).tolist()
                  if first != second or sources[i] < sources[j]]
        gap = shares[others] - shares[i]
        value = (gap * gap // (shares[others] + shares[i])).sum(axis=1)
        out += [(*sorted((sources[i], sources[j])), v, len(terms))
                for j, v in zip(others, value.tolist())]
    found = pd.DataFrame(out, columns=["source", "item", "value", "terms"])
    found.insert(0, "lang", rows["lang"].iloc[0])
    return found


def _pairs(slices: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every ordered pair of groups of a language."""
    blocks = F.expr(f"cast(ceil(groups / {GROUP_BLOCK}) as int)")
    size = groups.groupBy("lang").agg(F.count("*").alias("groups")).select(
        "lang", blocks.alias("blocks"))
    places = settle(groups.join(size, "lang").select(
        "lang", "source", "n_terms", "zero", "blocks",
        F.pmod(F.xxhash64(F.lit("group"), "source"), "blocks").cast("int").alias("block"),
        F.expr(f"cast(ceil(n_terms / {TERM_BLOCK}) as int)").alias("term_blocks")), "places")
    cell = [F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")]
    spread = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sent = slices.join(places, ["lang", "source"]).select("*", spread).select(
        "lang", "source", "term", "p", "block", "zero", *cell,
        F.pmod(F.xxhash64(F.lit("term"), "term"), "term_blocks").cast("int").alias("term_block"))
    named = places.where("term_blocks > 0").select("*", spread).select(
        "lang", "source", F.lit(None).cast("string").alias("term"), long(0).alias("p"), "block",
        "zero", *cell, F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("term_block"))
    partial = sent.unionByName(named).groupBy("lang", "first", "second", "term_block").applyInPandas(
        _cell, "lang string, source string, item string, value long, terms long")
    summed = partial.groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    left = places.select("lang", "source", "n_terms", F.col("zero").alias("p"))
    right = places.select("lang", F.col("source").alias("item"), F.col("zero").alias("q"))
    rest = (F.col("n_terms") - F.coalesce("terms", long(0))) * apart(F.col("p"), F.col("q"))
    once = left.join(right, "lang").where("source < item").join(
        summed, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.when(F.col("n_terms") == 0, long(0)).otherwise(
            F.coalesce("value", long(0)) + rest).alias("value"))
    return once.unionByName(once.select("lang", F.col("item").alias("source"),
                                        F.col("source").alias("item"), "value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """How each (lang, source) differs: lang, source, part, item, value, rank.

    Part "pair" lists every other source of the language with the divergence of
    the two; part "term" the ``top`` kept terms that the source has more of than
    its language, by their share of the divergence from it. Ranks count from 1 by
    value descending, then item.

    Null lang, source and text are empty text. Groups without terms take part: all
    their counts are 0. A language that keeps no term has pairs of value 0. Equal
    values rank by item; repeated rows count as often as they stand; an empty table
    gives no row; other columns are ignored; texts are split in portions.
    """
    counted = settle(counts(docs), "counts")
    kept = settle(counted.where(F.col("term").isNotNull()).groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs),
        "kept")
    used = settle(counted.where(F.col("term").isNotNull()).select("lang", "source", "term", "n").join(
        kept.select("lang", "term", "lang_n"), ["lang", "term"]), "used")
    langs = kept.groupBy("lang").agg(
        F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_sum"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    named = counted.where(F.col("term").isNull()).select("lang", "source")
    n_terms = F.coalesce("n_terms", long(0))
    groups = settle(named.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", n_terms.alias("n_terms"),
        (F.coalesce("n", long(0)) + 2 * n_terms).alias("divisor"),
        (F.coalesce("lang_sum", long(0)) + 2 * n_terms).alias("lang_divisor")).withColumn(
        "zero", F.when(F.col("n_terms") > 0, share(long(0), F.col("divisor"))).otherwise(long(0))),
        "groups")
    slices = settle(used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("divisor")).alias("p"),
        share(F.col("lang_n"), F.col("lang_divisor")).alias("q")), "slices")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = _pairs(slices.drop("q"), groups).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    terms = slices.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        apart(F.col("p"), F.col("q")).alias("value")).select("*", rank).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
