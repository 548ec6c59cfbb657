"""Personal data: patterns, then information-theoretic sanitisation. Native columns.

The patterns find emails, addresses, card and phone numbers. Protected entities are each
distinct value and what it belongs to: the domain of a mail, the block of an
address, the exchange of a phone number, the issuer of a card. Terms in the texts that
hold an entity may give it away, so the corpus decides: with counts over all rows,

    disclosure(e, t) = log(p * N / n_e) / log(N / n_e),  p = (n_et + k n_e / N) / (n_t + k)

where n_et counts rows that hold both, t outside all spans, n_e those with e, n_t those
with t anywhere and N all. p estimates how surely t tells e, as if ``k`` further rows
with t were like the corpus: so two rows say less than twenty. Disclosure is pointwise mutual
information over the information content of e: near 1 for a term that
occurs with e alone, 0 for one that says nothing. From ``remove`` on a term
goes. From ``generalise`` on it is replaced by a class: by its first letters, if these
as a class of terms disclose less than ``generalise``, else by a mere label. All its
occurrences in rows with e count. A pair needs ``support`` rows: in one row every
word is as telling as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import empty_as, text_key
from tripline.sources.session import settle

SUPPORT, GENERALISE, REMOVE = 2, 0.85, 0.95
#: Rows like the corpus that are added to those with a term.
PRIOR_ROWS = 0.5
#: Letters a term needs at least, and those that name its class.
TERM_LETTERS = CLASS_LETTERS = 3

KINDS = ("email", "ip", "card", "phone")
LABELS = {kind: f"[{kind.upper()}]" for kind in KINDS} | {"term": "[TERM]", "removed": ""}
#: A term that is replaced by its first letters and this sign.
PREFIX, CUT = "prefix", "*"

# Possessive loops keep long runs off the stack. The look-behind starts a match
# at the head of a run only (or where the last match ended), which is where the
# leftmost match of the plain pattern starts.
_EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TERM = r"[\p{L}\p{M}]++"

#: Matches or spans of a portion, at least.
PORTION = 64

_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
_KEYS = ["doc_id", "text_hash"]


def _digits(match: Column) -> Column:
    return F.translate(match, " ().+-", "")


def _ip_valid(match: Column) -> Column:
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) < 3) | (
        (F.length(part(p)) == 3) & (part(p) <= "255")))


def _card_valid(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(16, 19), F.call_function("luhn_check", digits)).otherwise(False)


def _phone_valid(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, though named several times."""
    return F.transform(F.array(value), use)[0]


def _portions(items: Column) -> Column:
    """A list cut into about as many pieces as a piece is long, at least one."""
    size = F.greatest(F.lit(PORTION), F.ceil(F.sqrt(F.size(items))).cast("int"))
    last = F.greatest(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * size + 1, size))


def matches(text: Column, pattern: str, kind: str, valid=None, value=None) -> Column:
    """Spans of ``pattern`` in ``text``, in order; positions in code points, end exclusive.

    The text between matches gives the positions: the lengths add up, within
    portions of the matches and over these, so that no long list is built by
    appending. A match that fails ``valid`` is passed over.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    empty = F.array().cast(_SPAN)
    length = lambda pair: F.length(pair["gap"]) + F.coalesce(F.length(pair["match"]), F.lit(0))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                        (value or (lambda m: m))(pair["match"]).alias("value"))
        good = pair["match"].isNotNull()
        if valid is not None:
            good = good & valid(pair["match"])
        return F.struct(end.alias("at"), F.when(
            good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def spans_from(portion: Column, at: Column) -> Column:
        return F.aggregate(portion, F.struct(at.alias("at"), empty.alias("out")), step,
                           lambda acc: acc["out"])

    def starts(portions: Column) -> Column:
        lengths = F.transform(portions, lambda part: F.aggregate(part, F.lit(0), lambda n, p: n + length(p)))
        return F.aggregate(
            lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"),
                                    F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    return _bound(_bound(pairs, _portions), lambda portions: F.flatten(
        F.zip_with(portions, starts(portions), spans_from)))


def base_spans(text: Column) -> Column:
    """Spans of the four patterns, by kind as listed, then by start.

    A cheap test keeps texts without the pattern's signs off the matcher.
    """
    found = {
        "email": (F.contains(text, F.lit("@")),
                  matches(text, _EMAIL, "email", value=F.lower)),
        "ip": (F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
               matches(text, _IP, "ip", _ip_valid)),
        "card": (F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")),
                 matches(text, _CARD, "card", _card_valid, _digits)),
        "phone": (F.contains(text, F.lit("+")),
                  matches(text, _PHONE, "phone", _phone_valid, _digits)),
    }
    none = F.array().cast(_SPAN)
    return F.concat(*(F.when(found[kind][0], found[kind][1]).otherwise(none) for kind in KINDS))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and base spans of every row; null counts as empty."""
    return docs.select("doc_id", text_key("text").alias("text_hash"),
                       empty_as(F.col("text")).alias("text")).withColumn(
        "spans", base_spans(F.col("text")))


def entities(spans: Column) -> Column:
    """The distinct values among ``spans`` and what they belong to."""
    wider = {"email": ("domain", lambda v: F.substring_index(v, "@", -1)),
             "ip": ("block", lambda v: F.substring_index(v, ".", 3)),
             "card": ("issuer", lambda v: F.substring(v, 1, 6)),
             "phone": ("exchange", lambda v: F.substring(v, 1, 7))}

    def of(span: Column) -> Column:
        named = None
        for kind, (name, cut) in wider.items():
            value = F.concat(F.lit(f"{name}:"), cut(span["value"]))
            named = F.when(span["kind"] == kind, value) if named is None else named.when(
                span["kind"] == kind, value)
        return F.array(F.concat(span["kind"], F.lit(":"), span["value"]), named)

    return F.array_distinct(F.flatten(F.transform(spans, of)))


def term_class(term: Column) -> Column:
    return F.concat(F.substring(term, 1, CLASS_LETTERS), F.lit(CUT))


def words_outside(text: Column, spans: Column) -> Column:
    """Spans of the words of ``text`` that touch none of ``spans``, the word in lower case as value."""
    word = matches(text, _TERM, "term", value=F.lower,
                   valid=lambda m: F.length(m) >= TERM_LETTERS)
    return F.filter(word, lambda w: ~F.exists(
        spans, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))


def _disclosure(n_et: Column, n_t: Column, n_e: Column, total: int) -> Column:
    """Null for an entity that all rows hold: nothing can tell it."""
    p = (n_et + n_e * (PRIOR_ROWS / total)) / (n_t + PRIOR_ROWS)
    return F.log(p * total / n_e) / F.nullif(F.log(F.lit(total) / n_e), F.lit(0.0))


def _told(names: DataFrame, holders: DataFrame, telling: DataFrame) -> DataFrame:
    """rid, name and the highest disclosure by any entity of the row."""
    near = names.join(telling.select("name").distinct(), "name", "left_semi")
    return near.select("rid", "name").join(holders.select("rid", "entity"), "rid").join(
        telling, ["entity", "name"]).groupBy("rid", "name").agg(F.max("disclosure").alias("disclosure"))


def disclosing(found: DataFrame, corpus: DataFrame, support: int = SUPPORT,
               generalise: float = GENERALISE) -> DataFrame:
    """Words that give an entity away: rid, start, end, disclosure and that of their class.

    ``found`` has rid (one a row), text and spans; ``corpus`` all texts. Counts are
    of rows. An entity in fewer rows than ``support`` has no pair, so words are
    taken only of rows that hold another, and of words only those that as many of
    these rows hold. A term is in no fewer rows than these with it, and meets an entity
    in no more than all rows of that, which bounds what it can disclose: pairs that
    fall short even so never meet, and n_t is counted over the corpus for
    the terms of the others, and for their classes, after an equality join.
    """
    spark = found.sparkSession
    total = max(1, found.count())
    c = F.col
    mentions = found.where(F.size("spans") > 0).select("rid", F.explode(entities(c("spans"))).alias("entity"))
    known = settle(mentions.groupBy("entity").agg(F.count("*").alias("n_e")).where(c("n_e") >= support),
                   "entities")
    holders = settle(mentions.join(known, "entity").select("rid", "entity", "n_e"), "holders")
    most = holders.groupBy("rid").agg(F.max("n_e").alias("most"))
    # by an explicit number: few bytes here are many words, which no task should have alone
    rows = settle(found.join(most, "rid").select("rid", "most", "text", "spans").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "rid").select(
        "rid", "most", words_outside(c("text"), c("spans")).alias("words")), "words")
    terms = F.array_distinct(F.transform("words", lambda w: w["value"]))
    names = rows.select("rid", "most", F.explode(terms).alias("name"))
    beside = names.groupBy("name").agg(F.count("*").alias("n_beside")).where(c("n_beside") >= support)

    def can_tell(n_e: str) -> Column:
        return F.coalesce(_disclosure(c(n_e), c("n_beside"), c(n_e), total), F.lit(1.0)) >= generalise

    shared = settle(names.join(beside, "name").where(can_tell("most")).select("rid", "name", "n_beside"),
                    "names")
    pairs = settle(shared.join(holders, "rid").where(can_tell("n_e")).groupBy("entity", "name").agg(
        F.count("*").alias("n_et"), F.max("n_beside").alias("n_beside"), F.max("n_e").alias("n_e"))
        .where((c("n_et") >= support) & (_disclosure(
            c("n_et"), c("n_beside"), c("n_e"), total) >= generalise)), "pairs")
    wanted = settle(pairs.select(F.explode(F.array("name", term_class(c("name")))).alias("name")).distinct(),
                    "wanted")
    whole = F.filter(F.split(F.lower(empty_as(c("text"))), r"[^\p{L}\p{M}]+"),
                     lambda t: F.length(t) >= TERM_LETTERS)
    # counted within tasks first: the wanted names may be too many to broadcast, and
    # all words of the corpus must not be shuffled to meet them
    counted = settle(corpus.select(F.explode(F.array_distinct(F.concat(
        whole, F.transform(whole, term_class)))).alias("name")).groupBy("name").agg(
        F.count("*").alias("n_t")).join(wanted, "name"), "counted")

    def telling(of: DataFrame) -> DataFrame:
        return of.join(counted, "name").select("entity", "name", _disclosure(
            c("n_et"), c("n_t"), c("n_e"), total).alias("disclosure")).where(c("disclosure") >= generalise)

    told = settle(_told(shared, holders, settle(telling(pairs), "telling")), "told")
    classes = told.select(term_class(c("name")).alias("name")).distinct()
    in_class = settle(rows.select("rid", F.explode(F.array_distinct(F.transform(
        "words", lambda w: term_class(w["value"])))).alias("name")).join(classes, "name", "left_semi"),
        "classes")
    class_pairs = in_class.join(holders, "rid").groupBy("entity", "name").agg(
        F.count("*").alias("n_et"), F.max("n_e").alias("n_e")).where(c("n_et") >= support)
    class_told = _told(in_class, holders, settle(telling(class_pairs), "class-telling")).select(
        "rid", c("name").alias("class"), c("disclosure").alias("class_disclosure"))
    spots = rows.join(told.select("rid").distinct(), "rid", "left_semi").select(
        "rid", F.explode("words").alias("w")).select("rid", "w.start", "w.end", c("w.value").alias("name"))
    return spots.join(told, ["rid", "name"]).withColumn("class", term_class(c("name"))).join(
        class_told, ["rid", "class"], "left").select(
        "rid", "start", "end", "disclosure", "class_disclosure")


def added_spans(docs: DataFrame, support: int, generalise: float, remove: float) -> tuple[DataFrame, DataFrame]:
    """Base spans of every row (rid, doc_id, text_hash, spans), and of rows with a
    telling term its spans (rid, added); both written."""
    found = settle(find(docs).select(*_KEYS, "spans", F.when(
        F.size("spans") > 0, F.col("text")).alias("text"),
        F.monotonically_increasing_id().alias("rid")), "spans")
    kind = F.when(F.col("disclosure") >= remove, "removed").when(
        F.col("class_disclosure").isNull(), PREFIX).otherwise("term")
    extra = settle(disclosing(found, docs, support, generalise).select("rid", F.struct(
        kind.alias("kind"), "start", "end", F.lit("").alias("value")).alias("span")).groupBy("rid").agg(
        F.array_sort(F.collect_list("span")).alias("added")), "added")
    return found.drop("text"), extra


def spans(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE,
          remove: float = REMOVE) -> DataFrame:
    """doc_id, text_hash and ``spans`` (base, then added) of every row.

    Added spans have kind "removed", or if generalised "prefix" (to the first
    letters) or "term" (to a label). A null text is empty, has no spans and counts
    among all rows; repeated rows count as often as they stand, get equal spans
    and, being several, may be told by their own words; other columns are ignored.
    An empty table gives an empty one; long texts cost in proportion to their words
    times their base spans.
    """
    found, extra = added_spans(docs, support, generalise, remove)
    return found.join(extra, "rid", "left").select(*_KEYS, F.concat(
        "spans", F.coalesce("added", F.array().cast(_SPAN))).alias("spans"))


def masked(text: Column, all_spans: Column) -> Column:
    """``text`` with each span replaced by its label; overlapping spans merge into the first.

    Each portion of the spans, by start, rewrites the text from its first span to
    that of the next portion, from behind all spans of the portions before.
    """
    ordered = F.array_sort(F.transform(all_spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    label = F.create_map(*(F.lit(x) for pair in LABELS.items() for x in pair))
    first = lambda p, i: F.when(i == 0, F.lit(0)).otherwise(p[0]["start"])
    furthest = lambda p: F.coalesce(F.array_max(F.transform(p, lambda s: s["end"])), F.lit(0))
    behind = lambda portions: F.aggregate(
        portions, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, p: F.struct(F.greatest(acc["at"], furthest(p)).alias("at"),
                                F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"])

    def rewritten(portion: Column, begin: Column, stop: Column, reached: Column, part: Column) -> Column:
        """``part`` is the text from ``begin`` on, a little further than ``stop``."""
        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(part, acc["at"] - begin + 1, s["start"] - acc["at"])
            letters = F.concat(F.substring(part, s["start"] - begin + 1, F.lit(CLASS_LETTERS)), F.lit(CUT))
            said = F.when(s["kind"] == PREFIX, letters).otherwise(F.try_element_at(label, s["kind"]))
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, said)).otherwise(
                    acc["out"]).alias("out"))

        return F.aggregate(
            portion, F.struct(F.greatest(begin, reached).alias("at"), F.lit("").alias("out")), step,
            lambda acc: F.concat(acc["out"], F.substring(
                part, acc["at"] - begin + 1, F.greatest(F.lit(0), stop - acc["at"]))))

    def whole(portions: Column, begins: Column, reached: Column) -> Column:
        def piece(portion: Column, i: Column) -> Column:
            begin, stop = begins[i], F.coalesce(F.get(begins, i + 1), F.length(text))
            part = F.substring(text, begin + 1, stop - begin + CLASS_LETTERS)
            return _bound(part, lambda part: rewritten(portion, begin, stop, reached[i], part))
        return F.array_join(F.transform(portions, piece), "")

    return _bound(_bound(ordered, _portions), lambda portions: _bound(
        F.transform(portions, first), lambda begins: _bound(
            behind(portions), lambda reached: whole(portions, begins, reached))))


def sanitise(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE,
             remove: float = REMOVE) -> DataFrame:
    """The documents with all spans masked; other columns stay, a null text stays null.

    Base spans are found again beside the text, so that only the few rows with
    telling terms come by a join, and texts stay where they are.
    """
    found, extra = added_spans(docs, support, generalise, remove)
    told = found.select("rid", *_KEYS).join(extra, "rid").dropDuplicates(_KEYS).select(
        F.col("doc_id").alias("extra_id"), F.col("text_hash").alias("extra_hash"), "added")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text",
                       text_key("text").alias("text_hash"),
                       base_spans(empty_as(F.col("text"))).alias("spans"))
    match = rows["doc_id"].eqNullSafe(told["extra_id"]) & (rows["text_hash"] == told["extra_hash"])
    whole = rows.join(told, match, "left").withColumn("spans", F.concat(
        "spans", F.coalesce("added", F.array().cast(_SPAN))))
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        masked(F.col("text"), F.col("spans")))
    return whole.withColumn("masked", text).select(*(
        F.col("masked").alias(c) if c == "text" else F.col("row")[c].alias(c)
        for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans and all spans as text."""
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                 s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, said), ",")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
