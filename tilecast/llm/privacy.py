"""Personal data: patterns, and terms that give protected entities away.

Patterns find e-mail and IP addresses, card and phone numbers. The values found are the protected
entities. A term near an entity tells something about it: with p(e) the share of documents that
name entity e, and p(e|t) the share of those with term t that do, knowing t leaves
``-log p(e|t)`` of the entity's information ``-log p(e)``. What t discloses is the rest,

    disclosure = PMI(t; e) / -log p(e) = 1 - log p(e|t) / log p(e),

1 for a term that only occurs where the entity does, 0 for an independent one. All counts are over
the corpus, a text counted once however often it was copied. Most entities are named in one text;
p(e|t) is therefore smoothed, by one more text with t that names e as often as any text does, and
no pair is left out for being rare. But rare words stand beside an entity by chance, too: a term
only counts if a lower confidence bound of p(e|t) shows that a fair share of its texts have it
there. Terms above one threshold are generalised, above a higher one removed: in every text that
holds personal data, or in every text.

Everything here is DataFrame functions. Regular expressions use possessive groups, which match
what the plain ones do but need no stack on very long texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.runtime import MAX_BROADCAST_ROWS, broadcast_if_small, materialize

KINDS = ("email", "ip", "card", "phone")

# Each matches the longest string of its kind from the leftmost place. A match can only start where
# a run of its first characters starts or where the last match ended (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Holds for every text with a match.
ANY = r"@|[0-9]\.[0-9]|[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]|\+[0-9]"
HINTS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
}

TERM = r"[\p{L}\p{N}]+"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 16 to 19 digits have a valid check digit."""
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def is_valid(kind: Column, match: Column) -> Column:
    """The checks that a match of a kind must pass."""
    digits = _digits(match)
    parts = F.split(match, r"\.")
    small = F.forall(parts, lambda p: p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.when(n.between(16, 19), _luhn(digits)).otherwise(F.lit(False)))
        .otherwise(n.between(8, 15))
    )


def _located(rows: DataFrame, key: str, pieces: str, matches: str, *more: str) -> DataFrame:
    """``key, more, start, end, match`` of arrays of matches and of the pieces between them.

    Positions are running sums of lengths, in code points, end exclusive.
    """
    each = rows.select(key, *more, F.posexplode(F.arrays_zip(F.col(matches).alias("m"), F.col(pieces).alias("p"))).alias("at", "z")).where(
        F.col("z.m").isNotNull()
    ).select(key, *more, "at", F.col("z.m").alias("match"), F.length("z.p").alias("gap"))
    upto = Window.partitionBy(key, *more).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("match") + F.col("gap")).over(upto)
    return each.withColumn("end", end.cast("bigint")).withColumn("start", F.col("end") - F.length("match")).drop("at", "gap")


def texts_with_hints(docs: DataFrame) -> DataFrame:
    """``digest, text``: distinct texts that could hold personal data, written once."""
    some = docs.where(F.col("text").rlike(ANY)).select(digest(F.col("text")).alias("digest"), "text")
    return materialize(some.groupBy("digest").agg(F.first("text").alias("text")), "pii-texts")


def digest(text: Column) -> Column:
    """Name of a text: 128 bits are enough for any corpus."""
    return F.unhex(F.md5(text.cast("binary")))


def base_spans(texts: DataFrame) -> DataFrame:
    """``digest, kind, start, end, match`` of valid matches."""
    found = []
    for kind in KINDS:
        hinted = texts.where(F.col("text").rlike(HINTS[kind]) if kind != "email" else F.col("text").contains("@"))
        arrays = hinted.select(
            "digest",
            F.lit(kind).alias("kind"),
            F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0)).alias("matches"),
            F.split("text", PATTERNS[kind], -1).alias("pieces"),
        )
        found.append(arrays)
    spans = _located(reduce(DataFrame.union, found), "digest", "pieces", "matches", "kind")
    return spans.where(is_valid(F.col("kind"), F.col("match")))


def contexts(texts: DataFrame, spans: DataFrame, words: int = 5) -> DataFrame:
    """``digest, entity, term``: distinct terms within ``words`` words of an entity, lower-cased.

    Terms that hold a digit or are part of another span are no terms.
    """
    reach = 40 * words
    entity = F.concat_ws(":", "kind", F.when(F.col("kind") == "email", F.lower("match")).when(F.col("kind") == "ip", F.col("match")).otherwise(_digits(F.col("match"))))
    placed = texts.join(spans.select("digest", "start", "end", entity.alias("entity")), "digest")

    def cut(start, n) -> Column:
        return F.regexp_extract_all(F.lower(F.substring("text", start.cast("int") + 1, n.cast("int"))), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    # A stretch beside the entity holds its nearest words whole if it holds one more, or ends with
    # the text. Where it does not, the whole side is read.
    start, behind = F.col("start"), F.length("text") - F.col("end")
    close = cut(F.greatest(start - reach, F.lit(0)), F.least(start, F.lit(reach)))
    close = F.when((start <= reach) | (F.size(close) > words), close).otherwise(cut(F.lit(0), start))
    before = F.slice(F.reverse(close), 1, words)
    close = cut(F.col("end"), F.lit(reach))
    close = F.when((behind <= reach) | (F.size(close) > words), close).otherwise(cut(F.col("end"), behind))
    after = F.slice(close, 1, words)
    near = F.filter(F.concat(before, after), lambda w: ~w.rlike("[0-9@]"))
    terms = F.flatten(F.transform(near, lambda w: F.regexp_extract_all(w, F.lit(TERM), F.lit(0))))
    return placed.select("digest", "entity", F.explode(F.array_distinct(terms)).alias("term")).where(F.length("term") >= 3).distinct()


def one_of_each(docs: DataFrame) -> tuple[DataFrame, int]:
    """A row of every distinct text (of copies the one with the smallest id), and how many there are."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("t"))
    counted = materialize(hashed.groupBy("t").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first")), "pii-copies")
    copied = broadcast_if_small(counted.where("rows > 1").select(F.col("t").alias("_t"), "first"))
    single = hashed.join(copied, F.col("t") == F.col("_t"), "left_anti")
    # Rows that repeat an id and its text are one text as well.
    least = hashed.join(copied, (F.col("t") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("first"))).dropDuplicates(["t"])
    return single.union(least.select(*hashed.columns)), counted.count()


def surely(part: Column, whole: Column, z: float = 1.0) -> Column:
    """Lower bound of a share of which ``part`` of ``whole`` were seen (Wilson's interval, ``z`` deviations)."""
    p, square = part / whole, z * z / whole
    return (p + square / 2 - z * F.sqrt(p * (1 - p) / whole + square / whole / 4)) / (1 + square)


def disclosing_terms(
    once: DataFrame, n: int, texts: DataFrame, spans: DataFrame, support: int = 1, generalise: float = 0.6,
    remove: float = 0.8, evidence: float = 0.2,
) -> DataFrame:
    """``term, disclosure, action``: terms that reveal an entity, by the most that they reveal.

    ``support`` is in how many distinct texts a term must stand near the entity, ``evidence`` what share
    of the term's texts must surely be such. At 0.2 a term found once counts, and one of two texts;
    one of three is taken for chance. p(t) is over the ``n`` distinct texts of the whole corpus, which
    ``once`` has.
    """
    near = materialize(contexts(texts, spans), "pii-contexts")
    pairs = near.groupBy("term", "entity").agg(F.count("*").alias("both")).where(F.col("both") >= support)
    pairs = materialize(pairs, "pii-pairs")
    entities = near.groupBy("entity").agg(F.countDistinct("digest").alias("n_entity"))
    wanted = materialize(pairs.select("term").distinct(), "pii-terms")
    words = once.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    # Summed up in tasks first; only then do the few wanted terms pick theirs.
    n_term = words.groupBy("term").agg(F.count("*").alias("n_term")).join(broadcast_if_small(wanted), "term")
    share = F.col("n_entity") / F.lit(max(n, 1))
    told = (F.col("both") + share) / (F.greatest("n_term", "both") + 1)
    value = 1 - F.log(told) / F.log(share)
    return (
        pairs.join(entities, "entity")
        .join(n_term, "term")
        .where((F.col("n_entity") < n) & (surely(F.col("both"), F.greatest("n_term", "both")) >= evidence))
        .groupBy("term")
        .agg(F.max(value).alias("disclosure"))
        .where(F.col("disclosure") >= generalise)
        .withColumn("action", F.when(F.col("disclosure") >= remove, "removed").otherwise("generalised"))
    )


def term_spans(texts: DataFrame, spans: DataFrame, terms: DataFrame) -> DataFrame:
    """``digest, kind, start, end, match`` of every occurrence of a term in ``texts``.

    The kind is what becomes of it: ``removed`` or ``generalised``. Occurrences inside another span
    are part of that span.
    """
    terms = materialize(terms, "pii-disclosing")
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term")
    if terms.count() <= MAX_BROADCAST_ROWS:  # texts stay where they are
        hit = texts.select("digest", "text", words).join(F.broadcast(terms), "term")
    else:
        hit = texts.join(texts.select("digest", words).join(terms, "term"), "digest")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])"), F.col("term"), F.lit(r"(?![\p{L}\p{N}])"))
    arrays = hit.select(
        "digest", "term", F.col("action").alias("kind"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("matches"), F.split("text", pattern, F.lit(-1)).alias("pieces"),
    )
    found = _located(arrays, "digest", "pieces", "matches", "kind", "term").drop("term")
    base = spans.select("digest", F.col("start").alias("s"), F.col("end").alias("e"))
    outside = found.join(
        base, (found.digest == base.digest) & (found.start < base.e) & (base.s < found.end), "left_anti"
    )
    # Rows without an id can bring a text twice.
    return outside.select("digest", "kind", "start", "end", "match").distinct()


def _order(kind: Column) -> Column:
    names = (*KINDS, "generalised", "removed")
    return F.array_position(F.array(*map(F.lit, names)), kind).cast("int")


def find(docs: DataFrame, everywhere: bool = False, **options) -> DataFrame:
    """All spans by text: ``digest, spans``, an array of order, start, end, kind.

    ``everywhere`` looks for disclosing terms in all texts, not only in those with personal data.
    """
    texts = texts_with_hints(docs)
    base = materialize(base_spans(texts), "pii-spans")
    once, n = one_of_each(docs)
    terms = disclosing_terms(once, n, texts, base, **options)
    if everywhere:
        searched = once.where(F.col("text").isNotNull()).select(digest(F.col("text")).alias("digest"), "text")
    else:
        searched = texts.join(base.select("digest").distinct(), "digest", "left_semi")
    every = base.unionByName(term_spans(searched, base, terms)).select(
        "digest", F.struct(_order(F.col("kind")).alias("order"), "start", "end", "kind").alias("span")
    )
    return materialize(every.groupBy("digest").agg(F.sort_array(F.collect_list("span")).alias("spans")), "pii-found")


def _may_have_spans(everywhere: bool) -> Column:
    text = F.col("text")
    return text.isNotNull() if everywhere else F.coalesce(text.rlike(ANY), F.lit(False))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, everywhere: bool = False, **options) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``, one row per document.

    A null or empty text has no spans: counts of 0, the digest of nothing, an empty list. Equal texts
    have equal spans; repeated rows stay. An empty table gives no rows.
    """
    found = find(docs, everywhere, **options)
    # Texts that cannot have spans: their keys, of half the length, match none and are
    # spread evenly.
    none = F.unhex(F.lpad(F.hex(F.xxhash64("doc_id")), 16, "0"))
    rows = docs.select("doc_id", F.when(_may_have_spans(everywhere), digest(F.col("text"))).otherwise(none).alias("digest"))
    joined = rows.join(found, "digest", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<order:int,start:bigint,end:bigint,kind:string>>"))
    base = F.filter(spans, lambda s: s["order"] <= len(KINDS))
    return joined.select(
        "doc_id",
        *[_count(spans, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


def sanitise(docs: DataFrame, everywhere: bool = False, **options) -> DataFrame:
    """``docs`` with spans replaced in ``text``, same columns and rows.

    A base span becomes its kind in brackets, a generalised term ``[TERM]``, a removed one nothing.
    Overlapping spans become one, named after the first. Null stays null.
    """
    found = find(docs, everywhere, **options)
    cut = found.select("digest", F.explode("spans").alias("s")).select("digest", "s.*")
    # Overlapping spans form one: a span starts a new one where none before reaches it.
    before = Window.partitionBy("digest").orderBy("start", "order", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("digest").orderBy("start", "order", "end").rowsBetween(Window.unboundedPreceding, 0)
    new = (F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(0))).cast("int")
    merged = (
        cut.withColumn("new", new)
        .withColumn("group", F.sum("new").over(upto))
        .groupBy("digest", "group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "order", "kind"))["kind"].alias("kind"))
    )
    mark = F.when(F.col("kind") == "removed", "").when(F.col("kind") == "generalised", "[TERM]").otherwise(
        F.concat(F.lit("["), F.upper("kind"), F.lit("]"))
    )
    previous = F.coalesce(F.lag("end").over(Window.partitionBy("digest").orderBy("start")), F.lit(0))
    part = F.struct(F.col("start"), previous.alias("from"), F.col("end").alias("to"), mark.alias("mark"))
    parts = merged.select("digest", part.alias("part")).groupBy("digest").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    body = F.array_join(
        F.transform("_parts", lambda p: F.concat(F.substring(F.col("text"), (p["from"] + 1).cast("int"), (p["start"] - p["from"]).cast("int")), p["mark"])), ""
    )
    tail = F.substring(F.col("text"), (F.element_at("_parts", -1)["to"] + 1).cast("int"), F.length("text"))
    cleaned = materialize(parts.withColumnsRenamed({"digest": "_digest", "parts": "_parts"}), "pii-parts")
    names = list(docs.columns)
    hinted = _may_have_spans(everywhere)
    # The row travels as one value, so that its columns may have any names.
    packed = docs.where(hinted).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text", digest(F.col("text")).alias("_own"))
    changed = packed.join(cleaned, F.col("_own") == F.col("_digest"), "left")
    text = F.when(F.col("_parts").isNotNull(), F.concat(body, tail)).otherwise(F.col("text")).alias("text")
    cells = [text if c == "text" else F.col("_row")[c].alias(c) for c in names]
    return changed.select(*cells).unionByName(docs.where(~hinted))
