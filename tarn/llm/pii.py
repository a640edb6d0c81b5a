"""Personal data: patterns, and the terms that give them away.

Built-in functions only. Pattern matches are marked in the text with two
control characters and cut apart there, which yields their offsets.

Beyond the patterns, a term can reveal a person whose data were removed. The
corpus tells which: a term that occurs near a protected value in different
texts, and in few documents without it, discloses that value. Its disclosure is
the pointwise mutual information of value and term, and the probability of the
value given the term, shrunk by how few texts show the two together: one text
alone is no evidence, and each further one leaves a quarter of the doubt. Terms
above the thresholds are removed, those a little below are generalised to a
broader term of the corpus, one that stands with nearly every occurrence of the
narrower one and with more besides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, filter_pages, flag_members, picked, stored
from tarn.llm.spans import SPANS_TYPE, no_spans

# Kinds in the order of ties. The first four are the base.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "term_removed", "term_generalised"]

# The base patterns. Possessive, because no shorter match of a
# part can be of use, and started only where a run starts, so that long runs
# are read once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)

OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"

# Terms are runs of letters, this long at least.
TERM = r"\p{L}{3,}+"
# Code points of a block of text that is reached at once.
BLOCK = 256
# Code points on either side of a value that count as its context.
CONTEXT = 60
# Share of the doubt that each text with both value and term leaves, from the
# second on.
DOUBT = 0.25
# Bits of information about the value, and its probability given the term.
LEAST_BITS = 3.0
REMOVE_FROM = 0.8
GENERALISE_FROM = 0.5
# Share of a term's contexts in which a broader term stands too.
BROADER_FROM = 0.8


def _clean() -> Column:
    """The text with the marking characters, if it has any, replaced one by one."""
    return F.translate("text", OPEN + CLOSE, OTHER + OTHER)


def _pieces(clean: Column, pattern: str) -> Column:
    """The text cut before every match, with the end of each match marked; null
    without matches. To be held in a column of its own before it is read."""
    marked = F.regexp_replace(clean, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}"))
    return F.when(clean.rlike(pattern), F.split(marked, OPEN, -1))


def _with(value: Column, read: Callable[[Column], Column]) -> Column:
    """``read`` of a value that is computed once, however often it is read."""
    return F.transform(F.array(value), read)[0]


def _running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What the numbers up to each one come to, from zero on.

    An array grows by copying, so the numbers are taken in about as many chunks
    as a chunk has numbers: n numbers cost some n ** 1.5 copies and not n ** 2.
    """
    kind = "array<bigint>"
    start = F.struct(F.lit(0).cast("bigint").alias("to"), F.array().cast(kind).alias("all"))

    def step(state: Column, number: Column) -> Column:
        now = combine(state["to"], number)
        return F.struct(now.alias("to"), F.concat(state["all"], F.array(now)).alias("all"))

    def before(state: Column, chunk: Column) -> Column:
        now = combine(state["to"], F.element_at(chunk, -1))
        kept = F.concat(state["all"], F.array(state["to"]))
        return F.struct(now.alias("to"), kept.alias("all"))

    def chunks(held: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(held))).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(held) - 1) / size).cast("int")),
            lambda n: F.aggregate(
                F.slice(held, n * size + 1, size), start, step, lambda state: state["all"]
            ),
        )

    def shifted(held: Column) -> Column:
        offsets = F.aggregate(held, start, before, lambda state: state["all"])
        return F.flatten(
            F.zip_with(
                held, offsets, lambda chunk, o: F.transform(chunk, lambda x: combine(o, x))
            )
        )

    def run(held: Column) -> Column:
        none = F.array().cast(kind)
        return F.when(F.size(held) > 0, _with(chunks(held), shifted)).otherwise(none)

    return _with(numbers, run)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _matches(pieces: Column) -> Column:
    """All matches in ``_pieces``: an array of (start, end, value), in code points."""

    def found(parts: Column) -> Column:
        rest, first = parts["rest"], parts["first"]
        reach = _running(
            F.transform(rest, lambda piece: (F.char_length(piece) - 1).cast("bigint")), _add
        )

        def match(piece: Column, to: Column) -> Column:
            start = first + to - F.char_length(piece) + 1
            size = F.instr(piece, CLOSE) - 1
            return F.struct(
                start.alias("start"),
                (start + size).alias("end"),
                F.substring(piece, F.lit(1), size).alias("value"),
            )

        return F.zip_with(rest, reach, match)

    kind = "array<struct<start:bigint,end:bigint,value:string>>"
    parts = F.struct(
        F.slice(pieces, F.lit(2), F.size(pieces)).alias("rest"),
        F.char_length(pieces[0]).cast("bigint").alias("first"),
    )
    none = F.array().cast(kind)
    return F.when(pieces.isNotNull(), _with(parts, found).cast(kind)).otherwise(none)


def _blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, so that a place far into it
    is reached at once. To be held in a column of its own before it is read."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _part(blocks: Column, at: Column, size: Column) -> Column:
    """``size`` code points, ``BLOCK`` at most, from ``at`` on."""
    number = F.floor(at / BLOCK).cast("int")
    held = F.concat_ws("", F.get(blocks, number), F.get(blocks, number + 1))
    return F.substring(held, (at % BLOCK + 1).cast("int"), size.cast("int"))


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def worth(place: Column) -> Column:
        digit = F.substring(backwards, place, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(
            place % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)
        ).otherwise(digit)

    places = F.sequence(F.lit(1), F.char_length(digits))
    total = F.aggregate(places, F.lit(0), lambda total, place: total + worth(place))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = lambda part: F.coalesce(part.try_cast("bigint") <= 255, F.lit(False))
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.when(F.char_length(digits).between(*CARD_DIGITS), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(F.regexp_replace(value, "[^0-9]", "")).between(*PHONE_DIGITS)
    return F.lit(True)


def _is_valid(kind: str) -> Callable[[Column], Column]:
    return lambda match: _valid(kind, match["value"])


def _base(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, base, contexts`` for every row.

    ``contexts`` holds a (value, term) for every term in the context of a match.
    """
    cleaned = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), _clean().alias("clean")
    )
    hint = {"email": F.col("clean").contains("@"), "phone": F.col("clean").contains("+")}
    cut = cleaned.select(
        "*",
        *[
            F.when(hint.get(kind, F.lit(True)), _pieces(F.col("clean"), pattern)).alias(f"p_{kind}")
            for kind, pattern in PATTERNS.items()
        ],
    )
    matched = cut.select(
        "doc_id",
        "text_hash",
        "clean",
        *[_matches(F.col(f"p_{kind}")).alias(f"m_{kind}") for kind in PATTERNS],
    )
    valid = matched.select(
        "doc_id",
        "text_hash",
        "clean",
        *[
            F.filter(f"m_{kind}", _is_valid(kind)).alias(kind)
            for kind in BASE_KINDS
        ],
    )

    def spans(kind: str) -> Column:
        return F.transform(
            kind,
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(BASE_KINDS.index(kind)).alias("rank"),
                F.lit(kind).alias("kind"),
                m["end"].alias("end"),
            ),
        ).cast(SPANS_TYPE)

    def around(match: Column) -> Column:
        # Words cut by the context's outer edges are not terms of it.
        left_at = F.greatest(match["start"] - CONTEXT, F.lit(0))
        left = _part(F.col("blocks"), left_at, match["start"] - left_at)
        left = F.when(left_at > 0, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
        right = _part(F.col("blocks"), match["end"], F.lit(CONTEXT))
        right = F.when(
            F.char_length(right) == CONTEXT, F.regexp_replace(right, r"\p{L}+$", "")
        ).otherwise(right)
        words = F.regexp_extract_all(F.lower(F.concat_ws(" ", left, right)), F.lit(TERM), F.lit(0))
        value = F.xxhash64(F.lower(match["value"])).cast("string")
        return F.transform(F.array_distinct(words), lambda word: F.concat(value, F.lit(":"), word))

    # Spark tells strings apart by hashes, and structs one by one.
    pairs = F.array_distinct(F.flatten(F.transform("matches", around)))
    held = valid.select(
        "doc_id",
        "text_hash",
        F.array_sort(F.concat(*[spans(kind) for kind in BASE_KINDS])).alias("base"),
        F.concat(*[F.col(kind) for kind in BASE_KINDS]).alias("matches"),
        "clean",
    ).select("*", F.when(F.size("matches") > 0, _blocks(F.col("clean"))).alias("blocks"))
    contexts = F.transform(
        pairs,
        lambda pair: F.struct(
            F.substring_index(pair, ":", 1).cast("bigint").alias("value"),
            F.substring_index(pair, ":", -1).alias("term"),
        ),
    )
    return held.select("doc_id", "text_hash", "base", contexts.alias("contexts"))


def _candidates(found: DataFrame) -> DataFrame:
    """``(value, term, together)``: terms that may disclose a value.

    ``together`` counts documents, less the share that stays in doubt. A term is left out if, among contexts alone, it already
    accompanies other values too often to disclose this one.
    """
    sure = 1 - F.pow(F.lit(DOUBT), F.col("texts") - 1)
    pairs = found.select("doc_id", "text_hash", F.inline("contexts"))
    together = (
        pairs.groupBy("value", "term")
        .agg(F.count("*").alias("documents"), F.countDistinct("text_hash").alias("texts"))
        .select("value", "term", (F.col("documents") * sure).alias("together"))
    )
    near_any = (
        found.where(F.size("contexts") > 0)
        .select(F.explode(F.array_distinct("contexts.term")).alias("near_term"))
        .groupBy("near_term")
        .agg(F.count("*").alias("near"))
    )
    return (
        together.join(near_any, F.col("term") == F.col("near_term"))
        .where(F.col("together") >= GENERALISE_FROM * F.col("near"))
        .select("value", "term", "together")
    )


def _carriers(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, term)`` for every document that holds one of ``terms``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(_clean()), F.lit(TERM), F.lit(0)))
    exploded = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.explode(words).alias("term"),
    )
    known = flag_members(exploded, [F.col("term")], filter_pages(terms), "maybe").where("maybe")
    return known.join(terms, "term", "left_semi").select("doc_id", "text_hash", "term")


def disclosing_terms(
    candidates: DataFrame, carriers: DataFrame, values: DataFrame, total: int
) -> DataFrame:
    """``(term, kind)`` for every candidate above the thresholds.

    A term that discloses several values counts by the one it discloses most.
    """
    held = carriers.groupBy("term").agg(F.count("*").alias("held"))
    given = F.col("together") / F.col("held")
    bits = F.log2(given / (F.col("documents") / F.lit(float(total))))
    return (
        candidates.join(held, "term")
        .join(values, "value")
        .where((given >= GENERALISE_FROM) & (bits >= LEAST_BITS))
        .groupBy("term")
        .agg(F.max(given).alias("given"))
        .select(
            "term",
            F.when(F.col("given") >= REMOVE_FROM, F.lit("term_removed"))
            .otherwise(F.lit("term_generalised"))
            .alias("kind"),
        )
    )


def broader_terms(found: DataFrame, disclosing: DataFrame) -> DataFrame:
    """``(term, broader)`` for generalised terms that a broader one stands in for.

    A term is broader than another if it stands in ``BROADER_FROM`` or more of
    the other's contexts, stands near values in more texts, and discloses
    nothing itself. The rarest such term says the most, and is taken. Copies of
    a text count once.
    """
    narrow = disclosing.where("kind = 'term_generalised'").select(F.col("term").alias("narrow"))
    pairs = found.select("text_hash", F.inline("contexts")).distinct()
    near = pairs.groupBy("term").agg(F.countDistinct("text_hash").alias("near"))
    seen = pairs.join(narrow, F.col("term") == F.col("narrow")).drop("term")
    shared = (
        seen.join(pairs, ["text_hash", "value"])
        .where("term <> narrow")
        .select("narrow", "term", "text_hash")
        .distinct()
        .groupBy("narrow", "term")
        .agg(F.count("*").alias("shared"))
        .join(disclosing.select("term"), "term", "left_anti")
    )
    own = near.select(F.col("term").alias("narrow"), F.col("near").alias("narrow_near"))
    return (
        shared.join(near, "term")
        .join(own, "narrow")
        .where(F.col("shared") >= BROADER_FROM * F.col("narrow_near"))
        .where("near > narrow_near")
        .groupBy(F.col("narrow").alias("term"))
        .agg(F.min(F.struct("near", "term"))["term"].alias("broader"))
    )


def _no_broader() -> Column:
    return F.create_map().cast("map<string,string>")


def _term_spans(docs: DataFrame, owned: DataFrame) -> DataFrame:
    """``(t_doc_id, t_hash, term_spans, broader)``: the documents' disclosing terms.

    ``owned`` has the terms per document. Only documents that the membership
    filter lets through are shuffled.
    """
    keyed = docs.select(
        F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), _clean().alias("clean")
    ).select("d", "h", _pieces(F.col("clean"), TERM).alias("pieces"))
    pages = filter_pages(owned.select("t_doc_id", "t_hash"))
    flagged = flag_members(keyed, [F.col("d"), F.col("h")], pages, "maybe").where("maybe")
    held = flagged.join(
        owned, F.col("d").eqNullSafe(F.col("t_doc_id")) & (F.col("h") == F.col("t_hash"))
    )

    def span(match: Column) -> Column:
        kind = F.element_at(F.col("terms"), F.lower(match["value"]))
        return F.struct(
            match["start"].alias("start"),
            F.when(kind == "term_removed", F.lit(4)).otherwise(F.lit(5)).alias("rank"),
            kind.alias("kind"),
            match["end"].alias("end"),
        )

    matches = F.filter(
        _matches(F.col("pieces")),
        lambda m: F.map_contains_key(F.col("terms"), F.lower(m["value"])),
    )
    return held.select(
        "t_doc_id",
        "t_hash",
        F.transform(matches, span).cast(SPANS_TYPE).alias("term_spans"),
        "broader",
    ).dropDuplicates(["t_doc_id", "t_hash"])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``found``, the spans by start, and
    ``broader``, a map from the text's generalised terms to broader ones, which
    lacks terms that have none.

    A span has ``start``, ``rank``, ``kind`` and ``end``, in code points, end
    exclusive; those of terms don't overlap those of patterns. Null texts are
    empty and have no spans. Rows with null ids, and rows that repeat an id,
    are rows of their own; equal texts under one id get equal spans. An empty
    table gives no rows; further columns do not matter.
    """
    docs = picked(docs, d=doc_id, t=text).select(
        F.col("d").cast("bigint").alias("doc_id"), body("t").alias("text")
    )
    found = stored(_base(docs))
    candidates = stored(_candidates(found))
    if candidates.isEmpty():
        return found.select(
            F.col("doc_id").alias(doc_id),
            F.col("base").alias("found"),
            _no_broader().alias("broader"),
        )
    terms = candidates.select("term").distinct()
    carriers = stored(_carriers(docs, terms))
    values = (
        found.select(F.explode(F.array_distinct("contexts.value")).alias("value"))
        .groupBy("value")
        .agg(F.count("*").alias("documents"))
    )
    # Written tables, so that a term of many documents can be split or broadcast.
    disclosing = stored(disclosing_terms(candidates, carriers, values, found.count()))
    named = stored(disclosing.join(broader_terms(found, disclosing), "term", "left"))
    in_place = F.when(F.col("broader").isNotNull(), F.struct("term", "broader"))
    owned = stored(
        carriers.join(named, "term")
        .distinct()
        .groupBy(F.col("doc_id").alias("t_doc_id"), F.col("text_hash").alias("t_hash"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("terms"),
            F.map_from_entries(F.collect_list(in_place)).alias("broader"),
        )
    )
    spans = _term_spans(docs, owned)
    joined = found.join(
        spans,
        F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("text_hash") == F.col("t_hash")),
        "left",
    )
    free = F.filter(
        F.coalesce("term_spans", no_spans()),
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return joined.select(
        F.col("doc_id").alias(doc_id),
        F.array_sort(F.concat("base", free)).alias("found"),
        F.coalesce("broader", _no_broader()).alias("broader"),
    )


def apply_spans(text: Column, spans: Column, broader: Column | None = None) -> Column:
    """The text without its spans: patterns leave their kind in brackets,
    generalised terms their broader term, or ``TERM`` if ``broader`` has none,
    and removed terms nothing. A span that begins inside an earlier one is taken
    out with it and leaves no label.

    ``spans`` come by start. Text between spans is read from blocks, so a text
    with many spans is not read from its beginning for each.
    """
    terms = _no_broader() if broader is None else broader
    held = F.struct(
        _blocks(text).alias("blocks"),
        _running(F.transform(spans, lambda span: span["end"]), F.greatest).alias("reach"),
    )

    def between(blocks: Column, at: Column, size: Column) -> Column:
        far = F.substring(text, (at + 1).cast("int"), size.cast("int"))
        return F.when(size <= BLOCK, _part(blocks, at, size)).otherwise(far)

    def label(blocks: Column, span: Column) -> Column:
        term = F.lower(between(blocks, span["start"], span["end"] - span["start"]))
        wide = F.coalesce(F.element_at(terms, term), F.lit("TERM"))
        name = F.when(span["kind"] == "term_generalised", wide).otherwise(F.upper(span["kind"]))
        bracketed = F.concat(F.lit("["), name, F.lit("]"))
        return F.when(span["kind"] == "term_removed", F.lit("")).otherwise(bracketed)

    def written(parts: Column) -> Column:
        blocks, reach = parts["blocks"], parts["reach"]

        def piece(span: Column, number: Column) -> Column:
            at = F.when(number == 0, F.lit(0).cast("bigint")).otherwise(F.get(reach, number - 1))
            size = F.greatest(span["start"] - at, F.lit(0))
            new = span["start"] >= at
            return F.when(new, F.concat(between(blocks, at, size), label(blocks, span))).otherwise("")

        last = F.coalesce(F.element_at(F.concat(F.array(F.lit(0).cast("bigint")), reach), -1))
        rest = F.substring(text, (last + 1).cast("int"), F.char_length(text))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    return _with(held, written)
