"""Personal data by pattern, and terms that give it away, in Spark functions alone.

Base spans are e-mail and IP addresses, card and phone numbers. On top of them an information
theoretic step looks at terms beside such entities: from counts over the whole corpus it estimates
how much of an entity's information a term carries,

    disclosure(term; entity) = PMI(term, entity) / -log p(entity),

which is 1 for a term that occurs nowhere but with the entity. Terms above one threshold are
removed, those above a lower one are generalised to a placeholder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import row_key, stage

# The kinds in their order. Possessive repeats and look-behinds keep the matches of the
# plain patterns but never try a start twice within one run of characters:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = "term"
_WORD = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class DisclosureRules:
    """window: words looked at on either side of an entity. support: distinct surroundings needed."""

    window: int = 5
    support: int = 3
    generalise: float = 0.7
    remove: float = 0.9
    least_letters: int = 3


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        def small(part: Column) -> Column:
            value = F.ltrim(part, F.lit("0"))
            return (F.length(value) <= 3) & (F.coalesce(value.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.length(_digits(match)).between(13, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap condition every text with a match meets."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9][.][0-9]" if kind == "ip" else r"(?:[0-9][\x20-]?){13}")


_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _matches(kind: str, text: Column) -> Column:
    """Array of spans: the matches that hold.

    Both split and extract find the matches from left to right without overlap, so their results
    interleave and running lengths are positions, in characters as Spark counts them: code points.
    """
    pattern = KINDS[kind]
    rests = F.split(text, pattern, -1)
    # The part after the last match has none of its own.
    found = F.concat(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array(F.lit("")))
    zipped = F.arrays_zip(rests.alias("rest"), found.alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["rest"])
        end = begin + F.length(x["match"])
        span = F.struct(
            F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["match"].alias("value"),
        )
        keep = (F.length(x["match"]) > 0) & _valid(kind, x["match"])
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(zipped, start, step, lambda s: s["spans"])
    return F.when(_may_hold(kind, text), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key, text, and one array of spans per kind, in order of start. A null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return keyed.select("doc_id", row_key("doc_id", "text").alias("key"), "text", *[_matches(k, F.col("text")).alias(k) for k in KINDS])


def _surroundings(spans: DataFrame, rules: DisclosureRules) -> DataFrame:
    """One row per term beside a base span: key, entity, term, start, end, place (hash of the surroundings)."""
    every = F.concat(*[F.col(k) for k in KINDS])
    reach = 40 * rules.window  # characters that hold the window's words, unless they are longer

    def around(s: Column) -> Column:
        left = F.greatest(F.lit(0), s["start"] - reach)
        return F.struct(
            s["value"].alias("entity"), (left > 0).alias("cut"),
            F.struct(left.alias("at"), F.substring(F.col("text"), left + 1, s["start"] - left).alias("part")).alias("before"),
            F.struct(s["end"].alias("at"), F.substring(F.col("text"), s["end"] + 1, F.lit(reach)).alias("part")).alias("after"),
        )

    # Cut out before the rows multiply, so that no row carries the whole text.
    sides = spans.select("key", F.explode(F.transform(every, around)).alias("s")).select("key", "s.*")

    def words(side: Column, last: bool) -> Column:
        """Structs of word and start, the window's words nearest to the entity."""
        gaps = F.split(side["part"], r"[\p{L}\p{N}]+", -1)
        own = F.concat(F.regexp_extract_all(side["part"], F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array(F.lit("")))
        start = F.struct(side["at"].alias("at"), F.array().cast("array<struct<word:string,start:int>>").alias("w"))

        def step(state: Column, x: Column) -> Column:
            begin = state["at"] + F.length(x["gap"])
            item = F.array(F.struct(x["own"].alias("word"), begin.alias("start")))
            return F.struct(
                (begin + F.length(x["own"])).alias("at"),
                F.when(F.length(x["own"]) > 0, F.concat(state["w"], item)).otherwise(state["w"]).alias("w"),
            )

        listed = F.aggregate(F.arrays_zip(gaps.alias("gap"), own.alias("own")), start, step, lambda s: s["w"])
        n = F.size(listed)
        # A part that ends inside the text may have cut a word at its far end: that one is left out.
        if last:
            whole = F.when(F.col("cut"), F.slice(listed, 2, F.greatest(n - 1, F.lit(0)))).otherwise(listed)
            m = F.size(whole)
            return F.slice(whole, F.greatest(m - rules.window, F.lit(0)) + 1, rules.window)
        whole = F.when(F.length(side["part"]) >= reach, F.slice(listed, 1, F.greatest(n - 1, F.lit(0)))).otherwise(listed)
        return F.slice(whole, 1, rules.window)

    near = sides.select("key", "entity", F.concat(words(F.col("before"), True), words(F.col("after"), False)).alias("near"))
    return (
        near.withColumn("place", F.xxhash64(F.transform("near", lambda w: w["word"])))
        .select("key", "entity", "place", F.explode("near").alias("w"))
        .select(
            "key", "entity", "place", F.lower("w.word").alias("term"), F.col("w.start").alias("start"),
            (F.col("w.start") + F.length("w.word")).alias("end"),
        )
        .filter((F.length("term") >= rules.least_letters) & F.col("term").rlike(r"^\p{L}+$"))
    )


def disclosing_terms(docs: DataFrame, near: DataFrame, spans: DataFrame, rules: DisclosureRules = DisclosureRules()) -> DataFrame:
    """entity, term, disclosure, action for the pairs at or above the lower threshold.

    Probabilities are document frequencies over the whole corpus. A pair needs `support` different
    surroundings, so that copies of one text are no evidence.
    """
    n = docs.count()
    # Distinct rows first: partial sums are made before the shuffle, whatever one entity holds.
    places = near.select("entity", "term", "place").distinct().groupBy("entity", "term").agg(F.count("*").alias("support"))
    supported = places.filter(F.col("support") >= rules.support).select("entity", "term")
    # Without its small left side nothing of what follows is of use, so it is counted first.
    supported = stage(supported)
    together = (
        near.select("key", "entity", "term").distinct().join(supported, ["entity", "term"])
        .groupBy("entity", "term").agg(F.count("*").alias("both"))
    )
    every = F.concat(*[F.col(k) for k in KINDS])
    of_entity = (
        spans.select("key", F.explode(F.array_distinct(F.transform(every, lambda s: s["value"]))).alias("entity"))
        .groupBy("entity").agg(F.count("*").alias("entity_docs"))
    )
    # Terms of the corpus: each once per document, summed before and after the shuffle.
    of_term = (
        docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), _WORD))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("term_docs"))
    )
    counted = together.join(of_entity, "entity").join(of_term, "term")
    information = F.log(F.lit(float(n)) / F.col("entity_docs"))
    pmi = F.log(F.col("both") * float(max(1, n)) / (F.col("entity_docs") * F.col("term_docs")))
    return (
        counted.withColumn("disclosure", F.when(information > 0, pmi / information).otherwise(0.0))
        .filter(F.col("disclosure") >= rules.generalise)
        .select("entity", "term", "disclosure", F.when(F.col("disclosure") >= rules.remove, "remove").otherwise("generalise").alias("action"))
    )


def find_personal_data(docs: DataFrame, rules: DisclosureRules = DisclosureRules()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (array of spans), terms (array of spans), for every row.

    Needs doc_id and text; other columns are left out. A null or empty text has no spans; rows equal
    in doc_id and text each get the spans; an empty table gives an empty result. Terms that overlap a
    base span are not given. A span is kind, start, end in code points, and value; for terms kind is
    `term` and value the action.
    """
    found = base_spans(docs)
    base = stage(found.select("doc_id", "key", F.when(_any_span(), F.col("text")).alias("text"), *KINDS))
    holding = base.filter(_any_span())
    near = stage(_surroundings(holding, rules))
    pairs = disclosing_terms(docs, near, holding, rules)
    every = F.concat(*[F.col(k) for k in KINDS])
    terms = (
        near.join(pairs, ["entity", "term"]).groupBy("key")
        .agg(F.collect_set(F.struct(F.lit(TERM).alias("kind"), "start", "end", F.col("action").alias("value"))).alias("terms"))
    )
    joined = base.select("doc_id", "key", *KINDS).join(terms, "key", "left")
    clear = F.filter(
        F.coalesce("terms", F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")),
        lambda t: ~F.exists(every, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return joined.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        every.alias("base"),
        F.array_sort(clear, lambda a, b: (a["start"] - b["start"]).cast("int")).alias("terms"),
    )


def _any_span() -> Column:
    return F.size(F.concat(*[F.col(k) for k in KINDS])) > 0


def digest(found: DataFrame) -> DataFrame:
    """Counts, a hash of the base spans, and all spans as text."""
    base = _joined(F.col("base"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.size("base") > 0, base), F.when(F.size("terms") > 0, _joined(F.col("terms")))).alias("spans"),
    )


def sanitise(text: Column, base: Column, terms: Column) -> Column:
    """The text with every base span and generalised term replaced by its kind in brackets, removed terms left out."""
    spans = F.array_sort(F.concat(base, terms), lambda a, b: (a["start"] - b["start"]).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        label = F.when((s["kind"] == TERM) & (s["value"] == "remove"), F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        rest = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], rest, F.when(s["end"] > state["at"], label).otherwise("")).alias("out"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
