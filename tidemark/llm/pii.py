"""Personal data: spans of four kinds, and terms that reveal them.

The base kinds are found by pattern. What else gives a protected value away is estimated from the corpus: a term t
reveals a value e as far as knowing t lowers the surprise of e, that is by PMI(t, e) / IC(e), which is 1 if t is
never seen without e. Co-occurrence is counted in texts that have both and the frequency of t over all texts, both
in units: a text with its copies and near copies counts once. Terms above a threshold are removed or generalised wherever they occur.

Only DataFrame functions are used. Patterns are written without repeated groups, on which Java's engine recurses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

KINDS = ("email", "ip", "card", "phone")
# The terms looked at.
TERM = r"\p{L}{3,}"
# The disclosure from which a term is generalised, and removed. To decide this, a disclosure seen in n units is shrunk
# by n / (n + DOUBT): a term that is always with its value is taken from two units on, others need more.
GENERALISE, REMOVE, DOUBT = 0.8, 0.999, 0.5
# Least hashes of neighbouring words that stand for a text: copies and most near copies have all of them alike.
SIGNATURE = 3
# Further least hashes, each in an order of its own (the hash with some bits turned), that tell whether units are as
# different as they look: near copies of which a part was changed have most of them alike, texts with a few words in
# common hardly any. So the units count by the order that is ALIKE-th in telling them apart least.
ORDERS, ALIKE = tuple((k * 0x9E3779B97F4A7C15) % (1 << 63) for k in range(1, 9)), 3

# Stand-ins of the same length, so that a run of single separators is a run of one class. They belong to no word.
_GAP, _DOT, _OTHER = "\ue000", "\ue001", "\ue002"
_LABEL, _LOCAL = "A-Za-z0-9-", f"A-Za-z0-9._%+{_DOT}-"


def _prepared(text: Column) -> Column:
    """The text with the stand-ins' own code points out of the way."""
    return F.translate(text, _GAP + _DOT, _OTHER * 2)


def _fixed(text: Column) -> dict[str, tuple[Column, str, Column]]:
    """Of each kind: the text to search, a pattern, and whether the text can have a match at all.

    A match begins at the first character of a run or where the last match ended (\\G): later starts in a run fail
    if the first does, so they need no trial, and long runs cost what their length costs.
    """
    has = F.contains
    digits = text.rlike("[0-9]")
    dotted = F.regexp_replace(text, rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", _DOT)
    spaced = F.regexp_replace(text, "(?<=[0-9])[ -](?=[0-9])", _GAP)
    return {
        "email": (dotted, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++{_DOT}[{_LABEL}{_DOT}]++", has(text, F.lit("@"))),
        "ip": (text, r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", digits & has(text, F.lit("."))),
        "card": (spaced, rf"[0-9][0-9{_GAP}]++", digits),
        "phone": (text, r"\+[0-9][ ().0-9-]+[0-9]", has(text, F.lit("+"))),
    }


def _is_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), small)


def _is_card(match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.substring(digits, F.lit(1) + i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(F.pmod(n - i, F.lit(2)) == 0, twice).otherwise(digit)

    luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, i: total + value(i))
    return F.when(n.between(16, 19), luhn % 10 == 0).otherwise(F.lit(False))


def _is_phone(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)


_SPANS = "array<struct<kind: string, start: int, end: int, value: string>>"


def _located(text: Column, pattern: Column | str, kind: str, good) -> Column:
    """Spans of the matches of a pattern: what lies between them gives their places."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    parts = F.arrays_zip(between.alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.char_length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        more = F.when(good(x["value"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    matched = F.filter(parts, lambda x: x["value"].isNotNull())
    return F.aggregate(matched, start, step, lambda state: state["spans"])


def base_spans(text: Column) -> Column:
    """All base spans of a text, kind by kind and by start; positions are code points, ends exclusive."""
    good = {"email": lambda m: F.lit(True), "ip": _is_ip, "card": _is_card, "phone": _is_phone}
    ready = _prepared(F.coalesce(text.cast("string"), F.lit("")))
    parts = [
        F.when(possible, _located(searched, pattern, kind, good[kind])).otherwise(F.array().cast(_SPANS))
        for kind, (searched, pattern, possible) in _fixed(ready).items()
    ]
    return F.concat(*parts)


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _words(text: Column) -> Column:
    """The terms of a text in order, without those inside an address."""
    ready = _prepared(F.coalesce(text.cast("string"), F.lit("")))
    searched, pattern, possible = _fixed(ready)["email"]
    open_text = F.when(possible, F.regexp_replace(searched, F.lit(pattern), F.lit(" "))).otherwise(ready)
    return F.regexp_extract_all(F.lower(open_text), F.lit(TERM), F.lit(0))


def with_units(docs: DataFrame) -> DataFrame:
    """docs with words, pairs and unit: what counts once, a text with its copies and near copies. Needs a column text.

    pairs are the hashes of neighbouring words, in order.
    """
    hashed = docs.withColumn("words", _words(F.col("text"))).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    after = F.slice("hashes", F.lit(2), F.size("hashes"))
    hashed = hashed.withColumn("pairs", F.array_sort(F.array_distinct(F.zip_with("hashes", after, lambda a, b: F.xxhash64(a, b)))))
    unit = F.when(F.size("words") == 0, F.xxhash64(_digest(F.col("text")))).otherwise(F.xxhash64(F.slice("pairs", 1, SIGNATURE)))
    return hashed.withColumn("unit", unit).withColumn("words", F.array_distinct("words")).drop("hashes")


def found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, digest and unit of the text, base spans, of texts that have any also words and sketch: written, without the texts."""
    whole = F.col("text")
    narrow = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    spans = with_units(narrow).withColumn("spans", base_spans(whole))
    sketch = F.array(*[F.array_min(F.transform("pairs", _turned(order))) for order in ORDERS])
    has = F.size("spans") > 0
    more = [F.when(has, F.col("words")).alias("words"), F.when(has, sketch).alias("sketch")]
    return written(spans.select("key", _digest(whole).alias("digest"), "unit", "spans", *more), "spans")


def _turned(order: int):
    return lambda x: x.bitwiseXOR(F.lit(order))


def _disclosure(share: Column, n_value: Column, n_docs: int) -> Column:
    """PMI of a term and a value over the value's information, for a share of the term's documents at the value."""
    n = F.lit(float(max(n_docs, 1)))
    odds = n / F.least(n_value, n)
    return F.when(odds > 1, F.log2(share * odds) / F.log2(odds)).otherwise(F.lit(0.0))


def _shrunk(disclosure: Column, n: Column) -> Column:
    return disclosure * n / (n + DOUBT)


def revealing_terms(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """term, disclosure, kind: the terms that reveal some protected value, with the most revealing share and its kind.

    A term and a value occur together where they are in one text, at any distance. Everything is counted in units, so
    that copies and near copies of a text are one piece of evidence for a term and one against it. Two bounds leave out
    what can't reveal, and nothing else: values of a single unit before they are paired, and, as a term occurs at least
    in the units that have it beside some value, most terms before their frequency is counted over all texts.
    """
    n_docs = spans.select("unit").distinct().count()
    enough = lambda n: _shrunk(F.lit(1.0), F.col(n)) >= GENERALISE
    has = spans.select("unit", F.explode("spans").alias("s")).select("unit", "s.kind", F.lower("s.value").alias("value")).distinct()
    has = written(has, "values")
    values = has.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_value")).where(enough("n_value"))
    values = written(values, "repeated-values")
    has = written(has.join(values, ["kind", "value"], "left_semi"), "units-with-values")
    near = spans.join(has.select("unit").distinct(), "unit", "left_semi").select("unit", F.explode("words").alias("term")).distinct()
    near = written(near, "terms-with-values")
    at_least = near.groupBy("term").agg(F.count(F.lit(1)).alias("n_least")).where(enough("n_least"))
    both = has.join(near, "unit").groupBy("kind", "value", "term").agg(F.count(F.lit(1)).alias("both"))
    together = both.where(enough("both")).join(values, ["kind", "value"]).join(at_least, "term")
    share = lambda n: F.col("both") / F.col(n)
    revealed = lambda n: _disclosure(share(n), F.col("n_value"), n_docs)
    together = written(together.where(_shrunk(revealed("n_least"), F.col("both")) >= GENERALISE), "together")
    candidates = written(together.select("term").distinct(), "candidates")
    # how often candidate terms occur in the whole corpus, in units
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = with_units(docs.select(whole.alias("text"))).select("unit", F.explode("words").alias("term"))
    frequency = words.join(candidates, "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    scored = together.join(frequency, "term").withColumn("disclosure", revealed("n_term"))
    scored = written(scored.where(_shrunk(F.col("disclosure"), F.col("both")) >= GENERALISE), "scored")
    pair = ["kind", "value", "term"]
    sketches = spans.where(F.col("sketch").isNotNull()).groupBy("unit").agg(F.min("sketch").alias("sketch"))
    shown = scored.select(*pair).join(has, ["kind", "value"]).join(near, ["unit", "term"]).join(sketches, "unit")
    different = shown.select(*pair, F.posexplode("sketch").alias("order", "least")).distinct().groupBy(*pair, "order")
    proof = different.agg(F.count(F.lit(1)).alias("n")).groupBy(*pair).agg(F.element_at(F.array_sort(F.collect_list("n")), ALIKE).alias("n_proof"))
    sure = scored.join(proof, pair).where(_shrunk(F.col("disclosure"), F.col("n_proof")) >= GENERALISE)
    revealing = sure.groupBy("term").agg(F.max(F.struct("disclosure", "kind")).alias("top"))
    return written(revealing.select("term", "top.disclosure", "top.kind"), "revealing")


def term_spans(docs: DataFrame, revealing: DataFrame, text: str = "text") -> DataFrame:
    """digest, terms, shapes: the revealing terms of each different text that has any, with their places."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = docs.select(_digest(whole).alias("digest"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(whole), F.lit(TERM), F.lit(0)))).alias("term"))
    hits = words.join(revealing, "term").groupBy("digest").agg(F.collect_set(F.struct("term", "disclosure", "kind")).alias("terms"))
    hits = written(hits, "texts-with-terms")
    texts = docs.select(_digest(whole).alias("digest"), whole.alias("text")).join(hits, "digest")
    names = F.array_join(F.transform("terms", lambda t: t["term"]), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), names, F.lit(r")(?!\p{L})"))
    spans = _located(F.col("text"), pattern, "term", lambda m: F.lit(True))
    each = texts.select("digest", "terms", spans.alias("term_spans"))
    return written(each.groupBy("digest").agg(F.first("terms").alias("terms"), F.first("term_spans").alias("term_spans")), "term-spans")


def _equal_to(kind: str):
    return lambda x: x == kind


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, digest, spans (base), term_spans (added), terms (revealing, with disclosure and kind).

    A null text counts as empty. Repeated rows and null keys give a row each, an empty table none.
    """
    base = found(docs, key, text)
    added = term_spans(docs, revealing_terms(docs, base, text), text)
    return base.drop("unit", "words", "sketch").join(added, "digest", "left").withColumnRenamed("key", key)


def report(docs: DataFrame) -> DataFrame:
    """Counts and spans of each document."""
    rows = detect(docs)
    kinds = F.transform("spans", lambda s: s["kind"])
    count = [F.size(F.filter(kinds, _equal_to(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    # base spans are in order of kind and start already; terms come after them
    base, added = _listed(F.col("spans")), _listed(F.col("term_spans"))
    both = F.concat_ws(",", F.when(base != "", base), F.when(added != "", added))
    return rows.select("doc_id", *count, F.sha2(base, 256).alias("base_sha256"), both.alias("spans"))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs with their personal data replaced by the name of its kind.

    Terms that give a value away entirely are removed, other revealing terms are generalised to the kind of what
    they reveal. Overlapping spans are replaced as one. A null text stays null; all other columns are carried.
    """
    base = found(docs, docs.columns[0], text)
    added = term_spans(docs, revealing_terms(docs, base, text), text)
    whole = F.coalesce(F.col(f"doc.{text}").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.withColumns({"digest": _digest(whole), "base": base_spans(whole)}).join(added, "digest", "left")

    def for_term(span: Column) -> Column:
        term = F.filter("terms", lambda t: t["term"] == F.lower(span["value"]))
        known = F.element_at(term, 1)
        return F.when(F.size(term) == 0, F.lit("")).when(known["disclosure"] >= REMOVE, F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(known["kind"]), F.lit(" CONTEXT]"))
        )

    def shape(span: Column, says: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), says.alias("says"))

    spans = F.concat(
        F.transform("base", lambda s: shape(s, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))),
        F.coalesce(F.transform("term_spans", lambda s: shape(s, for_term(s))), F.array().cast("array<struct<start: int, end: int, says: string>>")),
    )
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        kept = F.concat(done["out"], F.substring(whole, done["at"] + 1, s["start"] - done["at"]), s["says"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, kept).otherwise(done["out"]).alias("out"))

    rest = lambda done: F.concat(done["out"], F.substring(whole, done["at"] + 1, F.char_length(whole)))
    clean = F.when(F.size("spans") == 0, F.col(f"doc.{text}").cast("string")).otherwise(
        F.aggregate(F.array_sort("spans"), state, step, rest)
    )
    rows = rows.withColumn("spans", spans)
    return rows.select(*[clean.alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
