"""Personal data by patterns and by bootstrapped contexts, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import write_shared

#: The kinds, in their order, and the patterns of their seeds. Possessive forms find what the plain
#: ones find, in linear time and without recursion.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
#: Groups of digits joined by what joins them in seeds, each ended by white space, punctuation or the next group; not where
#: the first word has the digits of a phone by itself.
ENDED = r"(?=[\x20().-]*+[0-9]|[^A-Za-z0-9@\x20\x09-\x0D]*+(?:[\x20\x09-\x0D]|$))"
RUN = r"(?!(?:[^0-9\x20\x09-\x0D]*+[0-9]){7})[(+]*+[0-9]++(?:[\x20().-]++[0-9]++" + ENDED + ")++"
#: A run or word that looks like an identifier.
LIKELY = r"(?<![^\x20\x09-\x0D])(?:" + RUN + r"|(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]++)"
#: What precedes an identifier in its word; a bracket around its first digits is its own.
LEAD = r"^(?:[^A-Za-z0-9+@(]|\((?![0-9]+\)[\x20.-]*[0-9]))*+"
#: Contexts: characters looked at on each side, seeds that a pattern must have found, its least confidence (what that many
#: seeds give where nothing speaks against them), and the change of a confidence that counts as none.
NEAR, SUPPORT, CONFIDENT, SETTLED = 48, 5, 5 / 6, 1e-6
#: Texts with added spans that are few enough to be sent to all tasks; more are joined by a shuffle, to the same result.
SMALL = 10_000
#: Code points of the pieces that a long text is taken apart into, and spans that are gathered in one array at a time: an array
#: that grows by one is copied each time, so that only short ones may.
PIECE, GATHERED = 2000, 256
#: A piece for the patterns: at least PIECE characters (or the rest), up to a place that no match of any pattern can span.
SAFE = rf"(?s)(?=.).{{0,{PIECE}}}+(?:\z|.*?(?:(?<=[\x09-\x0D])|(?<=\x20)(?=[^\x20().0-9-])|\z))"


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET})" + "{3}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _let(value: Column, use) -> Column:
    """use(value), with value found once however often use needs it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _gathered(items: Column, step, kind: str) -> Column:
    """What step(acc, item) gathers in acc.out (of type array<kind>) from all items; acc.at, a place, goes on from 0."""
    empty = F.array().cast(f"array<{kind}>")

    def some(acc: Column, chunk: Column) -> Column:
        inner = F.aggregate(chunk, F.struct(acc["at"].alias("at"), empty.alias("out")), step)
        return _let(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    def whole(x: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.size(x), F.lit(GATHERED)), lambda i: F.slice(x, i + 1, F.lit(GATHERED)))
        return F.flatten(F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out")), some)["out"])

    return _let(items, whole)


def matches(text: Column, pattern: str, kind: str = "", rank: int = 0) -> Column:
    """Spans (code points, end exclusive) of the pattern's valid matches, leftmost first, none overlapping."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["found"])
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(_valid(kind, x["found"]), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def paired(found: Column) -> Column:
        return F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda p, m: F.struct(p.alias("piece"), m.alias("found")))

    pairs = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), paired)
    return F.when(text.rlike(pattern), _gathered(pairs, step, SPAN[6:-1])).otherwise(F.array().cast(SPAN))


def _pieces(text: Column) -> Column:
    """The text's pieces for the patterns, each with its place: (at, text)."""

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + F.length(x)).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), x.alias("text")))).alias("out"))

    one = F.array(F.struct(F.lit(0).alias("at"), text.alias("text")))
    return F.when(F.length(text) <= PIECE, one).otherwise(_gathered(F.regexp_extract_all(text, F.lit(SAFE), F.lit(0)), step, "struct<at:int,text:string>"))


def _seeds(piece: Column) -> Column:
    each = [F.when(piece.rlike("@" if kind == "email" else "[0-9]"), matches(piece, p, kind, i)).otherwise(F.array().cast(SPAN)) for i, (kind, p) in enumerate(KINDS.items())]
    return F.concat(*each)


def _placed(text: Column, spans) -> Column:
    """spans(piece) of all pieces of the text, in places of the text."""
    moved = lambda c: F.transform(spans(c["text"]), lambda s: F.struct((s["start"] + c["at"]).alias("start"), s["rank"].alias("rank"), (s["end"] + c["at"]).alias("end"), s["kind"].alias("kind")))
    return F.flatten(F.transform(_pieces(text), moved))


def _base(text: Column) -> Column:
    return F.when(text.rlike("[0-9@]"), F.array_sort(_placed(text, _seeds))).otherwise(F.array().cast(SPAN))


def _windows(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _cut(windows: Column, start: Column, end: Column) -> Column:
    """The text from start to end, read from its windows alone that hold it."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor(end / PIECE).cast("int")
    return F.substring(F.array_join(F.slice(windows, first + 1, last - first + 1), ""), start - first * PIECE + 1, end - start)


def _occurrences(texts: DataFrame) -> DataFrame:
    """Seeds, and words and runs of digits that look like identifiers, with the words around and the shape of each."""

    def both(piece: Column) -> Column:
        def with_words(seeds: Column) -> Column:
            return F.concat(seeds, F.filter(matches(piece, LIKELY), lambda w: ~F.exists(seeds, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))))

        return _let(_seeds(piece), with_words)

    def around(windows: Column) -> Column:
        return F.transform(
            _placed(F.col("text"), both),
            lambda s: F.struct(s.alias("s"), _cut(windows, s["start"], s["end"]).alias("found"), _cut(windows, F.greatest(F.lit(0), s["start"] - NEAR), s["start"]).alias("before"), _cut(windows, s["end"], s["end"] + NEAR).alias("after")),
        )

    some = texts.where(F.col("text").rlike("[0-9@]"))
    rows = some.select("key", F.explode(_let(_windows(F.col("text")), around)).alias("o")).select("key", "o.*")
    trimmed = F.regexp_extract("found", LEAD + "(.*?)[^A-Za-z0-9]*$", 1)
    skipped = F.length(F.regexp_extract("found", LEAD, 0))
    start = F.col("s.start") + F.when(F.col("s.kind") == "", skipped).otherwise(0)
    value = F.when(F.col("s.kind") == "", trimmed).otherwise(F.col("found"))
    left = F.lower(F.regexp_extract("before", r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1))
    near = F.lower(F.regexp_extract("before", r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1))
    right = F.lower(F.regexp_extract("after", r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1))
    shape = F.regexp_replace(F.regexp_replace(value, "[A-Za-z]+", "a"), "[0-9]+", "9")
    flat = rows.select("key", start.alias("start"), (start + F.length(value)).alias("end"), F.nullif(F.col("s.kind"), F.lit("")).alias("kind"), F.lower(value).alias("value"), shape.alias("shape"), left.alias("left"), near.alias("near"), right.alias("right"))
    patterns = F.array(F.when(F.col("left") != "", F.concat(F.lit("before:"), "left")), F.when(F.col("near") != "", F.concat(F.lit("next:"), "near")), F.when(F.col("right") != "", F.concat(F.lit("after:"), "right", F.lit(" shape:"), "shape")))
    return flat.where(F.col("value") != "").withColumn("pattern", F.explode(F.array_compact(patterns))).drop("shape", "left", "near", "right")


def _fits(kind: Column, value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    mail = value.rlike(r"^[^@\s]+@[^@\s]+$")
    return F.when(kind == "email", mail).when(kind == "ip", value.rlike(r"^[0-9]{1,3}(?:[.:_-][0-9]{1,3}){3}$")).when(kind == "card", digits.between(12, 19)).otherwise(digits.between(7, 15) & ~mail)


def discover(occurrences: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """Score patterns and values in turn over their graph; spans (key, start, end, kind) that no seed pattern finds.

    A pattern's score for a kind is the mean score of the distinct values in it, drawn towards 0 as if one more did not
    fit; a seed's score is 1, another value's 1 - (1 - score) over its patterns, or 0 if it can't be of the kind. Patterns
    need `support` distinct seeds. Each round solves a pattern's score exactly given the others', so that values that only it
    has don't weigh: it is seeds / (seeds + values that don't fit + 1) at first, and only rises, until all have settled.
    Patterns and values are only counted, summed and joined: a context that a third of all rows have sends a row a task.
    """
    occurrences = write_shared(occurrences, "occurrences")
    graph = occurrences.groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    seeds = graph.where(F.col("kind").isNotNull()).groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= support)
    kept = graph.withColumnRenamed("kind", "own").join(seeds, "pattern")
    kept = write_shared(kept.select("pattern", "value", "kind", "seeds", (F.col("own").isNull() & _fits(F.col("kind"), F.col("value"))).alias("open")), "graph")
    # values not open are seeds of the kind, or speak against it
    fixed = kept.groupBy("pattern", "kind").agg(F.max("seeds").alias("seeds"), F.count("*").alias("values"), F.count_if("open").alias("open"))
    trust = lambda settled, free: (F.col("seeds") + settled) / (F.col("values") + 1 - free)
    patterns = write_shared(fixed.withColumn("trust", trust(F.lit(0.0), F.col("open"))), "patterns")
    open_ = kept.where("open").select("pattern", "value", "kind")
    while True:
        doubts = open_.join(patterns.select("pattern", "kind", F.log(1 - F.col("trust")).alias("doubt")), ["pattern", "kind"])
        values = doubts.groupBy("value", "kind").agg(F.sum("doubt").alias("all"))
        others = doubts.join(values, ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum(F.exp(F.least(F.lit(0.0), F.col("all") - F.col("doubt")))).alias("free"))
        free = F.coalesce("free", F.lit(0.0))
        after = patterns.withColumnRenamed("trust", "was").join(others, ["pattern", "kind"], "left").withColumn("trust", trust(F.col("open") - free, free)).drop("free")
        patterns = write_shared(after, "patterns")
        if (patterns.agg(F.max(F.abs(F.col("trust") - F.col("was")))).first()[0] or 0.0) < SETTLED:
            break
        patterns = patterns.drop("was")
    sure = patterns.where(F.col("trust") >= confident - SETTLED).select("pattern", F.col("kind").alias("as"), "trust")
    new = occurrences.where(F.col("kind").isNull()).join(sure, "pattern").where(_fits(F.col("as"), F.col("value")))
    return new.groupBy("key", "start", "end").agg(F.max_by("as", F.struct("trust", "as")).alias("kind"))


def find(docs: DataFrame, text_col: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """All columns of docs, and `base` and `spans`: arrays of (start, rank, end, kind), in order of start and kind.

    base holds the seeds that the fixed patterns find in the whole text; spans holds these and what contexts add: the two
    words before, the one before, or the word after with the shape of the value, where nearly all values found there are seeds of a kind.
    Added spans never overlap seeds. Offsets are code points, end exclusive.

    Null and empty texts have none; repeated rows have the same; no rows give none; a column of docs that is called base or spans
    stays and the new one gets `_` after its name. A text of any length is taken apart into pieces, so that time grows with it;
    of a candidate of more than PIECE characters contexts see its first PIECE or more.
    """
    while base in docs.columns:
        base += "_"
    while spans in docs.columns or spans == base:
        spans += "_"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text, F.lit(9))
    new = discover(_occurrences(docs.select(key.alias("key"), text.alias("text"))))
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int") - 1
    added = new.groupBy("key").agg(F.collect_set(F.struct("start", rank.alias("rank"), "end", "kind")).cast(SPAN).alias("__added"))
    added = write_shared(added.withColumnRenamed("key", "__pii_key"), "added")
    small = added.limit(SMALL + 1).count() <= SMALL
    rows = docs.withColumn(base, _base(text)).withColumn("__pii_key", key)
    both = rows.join(F.broadcast(added) if small else added, "__pii_key", "left")
    whole = F.when(F.col("__added").isNull(), F.col(base)).otherwise(F.array_sort(F.concat(base, F.coalesce("__added", F.array().cast(SPAN)))))
    return both.withColumn(spans, whole).select(*docs.columns, base, spans)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, text_col: str = "text", spans: str = "spans") -> DataFrame:
    """The texts of find(), each span put out by its kind in brackets; of overlapping spans the first stands for all."""
    text = F.col(text_col)

    def put_out(windows: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            parts = F.concat(acc["out"], F.array(F.concat(_cut(windows, acc["at"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], parts).otherwise(acc["out"]).alias("out"))

        stop = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(_gathered(F.col(spans), step, "string"), ""), _cut(windows, stop, F.length(text)))

    return found.withColumn(text_col, F.when(F.size(spans) > 0, _let(_windows(text), put_out)).otherwise(text))
