"""Personal data: base patterns and bootstrapped contextual extraction.

Base spans (e-mail, IP address, card, phone) come from fixed expressions.
They are the seeds of the bootstrap:

* instances are values: those of base spans, known with their kind, and
  other candidates that look like identifiers: runs of tokens with digits and
  single spaces between them, tokens with an @ or a written "(at)", and
  addresses written out with "at" and "dot";
* patterns are lexical contexts: the word before alone, with the one before it
  and with the word after, and the two words after;
* an edge joins an instance to a pattern that it was seen in.

Each round scores a pattern for a kind by the confidence of the instances
of that kind against those of other kinds or shapes, and an instance by the
patterns that hold it (noisy or).  Patterns count when they have
``least_support`` of confidence and a score of ``least_score``; values
reach ``least_confidence`` by them (equal confidence of two kinds: the first as
listed).  Found values are spans wherever they occur as a candidate.  Only values and contexts are shuffled, never texts;
everything is DataFrame functions, positions included: the pieces between
matches give the offsets.

Edge cases: a null text counts as empty; a text without a span has the hash
of the empty string and an empty list; repeated rows are reported each; null
ids are kept; very long texts are read whole, their matches in runs; an empty
table gives an empty result; further columns, whatever their names, are not
read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.sources.sinks import materialize

KINDS = ("email", "ip", "card", "phone")

# The base expressions, written so that no text takes more than
# linear time (a look-behind pins the start of a run, runs do not give back).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for an expression to be tried.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TOKEN = (r"(?<!\S)(?:[A-Za-z0-9._%+-]++\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++"
         r"|(?=\S*?[0-9])\S++(?:\x20(?=\S*?[0-9])\S++)*+|(?=\S*?(?:@|[\[(]at[\])]))\S++)")
TOKEN_NEEDS = r"[0-9@]|[\[(]at[\])]|\x20dot\x20"
#: Shapes that a token may have to be found as a kind.
SHAPES = {
    "email": r"^[A-Za-z0-9._%+-]+(?:@|[\[(]at[\])]|\x20at\x20)[A-Za-z0-9-]+(?:(?:\.|\x20dot\x20)[A-Za-z0-9-]+)*+$",
    "ip": r"^[0-9]{1,3}(?:[^0-9A-Za-z]{1,3}[0-9]{1,3}){3}$",
    "card": r"^(?:[0-9][^0-9A-Za-z]?){12,19}$",
    "phone": r"^[^0-9A-Za-z]?(?:[0-9][^0-9A-Za-z]{0,2}){7,15}$",
}

_AT_MOST_255 = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Matches that are placed in one go.
_RUN = 128
_SPAN = "array<struct<kind:int,start:int,end:int,value:string,patterns:array<string>>>"


@dataclass(frozen=True)
class Settings:
    rounds: int = 3
    least_support: float = 3.0
    least_score: float = 0.8
    least_confidence: float = 0.8
    unknown_weight: float = 0.1


def _word(text: Column, expression: str, group: int) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(text, expression, group)), r"[^\p{L}]+", "")


def _context(before: Column, after: Column) -> Column:
    """The patterns of a place; those with a word without letters are left
    out."""
    tail, head = F.substring(before, -200, 200), F.substring(after, 1, 200)
    left2 = _word(tail, r"(\S+)\s+(\S+)\s+\S*$", 1)
    left1 = _word(tail, r"(\S+)\s+\S*$", 1)
    right1 = _word(head, r"^\S*\s+(\S+)", 1)
    right2 = _word(head, r"^\S*\s+\S+\s+(\S+)", 1)
    return F.array_compact(F.array(
        F.when(left1 != "", F.concat(left1, F.lit(" _"))),
        F.when((left1 != "") & (left2 != ""), F.concat(left2, F.lit(" "), left1, F.lit(" _"))),
        F.when((left1 != "") & (right1 != ""), F.concat(left1, F.lit(" _ "), right1)),
        F.when((right1 != "") & (right2 != ""), F.concat(F.lit("_ "), right1, F.lit(" "), right2))))


def matches(text: Column, expression: str, needs: str, kind: int) -> Column:
    """All matches of an expression as spans in code points (end exclusive).

    The pieces between matches and the matches alternate, so the lengths
    before each give its start."""
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    between = F.split(text, expression, -1)

    # zipped before the fold, so that the text is read once and not at every step
    n = F.size(found)
    places = F.arrays_zip(found.alias("value"), F.slice(between, F.lit(1), n).alias("before"), F.slice(between, F.lit(2), n).alias("after"))

    def step(state: Column, place: Column) -> Column:
        value = place["value"]
        start = state["at"] + F.length(place["before"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                        value.alias("value"), _context(place["before"], place["after"]).alias("patterns"))
        return F.struct((start + F.length(value)).alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    none = F.expr(f"cast(array() as {_SPAN})")

    def run(start: Column, part: Column) -> Column:
        return F.aggregate(part, F.struct(start.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def length(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda n, place: n + F.length(place["before"]) + F.length(place["value"]))

    def spans(parts: Column) -> Column:
        starts = _let(F.transform(parts, length), lambda sizes: F.aggregate(
            sizes, F.array(F.lit(0)), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n))))
        return F.flatten(F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), lambda part, start: run(start, part)))

    # runs of some matches each: growing one array match by match would take quadratic time
    runs = _let(places, lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _RUN).cast("int")),
                                                 lambda k: F.slice(all_, k * _RUN + 1, F.lit(_RUN))))
    return F.when(text.rlike(needs) & (n > 0), _let(runs, spans)).otherwise(none)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also inside of lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.floor(digit / 10).cast("int") + digit % 10

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^%s(?:\.%s){3}$" % (_AT_MOST_255, _AT_MOST_255))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)



def base_spans(text: Column) -> Column:
    """The valid base spans of a text column, kind by kind."""
    def of(number: int, kind: str) -> Column:
        return F.filter(matches(text, BASE[kind], NEEDS[kind], number), lambda s: _valid(kind, s["value"]))

    return F.concat(*[of(n, kind) for n, kind in enumerate(KINDS)])


def _tidy(value: Column) -> Column:
    """A candidate without the punctuation around it."""
    return F.regexp_replace(value, r"^[^A-Za-z0-9+(\[]+|[^A-Za-z0-9]+$", "")


def other_tokens(text: Column, base: Column) -> Column:
    """Tokens that look like identifiers and touch no base span."""
    return F.filter(matches(text, TOKEN, TOKEN_NEEDS, -1), lambda t: ~F.exists(
        base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))


def _edges(rows: DataFrame) -> DataFrame:
    """Distinct (pattern, value, kind): kind is null for values not known."""
    def of(column: str, kind: Column, value: Column) -> DataFrame:
        places = rows.select(F.explode(column).alias("s"))
        return places.select(F.explode("s.patterns").alias("pattern"), value.alias("value"), kind.alias("kind"))

    known = of("base", F.col("s.kind"), F.col("s.value"))
    other = of("tokens", F.lit(None).cast("int"), _tidy(F.col("s.value")))
    return known.unionByName(other).where(F.col("value") != "").distinct()


def bootstrap(edges: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(value, kind, confidence) of the values found by their contexts."""
    kinds = F.array(*[F.when(F.col("value").rlike(SHAPES[k]), F.lit(n)) for n, k in enumerate(KINDS)])
    edges = materialize(edges.withColumn("shapes", F.when(F.col("kind").isNull(), F.array_compact(kinds))))
    # patterns without a known value of a kind never score for it: leave them out
    seeded = edges.where(F.col("kind").isNotNull()).groupBy("pattern", F.col("kind").alias("target")).agg(F.count(F.lit(1)).alias("seeds"))
    target = F.explode(F.sequence(F.lit(0), F.lit(len(KINDS) - 1)))
    open_ = edges.where(F.size("shapes") > 0).select("pattern", "value", F.explode("shapes").alias("target")).distinct()
    against = (edges.withColumn("target", target)
               .where(F.when(F.col("kind").isNotNull(), F.col("kind") != F.col("target"))
                      .otherwise(~F.array_contains("shapes", F.col("target"))))
               .groupBy("pattern", "target").agg(F.count(F.lit(1)).alias("against")))
    patterns = materialize(open_.select("pattern", "target").distinct()
                           .join(seeded, ["pattern", "target"], "left").join(against, ["pattern", "target"], "left")
                           .select("pattern", "target", F.coalesce("seeds", F.lit(0)).alias("seeds"),
                                   F.coalesce("against", F.lit(0)).alias("against")))
    places = materialize(open_)
    found = places.select("value", "target").limit(0).withColumn("confidence", F.lit(0.0))
    for _ in range(s.rounds):
        belief = (places.join(found, ["value", "target"], "left")
                  .groupBy("pattern", "target").agg(F.sum(F.coalesce("confidence", F.lit(0.0))).alias("belief"),
                                                    F.sum(F.when(F.col("confidence").isNull(), 1).otherwise(0)).alias("unknown")))
        support = F.col("seeds") + F.col("belief")
        score = support / (support + F.col("against") + s.unknown_weight * F.col("unknown") + 0.25)
        scored = (patterns.join(belief, ["pattern", "target"]).withColumn("support", support).withColumn("score", score)
                  .where((F.col("support") >= s.least_support) & (F.col("score") >= s.least_score)))
        found = materialize(places.join(scored.select("pattern", "target", "score"), ["pattern", "target"])
                            .groupBy("value", "target").agg((1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("confidence"))
                            .where(F.col("confidence") >= s.least_confidence))
    return (found.groupBy("value").agg(F.max(F.struct("confidence", (-F.col("target")).alias("order"))).alias("best"))
            .select("value", (-F.col("best.order")).alias("kind"), F.col("best.confidence").alias("confidence")))


def _listed(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_documents(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256 and spans."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    rows = materialize(rows.withColumn("base", base_spans(F.col("text")))
                       .select("row", "doc_id", "base", other_tokens(F.col("text"), F.col("base")).alias("tokens")))
    values = bootstrap(_edges(rows), s)
    more = (rows.select("row", F.explode("tokens").alias("t"))
            .select("row", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.value").alias("token"), _tidy(F.col("t.value")).alias("value"))
            .join(values, "value"))
    # a span is the token without the punctuation around it
    begin = F.col("start") + F.instr("token", F.col("value")) - 1
    more = (more.groupBy("row").agg(F.collect_list(F.struct(
        F.col("kind"), begin.alias("start"), (begin + F.length("value")).alias("end"))).alias("more")))
    spans = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    kinds = F.transform("base", lambda b: b["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.join(more, "row", "left").select(
        "doc_id", *counts, F.sha2(_listed(spans), 256).alias("base_sha256"),
        _listed(F.when(F.col("more").isNull(), spans).otherwise(F.concat(spans, F.col("more")))).alias("spans"))
