"""Personal data by bootstrapped contextual extraction, in DataFrame functions alone.

Base: four kinds of spans by their formats, found in each whole text. The method: places that look like identifiers (slots: runs of words
with a digit or an at-sign) stand in lexical patterns, the words and marks to their left and right. A slot that holds a base span is a
seed of its kind; seeds give patterns a confidence for a kind, confident patterns give it to the other instances they surround, these
count when patterns are scored again, and so on for ``rounds`` rounds over the graph of distinct (pattern, instance) pairs. Slots without a base span that stand in
patterns of high confidence are the method's own spans.

Spans never leave their row: offsets come from the lengths of the pieces between matches, so base results need no shuffle. Only slots with their
patterns are written, once; the rounds aggregate them with partial sums, and copies of a text weigh once, as pairs are distinct. The last join brings spans
to the few texts that have any, by id and hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import cut

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
#: The formats, so written that each part of a text is scanned once: what a match may not follow keeps the scan from starting again inside a run,
#: and quantifiers that give nothing back keep long runs off the stack. A card is a whole chain of digits of the right length.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Parts of an address are numbers up to 255, with any zeros in front.
BYTES = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
#: A word with a digit or an at-sign, and those that follow it, with spaces and marks of numbers between.
SLOT_CHAR, PLAIN_CHAR = r"[^\s\"'<>|=;,]", r"[^\s\"'<>|=;,0-9@]"
SLOT = rf"(?<!{SLOT_CHAR}){PLAIN_CHAR}*+[0-9@]{SLOT_CHAR}*+(?:\x20++(?:[().-]++\x20++)*+{PLAIN_CHAR}*+[0-9@]{SLOT_CHAR}*+)*+"
#: What an identifier begins and ends with; its least and largest number of code points.
EDGE, LEAST, MOST = r"[^\p{L}\p{N}+@(]", 4, 64
#: Code points beside a slot from which its context is read; a context is words and marks.
REACH, CONTEXT = 96, r"[\p{L}\p{M}]++|[0-9]++|[^\p{L}\p{M}0-9\s]"
#: Rounds of scoring; distinct instances by which a pattern's share is drawn to the kind's share of all; confidence that counts at all, and that is high.
ROUNDS, PRIOR, COUNTS, HIGH = 3, 2.0, 0.5, 0.8
#: Distinct instances of the kind that a pattern must surround.
SUPPORT = 3

SPAN = "array<struct<kind:int,start:bigint,end:bigint>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once: an expression from outside would be computed anew in every call of a lambda function."""
    return F.get(F.transform(F.array(value), body), 0)


def running_total(sizes: Column, block: int = 512) -> Column:
    """Sum of an array's longs up to and with each place. In blocks, so that long arrays are not copied once for each entry."""
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("bigint"))
    grow = lambda a: F.aggregate(a, F.array().cast("array<bigint>"), lambda acc, x: F.concat(acc, F.array(x + last(acc))))
    firsts = lambda v: F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(block))
    within = bound(sizes, lambda v: F.transform(firsts(v), lambda i: grow(F.slice(v, i, block))))
    return bound(within, lambda w: F.flatten(F.zip_with(w, grow(F.transform(w, last)), lambda b, e: F.transform(b, lambda x: x + e - last(b)))))


def places(text: Column, pattern: str) -> Column:
    """array<struct<said, start, end, before, after>> of the pattern's matches, leftmost first; offsets in code points, end exclusive."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = bound(pieces, lambda p: F.transform(found, lambda m, i: F.struct(m.alias("said"), F.get(p, i).alias("before"), F.get(p, i + 1).alias("after"))))
    size = lambda b: (F.length(b["said"]) + F.length(b["before"])).cast("bigint")
    return bound(both, lambda all_: F.zip_with(all_, running_total(F.transform(all_, size)), lambda b, e: F.struct(b["said"], (e - F.length(b["said"])).alias("start"), e.alias("end"), b["before"], b["after"])))


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less 9 if that is over 9; the sum ends in 0."""
    one = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)", -1), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(one, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def is_sound(kind: str, said: Column) -> Column:
    """Whether a match of the kind's format keeps the rules beyond the format."""
    digits = F.regexp_replace(said, "[^0-9]", "")
    return {"email": F.lit(True), "ip": said.rlike(BYTES), "card": _luhn(digits), "phone": F.length(digits).between(9, 15)}[kind]


def base_spans(text: Column, kind: str) -> Column:
    """The kind's spans of a text: array<struct<kind, start, end>> with the kind's place in KINDS."""
    number = KINDS.index(kind)
    sound = F.filter(places(text, FORMATS[kind]), lambda m: is_sound(kind, m["said"]))
    spans = F.transform(sound, lambda m: F.struct(F.lit(number).alias("kind"), m["start"], m["end"]))
    return F.when(text.contains({"email": "@", "ip": ".", "card": "", "phone": "+"}[kind]), spans).otherwise(F.array().cast(SPAN))


def holds(text: Column, kind: str) -> Column:
    return F.exists(F.regexp_extract_all(text, F.lit(FORMATS[kind]), F.lit(0)), lambda m: is_sound(kind, m))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span by kind, then start, joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def slots(texts: DataFrame) -> DataFrame:
    """key, start, end, instance, seed (kinds it holds a base span of: array<int>) and patterns (array<string>) of each slot of key, text.

    Offsets are those of the slot without marks at its ends. Slots of fewer than LEAST or more than MOST code points (words with one digit, tables of
    numbers) are no identifiers and neither seeds nor found.
    """
    has = F.col("text").rlike("[0-9@]")
    met = texts.filter(has).select("key", F.explode(places(F.col("text"), SLOT)).alias("m"))
    # Only the nearest code points of the text between two slots are carried on.
    met = met.select("key", F.col("m.said").alias("said"), F.col("m.start").alias("at"), F.substring("m.before", -REACH, REACH).alias("before"), F.substring("m.after", 1, REACH).alias("after"))
    inner = F.regexp_replace(F.regexp_replace("said", f"^{EDGE}+", ""), rf"(?<=[\p{{L}}\p{{N}}]){EDGE[:-1]}(]++$", "")
    met = met.withColumns({"instance": F.lower(inner), "start": F.col("at") + F.length("said") - F.length(F.regexp_replace("said", f"^{EDGE}+", "")), "size": F.length(inner)})
    met = met.filter(F.col("size").between(LEAST, MOST))
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(CONTEXT), F.lit(0))
    met = met.withColumns({"left": words(F.concat_ws(" ", "before", F.regexp_extract("said", f"^{EDGE}+", 0))), "right": words(F.col("after"))})
    # A text's edge is a mark of its own; a context cut at the reach just has fewer words.
    l1, l2, l3 = (F.coalesce(F.try_element_at("left", F.lit(-i)), F.lit("^")) for i in (1, 2, 3))
    r1, r2 = (F.coalesce(F.try_element_at("right", F.lit(i)), F.lit("$")) for i in (1, 2))
    patterns = F.array(F.concat_ws(" ", l1, F.lit("_")), F.concat_ws(" ", l2, l1, F.lit("_")), F.concat_ws(" ", l3, l2, l1, F.lit("_")), F.concat_ws(" ", l1, F.lit("_"), r1), F.concat_ws(" ", F.lit("_"), r1, r2))
    seed = F.filter(F.array(*[F.when(holds(F.col("said"), k), F.lit(i)) for i, k in enumerate(KINDS)]), lambda k: k.isNotNull())
    return met.select("key", "start", (F.col("start") + F.col("size")).alias("end"), "instance", seed.alias("seed"), patterns.alias("patterns"))


def confident_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, confidence of the patterns that count, from slots; a pattern counts for every kind of which it is confident enough.

    A pattern's confidence is its instances' mean score of the kind, drawn by PRIOR instances to the kind's share of all instances; an instance's score is 1
    for a seed, else one less the product of its patterns' doubts, and counts from HIGH on.
    """
    edges = cut(found.select("instance", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    instances = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    shares = instances.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.array_contains("seed", i).cast("double")).alias(f"s{i}") for i in range(len(KINDS))]).first()
    share = F.element_at(F.array(*[F.lit(float(shares[f"s{i}"] or 0.0)) for i in range(len(KINDS))]), F.col("kind") + 1)
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    # Only patterns with a seed ever count, so the rest of the graph stays out of the rounds.
    held = edges.filter(F.size("seed") > 0).select("pattern", "instance", F.explode("seed").alias("kind")).withColumn("score", F.lit(1.0))
    seeded = cut(held.groupBy("pattern", "kind").agg(F.sum("score").alias("seeds")).filter(F.col("seeds") >= SUPPORT).join(sizes, "pattern"))
    confidence = lambda mass: (mass + PRIOR * share) / (F.col("size") + PRIOR)
    scored = seeded.withColumn("confidence", confidence(F.col("seeds")))
    open_edges = edges.filter(F.size("seed") == 0).select("pattern", "instance")
    for _ in range(rounds - 1):
        sure = scored.filter(F.col("confidence") >= COUNTS).select("pattern", "kind", "confidence")
        doubt = open_edges.join(sure, "pattern").groupBy("instance", "kind").agg(F.exp(F.sum(F.log(1 - F.col("confidence")))).alias("doubt"))
        new = doubt.filter(1 - F.col("doubt") >= HIGH).select("instance", "kind", (1 - F.col("doubt")).alias("score"))
        gained = open_edges.join(new, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("gained"))
        scored = cut(seeded.join(gained, ["pattern", "kind"], "left").withColumn("confidence", confidence(F.col("seeds") + F.coalesce("gained", F.lit(0.0)))).drop("gained"))
    return scored.filter(F.col("confidence") >= COUNTS).select("pattern", "kind", "confidence")


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """key, spans (array<struct<kind, start, end>>): slots without a base span whose own patterns together are of high confidence, of the likeliest kind."""
    asked = found.filter(F.size("seed") == 0).select("key", "start", "end", F.explode(F.array_distinct("patterns")).alias("pattern"))
    doubt = asked.join(patterns, "pattern").groupBy("key", "start", "end", "kind").agg(F.exp(F.sum(F.log(1 - F.col("confidence")))).alias("doubt"))
    best = doubt.groupBy("key", "start", "end").agg(F.min(F.struct("doubt", "kind")).alias("b")).filter(1 - F.col("b.doubt") >= HIGH)
    return best.groupBy("key").agg(F.collect_set(F.struct(F.col("b.kind").alias("kind"), "start", "end")).alias("spans"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and, for each row, base (the base spans) and found (the method's own), each array<struct<kind, start, end>>, kind a place in KINDS.

    A null text counts as empty, and has no spans. Rows that share id and text share their spans; rows without an id are told apart by text alone. Base spans are never changed; found ones hold none of them.
    A kept column named base or found is replaced; other columns don't matter. An empty table, or one without seeds, gives no found spans.
    """
    keep = [c for c in dict.fromkeys(keep) if c not in ("base", "found")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), text).cast("binary"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), key.alias("key"), text.alias("text"))
    met = cut(slots(rows))
    own = discovered(met, confident_patterns(met)).withColumnRenamed("spans", "found")
    base = rows.select("kept", "key", F.concat(*[base_spans(F.col("text"), k) for k in KINDS]).alias("base"))
    return base.join(own, "key", "left").select("kept.*", "base", F.coalesce("found", F.array().cast(SPAN)).alias("found"))
