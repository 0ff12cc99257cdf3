"""Personal data by bootstrapped contextual extraction, in DataFrame expressions.

Seeds are the entities of four base kinds (email, ip, card, phone), found by patterns. Their
lexical context (the one and the two words to the left, lower case, digits as 0) induces
patterns. Every identifier-like string of any length is an instance: a token with a digit or an @
inside, and a group of digits or capitals with digits that the base kinds' separators join (from
one start the longest that no base span touches). A token without digit and @ is none. Each occurrence is an edge of a graph between patterns and instances. Spark scores it
in rounds: a pattern is trusted as far as its distinct instances are known, and an unknown
instance by the patterns that it stands in (noisy or). Occurrences of trusted instances in
trusted patterns that no base span covers are added as spans of kind ``id``.

Texts are read in one pass that keeps only matches, gaps and contexts; positions are running sums
over gaps and matches, computed in a window over one text's matches, so a text with very many
matches costs time in proportion. A pattern or an instance of a third of all rows is combined
before each shuffle (counts of distinct edges, sums).

Base patterns match leftmost and without overlaps per kind; they are written with possessive
quantifiers and look-behinds that reject starts inside a run, which match the same strings in
linear time. Positions are code points, ends exclusive.

Inputs: a null text is empty and, like any text without a match, has no spans; texts of any length
are read whole; repeated rows give repeated results and count once as an edge; a null doc_id is
kept; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histwise.llm.common import OWN, stored, text_or_empty

# The base kinds in order, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
FOUND = "id"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    FOUND: r"(?<![A-Za-z0-9._@%+:-])[A-Za-z._%+:-]*+(?:[0-9]|@[A-Za-z0-9])(?:[A-Za-z0-9._@%+:-]*[A-Za-z0-9])?+",
    "group": r"(?<![A-Za-z0-9._@%+:-])\(?[A-Z]*+[0-9][A-Z0-9]*+(?![A-Za-z])"
             r"(?:(?:[\x20.-]?\(|\)?[\x20.-]|\))(?:[A-Z]*+[0-9][A-Z0-9]*+|[A-Z]{4}(?=\x20))(?![A-Za-z]))++",
}
#: What a text must hold to be searched for a kind at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
IP = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"

# A context reaches so far to the left.
CONTEXT_CHARS = 80
# Rounds of the graph; trust that adds a span; known instances that a pattern needs at least.
ROUNDS, TRUST, SUPPORT = 3, 0.8, 3


def _matches(text: Column, kind: str) -> Column:
    """Matches with the length of the gap before each and the end of its text."""
    found, pieces = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), F.split(text, PATTERNS[kind], -1)
    gaps = F.transform(pieces, lambda p: F.length(p))
    tails = F.transform(pieces, lambda p: F.substring(p, -CONTEXT_CHARS, CONTEXT_CHARS))
    columns, fields = [gaps.alias("gap"), found.alias("match"), tails.alias("left")], "gap: int, match: string, left: string"
    need = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike("[0-9@]")
    return F.when(need, F.arrays_zip(*columns)).otherwise(F.array().cast(f"array<struct<{fields}>>"))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda a, i: a + F.when((F.length(digits) - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int"))
        .otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substr(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", match.rlike(IP))
            .when(kind == "card", F.when((n >= 12) & (n <= 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", (n >= 9) & (n <= 15))
            .otherwise(F.lit(True)))


def occurrences(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: row, doc_id, key), and (spans: row, kind, start, end, match, left) of the base kinds and of
    all identifier-like strings. ``left`` is the text before a match, other matches too. ``row`` numbers
    the rows; ``key`` is a hash of the text."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
    columns = [_matches(F.col("t"), k).alias(k) for k in PATTERNS]
    rows = stored(read.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("t").alias("key"), *columns), "pii-matches")
    shape = "array<struct<kind: string, i: int, gap: int, match: string, left: string>>"

    def left(kind: str, m: Column, i: Column) -> Column:
        # each earlier match has a character at least, so no more of them can reach into the context
        before = F.transform(F.sequence(F.greatest(i - CONTEXT_CHARS, F.lit(0)), i - 1), lambda j: F.concat(F.get(F.col(kind), j)["left"], F.get(F.col(kind), j)["match"]))
        whole = F.concat(F.array_join(before, ""), m["left"])
        return F.when((m["gap"] >= CONTEXT_CHARS) | (i == 0), m["left"]).otherwise(F.substring(whole, -CONTEXT_CHARS, CONTEXT_CHARS))

    def listed(kind: str) -> Column:
        return F.transform(F.col(kind), lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), m["gap"].alias("gap"), m["match"].alias("match"), left(kind, m, i).alias("left"))).cast(shape)

    each = F.concat(*map(listed, PATTERNS))
    flat = rows.select("row", F.explode(each).alias("m")).select("row", "m.*").where("match is not null")
    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(order)
    spans = (flat.withColumn("end", end).where(_valid(F.col("kind"), F.col("match")))
             .select("row", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match", "left"))
    return rows.select("row", "doc_id", "key"), stored(spans, "pii-spans")


def contexts(left: Column) -> Column:
    """The patterns that a text left of an instance is: its last word, its last two words."""
    words = F.filter(F.split(F.regexp_replace(F.lower(left), "[0-9]", "0"), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    n = F.size(words)
    return (F.when(n >= 2, F.array(F.element_at(words, -1), F.concat_ws(" ", F.element_at(words, -2), F.element_at(words, -1))))
            .when(n == 1, F.array(F.element_at(words, -1))).otherwise(F.array().cast("array<string>")))


def graph(spans: DataFrame) -> DataFrame:
    """Occurrences of instances: row, start, end, instance, patterns, seed. Base spans are the
    seeds; the others are identifier-like strings that no base span touches."""
    base = F.col("kind").isin(KINDS)
    order = Window.partitionBy("row").orderBy("start", ~base)
    back = Window.partitionBy("row").orderBy(F.desc("start"), ~base)
    placed = spans.select(
        "*", F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("before"),
        F.min(F.when(base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("after"))
    touched = F.coalesce(F.col("before") > F.col("start"), F.lit(False)) | F.coalesce(F.col("after") < F.col("end"), F.lit(False))
    longest = F.max(F.when(~base, F.col("end"))).over(Window.partitionBy("row", "start"))
    kept = placed.where(base | ~touched).withColumn("longest", longest).where(base | (F.col("end") == F.col("longest")))
    return kept.select("row", "start", "end", F.lower("match").alias("instance"), contexts(F.col("left")).alias("patterns"), base.alias("seed"))


def score_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Trust of patterns (pattern, trust) and of unknown instances (instance, belief)."""
    edges = stored(found.select("instance", "seed", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-graph")
    belief = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("belief"))
    for _ in range(rounds):
        known = edges.join(belief, "instance")
        trust = known.groupBy("pattern").agg(F.sum("belief").alias("mass"), F.count("*").alias("n"))
        trust = stored(trust.where(F.col("mass") >= support).select("pattern", (F.col("mass") / (F.col("n") + 1)).alias("trust")), "pii-patterns")
        doubt = F.sum(F.log1p(-F.coalesce("trust", F.lit(0.0))))
        belief = stored(edges.join(trust, "pattern", "left").groupBy("instance")
                        .agg(F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(doubt)).alias("belief")), "pii-instances")
    return trust, belief


def find(docs: DataFrame, trust: float = TRUST, rounds: int = ROUNDS, support: int = SUPPORT) -> DataFrame:
    """doc_id, key (hash of the text) and spans (array of kind, start, end, in order) of every row."""
    rows, spans = occurrences(docs)
    found = stored(graph(spans), "pii-occurrences")
    patterns, instances = score_patterns(found, rounds, support)
    added = (found.where("not seed").select("row", "start", "end", "instance", F.explode("patterns").alias("pattern"))
             .join(patterns.where(F.col("trust") >= trust), "pattern").join(instances.where(F.col("belief") >= trust), "instance")
             .select("row", F.lit(FOUND).alias("kind"), "start", "end").distinct())
    every = spans.where(F.col("kind").isin(KINDS)).select("row", "kind", "start", "end").unionByName(added)
    place = F.array_position(F.array(*[F.lit(k) for k in [*KINDS, FOUND]]), F.col("kind"))
    by_row = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), place.alias("place"), "kind", F.col("end").cast("long").alias("end")))).alias("s"))
    return (rows.join(by_row, "row", "left")
            .select("doc_id", "key", F.transform(F.coalesce("s", F.array().cast("array<struct<start: bigint, place: bigint, kind: string, end: bigint>>")), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans")))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, x: Column) -> Column:
        gap = text.substr((state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        return F.when(x["start"] < state["at"], F.struct(state["parts"].alias("parts"), F.greatest(state["at"], x["end"]).alias("at"))).otherwise(
            F.struct(F.concat(state["parts"], F.array(gap, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))).alias("parts"), x["end"].alias("at")))

    done = F.aggregate(spans, start, step, lambda s: F.struct(F.array_join(s["parts"], "").alias("head"), s["at"].alias("at")))
    return F.when(F.size(spans) > 0, F.concat(done["head"], text.substr((done["at"] + 1).cast("int"), F.length(text)))).otherwise(text)


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the column ``__llm_masked``, the text without personal data."""
    found = find(docs.select("doc_id", "text"), **options)
    some = found.where(F.size("spans") > 0).dropDuplicates(["doc_id", "key"]).select(F.col("doc_id").alias(f"{OWN}id"), F.col("key").alias(f"{OWN}key"), F.col("spans").alias(f"{OWN}spans"))
    joined = docs.join(some, docs["doc_id"].cast("long").eqNullSafe(some[f"{OWN}id"]) & (F.xxhash64(text_or_empty()) == some[f"{OWN}key"]), "left")
    empty = F.array().cast("array<struct<kind: string, start: bigint, end: bigint>>")
    return joined.withColumn(f"{OWN}masked", masked(text_or_empty(), F.coalesce(f"{OWN}spans", empty))).drop(f"{OWN}id", f"{OWN}key", f"{OWN}spans")


def contract(docs: DataFrame) -> DataFrame:
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"] != FOUND)
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [number(k) for k in KINDS]
    return find(docs.select("doc_id", "text")).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
