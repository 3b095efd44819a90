"""Personal data: fixed kinds with offsets, and contextual extraction bootstrapped from them.

Method: four kinds of entities (email, ip, card, phone) are found by pattern and check.
They are the seeds. Every mention of something with digits in it, seed or not, stands in
a lexical pattern: the two words before it, with the start of its own word if that holds
a key such as ``id=``. Patterns and the distinct values they extract form a graph. In each
round Spark scores it both ways: a pattern is as reliable as the share of its values that
are believed, if enough distinct values support it; a value is believed as far as one of
its patterns is reliable (noisy or). After a fixed number of rounds the mentions of
reliable patterns that no fixed kind covers are added as kind ``found``.

Everything is DataFrame functions. Spans are offsets in code points, end exclusive.
Matches come from regexp_extract_all and the text between them from split with the same
pattern, so offsets are running sums of lengths. The patterns are written so that no
position is tried twice inside one run of characters; they match the same spans as the plain
ones. The graph holds counts of (pattern, value), never a list of mentions of one
pattern, so a pattern that a third of all mentions share is a join key that Spark splits.

Null texts are empty and have no spans. Rows that repeat a document each get its spans;
an empty table gives none. Other columns than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.session import cut_lineage

# The kinds, in their order, and patterns equal to the plain ones of the contract.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
FOUND = "found"
# A mention: a phone number, or an unbroken value that holds a digit.
MENTION = r"\+[0-9][\x20().0-9-]+[0-9]|(?<![\p{L}0-9@._%+/-])[\p{L}@._%+/-]*+[0-9][\p{L}0-9@._%+/-]*+"
CONTEXT = 64  # characters before a mention that its pattern may come from
PATTERN = r"\p{L}+|[=:#]"  # words of a pattern, the last two of which count
LEAST_DIGITS, LEAST_SIZE = 3, 4  # of a value that may be found
ROUNDS = 3
SUPPORT = 3.0  # believed distinct values that a pattern needs
RELIABLE = 0.7  # reliability from which a pattern adds spans

SPANS = "array<struct<start: int, end: int>>"
MATCHES = "array<struct<start: int, end: int, value: string, before: string>>"


def with_matches(rows: DataFrame, name: str, pattern: str, guard: str) -> DataFrame:
    """Adds ``name``: (start, end, value, before: the text since the last match) of all matches of ``text``."""
    text, may = F.col("text"), F.regexp_like("text", F.lit(guard))
    rows = rows.withColumn("values", F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    rows = rows.withColumn("gaps", F.when(F.size("values") > 0, F.split(text, pattern, -1)))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["value"])
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), x["before"].alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    pairs = F.zip_with("values", F.slice("gaps", F.lit(1), F.size("values")), lambda v, g: F.struct(v.alias("value"), g.alias("before")))
    none = F.array().cast(MATCHES)
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda acc: acc["found"])
    return rows.withColumn(name, F.when(F.col("gaps").isNotNull(), found).otherwise(none)).drop("values", "gaps")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the check sum."""
    turned = F.split(F.reverse(number), "")

    def step(acc: Column, digit: Column) -> Column:
        value = digit.cast("int") * F.when(acc["twice"], 2).otherwise(1)
        value = F.when(value > 9, value - 9).otherwise(value)
        return F.struct((acc["total"] + value).alias("total"), (~acc["twice"]).alias("twice"))

    start = F.struct(F.lit(0).alias("total"), F.lit(False).alias("twice"))
    return F.aggregate(F.filter(turned, lambda d: d != ""), start, step, lambda acc: acc["total"] % 10 == 0)


def valid(kind: str, value: Column) -> Column:
    size = F.length(digits(value))
    if kind == "ip":
        # Leading zeros do not count.
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.when(size.between(16, 19), luhn(digits(value))).otherwise(False)
    return size.between(8, 15) if kind == "phone" else F.lit(True)


def valid_spans(kind: str) -> Column:
    """(start, end) of the matches that pass their check; failing ones are not tried again."""
    return F.transform(F.filter(kind, lambda m: valid(kind, m["value"])), lambda m: F.struct(m["start"], m["end"]))


def located(docs: DataFrame) -> DataFrame:
    """(doc_id, version, the spans of each fixed kind, mentions: start, end, value, pattern, seed)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("version"), text.alias("text"))
    for kind in KINDS:
        rows = with_matches(rows, kind, PATTERNS[kind], GUARDS[kind])
        rows = rows.withColumn(kind, valid_spans(kind))
    rows = with_matches(rows, "mentions", MENTION, "[0-9]").drop("text").withColumn("base", F.flatten(F.array(*KINDS)))

    def described(m: Column) -> Column:
        lead = F.length(F.regexp_extract(m["value"], r"^[@._%/-]*", 0))
        core = F.regexp_replace(F.substring(m["value"], lead + 1, F.length(m["value"])), r"[@._%+/-]+$", "")
        near = F.regexp_extract_all(F.lower(F.right(m["before"], F.lit(CONTEXT))), F.lit(PATTERN), F.lit(0))
        start = m["start"] + lead
        end = start + F.length(core)
        return F.struct(
            start.alias("start"), end.alias("end"), core.alias("value"),
            F.array_join(F.slice(near, F.greatest(F.size(near) - 1, F.lit(1)), F.lit(2)), " ").alias("pattern"),
            F.exists("base", lambda b: (b["start"] < end) & (start < b["end"])).alias("seed"),
        )

    found = F.transform("mentions", described)
    usable = F.filter(found, lambda m: (m["pattern"] != "") & (F.length(m["value"]) >= LEAST_SIZE) & (F.length(digits(m["value"])) >= LEAST_DIGITS))
    return rows.select("doc_id", "version", *KINDS, usable.alias("mentions"))


def reliable_patterns(mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, reliability) of the patterns that may add spans; from (pattern, value, seed)."""
    edges = mentions.groupBy("pattern", "value").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    # Patterns of few values can never be supported.
    usual = edges.groupBy("pattern").agg(F.count("*").alias("values")).filter(F.col("values") >= SUPPORT)
    edges = cut_lineage(edges.join(usual, "pattern"))
    belief = edges.groupBy("value").agg(F.max("seed").alias("belief"))
    patterns = None
    for _ in range(rounds):
        believed = edges.join(cut_lineage(belief), "value").groupBy("pattern").agg(F.sum("belief").alias("sum"), F.count("*").alias("values"))
        reliability = F.when(F.col("sum") >= SUPPORT, F.col("sum") / F.col("values")).otherwise(0.0)
        patterns = cut_lineage(believed.select("pattern", reliability.alias("reliability")))
        doubt = F.sum(F.log(1 - F.least("reliability", F.lit(0.99))))
        belief = edges.join(patterns, "pattern").groupBy("value").agg(F.greatest(F.max("seed"), 1 - F.exp(doubt)).alias("belief"))
    return patterns.filter(F.col("reliability") >= RELIABLE)


def find_private(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, version, and the spans of each kind, ``found`` included."""
    rows = cut_lineage(located(docs))
    mentions = rows.select("doc_id", "version", F.explode("mentions").alias("m")).select("doc_id", "version", "m.*")
    patterns = reliable_patterns(mentions.select("pattern", "value", "seed"))
    new = mentions.filter(~F.col("seed")).join(patterns, "pattern", "left_semi")
    new = new.groupBy(F.col("doc_id").alias("d"), F.col("version").alias("v")).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias(FOUND)
    )
    new = cut_lineage(new)
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))
    out = rows.drop("mentions").join(new, same, "left").drop("d", "v")
    return out.withColumn(FOUND, F.coalesce(FOUND, F.array().cast(SPANS)))


def listed(*kinds: str) -> Column:
    """kind:start:end of all spans, in the order of kinds and starts, joined by commas."""

    def of(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat(F.lit(kind + ":"), s["start"], F.lit(":"), s["end"]))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def op5_private(spark: SparkSession, folder: str) -> DataFrame:
    found = find_private(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(*KINDS).cast("binary"), 256).alias("base_sha256"), listed(*KINDS, FOUND).alias("spans"),
    )
