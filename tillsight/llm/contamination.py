"""Benchmark decontamination over a distributed positional inverted index.

Method: the corpus is tokenised once and the postings (term, document, position) of all
terms that a benchmark text uses are stored as a table, with each document's length. Their
frequencies rank the terms. For every window of an item the rarest term's postings
propose a place (position minus offset), which the postings of the second rarest term of
the same window must confirm at its own offset: an intersection of offset-adjusted
lists. Neighbouring windows share a rarest term while they can. Confirmed places are
compared with the document's words, word by word; a place is one row, however long the
item is, and the windows found there are folded inside the row.

Only DataFrame functions are used. Terms are 64-bit hashes in the index; the last
comparison is on words. Tables that follow the benchmark are broadcast only if their counted
rows are within a bound, and shuffled otherwise.

Null texts and texts without words have no postings, no hits and no windows. An item of
fewer words than a window is one window. Rows that repeat a document are answered one by
one; several benchmark rows with one id are one item, a null id is the empty string. An empty
benchmark finds nothing. Columns other than the ids and texts are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.llm.sized import small
from tillsight.session import cut_lineage

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LENGTH = " "  # a term that no text holds; its posting is the number of words


def words(text: Column) -> Column:
    text = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, version, text); the version tells texts under one id apart."""
    return docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("version"), "text")


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, words, size: of a window) of the benchmark rows that have words."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") > 0).distinct()
    return rows.withColumn("size", F.least(F.size("words"), F.lit(WINDOW))).withColumn("text_id", F.xxhash64("item", "words"))


@dataclass
class Index:
    """Postings (doc_id, version, position, term), and items that may be looked for."""

    postings: DataFrame
    items: DataFrame

    def lengths(self) -> DataFrame:
        return self.postings.filter(F.col("term") == F.xxhash64(F.lit(LENGTH))).select("doc_id", "version", F.col("position").alias("n_words"))


def build_index(docs: DataFrame, benchmark: DataFrame) -> Index:
    items = cut_lineage(items_of(benchmark))
    terms = items.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    terms = cut_lineage(terms.union(docs.sparkSession.range(1).select(F.xxhash64(F.lit(LENGTH)).alias("term"))))
    found = keyed(docs).select("doc_id", "version", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(LENGTH)))).alias("position", "word"))
    found = found.select("doc_id", "version", "position", F.xxhash64("word").alias("term"))
    return Index(cut_lineage(found.join(small(terms), "term", "left_semi")), items)


def rarest_pairs(index: Index) -> DataFrame:
    """For each window the offsets and terms of its two rarest words, once for all windows
    that share them: (text_id, first, second, first_term, second_term)."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("n"))
    used = index.items.select("text_id", "size", F.posexplode("words").alias("offset", "word"))
    used = used.withColumn("term", F.xxhash64("word")).join(counts, "term", "left")
    ranked = used.groupBy("text_id", "size").agg(
        F.sort_array(F.collect_list(F.struct("offset", "term", F.coalesce("n", F.lit(0)).alias("n")))).alias("at")
    )
    # Rarity of a place: its term's count, then the rightmost place.
    rarity = F.transform("at", lambda x: F.struct(x["n"].alias("n"), (-x["offset"]).alias("back")))
    ranked = ranked.withColumn("rarity", rarity).withColumn("starts", F.expr("sequence(0, size(at) - size)"))
    # The last first-place stays while it is in the window and no place is rarer.
    firsts = F.expr("""
        aggregate(starts, cast(array() AS array<int>), (acc, s) -> concat(acc, array(
          CASE WHEN size(acc) > 0 AND element_at(acc, -1) >= s
                AND get(rarity, element_at(acc, -1)).n = array_min(slice(rarity, s + 1, size)).n
               THEN element_at(acc, -1) ELSE -array_min(slice(rarity, s + 1, size)).back END)))""")
    pairs = ranked.withColumn("firsts", firsts).withColumn("pair", F.explode(F.expr("""
        transform(starts, s -> named_struct('first', get(firsts, s), 'second',
          coalesce(-array_min(filter(slice(rarity, s + 1, size), r -> r.back <> -get(firsts, s))).back, get(firsts, s))))""")))
    return pairs.select(
        "text_id", "pair.first", "pair.second", F.expr("get(at, pair.first).term").alias("first_term"),
        F.expr("get(at, pair.second).term").alias("second_term"),
    ).distinct()


def places(index: Index, slack: int = 0) -> DataFrame:
    """(doc_id, version, text_id, place): where both rarest terms of a window stand at their
    offsets from the place, or, with slack, at most so many words away from that."""
    pairs = cut_lineage(rarest_pairs(index))
    proposed = index.postings.join(small(pairs), F.col("term") == F.col("first_term"))
    proposed = proposed.select("doc_id", "version", "text_id", (F.col("position") - F.col("first")).alias("place"), "second", "second_term")
    expected = F.col("place") + F.col("second")
    width = slack + 1
    # With slack, positions fall into bins as wide as the slack; near ones are in one of three bins.
    bins = F.sequence(F.floor(expected / width) - 1, F.floor(expected / width) + 1) if slack else F.array(expected.cast("long"))
    proposed = proposed.withColumn("expected", expected).withColumn("bin", F.explode(bins))
    seconds = small(pairs.select(F.col("second_term").alias("term")).distinct())
    confirming = index.postings.join(seconds, "term", "left_semi").select(
        F.col("doc_id").alias("d"), F.col("version").alias("v"), F.col("term").alias("t"), "position", F.floor(F.col("position") / width).alias("b")
    )
    met = proposed.join(
        confirming,
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")) & (F.col("second_term") == F.col("t"))
        & (F.col("bin") == F.col("b")) & (F.abs(F.col("position") - F.col("expected")) <= slack),
    )
    return met.select("doc_id", "version", "text_id", "place").distinct()


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slack: int = 3) -> DataFrame:
    """(doc_id, item, place): documents in which the two rarest terms of a window stand
    within ``slack`` words of their distance in the item, whatever stands between."""
    index = build_index(docs, benchmark)
    found = places(index, slack).join(small(index.items.select("text_id", "item")), "text_id")
    return found.select("doc_id", "item", "place").distinct()


def phrase_matches(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, version, item, starts: document positions of found windows, size)."""
    by_document = places(index).groupBy("doc_id", "version").agg(F.collect_list(F.struct("text_id", "place")).alias("places"))
    by_document = cut_lineage(by_document)
    rows = keyed(docs).join(small(by_document, F.size("places") + 1).withColumnsRenamed({"doc_id": "d", "version": "v"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")))
    rows = rows.select("doc_id", "version", words(F.col("text")).alias("found"), "places")
    rows = rows.select("doc_id", "version", "found", F.explode("places").alias("p")).select("doc_id", "version", "found", "p.text_id", "p.place")
    rows = rows.join(small(index.items, F.size("words") + 1), "text_id")
    same = F.expr("transform(words, (w, i) -> coalesce(get(found, place + i) = w, false))")
    starts = F.expr("""
        transform(filter(sequence(0, size(words) - size), s -> forall(slice(same, s + 1, size), x -> x)), s -> place + s)""")
    rows = rows.withColumn("same", same).withColumn("starts", starts)
    return rows.filter(F.size("starts") > 0).select("doc_id", "version", "item", "starts", "size")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, version, n_words, n_hit, items (sorted ids found in it), spans (start and
    end of each run of hit words)."""
    index = build_index(docs, benchmark)
    found = phrase_matches(docs, index).groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(
            F.transform("starts", lambda s: F.struct(s.alias("start"), (s + F.col("size")).alias("end")))
        )))).alias("windows"),
    )
    # Windows in ascending order, folded into runs that do not touch.
    spans = F.expr("""
        aggregate(windows, cast(array() AS array<struct<start: int, end: int>>), (acc, w) ->
          CASE WHEN size(acc) > 0 AND element_at(acc, -1).end >= w.start
               THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start,
                           'end', greatest(element_at(acc, -1).end, w.end))))
               ELSE concat(acc, array(w)) END)""")
    found = cut_lineage(found.select("doc_id", "version", "items", spans.alias("spans")))
    found = found.withColumnsRenamed({"doc_id": "d", "version": "v"})
    out = index.lengths().join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left")
    hits = F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"), F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    return out.select("doc_id", "version", F.col("n_words").cast("long").alias("n_words"), hits.alias("n_hit"), F.coalesce("items", none).alias("items"), "spans")


def op7_contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT item, least(len(ws), 10) AS k, ws,
              unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS s FROM b WHERE len(ws) > 0),
items AS (SELECT DISTINCT item, k, array_to_string(ws[s : s + k - 1], ' ') AS w FROM iw),
sizes AS (SELECT DISTINCT k FROM items),
dw AS (SELECT r, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS s FROM d, sizes WHERE len(ws) >= k),
hits AS (SELECT dw.r, dw.s, dw.k, item FROM dw JOIN items i ON i.k = dw.k AND i.w = array_to_string(dw.ws[dw.s : dw.s + dw.k - 1], ' ')),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + k - 1)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
