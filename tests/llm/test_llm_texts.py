"""Text operators against literal Python versions."""

import collections
import math
import random
import re
import unicodedata
import zlib

import pytest
from odd_rows import docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from tillsight.llm import components, contamination, kneser_ney, language, near_duplicates, private_data, toxicity

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


# Language model

START, END = ("start",), ("end",)  # no words


def literal_model(train):
    pairs, words, texts = collections.Counter(), collections.Counter(), 0
    for text in train:
        w = [*blank_words(text), END]
        pairs.update(zip([START, *w], w))
        words.update(w)
        texts += 1
    left = collections.Counter(b for _, b in pairs)

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        return kneser_ney.Level.of([*n, 0, 0, 0]).discounts

    high, low = discounts(list(pairs.values())), discounts(list(left.values()))
    follow, total = collections.defaultdict(list), collections.Counter()
    for (a, _), n in pairs.items():
        follow[a].append(n)
        total[a] += n
    mass = sum(low[min(x, 3)] for x in left.values()) / sum(left.values())

    def p(a, b):
        one = (left[b] - low[min(left[b], 3)]) / sum(left.values()) + mass / (len(words) + 1)
        if not total[a]:
            return one
        n = pairs[(a, b)]
        return (n - high[min(n, 3)]) / total[a] + sum(high[min(x, 3)] for x in follow[a]) / total[a] * one

    return p, words


def test_kneser_ney(docs, rows, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HOLD", 2000)
    train = [(d, t) for d, t in rows if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1]
    p, words = literal_model(t for _, t in train)
    model = kneser_ney.train(docs.filter(language.rest("doc_id", 5) != 1))
    got = kneser_ney.score(docs, model).collect()
    n, v = sum(words.values()), len(words)
    want = []
    for doc, text in rows:
        w = [*blank_words(text), END]
        base = sum(math.log10((words[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want.append((str(doc), len(w), sum(x in words for x in w), n, base, sum(math.log10(p(a, b)) for a, b in zip([START, *w], w))))
    got = sorted((str(r[0]), *r[1:6]) for r in got)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)
    for before in ("the", START, "never seen"):
        assert sum(p(before, x) for x in words) + p(before, "?unknown") == pytest.approx(1)


def test_kneser_ney_without_training(docs, empty):
    got = kneser_ney.score(docs, kneser_ney.train(empty)).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in got)
    assert kneser_ney.score(empty, kneser_ney.train(docs)).count() == 0


# Language


def test_code_lengths_follow_the_definition(spark):
    train = {"aa": ["abcabcabd", "bcd"], "bb": ["zzzabz", "abab"]}
    rows = spark.createDataFrame([(i, t, k) for k, ts in train.items() for i, t in enumerate(ts)], "key int, text string, lang string")
    trees = language.train(rows)
    counts = {k: collections.Counter() for k in train}
    for k, ts in train.items():
        for t in ts:
            padded = "\n" * language.CONTEXT + t
            for i in range(language.CONTEXT, len(padded)):
                for order in range(language.CONTEXT + 1):
                    counts[k][padded[i - order : i + 1]] += 1

    def bits(k, context, byte):
        if context is None:
            return 8.0
        followers = {g[-1]: n for g, n in counts[k].items() if len(g) == len(context) + 1 and g[:-1] == context}
        shorter = context[1:] if context else None
        if not followers:
            return bits(k, shorter, byte)
        total = sum(followers.values()) + len(followers)
        if byte in followers:
            return -math.log2(followers[byte] / total)
        return -math.log2(len(followers) / total) + bits(k, shorter, byte)

    for text in ["abc", "zab", "qqq", "abcabz", "b"]:
        padded = "\n" * language.CONTEXT + text
        want = [sum(bits(k, padded[i - language.CONTEXT : i], padded[i]) for i in range(language.CONTEXT, len(padded))) for k in ("aa", "bb")]
        assert language.code_lengths(trees, [text.encode()])[0].tolist() == pytest.approx(want)


def test_long_texts_are_scored_whole(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "abcabc", "x"), (2, "xyzxyz", "y")], "key int, text string, lang string")
    trees = language.train(rows)
    text = b"abcxyzab" * 50
    whole = language.code_lengths(trees, [text])
    monkeypatch.setattr(language, "STEP", 37)
    got = language.code_lengths(trees, [text, b"", text])
    assert got[0] == pytest.approx(whole[0]) and got[2] == pytest.approx(whole[0]) and not got[1].any()


def test_language_of_odd_rows(docs, rows, empty):
    trees = language.train(docs.select(F.col("doc_id").alias("key"), "text", "lang"))
    got = language.predict(docs, trees).collect()
    assert len(got) == len(rows)
    text = collections.defaultdict(set)
    for d, t in rows:
        text[d].add(t)
    for r in got:
        unknown = any(not t or not re.search(r"[^\W\d_]", t) for t in text[r.doc_id])
        assert 0 <= r.score <= 1 and r.lang_pred in (("und", "en", "fr") if unknown else ("en", "fr"))
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 10)} == {"und"}
    assert language.predict(empty, trees).count() == 0
    nothing = language.train(empty.select(F.col("doc_id").alias("key"), "text", "lang"))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_language_accuracy(spark):
    from conftest import MEDIUM
    from tillsight.llm.queries import QUERIES

    got = QUERIES["op8_language"](spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/documents.parquet"), "doc_id")
    held = got.filter("held_out")
    assert held.filter("lang = lang_pred").count() > 0.98 * held.count()


# Toxicity


def test_toxicity_separates_held_out_rows(spark):
    from conftest import MEDIUM
    from tillsight.llm.queries import QUERIES

    got = QUERIES["op4_toxicity"](spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    bad, good = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    assert sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good)) > 0.8
    assert sum(r.predicted for r in got if not r.toxic) <= 0.03 * len(good)


def test_toxicity_with_few_or_no_labels(spark, docs, rows, empty):
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    one = spark.createDataFrame([(20, 1), (21, 1)], "doc_id long, toxic int")
    for labels, want in ((none, 0.0), (one, 1.0)):
        assert {r.score for r in toxicity.train(docs, labels).score(docs).collect()} == {want}
    both = spark.createDataFrame([(i, i % 2) for i in range(13, 50)], "doc_id long, toxic int")
    model = toxicity.train(docs, both)
    assert model.score(docs).count() == len(rows) and model.score(empty).count() == 0
    assert set(model.score(docs).select("row.*").columns) == set(docs.columns) - {"text"}


def test_spellings():
    assert toxicity.spellings('"Clown!!"') == ("clown", "clown")
    assert toxicity.spellings("cl0wn,")[1] == "clown"
    assert toxicity.spellings("c-l-o-w-n")[1] == "clown"
    assert toxicity.spellings("clooooown")[1] == "clown"
    tokens = toxicity.Tokens({"clown": 9.0})
    words = "you c l o w n".split()
    assert toxicity.spaced(words, tokens.flags(words), tokens) == 1


# Personal data

CHECKS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def literal_spans(text):
    out = {}
    for kind, pattern in CHECKS.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}
            if fine[kind]:
                out[kind].append((m.start(), m.end()))
    return out


FRAGMENTS = ["a@b.c", "_d@e.f", "1.2.3.4", "256.1.1.1", ".", "@", "4111 1111 1111 1111", "4111111111111111", "-", "+1 (234) 555-0199", " ", "é", "🙂",
             "x", "12", "+", "(", "001.02.3.4", "\n", "foo@bar", "%", "5.6.7.8", "日", "9" * 40]


def test_fixed_kinds_are_the_plain_patterns(spark):
    rng = random.Random(5)
    found = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [None, "", "1" * 50_000, "a." * 30_000 + "@", "+1" + " " * 30_000]
    rows = list(enumerate(found))
    got = private_data.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = literal_spans(found[r.doc_id])
        assert {k: [tuple(s) for s in r[k]] for k in CHECKS} == want, repr(found[r.doc_id])


def test_reliable_contexts_find_unseen_identifiers(spark):
    seeds = [f"{w} my contact number is +1 (555) 200-{1000 + i} ok" for i, w in enumerate("abcdef")]
    plain = [f"built in the year {1900 + i} they say" for i in range(30)]
    new = ["the contact number is 777-1234.", "contact number is \"QX99-1234\" then"]
    rows = list(enumerate(seeds + plain + new))
    got = {r.doc_id: r for r in private_data.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    values = {d: [text[d][s.start : s.end] for s in r.found] for d, r in got.items() if r.found}
    assert values == {36: ["777-1234"], 37: ["QX99-1234"]}


def test_reliability_follows_the_graph(spark):
    edges = [("p", f"s{i}", True) for i in range(4)] + [("p", "bridge", False)] + [("q", "bridge", False)] + [("q", f"u{i}", False) for i in range(5)]
    got = {r.pattern: r.reliability for r in private_data.reliable_patterns(spark.createDataFrame(edges, "pattern string, value string, seed boolean")).collect()}
    belief = 0.0
    for _ in range(private_data.ROUNDS):
        p = (4 + belief) / 5
        belief = 1 - (1 - min(p, 0.99))
    assert got == {"p": pytest.approx(p)}


def test_private_data_of_odd_rows(docs, rows, empty):
    got = private_data.find_private(docs)
    assert got.count() == len(rows) and private_data.find_private(empty).count() == 0


# Contamination


def item_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))


def literal_contamination(rows, benchmark):
    windows = collections.defaultdict(set)
    for item, text in benchmark:
        w = item_words(text)
        size = min(10, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[s : s + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w, hit, items = item_words(text), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if found := windows.get(tuple(w[s : s + size])):
                    hit.update(range(s, s + size))
                    items |= found
        out.append((str(doc), len(w), len(hit), tuple(sorted(items))))
    return sorted(out)


def benchmark_rows(rows):
    texts = [t for _, t in rows if t and len(t) < 2000]
    found = [(i, " ".join(item_words(t)[3:40])) for i, t in enumerate(texts[8:30])]
    return [*found, (100, None), (101, ""), (102, "one"), (103, "the cat"), (None, "another text under"), (104, "a a a a a a a a a a a a a"), found[0], (found[1][0], "no one sat")]


def test_contamination(spark, docs, rows):
    extra = spark.createDataFrame([(500, "a " * 300), (501, "x the cat the cat y")], "doc_id long, text string")
    table = docs.select("doc_id", "text").union(extra)
    benchmark = benchmark_rows(rows)
    frame = spark.createDataFrame([(*b, 1) for b in benchmark], "item_id long, text string, words int")
    got = contamination.contamination(table, frame).collect()
    want = literal_contamination([tuple(r) for r in table.collect()], benchmark)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    assert sum(x[2] > 0 for x in want) > 10


def test_contamination_without_broadcast(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(contamination, "small", lambda df, *a: df)
    frame = spark.createDataFrame(benchmark_rows(rows), "item_id long, text string")
    got = contamination.contamination(docs, frame).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"])) for r in got) == literal_contamination(rows, benchmark_rows(rows))


def test_contamination_of_nothing(spark, docs, rows, empty):
    frame = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in contamination.contamination(docs, frame).collect()} == {0}
    assert contamination.contamination(empty, frame).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha q beta y"), (2, "alpha beta"), (3, "alpha q q q q q q q beta"), (4, "beta alpha")], "doc_id long, text string")
    item = spark.createDataFrame([(9, "alpha beta")], "item_id long, text string")
    assert {r.doc_id for r in contamination.proximity_matches(docs, item, 2).collect()} == {1, 2, 4}


# Near duplicates


def literal_components(rows):
    sets = []
    for _, text in rows:
        w = blank_words(text)
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    # Rows without words are linked with nothing.
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def got_components(frame):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in frame.collect())


def test_near_duplicates(docs, rows, empty):
    got = near_duplicates.near_duplicates(docs)
    assert got_components(got) == literal_components(rows)
    assert near_duplicates.near_duplicates(empty).count() == 0


def cluster(seed, copies, edits):
    """Copies of one text with a growing number of edits; their links form a chain as well as a star."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_a_large_group_of_near_copies(spark):
    """Pairs on both sides of the threshold in the same buckets: no link may be lost, whatever the pivots are."""
    found = cluster(1, 150, 14) + cluster(2, 60, 9) + cluster(3, 1, 0) * 40 + [f"lone text {i} with some words of its own {i * 7}" for i in range(20)]
    rows = list(enumerate(found))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got_components(near_duplicates.near_duplicates(frame)) == literal_components(rows)


@pytest.mark.parametrize("few", [0, 1000])
def test_cells_are_split(spark, monkeypatch, few):
    monkeypatch.setattr(near_duplicates, "FEW", few)
    monkeypatch.setattr(near_duplicates, "CELL_LEFT", 3)
    monkeypatch.setattr(near_duplicates, "CELL_RIGHT", 5)
    rows = list(enumerate(cluster(4, 80, 15)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got_components(near_duplicates.near_duplicates(frame)) == literal_components(rows)


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200), (101, 102), (102, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_letters_are_those_of_unicode():
    odd = ["½", "²", "①", "Ⅷ", "3_4", "٣", "五", "ª", "é", "ʰ", "\u0301", "𝟘", "🙂", "12 ½ x"]
    for text in [*map(chr, range(0x3000)), *odd]:
        assert language.has_letter(text) == any(unicodedata.category(c).startswith("L") for c in text), text


def test_numerals_without_letters_have_no_language(spark, docs):  # noqa: F811
    trees = language.train(docs.select(F.col("doc_id").cast("string").alias("key"), "text", "lang"))
    frame = spark.createDataFrame([(1, "½"), (2, "²"), (3, "①"), (4, "the ½")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in sorted(language.predict(frame, trees).collect())] == [True, True, True, False]


def test_rows_of_many_blocks_are_not_broadcast(spark):
    """They look as small as the nodes they come from, before they are dealt to blocks."""
    ids = spark.range(30_000).withColumnRenamed("id", "node")
    near = ids.select(F.lit(0).cast("long").alias("group"), "node", F.col("node").alias("component"), F.lit(False).alias("major"))
    sets = ids.withColumn("shingles", F.repeat(F.lit("x"), 600).cast("binary"))
    text = near_duplicates.links_within(near, sets)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [node" in text and "BroadcastHashJoin [node" not in text


def test_frames_of_few_values_are_not_broadcast(spark):
    """Their files are small, their rows many."""
    edges = spark.range(30_000).select(F.col("id").alias("a"), F.lit(-1).cast("long").alias("b"))
    text = components.nearest(edges, 30_000)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
