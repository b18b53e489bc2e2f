from pyspark.sql import functions as F

from strata.llm import language_id
from strata.llm.common import read_table, ship_code
from strata.llm.queries import op6_language_id


def brute_profile(texts, n):
    counts = {}
    for text in texts:
        word, grams = " ", []
        cleaned = "".join(c.lower() if c.isalpha() else " " for c in text)
        for w in cleaned.split():
            p = f" {w} "
            grams += [c for c in w] + [p[i : i + 2] for i in range(len(p) - 1)] + [p[i : i + 3] for i in range(len(p) - 2)]
        for g in grams:
            counts[g] = counts.get(g, 0) + 1
    code = lambda g: len(g) << 33 | sum((0 if c == " " else ord(c)) << 11 * (len(g) - 1 - i) for i, c in enumerate(g))
    return sorted((code(g) for g in counts), key=lambda c: (-{code(g): n for g, n in counts.items()}[c], c))[:n]


def test_profiles_and_distance(spark):
    ship_code(spark)
    texts = {"a": ["the cat, the hat", "That is the cat"], "b": ["un chat été", "le chapeau"]}
    rows = [(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)] + [(9, "no lang", None), (10, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.learn_profiles(docs, 20)
    assert profiles == {lang: brute_profile(ts, 20) for lang, ts in texts.items()}
    queries = [(1, "the that"), (2, "été été"), (3, None), (4, ""), (5, "123 -- !"), (None, "the hat"), (6, "cat " * 3000), (1, "the that")]
    asked = spark.createDataFrame([(i, t, "x", 1.0) for i, t in queries], "doc_id long, text string, lang_pred string, score double")
    got = sorted((tuple(r) for r in language_id.identify(asked, profiles, 20).collect()), key=str)
    want = []
    for doc_id, text in queries:
        own = brute_profile([text or ""], 20)
        if not own:
            want.append((doc_id, "und", 0.0))
            continue
        distance = {
            lang: sum(min(20, abs(i - p.index(g))) if g in p else 20 for i, g in enumerate(own)) for lang, p in profiles.items()
        }
        best = min(sorted(distance), key=distance.get)
        want.append((doc_id, best, 1 - distance[best] / (20 * len(own))))
    assert got == sorted(want, key=str)


def test_nothing_learned(spark):
    ship_code(spark)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.learn_profiles(empty) == {}
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert [tuple(r) for r in language_id.identify(docs, {}).collect()] == [(1, "und", 0.0)]
    assert language_id.identify(empty, {}).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op6_language_id(spark, sf).join(read_table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[1] > 100 and held[0] > 0.97
    assert {r[0] for r in got.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).select("held_out").distinct().collect()} == {True}
