import hashlib
import random
import re

from strata.llm import decontaminate
from strata.llm.common import ship_code

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    ship_code(spark)
    d = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n_hit int, key string").repartition(3)
    b = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, id string").repartition(2)
    return sorted((tuple(r) for r in decontaminate.decontaminate(d, b).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "é", "ab1"]  # few words, so grams repeat
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 40])))) for i in range(25)]
    items += [(3, "Repeated, item! " * 6), (3, "Repeated, item! " * 6), (None, "a null id of an item that has more than ten words here"), (77, None), (78, "")]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    for i in range(120, 200):
        text = (items[rng.randrange(len(items))][1] or "").split()
        at = rng.randint(0, max(0, len(text) - 8))
        docs.append((i, " ".join(["x1"] * rng.randint(0, 12) + text[at : at + rng.randint(8, 14)] + ["Y2"] * rng.randint(0, 5)).upper()))
    docs += [(500, None), (501, ""), (502, "-- !!"), (None, docs[130][1]), (130, docs[130][1]), (503, items[-3][1]), (504, "repeated item " * 400)]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(1, "some words"), (2, None)]
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], [(1, "one two")]) == []
