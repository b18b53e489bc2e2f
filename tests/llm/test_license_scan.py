import random
import re

import numpy as np

from strata.llm import license_scan as scan
from strata.llm.common import ship_code

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(text, containment=scan.CONTAINMENT):
    """Every window against every template, without MinHash."""
    doc, found = words(text), []
    for i, (_, notice) in enumerate(scan.NOTICES):
        own = words(notice)
        size = min(scan.SHINGLE, len(own))
        template = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)}
        grams = [tuple(doc[j : j + size]) for j in range(len(doc) - size + 1)]
        m = scan.scale_of(len(template))
        share = max((len(template & set(grams[at : at + 2 * m])) / len(template) for at in range(0, max(1, len(grams)), m)), default=0)
        if share >= containment:
            found.append((i, share))
    return found


def test_bands_reach_their_probability():
    s = scan.least_similarity()
    b = scan.bands_for(s)
    assert (1 - s) ** b <= scan.MISS < (1 - s) ** (b - 1)
    assert scan.bands_for(0.8, rows=3) < scan.bands_for(0.8, rows=6)


def test_signature_agreement_estimates_similarity():
    index = scan.Index(scan.NOTICES)
    index.seeds = np.random.default_rng(1).integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    pool = np.random.default_rng(2).integers(0, 1 << 63, 150, dtype=np.uint64)
    agree = (index.signature(pool[:100]) == index.signature(pool[50:])).mean()
    assert abs(agree - 1 / 3) < 0.04


def test_against_brute_force(spark):
    ship_code(spark)
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(50)] + ["license", "under", "the", "is", "work"]
    texts = []
    for i in range(150):
        body = [rng.choice(filler) for _ in range(rng.randint(0, 80))]
        notice = words(rng.choice(scan.NOTICES)[1])
        for _ in range(rng.randint(0, max(1, len(notice) // 12))):
            notice[rng.randrange(len(notice))] = "changed"
        at = rng.randint(0, len(body))
        texts.append(" ".join(body[:at] + notice[rng.randint(0, 2) :] + body[at:]))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "..."), (None, scan.NOTICES[0][1].upper()), (3, texts[3]), (903, "All rights reserved. " * 3000), (904, "All rights")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, licenses string").repartition(3)
    got = sorted(((r["doc_id"], r["n_licenses"], r["licenses"], [(m["template"], m["containment"]) for m in r["matches"]]) for r in scan.scan_licenses(docs).collect()), key=str)
    want = []
    for doc_id, text in rows:
        found = brute(text)
        names = sorted({scan.NOTICES[i][0] for i, _ in found})
        want.append((doc_id, len(names), ",".join(names), found))
    assert got == sorted(want, key=str)
    assert scan.scan_licenses(docs.limit(0)).collect() == []


def test_spans_hold_the_notice(spark):
    ship_code(spark)
    docs = spark.createDataFrame([(1, "Some text. Released under the MIT License. More text follows here.")], "doc_id long, text string")
    (match,) = scan.scan_licenses(docs).first()["matches"]
    assert (match["license"], match["start"], match["stop"]) == ("MIT", 2, 7)
