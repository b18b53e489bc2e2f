import hashlib
import random

import pytest

from strata.llm import exact_dedup
from strata.llm.common import ship_code

SCHEMA = "doc_id long, text string, keep_id string, kept string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def run(spark, rows, parts=3, **options):
    ship_code(spark)
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA).repartition(parts)
    return [tuple(r) for r in exact_dedup.exact_dedup(docs, **options).collect()]


def brute(rows, best):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(FOLD), []).append(doc_id)
    low = lambda i: (i is not None, i or 0)
    return sorted(
        ((i, best(ids, key=low), len(ids), hashlib.sha256(text.encode()).hexdigest()) for text, ids in groups.items() for i in ids), key=str
    )


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_groups(spark, keep, best):
    rng = random.Random(1)
    rows = [(i, rng.choice(["A b", "a B", "É", "é", "", None, "x" * 5000, f"own {i}"])) for i in range(200)]
    rows += [(None, "a b"), (None, "alone"), (7, rows[7][1])]
    got = run(spark, rows, keep=keep)
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == brute(rows, best)
    # exactly one row of each text stays, and it is the one named
    kept = [r for r in got if r[3]]
    assert len(kept) == len({r[4] for r in got}) and all(r[0] == r[1] for r in kept)


def test_many_rounds(spark):
    """More runs than the fan-in, so entries meet in several rounds."""
    rows = [(i, f"text {i % 40}") for i in range(300)]
    got = run(spark, rows, parts=19, fan_in=2, keep="largest")
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == brute(rows, max)


def test_long_runs_are_ended(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUN_ENTRIES", 7)
    rows = [(i, f"t{i % 5}") for i in range(60)]
    got = list(exact_dedup.digest_runs(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect())
    assert sum(len(r["rows"]) for r in got) == 60


def test_empty_table(spark):
    assert run(spark, []) == []


def test_bad_options(spark):
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(None, keep="first")
