import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import best_two_fit
from strata.llm.common import ship_code


def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


TEXTS = ["", None, "Hello, world!", "<|endoftext|> is ordinary", "naïve café 漢字 🙂", "a" * 3000, "\x00\t\r\n  spaces   ", "word " * 2500, "word " * 1023, "word " * 1022]


def test_ids_are_the_tokenizers():
    for text in TEXTS:
        want = tokenizer().encode(text or "", add_special_tokens=False).ids
        assert best_two_fit.encoder().encode_ordinary(text or "") == want


def as_loaded():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


END = "<|endoftext|>"
ADDED_TEXTS = [f"a {END} b", END, f"{END}{END}", f"x  {END}  \n y", f"<|endoftext{END}|>", f"don't{END}'s", f"漢 {END}é ", "<|ENDOFTEXT|>", "word " * 1500 + END + " tail" * 900]


def test_added_tokens_are_the_tokenizers():
    encode = best_two_fit.text_encoder(added=True)
    for text in [t or "" for t in TEXTS] + ADDED_TEXTS:
        assert encode(text) == as_loaded().encode(text, add_special_tokens=False).ids


def test_queries_give_added_tokens(spark, scratch):
    from strata.llm import queries

    ship_code(spark)
    texts = ADDED_TEXTS + ["plain text", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(f"{scratch}/documents.parquet")
    want = {i: as_loaded().encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for rows, size in ((queries.op7_best_two_fit(spark, scratch), "length"), (corpus_pipeline.packing(spark, docs, scratch), "length"), (queries.op9_token_output(spark, scratch), "n_tokens")):
        lengths = Counter()
        for r in rows.collect():
            part = np.array(want[r["doc_id"]][r["start"] : r["start"] + r[size]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            lengths[r["doc_id"]] += r[size]
        assert lengths == {i: len(ids) for i, ids in want.items()}


def check(rows, texts, capacity):
    """Every document's ids are there once, in order; sequences are gapless."""
    encode = tokenizer()
    want = Counter()
    for doc_id, text in texts:
        ids = np.array(encode.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [len(ids)] if len(ids) <= capacity else [n for n in [len(ids) % capacity] if n] + [capacity] * (len(ids) // capacity)
        start = 0
        for piece, n in enumerate(cuts):
            want[(doc_id, piece, start, n, zlib.crc32(ids[start : start + n].tobytes()))] += 1
            start += n
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(k[3] * n for k, n in want.items()) // capacity)


def test_pack(spark):
    ship_code(spark)
    rng = random.Random(3)
    texts = list(enumerate(TEXTS)) + [(100 + i, "tok " * int(rng.paretovariate(0.7) * 20 % 1800)) for i in range(300)]
    texts += [(None, "no id"), (2, "Hello, world!"), (500, "same"), (501, "same")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts], "doc_id long, text string, sequence_id int").repartition(5)
    used, least = check(best_two_fit.pack(docs).collect(), texts, 1024)
    assert used <= least + 1


def test_empty_table(spark):
    ship_code(spark)
    assert best_two_fit.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def one_at_a_time(counts, capacity):
    """The same rule without repeating bins in bulk."""
    left, bins = dict(counts), []
    while any(left.values()):
        bins.append(best_two_fit.plan_bins(left, capacity)[0][1])
        for length in bins[-1]:
            left[length] -= 1
    return bins


def test_bulk_plan_equals_single_bins():
    rng = random.Random(5)
    for _ in range(40):
        counts = {rng.randint(1, 64): rng.randint(1, 60) for _ in range(rng.randint(1, 15))}
        bulk = [tuple(b) for times, b in best_two_fit.plan_bins(counts, 64) for _ in range(times)]
        assert sorted(bulk) == sorted(map(tuple, one_at_a_time(counts, 64)))
        assert Counter(n for b in bulk for n in b) == Counter(counts)
        assert all(sum(b) <= 64 for b in bulk)


def test_two_fit_replaces_the_smallest():
    # greedy: 6 + 2 leaves 2; giving 2 back, 2 unpacked documents fill the gap of 4
    assert best_two_fit.best_two([1, 2, 3], {1: 1, 2: 1, 3: 1}, Counter({2: 1}), 4) == [3, 1]
    bins = best_two_fit.plan_bins({6: 1, 3: 2, 1: 1}, 10)
    assert bins[0][1] == [6, 3, 1]


def test_long_runs_of_white_space():
    """The matcher fails on them as a whole; the ids stay the tokenizer's."""
    encode = best_two_fit.text_encoder(added=True)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = 1 << 16
    for text in (" " * n + "x", "a" + "\n" * n + "b c", "a " + " " * n, "x" + "\t \n" * n + "'s", " " * n + "<|endoftext|>", "a　" + "\xa0" * n + "1" + " " * (n - 1) + "b"):
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids
    assert len(encode(" " * 2_000_000 + "x")) == 2_000_000


def test_two_million_blanks(spark):
    ship_code(spark)
    docs = spark.createDataFrame([(1, " " * 2_000_000 + "x"), (2, "\n" * 2_000_000), (3, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in best_two_fit.pack(docs, capacity=1024).groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert got == {1: 2_000_001, 2: 1_000_001, 3: 2}
