"""Language identification by rank-order profiles.

A profile is the list of the most frequent 1- to 3-grams of letters, word ends
marked by a blank, in order of frequency. A document is compared with every
learned language by the out-of-place distance: for each of its own most
frequent n-grams the difference between its rank there and in the language's
profile, or the full profile length if the language lacks it. The nearest
language wins, ties going to the first by name.

Learning counts n-grams over all training rows (a count per task and language
before the shuffle) and keeps ``profile`` of them for each language, so what
the tasks receive is bounded by the number of languages.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text if nothing was learned. Rows without a language teach
nothing. Repeated rows count and are answered each on its own. A null doc_id
stays null. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, slices

UNDETERMINED = "und"
LETTER_BITS = 11
HELD_GRAMS = 1 << 21  # distinct n-grams a task holds before it passes its counts on


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """A number from 1 for every letter (small and capital alike), else 0.

    The first 1,024 code points keep their own number; later scripts share the
    second half of the range by remainder.
    """
    table = np.zeros(0x110000, np.uint16)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            small = ord(letter.lower()[0])
            table[code] = small if small < 1024 else 1024 + small % 1024
    return table


def letters_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, each text led and followed by one blank (0), and each one's row."""
    raw = data.tobytes()
    try:
        text = raw.decode("utf-8")
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    except UnicodeDecodeError:
        parts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        text, starts = "".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    codes = letter_table()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    letters = np.insert(codes, starts, 0)
    rows = np.repeat(np.arange(len(at)), np.diff(np.concatenate([starts, [len(codes)]])) + 1)
    rows = np.minimum(rows, len(at) - 2)  # the blank behind the last text
    keep = np.ones(len(letters), np.bool_)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    return letters[keep], rows[keep]


def gram_keys(letters: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """owner << 35 | n << 33 | letters, for every 1-, 2- and 3-gram of a word with its blanks.

    A gram belongs to the owner of its first letter that isn't a blank.
    """
    x = letters.astype(np.uint64)
    own = owner.astype(np.uint64) << np.uint64(35)
    bits = np.uint64(LETTER_BITS)
    one = own | np.uint64(1 << 33) | x
    two_code = x[:-1] << bits | x[1:]
    first = np.where(x[:-1] == 0, own[1:], own[:-1]) if len(x) > 1 else own[:0]
    two = first | np.uint64(2 << 33) | two_code
    n = max(0, len(x) - 2)
    three = first[:n] | np.uint64(3 << 33) | two_code[:n] << bits | x[2:]
    return np.concatenate([one[x != 0], two, three[x[1 : n + 1] != 0]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[str, int] = {}
    held_keys, held_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        langs = list(names)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([langs[i] for i in (held_keys >> np.uint64(35)).tolist()], pa.string()),
                pa.array((held_keys & np.uint64((1 << 35) - 1)).view(np.int64)),
                pa.array(held_counts),
            ],
            names=["lang", "gram", "n"],
        )

    for batch, data, at in slices(batches, most=2 << 20):
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        index = np.array([names.setdefault(lang, len(names)) for lang in langs], np.int64)
        letters, rows = letters_of(data, at)
        keys, counts = np.unique(gram_keys(letters, index[rows]), return_counts=True)
        held_keys, back = np.unique(np.concatenate([held_keys, keys]), return_inverse=True)
        held_counts = np.bincount(back, np.concatenate([held_counts, counts]), len(held_keys)).astype(np.int64)
        if len(held_keys) > HELD_GRAMS:
            yield out()
            held_keys, held_counts = held_keys[:0], held_counts[:0]
    if len(held_keys):
        yield out()


def learn_profiles(docs: DataFrame, profile: int = 300) -> dict[str, list[int]]:
    """Each language's n-grams, most frequent first (ties by n-gram)."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")
    counts = rows.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = materialise(counts.withColumn("rank", rank).filter(F.col("rank") <= profile), "profiles")
    profiles: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():  # at most ``profile`` rows a language
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def ranked_grams(data: np.ndarray, at: np.ndarray, profile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram, rank) of each text's ``profile`` most frequent n-grams."""
    letters, rows = letters_of(data, at)
    keys, counts = np.unique(gram_keys(letters, rows), return_counts=True)
    owner = (keys >> np.uint64(35)).astype(np.int64)
    code = keys & np.uint64((1 << 35) - 1)
    # a text without letters has one gram at most, of blanks
    real = code & np.uint64((1 << 33) - 1) != 0
    keys, counts, owner, code = keys[real], counts[real], owner[real], code[real]
    order = np.argsort(owner << 32 | ((1 << 32) - 1 - counts), kind="stable")
    owner, code = owner[order], code[order]
    first = np.searchsorted(owner, owner, "left")
    rank = np.arange(len(owner)) - first
    kept = rank < profile
    return owner[kept], code[kept].view(np.int64), rank[kept]


def identify(docs: DataFrame, profiles: dict[str, list[int]], profile: int = 300, more: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, ``more`` columns, lang_pred and score of every row.

    score is 1 less the mean out-of-place distance as a share of the profile
    length. lang, source and doc_id play no part in it.
    """
    langs = sorted(profiles)
    grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    place = np.full((len(langs), len(grams) + 1), -1, np.int64)
    for i, lang in enumerate(langs):
        place[i, np.searchsorted(grams, profiles[lang])] = np.arange(len(profiles[lang]))
    shared = docs.sparkSession.sparkContext.broadcast((langs, grams, place))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, grams, place = shared.value
        for batch, data, at in slices(batches, most=2 << 20):
            n = batch.num_rows
            names, score = np.full(n, UNDETERMINED, object), np.zeros(n)
            if langs:
                owner, code, rank = ranked_grams(data, at, profile)
                column = np.minimum(np.searchsorted(grams, code), len(grams) - 1)
                column[grams[column] != code] = len(grams)
                distance = np.empty((len(langs), n))
                for i in range(len(langs)):
                    there = place[i, column]
                    apart = np.where(there < 0, profile, np.minimum(np.abs(there - rank), profile))
                    distance[i] = np.bincount(owner, apart, n)
                size = np.bincount(owner, minlength=n)
                best = distance.argmin(0)
                has = size > 0
                names[has] = np.array(langs, object)[best[has]]
                score[has] = 1 - distance[best[has], np.flatnonzero(has)] / (profile * size[has])
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            kept_names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names.tolist(), pa.string()), pa.array(score)], names=[*kept_names, "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(judge, f"{schema}, lang_pred string, score double")
