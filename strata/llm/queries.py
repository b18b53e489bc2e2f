"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import best_two_fit, decontaminate, exact_dedup, jaccard_join, language_id, lexical_search, license_scan, pii_feistel, quality_cnn, simhash_covering, spelling_groups, suffix_dedup, token_output
from strata.llm.common import read_table, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PSEUDONYM_KEY = "example key; a real run passes its own"
ORDER_KEY, SEQ_LEN, SHARD_ROWS = 20240607, 1024, 8192


def op1_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.train_and_score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), span=10, k=5)


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.pseudonymise_documents(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    profiles = language_id.learn_profiles(docs.filter(~F.coalesce(held_out, F.lit(True))))
    return language_id.identify(docs, profiles, more=(held_out.alias("held_out"),)).select("doc_id", "held_out", "lang_pred", "score")


def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_two_fit.pack(read_table(spark, sf_dir, "documents"), capacity=1024, added=True)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    if not token_output.write_shards(read_table(spark, sf_dir, "documents"), path, ORDER_KEY, SEQ_LEN, SHARD_ROWS, added=True):
        return spark.createDataFrame([], "doc_id long, piece int, start long, slot long, shard long, at int, n_tokens int, ids_crc32 long, intact boolean")
    return token_output.read_index(spark, path, SEQ_LEN, SHARD_ROWS)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


def op12_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_covering.simhash_components(read_table(spark, sf_dir, "documents"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_cnn": op1_quality_cnn,
        "op2_decontaminate": op2_decontaminate,
        "op3_pii_feistel": op3_pii_feistel,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_language_id": op6_language_id,
        "op7_best_two_fit": op7_best_two_fit,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_token_output": op9_token_output,
        "op10_license_scan": op10_license_scan,
        "op11_lexical_search": op11_lexical_search,
        "op12_simhash_covering": op12_simhash_covering,
        "op13_spelling_groups": op13_spelling_groups,
    }


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

NOT_SPACE = r"[^\x20\x09-\x0D]+"

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The letters beyond ASCII, and as many ASCII characters that are no small letters, so
#: that an edit distance over bytes is one over code points.
LETTERS = "".join(map(chr, range(0xC0, 0x100)))
BYTES = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c != "'")[:64]

ORACLE = {
    "op2_decontaminate": f"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents
        ),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM benchmark
        ),
        item_windows AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item_words WHERE len(words) > 0)
        ),
        doc_windows AS (
            SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS win
            FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
                  FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)
        ),
        met AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
        hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM met)) GROUP BY doc_id
        ),
        listed AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
            FROM met GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op5_jaccard_join": f"""
        WITH RECURSIVE doc_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NOT_SPACE}') AS words FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
            FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM doc_words WHERE len(words) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT x, y
            FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
                  FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2)
            JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * common >= 75 * (p.n + q.n - common)
        ),
        reach AS (
            SELECT doc_id, doc_id AS other FROM doc_words
            UNION
            SELECT reach.doc_id, y FROM reach JOIN links ON x = other
        ),
        parts AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM parts LEFT JOIN sizes USING (doc_id)
    """,
    "op11_lexical_search": f"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
        tfs AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        items AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
        ),
        asked AS (SELECT item_id, term, count(*) AS times FROM items GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, whole GROUP BY term, docs
        ),
        scores AS (
            SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), whole
            GROUP BY ALL
        )
        SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
        QUALIFY row_number() OVER best <= 20
    """,
    "op13_spelling_groups": f"""
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS crcs FROM (
                SELECT i, list_reduce([i] || range(8)::BIGINT[], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM (SELECT unnest(range(256)) AS i))
        ),
        runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= 7 GROUP BY ALL
        ),
        hexed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
        hashed AS (
            SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT),
                                           lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
            FROM hexed, crc_table
        ),
        words AS (
            SELECT word, sum(n)::BIGINT AS n
            FROM (SELECT n, CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ),
        cuts AS (
            SELECT word, word AS cut FROM words
            UNION
            SELECT word, substr(word, 1, i) || substr(word, i + 2) FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
        ),
        pairs AS (SELECT DISTINCT a.word AS word, b.word AS other FROM cuts a JOIN cuts b USING (cut) WHERE a.word <> b.word),
        near AS (
            SELECT p.word, p.other, w.n AS other_n FROM pairs p JOIN words w ON w.word = p.other
            WHERE levenshtein(translate(p.word, '{LETTERS}', '{BYTES}'), translate(p.other, '{LETTERS}', '{BYTES}')) = 1
        ),
        best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
        ),
        forms AS (
            SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ),
        paths AS (
            SELECT word, word AS tip FROM forms
            UNION ALL
            SELECT paths.word, form FROM paths JOIN forms ON forms.word = tip WHERE form IS NOT NULL
        ),
        ends AS (SELECT paths.word, tip AS root FROM paths JOIN forms ON forms.word = tip WHERE form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
    "op8_exact_dedup": f"""
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
