"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.llm import bytes_dedup, decontamination, fingerprints, hmm, langid, lines, near_simhash, packing, pii, ranked_search, spelling, substring, token_files
from stridecast.scratch import new_folder, written

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@_query()
def op1_simhash_golay(spark, sf_dir):
    found = near_simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: A window goes if its words also start at a smaller (doc_id, place); its words are then gone.
_OP2 = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS place FROM w
), windows AS (
  SELECT doc_id, place, array_to_string(words[place:place + 19], ' ') AS body FROM starts JOIN w USING (doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS i FROM (
    SELECT doc_id, place, row_number() OVER (PARTITION BY body ORDER BY doc_id, place) AS nth FROM windows
  ) WHERE nth > 1
), each AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@_query(_OP2)
def op2_substring_dedup(spark, sf_dir):
    found = substring.without_repeats(documents(spark, sf_dir))
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


@_query()
def op3_pii(spark, sf_dir):
    return pii.digest(pii.with_pii(documents(spark, sf_dir)))


@_query()
def op4_token_files(spark, sf_dir):
    folder = new_folder(spark, "tokens")
    token_files.write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.with_crc(token_files.read_token_files(spark, folder))


@_query()
def op5_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.benchmark_matches(documents(spark, sf_dir), benchmark)


@_query()
def op6_packing(spark, sf_dir):
    return packing.with_crc(packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


#: Bytes as pairs of hexadecimal digits, so that SQL can cut strings of them.
_OP7 = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), strings AS (
  SELECT doc_id, place, md5(substr(x, 2 * place + 1, 400)) AS body
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 199)) AS place FROM d)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 200)) AS i FROM (
    SELECT doc_id, place, count(*) OVER (PARTITION BY body) AS times FROM strings
  ) WHERE times > 1
), each AS (
  SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS i FROM d
), kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * i + 1, 2), '' ORDER BY i) AS body FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), spans AS (
  SELECT doc_id, count(*) AS n FROM gone AS g
  WHERE NOT EXISTS (SELECT 1 FROM gone AS p WHERE p.doc_id = g.doc_id AND p.i = g.i - 1) GROUP BY doc_id
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes,
       CAST((length(x) - length(coalesce(body, ''))) // 2 AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(body, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""


@_query(_OP7)
def op7_suffix_dedup(spark, sf_dir):
    found = bytes_dedup.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query()
def op8_hidden_markov(spark, sf_dir):
    found = hmm.score_texts(documents(spark, sf_dir), id_remainder(5) != 1)
    return found.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query()
def op9_fingerprints(spark, sf_dir):
    found = written(fingerprints.with_edits(documents(spark, sf_dir)), "fingerprint-rows")
    found = fingerprints.with_near(found, F.col("doc_id") % 50 == 0)

    def shown(name):
        return F.lower(F.lpad(F.hex(name), 16, "0"))

    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown("fp").alias("fingerprint"),
        shown("edited_fp").alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )


@_query()
def op10_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held_out = id_remainder(4) == 2
    model = langid.train(docs, learn=~held_out)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


#: Every row is a document of its own; ids are made whole by a number so that repeated ones count.
_OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), each AS (
  SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each
), common AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT rid) >= 3
), marked AS (
  SELECT rid, i, line, common.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM holder AS gone FROM keyed LEFT JOIN common USING (k)
), result AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY rid
)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM result JOIN d USING (rid)
"""


@_query(_OP11)
def op11_line_dedup(spark, sf_dir):
    found = lines.without_common_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The crc32 in SQL: a table of 256 remainders, folded over the bytes. Near words share what is left without one place.
_OP12 = """
WITH RECURSIVE crcs AS (
  SELECT list_transform(range(256), lambda v: list_reduce(list_prepend(v, [1, 2, 3, 4, 5, 6, 7, 8]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
  ) GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END)) AS b FROM runs
), marked AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crcs
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM marked
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS part FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM less AS a JOIN less AS b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.part = b.word
  UNION SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.part = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), ways AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT ways.word, formed.form FROM ways JOIN formed ON formed.word = ways.root WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, ways.root, f.n, f.n_near, f.form_n
FROM formed AS f JOIN ways USING (word) JOIN formed AS last ON last.word = ways.root WHERE last.form IS NULL
"""


@_query(_OP12)
def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


#: Every row is a document and every (item_id, text) an item of its own.
_OP13 = """
WITH t AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, * FROM documents)
), tfs AS (
  SELECT rid, doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), sizes AS (
  SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY rid
), totals AS (
  SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_l FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals
), items AS (
  SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT DISTINCT item, item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM items
), scores AS (
  SELECT item, item_id, rid, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_n) // all_l))))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (rid), totals GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM scores WHERE score > 0
) WHERE rank <= 50
"""


@_query(_OP13)
def op13_ranked_search(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked_search.search(documents(spark, sf_dir), benchmark)
