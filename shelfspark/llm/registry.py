"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    merkle,
    mixing,
    near_dedup,
    pivot_search,
    quality_model,
    secret_scan,
    ship,
    spelling,
    token_counts,
    token_files,
    warc,
)
from shelfspark.session import scratch_path, settle

#: Weights of the mixture; sources that are not named share weight OTHER_SOURCES.
TARGETS = {
    **{"src0": 6},
    **{f"src{i}": 4 for i in range(1, 5)},
    **{f"src{i}": 3 for i in range(5, 10)},
    **{f"src{i}": 2 for i in range(10, 20)},
}
OTHER_SOURCES = 1
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every document in a mixture of sources by weight."""
    return mixing.positions(table(spark, folder, "documents"), TARGETS, OTHER_SOURCES)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: counts of the base kinds, digest of their spans, all spans."""
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    spans = F.arrays_zip("kinds", "starts", "ends")
    base = F.filter(spans, lambda s: s["kinds"].isin(*secret_scan.BASE))

    def written(of: Column) -> Column:
        line = F.transform(of, lambda s: F.concat_ws(":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string")))
        return F.concat_ws(",", line)

    def number(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(number(k) for k in secret_scan.BASE), F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans")
    )


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(table(spark, folder, "documents"), PIECES)


def op4_pivot_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best inner products for every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return pivot_search.top_products(vectors, F.col("vec_id") % 100 == 0)


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return byte_bpe.round_trip(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written to grammar-compressed files and read back."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), TOKENIZER, public_tokenizers.PATTERN, path, END_ID)
    found = token_files.read_tokens(spark, path)
    return found.withColumnsRenamed({"key": "doc_id", "crc32": "ids_crc32"})


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are copies of which."""
    found = exact_dedup.copies(table(spark, folder, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def op8_warc_revisit(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives, copies as revisit records, and read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    records = settle(warc.read_archives(spark, path, payloads=False), "records")
    return warc.resolved(records).select(
        F.col("page").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near-copies of every document."""
    found = near_dedup.classes(table(spark, folder, "documents"))
    return found.select(F.col("key").alias("doc_id"), "class_id", "class_size", F.col("first").alias("kept"))


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> quality_model.Model:
    return quality_model.fit(docs, quality_model.grades(table(spark, folder, "labels")))


def op10_quality_grade(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade of every document and whether it is accepted: more likely than not of quality and not toxic."""
    docs = table(spark, folder, "documents")
    found = quality_model.grade_documents(docs, quality(spark, docs, folder))
    return found.select(F.col("key").alias("doc_id"), "expected_grade", "tail_probability", "kept")


def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand inside a window of a benchmark item, and the items found."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, proof and verification of every document, half of them without their line ends."""
    text = F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.coalesce(text, "text"))
    claimed = merkle.leaf_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text)
    found = merkle.manifest(table(spark, folder, "documents"), claimed=claimed)
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent long word with its more usual form."""
    return spelling.spelling_variants(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pfair_mix,
        op2_secret_scan,
        op3_token_counts,
        op4_pivot_topk,
        op5_byte_bpe,
        op6_token_files,
        op7_exact_dedup,
        op8_warc_revisit,
        op9_near_dedup,
        op10_quality_grade,
        op11_decontaminate,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}

_BASE32 = " || ".join(
    f"substr('{warc.BASE32}', ((('0x' || substr(h, {5 * k + 1}, 5))::int >> {s}) & 31) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0)
)
_NORMAL = "coalesce(text, '')"
for _c in (32, 9, 10, 11, 12, 13):
    _NORMAL = f"replace({_NORMAL}, chr({_c}), '')"
_GROUPS = ", ".join(f"('{s}', {i}, {u})" for i, (s, u) in enumerate(TARGETS.items()))

_CAPITALS, _SMALLS = string.ascii_uppercase, string.ascii_lowercase
_SMALL = f"translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALLS}')"
_WORDS = f"regexp_extract_all({_SMALL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_CRC_TABLE = """crc AS (
 SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS crc_table)"""


def _crc(text: str) -> str:
    """CRC-32 of a text's bytes, by the table ``crc_table``."""
    octets = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)"
    return f"xor(list_reduce([4294967295] || {octets}, lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::varchar) || ':' || {value} END"


_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE = {
    "op1_pfair_mix": f"""
WITH RECURSIVE target(name, grp, unit) AS (VALUES {_GROUPS}),
unit AS (SELECT grp, unit FROM target UNION ALL SELECT {len(TARGETS)}, {OTHER_SOURCES}),
rows AS (
 SELECT doc_id, source, coalesce(grp, {len(TARGETS)}) AS grp, length(coalesce(text, '')) AS chars, md5(coalesce(doc_id::varchar, '')) AS digest
 FROM documents LEFT JOIN target ON source = name),
begun AS (
 SELECT *, ('0x' || substr(digest, 1, 4))::int % {mixing.PARTS} AS part FROM rows),
placed AS (
 SELECT doc_id, source, grp, coalesce(sum(chars) OVER (
  PARTITION BY grp ORDER BY part, digest, doc_id, chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start FROM begun),
total AS (SELECT grp, greatest(1, ceil(sum(chars) / {mixing.BLOCK}.0))::bigint AS blocks FROM rows GROUP BY grp),
own AS (SELECT grp, unit, blocks // unit AS whole, blocks % unit AS rest, blocks FROM total JOIN unit USING (grp)),
edge AS (SELECT 0::bigint AS since UNION SELECT whole FROM own UNION SELECT whole + (rest > 0)::int FROM own),
kind AS (SELECT since, lead(since) OVER (ORDER BY since) AS until FROM edge),
part AS (
 SELECT since, until, grp, CASE WHEN since < whole THEN unit WHEN since = whole THEN rest ELSE 0 END AS c
 FROM kind JOIN own ON until IS NOT NULL),
sized AS (SELECT since, until, sum(c)::bigint AS n FROM part GROUP BY ALL),
based AS (SELECT *, coalesce(sum(n * (until - since)) OVER (ORDER BY since ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM sized),
job AS (
 SELECT since, grp, c, n, i AS nth, (i * n) // c AS released, ((i + 1) * n + c - 1) // c AS due
 FROM part JOIN sized USING (since, until), LATERAL (SELECT unnest(range(c::bigint)) AS i) WHERE c > 0),
run(since, t, grp, nth, done) AS (
 SELECT since, -1::bigint, NULL::int, NULL::bigint, []::varchar[] FROM sized
 UNION ALL
 SELECT since, t + 1, grp, nth, list_append(done, grp || '/' || nth) FROM (
  SELECT r.since, r.t, j.grp, j.nth, r.done,
   row_number() OVER (PARTITION BY r.since ORDER BY j.due, j.grp) AS best
  FROM run r JOIN job j ON j.since = r.since
  WHERE j.released <= r.t + 1 AND NOT list_contains(r.done, j.grp || '/' || j.nth))
 WHERE best = 1),
blocked AS (SELECT p.*, least(start // {mixing.BLOCK}, blocks - 1) AS block, unit FROM placed p JOIN own USING (grp))
SELECT doc_id, source, block::bigint AS block, (base + (block // unit - b.since) * n + t)::bigint AS slot, start
FROM blocked k JOIN run r ON r.grp = k.grp AND r.nth = k.block % k.unit
JOIN based b ON b.since = r.since AND k.block // k.unit >= b.since AND k.block // k.unit < b.until""",
    "op4_pivot_topk": """
WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
 SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint AS score
 FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::int AS rank, vec_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    "op7_exact_dedup": f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, {_NORMAL} AS content FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
 row_number() OVER best = 1 AS kept, sha256(content) AS text_sha256
FROM d WINDOW best AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST)""",
    "op8_warc_revisit": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, strlen(payload)::bigint AS payload_bytes, {_BASE32} AS payload_digest,
 CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f""",
    "op11_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::varchar AS item, {_WORDS} AS w FROM benchmark),
win AS (
 SELECT DISTINCT item, array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') AS content, least(len(w), {decontaminate.WINDOW}) AS size
 FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {decontaminate.WINDOW - 1}) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT size FROM win),
place AS (SELECT row, size, unnest(range(1, len(w) - size + 2)) AS spot, w FROM d, size WHERE len(w) >= size),
met AS (SELECT row, spot, s.size, item FROM place s JOIN win ON win.size = s.size AND win.content = array_to_string(w[spot:spot + s.size - 1], ' ')),
hit AS (SELECT row, count(DISTINCT k) AS n FROM (SELECT row, unnest(range(spot, spot + size)) AS k FROM met) GROUP BY row),
named AS (SELECT row, list_sort(list(DISTINCT item)) AS items FROM met GROUP BY row)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n, 0)::bigint AS n_hit, coalesce(len(items), 0)::bigint AS n_items,
 sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN named USING (row)""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
 SELECT *, {_crc("coalesce(doc_id::varchar, '')")} % 2 = 0 AS bad, CASE WHEN {_crc("coalesce(doc_id::varchar, '')")} % 2 = 0
  THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents, crc),
l AS (
 SELECT doc_id, source, sha256({_FIELDS} || {_field("text")}) AS leaf, sha256({_FIELDS} || {_field("changed")}) AS claimed FROM d),
r AS (
 SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
  dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM l),
node(level, grp, place, digest) AS (
 SELECT 0, grp, place, leaf FROM r
 UNION ALL
 SELECT level + 1, grp, place // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM (
  SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM node) WHERE n > 1 GROUP BY level, grp, place // 3),
sub AS (SELECT grp, level AS depth, digest AS subroot FROM (SELECT *, max(level) OVER (PARTITION BY grp) AS top FROM node) WHERE level = top),
high(level, place, digest) AS (
 SELECT 0, grp, subroot FROM sub
 UNION ALL
 SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM (
  SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY level, place // 3),
root AS (SELECT level AS height, digest AS root FROM high ORDER BY level DESC LIMIT 1),
way AS (
 SELECT r.grp, r.place AS leaf_place, level AS step, n.place < r.place // (3 ** level)::bigint AS before, n.place, digest
 FROM r JOIN sub USING (grp), LATERAL (SELECT unnest(range(depth)) AS lv) x
 JOIN node n ON n.grp = r.grp AND n.level = lv AND n.place // 3 = r.place // (3 ** (lv + 1))::bigint AND n.place <> r.place // (3 ** lv)::bigint
 UNION ALL
 SELECT r.grp, r.place, depth + level, h.place < r.grp // (3 ** level)::bigint, h.place, digest
 FROM r JOIN sub USING (grp), root, LATERAL (SELECT unnest(range(height)) AS lv) x
 JOIN high h ON h.level = lv AND h.place // 3 = r.grp // (3 ** (lv + 1))::bigint AND h.place <> r.grp // (3 ** lv)::bigint),
beside AS (
 SELECT grp, leaf_place AS place, step, coalesce(string_agg(digest, '' ORDER BY place) FILTER (before), '') AS l,
  coalesce(string_agg(digest, '' ORDER BY place) FILTER (NOT before), '') AS r FROM way GROUP BY ALL),
proof AS (SELECT grp, place, string_agg(l || r, '' ORDER BY step) AS proof FROM beside GROUP BY ALL),
fold(step, grp, place, digest) AS (
 SELECT 0::bigint, grp, place, claimed FROM r
 UNION ALL
 SELECT f.step + 1, f.grp, f.place, sha256(coalesce(l, '') || digest || coalesce(r, ''))
 FROM fold f JOIN sub USING (grp) CROSS JOIN root LEFT JOIN beside b ON b.grp = f.grp AND b.place = f.place AND b.step = f.step
 WHERE f.step < depth + height)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.digest AS folded_root, f.digest = root AS verified
FROM r JOIN sub USING (grp) CROSS JOIN root LEFT JOIN proof USING (grp, place)
JOIN fold f ON f.grp = r.grp AND f.place = r.place AND f.step = depth + height""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
run AS (SELECT doc_id, unnest(regexp_extract_all({_SMALL}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
long AS (SELECT coalesce(doc_id::varchar, '') || ':' || run AS keyed, run FROM run WHERE length(run) >= {spelling.LEAST_CHARS}),
marked AS (SELECT run, {_crc("keyed")} AS h FROM long, crc),
word AS (
 SELECT CASE WHEN h % {spelling.SPOILED} = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word FROM marked),
v AS (SELECT word, count(*) AS n FROM word WHERE length(word) >= {spelling.LEAST_CHARS} GROUP BY word HAVING count(*) >= {spelling.LEAST_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
 SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
 UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
 UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (
 SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word, n),
form AS (SELECT word, n_near, CASE WHEN form_n >= {spelling.RATIO} * n THEN form END AS form, CASE WHEN form_n >= {spelling.RATIO} * n THEN form_n END AS form_n FROM best),
way(word, root, step) AS (
 SELECT word, word, 0 FROM v
 UNION ALL
 SELECT w.word, f.form, step + 1 FROM way w JOIN form f ON f.word = w.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, coalesce(n_near, 0)::bigint AS n_near, form_n
FROM v LEFT JOIN form USING (word) JOIN (SELECT word, arg_max(root, step) AS root FROM way GROUP BY word) USING (word)""",
}
