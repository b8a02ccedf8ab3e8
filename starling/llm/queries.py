"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import crc_remainder, documents
from .exact import exact_duplicates
from .mixing import mix
from .quality import judge, learn_rules
from .pii import BASE, find_spans, joined, of_kind
from .token_files import read_token_files, token_folder, write_token_files
from .packing import pack_documents
from .language import identify, learn_languages
from .licenses import scan_licenses
from .jaccard import jaccard_components, jaccard_links
from .lm import score_documents
from .repair import damaged, repair_report
from .clustering import cluster
from .topk import top_k


def tokenizer_path() -> str:
    """The installed vocabulary file; every operator takes another path as a parameter."""
    from public_tokenizers import path

    return str(path("byte_bpe_50k.json"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir)).drop("row")


EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""

def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(of_kind(F.col("pii"), kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(joined(of_kind(F.col("pii"), *BASE)), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_folder(spark)
    return read_token_files(write_token_files(documents(spark, sf_dir), folder, tokenizer_path()), folder)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    third = crc_remainder(F.col("doc_id"), 3)
    found = identify(docs, learn_languages(docs.where(third != 1).select("doc_id", "text", "lang")))
    return found.select("doc_id", (third == 1).alias("held_out"), "lang_pred", "score")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.size("sentence_ids").cast("long").alias("n_sentences"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), k=4, part=85, whole=100)


def op6_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(documents(spark, sf_dir), k=4, part=85, whole=100)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(conversations, damaged(conversations))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * c >= 85 * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS hit FROM documents
  UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.hit)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, d.component_id
FROM (SELECT doc_id, min(hit) AS component_id FROM reach GROUP BY doc_id) d LEFT JOIN n ON n.doc_id = d.doc_id
"""

# The same with the number of a document's links.
JACCARD_LINKS_SQL = JACCARD_SQL.replace("SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, d.component_id", """
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, d.component_id,
       (SELECT count(*) FROM edges e WHERE e.x = d.doc_id) AS n_links""")


def _edits() -> str:
    """The repair as a recursion over turns: the cheapest way to each state of the role grammar,
    first with insertions, then over one more turn."""
    def add(state: str, cost: str, letter: str, line: str | None = None) -> str:
        out = f"{state}.out" if line is None else f"list_append({state}.out, {line})"
        return (f"CASE WHEN {state} IS NOT NULL THEN {{'cost': {state}.cost + {cost}, "
                f"'audit': {state}.audit || '{letter}', 'out': {out}}} END")

    def least(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"

    own, stays = "role || ':' || text", "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN goes OR left(role, 1) <> '{initial}' THEN NULL ELSE {add(state, stays, 'K', own)} END"

    def changed(state: str, role: str) -> str:
        return f"CASE WHEN goes THEN NULL ELSE {add(state, f'1 + {stays}', 'R', f"'{role}:' || text")} END"

    user, reply = "'user:'", "'assistant:'"
    opened = f"""SELECT *, {least('b2', *[add(f'b{i}', '5', 'I', user) for i in (0, 1, 3)])} AS c2 FROM best"""
    filled = f"""SELECT conv_id, i, b0 AS c0, b1 AS c1, c2, {least('b3', add('c2', '5', 'I', reply))} AS c3
                 FROM ({opened})"""
    before_user = ("c0", "c1", "c3")
    return rf"""
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'cost': 0, 'audit': '', 'out': []::VARCHAR[]}} AS b0,
         NULL::STRUCT(cost INTEGER, audit VARCHAR, "out" VARCHAR[]) AS b1,
         NULL::STRUCT(cost INTEGER, audit VARCHAR, "out" VARCHAR[]) AS b2,
         NULL::STRUCT(cost INTEGER, audit VARCHAR, "out" VARCHAR[]) AS b3
  FROM conversations
  UNION ALL
  SELECT c.conv_id, c.i + 1, {add('c0', '2', 'D')}, {least(add('c1', '2', 'D'), kept('c0', 's'))},
    {least(add('c2', '2', 'D'), *[kept(s, 'u') for s in before_user], *[changed(s, 'user') for s in before_user])},
    {least(add('c3', '2', 'D'), kept('c2', 'a'), changed('c2', 'assistant'))}
  FROM ({filled}) c JOIN faults r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.i + 1),
ends AS (
  SELECT conv_id, {least('c0', 'c3')} AS w
  FROM (SELECT * FROM ({filled}) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1))"""


REPAIR_SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
-- The 32-bit cyclic redundancy check, bit by bit: polynomial 0xEDB88320, all ones before and after.
kinds AS (
  SELECT *, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(name, ''),
        lambda ch: list_transform(range(8), lambda k: ((ord(ch) >> k::INTEGER) & 1)::BIGINT)))),
      lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 20 AS kind FROM keyed),
rows_after AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) copies(n)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last_one
  FROM rows_after),
faults AS (
  SELECT *, fault IN ('blank', 'duplicate') AS goes,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM (SELECT *, CASE WHEN last_one = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN last_one NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ordered)),
{_edits()},
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, w.cost::BIGINT AS cost, w.audit AS audit,
       sha256(array_to_string(w.out, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

_WHOLE = "list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)"
_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _rounds(rounds: int) -> str:
    """Assign all vectors and move the centroids, so many times, then assign once more."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS (
  SELECT v.row, v.vec_id, v.v, c.cluster, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS distance
  FROM v, c{n} c QUALIFY row_number() OVER (PARTITION BY v.row ORDER BY distance, c.cluster) = 1)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS v FROM (
      SELECT cluster, place, sum(x) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{n}) GROUP BY ALL)
    GROUP BY cluster) m ON m.cluster = c.cluster)""")
    return ",\n".join(steps)


CLUSTER_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, {_WHOLE} AS v FROM embeddings
  WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1)::INTEGER AS cluster, v FROM v
  QUALIFY cluster < 16),
{_rounds(3)}
SELECT vec_id, a.cluster, distance, sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON c.cluster = a.cluster
"""

TOP_K_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS row, vec_id, {_WHOLE} AS v FROM embeddings WHERE {_FINITE})
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM (SELECT q.row, q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0)))::BIGINT AS score
      FROM v q JOIN v c ON c.row <> q.row WHERE q.vec_id % 20 = 0)
QUALIFY rank <= 20
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op2_mix_sources": (op2_mix_sources, None),
    "op9_exact_dedup": (op9_exact_dedup, EXACT_SQL),
    "op10_quality_rules": (op10_quality_rules, None),
    "op1_pii": (op1_pii, None),
    "op4_token_files": (op4_token_files, None),
    "op8_best_fit_packing": (op8_best_fit_packing, None),
    "op5_language_id": (op5_language_id, None),
    "op7_license_scan": (op7_license_scan, None),
    "op6_jaccard_join": (op6_jaccard_join, JACCARD_SQL),
    "op6_jaccard_links": (op6_jaccard_links, JACCARD_LINKS_SQL),
    "op3_lm_scoring": (op3_lm_scoring, None),
    "op11_conversation_repair": (op11_conversation_repair, REPAIR_SQL),
    "op12_centroid_clustering": (op12_centroid_clustering, CLUSTER_SQL),
    "op13_exact_top_k": (op13_exact_top_k, TOP_K_SQL),
}
