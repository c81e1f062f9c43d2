"""One registered query per operator, each over its whole table with production
parameters, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_dir
from ..operators.joins import fits_broadcast
from . import (chat_trees, decontaminate, exact_dedup, minhash_dedup, mixing, periodic_runs, pitman_yor, quality, subspace_join,
               substring_dedup, token_counts, url_filter, vector_codes)
from .staging import staged, table
from .words import WORD_PATTERN


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark, table(spark, sf_dir, "documents")).drop("kept_text")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark, table(spark, sf_dir, "pages"), URL_RULES)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}')" for r in URL_RULES)
OP4_SQL = rf"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, rule, verdict) AS (VALUES {_RULES})
SELECT page_id, host, path,
       (SELECT max_by(r.rule, length(r.rule)) FROM rules r WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)) AS rule,
       coalesce((SELECT max_by(r.verdict, length(r.rule)) FROM rules r WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)), 'allow') AS verdict
FROM parts"""


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents"))
    return (mixed.select("doc_id", "size", "source_size", "target", "taken", "position")
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


OP6_SQL = r"""
WITH sized AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                      CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sums),
weighed AS (SELECT *, CAST([3, 1, 2][(r - 1) % 3 + 1] AS DOUBLE) AS w, CAST([0.5, 0.0, -0.5][(r - 1) % 3 + 1] AS DOUBLE) AS tilt,
                   CAST(2 * source_size AS DOUBLE) AS capped FROM ranked),
levels AS (SELECT *, (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE)
                      - coalesce(sum(capped) OVER (ORDER BY capped / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY capped / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM weighed),
water AS (SELECT min_by(level, capped / w) AS level FROM levels WHERE level * w <= capped),
goals AS (SELECT source, source_size, tilt, least(capped, coalesce((SELECT level FROM water) * w, capped)) AS target FROM levels),
placed AS (SELECT s.doc_id, s.size, g.source_size, g.target, g.tilt,
                  coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
           FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
counted AS (SELECT *, CAST(round(target) AS BIGINT) AS whole,
                   CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS passes FROM placed),
mixed AS (SELECT *, CAST(passes * size + greatest(0, least(size, whole - passes * source_size - start)) AS BIGINT) AS taken,
                 CASE WHEN target > 0 THEN least(1.0, CAST(start AS DOUBLE) / target) ELSE 0 END AS due FROM counted)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE WHEN tilt = 0 THEN due
            ELSE (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * due) - (1 - tilt)) / (2 * tilt) END, 9) END AS position
FROM mixed"""


def op6_mixing_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.schedule(mixed.drop("text", "source")).select("doc_id", "pass", "size", "source_size", "target", "taken", "position")


#: The same sums as OP6_SQL, then a row per pass.
OP6_SCHEDULE_SQL = OP6_SQL[:OP6_SQL.index("mixed AS")] + r"""
every AS (SELECT *, unnest(range(0, CAST(passes AS BIGINT) + 1)) AS n FROM counted),
mixed AS (SELECT *, CAST(CASE WHEN n < passes THEN size ELSE greatest(0, least(size, whole - passes * source_size - start)) END AS BIGINT) AS taken,
                 CASE WHEN target > 0 THEN least(1.0, CAST(start + n * source_size AS DOUBLE) / target) ELSE 0 END AS due FROM every)
SELECT doc_id, CAST(n AS INTEGER) AS pass, size, source_size, target, taken,
       round(CASE WHEN tilt = 0 THEN due ELSE (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * due) - (1 - tilt)) / (2 * tilt) END, 9) + CAST(0 AS DOUBLE) AS position
FROM mixed WHERE taken > 0"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(spark, table(spark, sf_dir, "documents"))


#: Where the vocabulary of op8 lies, and the pattern by which it cuts texts
#: (fixed value: the published pattern of this vocabulary).
BPE_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def op8_token_counts(spark: SparkSession, sf_dir: str, bpe_file: str = BPE_FILE) -> DataFrame:
    """Totals of two tokenizers after the batches of ``_token_batches``."""
    tokenizers = {"words-1": token_counts.word_counter(), "byte_bpe_50k-1": token_counts.bpe_counter(spark, bpe_file, BPE_PATTERN)}
    return _token_batches(spark, sf_dir, tokenizers)


def op8_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the tokenizer that SQL can express."""
    return _token_batches(spark, sf_dir, {"words-1": token_counts.word_counter()})


def _token_batches(spark: SparkSession, sf_dir: str, tokenizers: dict) -> DataFrame:
    """Batch 0 inserts every document and is sent twice. Batch 1 revises those of
    quality 0 (their language becomes ``und``), then those in German (their text
    stands there twice now, and is counted anew), then takes down those labelled
    toxic. The ledger is compacted in between."""
    docs = table(spark, sf_dir, "documents")
    counts = staged(spark, token_counts.counted(docs, tokenizers), "token-counts")
    changed = docs.where("lang = 'de'").withColumn("text", F.concat_ws(" ", "text", "text"))
    again = staged(spark, token_counts.counted(changed, tokenizers), "token-again")
    store = token_counts.Rollup(spark, stage_dir(spark, "llm-rollup"))
    sent = lambda op, seq, rows: rows.select(F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), "*")
    store.commit(0, sent("insert", 0, counts))
    store.commit(0, sent("insert", 0, counts))
    store.compact()
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    poor = counts.join(marks.where("quality = 0").select("doc_id"), "doc_id").withColumn("lang", F.lit("und")).select(counts.columns)
    toxic = counts.join(marks.where("toxic = 1").select("doc_id"), "doc_id").select(counts.columns)
    store.commit(1, sent("revise", 1, poor).unionByName(sent("revise", 2, again)).unionByName(sent("delete", 3, toxic)))
    return store.totals()


OP8_WORDS_SQL = r"""
WITH marks AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (SELECT d.source, d.lang, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n, m.quality
          FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id WHERE coalesce(m.toxic, 0) <> 1),
held AS (SELECT source, CASE WHEN lang = 'de' THEN lang WHEN quality = 0 THEN 'und' ELSE lang END AS lang, CASE WHEN lang = 'de' THEN 2 * n ELSE n END AS n FROM sized)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM held GROUP BY source, lang"""


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"))


PROBE = r"\### Assistant: </turn> ok"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    messages = staged_messages(spark, given.unionByName(probe))
    written = chat_trees.format_paths(chat_trees.paths(spark, messages, branches=1, distinct=True))
    turns, loss = chat_trees.read_turns(F.col("formatted")), chat_trees.read_loss(F.col("formatted"), F.col("loss_spans"))
    return (written.withColumn("turns", turns).withColumn("loss", F.array_join(loss, ""))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def staged_messages(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return staged(spark, chat_trees.chain(rows), "reply-messages")


_ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '#', '&num;')"
OP10_SQL = rf"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(4 + length(replace(replace({_ESC.format('role')}, ':', '&colon;'), chr(10), '&nl;')) + 2 + length({_ESC.format('text')}) + 8) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id"""

def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(spark, table(spark, sf_dir, "embeddings"), keep=("label",))
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    coded = staged(spark, coded, "vector-codes")
    sums = staged(spark, coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    if fits_broadcast(sums):
        joined = coded.join(F.broadcast(sums.withColumnRenamed("label", "l")), F.col("label").eqNullSafe(F.col("l")))
    else:  # a row per label is too much to broadcast: a hot label's rows go to SALTS tasks
        salts = sums.select(F.col("label").alias("l"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
        joined = coded.join(salts, F.col("label").eqNullSafe(F.col("l")) & (F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)) == F.col("s")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


SALTS = 64


def _op11_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Rounds of assignment and update, one pair of tables each, for vectors of 64 components."""
    apart = " + ".join(f"(p.v[{d}] - b.v[{d}]) * (p.v[{d}] - b.v[{d}])" for d in range(1, 9))
    mean = ", ".join(f"CAST((s{d} - ((s{d} % n) + n) % n) // n AS BIGINT)" for d in range(1, 9))
    sums = ", ".join(f"sum(v[{d}]) AS s{d}" for d in range(1, 9))
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (SELECT p.r, p.part, p.v, min({{'d': {apart}, 'e': b.entry}}) AS best FROM parts p JOIN book{r} b ON p.part = b.part GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, CASE WHEN n > 0 THEN [{mean}] ELSE b.v END AS v FROM book{r} b LEFT JOIN
  (SELECT part, best.e AS entry, count(*) AS n, {sums} FROM near{r} GROUP BY ALL) s ON b.part = s.part AND b.entry = s.entry)""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
       list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS ints
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, CAST(part AS INTEGER) AS part, ints[part * 8 + 1 : part * 8 + 8] AS v FROM kept, range(8) t(part)),
book0 AS MATERIALIZED (SELECT part, CAST(r - 1 AS INTEGER) AS entry, v FROM parts WHERE r <= 16),{",".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; where h = crc32(doc_id) is a multiple of 10, the words
    from a = g % n on (g = h / 10) repeat the first 1 + (n - a) / (3 + g % 8) of
    them, joined by spaces. A null id has no h."""
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD_PATTERN})"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.when(F.pmod(h, F.lit(10)) == 0, F.expr("1")).alias("chosen"), F.floor(h / 10).cast("long").alias("g"))
    rows = rows.withColumn("words", F.when(F.col("chosen") == 1, words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")).cast("int"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod("g", F.lit(8))))).cast("int")
    tail = F.slice("words", F.col("a") + 1, F.col("period"))
    again = F.flatten(F.array_repeat(tail, F.ceil((F.col("n") - F.col("a")) / F.col("period")).cast("int")))
    whole = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return rows.withColumn("period", period).select(
        "doc_id", F.when(F.col("a").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *periodic_runs.longest("runs"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_vectors(spark, table(spark, sf_dir, "embeddings"))


#: All pairs, which is what the operator avoids; cosines in doubles.
OP13_SQL = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS MATERIALIZED (SELECT r, v, sqrt(list_inner_product(v, v)) AS s FROM rows
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT x.r AS a, y.r AS b FROM good x JOIN good y ON x.r <> y.r AND len(x.v) = len(y.v)
  WHERE list_inner_product(x.v, y.v) / (x.s * y.s) >= 0.9),
reach(a, b) AS (SELECT r, r FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY reach.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = rows.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least USING (r)"""

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_mixing": op6_mixing,
    "op6_mixing_schedule": op6_mixing_schedule,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_counts": op8_token_counts,
    "op8_word_counts": op8_word_counts,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_subspace_join": op13_subspace_join,
}

SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op4_url_filter": OP4_SQL,
    "op6_mixing": OP6_SQL,
    "op6_mixing_schedule": OP6_SCHEDULE_SQL,
    "op8_word_counts": OP8_WORDS_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op11_vector_codes": _op11_sql(),
    "op13_subspace_join": OP13_SQL,
}
