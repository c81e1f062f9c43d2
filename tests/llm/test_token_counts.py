import base64
import os

import pytest
from pyspark.sql import functions as F

from aerostar.llm import token_counts as T
from aerostar.llm.queries import BPE_FILE, BPE_PATTERN

KIND = "op string, seq long, doc_id long, source string, lang string, tokenizer string, tokens long"


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in store.totals().collect()}


BATCHES = [
    [("insert", 0, k, ["a", None][k % 2], "en", z, 10 * k + len(z)) for k in range(20) for z in ("t1", "tt2")] + [("insert", 0, None, "n", None, "t1", 5)] * 2,
    [("delete", 0, k, None, None, None, None) for k in (1, 2, 99)] + [("revise", 0, 3, "b", "de", z, 7) for z in ("t1", "tt2")],
    [("insert", 1, 4, "c", "fr", "t1", 1), ("insert", 2, 4, "d", "fr", "t1", 2), ("delete", 3, 5, None, None, None, None), ("insert", 1, 5, "x", "x", "t1", 9),
     ("insert", 0, 1, "a", "en", "t1", 11), ("insert", 0, 1, "a", "en", "t1", 11), ("insert", 0, 1, "b", "en", "t1", 4), ("delete", 0, None, None, None, None, None),
     ("insert", 0, None, "n", None, "t1", 5), ("delete", 2, 6, None, None, None, None), ("insert", 2, 6, "a", "en", "t1", 3)],
    [],
    [("delete", 0, 1, None, None, None, None)],
]


@pytest.mark.parametrize("compacting", [False, True])
def test_deltas_against_a_recount(spark, scratch, compacting):
    store, held = T.Rollup(spark, f"{scratch}/store"), []
    assert totals(store) == {}
    for number, rows in enumerate(BATCHES):
        last = {}
        for op, seq, i, *rest in rows:
            if i is not None:
                last[i] = max(last.get(i, (-1, False)), (seq, op == "delete"))
        held = [x for x in held if x[0] not in last]
        held += [(i, *rest) for op, seq, i, *rest in rows if op != "delete" and (i is None or last[i] == (seq, False))]
        changes = spark.createDataFrame(rows, KIND)
        assert store.commit(number, changes)
        assert not store.commit(number, changes)  # sent twice: nothing happens
        if compacting and number % 2:
            assert store.compact() == number and store.compact() is None
            assert not store.commit(number, changes)
        want = {}
        for _, source, lang, z, n in held:
            d, t = want.get((source, lang, z), (0, 0))
            want[source, lang, z] = (d + 1, t + n)
        assert totals(store) == want


def test_rows_that_share_an_id_or_have_none_all_count(spark, scratch):
    docs = spark.createDataFrame([(i, "s", "en", "w " * n) for i, n in ((1, 4), (1, 4), (None, 5), (None, 6))], "doc_id long, source string, lang string, text string")
    store = T.Rollup(spark, f"{scratch}/store")
    counts = T.counted(docs, {"w": T.word_counter()})
    store.commit(0, counts.select(F.lit("insert").alias("op"), F.lit(0).cast("long").alias("seq"), "*"))
    assert totals(store) == {("s", "en", "w"): (4, 19)}


def test_a_batch_reads_only_the_buckets_it_touches(spark, scratch):
    store = T.Rollup(spark, f"{scratch}/store")
    store.commit(0, spark.range(500).selectExpr("'insert' op", "0L seq", "id doc_id", "'a' source", "'en' lang", "'t' tokenizer", "id tokens"))
    bucket = spark.range(7, 8).select(T._bucket("id")).first()[0]
    files = store._ledger(-1, [0], [bucket]).inputFiles()
    assert files and all(f"bucket={bucket}/" in f for f in files) and len(store._ledger(-1, [0], range(T.BUCKETS)).inputFiles()) > 30


def test_the_query_against_brute_force(spark, tmp_path):
    """Repeated and null ids, texts without words, labels of several kinds."""
    docs = [(k % 30, ["a", None, "b"][k % 3], ["de", "en", None][k % 3 if k % 4 else 0], ["x " * (k % 7), None, "", "one two"][k % 4]) for k in range(60)]
    docs += [(None, "a", "de", "n n n"), (None, "a", "en", "n")] * 2
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 40, 2)] + [(3, 0, 0), (3, 1, 1), (9, 0, 0), (None, 0, 1)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    from aerostar.llm import queries as Q
    toxic = {i for i, _, t in labels if t and i is not None}
    poor = {i for i, q, _ in labels if not q and i is not None}
    german = {i for i, _, lang, _ in docs if lang == "de" and i is not None}
    want = {}
    for i, source, lang, text in docs:
        n = len((text or "").split())
        if i is None:
            rows = [(lang, n)] + [(lang, 2 * n)] * (lang == "de")  # a null id cannot be revised: such rows only add
        elif i in toxic or (i in german and lang != "de"):
            rows = []  # gone, or replaced by the id's German rows
        else:
            rows = [("de", 2 * n)] if lang == "de" else [("und" if i in poor else lang, n)]
        for lang_, n_ in rows:
            d, t = want.get((source, lang_, "words-1"), (0, 0))
            want[source, lang_, "words-1"] = (d + 1, t + n_)
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in Q.op8_word_counts(spark, str(tmp_path)).collect()} == want


def test_a_batch_that_failed_halfway_is_written_anew(spark, scratch):
    store = T.Rollup(spark, f"{scratch}/store")
    rows = spark.createDataFrame([("insert", 0, 1, "a", "en", "t", 3)], KIND)
    rows.select("doc_id", F.lit(1).alias("bucket")).write.partitionBy("bucket").parquet(f"{scratch}/store/ledger/batch=0")  # left by the failure, no marker
    assert totals(store) == {}
    assert store.commit(0, rows) and totals(store) == {("a", "en", "t"): (1, 3)}


@pytest.mark.skipif(not os.path.exists(BPE_FILE), reason="needs the vocabulary file")
def test_counts_of_both_tokenizers(spark, messy):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE_FILE, "rb"))}
    encoding = tiktoken.Encoding("t", pat_str=BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = T.counted(messy, {"w": T.word_counter(), "b": T.bpe_counter(spark, BPE_FILE, BPE_PATTERN)})
    want = sorted((str(r.doc_id), z, n) for r in messy.collect() for z, n in (("w", len((r.text or "").encode().split())), ("b", len(encoding.encode_ordinary(r.text or "")))))
    assert sorted((str(r.doc_id), r.tokenizer, r.tokens) for r in got.collect()) == want
    assert T.counted(messy.where(F.lit(False)), {"w": T.word_counter()}).count() == 0
