"""LM scoring with a hierarchical Pitman-Yor model over two-word contexts.

Every token is a customer in the restaurant of the two words before it, whose
parent is the restaurant of the last of them; a table opened there is a customer
of the parent. All of these share the one restaurant without context, which
seats every training token (not only the tables below it, so it is known before
they are seated) and whose base is uniform over the distinct training words and
one more. All contexts and all words of the training texts have their own
restaurants and dishes: what is gathered grows with the corpus.

Seatings are sampled by Gibbs: in a sweep every restaurant sends each dish's
customers away and seats them anew, one by one (from the ``EXACT``-th on in
groups of ``GROUPED`` of those seated), at tables of the dish or at new ones
that draw on the parent, as its last sweep left it; the parent then reseats what
they sent. After ``BURN`` sweeps the predictive probabilities of ``SAMPLES``
sweeps are averaged.

How it is spread. A restaurant and its children share their last word, so the
tokens are dealt by the word before them: one exchange, after which a bucket of
about ``BUCKET`` tokens holds whole restaurants of both kinds, sweeps on its own
and scores its tokens. The restaurant of a word before ``LIMIT`` tokens or more is
one as well, but lies in several buckets, by the hash of the word before it (and
that of a word before ``WIDE`` times as many also by the word after it), so no
bucket grows with one word. These buckets sweep together: in each sweep they seat
the customers of their contexts and send the tables of each dish to the part of
the parent that holds the dish; it seats what all of them sent and answers. So
the model is the same wherever ``LIMIT`` lies. Tokens travel as
sorted, packed and compressed columns, for each chunk of about ``CHUNK`` tokens
of whole documents and each bucket; what comes back is one sum per document of
the chunk, in the same form, and is added up by chunk.

The ``HEAD`` most frequent words travel to the tasks with their counts and root
probabilities. Any other word's probability is alpha + beta * p, with alpha and
beta from its bucket and p, its probability at the root, from a join on the
word, where no key is frequent. While they are seated, such words share one p.

Words and contexts are told apart by 64-bit hashes.

Cases: null or empty text is one end token; a null id counts as an empty text
in the hash, so it is held out; repeated rows come back repeated, and all count;
without training documents N and V are 0 and the model is its base measure; an
empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .staging import staged

HEAD, LIMIT, WIDE, BUCKET = 1 << 17, 1 << 18, 64, 1 << 20
DISCOUNTS, STRENGTH = (0.6, 0.75, 0.85), 1.0  # by words of context
BURN, SAMPLES, EXACT, GROUPED = 1, 2, 32, 0.08
MERGED, CHUNK = 1 << 20, 1 << 20
START = np.int64(1) << np.int64(60)
END = W.U(0x9B97F4A7C15F39CC)
FOLDS = 10


class Tokens:
    """Tokens of a group of documents: hash and bounds."""

    def __init__(self, w: W.Words):
        n = len(w.docs) - 1
        self.hash = np.insert(w.hash, w.docs[1:], END)
        self.docs = w.docs + np.arange(n + 1)
        self.doc = np.repeat(np.arange(n), np.diff(self.docs))


class Vocabulary:
    """The most frequent words in the order of their hash, with their count and
    rank. Numbers of words: the rank, or negative, the hash."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.lexsort((words, -counts))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        by_hash = np.argsort(words)
        self.words, self.rank, self.counts = words[by_hash], rank[by_hash], counts[order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = rare_number(hashes)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[at] == hashes
            out[known] = self.rank[at[known]]
        return out

    def before(self, number: np.ndarray, texts: int) -> np.ndarray:
        """How many training tokens follow each word, if it is frequent (else 0)."""
        out = np.zeros(len(number), dtype=np.int64)
        known = (number >= 0) & (number < START)
        if len(self.counts):
            out[known] = self.counts[number[known]]
        out[number == START] = texts
        return out


def rare_number(hashes: np.ndarray) -> np.ndarray:
    return (hashes | W.U(1 << 63)).view(np.int64)


@dataclass
class Shape:
    """What the tasks need to deal tokens out."""

    vocabulary: Vocabulary
    base: np.ndarray  # log10 base probability by rank
    texts: int
    buckets: int
    limit: int


def _hash(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return W.mix(x.view(np.uint64) * W.U(0x9E3779B97F4A7C15) + W.U(seed))


def deal(shape: Shape, v: np.ndarray, u: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Bucket of each token by the words before it (v the nearer one), mark: a
    hash of the token."""
    held = shape.vocabulary.before(v, shape.texts)
    parts = 1 + held // shape.limit
    part = (_hash(u, 1) % parts.astype(np.uint64)).astype(np.int64)
    wide = np.where(v == START, parts, 1 + held // (WIDE * shape.limit))  # START has one word before it
    part = (part + (mark.view(np.uint64) % wide.astype(np.uint64)).astype(np.int64)) % parts
    return (_hash(v + part * np.int64(1_000_003), 2) % W.U(shape.buckets)).astype(np.int64)


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays by byte planes, compressed: high bytes are mostly equal."""
    head = np.array([len(arrays[0])], dtype=np.int64).tobytes()
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=3).compress(head + planes)


def _unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, at, out = int(raw[:8].view(np.int64)[0]), 8, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


TOKEN_KINDS = [np.int64, np.int64, np.int64, np.uint32]  # steps of v, u, the word, the document in its chunk (twice; odd: training)
HOT_KINDS = TOKEN_KINDS + [np.uint32]  # and how often
SUM_KINDS = [np.uint32, np.float32]


class Held:
    """Documents of a chunk."""

    def __init__(self):
        self.hash, self.sizes, self.ids, self.out, self.n = [], [], [], [], 0

    def add(self, t: Tokens, ids: pa.Array, out: np.ndarray) -> None:
        self.hash.append(t.hash)
        self.sizes.append(np.diff(t.docs))
        self.ids.append(ids)
        self.out.append(out)
        self.n += len(t.hash)


def _dealt(shape: Shape, held: Held, chunk: int, kind: pa.DataType) -> pa.RecordBatch:
    """A row with the documents of a chunk (bucket below 0), and a blob of
    tokens for each bucket; those from ``shape.buckets`` on share restaurants."""
    v = shape.vocabulary
    word, sizes = v.numbers(np.concatenate(held.hash)), np.concatenate(held.sizes)
    out = np.concatenate(held.out)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    known = word >= 0
    base = np.bincount(doc[known], shape.base[word[known]], minlength=len(sizes))
    first = np.r_[True, doc[1:] != doc[:-1]]
    near = np.where(first, START, np.r_[START, word[:-1]])
    second = np.r_[False, first[:-1]] | first
    far = np.where(second, START, np.r_[START, START, word[:-2]][:len(word)])
    bucket = deal(shape, near, far, _hash(word, 12).view(np.int64)) + shape.buckets * (v.before(near, shape.texts) >= shape.limit)
    order = np.lexsort((far, near, bucket))
    place = (2 * doc + ~out[doc]).astype(np.uint32)
    names, blobs = [-1 - chunk % shape.buckets], [None]
    hot = order[np.searchsorted(bucket[order], shape.buckets):]
    for at, times in ((order[:len(order) - len(hot)], None), _counted(hot, [bucket, near, far, word, place])):
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[at]) != 0, True]) if len(at) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            names.append(int(bucket[at[a]]))
            blobs.append(_pack([np.diff(near[at[a:b]], prepend=np.int64(0)), far[at[a:b]], word[at[a:b]], place[at[a:b]],
                                *([] if times is None else [times[a:b]])]))
    texts = pa.StructArray.from_arrays(
        [pa.concat_arrays([x.cast(kind) for x in held.ids]), pa.array(out), pa.array(sizes.astype(np.int64)),
         pa.array(np.bincount(doc[known], minlength=len(sizes)).astype(np.int64)), pa.array(base)],
        ["doc_id", "held_out", "tokens", "known", "base"])
    offsets = pa.array([0] + [len(texts)] * len(blobs), pa.int32())
    return pa.record_batch([pa.array(names, pa.int64()), pa.array([chunk] * len(names), pa.int64()), pa.array(blobs, pa.binary()),
                            pa.ListArray.from_arrays(offsets, texts)], names=["bucket", "chunk", "blob", "texts"])


def _counted(at: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One of each set of positions that are equal by all keys, in the order of
    the keys, and how many there are."""
    at = at[np.lexsort([k[at] for k in reversed(keys)])]
    starts = np.flatnonzero(_edges([k[at] for k in keys]))
    return at[starts], np.diff(starts, append=len(at)).astype(np.uint32)


def _edges(keys: list[np.ndarray]) -> np.ndarray:
    """Whether a row of sorted keys differs from the one before it."""
    out = np.ones(len(keys[0]), dtype=bool)
    if len(out):
        out[1:] = False
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


class Bucket:
    """The tokens of a bucket as distinct rows (u, v, word), their contexts
    (u, v), the rows (v, word) above them and their contexts v."""

    def __init__(self, blobs: list[bytes]):
        parts = [_unpack(blob, TOKEN_KINDS) for blob in blobs]
        self.cuts = np.cumsum([0] + [len(p[0]) for p in parts])
        v = np.concatenate([np.cumsum(p[0]) for p in parts])
        u, word, place = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        del parts
        self.doc, seen = place >> 1, (place & 1).astype(bool)
        near = _hash(v, 3)
        with np.errstate(over="ignore"):
            key = _hash((near * W.U(0xD1342543DE82EF95) + _hash(u, 4)).view(np.int64), 5)
            row = _hash((key * W.U(0x2545F4914F6CDD1D) + _hash(word, 6)).view(np.int64), 7)
            _, first, self.row = np.unique(row, return_index=True, return_inverse=True)
            self.word = word[first]
            self.customers = np.bincount(self.row, seen, minlength=len(first))
            _, self.context = np.unique(key[first], return_inverse=True)
            upper = _hash((near[first] * W.U(0xD1342543DE82EF95) + _hash(self.word, 6)).view(np.int64), 8)
        _, first2, self.above = np.unique(upper, return_index=True, return_inverse=True)
        self.word2 = self.word[first2]
        _, self.context2 = np.unique(near[first][first2], return_inverse=True)


Seat = Callable[[np.ndarray, np.ndarray, np.ndarray, float, np.random.Generator], np.ndarray]


def seat(customers: np.ndarray, base: np.ndarray, others: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers were seated anew; others: tables
    of the other dishes of its restaurant, which a new table's weight sees."""
    opened, seated = np.minimum(customers, 1.0), np.minimum(customers, 1.0)  # the first opens a table
    going = np.flatnonzero(customers > 1)
    while len(going):
        n, t = seated[going], opened[going]
        group = np.minimum(np.where(n < EXACT, 1, np.ceil(GROUPED * n)), customers[going] - n)
        new = (STRENGTH + discount * (others[going] + t)) * base[going]
        chance = new / (new + np.maximum(n + (group - 1) / 2 - discount * t, 1e-12))
        opened[going] += random.binomial(group.astype(np.int64), chance)
        seated[going] += group
        going = going[seated[going] < customers[going]]
    return opened


def sweeps(b: Bucket, root: np.ndarray, seating: Seat, seed: int) -> Iterator[tuple]:
    """After the burn-in, of each sample: (alpha, beta) of each row (u, v, word),
    whose predictive probability is alpha + beta * root(word). root: that
    probability per row (v, word), as far as it is known."""
    random = np.random.default_rng([seed, 11])
    d2, d3 = DISCOUNTS[1:]
    c3 = b.customers
    total3 = np.bincount(b.context, c3)
    t3 = np.minimum(c3, 1.0)
    c2 = np.bincount(b.above, t3, minlength=len(b.word2))
    t2 = np.minimum(c2, 1.0)
    for number in range(BURN + SAMPLES):
        total2, tables2 = np.bincount(b.context2, c2), np.bincount(b.context2, t2)
        p2 = ((c2 - d2 * t2) + (STRENGTH + d2 * tables2[b.context2]) * root) / (STRENGTH + total2[b.context2])
        t3 = seating(c3, p2[b.above], np.bincount(b.context, t3)[b.context] - t3, d3, random)
        c2 = np.bincount(b.above, t3, minlength=len(b.word2))
        t2 = seating(c2, root, tables2[b.context2] - t2, d2, random)
        if number < BURN:
            continue
        total2, tables2 = np.bincount(b.context2, c2)[b.context2], np.bincount(b.context2, t2)[b.context2]
        alpha2, beta2 = (c2 - d2 * t2) / (STRENGTH + total2), (STRENGTH + d2 * tables2) / (STRENGTH + total2)
        novel = (STRENGTH + d3 * np.bincount(b.context, t3)[b.context]) / (STRENGTH + total3[b.context])
        yield (c3 - d3 * t3) / (STRENGTH + total3[b.context]) + novel * alpha2[b.above], novel * beta2[b.above]


class Root:
    """The restaurant without context. ``head``: customers of each frequent word;
    ``tail``: (customers, number of words that have as many) of the others."""

    def __init__(self, head: np.ndarray, tail: list[tuple[int, int]], seating: Seat):
        random, d = np.random.default_rng([1, 11]), DISCOUNTS[0]
        n, many = (np.array([x[k] for x in tail], dtype=float) for k in (0, 1))
        c, weight = np.r_[head, n], np.r_[np.ones(len(head)), many]
        self.base, customers = 1 / (weight.sum() + 1), (c * weight).sum()
        t = mean = np.minimum(c, 1.0)
        for number in range(BURN + SAMPLES):
            t = seating(c, np.full(len(c), self.base), (t * weight).sum() - t, d, random)
            mean = t / SAMPLES + (mean if number > BURN else 0)
        novel = (STRENGTH + d * (mean * weight).sum()) / (STRENGTH + customers)
        p = (c - d * mean) / (STRENGTH + customers) + novel * self.base
        self.unknown = novel * self.base
        self.head, self.by_count = p[:len(head)], dict(zip(n.astype(int).tolist(), p[len(head):].tolist()))
        self.lonely = float((p[len(head):] * many).sum() / many.sum()) if len(many) else self.unknown  # a mean word of the tail


def score(spark: SparkSession, docs: DataFrame, seating: Seat = seat) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select("doc_id", (fold == 0).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    types = staged(spark, _types(rows.where("not held_out")), "lm-words")
    total, distinct = types.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts, every = rows.agg(F.count_if(~F.col("held_out")), F.count(F.lit(1))).first()
    top = types.orderBy(F.col("n").desc(), "word").limit(HEAD).select("word", "n").toArrow()
    vocabulary = Vocabulary(np.asarray(top["word"], dtype=np.int64).view(np.uint64), np.asarray(top["n"], dtype=np.int64))
    tail = types.join(_frame(spark, W.signed(vocabulary.words)), "word", "left_anti") if distinct > HEAD else types.limit(0)
    tail = staged(spark, tail.select(F.expr("word | shiftleft(1L, 63)").alias("number"), "n"), "lm-tail")
    by_count = [(r.n, r.words) for r in tail.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy("n").collect()]  # distinct small counts
    root = Root(vocabulary.counts.astype(float), by_count, seating)

    logs = lambda n: np.log10((n + 0.1) / (total + 0.1 * (distinct + 1)))
    buckets = int(max(24, total / BUCKET * max(every, 1) / max(texts, 1)))
    shape = spark.sparkContext.broadcast(Shape(vocabulary, logs(vocabulary.counts), texts, buckets, LIMIT))
    size, head = CHUNK, spark.sparkContext.broadcast(np.r_[root.head, root.lonely])
    id_kind, id_type = docs.schema["doc_id"].dataType.simpleString(), _arrow(docs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        chunk, held = TaskContext.get().partitionId() << 32, Held()
        for batch in batches:
            out = batch["held_out"].to_numpy(zero_copy_only=False).astype(bool)
            for i, j, w in W.batches(batch["text"], lower=True):
                held.add(Tokens(w), batch["doc_id"].slice(i, j - i), out[i:j])
                if held.n > size:
                    yield _dealt(shape.value, held, chunk, id_type)
                    chunk, held = chunk + 1, Held()
        if held.n:
            yield _dealt(shape.value, held, chunk, id_type)

    def judge(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        if bucket < 0:  # documents of chunks go on as they are
            return pa.table([group["chunk"], group["texts"], pa.nulls(len(group), pa.binary()), pa.nulls(len(group), _RARE), *plain(group)], names=names)
        chunks = group["chunk"].to_numpy()
        order = np.argsort(chunks, kind="stable")
        blobs = [group["blob"][int(k)].as_py() for k in order]
        none = pa.nulls(len(order), group.schema.field("texts").type)
        if bucket >= shape.value.buckets:  # what it needs of others comes in the sweeps
            seats, tokens = _gathered(blobs)
            n = len(order) + 1
            return pa.table([pa.array(np.r_[0, chunks[order]]), pa.nulls(n, none.type), pa.array([seats, *tokens], pa.binary()), pa.nulls(n, _RARE),
                             pa.array([bucket] * n, pa.int64()), pa.array(["rows"] + ["tokens"] * (n - 1))], names=names)
        sums, rare = _judged(Bucket(blobs), bucket, seating, head.value)
        return pa.table([pa.array(chunks[order]), none, pa.array(sums, pa.binary()), rare, *plain(group)], names=names)

    plain = lambda group: (group["bucket"], pa.nulls(len(group), pa.string()))
    names = ["chunk", "texts", "sums", "rare", "bucket", "name"]
    kind = f"array<struct<doc_id:{id_kind},held_out:boolean,tokens:long,known:long,base:double>>"
    dealt = rows.mapInArrow(emit, f"bucket long, chunk long, blob binary, texts {kind}")
    judged = staged(spark, dealt.groupBy("bucket").applyInArrow(
        judge, f"chunk long, texts {kind}, sums binary, rare {_RARE_KIND}, bucket long, name string"), "lm-judged")
    if max([texts, *vocabulary.counts[:1]]) >= LIMIT:
        messages = judged.where("name is not null").select("bucket", F.col("chunk").alias("part"), "name", F.col("sums").alias("blob"))
        late = staged(spark, _shared(spark, messages, shape, head, seating), "lm-shared")
        judged = judged.where("name is null").select("chunk", "texts", "sums", "rare").unionByName(late, allowMissingColumns=True)

    def add(group: pa.Table) -> pa.Table:
        at = [k for k, x in enumerate(group["texts"]) if x.is_valid][0]
        texts = pa.concat_arrays(group["texts"].chunks)[at].values
        own = np.zeros(len(texts))
        for blob in group["sums"]:
            if blob.is_valid:
                doc, part = _unpack(blob.as_py(), SUM_KINDS)
                own[np.cumsum(doc)] += part
        n = len(texts)
        return pa.table([pa.array([group["chunk"][0].as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)),
                         *(texts.field(k) for k in range(5)), pa.array(own)],
                        names=["chunk", "doc", "doc_id", "held_out", "tokens", "known", "base", "own"])

    each = (judged.select("chunk", "texts", "sums").groupBy("chunk")
            .applyInArrow(add, f"chunk long, doc int, doc_id {id_kind}, held_out boolean, tokens long, known long, base double, own double"))
    rare = judged.where("rare is not null").select("chunk", F.explode("rare").alias("r")).select("chunk", "r.*")
    p = F.lit(root.unknown)  # of a word that no training text has
    if 0 < len(root.by_count) <= 4096:
        p = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for item in sorted(root.by_count.items()) for x in item]), F.col("n")), p)
    elif root.by_count:
        known = spark.createDataFrame(sorted(root.by_count.items()), "n long, p double")
        tail, p = tail.join(F.broadcast(known), "n"), F.coalesce("p", p)  # distinct counts of the tail
    n = F.coalesce("n", F.lit(0))
    late = (rare.join(tail, "number", "left")
            .select("chunk", "doc", F.when(n > 0, F.col("times")).otherwise(0).alias("known2"),
                    (F.log10((n + 0.1) / (total + 0.1 * (distinct + 1))) * F.col("times")).alias("base2"),
                    (F.log10(F.col("alpha") + F.col("beta") * p) * F.col("times")).alias("own2"))
            .groupBy("chunk", "doc").agg(*[F.sum(c).alias(c) for c in ("known2", "base2", "own2")]))
    none = lambda c: F.coalesce(c, F.lit(0))
    return (each.join(late, ["chunk", "doc"], "left")
            .select("doc_id", "held_out", F.col("tokens").alias("n_tokens"), (F.col("known") + none("known2")).alias("n_known"),
                    F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + none("base2")).alias("base_score"),
                    (F.col("own") + none("own2")).alias("score")))


def _arrow(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(docs.schema["doc_id"].dataType)


def _types(learnt: DataFrame) -> DataFrame:
    """word (hash) and n of all training tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # counts of some groups of texts, merged before they leave
        for batch in batches:
            for _, _, w in W.batches(batch["text"], lower=True):
                held.append(np.unique(Tokens(w).hash, return_counts=True))
                size += len(held[-1][0])
                if size > MERGED:
                    yield _merged(held)
                    held, size = [], 0
        if held:
            yield _merged(held)
    return learnt.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _merged(held: list) -> pa.RecordBatch:
    every, counts = (np.concatenate(x) for x in zip(*held))
    word, back = np.unique(every, return_inverse=True)
    return pa.record_batch([pa.array(W.signed(word)), pa.array(np.bincount(back, counts).astype(np.int64))], names=["word", "n"])


def _frame(spark: SparkSession, words: np.ndarray) -> DataFrame:
    return spark.createDataFrame(pa.table({"word": words}))


_RARE_KIND = "array<struct<doc:int,number:long,times:int,alpha:double,beta:double>>"
_RARE = pa.list_(pa.struct([("doc", pa.int32()), ("number", pa.int64()), ("times", pa.int32()), ("alpha", pa.float64()), ("beta", pa.float64())]))


def _judged(b: Bucket, seed: int, seating: Seat, p: np.ndarray) -> tuple[list[bytes], pa.Array]:
    """For each blob of the bucket: the sums of log10 probabilities by document
    over frequent words, and the others (document, word, alpha, beta)."""
    alpha, beta = 0.0, 0.0
    for x, y in sweeps(b, p[np.where(b.word2 >= 0, b.word2, len(p) - 1)], seating, seed):
        alpha, beta = alpha + x / SAMPLES, beta + y / SAMPLES
    return _summed(b.word, alpha, beta, p, [(b.row[i:j], b.doc[i:j].astype(np.int64), np.ones(j - i)) for i, j in zip(b.cuts[:-1], b.cuts[1:])])


def _summed(word: np.ndarray, alpha: np.ndarray, beta: np.ndarray, p: np.ndarray, blobs: list[tuple]) -> tuple[list[bytes], pa.Array]:
    """The same from alpha and beta of each row, and the row, document and
    number of the tokens of each blob."""
    frequent = word >= 0
    own = np.where(frequent, np.log10(alpha + beta * p[np.where(frequent, word, len(p) - 1)]), 0.0)
    sums, offsets, found = [], [0], []
    for row, doc, times in blobs:
        docs, at = np.unique(doc, return_inverse=True)
        part = np.bincount(at, own[row] * times).astype(np.float32)
        sums.append(_pack([np.diff(docs, prepend=0).astype(np.uint32), part]))
        rest = ~frequent[row]
        pair, back = np.unique(doc[rest] * len(word) + row[rest], return_inverse=True)
        found.append((pair // len(word), pair % len(word), np.bincount(back, times[rest], minlength=len(pair))))
        offsets.append(offsets[-1] + len(pair))
    doc, row, times = (np.concatenate([f[k] for f in found]) for k in range(3))
    values = pa.StructArray.from_arrays([pa.array(doc.astype(np.int32)), pa.array(word[row]), pa.array(times.astype(np.int32)), pa.array(alpha[row]), pa.array(beta[row])],
                                        ["doc", "number", "times", "alpha", "beta"])
    return sums, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


# ---- restaurants that lie in several buckets

ROW_KINDS = [np.int64] * 4  # steps of v, steps of u, the word, its customers
PIECE_KINDS = [np.uint32] * 3  # steps of the row, document, times
ASK_KINDS = [np.int64] * 4  # the restaurant (contexts: below 0), the dish or u, tables, tables of the last sweep (contexts: customers)
PARTED = 16  # buckets for each part of the parents
_MESSAGE = "bucket long, part long, name string, blob binary"


def _gathered(blobs: list[bytes]) -> tuple[bytes, list[bytes]]:
    """The distinct rows (v, u, word) of a bucket, and each blob's tokens by row."""
    parts = []
    for blob in blobs:  # one by one: a row may have many tokens
        v, u, word, place, times = _unpack(blob, HOT_KINDS)
        v = np.cumsum(v)
        starts = _edges([v, u, word])  # blobs are sorted
        row = np.cumsum(starts) - 1
        parts.append((v[starts], u[starts], word[starts], np.bincount(row, (place & 1) * times), row, place >> 1, times))
    v, u, word, customers = (np.concatenate([p[k] for p in parts]) for k in range(4))
    order = np.lexsort((word, u, v))
    starts = _edges([v[order], u[order], word[order]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(starts) - 1
    first = order[starts]
    seats = _pack([np.diff(v[first], prepend=np.int64(0)), np.diff(u[first], prepend=np.int64(0)), word[first],
                   np.bincount(number, customers).astype(np.int64)])
    tokens, begin = [], 0
    for p in parts:
        row = number[begin:begin + len(p[0])][p[4]]  # ascending, as both are sorted alike
        tokens.append(_pack([np.diff(row, prepend=0).astype(np.uint32), p[5].astype(np.uint32), p[6]]))
        begin += len(p[0])
    return seats, tokens


class Spread:
    """The rows of a bucket of shared restaurants, as ``Bucket`` has them;
    ``asks``: for each part of the parents the (v, word) and the contexts whose
    tables it adds up. A context is added up there if its v is in ``WIDE`` parts."""

    def __init__(self, blob: bytes, shape: Shape):
        v, u, self.word, customers = _unpack(blob, ROW_KINDS)
        v, u, self.customers = np.cumsum(v), np.cumsum(u), customers.astype(float)
        starts = _edges([v, u])
        self.context, v1 = np.cumsum(starts) - 1, v[starts]
        restaurant = np.where(v == START, frequent_before(shape), v)
        self.context_v, self.context_u = restaurant[starts], u[starts]
        order = np.lexsort((self.word, restaurant))
        starts = _edges([restaurant[order], self.word[order]])
        self.above = np.empty(len(order), np.int64)
        self.above[order] = np.cumsum(starts) - 1
        self.v2, self.word2 = restaurant[order[starts]], self.word[order[starts]]
        self.total3 = np.bincount(self.context, self.customers)
        wide = (v1 == START) | (shape.vocabulary.before(v1, shape.texts) >= WIDE * shape.limit)
        parts = max(24, shape.buckets // PARTED)
        up = (_hash(self.word2 + self.v2 * np.int64(1_000_003), 9) % W.U(parts)).astype(np.int64)
        side = np.where(wide, (_hash(self.context_u + self.context_v * np.int64(1_000_003), 10) % W.U(parts)).astype(np.int64), -1)
        self.asks = [(k, np.flatnonzero(up == k), np.flatnonzero(side == k)) for k in np.unique(np.r_[up, side[wide]]).tolist()]

    def ask(self, t3: np.ndarray, t2: np.ndarray) -> list[tuple[int, bytes]]:
        c2, tables3 = np.bincount(self.above, t3), np.bincount(self.context, t3)
        ints = lambda *xs: np.concatenate(xs).astype(np.int64)
        return [(k, _pack([ints(self.v2[a], -1 - self.context_v[b]), ints(self.word2[a], self.context_u[b]), ints(c2[a], tables3[b]),
                           ints(t2[a], self.total3[b])])) for k, a, b in self.asks]

    def heard(self, answers: dict[int, bytes], t3: np.ndarray) -> tuple[np.ndarray, ...]:
        """Customers and tables of each (v, word), tables and customers of each context."""
        c2, t2 = np.empty(len(self.v2)), np.empty(len(self.v2))
        tables3, total3 = np.bincount(self.context, t3), self.total3.copy()
        for k, a, b in self.asks:
            x, y = _unpack(answers[k], [np.int64] * 2)
            c2[a], t2[a], tables3[b], total3[b] = x[:len(a)], y[:len(a)], x[len(a):], y[len(a):]
        return c2, t2, tables3, total3


def frequent_before(shape: Shape) -> int:
    """How many words have shared restaurants: the first ones by rank. The
    next number is that of START."""
    return int(np.count_nonzero(shape.vocabulary.counts >= shape.limit))


def _shared(spark: SparkSession, messages: DataFrame, shape, head, seating: Seat) -> DataFrame:
    """Sums (as ``judge``'s) of the tokens in buckets of shared restaurants.
    messages: their rows and tokens. The sweeps are those of ``sweeps``; what it
    has at hand there is asked of the parents' parts here, once in each sweep."""
    d2, d3 = DISCOUNTS[1:]
    size = frequent_before(shape.value) + 1
    rows = messages.where("name = 'rows'")
    last, said, totals = rows, [], []  # totals: of each sweep, customers and tables by restaurant (as many as LIMIT fits into the tokens)

    def visits(k: int, total2: np.ndarray, tables2: np.ndarray) -> Callable:
        def visit(group: pa.Table) -> pa.Table:
            bucket, found = group["bucket"][0].as_py(), _named(group)
            b = Spread(found["rows"][0], shape.value)
            if k == 0:
                t3, t2 = np.minimum(b.customers, 1.0), np.zeros(len(b.v2))
            else:
                t3 = _unpack(found[f"tables{k - 1}"][0], [np.int64])[0].astype(float)
                c2, t2, tables3, _ = b.heard(found[f"answer{k - 1}"], t3)
                p2 = ((c2 - d2 * t2) + (STRENGTH + d2 * tables2[b.v2]) * _root(b.word2, head.value)) / (STRENGTH + total2[b.v2])
                t3 = seating(b.customers, p2[b.above], tables3[b.context] - t3, d3, np.random.default_rng([bucket, k, 12]))
            asks = b.ask(t3, t2)
            return _told(bucket, [0] + [a[0] for a in asks], [f"tables{k}"] + [f"ask{k}"] * len(asks), [_pack([t3.astype(np.int64)])] + [a[1] for a in asks])
        return visit

    def answers(k: int, tables2: np.ndarray) -> Callable:
        def answer(group: pa.Table) -> pa.Table:
            part = group["part"][0].as_py()
            order = np.argsort(group["bucket"].to_numpy())
            asked = [_unpack(group["blob"][int(i)].as_py(), ASK_KINDS) for i in order]
            v, x, n, held = (np.concatenate([a[j] for a in asked]) for j in range(4))
            sort = np.lexsort((x, v))
            starts = _edges([v[sort], x[sort]])
            one = np.empty(len(sort), np.int64)
            one[sort] = np.cumsum(starts) - 1
            first = sort[starts]
            c, t, dish = np.bincount(one, n), np.bincount(one, held), v[first] >= 0  # below: contexts, whose customers t are
            v2, x2, c2 = v[first][dish], x[first][dish], c[dish]
            if k == 0:
                t[dish] = np.minimum(c2, 1.0)
            else:
                t[dish] = seating(c2, _root(x2, head.value), tables2[v2] - held[first][dish], d2, np.random.default_rng([part, k, 13]))
            cuts = np.cumsum([0] + [len(a[0]) for a in asked])
            blobs = [_pack([c[one[i:j]].astype(np.int64), t[one[i:j]].astype(np.int64)]) for i, j in zip(cuts[:-1], cuts[1:])]
            own = np.unique(v2)
            sums = pa.StructArray.from_arrays([pa.array(own), *(pa.array(np.bincount(v2, y, minlength=size)[own]) for y in (c2, t[dish]))], ["v", "customers", "tables"])
            out = _told(0, [part] * len(blobs), [f"answer{k}"] * len(blobs), blobs)
            out = out.set_column(0, "bucket", group["bucket"].take(pa.array(order)))
            return out.append_column("totals", pa.ListArray.from_arrays(pa.array([0] + [len(own)] * len(blobs), pa.int32()), sums))
        return answer

    zero = np.zeros(size)
    for k in range(1 + BURN + SAMPLES):
        total2, tables2 = totals[-1] if k else (zero, zero)
        visited = staged(spark, last.groupBy("bucket").applyInArrow(visits(k, total2, tables2), _MESSAGE), "lm-visits")
        asked = visited.where(f"name = 'ask{k}'")
        answered = staged(spark, asked.groupBy("part").applyInArrow(
            answers(k, tables2), f"{_MESSAGE}, totals array<struct<v:long,customers:double,tables:double>>"), "lm-answers")
        totals.append((np.zeros(size), np.zeros(size)))
        for r in answered.select(F.inline("totals")).groupBy("v").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t")).collect():
            totals[-1][0][r.v], totals[-1][1][r.v] = r.c, r.t
        told = visited.where(f"name = 'tables{k}'").unionByName(answered.drop("totals"))
        last = rows.unionByName(told)
        if k > BURN:
            said.append(told)

    def judge(group: pa.Table) -> pa.Table:
        found, alpha, beta = _named(group), 0.0, 0.0
        b = Spread(found["rows"][0], shape.value)
        for k, (total2, tables2) in list(enumerate(totals))[1 + BURN:]:
            t3 = _unpack(found[f"tables{k}"][0], [np.int64])[0].astype(float)
            c2, t2, tables3, total3 = b.heard(found[f"answer{k}"], t3)
            under = STRENGTH + total2[b.v2]
            novel = ((STRENGTH + d3 * tables3) / (STRENGTH + total3))[b.context]
            alpha = alpha + ((b.customers - d3 * t3) / (STRENGTH + total3[b.context]) + novel * ((c2 - d2 * t2) / under)[b.above]) / SAMPLES
            beta = beta + novel * ((STRENGTH + d2 * tables2[b.v2]) / under)[b.above] / SAMPLES
        blobs = []
        for chunk in sorted(found["tokens"]):
            row, doc, times = _unpack(found["tokens"][chunk], PIECE_KINDS)
            blobs.append((np.cumsum(row, dtype=np.int64), doc.astype(np.int64), times))
        sums, rare = _summed(b.word, alpha, beta, head.value, blobs)
        return pa.table([pa.array(sorted(found["tokens"]), pa.int64()), pa.array(sums, pa.binary()), rare], names=["chunk", "sums", "rare"])

    for told in said:
        messages = messages.unionByName(told)
    return messages.groupBy("bucket").applyInArrow(judge, f"chunk long, sums binary, rare {_RARE_KIND}")


def _root(word: np.ndarray, p: np.ndarray) -> np.ndarray:
    return p[np.where(word >= 0, word, len(p) - 1)]


def _named(group: pa.Table) -> dict[str, dict[int, bytes]]:
    """Messages to a bucket by name and part."""
    out: dict[str, dict[int, bytes]] = {}
    for name, part, blob in zip(group["name"].to_pylist(), group["part"].to_pylist(), group["blob"]):
        out.setdefault(name, {})[part] = blob.as_py()
    return out


def _told(bucket: int, parts: list, names: list, blobs: list) -> pa.Table:
    return pa.table([pa.array([bucket] * len(parts), pa.int64()), pa.array(parts, pa.int64()), pa.array(names), pa.array(blobs, pa.binary())],
                    names=["bucket", "part", "name", "blob"])
