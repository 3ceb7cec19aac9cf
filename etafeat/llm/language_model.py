"""LM scoring (operator 6): a hashed maximum-entropy model with class-factored softmax.

Every token belongs to a class: the most frequent words have one each, the end of
text and a word that repeats the one before it have one, and all other words
share ``GROUPS`` classes. Those come from word endings: hashed endings with like
neighbours (counted over all training text) are clustered. A token's probability
is that of its class given the words before it, times that of the word in its
class by count. The class has a softmax over hashed n-gram and skip features of
the two words before the token, and of the three classes before it.

Training: class 4-grams are counted over all training text. Contexts are dealt
into slices, each update sums the slices' gradients (a matrix of fixed size) on
the driver, and ``STEPS`` updates fit the weights of class features. Those stay,
and ``ROUNDS`` of iterative scaling fit the weights of word features: every
training token is read in each round, tasks sum how often each feature and class
meet and how often the model says so, and Spark adds these up slice by slice.
Scoring: texts are dealt into blocks of about ``BLOCK`` bytes; a block's own
words are joined with the corpus counts and sent to it, so no task or driver
ever holds the vocabulary.

Rows whose crc32 of the id as text is divisible by ten are not learned from.

Defined results: a NULL text is empty; an empty text is one end token. Rows
without an id are held out. Without any training text every probability is that
of an unseen token in an empty model. Repeated rows count and are scored each.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm import ngrams
from etafeat.llm.common import materialize, table

ALPHA = 0.1
BLOCK, BLOCKS = 16 << 20, 64  # bytes of text in a block, about; least number of blocks
FLUSH = 4 << 20  # bytes of text a counting task numbers at once
RUN = 2 << 20  # the same, where the tokens' classes are needed
ENDINGS = 256
K = 32
BOS, END, REPEAT, HEADS = 0, 1, 2, 3
WORDS_OWN = 14  # words with a class of their own
GROUPS = K - HEADS - WORDS_OWN
FEATURES = 1 << 15
CONTEXTS = K ** 3
SLICES = 8
STEPS, RATE, MOMENTUM, RIDGE = 30, 0.1, 0.7, 1.0
WORD_FEATURES = 1 << 15
HISTORIES = 3  # word features of a token
ROUNDS, SMOOTH = 1, 1.0
WORD_SLICES = 64
TOKENS = 1 << 16  # tokens whose class probabilities are held at once
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def endings(words: pa.Array) -> np.ndarray:
    """Hash of each word's last letters, with whether punctuation follows them. Only distinct endings are hashed in Python."""
    core = pc.ascii_rtrim(words, characters=PUNCTUATION)
    last = pc.if_else(pc.equal(core, words), pa.scalar(b"", pa.binary()), pc.binary_slice(words.cast(pa.binary()), -1))
    tails = pc.binary_join_element_wise(pc.binary_slice(core.cast(pa.binary()), -3), last, b"").dictionary_encode()
    hashed = np.array([xxhash.xxh32_intdigest(t) % ENDINGS for t in tails.dictionary.to_pylist()], np.int64)
    return hashed[tails.indices.to_numpy(zero_copy_only=False)]


class Words:
    """The distinct words of the texts numbered last: ``names``, ``ending`` and ``own`` (class of its own, or 0)."""

    def __init__(self, heads: list[bytes] = ()):
        self.heads = pa.array(list(heads), pa.string())

    def hold(self, names: pa.Array) -> None:
        self.names, self.ending = names, endings(names)
        own = pc.index_in(names, value_set=self.heads)
        self.own = pc.fill_null(pc.add(own, HEADS), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def hashed(self) -> np.ndarray:
        """Hash of each word, and 0 for the end's number."""
        parts = [ngrams.hashed(self.names.slice(i, j - i)) for i, j in runs(self.names, ngrams.CHUNK)]
        return np.concatenate([*parts, np.zeros(1, np.uint64)])


def runs(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``texts`` that end with the text that passes ``size`` bytes."""
    length = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    first, total = 0, 0
    for i, n in enumerate(length.tolist(), 1):
        total += n
        if total > size:
            yield first, i
            first, total = i, 0
    if first < len(length):
        yield first, len(length)


def numbered(texts: pa.Array | list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (in ``words``) of the tokens of all ``texts``, an end (-1) after each; where each text starts."""
    if isinstance(texts, list):
        texts = pa.array(texts, pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), split.value_lengths().to_numpy(zero_copy_only=False))
    names, empty = coded.dictionary, coded.dictionary.index("").as_py()
    if empty >= 0:  # white space at a text's start or end leaves an empty word
        real = code != empty
        code, of = code[real], of[real]
        code -= code > empty
        names = pa.concat_arrays([names[:empty], names[empty + 1:]])
    words.hold(names)
    size = np.bincount(of, minlength=len(texts))
    at = np.full(len(code) + len(texts), -1, np.int32)
    start = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    inside = np.ones(len(at), bool)
    inside[start + size] = False
    at[inside] = code
    return at, start


def classes(at: np.ndarray, start: np.ndarray, words: Words, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each token, and the number of the three classes before it."""
    by_word = np.append(np.where(words.own > 0, words.own, group[words.ending]), END)  # the last is the end's, -1
    c = by_word[at]
    c[1:][at[1:] == at[:-1]] = REPEAT  # an end lies between texts
    c[at < 0] = END  # an end after an end, too
    context = np.zeros(len(c), np.int64)
    # tokens after the start that are still within n of it see BOS
    place = np.arange(len(c)) - np.repeat(start, np.diff(np.append(start, len(c))))
    for n in (3, 2, 1):
        before = np.zeros(len(c), np.int64)
        before[n:] = c[:-n]
        before[place < n] = BOS
        context = context * K + before
    return c, context


def word_features(at: np.ndarray, start: np.ndarray, words: Words) -> np.ndarray:
    """Hashed features of each token, a row for each kind: the word before, the two before, and the second before alone."""
    place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))

    def before(n: int, of: np.ndarray) -> np.ndarray:
        out = np.full(len(at), of[-1])
        out[n:] = of[at[:-n]]
        out[place < n] = of[-1]
        return out

    def numbers(kind: int, h: np.ndarray) -> np.ndarray:
        return (ngrams.mixed(h + np.uint64(kind) * ngrams.PRIME) & np.uint64(WORD_FEATURES - 1)).astype(np.int32)

    h = words.hashed()
    both = before(1, ngrams.mixed(h) * ngrams.PRIME) + before(2, h)
    return np.stack([before(1, numbers(0, h)), numbers(1, both), before(2, numbers(2, h))])


def class_odds(by_context: np.ndarray, weights: np.ndarray | None, context: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Unnormed probability of every class at each token; without ``weights`` from the classes before alone.

    ``by_context`` are logs of probabilities and a weight is at most ``ROUNDS`` log
    ratios, so that no exponential overflows or leaves all classes at zero.
    """
    z = np.take(by_context, context, axis=0)
    if weights is not None:
        of = np.empty_like(z)
        for f in feature:
            z += np.take(weights, f, axis=0, out=of, mode="clip")
    return np.exp(z, out=z)


def features() -> np.ndarray:
    """Hashed features of every context: bias, n-grams and skips of the three classes before."""
    every = np.arange(CONTEXTS, dtype=np.uint64)
    c1, c2, c3 = every % K, every // K % K, every // (K * K)
    one = np.uint64(1)
    kinds = [(0, 0 * c1), (1, c1), (2, c2), (3, c3), (4, c1 * K + c2), (5, c1 * K + c3), (6, c2 * K + c3), (7, every)]
    return np.stack([(ngrams.mixed((x + one) * np.uint64(8) + np.uint64(i)) % np.uint64(FEATURES)).astype(np.int64)
                     for i, x in kinds], axis=1)


def log_softmax(weights: np.ndarray, feature: np.ndarray) -> np.ndarray:
    z = weights[feature].sum(axis=1)
    z[:, BOS] = -np.inf  # never a token
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def gradient(weights: np.ndarray, feature: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that occur, and the log likelihood's derivative by their weights."""
    off = counts - counts.sum(axis=1, keepdims=True) * np.exp(log_softmax(weights, feature))
    seen, at = np.unique(feature, return_inverse=True)
    at = at.reshape(feature.shape)
    out = np.zeros((len(seen), K))
    for j in range(feature.shape[1]):
        order = np.argsort(at[:, j], kind="stable")
        first = np.flatnonzero(np.diff(at[order, j], prepend=-1))
        out[at[order[first], j]] += np.add.reduceat(off[order], first, axis=0)
    return seen, out


def update(weights: np.ndarray, total: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """The step along the gradient, scaled by how often each feature is used."""
    return RATE * (total - RIDGE * weights) / (0.25 * uses[:, None] + RIDGE)


def train(cells: DataFrame, totals: np.ndarray) -> np.ndarray:
    """Weights from ``cells(context, class, n)``; ``totals`` are the classes' counts."""
    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        counts = np.zeros((CONTEXTS // SLICES, K))
        counts[rows["context"].to_numpy() // SLICES, rows["class"].to_numpy()] = rows["n"].to_numpy()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())})

    slices = materialize(cells.withColumn("slice", F.col("context") % SLICES).groupBy("slice").applyInArrow(
        gather, "slice int, counts binary"), "slices")
    every = features()
    weights = np.zeros((FEATURES, K))
    weights[every[0, 0]] = np.log((totals + 0.5) / (totals + 0.5).sum())
    uses, moved = np.zeros(FEATURES), 0.0

    def step(now: np.ndarray | None):
        sent = None if now is None else cells.sparkSession.sparkContext.broadcast(now.astype(np.float32).tobytes())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    counts = np.frombuffer(blob).reshape(-1, K)
                    own = np.flatnonzero(counts.any(axis=1))
                    feature = features()[own * SLICES + s]
                    if sent is None:
                        n = np.bincount(feature.ravel(), weights=np.repeat(counts[own].sum(axis=1), feature.shape[1]), minlength=FEATURES)
                        seen, out = np.flatnonzero(n), n[n > 0, None]
                    else:
                        seen, out = gradient(np.frombuffer(sent.value, np.float32).reshape(-1, K), feature, counts[own])
                    yield pa.record_batch([pa.array([seen.astype(np.int64).tobytes()], pa.binary()),
                                           pa.array([out.tobytes()], pa.binary())], ["seen", "out"])

        got = slices.mapInArrow(run, "seen binary, out binary").collect()
        if sent:
            sent.destroy()  # else every step's weights stay on all executors
        return got

    for r in step(None):
        uses[np.frombuffer(r.seen, np.int64)] += np.frombuffer(r.out)
    for _ in range(STEPS):
        total = np.zeros((FEATURES, K))
        for r in step(weights):
            total[np.frombuffer(r.seen, np.int64)] += np.frombuffer(r.out).reshape(-1, K)
        moved = MOMENTUM * moved + update(weights, total, uses)
        weights = weights + moved
    return weights


def cluster(pairs: np.ndarray, groups: int = GROUPS, rounds: int = 25) -> np.ndarray:
    """Class of each ending, from ``pairs[a, b]``: how often a word ending in b follows one in a."""
    n = pairs.sum(axis=1) + pairs.sum(axis=0)
    share = lambda m: np.sqrt((m + 1e-9) / (m + 1e-9).sum(axis=1, keepdims=True))
    x = np.hstack([share(pairs), share(pairs.T)])
    centre = x[[int(n.argmax())]]
    while len(centre) < groups:
        far = ((x[:, None] - centre[None]) ** 2).sum(-1).min(axis=1)
        centre = np.vstack([centre, x[int((far * n).argmax())]])
    for _ in range(rounds):
        of = ((x[:, None] - centre[None]) ** 2).sum(-1).argmin(axis=1)
        for g in range(groups):
            if n[of == g].sum() > 0:
                centre[g] = np.average(x[of == g], axis=0, weights=n[of == g])
    return (HEADS + WORDS_OWN + of).astype(np.int16)


def merged(parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, their endings and summed counts, of several (words, endings, counts)."""
    if len(parts) == 1:
        return parts[0]
    coded = pa.concat_arrays([names for names, _, _ in parts]).dictionary_encode()
    code, n = coded.indices.to_numpy(zero_copy_only=False), np.zeros(len(coded.dictionary), np.int64)
    ending = np.zeros(len(n), np.int64)
    at = 0
    for _, e, c in parts:  # a part has a word once
        of = code[at:at + len(c)]
        n[of] += c
        ending[of] = e
        at += len(c)
    return coded.dictionary, ending, n


def word_counts(blocked: DataFrame) -> DataFrame:
    """(block, word, ending, pair, n): the distinct words of each block with their training
    counts; and, without word, counts of pairs of endings in training text. ``blocked`` has
    the rows of a block next to each other in one task; they are numbered in runs of
    ``FLUSH`` bytes, whose counts are merged until the block ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Words(), np.zeros(ENDINGS * ENDINGS, np.int64)
        now, parts = None, []

        def out(block, word, end, pair, n) -> pa.RecordBatch:
            return pa.record_batch([pa.array(block, pa.int32()), word, pa.array(end, pa.int32()),
                                    pa.array(pair, pa.int32()), pa.array(n, pa.int64())], ["block", "word", "ending", "pair", "n"])

        def ended() -> Iterator[pa.RecordBatch]:
            if parts:
                names, ending, n = merged(parts)
                for k in range(0, len(n), 50_000):
                    some = names[k:k + 50_000]
                    yield out(np.full(len(some), now), some.cast(pa.binary()), ending[k:k + 50_000],
                              np.full(len(some), -1), n[k:k + 50_000])
                parts.clear()

        for b in batches:
            block = b.column("block").to_numpy()
            learn = ~b.column("held_out").to_numpy(zero_copy_only=False)
            edges = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if block[first] != now:
                    yield from ended()
                    now = int(block[first])
                texts = b.column("text").slice(first, last - first)
                for i, j in runs(texts, FLUSH):
                    at, start = numbered(texts.slice(i, j - i), words)
                    known = np.repeat(learn[first + i:first + j], np.diff(np.append(start, len(at))))
                    word = at >= 0
                    both = word[1:] & word[:-1] & known[1:]
                    e = np.append(words.ending, 0)[at]
                    pairs += np.bincount(e[:-1][both] * ENDINGS + e[1:][both], minlength=len(pairs))
                    parts.append((words.names, words.ending, np.bincount(at[word & known], minlength=len(words.names))))
                    if len(parts) == 4:
                        parts[:] = [merged(parts)]
            pa.default_memory_pool().release_unused()  # what the last texts took, before the next ones
        yield from ended()
        at = np.flatnonzero(pairs)
        yield out(np.full(len(at), -1), pa.nulls(len(at), pa.binary()), np.full(len(at), -1), at, pairs[at])

    return blocked.mapInArrow(run, "block int, word binary, ending int, pair int, n long")


def class_counts(train_docs: DataFrame, heads: list[bytes], group: np.ndarray) -> DataFrame:
    """(context, class, n) over all of ``train_docs(text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cells = Words(heads), np.zeros(CONTEXTS * K, np.int64)
        for b in batches:
            for i, j in runs(b.column("text"), RUN):
                c, context = classes(*numbered(b.column("text").slice(i, j - i), words), words, group)
                cells += np.bincount(context * K + c, minlength=len(cells))
        at = np.flatnonzero(cells)
        yield pa.record_batch([pa.array((at // K).astype(np.int32)), pa.array((at % K).astype(np.int32)), pa.array(cells[at])],
                              ["context", "class", "n"])

    rows = train_docs.mapInArrow(run, "context int, class int, n long")
    return rows.groupBy("context", "class").agg(F.sum("n").alias("n"))


def fit_words(train_docs: DataFrame, heads: list[bytes], group: np.ndarray, by_context: np.ndarray) -> np.ndarray:
    """Weights of the word features over all of ``train_docs(text)``, by generalised iterative scaling.

    Each token has ``HISTORIES`` features, so a round adds that share of the log
    ratio of the classes a feature met and was expected to meet.
    """
    spark = train_docs.sparkSession
    # what a task sums has a fixed size, and it reads its texts as a stream: tasks as cores
    dealt = train_docs.coalesce(max(spark.sparkContext.defaultParallelism, 1))
    sent_context = spark.sparkContext.broadcast(by_context.tobytes())
    weights, met = None, None
    size = WORD_FEATURES // WORD_SLICES

    def total(rows: pa.Table) -> pa.Table:
        summed = np.sum([np.frombuffer(x, np.float32).astype(np.float64) for x in rows["sums"].to_pylist()], axis=0)
        return pa.table({"slice": rows["slice"][:1].combine_chunks().cast(pa.int32()), "met": rows["met"][:1].combine_chunks(),
                         "sums": pa.array([summed.tobytes()], pa.binary())})

    for _ in range(ROUNDS):
        sent = None if weights is None else spark.sparkContext.broadcast(weights.tobytes())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, base = Words(heads), np.frombuffer(sent_context.value, np.float32).reshape(-1, K)
            now = None if sent is None else np.frombuffer(sent.value, np.float32).reshape(-1, K)
            expected = np.zeros((K, WORD_FEATURES))
            counts = np.zeros(WORD_FEATURES * K, np.int64) if sent is None else None
            for b in batches:
                for i, j in runs(b.column("text"), RUN):
                    at, start = numbered(b.column("text").slice(i, j - i), words)
                    c, context = classes(at, start, words, group)
                    feature = word_features(at, start, words)
                    if counts is not None:
                        for f in feature:
                            counts += np.bincount(f.astype(np.int64) * K + c, minlength=len(counts))
                    for k in range(0, len(c), TOKENS):
                        of = feature[:, k:k + TOKENS].astype(np.int64)
                        p = class_odds(base, now, context[k:k + TOKENS], of)
                        p = np.ascontiguousarray((p / p.sum(axis=1, keepdims=True)).T, dtype=np.float64)
                        for f in of:
                            for share, sums in zip(p, expected):
                                sums += np.bincount(f, weights=share, minlength=WORD_FEATURES)
            for kind, sums in ((False, expected.T), (True, counts)):
                if sums is not None:
                    parts = sums.astype(np.float32).reshape(WORD_SLICES, size * K)
                    for s in np.flatnonzero(parts.any(axis=1)).tolist():
                        yield pa.record_batch([pa.array([s], pa.int32()), pa.array([kind]), pa.array([parts[s].tobytes()], pa.binary())],
                                              ["slice", "met", "sums"])

        sums = dealt.mapInArrow(run, "slice int, met boolean, sums binary").groupBy("slice", "met").applyInArrow(
            total, "slice int, met boolean, sums binary")
        expected, found = np.zeros((WORD_FEATURES, K)), np.zeros((WORD_FEATURES, K))
        for r in sums.toLocalIterator():
            (found if r.met else expected)[r.slice * size:(r.slice + 1) * size] = np.frombuffer(r.sums).reshape(size, K)
        met = found if met is None else met
        step = (np.log((met + SMOOTH) / (expected + SMOOTH)) / HISTORIES).astype(np.float32)
        weights = step if weights is None else weights + step
        if sent:
            sent.destroy()
    sent_context.destroy()
    return weights


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_blocks = max(BLOCKS, -(-size // BLOCK))
    rows = docs.select("doc_id", held_out().alias("held_out"), text.alias("text"),
                       F.pmod(F.xxhash64("doc_id", "text"), n_blocks).cast("int").alias("block"))
    counted = materialize(word_counts(rows.select("block", "held_out", "text").repartition("block")
                                   .sortWithinPartitions("block")), "block-words")
    vocabulary = materialize(counted.filter("word is not null").groupBy("word", "ending").agg(F.sum("n").alias("n"))
                             .filter("n > 0"), "vocabulary")
    pairs = np.zeros(ENDINGS * ENDINGS)
    found = counted.filter("word is null").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most ENDINGS squared
    pairs[found["pair"].to_numpy(np.int64)] = found["n"]
    group = cluster(pairs.reshape(ENDINGS, ENDINGS))
    top = vocabulary.orderBy(F.desc("n"), "word").limit(WORDS_OWN).collect()
    heads = [bytes(r.word) for r in top]
    by_ending = vocabulary.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    mass, kinds = np.zeros(K), np.zeros(K)
    for r in by_ending:
        mass[group[r.ending]] += r.n
        kinds[group[r.ending]] += r.v
    for r in top:
        mass[group[r.ending]] -= r.n
        kinds[group[r.ending]] -= 1
    learn = rows.filter(~F.col("held_out"))
    n_train = learn.count()
    n_words, v_words = sum(r.n for r in by_ending), sum(r.v for r in by_ending)
    n_all, v_all = n_words + n_train, v_words + (n_train > 0)
    cells = materialize(class_counts(learn.select("text"), heads, group), "class-counts")
    totals = np.zeros(K)
    for r in cells.groupBy("class").agg(F.sum("n").alias("n")).collect():
        totals[r["class"]] = r.n
    weights = train(cells, totals)
    by_class = log_softmax(weights, features()).astype(np.float32)
    by_word = spark.sparkContext.broadcast(fit_words(learn.select("text"), heads, group, by_class).tobytes())
    by_context = spark.sparkContext.broadcast(by_class.tobytes())

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        base_log = np.frombuffer(by_context.value, np.float32).reshape(-1, K)
        word_log = np.frombuffer(by_word.value, np.float32).reshape(-1, K)
        words = Words(heads)
        corpus = right["word"].combine_chunks().cast(pa.string())
        counts = np.append(right["n"].to_numpy(), 0)
        texts = left["text"].combine_chunks()
        n_tokens, n_known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        base, full = np.zeros(len(texts)), np.zeros(len(texts))
        for i, j in runs(texts, RUN):
            at, start = numbered(texts.slice(i, j - i), words)
            place = pc.fill_null(pc.index_in(words.names, value_set=corpus), len(corpus)).to_numpy(zero_copy_only=False)
            c, context = classes(at, start, words, group)
            n = np.append(counts[place], n_train)  # by word; the last is the end's, -1
            of_base = np.log10((n + ALPHA) / (n_all + ALPHA * (v_all + 1)))[at]
            of_group = np.append(group[words.ending], END)
            of_full = np.log10((n + ALPHA) / (mass[of_group] + ALPHA * (kinds[of_group] + 1)))[at]
            of_full[c < HEADS + WORDS_OWN] = 0.0  # the class is the word
            feature = word_features(at, start, words)
            for k in range(0, len(c), TOKENS):
                part = class_odds(base_log, word_log, context[k:k + TOKENS], feature[:, k:k + TOKENS])
                of_full[k:k + TOKENS] += np.log10(part[np.arange(len(part)), c[k:k + TOKENS]] / part.sum(axis=1))
            n_tokens[i:j] = np.diff(np.append(start, len(at)))
            n_known[i:j] = np.add.reduceat((n > 0).astype(np.int64)[at], start)
            base[i:j], full[i:j] = np.add.reduceat(of_base, start), np.add.reduceat(of_full, start)
        return pa.table({"doc_id": left["doc_id"], "held_out": left["held_out"], "copies": left["copies"], "n_tokens": n_tokens, "n_known": n_known,
                         "train_tokens": np.full(len(texts), n_all), "base_score": base, "score": full})

    known = (counted.filter("word is not null").select("block", "word").join(vocabulary, "word")
             .select("block", "word", "n"))
    # equal rows are one row of their block, scored once: a hot row is streamed, never held
    once = (rows.repartition("block").groupBy("block", "doc_id", "held_out", "text")
            .agg(F.count(F.lit(1)).cast("int").alias("copies")))
    scored = once.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, copies int, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
    return scored.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
