"""Language-model scoring with a gated recurrent net.

Tokens are the words of a text (A-Z in lower case, cut at ASCII white space) and
one end. Token counts cover all training documents. The most frequent tokens,
a fixed number, are the net's words; all others share its word RARE and are
told apart by their counts, so a text's probability covers any token:
log P(token) = log P(RARE | state) + log((c + 0.1) / (R + 0.1 (rare kinds + 1))).

The net (`gru.py`) learns by truncated back-propagation from every training
document, in rounds of growing shares of the documents: in a round each task
starts from the same weights and learns from its own rows, then the weights are
averaged by tokens in a tree, so neither the driver nor a task sees more than a
few copies of the weights, whose size is fixed. Scoring carries the state
through the whole document.

Texts are split twice: to count their tokens, and to write each text as the
numbers of its words, two bytes a token, with what its score needs of the counts.
Learning and scoring read these numbers. Counts of the most frequent tokens (a
bounded list) travel with the writing tasks; the counts of all other tokens are
joined by token.

Defined results: NULL and empty texts are one end token; rows without training
documents at all get the untrained net (counts of the end only); repeated rows
are scored alike, ids may be NULL or repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import crc32_of_id, held_out, table
from ledgerlake.llm.gru import Net
from ledgerlake.session import materialise

FOLDS = 10
WORDS = 1023  # the net's own words besides RARE
CLASSES = 32
SUFFIXES = 256  # inputs for rare words, by their last letters
ADD = 0.1
LISTED = 100_000  # frequent tokens whose counts go with the tasks
LISTED_BYTES = 64  # longer tokens are not listed, so the list is bounded
ROUNDS = ((0, 1), (1, 2), (2, 4), (4, 8))  # shares of the training documents, in eighths
END = b"\n"  # no word holds white space
CODED_TOKENS = 50_000  # tokens looked up together
LEARN_TOKENS = 300_000  # documents learnt from together
SCORE_TOKENS = 1_200_000  # documents scored together
LONG = 2048  # tokens; longer documents are scored with their like
LONG_TOKENS = 4_000_000
HELD_TOKENS = 200_000  # distinct tokens a counting task holds
CODES = 300_000  # unknown words whose numbers a task remembers


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text; A-Z in lower case. bytes.split cuts at the ASCII white space 09-0D and 20."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all texts, the end included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                             names=["token", "c"])
            held.clear()
            return out

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(tokens_of(text))
                held[END] += 1
                if len(held) > HELD_TOKENS:
                    yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The net's words in falling order of their counts, RARE among them."""

    def __init__(self, top: list[tuple[bytes, int]], total: int, kinds: int) -> None:
        known = sum(c for _, c in top)
        self.total, self.kinds = total, kinds
        self.rare_total, self.rare_kinds = total - known, kinds - len(top)
        words: list[tuple[bytes | None, int]] = sorted([*top, (None, self.rare_total)], key=lambda w: (-w[1], w[0] or b""))
        self.counts = np.array([c for _, c in words], np.int64)
        self.index = {w: i for i, (w, _) in enumerate(words) if w is not None}
        self.rare = next(i for i, (w, _) in enumerate(words) if w is None)
        self.size = len(words)
        self.first = self.size + SUFFIXES  # the input before a text's first token
        self.inputs = self.first + 1

    def net(self) -> Net:
        return Net(self.counts, self.inputs, CLASSES)

    def inputs_of(self, ids: np.ndarray, codes: Codes) -> np.ndarray:
        """The net's inputs for a text, from its words' numbers."""
        x = np.empty(len(ids) + 1, np.uint16)  # fewer than 65,536 inputs
        x[0] = self.first
        x[1:] = codes.inputs[ids]
        return x

    def encode(self, ids: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """(inputs, targets) of a text from its words' numbers."""
        return self.with_targets(self.inputs_of(ids, codes))

    def with_targets(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = np.append(x[1:], np.uint16(self.index.get(END, self.rare)))
        y[y >= self.size] = self.rare
        return x, y


class Codes(dict):
    """Each word's number, one look-up per word: known words have their own, all others one by their last
    letters, made when first asked for. `inputs` and `logs` give each number's input and log count."""

    def __init__(self, vocab: Vocabulary, listed: dict[bytes, int] | None = None) -> None:
        self.listed = listed or {}
        known = list(dict.fromkeys([*vocab.index, *self.listed]))
        super().__init__(zip(known, range(len(known))))
        self.known = len(known)
        tail = np.arange(SUFFIXES, dtype=np.int32) + vocab.size
        own = [vocab.index.get(w, -1) for w in known]
        self.inputs = np.append(np.array([i if i >= 0 else vocab.size + self._suffix(w) for i, w in zip(own, known)], np.int32), tail)
        self.logs = np.append(np.log10(np.array([self.listed.get(w, np.nan) for w in known], np.float64) + ADD), np.full(SUFFIXES, np.nan))

    @staticmethod
    def _suffix(word: bytes) -> int:
        import zlib
        return zlib.crc32(word[-3:]) % SUFFIXES

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.known + self._suffix(word)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if len(self) > self.known + CODES:
            for w in [w for w, i in self.items() if i >= self.known]:
                del self[w]
        return out


def listed_counts(counts: DataFrame, most: int | None = None) -> dict[bytes, int]:
    """The counts of the most frequent tokens, at most `most` of them (LISTED).

    A histogram of the counts on a fixed logarithmic scale gives the smallest
    count that keeps the list within its bound, so only the list itself comes to
    the driver, however many partitions there are."""
    most = LISTED if most is None else most
    short = counts.where(F.octet_length("token") <= LISTED_BYTES)
    step = F.floor(F.log2("c") * 256).cast("int")  # at most 64 x 256 steps
    held, least = 0, None
    for r in sorted(short.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        held += r["count"]
        if held > most:
            break
        least = r["step"]
    if least is None:
        return {}
    return {bytes(r["token"]): r["c"] for r in short.where(step >= least).collect()}


def vocabulary(counts: DataFrame, listed: dict[bytes, int]) -> Vocabulary:
    """The net's words: the most frequent of the listed tokens."""
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = sorted(listed.items(), key=lambda w: (-w[1], w[0]))[:WORDS]
    return Vocabulary(top, total, kinds)


def coded(docs: DataFrame, vocab: Vocabulary, listed: dict[bytes, int]) -> DataFrame:
    """Each row of (doc_id, text, learns, share) with `x`, its net inputs, and what its score needs of the counts."""
    shared = docs.sparkSession.sparkContext.broadcast((vocab, listed))  # LISTED tokens
    names = ["doc_id", "learns", "share", "n_tokens", "known", "listed_sum", "rare_sum", "n_rare", "x", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, listed = shared.value
        codes = Codes(vocab, listed)
        for batch in batches:
            at, words, ends = 0, [], []
            for text in batch.column("text").to_pylist():
                words += tokens_of(text)
                words.append(END)
                ends.append(len(words))
                if len(words) >= CODED_TOKENS:
                    yield coded_part(batch.slice(at, len(ends)), words, np.array(ends), vocab, codes)
                    at, words, ends = at + len(ends), [], []
            if ends:
                yield coded_part(batch.slice(at, len(ends)), words, np.array(ends), vocab, codes)

    def coded_part(part: pa.RecordBatch, words: list[bytes], ends: np.ndarray, vocab: Vocabulary, codes: Codes) -> pa.RecordBatch:
        from collections import Counter
        starts = np.append(0, ends[:-1])
        ids = codes.numbers(words)
        given, log = codes.inputs[ids], codes.logs[ids]
        x = np.empty(len(ids), np.uint16)  # fewer than 65,536 inputs
        x[1:], x[starts] = given[:-1], vocab.first
        off, rare = np.isnan(log), given >= vocab.size
        log[off] = 0.0
        at = np.flatnonzero(off)
        cut = np.searchsorted(at, np.append(0, ends)).tolist()
        unlisted = [words[k] for k in at.tolist()]
        tails = [Counter(unlisted[lo:hi]) for lo, hi in zip(cut, cut[1:])]
        flat = pa.StructArray.from_arrays(
            [pa.array([w for t in tails for w in t], pa.binary()), pa.array([n for t in tails for n in t.values()], pa.int64())],
            names=["token", "n"])
        sizes = ends - starts
        rows = [sizes, sizes - np.diff(cut), np.add.reduceat(log, starts), np.add.reduceat(np.where(rare, log, 0.0), starts),
                np.add.reduceat(rare.astype(np.int64), starts)]
        texts = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((np.append(0, ends) * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in names[:3]), *(pa.array(c) for c in rows), texts,
             pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(t) for t in tails]), pa.int32()), flat)], names=names)

    return docs.select("doc_id", "text", "learns", "share").mapInArrow(
        run, "doc_id long, learns boolean, share int, n_tokens long, known long, listed_sum double, rare_sum double, n_rare long, "
             "x binary, tail array<struct<token:binary,n:long>>").withColumn("row", F.monotonically_increasing_id())


def learn(rows: DataFrame, vocab: Vocabulary) -> Net:
    """The net after all rounds, from the inputs `x` of rows whose `share` is their eighth."""
    spark = rows.sparkSession
    net = vocab.net()
    if vocab.total == 0:
        return net
    known = spark.sparkContext.broadcast(vocab)  # WORDS words
    for lo, hi in ROUNDS:
        weights = spark.sparkContext.broadcast(net.flat())  # fixed size

        def run(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            vocab = known.value
            net, memory, n = vocab.net(), {}, 0
            net.load(weights.value)
            texts, size = [], 0
            for batch in batches:
                for x in batch.column("x").to_pylist():
                    texts.append(vocab.with_targets(np.frombuffer(x, np.uint16)))
                    size += len(texts[-1][0])
                    if size >= LEARN_TOKENS:
                        net.train(texts, memory)
                        n, texts, size = n + size, [], 0
            net.train(texts, memory)
            n += size
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([net.flat().tobytes()], pa.binary())],
                                                 names=["n", "weights"])

        learnt = rows.where((F.col("share") >= lo) & (F.col("share") < hi)).select("x").mapInArrow(run, "n long, weights binary")

        def add(acc, row):
            n, w = acc
            own = np.frombuffer(row["weights"], np.float32).astype(np.float64) * row["n"]
            return n + row["n"], own if w is None else w + own

        def merge(a, b):
            if a[1] is None or b[1] is None:
                return a if b[1] is None else b
            return a[0] + b[0], a[1] + b[1]

        n, summed = learnt.rdd.treeAggregate((0, None), add, merge, depth=3)
        if n:
            net.load(summed / n)
    return net


def scores(part: DataFrame, counts: DataFrame, vocab: Vocabulary, net: Net) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each row of the stored table of `coded`."""
    shared = part.sparkSession.sparkContext.broadcast((vocab, net.flat()))  # fixed size
    kept = ["row", "doc_id", "n_tokens", "known", "listed_sum", "rare_sum", "n_rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, flat = shared.value
        net = vocab.net()
        net.load(flat)

        def scored(pool: list) -> pa.RecordBatch:
            rows = pa.concat_tables([pa.Table.from_batches([b]) for b in pool[0]]).combine_chunks()
            logp = net.score([vocab.with_targets(np.frombuffer(x, np.uint16)) for x in pool[1]]) / np.log(10)
            return pa.RecordBatch.from_arrays([*(rows.column(c).chunk(0) for c in kept), pa.array(logp)], names=[*kept, "logp"])

        # long documents wait for their like, so that lanes are of one length
        pools: dict[bool, list] = {False: [[], [], 0], True: [[], [], 0]}
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            texts = batch.column("x").to_pylist()
            for is_long, pool in pools.items():
                mine = np.flatnonzero((n > LONG) == is_long)
                # a pool is closed within a batch as often as it fills
                for at in np.split(mine, np.flatnonzero(np.diff((pool[2] + np.cumsum(n[mine])) // (LONG_TOKENS if is_long else SCORE_TOKENS))) + 1):
                    if not len(at):
                        continue
                    pool[0].append(batch.select(kept).take(pa.array(at)))
                    pool[1] += [texts[k] for k in at]
                    pool[2] += int(n[at].sum())
                    if pool[2] >= (LONG_TOKENS if is_long else SCORE_TOKENS):
                        yield scored(pool)
                        pool[:] = [], [], 0
        for pool in pools.values():
            if pool[1]:
                yield scored(pool)

    known = part.select(*kept, "x").mapInArrow(run, "row long, doc_id long, n_tokens long, known long, listed_sum double, rare_sum double, "
                                                    "n_rare long, logp double")
    # tokens off the list meet their counts by token; rows are numbered in the stored table, so the numbers are firm
    tail = part.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.n") \
        .join(counts, "token", "left").groupBy("row").agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("tail_sum"))
    all_log = float(np.log10(vocab.total + ADD * (vocab.kinds + 1)))
    rare_log = float(np.log10(vocab.rare_total + ADD * (vocab.rare_kinds + 1)))
    none = F.lit(0.0)
    return known.join(tail, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("listed_sum") + F.coalesce("tail_sum", none) - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("logp") + F.col("rare_sum") + F.coalesce("tail_sum", none) - F.col("n_rare") * F.lit(rare_log)).alias("score"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a net and counts learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (~held_out(F.col("doc_id"), FOLDS)).alias("learns"),
        (F.floor(crc32_of_id(F.col("doc_id")) / F.lit(FOLDS)) % 8).cast("int").alias("share"))
    counts, _ = materialise(token_counts(docs.where("learns")), "token-counts")
    listed = listed_counts(counts)
    vocab = vocabulary(counts, listed)
    part, _ = materialise(coded(docs, vocab, listed), "lm-codes")
    net = learn(part.where("learns"), vocab)
    return scores(part, counts, vocab, net).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocab.total).cast("long").alias("train_tokens"), "base_score", "score")
