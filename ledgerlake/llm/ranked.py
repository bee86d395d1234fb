"""Ranked lexical search by the Best Position Algorithm.

Scores are sums of term impacts (see `impact_of`). First the whole collection is
counted: documents with terms, their terms, and the documents that hold each
query term. Each document's counts of query terms are written once, so that
texts are read one time.

Documents are then indexed in blocks of bounded size. In a block every query
term has an impact list, its documents by falling impact. For an item the lists
of its terms are read from the top. A document met for the first time is looked
up in all other lists at once by direct access, which gives its whole score and
marks its position in each list as seen. The best position of a list is the end
of its contiguous seen part from the top; it runs ahead of the last position
read, as direct accesses fill gaps. No unseen document can score above the sum
of the impacts at the best positions, so reading stops as soon as this bound is
strictly below the k-th best score (at an equal score a smaller id could still
follow). Blocks that a task reads one after another share the k-th best score.
Tasks hand on their k best documents for each item, and these are merged.

The items' terms go to every task. Their size is checked: items above
`ITEM_CHARS` characters are searched in several blocks.

Defined results: NULL and empty texts hold no term, and texts without terms are
not counted; items without terms have no rows; items equal in id and text count
once, items with one id and different texts are ranked each on their own;
documents without an id are ranked after all others at an equal score; repeated
documents are ranked each on their own; empty tables give no rows; other columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import table
from ledgerlake.session import materialise

TOP = 10
ITEM_CHARS = 4 << 20  # characters of items that are searched together
BLOCK_POSTINGS = 1 << 20  # postings of a block of documents
BLOCK_DOCS = 1 << 15
WINDOW = 1 << 20  # bytes of a text that are split at once
FIRST_DEPTH = 8  # positions read in the first step; doubled in each further one
MERGES = 64  # parts in which the tasks' results for an item are merged first
NO_ID = np.iinfo(np.int64).max

# a term is a run of ASCII letters, digits and bytes of other characters; ASCII capitals are lowered
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(text: str | None) -> tuple[int, Counter]:
    """(number of terms, occurrences of each) of a whole text, taken window by window."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    counts: Counter = Counter()
    total = at = 0
    while at < len(data):
        end = data.find(b" ", at + WINDOW)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        total += len(words)
        counts.update(words)
        at = end
    return total, counts


def weight_of(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with these numbers of terms, exact at any size."""
    most = 75 * int(lengths.max(initial=0)) * n_docs
    exact = lengths if most < 1 << 62 else lengths.astype(object)
    return (25 + (75 * exact * n_docs) // max(n_terms, 1)).astype(np.int64)


def impact_of(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Queries:
    """Items whose terms are numbered: `terms` numbers them, `items` lists (key, term numbers, how often each)."""

    terms: dict[bytes, int]
    items: list[tuple[int, np.ndarray, np.ndarray]]


def numbered(items: list[tuple[int, str]]) -> Queries:
    terms: dict[bytes, int] = {}
    out = []
    for key, text in items:
        _, counts = term_counts(text)
        if counts:
            numbers = np.array([terms.setdefault(t, len(terms)) for t in counts], np.int64)
            out.append((key, numbers, np.array(list(counts.values()), np.int64)))
    return Queries(terms, out)


class Block:
    """Impact lists of a block of documents, with direct access by document.

    Postings lie by document (`terms`, `impacts`, from `starts`); list t holds
    `docs[begin[t]:begin[t + 1]]` by falling impact, and `place` is where each
    document's posting stands in its list.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int) -> None:
        some = impacts > 0
        owner = np.repeat(np.arange(len(ids)), lengths)[some]
        self.ids, self.terms, self.impacts = ids, terms[some], impacts[some]
        self.starts = np.searchsorted(owner, np.arange(len(ids) + 1))
        order = np.lexsort((-self.impacts, self.terms))
        self.docs, self.falling = owner[order], self.impacts[order]
        self.begin = np.searchsorted(self.terms[order], np.arange(n_terms + 1))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.met = np.zeros(len(ids), bool)
        self.slot = np.full(n_terms, -1, np.int64)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, positions read) of the k best; all documents that could reach `floor` are among those met."""
        begin, size = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        some = size > 0
        terms, times, begin, size = terms[some], times[some], begin[some], size[some]
        if not len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        self.slot[terms] = np.arange(len(terms))
        first = np.concatenate([[0], np.cumsum(size)])
        seen = np.zeros(first[-1], bool)  # the lists' positions, one list after another
        best = np.zeros(len(terms), np.int64)  # positions from the top that are all seen
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth = FIRST_DEPTH
        while True:
            # sorted access: the next positions after each best position
            ends = np.minimum(best + depth, size)
            found = np.unique(np.concatenate([self.docs[b + lo:b + hi] for b, lo, hi in zip(begin, best, ends)]))
            new = found[~self.met[found]]
            self.met[new] = True
            # direct access: the postings of the new documents in all lists
            lo, n = self.starts[new], self.starts[new + 1] - self.starts[new]
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else lo, n) + np.arange(n.sum())
            owner = np.repeat(np.arange(len(new)), n)
            slot = self.slot[self.terms[at]]
            mine = slot >= 0
            at, owner, slot = at[mine], owner[mine], slot[mine]
            total = np.zeros(len(new), np.int64)
            np.add.at(total, owner, self.impacts[at] * times[slot])
            seen[first[slot] + self.place[at] - begin[slot]] = True
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, total])
            for t in range(len(terms)):
                part = seen[first[t] + best[t]:first[t + 1]]
                gap = part.argmin() if len(part) else 0
                best[t] += len(part) if len(part) and part[gap] else gap
            # what an unseen document can score at most: one at the best position itself is seen
            left = best < size
            bound = int((self.falling[(begin + best)[left] - (best[left] > 0)] * times[left]).sum())
            reached = floor
            if len(scores) >= k:
                reached = max(reached, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            if not left.any() or bound < reached:
                break
            depth *= 2
        self.met[docs] = False
        self.slot[terms] = -1
        top = np.lexsort((self.ids[docs], -scores))[:k]
        return docs[top], scores[top], int(best.sum())


def counted(docs: DataFrame, queries: Queries, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of each document with terms: its counts of query terms as packed 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.terms)  # bounded by ITEM_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        known = number.keys()
        for batch in batches:
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                n, counts = term_counts(batch.column("text")[i].as_py())
                if n:
                    mine = counts.keys() & known
                    t = np.fromiter(map(number.__getitem__, mine), np.int32, len(mine))
                    tf = np.fromiter(map(counts.__getitem__, mine), np.int32, len(mine))
                    rows.append((batch.column("id")[i].as_py(), n, t.tobytes(), tf.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _COUNT_KINDS)],
                                                 names=["id", "n", "terms", "tfs"])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "id long, n long, terms binary, tfs binary")


_COUNT_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _document_counts(counts: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each query term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in counts.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]  # a row for each query term
    return out


def _blocks_of(batches: Iterator[pa.RecordBatch], block_postings: int, block_docs: int) -> Iterator[pa.Table]:
    """The rows in blocks of bounded numbers of documents and postings."""
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for batch in batches:
        sizes = np.array([len(x) // 4 for x in batch.column("terms").to_pylist()], np.int64)
        lo = 0
        for i, size in enumerate(sizes):
            if docs and (docs >= block_docs or postings + size > block_postings):
                held.append(batch.slice(lo, i - lo))
                yield pa.Table.from_batches(held)
                held, lo, docs, postings = [], i, 0, 0
            docs += 1
            postings += int(size)
        held.append(batch.slice(lo))
    if docs:
        yield pa.Table.from_batches(held)


def _searched(counts: DataFrame, queries: Queries, weights: np.ndarray, n_docs: int, n_terms: int, k: int,
              block_postings: int, block_docs: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each task for each item."""
    shared = counts.sparkSession.sparkContext.broadcast((queries.items, weights))  # bounded by ITEM_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w = shared.value
        held = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
        for t in _blocks_of(batches, block_postings, block_docs):
            ids = t.column("id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
            terms = [np.frombuffer(x, np.int32) for x in t.column("terms").to_pylist()]
            lengths = np.array([len(x) for x in terms], np.int64)
            flat = np.concatenate(terms).astype(np.int64)
            tf = np.frombuffer(b"".join(t.column("tfs").to_pylist()), np.int32).astype(np.int64)
            m = length_norms(t.column("n").to_numpy(), n_docs, n_terms)
            block = Block(ids, lengths, flat, impact_of(w[flat], tf, np.repeat(m, lengths)), len(w))
            for q, (_, numbers, times) in enumerate(items):
                old_ids, old = held[q]
                docs, scores, _ = block.search(numbers, times, k, int(old[-1]) if len(old) == k else 1)
                both_ids, both = np.concatenate([old_ids, ids[docs]]), np.concatenate([old, scores])
                top = np.lexsort((both_ids, -both))[:k]
                held[q] = both_ids[top], both[top]
        sizes = [len(s) for _, s in held]
        if sum(sizes):
            doc_ids = np.concatenate([i for i, _ in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([key for key, *_ in items], np.int64), sizes)),
                 pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(np.concatenate([s for _, s in held]))],
                names=["item", "doc_id", "score"])

    return counts.mapInArrow(run, "item long, doc_id long, score long")


def _item_blocks(items: DataFrame) -> Iterator[DataFrame]:
    """The items in blocks of about `ITEM_CHARS` characters, dealt by number."""
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    count = max(1, math.ceil(2 * total / ITEM_CHARS)) if total > ITEM_CHARS else 1
    for b in range(count):
        yield items.where(F.pmod(F.xxhash64("item"), F.lit(count)) == b) if count > 1 else items


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", block_postings: int = BLOCK_POSTINGS,
           block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 for each item."""
    asked, _ = materialise(items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("t"))
                           .distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    out = None
    for part in _item_blocks(asked.where("t IS NOT NULL")):
        queries = numbered([(r["item"], r["t"]) for r in part.select("item", "t").collect()])  # ITEM_CHARS
        counts, _ = materialise(counted(docs, queries, id_col, text_col), "term-counts")
        n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = _document_counts(counts, len(queries.terms))
        weights = np.array([weight_of(n_docs, int(d)) for d in df], np.int64)
        found = _searched(counts, queries, weights, n_docs, n_terms, k, block_postings, block_docs)
        out = found if out is None else out.unionByName(found)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # in two steps, so that the rows of all tasks for one item do not meet at once
    for keys in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(MERGES))], ["item"]):
        out = out.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return out.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_sql(k: int = TOP) -> str:
    return rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY term, docs
), impact AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS score
  FROM tf JOIN weight USING (term) JOIN lengths USING (doc_id), whole
), scored AS (
  SELECT item_id, doc_id, sum(score)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
