"""Benchmark decontamination by the q-gram lemma.

A benchmark item of m characters occurs in a document with at most k edits only
if they share at least m - q + 1 - k*q character q-grams, all of them on
diagonals (document position less item position) that span at most k. So the
shared q-grams are counted in overlapping diagonal bands of width 2(k + 1), one
starting every k + 1 diagonals; a band that reaches the bound is a region worth
looking at, and only those are verified by a banded alignment of the whole item
with the region.

Text and items are compared in lower case with white space runs as one space.
The edit budget is `EDIT_RATE` of the item's characters, lowered for short items
so that the bound stays positive. Items shorter than `MIN_CHARS` characters have no
q-grams to count; they are found without edits, as whole words.

A phrase that many items share and a text repeats gives hits times items. So an
item is looked at only if the text holds enough of its distinct q-grams at all, and
bands are found by its other q-grams: a band that reaches the bound must hold as
many of these as the bound exceeds the item's places in such phrases. The bands
found are then counted whole, place by place. Items that consist of such phrases
are counted by all their hits, in slices of at most `SLICE` pairs.

The q-grams of the items form an index that every task gets. Its size is
checked: items above `BLOCK_CHARS` characters are taken in several blocks, each
one pass over the documents.

Defined results: NULL and empty texts match nothing; NULL and empty items name no
passage and are left out; items with equal texts all match; a document holding an item more than once
gives one row per item, with the best region; repeated rows give repeated
results; empty tables give no matches; other columns pass through the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import named, table

Q = 10
EDIT_RATE = 0.06
MIN_CHARS = 2 * Q
BLOCK_CHARS = 4 << 20  # characters of items in one index
HOT_PAIRS = 1 << 12  # pairs of a hit and an item place, from which on a q-gram of a text finds no bands by itself
SLICE = 1 << 20  # pairs of a hit and an item place that are counted at once
SCAN_CHARS = 1 << 19  # texts are scanned together up to about this size
TABLE_BITS = 22
BASE = 0x9E3779B97F4A7C15


def normal(text: str | None) -> str:
    return " ".join(text.lower().replace("\x00", " ").split()) if text else ""


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def budget(m: int) -> int:
    """Edits allowed for an item of m characters: the q-gram bound stays at q or more."""
    return max(0, min(int(EDIT_RATE * m), (m - 2 * Q + 1) // Q))


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place, built by doubling."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    width, have = 1, codes.astype(np.uint64) + np.uint64(1)
    one, total, done = have, None, 0
    bits = Q
    while bits:
        if bits & 1:
            part = have[done:done + n]
            total = part.copy() if total is None else total * np.uint64(pow(BASE, width, 1 << 64)) + part
            done += width
        bits >>= 1
        if bits:
            have = have[:-width] * np.uint64(pow(BASE, width, 1 << 64)) + have[width:]
            width *= 2
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total


@dataclass
class Index:
    """The q-grams of a block of items; items with equal texts are one."""
    item_ids: list[list]
    texts: list[str]
    lengths: np.ndarray
    budgets: np.ndarray
    bounds: np.ndarray  # shared q-grams needed
    keys: np.ndarray  # distinct q-grams, sorted
    starts: np.ndarray  # of each key's postings
    items: np.ndarray
    places: np.ndarray
    item_starts: np.ndarray  # of each item's q-grams
    item_keys: np.ndarray  # in the order of their places, as numbers of `keys`
    table: np.ndarray  # bit per leading bits of a q-gram
    short: dict[str, list]  # items below MIN_CHARS: ids by text


def build_index(rows: list[tuple[int, str]]) -> Index:
    ids: dict[str, list] = {}
    for i, t in rows:
        ids.setdefault(normal(t), []).append(i)
    kept = [(i, t) for t, i in ids.items() if len(t) >= MIN_CHARS]
    short = {t: i for t, i in ids.items() if 0 < len(t) < MIN_CHARS}
    lengths = np.array([len(t) for _, t in kept], np.int64)
    budgets = np.array([budget(m) for m in lengths], np.int64)
    hashes = [grams(codes_of(t)) for _, t in kept]
    every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes]).astype(np.int64)
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
    order = np.argsort(every, kind="stable")
    keys, starts = np.unique(every[order], return_index=True)
    bits = np.zeros(1 << TABLE_BITS, bool)
    bits[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    sizes = np.array([len(h) for h in hashes], np.int64)
    return Index([i for i, _ in kept], [t for _, t in kept], lengths, budgets, lengths - Q + 1 - budgets * Q,
                 keys, np.append(starts, len(every)), item[order], place[order],
                 np.append(0, np.cumsum(sizes)), np.searchsorted(keys, every), bits, short)


def align(item: np.ndarray, text: np.ndarray, first: int, last: int) -> tuple[int, int, int]:
    """(edits, start, end) of the best alignment of the whole item with a part of
    the text, on the diagonals `first` to `last` only."""
    width = last - first + 1
    far = len(item) + len(text) + 1
    col = np.arange(width)
    # cell (i, c) is text place first + i + c; a start anywhere is free
    at = first + col
    cost = np.where((at >= 0) & (at <= len(text)), 0, far)
    start = at.copy()
    padded = np.concatenate([np.zeros(1, np.uint32), text, np.zeros(1, np.uint32)])
    for i, ch in enumerate(item, 1):
        at = first + i + col
        inside = (at >= 1) & (at <= len(text))
        same = inside & (padded[np.clip(at, 0, len(text))] == ch)
        diag = np.where(inside, cost + ~same, far)  # from (i-1, c): one text character back
        up = np.append(cost[1:] + 1, far)  # item character left out
        up = np.where((at >= 0) & (at <= len(text)), up, far)
        best = np.minimum(diag, up)
        begin = np.where(diag <= up, start, np.append(start[1:], 0))
        # text characters left out: the running minimum along the row
        run = best - col
        low = np.minimum.accumulate(run)
        source = np.maximum.accumulate(np.where(run == low, col, 0))
        cost = np.minimum(low + col, far)
        start = begin[source]
    c = int(np.argmin(cost))
    return int(cost[c]), int(start[c]), int(first + len(item) + c)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... for count[i] numbers, one i after another."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _bands(item: np.ndarray, place: np.ndarray, at: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((item, band) rows, distinct places in each) of hits; each band starts at a multiple of the step and is two steps wide."""
    band = np.floor_divide(at - place, step[item])
    rows = np.concatenate([np.column_stack([item, band, place]), np.column_stack([item, band - 1, place])])
    low = rows.min(axis=0)
    span = (rows.max(axis=0) - low + 1).tolist()
    if span[0] * span[1] * span[2] >= 1 << 62:
        return np.unique(np.unique(rows, axis=0)[:, :2], axis=0, return_counts=True)
    code = np.unique(((rows[:, 0] - low[0]) * span[1] + rows[:, 1] - low[1]) * span[2] + rows[:, 2] - low[2]) // span[2]
    code, seen = np.unique(code, return_counts=True)
    return np.column_stack([code // span[1] + low[0], code % span[1] + low[1]]), seen


def _counted(index: Index, post: np.ndarray, first: np.ndarray, times: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`_bands` of all pairs of the postings `post` and their hits `at[first:first + times]`, slice by slice:
    a posting is in one slice, so the counts of distinct places add up."""
    step = index.budgets + 1
    cuts = np.flatnonzero(np.diff(np.cumsum(times) // SLICE, prepend=0)).tolist()
    parts = [_bands(np.repeat(index.items[post[lo:hi]], times[lo:hi]), np.repeat(index.places[post[lo:hi]], times[lo:hi]),
                    at[_spread(first[lo:hi], times[lo:hi])], step)
             for lo, hi in zip([0, *cuts], [*cuts, len(post)]) if lo < hi]
    if len(parts) < 2:
        return parts[0] if parts else (np.empty((0, 2), np.int64), np.empty(0, np.int64))
    group, back = np.unique(np.concatenate([g for g, _ in parts]), axis=0, return_inverse=True)
    return group, np.bincount(back.ravel(), np.concatenate([n for _, n in parts])).astype(np.int64)


def _shared_in(index: Index, i: int, band: int, held: np.ndarray, first: np.ndarray, times: np.ndarray, at: np.ndarray) -> int:
    """Distinct places of an item whose q-gram the text holds inside the band."""
    step = int(index.budgets[i]) + 1
    own = slice(index.item_starts[i], index.item_starts[i + 1])
    keys, places = index.item_keys[own], np.arange(index.item_starts[i + 1] - index.item_starts[i])
    where = np.searchsorted(held, keys)
    there = np.flatnonzero(held[np.minimum(where, len(held) - 1)] == keys)
    total = 0
    for k, p in zip(where[there].tolist(), places[there].tolist()):
        hits = at[first[k]:first[k] + times[k]]
        total += int(np.searchsorted(hits, band * step + p) < np.searchsorted(hits, (band + 2) * step + p))
    return total


def _regions(index: Index, at: np.ndarray, key: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, first diagonal, shared q-grams) of the bands that reach the bound; `at`: places of hits, `key`: their q-grams."""
    order = np.lexsort((at, key))
    at, (held, first, times) = at[order], np.unique(key[order], return_index=True, return_counts=True)
    count = index.starts[held + 1] - index.starts[held]
    post, mine = _spread(index.starts[held], count), np.repeat(np.arange(len(held)), count)
    # an item needs as many distinct q-grams in the whole text as in a band
    n_items = len(index.bounds)
    enough = np.bincount(index.items[post], minlength=n_items) >= index.bounds
    keep = enough[index.items[post]]
    post, mine = post[keep], mine[keep]
    left = np.bincount(mine, minlength=len(held))
    hot = left * times > HOT_PAIRS
    hot_places = np.bincount(index.items[post][hot[mine]], minlength=n_items)
    need = index.bounds - hot_places
    by_rest = (need > 0)[index.items[post]]
    some = ~(by_rest & hot[mine])  # all postings of the other items
    group, shared = _counted(index, post[some], first[mine[some]], times[mine[some]], at)
    least = np.where(need > 0, need, index.bounds)
    out = []
    for (i, b), n in zip(group[shared >= least[group[:, 0]]].tolist(), shared[shared >= least[group[:, 0]]].tolist()):
        if need[i] > 0 and hot_places[i]:
            n = _shared_in(index, i, b, held, first, times, at)
        if n >= index.bounds[i]:
            out.append((i, b * (int(index.budgets[i]) + 1), int(n)))
    return out


def _short_items(norm: str, index: Index, machine) -> list[tuple[int, int, int, int, int]]:
    """(item id, edits, start, end, shared) of the short items that stand in a normal text as whole words, each at its first place."""
    best: dict[str, int] = {}
    for end, item in machine.iter(f" {norm} "):
        best.setdefault(item, end - len(item) - 1)
    return [(i, 0, at, at + len(item), 0) for item, at in best.items() for i in index.short[item]]


def _machine(index: Index):
    """What finds the short items, None where there are none."""
    if not index.short:
        return None
    import ahocorasick
    machine = ahocorasick.Automaton()
    for item in index.short:
        machine.add_word(f" {item} ", item)
    machine.make_automaton()
    return machine


def scan(texts: list[str | None], index: Index, machine=None) -> list[tuple[int, int, int, int, int, int]]:
    """(text number, item id, edits, start, end, shared q-grams) of the items found in normal texts; `machine` finds the short ones."""
    norms = [normal(t) for t in texts]
    out = [(d, *found) for d, norm in enumerate(norms) for found in _short_items(norm, index, machine)] if machine is not None else []
    return out + _scan_long(norms, index)


def _scan_long(norms: list[str], index: Index) -> list[tuple[int, int, int, int, int, int]]:
    out = []
    if not len(index.keys):
        return out
    # a text is scanned with its neighbours, the separator is in no item
    starts = np.cumsum([0] + [len(t) + 1 for t in norms])
    whole = codes_of("\x00".join(norms))
    if not len(whole):  # a run of one empty text
        return out
    found_at, found_key = [], []
    for lo in range(0, len(whole), SCAN_CHARS):
        h = grams(whole[lo:lo + SCAN_CHARS + Q - 1])
        at = np.flatnonzero(index.table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        key = np.searchsorted(index.keys, h[at])
        key[key == len(index.keys)] = 0
        real = index.keys[key] == h[at]
        found_at.append(at[real] + lo)
        found_key.append(key[real])
    at, key = np.concatenate(found_at), np.concatenate(found_key)
    need, reach = int(index.bounds.min()), int((index.lengths + index.budgets).max())
    if len(at) < need:
        return out
    # only places with enough hits around them can lie in a region
    dense = at[need - 1:] - at[:len(at) - need + 1] <= reach
    mark = np.zeros(len(at) + 1, np.int64)
    first = np.flatnonzero(dense)
    np.add.at(mark, first, 1)
    np.add.at(mark, first + need, -1)
    keep = np.cumsum(mark)[:-1] > 0
    at, key = at[keep], key[keep]
    owner = np.searchsorted(starts, at, side="right") - 1
    for d in np.unique(owner):
        mine = owner == d
        best: dict[int, tuple] = {}
        codes = None
        for i, diag, shared in _regions(index, at[mine] - starts[d], key[mine]):
            k, m = int(index.budgets[i]), int(index.lengths[i])
            if i in best and best[i][0] == 0:
                continue
            lo = max(0, diag - k)
            spot = norms[d].find(index.texts[i], lo, max(0, diag) + 3 * (k + 1) + m)
            if spot >= 0:  # no edits: the alignment is plain
                best[i] = (0, spot, spot + m, shared)
                continue
            if codes is None:
                codes = codes_of(norms[d])
            lo, hi = max(0, diag - 1), min(len(codes), max(0, diag) + 2 * (k + 1) + m + k + 1)
            edits, a, b = align(codes_of(index.texts[i]), codes[lo:hi], diag - lo, diag - lo + 2 * (k + 1))
            if edits <= k and (i not in best or (edits, a + lo) < best[i][:2]):
                best[i] = (edits, a + lo, b + lo, shared)
        out += [(int(d), item_id, *found) for i, found in sorted(best.items()) for item_id in index.item_ids[i]]
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """The items in blocks of bounded size."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")  # an item without an id is reported without one
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    count = max(1, math.ceil(2 * total / BLOCK_CHARS)) if total > BLOCK_CHARS else 1
    for b in range(count):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == b) if count > 1 else items
        yield build_index([(r["i"], r["t"]) for r in part.collect()])


def _scanned(batch: pa.RecordBatch, text_col: str, index: Index) -> Iterator[tuple[int, int, list]]:
    """(first row, rows, matches) of runs of rows whose texts together have a bounded size."""
    texts, machine = batch.column(text_col).to_pylist(), _machine(index)
    lo, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text or "")
        if size >= SCAN_CHARS or n == len(texts) - 1:
            yield lo, n + 1 - lo, scan(texts[lo:n + 1], index, machine)
            lo, size = n + 1, 0


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, match_start, match_end, shared_qgrams) of each item found in each document;
    the places are those in the text in lower case with single spaces."""
    schema = "doc_id long, item_id long, edits int, match_start long, match_end long, shared_qgrams int"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    names = [c.split()[0] for c in schema.split(", ")]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in _blocks(benchmark, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by BLOCK_CHARS

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for lo, _, found in _scanned(batch, "text", index):
                    rows = [(ids[lo + d], *rest) for d, *rest in found]
                    if rows:
                        ordered = [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ordered), kinds)], names=names)

        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """The documents in which no item is found."""
    out = docs
    for index in _blocks(benchmark, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by BLOCK_CHARS

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for lo, n, found in _scanned(batch, text_col, index):
                    bad = {d for d, *_ in found}
                    part = batch.slice(lo, n)
                    yield part.filter(pa.array([d not in bad for d in range(n)])) if bad else part

        out = out.select(*named(docs.schema.fields)).mapInArrow(run, docs.schema)
    return out


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any document."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
