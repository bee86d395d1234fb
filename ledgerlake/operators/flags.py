"""Existence flags computed set-wise.

The reference probes the ledger once per staged row (correlated lookups with
ROWNUM = 1). Here each probe becomes an aggregate flag per key, computed once
per batch and attached with one left join:

* the aggregate combines map-side, so a key holding a third of all ledger rows
  costs one partial-aggregate row per input partition, not a hot reduce task;
* the flag table is unique per key, so the join never fans out;
* for a batch with a measured bound on its keys (KeyScope) the ledger is
  pre-filtered in its scan tasks and the small flag table is broadcast by AQE
  at run time; above the bound, hot keys are salted (AQE's own skew split does
  not apply when one join side is an aggregate on the join key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


# a side is broadcast only when its measured bytes are at most this
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of `df` in memory, measured in one aggregate: 16 per
    column and row, and the length of every text."""
    sizes = [F.octet_length(F.col(f"`{n}`").cast("binary")) for n, t in df.dtypes if t in ("string", "binary")]
    text = sum((F.coalesce(x, F.lit(0)) for x in sizes), F.lit(0)).cast("long")
    return int(df.agg(F.coalesce(F.sum(text + F.lit(16 * (len(df.columns) + 1))), F.lit(0)).alias("b")).first()["b"])


def bounded(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """`broadcast(df)` once its measured bytes are within the bound; else `df`."""
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    return F.broadcast(df) if measured_bytes(df) <= limit else df


class KeyScope:
    """The distinct keys of a batch, counted once.

    An upload batch is small next to the ledger. When its distinct keys have at
    most `max_bytes` bytes (measured), they are broadcast and
    the ledger/master are filtered in their scan tasks (left-semi join) before
    any shuffle. Every flag table built from such restricted inputs has at most
    as many rows as the batch has keys, so it stays small enough for AQE's
    run-time broadcast. Larger batches skip the pre-filter and join with hot
    keys salted."""

    def __init__(self, batch: DataFrame, keys: Sequence[str], max_bytes: int | None = None):
        self.keys = list(keys)
        limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
        distinct = batch.select(*self.keys).dropna().dropDuplicates()
        self.small = measured_bytes(distinct) <= limit
        self.key_table = F.broadcast(distinct) if self.small else None
        self._buckets: list[int] | None = None

    def restrict(self, big: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
        """Rows of `big` whose keys occur in the batch (unchanged when large).
        `rename` maps a batch key name to its name in `big`."""
        if not self.small:
            return big
        rename = rename or {}
        kt = self.key_table.select(*[F.col(k).alias(rename.get(k, k)) for k in self.keys])
        on = [rename.get(k, k) for k in self.keys]
        if "deal_bucket" in big.columns and "deal_id" in on:
            # a ledger stored by deal bucket: read only the buckets of the
            # batch's deals (at most DEAL_BUCKETS small ints, a bounded list)
            big = big.filter(F.col("deal_bucket").isin(self.buckets()))
        return big.join(F.broadcast(kt), on, "left_semi")

    def buckets(self) -> list[int]:
        """Deal buckets of the batch keys (computed once)."""
        if self._buckets is None:
            from ledgerlake.schemas import deal_bucket
            rows = self.key_table.select(deal_bucket("deal_id").alias("b")).distinct().collect()
            self._buckets = sorted(r["b"] for r in rows)
        return self._buckets

    def attach(self, left: DataFrame, flags: DataFrame, keys: Sequence[str] | None = None,
               on: Column | None = None, defaults: dict | None = None) -> DataFrame:
        return attach(left, flags, keys, on, defaults, small=self.small)


def restrict_to_keys(big: DataFrame, small: DataFrame, keys: Sequence[str],
                     max_bytes: int | None = None) -> DataFrame:
    """Keep only rows of `big` whose keys occur in `small` (see KeyScope)."""
    return KeyScope(small, keys, max_bytes).restrict(big)


def any_of(cond: Column) -> Column:
    """EXISTS over a group: true if some row satisfies `cond` (NULL counts as no)."""
    return F.coalesce(F.bool_or(F.coalesce(cond, F.lit(False))), F.lit(False))


# salting of hot keys when the flag table is too large to broadcast
SALT_BUCKETS = 256  # many more than shuffle partitions, so hashed buckets even out
HOT_KEY_SHARE = 0.001      # a key with more than this share of the batch rows is hot (<= 1000 keys)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_KEY_SHARE) -> DataFrame:
    """Keys holding more than `share` of the rows of `df`. There can be at most
    1/share of them, so the result has a size bound by construction."""
    total = df.count()
    counts = df.groupBy(*keys).count()
    return counts.filter(F.col("count") > max(1, int(total * share))).select(*keys)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                buckets: int | None = None) -> DataFrame:
    """Equi-join where `right` has one row per key: rows of hot keys on the
    left are spread over `buckets` tasks and their right row is repeated that
    many times; other keys join as usual. Rows with a NULL key match nothing
    and are spread as well."""
    buckets = buckets or SALT_BUCKETS
    # at most 1 / HOT_KEY_SHARE keys: a proven bound, broadcast without a count
    hot = F.broadcast(hot_keys(left, keys).withColumn("_hot", F.lit(True)))
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    l2 = (left.join(hot, list(keys), "left")
          .withColumn("_salt", F.when(F.col("_hot") | no_key, F.pmod(row_hash, F.lit(buckets).cast("long")))
                      .otherwise(F.lit(0).cast("long")))
          .drop("_hot"))
    r2 = (right.join(hot, list(keys), "left")
          .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"),
                                                                          F.lit(buckets - 1).cast("long")))
                                          .otherwise(F.array(F.lit(0).cast("long")))))
          .drop("_hot"))
    return l2.join(r2, [*keys, "_salt"], how).drop("_salt")


def attach(left: DataFrame, flags: DataFrame, keys: Sequence[str] | None = None,
           on: Column | None = None, defaults: dict | None = None, small: bool | None = None) -> DataFrame:
    """Left-join a per-key flag table. Boolean flags of unmatched rows become
    False; other columns keep NULL unless `defaults` names a value. NULL keys
    never match, as in SQL.

    The rows of hot and of NULL keys are salted, so no key's rows end up in one
    task whatever the size of the flag table. Only where the keys are few enough
    that the table fits a broadcast (`small`: measured by KeyScope, or here) is
    it joined plainly: AQE measures it again and broadcasts it."""
    defaults = dict(defaults or {})
    for field in flags.schema.fields:
        if field.name in (keys or []) or field.name in defaults:
            continue
        if field.dataType.typeName() == "boolean":
            defaults[field.name] = False
    if small is None:
        small = measured_bytes(flags) <= MAX_BROADCAST_BYTES
    if on is not None:
        joined = left.join(flags, on, "left")
    elif small:
        joined = left.join(flags, list(keys), "left")
    else:
        joined = salted_join(left, flags, list(keys), "left")
    fills = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if v is not None}
    return joined.withColumns(fills) if fills else joined
