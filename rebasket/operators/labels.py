"""Labels, train and test rows, holdout and sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.functions.keys import PAIR, hash_bucket, hash_number
from rebasket.operators.running import range_blocks, running_totals
from rebasket.session import stored

IDS = ["user_id", "product_id", "order_id", "eval_set"]
LABEL = "reordered"


def train_lines(order_products_train: DataFrame, orders: DataFrame) -> DataFrame:
    """The lines of the train orders with their user; other orders are not read."""
    train = orders.where(F.col("eval_set") == "train").select("order_id", "user_id")
    return order_products_train.join(train, "order_id")


def candidate_orders(orders: DataFrame) -> DataFrame:
    """Each user's order to predict. A missing eval_set is not a candidate."""
    return orders.where(F.col("eval_set") != "prior").select("user_id", "order_id", "eval_set")


def labelled(features: DataFrame, candidates: DataFrame, lines: DataFrame) -> DataFrame:
    """Feature rows with their candidate order and label."""
    return with_labels(features.join(candidates, "user_id"), lines)


def with_labels(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows that know their candidate order, with the label.

    Train rows without a matching line get 0, test rows stay NULL. Repeated
    lines of a pair are merged first, so the join never adds rows.
    """
    return filled(rows.join(pair_labels(lines), PAIR, "left"))


def pair_labels(lines: DataFrame) -> DataFrame:
    """One label per user and product."""
    return lines.groupBy(*PAIR).agg(F.max(LABEL).alias(LABEL))


def filled(rows: DataFrame) -> DataFrame:
    """Rows that know their candidate order and their pair's label: 0 for train rows without one."""
    label = F.when(F.col("eval_set") == "train", F.coalesce(LABEL, F.lit(0))).otherwise(F.col(LABEL))
    return rows.withColumn(LABEL, label.cast("int"))


def split_train_test(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train rows with label, test rows without. Ids stay in the row; the model
    reads the feature columns only."""
    train = rows.where(F.col("eval_set") == "train")
    test = rows.where(F.col("eval_set") == "test").drop(LABEL)
    return train, test


def holdout(train: DataFrame, percent: int = 20, by: list[str] = PAIR,
            seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(fit rows, validation rows), cut by a hash of the key: repeatable."""
    bucket = hash_bucket(by, 100, seed)
    return train.where(bucket >= percent), train.where(bucket < percent)


def random_holdout(train: DataFrame, fraction: float = 0.8, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Random cut; repeatable only while the input partitions stay the same."""
    kept, rest = train.randomSplit([fraction, 1.0 - fraction], seed)
    return kept, rest


def sample(train: DataFrame, percent: int = 10, by: list[str] = PAIR, seed: int = 1) -> DataFrame:
    """Keep a share of the rows by a seeded hash of the key."""
    return train.where(hash_bucket(by, 100, seed) < percent)


def random_sample(train: DataFrame, fraction: float = 0.1, seed: int = 1) -> DataFrame:
    return train.sample(fraction, seed)


_LEVEL_BITS = 15


def _cut(numbers: DataFrame, count: int, bits: int) -> tuple[int, int]:
    """(cut, left): the ``count`` least numbers are those below the cut and ``left`` of those that equal it.

    ``numbers`` has one column ``number`` of ``bits`` bits. Each level counts the rows
    by the next fifteen bits of the numbers that share the bits found so far; its
    32,768 counts at most come to the driver, whatever the rows.
    """
    found, left = 0, count
    for shift in range(bits - _LEVEL_BITS, -1, -_LEVEL_BITS):
        inside = numbers.where(F.shiftright("number", shift + _LEVEL_BITS) == found)
        step = F.shiftright("number", shift).bitwiseAND(F.lit((1 << _LEVEL_BITS) - 1))
        counts = inside.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
        at = 0
        for r in sorted(counts, key=lambda r: r.step):
            at = r.step
            if r.n > left:
                break
            left -= r.n
            at = r.step + 1
        found = (found << _LEVEL_BITS) + at
        if left == 0 or not counts or at > max(r.step for r in counts):
            return found << shift, 0
    return found, left


def exact_split(rows: DataFrame, count: int, by: list[str] = PAIR, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rest): exactly ``count`` rows (all, if there are fewer), those of the least hash of the key.

    Nothing is sorted: the cut is found from counts of the hash's leading bits.
    Rows of one hash at the cut, mostly one, are told apart by a number each,
    and cut the same way. ``rows`` is read several times: store it first.
    """
    numbered = rows.withColumn("_number", F.coalesce(hash_number(by, seed), F.lit(0)))
    cut, left = _cut(numbered.select(F.col("_number").alias("number")), max(count, 0), 60)
    below, above_ = numbered.where(F.col("_number") < cut), numbered.where(F.col("_number") > cut)
    equal = numbered.where(F.col("_number") == cut)
    if left == 0:
        kept, rest = below, numbered.where(F.col("_number") >= cut)
    else:
        tied = stored(equal.withColumn("_row", F.monotonically_increasing_id()), "tied")
        row, over = _cut(tied.select(F.col("_row").alias("number")), left, 60)
        first = F.col("_row") <= row if over else F.col("_row") < row
        kept = below.unionByName(tied.where(first).drop("_row"))
        rest = above_.unionByName(tied.where(~first).drop("_row"))
    return kept.drop("_number"), rest.drop("_number")


def exact_sample(train: DataFrame, fraction: float = 0.1, by: list[str] = PAIR, seed: int = 1) -> DataFrame:
    """Exactly that share of the rows, the count rounded half to even."""
    train = stored(train, "sampled-from")
    return exact_split(train, round(train.count() * fraction), by, seed)[0]


def exact_holdout(train: DataFrame, count: int = 20_000, by: list[str] = PAIR,
                  seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(fit rows, validation rows), exactly ``count`` of them for validation."""
    held, kept = exact_split(stored(train, "held-from"), count, by, seed)
    return kept, held


def label_folds(train: DataFrame, folds: int = 3, label: str = LABEL, by: list[str] = PAIR, seed: int = 1,
                per_block: int | None = None) -> DataFrame:
    """The rows with ``fold`` 0..folds - 1: those of each label dealt in turn, by rank of the key's hash.

    The folds' rows of a label differ by one at most; a missing label is a label like
    any other. Ranks are running totals over blocks, so a label with most
    of the rows is no single task's.
    """
    keyed = stored(train.withColumns({"_number": F.coalesce(hash_number(by, seed), F.lit(0)), "_one": F.lit(1)}), "dealt")
    ranged = range_blocks(keyed, [label, "_number", *by], "dealt-blocks", per_block)
    ranked = running_totals(ranged, [label], F.col("block"), ["_number", *by], ["_one"])
    return ranked.withColumn("fold", (F.col("_one_before") % folds).cast("int")).drop(
        "_number", "_one", "_one_before", "_one_total", "block")
