"""Left joins that survive heavy keys.

Default ids (0), blanks and NULLs gather on one key, so an exchange on the key
alone sends a third of the rows to one task. Here the join's key gets a salt: rows
whose key is NULL, which match nothing, have a hash of the row as salt; rows of a heavy key over as many salts as the key's share of the tasks, and
the right side's rows of that key are repeated for each salt. All other rows have
salt 0. The result is that of the plain join.

Heavy keys are found by Spark's mergeable top-k sketch, in one pass over the
columns in question. At most ``TOP`` values per column come to the driver, and the copies
made of the right side's heavy rows are about four per task, over all heavy values. Keys
lighter than that are left to Spark's own splitting of skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Heavy values kept per column, at most, and values that the sketch tracks.
TOP, TRACKED = 128, 8192
_SALT = "__salt"


def dealt(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, to be met by a sort-merge join.

    A broadcast passes through the driver whole and stands there as a hash table, several times the size that the planner
    judged it by; a build with dozens of joins holds as many at once. Tables of fixed size need no such mark."""
    return df.hint("merge")


def heavy_values(df: DataFrame, columns: Sequence[str], tasks: int) -> dict[str, dict[object, int]]:
    """Per column its heavy values, and over how many salts the rows of each are to be dealt.

    Heavy is a value with an eighth of the rows of an even task or a 128th of all, whichever is more; a salt
    holds a quarter of a task's rows, so that what falls on one task by chance stays small."""
    sketch = [F.expr(f"approx_top_k({c}, {TOP}, {TRACKED})").alias(c) for c in columns]
    row = df.agg(F.count("*").alias("__n"), *sketch).first()
    least = max(row["__n"] / tasks / 8, row["__n"] / TOP, 1)
    out = {}
    for c in columns:
        found = [(x["item"], x["count"]) for x in row[c] or () if x["item"] is not None]
        out[c] = {v: -(-4 * n * tasks // row["__n"]) for v, n in found if n >= least}
    return out


@dataclass(frozen=True)
class Skew:
    """How to salt the joins of a chain: the left columns that tell rows apart, and the heavy
    values by the name that join steps give their key."""

    row: Sequence[str]
    heavy: Mapping[str, Mapping[object, int]] = field(default_factory=dict)

    def _salts(self, key: Column, name: str) -> Column:
        """Salts of a key's value; NULL where it is not heavy."""
        out = F.lit(None).cast("long")
        for value, salts in self.heavy.get(name, {}).items():
            out = F.when(key == F.lit(value), F.lit(salts).cast("long")).otherwise(out)
        return out

    def salted(self, right: DataFrame, alias: str, left_key: Column, right_key: str, name: str) -> tuple[DataFrame, Column]:
        """The right side with a salt column, and the condition that both sides' salts are equal."""
        draw = F.xxhash64(*[F.col(c) for c in self.row])
        salts = self._salts(left_key, name)
        own = F.when(left_key.isNull(), draw).when(salts.isNotNull(), F.pmod(draw, salts)).otherwise(F.lit(0))
        if self.heavy.get(name):
            last = F.coalesce(self._salts(F.col(right_key), name), F.lit(1)) - 1
            dealt = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), last)))
        else:
            # zero for every row, but no constant: a constant would take the salt out of the join's keys
            dealt = right.withColumn(_SALT, F.pmod(F.xxhash64(right_key), F.lit(1)))
        return dealt, own == F.col(f"{alias}.{_SALT}")
