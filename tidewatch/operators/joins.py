"""Joining fitted state to rows without a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 16


def attach(rows: DataFrame, fitted: DataFrame, keys, spread, salts: int = SALTS) -> DataFrame:
    """Left join of a per-key state table to the rows.

    No broadcast is forced: Spark broadcasts the state when its known size is
    under the threshold and shuffles otherwise. For the shuffle the key is
    salted by a hash of ``spread`` (columns that vary inside a key), and the
    state is repeated once per salt, so a key with a third of all rows is
    spread over ``salts`` tasks. State without keys is one aggregate row.
    """
    keys = list(keys)
    spread = [spread] if isinstance(spread, str) else list(spread)
    if not keys:
        one = F.lit(1).alias("_one")
        return rows.select("*", one).join(F.broadcast(fitted.select("*", one)), "_one", "left").drop("_one")
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    salted_state = fitted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_state, [*keys, "_salt"], "left").drop("_salt")
