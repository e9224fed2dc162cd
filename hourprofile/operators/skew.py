"""Many-to-many joins whose left side is crowded on few keys.

A sketch (``approx_top_k``) names the keys that hold many rows. Their rows on the
left are dealt over several salts, by a hash of the row, and the few rows on the right
are copied once per salt; all other keys join as they are. Join tasks are then even
whatever share of the rows one key holds, in every plan that Spark picks for the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that can be salted; the sketch tracks more, so that its counts are close.
HOT_KEYS, TRACKED = 64, 4096
#: Salts per join task for a key that holds all rows, and the fewest rows worth a salt.
SALTS_PER_TASK, LEAST_ROWS = 16, 100
SALT = "_salt"


def hot_keys(df: DataFrame, key: str, tasks: int, limit: int = HOT_KEYS) -> dict[str, int]:
    """key -> number of salts, for the keys with more rows than a salt should have.

    At most ``limit`` entries reach the driver. A key beyond them holds at most 1 /
    ``limit`` of the rows.
    """
    found = df.agg(F.expr(f"approx_top_k({key}, {limit}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("rows")).first()
    target = max(LEAST_ROWS, found["rows"] // (tasks * SALTS_PER_TASK))
    return {t["item"]: -(-t["count"] // target) for t in found["top"] or () if t["item"] is not None and t["count"] > target}


def _salts(key: str, hot: dict[str, int]) -> Column:
    if not hot:
        return F.lit(1)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in sorted(hot.items()) for x in kv])[F.col(key)], F.lit(1))


def salted(left: DataFrame, key: str, hot: dict[str, int]) -> DataFrame:
    """``left`` with the salt of every row (0 for keys that aren't hot)."""
    return left.withColumn(SALT, F.pmod(F.xxhash64(*left.columns), _salts(key, hot)).cast("int"))


def copied(right: DataFrame, key: str, hot: dict[str, int]) -> DataFrame:
    """``right`` once per salt of its key."""
    return right.withColumn(SALT, F.explode(F.sequence(F.lit(0), (_salts(key, hot) - 1).cast("int"))))


def salted_join(right: DataFrame, left: DataFrame, key: str, tasks: int | None = None, keep_salt: bool = False) -> DataFrame:
    """Inner join of ``right`` (few rows a key) with ``left`` (many), column order of
    ``right.join(left, key)``. ``left`` is read twice: once for the sketch."""
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, key, tasks)
    out = copied(right, key, hot).join(salted(left, key, hot), [key, SALT])
    return out if keep_salt else out.drop(SALT)
