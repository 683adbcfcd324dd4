"""One person in several lists: matches by keys of falling trust, and records joined into persons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.functions.tables import written

ROUNDS = 40


def match_by_tiers(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: Sequence[Sequence[str]], newest: str | None = None) -> DataFrame:
    """(left_id, right_id, tier): for each row of left the row of right that agrees on the columns of the first tier it can;
    of several the newest, then the first by id. Tiers are lists of columns that both sides have; nulls agree with nothing. newest
    is a number that grows with time."""
    found = None
    for k, columns in enumerate(tiers, 1):
        a = left.select(left_id, *columns).dropna()
        b = right.select(right_id, *columns, *([newest] if newest else [])).dropna(subset=list(columns))
        order = F.struct(*([F.lit(0) - F.col(newest)] if newest else []), F.col(right_id))
        first = b.groupBy(*columns).agg(F.min_by(right_id, order).alias(right_id))  # one row a key: nothing multiplies
        met = a.join(first, list(columns)).select(left_id, right_id, F.lit(k).alias("tier"))
        found = met if found is None else found.union(met)
    return found.groupBy(left_id).agg(F.min(F.struct("tier", right_id)).alias("m")).select(left_id, f"m.{right_id}", "m.tier")


def components(rows: DataFrame, id_col: str, keys: Sequence[str], rounds: int = ROUNDS) -> DataFrame:
    """(id, person): the least id that can be reached over rows which agree on one of the keys; nulls agree with nothing.

    Each round takes the least person among all rows of a key, then among all keys of a row, and follows the person's own
    person, so that chains shrink by jumps. Minima are taken map-side: the rows of a key are never gathered.
    """
    each = F.filter(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k).cast("string").alias("value")) for i, k in enumerate(keys)]), lambda x: x["value"].isNotNull())
    links = written(rows.select(F.col(id_col).alias("id"), F.explode(each).alias("k")).select("id", F.xxhash64("k.kind", "k.value").alias("h"), "k.value").distinct(), "keys")
    ids = rows.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    person = written(ids.withColumn("person", F.col("id")), "persons")
    for _ in range(rounds):
        by_key = links.join(person.hint("merge"), "id").groupBy("h", "value").agg(F.min("person").alias("p"))
        by_row = links.join(by_key.hint("merge"), ["h", "value"]).groupBy("id").agg(F.min("p").alias("p"))
        least = written(person.join(by_row.hint("merge"), "id", "left").select("id", "person", F.least("person", "p").alias("p")), "least")
        jump = least.select(F.col("id").alias("p"), F.col("p").alias("pp"))
        after = written(least.join(jump.hint("merge"), "p").select("id", "person", "pp"), "jumped")
        changed = not after.where("pp <> person").isEmpty()
        person = after.select("id", F.col("pp").alias("person"))
        if not changed:
            return person
    raise RuntimeError(f"persons still change after {rounds} rounds")


def identities(rows: DataFrame, id_col: str, keys: Sequence[str], newest: str, surname: Column, initial: Column) -> DataFrame:
    """(id, person, survivor, possible): records that agree on a key, over any number of steps, are one person, who is known
    by the newest record (the first by id of equals). possible says how many other persons have a record with the same surname
    and initial: they may be the same, and are left apart."""
    r = rows.select(F.col(id_col).alias("id"), F.col(newest).alias("when"), F.concat_ws(" ", F.lower(surname), F.lower(F.left(initial, F.lit(1)))).alias("about"), (surname.isNotNull() & initial.isNotNull()).alias("named"))
    known = written(r.join(components(rows, id_col, keys).hint("merge"), "id"), "known")
    survivors = known.groupBy("person").agg(F.min_by("id", F.struct(F.col("when").isNull(), F.lit(0) - F.col("when"), F.col("id"))).alias("survivor"))
    alike = known.where("named").groupBy("about").agg(F.count_distinct("person").alias("n"))
    found = known.join(survivors.hint("merge"), "person").join(alike.hint("merge"), "about", "left")
    possible = F.when(F.col("named"), F.col("n") - 1).otherwise(0).cast("int")
    return found.select(F.col("id").alias(id_col), "person", "survivor", possible.alias("possible"))
