"""JN7 price enrichment, JN9 recombination and AG4 totals.

Form 1 (the core): a left join of the parts to a price table. Each car is exploded into
one lookup row per part kind, the lookups are joined to the price table once (broadcast
when the table passes a bounded size check, else a shuffle join on the id), and the
prices are folded back per car. A car that lacks the part gets MISSING_<kind> and no
lookup; a lookup with no price fails the car (FAILED_GET_PRICE, total -1.0).

Form 2: the same fold, but prices come from a user ``fetch`` (e.g. a remote service)
called from ``mapInPandas`` with a bounded number of calls in flight per task, a
per-call timeout and fixed-delay retries.
"""

from __future__ import annotations

import concurrent.futures as cf
import threading
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.scalars import money
from partflow.operators.sizing import bounded_broadcast
from partflow.schemas import (LOOKUP_CAPACITY, LOOKUP_RETRIES, LOOKUP_RETRY_DELAY_S,
                              LOOKUP_TIMEOUT_S, WHEEL_PRICE_FACTOR)

WHEEL_FACTOR = WHEEL_PRICE_FACTOR  # wheel price counts four times, whatever the count


def _lookups(cars: DataFrame, car_key: list[str], ids: dict[str, Column]) -> DataFrame:
    """One lookup row per car and part kind; the car record rides on the first one only,
    so the fold below needs no join back to the cars (and the cars are read once)."""
    payload = [c for c in cars.columns if c not in car_key]
    first = next(iter(ids))
    # Ids may be numbers or text; both sides of the lookup compare them as text.
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), e.cast("string").alias("id"))
                     for k, e in ids.items()])
    return (cars.select(*car_key, F.struct(*payload).alias("_car"), F.inline(rows))
            .withColumn("_car", F.when(F.col("kind") == first, F.col("_car"))))


def _fold(found: DataFrame, car_key: list[str], kinds: list[str]) -> DataFrame:
    """Back to one row per car: its record, the price per kind and whether that lookup
    failed. ``car_key`` identifies a car with deterministic columns, so a task redone
    after an executor loss regroups the same cars. Grouping by the car key reuses the
    cars' partitioning by sku when the price table was broadcast."""
    per_car = found.groupBy(*car_key).agg(
        F.first("_car", ignorenulls=True).alias("_car"), *[
            F.max(F.when(F.col("kind") == k, F.col("price"))).alias(f"_p_{k}")
            for k in kinds
        ], *[
            F.max(F.when((F.col("kind") == k) & F.col("id").isNotNull()
                         & F.col("price").isNull(), 1)).alias(f"_f_{k}")
            for k in kinds])
    return per_car.select(*car_key, "_car.*", *[c for c in per_car.columns
                                               if c.startswith(("_p_", "_f_"))])


def _settle(df: DataFrame, ids: dict[str, Column], total: str) -> DataFrame:
    kinds = list(ids)
    missing = None
    for k in kinds:  # first missing part, in kind order
        cond = ids[k].isNull()
        missing = (F.when(cond, F.lit(f"MISSING_{k}")) if missing is None
                   else missing.when(cond, F.lit(f"MISSING_{k}")))
    failed = F.greatest(*[F.coalesce(F.col(f"_f_{k}"), F.lit(0)) for k in kinds]) > 0 \
        if len(kinds) > 1 else F.coalesce(F.col(f"_f_{kinds[0]}"), F.lit(0)) > 0
    rounded = {k: money(F.col(f"_p_{k}")) for k in kinds}
    new_total = money(F.col(total) + sum(
        (rounded[k] * WHEEL_FACTOR if k == "WHEEL" else rounded[k]) for k in kinds))
    situation = (missing.when(failed, F.lit("FAILED_GET_PRICE"))
                 .otherwise(F.lit("COMPLETE")))
    out = df.withColumn("situation", situation).withColumn(
        total, F.when(F.col("situation") == "FAILED_GET_PRICE", F.lit(-1.0))
        .when(F.col("situation") == "COMPLETE", new_total).otherwise(F.col(total)))
    for k in kinds:
        out = out.withColumn(f"{k.lower()}_price", F.when(
            F.col("situation") == "COMPLETE", rounded[k]))
    return out.drop(*[f"_p_{k}" for k in kinds], *[f"_f_{k}" for k in kinds])


def price_cars(cars: DataFrame, prices: DataFrame, ids: dict[str, Column],
               car_key: list[str], total: str = "total_price",
               max_broadcast_rows: int | None = None, check_size: bool = True
               ) -> DataFrame:
    """Form 1. ``ids`` maps part kind -> id column of the car (null = part missing);
    ``prices`` has ``id, price``; ``car_key`` identifies a car. With ``check_size``
    off, ``prices`` is used as given (a caller that checked it once, e.g. before a
    stream starts, passes it already hinted). Adds ``situation``, ``<kind>_price`` and updates
    ``total`` (added to; starts at 0.0 if absent)."""
    if total not in cars.columns:
        cars = cars.withColumn(total, F.lit(0.0))
    look = _lookups(cars, car_key, ids)
    p = prices.select(F.col("id").cast("string").alias("id"), "price")
    if check_size:
        p = bounded_broadcast(p) if max_broadcast_rows is None else \
            bounded_broadcast(p, max_broadcast_rows)
    found = look.join(p, "id", "left")
    return _settle(_fold(found, car_key, list(ids)), ids, total)


def asker(fetch: Callable[[list[str]], dict[str, float]], capacity: int, timeout_s: float,
          retries: int, delay_s: float, chunk: int) -> Callable[[list[str]], dict[str, float]]:
    """ids -> prices, ``chunk`` ids a call and ``capacity`` calls at a time, abandoned ones
    included. A lookup has ``timeout_s`` in all; within it, ids that the answer lacks and calls
    that fail are tried again, ``retries`` times at most and ``delay_s`` apart."""
    slots = threading.Semaphore(capacity)

    def lookup(batch: list[str]) -> dict[str, float]:
        end, answer, missing = time.monotonic() + timeout_s, {}, batch
        for attempt in range(retries + 1):
            if not slots.acquire(timeout=max(0.0, end - time.monotonic())):
                break
            call = cf.Future()

            def run(asked=missing, call=call):
                try:
                    call.set_result(fetch(asked))
                except Exception as e:  # noqa: BLE001 - handed to the waiting lookup
                    call.set_exception(e)
                finally:
                    slots.release()
            threading.Thread(target=run, daemon=True).start()
            try:
                got = call.result(timeout=max(0.0, end - time.monotonic()))
                answer.update({i: got[i] for i in missing if got.get(i) is not None})
            except Exception:  # noqa: BLE001 - timeout or failure: tried again, then fails
                pass
            missing = [i for i in missing if i not in answer]
            left = end - time.monotonic()
            if not missing or left <= 0 or attempt == retries:
                break
            time.sleep(min(delay_s, left))
        return answer

    def ask(ids: list[str]) -> dict[str, float]:
        got: dict[str, float] = {}
        with cf.ThreadPoolExecutor(max_workers=capacity) as pool:
            for part in pool.map(lookup, [ids[i:i + chunk] for i in range(0, len(ids), chunk)]):
                got.update(part)
        return got
    return ask


def _answer(got: dict[str, float]) -> pd.DataFrame:
    return pd.DataFrame({"id": pd.Series(list(got), dtype=object),
                         "price": [float(v) for v in got.values()]})


#: Prices that one task holds at a time, about.
BUCKET_PRICES = 50_000


def fetch_prices(cars: DataFrame, fetch: Callable[..., dict[str, float]],
                 ids: dict[str, Column], car_key: list[str], total: str = "total_price",
                 capacity: int = LOOKUP_CAPACITY, timeout_s: float = LOOKUP_TIMEOUT_S,
                 retries: int = LOOKUP_RETRIES, delay_s: float = LOOKUP_RETRY_DELAY_S,
                 chunk: int = 256, per_id: bool = False, table: DataFrame | None = None
                 ) -> DataFrame:
    """Form 2: prices from ``fetch(list_of_ids) -> {id: price}`` (ids, as text, without a
    price are left out of the answer), with bounded concurrency, a deadline and retries per
    task (``asker``). Every distinct id is asked for once over the whole table; ids still
    without a price fail their car.

    ``per_id=True`` takes ``fetch(id) -> price | None`` instead, one request per id as
    the reference makes them; ``capacity`` then bounds the ids in flight.

    With a ``table`` (id, price; ids unique) the service is answered from it: ids and prices
    meet by hash bucket, and ``fetch(list_of_ids, prices)`` gets the bucket's prices as a
    dictionary. No price passes the driver, and a task holds one bucket, of about
    ``BUCKET_PRICES``, whatever the table's size."""
    if total not in cars.columns:
        cars = cars.withColumn(total, F.lit(0.0))
    if per_id:
        one, chunk = fetch, 1

        def fetch(batch, *table):  # noqa: F811 - the per-id fetch behind the batch interface
            v = one(batch[0], *table)
            return {} if v is None else {batch[0]: v}
    from partflow.session import materialize
    look = materialize(_lookups(cars, car_key, ids), "lookups")  # read twice: asked, priced
    how = (capacity, timeout_s, retries, delay_s, chunk)
    asked = look.select("id").where("id is not null").distinct()
    if table is None:
        def answers(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ask = asker(fetch, *how)
            for pdf in frames:
                if len(pdf):
                    yield _answer(ask(pdf["id"].tolist()))
        found = asked.mapInPandas(answers, "id string, price double")
    else:
        prices = table.select(F.col("id").cast("string").alias("id"),
                              F.col("price").cast("double").alias("price"))
        bucket = F.pmod(F.xxhash64("id"), F.lit(-(-max(1, prices.count()) // BUCKET_PRICES)))

        def of_bucket(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            known = dict(zip(held["id"], held["price"]))
            return _answer(asker(lambda batch: fetch(batch, known), *how)(own["id"].tolist()))
        found = (asked.groupBy(bucket.alias("b")).cogroup(prices.groupBy(bucket.alias("b")))
                 .applyInPandas(of_bucket, "id string, price double"))
    return _settle(_fold(look.join(found, "id", "left"), car_key, list(ids)), ids, total)


def from_table(ids: list[str], prices: dict[str, float]) -> dict[str, float]:
    """A ``fetch`` that answers from a price table, in place of a remote service."""
    return {i: prices[i] for i in ids if i in prices}
