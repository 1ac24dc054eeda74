"""Wait-joins on streams as folds per micro-batch, inside the JVM.

Each micro-batch (``foreachBatch``) joins the keys' state, a table of typed columns, with the new
arrivals, once by key, and folds the settled ones on from the state (``operators/folds``): those
before the horizon, which is the newest arrival less ``lateness``. What arrives at or after the
horizon stays in the state as it is, so results depend neither on how the input is cut into
micro-batches nor on the order within them.

State is a table of changes. A micro-batch reads and writes the keys that it touches only: those
with arrivals and those that are due (the earliest deadline, expiry or arrival not yet settled,
kept beside the state, lies before the horizon). A key's newest row counts; a key that nothing
waits for any more leaves a row that says so. Every ``compact`` micro-batches all of it is written
as one table of the keys that are alive, so that reading stays bounded by the state's size. Where
many keys are touched all state rows meet the arrivals by key and the untouched ones end there;
where these are few against the touched ones, the state is written whole.

Disk. A micro-batch is written once as it came (decoded), in the order of its keys' slots (a hash).
It is folded in passes over ranges of slots, each of at most ``PASS_ROWS`` rows of arrivals and
state per core, so that what is exchanged, sorted and folded at a time is bounded whatever the
micro-batch's size. What a pass has folded is written once; outputs, sinks and state are taken from
there. Shuffle files go when what wrote them is done (``session.brief_shuffles``). With ``tidy``
state that a later whole one replaces is emptied, too, and so are working tables at the end.

Tables of a stream are versioned by batch id (``Versions``): all that a batch writes (outputs of
every sink, state, late rows) becomes visible by its manifest, which is written last. Readers
take batches with a manifest only, so they never see one sink's part of a batch without the
other's, nor anything of an attempt that failed. A batch that is replayed after its manifest was
written changes nothing; one without starts from the last state with a manifest.

State has a version number and is read by column name: columns that a later version of a job
adds are null in older state, columns that it no longer has are left out.

Rows behind the horizon of earlier batches are late: they go to the table ``late`` with the batch
that they came in, and the manifest counts them. They are never dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators.folds import Wait, event, fold_from, nullable, number, out_type, state_type
from partflow.session import brief_shuffles, cores, scratch_path, state_partitions

TIME = T.TimestampType()
#: Rows of arrivals and state that one pass takes, per core; slots that keys are dealt to.
PASS_ROWS, SLOTS = 1_000_000, 1 << 16
#: Touched keys that are broadcast at most, to leave other state out of a micro-batch.
FEW_KEYS = 100_000
#: ``horizon`` in microseconds; ``base``: the batch whose state is whole, later ones hold changes.
MANIFEST = "batch_id bigint, horizon bigint, late bigint, version int, base bigint"
#: How tables and topics are packed: records repeat their own text a lot.
PACKED = "zstd"


class Versions:
    """The tables of a stream, by batch id, below ``path``; a batch counts once its manifest is
    there. While ``adding`` is set, what is written comes to what the batch has written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.adding = spark, path, False
        self.worked: set[str] = set()

    def manifests(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/*")
        except AnalysisException:  # no batch yet
            return self.spark.createDataFrame([], MANIFEST)

    def before(self, batch_id: int):
        """The newest manifest up to ``batch_id``, this included; None if there is none."""
        return (self.manifests().where(F.col("batch_id") <= batch_id)
                .orderBy(F.desc("batch_id")).first())

    def folder(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/batch_id={batch_id}"

    def write(self, name: str, batch_id: int, df: DataFrame) -> None:
        df.write.mode("append" if self.adding else "overwrite").parquet(
            self.folder(name, batch_id), compression=PACKED)

    def work(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written and read back; the working table takes the place of the last one."""
        path = f"{self.path}/work/{name}"
        self.worked.add(name)
        df.write.mode("overwrite").parquet(path, compression=PACKED)
        return self.spark.read.schema(df.schema).parquet(path)

    def empty(self, path: str) -> None:
        """Leave no rows in a table that nobody reads any more."""
        self.spark.createDataFrame([], "key string").write.mode("overwrite").parquet(path)

    def commit(self, batch_id: int, horizon, late: int, version: int, base=None) -> None:
        row = self.spark.createDataFrame([(batch_id, horizon, late, version, base)], MANIFEST)
        row.coalesce(1).write.mode("overwrite").parquet(self.folder("manifest", batch_id))

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        """The rows of all batches that have a manifest."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        try:
            rows = self.spark.read.schema(T.StructType(
                [*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(
                f"{self.path}/{name}")
        except AnalysisException:  # nothing written
            return self.spark.createDataFrame([], schema)
        return rows.join(F.broadcast(self.manifests().select("batch_id")), "batch_id",
                         "left_semi").select(*schema.names)


class WaitJob:
    """One wait-join (JN1, JN2, JN3, JN5, JN6) as a stage of a stream: rows ``left`` and
    ``right`` with the given payloads (structs with ``ts`` and ``seq``). Outputs: l, r, ts,
    now."""

    def __init__(self, wait: Wait, left: str, lt: T.StructType, right: str, rt: T.StructType):
        self.wait, self.left, self.right = wait, left, right
        self.kinds = {left: nullable(lt), right: nullable(rt)}
        self.lt, self.rt = self.kinds[left], self.kinds[right]
        self.state = state_type(wait, self.lt, self.rt, TIME)
        self.out = out_type(wait, self.lt, self.rt, TIME)

    def step(self, state: Column, settled: dict[str, Column], until: Column) -> Column:
        events = F.sort_array(F.concat(
            arrivals(settled[self.left], self.wait, 0, self.lt, self.rt),
            arrivals(settled[self.right], self.wait, 1, self.lt, self.rt)))
        got = fold_from(events, self.wait, self.lt, self.rt, TIME, state, until)
        # Folded once, used twice.
        return F.element_at(F.transform(F.array(got), lambda x: F.struct(
            F.struct(x["l"].alias("l"), x["r"].alias("r"), x["wd"].alias("wd")).alias("st"),
            x["out"].alias("out"))), 1)

    def alive(self, state: Column) -> Column:
        r = state["r"]
        return state["l"].isNotNull() | (F.size(r) > 0 if self.wait.mode == "collect"
                                         else r.isNotNull())

    def due(self, state: Column) -> list[Column]:
        return [due(self.wait, state)]


def due(wait: Wait, state: Column) -> Column:
    """When the state changes next if nothing comes: the deadline or the first expiry."""
    if wait.keep is None:
        return state["wd"]
    first = (F.array_min(F.transform(state["r"], lambda x: x["ts"])) if wait.mode == "collect"
             else state["r"]["ts"])
    return F.least(state["wd"], first + F.expr(f"INTERVAL {wait.keep}"))


def arrivals(rows: Column, wait: Wait, side: int, lt: T.DataType, rt: T.DataType) -> Column:
    null = F.lit(None).cast(lt if side else rt)
    return F.transform(rows, lambda x: event(wait, side, x["ts"], x["seq"],
                                             null if side else x, x if side else null))


class AssemblyJob:
    """JN8: body ⋈ engine (JN1) ⟕ remote control (JN2) ⟕ wheels (JN3) as one stage: three
    folds, each one's outputs the next one's left side. Outputs: body, engine, remote, wheels,
    ts, now."""

    def __init__(self, within: str, expected: int, kinds: dict[str, T.StructType]):
        self.kinds = {k: nullable(kinds[k]) for k in ("body", "engine", "remote", "wheel")}
        b, e, r, w = self.kinds.values()
        two = T.StructType([T.StructField("body", b), T.StructField("engine", e)])
        three = T.StructType([*two.fields, T.StructField("remote", r)])
        self.joins = [(Wait("full", within), b, e), (Wait("left", within), two, r),
                      (Wait("collect", within, expected), three, w)]
        self.state = T.StructType([T.StructField(f"s{i}", state_type(*j, TIME))
                                   for i, j in enumerate(self.joins, 1)])
        self.out = T.StructType([*three.fields, T.StructField("wheels", T.ArrayType(w)),
                                 T.StructField("ts", TIME),
                                 T.StructField("now", T.BooleanType())])

    def step(self, state: Column, settled: dict[str, Column], until: Column) -> Column:
        (w1, b, e), (w2, two, r), (w3, three, w) = self.joins
        first = F.sort_array(F.concat(arrivals(settled["body"], w1, 0, b, e),
                                      arrivals(settled["engine"], w1, 1, b, e)))
        one = fold_from(first, w1, b, e, TIME, state["s1"], until)

        def cars(done, wait, make, lt, rt):
            null = F.lit(None).cast(rt)
            return F.transform(done, lambda o, i: event(
                wait, 0, o["ts"], number(o, i), make(o).cast(lt), null))

        def second(x):
            events = F.sort_array(F.concat(
                cars(x["out"], w2, lambda o: F.struct(o["l"].alias("body"),
                                                      o["r"].alias("engine")), two, r),
                arrivals(settled["remote"], w2, 1, two, r)))
            return F.struct(held(x).alias("s1"),
                            fold_from(events, w2, two, r, TIME, state["s2"], until).alias("x"))

        def third(y):
            x = y["x"]
            events = F.sort_array(F.concat(
                cars(x["out"], w3, lambda o: F.struct(
                    o["l"]["body"].alias("body"), o["l"]["engine"].alias("engine"),
                    o["r"].alias("remote")), three, w),
                arrivals(settled["wheel"], w3, 1, three, w)))
            return F.struct(y["s1"].alias("s1"), held(x).alias("s2"),
                            fold_from(events, w3, three, w, TIME, state["s3"], until).alias("x"))

        def last(y):
            x = y["x"]
            return F.struct(
                F.struct(y["s1"].alias("s1"), y["s2"].alias("s2"), held(x).alias("s3")).alias("st"),
                F.transform(x["out"], lambda o: F.struct(
                    o["l"]["body"].alias("body"), o["l"]["engine"].alias("engine"),
                    o["l"]["remote"].alias("remote"), F.array_sort(o["r"]).alias("wheels"),
                    o["ts"].alias("ts"), o["now"].alias("now"))).alias("out"))
        out = F.array(one)
        for f in (second, third, last):  # each is computed once per key
            out = F.transform(out, f)
        return F.element_at(out, 1)

    def alive(self, state: Column) -> Column:
        some = (state["s1"]["l"].isNotNull() | state["s1"]["r"].isNotNull()
                | state["s2"]["l"].isNotNull() | state["s2"]["r"].isNotNull())
        return some | state["s3"]["l"].isNotNull() | (F.size(state["s3"]["r"]) > 0)

    def due(self, state: Column) -> list[Column]:
        return [due(j[0], state[f"s{i}"]) for i, j in enumerate(self.joins, 1)]


def held(x: Column) -> Column:
    return F.struct(x["l"].alias("l"), x["r"].alias("r"), x["wd"].alias("wd"))


def rest_of(kind: str) -> str:
    return f"rest_{kind}"


def state_schema(job) -> T.StructType:
    """``due``: before which horizon nothing happens without arrivals (null: never);
    ``gone``: nothing waits any more; ``slot``: of the key, null in older state."""
    return T.StructType([T.StructField("key", T.StringType()), T.StructField("st", job.state),
                         *[T.StructField(rest_of(k), T.ArrayType(t))
                           for k, t in job.kinds.items()],
                         T.StructField("due", TIME), T.StructField("gone", T.BooleanType()),
                         T.StructField("slot", T.IntegerType())])


def slot_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def in_slots(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Rows with ``low`` <= slot < ``high``. The first condition is one that Parquet's statistics
    can tell; rows without a slot have their key's."""
    if (low, high) == (0, SLOTS):
        return rows
    slot, own = F.col("slot"), F.coalesce("slot", slot_of("key"))
    return rows.where(slot.isNull() | ((slot >= low) & (slot < high))).where(
        (own >= low) & (own < high))


@dataclass
class Incremental:
    """A job over a stream of rows ``key, side, ts, p_<side>`` (one payload column per side),
    with its tables below ``path``. ``publish(outputs, batch_id)`` may write further tables of
    the batch through ``versions``; ``outputs`` has key, seq and the job's output columns. It is
    called once per pass, with all outputs of the pass's keys. ``keep_out`` off: what was published
    is not kept as ``outputs()`` besides."""
    spark: SparkSession
    job: object
    path: str
    lateness: str = "0 seconds"
    publish: Callable[[DataFrame, int], None] | None = None
    version: int = 1
    compact: int = 8
    tidy: bool = False
    keep_out: bool = True

    def __post_init__(self):
        self.versions = Versions(self.spark, self.path)

    def output_schema(self) -> T.StructType:
        return T.StructType([T.StructField("key", T.StringType()),
                             T.StructField("seq", T.LongType()), *self.job.out.fields])

    def outputs(self) -> DataFrame:
        return self.versions.read("out", self.output_schema())

    def late(self) -> DataFrame:
        """Late rows: key, side, ts and the payload as JSON."""
        return self.versions.read("late", "key string, side string, ts timestamp, value string")

    def per_batch(self, batch: DataFrame, batch_id: int) -> None:
        job, v = self.job, self.versions
        last = v.before(batch_id)
        if last is not None and last["batch_id"] == batch_id:
            return  # a replay of a batch that is done
        since = None if last is None else last["horizon"]
        behind = F.lit(False) if since is None else F.col("ts") < F.timestamp_micros(F.lit(since))
        batch = v.work("arrivals", batch.withColumn("slot", slot_of("key"))
                       .sortWithinPartitions("slot"))
        newest, n_late, n_rows = batch.agg(
            F.unix_micros(F.max("ts") - F.expr(f"INTERVAL {self.lateness}")),
            F.count_if(behind), F.count(F.lit(1))).first()
        horizon = max((x for x in (since, newest) if x is not None), default=None)
        if n_late:
            payload = F.coalesce(*[F.to_json(F.col(f"p_{k}")) for k in job.kinds])
            v.write("late", batch_id, batch.where(behind).select("key", "side", "ts",
                                                                 payload.alias("value")))
        chain = self._chain(last)
        old = self._held(chain)
        n_old, n_due = (0, 0) if old is None else old.agg(F.count(F.lit(1)), F.count_if(
            F.col("due") < F.timestamp_micros(F.lit(horizon).cast("long")))).first()
        touched = n_rows + n_due
        few = touched <= FEW_KEYS
        whole = len(chain) in (0, self.compact) or not few and 2 * touched >= n_old
        n_pass = n_rows + (n_due if few and not whole else n_old)
        passes = min(SLOTS, max(1, -(-n_pass // (PASS_ROWS * cores(self.spark)))))
        edges = [SLOTS * i // passes for i in range(passes + 1)]
        try:
            for low, high in zip(edges[:-1], edges[1:]):
                self._one_pass(in_slots(batch.where(~behind), low, high),
                               None if old is None else in_slots(old, low, high),
                               horizon, whole, few, batch_id)
                v.adding = True
        finally:
            v.adding = False
        v.commit(batch_id, horizon, n_late, self.version, batch_id if whole else chain[0])
        if self.tidy and whole:
            for b in chain:
                v.empty(v.folder("state", b))

    def _one_pass(self, fresh: DataFrame, old: DataFrame | None, horizon, whole: bool, few: bool,
                  batch_id: int) -> None:
        """Fold the arrivals and the state of some keys; write outputs and state."""
        job, v = self.job, self.versions
        full = v.work("folded", self._advance(fresh, old, horizon, whole, few))
        outs = full.select("key", F.posexplode("out").alias("_pos", "o")).select(
            "key", number(F.col("o"), F.col("_pos")).alias("seq"), "o.*")
        if self.publish is None or self.keep_out:
            v.write("out", batch_id, outs)
        rest = [rest_of(k) for k in job.kinds]
        some = job.alive(F.col("st"))
        for c in rest:
            some = some | (F.size(c) > 0)
        nexts = [*job.due(F.col("st")),
                 *[F.array_min(F.transform(c, lambda x: x["ts"])) for c in rest]]
        changed = some if whole else some | F.col("had")
        v.write("state", batch_id, full.where(changed).select(
            "key", F.when(some, F.col("st")).alias("st"), *rest,
            F.least(*nexts, F.lit(None).cast(TIME)).alias("due"), (~some).alias("gone"),
            slot_of("key").alias("slot")).sortWithinPartitions("slot"))
        if self.publish is not None:
            self.publish(outs, batch_id)

    def _chain(self, last) -> list[int]:
        """The batches whose state tables hold the state, the whole one first. State that was
        written without ``base`` is whole, but says nothing of when it is due: taken whole."""
        if last is None:
            return []
        base = last["batch_id"] if last["base"] is None else last["base"]
        return [r["batch_id"] for r in self.versions.manifests().where(
            F.col("batch_id").between(base, last["batch_id"])).orderBy("batch_id").collect()]

    def _held(self, chain: list[int]) -> DataFrame | None:
        """The state rows of these batches with their ``batch_id``."""
        if not chain:
            return None
        held = T.StructType([*state_schema(self.job).fields,
                             T.StructField("batch_id", T.LongType())])
        return (self.spark.read.schema(held)
                .option("basePath", f"{self.versions.path}/state")
                .parquet(*[self.versions.folder("state", b) for b in chain]))

    def _advance(self, fresh: DataFrame, old: DataFrame | None, horizon, whole: bool,
                 few: bool) -> DataFrame:
        """key, st, out, what is not settled yet, and whether it was in the state, of every key
        that arrivals or the horizon touch; ``whole``: of every key with state or arrivals.

        State rows and arrivals meet in one exchange and one grouping by key; the newest state of
        a key counts. Where few keys are touched (by arrivals and by what is due), other state is
        left out before."""
        job = self.job
        until = F.timestamp_micros(F.lit(horizon).cast("long"))
        held = T.StructType([T.StructField("batch_id", T.LongType()),
                             *[f for f in state_schema(job).fields if f.name not in
                               ("key", "slot")]])
        rows = fresh.select("key", F.lit(None).cast(held).alias("_s"), F.lit(True).alias("_new"), *[
            F.when(F.col("side") == k, F.col(f"p_{k}")).cast(t).alias(f"p_{k}")
            for k, t in job.kinds.items()])
        if old is not None:
            due = old.where(F.col("due") < until).select(F.col("key").alias("_k"))
            if few and not whole:
                some = F.broadcast(due.union(fresh.select("key")))
                old = old.join(some, F.col("key").eqNullSafe(F.col("_k")), "left_semi")
            rows = rows.unionByName(old.select(
                "key", F.struct(*held.names).alias("_s"), F.lit(False).alias("_new"),
                *[F.lit(None).cast(t).alias(f"p_{k}") for k, t in job.kinds.items()]))
        both = rows.groupBy("key").agg(
            F.max("_new").alias("_new"), F.max_by("_s", "_s.batch_id").alias("_s"),
            *[F.collect_list(f"p_{k}").alias(f"new_{k}") for k in job.kinds])
        had = F.col("_s").isNotNull() & ~F.coalesce(F.col("_s.gone"), F.lit(False))
        touched = had if whole else had & F.coalesce(F.col("_s.due") < until, F.lit(False))
        both = both.where(F.col("_new") | touched).select(
            "*", had.alias("had"), F.when(had, F.col("_s.st")).alias("st"),
            *[F.when(had, F.col(f"_s.{rest_of(k)}")).alias(rest_of(k)) for k in job.kinds])
        settled, later = {}, {}
        for k, t in job.kinds.items():
            none = F.array().cast(T.ArrayType(t))
            every = F.concat(F.coalesce(F.col(rest_of(k)), none),
                             F.coalesce(F.col(f"new_{k}"), none))
            both = both.withColumn(f"all_{k}", every)
            settled[k] = F.filter(f"all_{k}", lambda x: x["ts"] < until)
            later[k] = F.filter(f"all_{k}", lambda x: x["ts"] >= until)
        got = both.select("key", "had", job.step(F.col("st"), settled, until).alias("x"),
                          *[later[k].alias(rest_of(k)) for k in job.kinds])
        return got.select("key", "had", "x.st", "x.out", *[rest_of(k) for k in job.kinds])

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Take what the streaming ``source`` has, and stop."""
        with brief_shuffles(self.spark):
            with state_partitions(self.spark):
                q = (source.writeStream.foreachBatch(self.per_batch)
                     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
            q.awaitTermination()

    def close(self) -> None:
        """Empty the working tables, once nothing more is to come."""
        for name in self.versions.worked:
            self.versions.empty(f"{self.versions.path}/work/{name}")


def typed(topic: DataFrame, kinds: dict[str, str | T.DataType]) -> DataFrame:
    """A topic frame (key, side, ts, seq, JSON value) with one payload column per side: ``ts``,
    ``seq`` and the fields of the value, of the given type."""
    out = topic
    for k, t in kinds.items():
        x = F.from_json("value", t if isinstance(t, str) else t.simpleString())
        out = out.withColumn("_x", F.when(F.col("side") == k, x)).withColumn(
            f"p_{k}", F.when(F.col("side") == k, F.struct(
                F.col("ts").cast(TIME).alias("ts"), "seq", "_x.*"))).drop("_x")
    return out.select("key", "side", F.col("ts").cast(TIME).alias("ts"),
                      *[f"p_{k}" for k in kinds])


def payload_type(fields: str | T.StructType) -> T.StructType:
    """The payload of ``typed`` for a value with these fields."""
    own = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    return T.StructType([T.StructField("ts", TIME), T.StructField("seq", T.LongType()),
                         *own.fields])


def run_sliced(spark: SparkSession, frame: DataFrame, job, values: dict, name: str, slices: int,
               horizon_ms: int, publish=None, stored: bool = True) -> Incremental:
    """Feed a topic frame slice by slice (``runner.time_slices``), one ``availableNow`` run
    each from the same checkpoint; ``values``: the type of each side's value. A slice that was
    taken is deleted when the next one comes. ``stored``: the frame is written once before it is
    cut; off for frames that are cheaper to compute than to keep."""
    from partflow.streaming.runner import TOPIC_SCHEMA, time_slices
    topic, path = scratch_path(spark, f"{name}-topic"), scratch_path(spark, f"{name}-tables")
    stream = Incremental(spark, job, path, publish=publish, tidy=True)
    for i, part in enumerate(time_slices(spark, frame, slices, horizon_ms, stored)):
        part.write.parquet(f"{topic}/slice-{i:05d}", compression=PACKED)
        source = spark.readStream.schema(TOPIC_SCHEMA).option("cleanSource", "delete").parquet(
            f"{topic}/slice-*")
        stream.run(typed(source, values), f"{path}/checkpoint")
    stream.close()
    return stream
